"""The registered queries of the corpus operators, each over its whole table."""

from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, exact_dedup, jaccard_join, language_id, materialise, quality, secrets, spelling, substring_dedup, suffix_dedup, url_filter, whitening
from tidemark.llm.common import documents, prepare, shared_folder

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_byte_bpe(spark, sf):
    return bpe.encode_digests(documents(spark, sf))


@query
def op2_substring_dedup(spark, sf):
    return substring_dedup.digests(substring_dedup.substring_dedup(documents(spark, sf)))


@query
def op3_jaccard_join(spark, sf):
    return jaccard_join.jaccard_components(documents(spark, sf))


@query
def op4_suffix_dedup(spark, sf):
    return suffix_dedup.digests(suffix_dedup.suffix_dedup(documents(spark, sf), later_only=False))


@query
def op5_decontaminate(spark, sf):
    return decontaminate.decontaminate(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query
def op6_training_order(spark, sf):
    return materialise.materialise(documents(spark, sf), shared_folder(spark, "shards"))


@query
def op7_language_id(spark, sf):
    return language_id.predict(documents(spark, sf))


@query
def op8_exact_dedup(spark, sf):
    return exact_dedup.exact_dedup(documents(spark, sf))


ORACLES["op8_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


@query
def op9_secret_scan(spark, sf):
    return secrets.report(secrets.scan(documents(spark, sf)))


@query
def op10_quality(spark, sf):
    return quality.predict(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


ORACLES["op2_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 33), lambda s: {'s': s, 'h': sha256(array_to_string(list_slice(w, s, s + 34), ' '))}), recursive := true) FROM d),
again AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS i FROM windows SEMI JOIN again USING (h)),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n, count(*) FILTER (p IS NULL OR p < i - 1) AS spans
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM gone) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256, coalesce(spans, 0) AS n_spans
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""


ORACLES["op3_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda s: array_to_string(list_slice(w, s, s + 4), ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM d),
shingles AS (SELECT doc_id, unnest(g) AS x FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= 80 * (len(x.g) + len(y.g) - n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT doc_id, len(g)::BIGINT AS n_shingles, least AS component_id
FROM sets JOIN (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a) USING (doc_id)
"""


@query
def op12_url_filter(spark, sf):
    return url_filter.judge(prepare(spark).read.parquet(f"{sf}/pages.parquet")).drop("score")


ORACLES["op12_url_filter"] = url_filter.oracle()


@query
def op11_embedding_whitening(spark, sf):
    rows = whitening.whiten(prepare(spark).read.parquet(f"{sf}/embeddings.parquet"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


@query
def op13_spelling_variants(spark, sf):
    return spelling.variants(documents(spark, sf))


ORACLES["op13_spelling_variants"] = spelling.ORACLE
