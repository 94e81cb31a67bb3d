import base64
import hashlib
import re

import public_tokenizers
import tiktoken
from test_decontaminate import expected as contaminated
from test_jaccard_join import expected as near

import corpus_pipeline
from tidemark.llm import decontaminate as dc
from tidemark.llm import exact_dedup, jaccard_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(docs, items):
    docs = {d: t for d, t in docs if t and re.search(r"[^\W\d_]", t)}
    last = {}
    for d, t in docs.items():
        last[t.translate(LOWER)] = max(d, last.get(t.translate(LOWER), d))
    docs = {d: docs[d] for d in last.values()}
    docs = {d: docs[d] for d, _, c in near(list(docs.items())) if d == c}
    bad = contaminated(list(docs.items()), items, dc.LEAST, dc.COVERAGE)
    docs = {d: t for d, t in docs.items() if not bad[d][0]}
    lines = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for d, t in docs.items():
        ids = encoding.encode_ordinary(t)
        out.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), len(t.encode())))
    return sorted(out)


def test_run_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()) == expected(docs, items)


def test_stages_keep_columns_and_take_odd_rows(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, s int, key string, label string"
    long = " ".join(f"word{i}" for i in range(25))
    rows = [(1, "Good day to you all", "en"), (2, None, "en"), (3, "", None), (4, "12 34", "en"), (5, "good day to you all", "en"), (5, "good day to you all", "en"),
            (None, "guten tag und auf wiedersehen", "de"), (7, long, "en"), (8, long + " x", "en"), (9, "guten abend meine damen", "de")]
    docs = spark.createDataFrame([(*r, "src", 1, 2, "k", "l") for r in rows], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 5, 7, 9]


def test_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.collect() == []


def test_stages_keep_columns_that_look_like_helpers(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, 10, 11, 12, 13, "a"), (2, text + " more", 20, 21, 22, 23, "b"), (3, "etwas anderes", 30, 31, 32, 33, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _k int, _own int, _row int, _doc_id int, k string")
    items = spark.createDataFrame([(1, "etwas ganz anderes, das nirgends steht und lang genug ist")], "item_id long, text string")
    kept = exact_dedup.kept_rows(docs, exact_dedup.exact_dedup(docs))
    assert sorted(tuple(r) for r in kept.collect()) == rows
    assert sorted(tuple(r) for r in dc.clean_rows(docs, items).collect()) == rows
    assert sorted(tuple(r) for r in jaccard_join.one_of_each(docs).collect()) == [rows[0], rows[2]]
