"""URL filter: rules first, then a character language-model ratio. DataFrame functions only.

URLs that a rule decides teach two variable-order Markov models, one of accepted and one of rejected URLs. A character
follows a context of up to ``ORDER`` characters; the estimate of every length is smoothed with that of the next
shorter one in proportion to how often the context was followed by something new (Witten and Bell), down to a
uniform one. All other URLs are judged by the difference of both log-likelihoods per character, against a threshold
calibrated on URLs of hosts that the models have not seen.

The counts cover every decided URL and grow with the table. Every level of a model is a table keyed by its string;
a string meets at most one row per character of the alphabet, so no key is hot. Texts are looked up by shuffle
once the models have more rows than may be broadcast.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import CRC32_SQL, lower_ascii, stored
from tidemark.session import broadcast_if_small

# Verdict and rule, a host followed by a path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
ORDER = 5
CODE_POINTS = 1_114_112
PIECE = 512
SALTS = 16
# A fifth of the hosts calibrates the threshold; scores are counted in steps of 1 / STEPS up to +-LIMIT / STEPS.
FOLDS = 5
STEPS, LIMIT = 100, 2000
# URLs with more than this share of all rows (so fewer than 1 / share of them) are looked up by broadcast.
HOT_SHARE = 0.001


def parsed(url):
    """(host, path): host after the first ``://``, A-Z lower-cased; both empty for null or no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits; null for none. A rule fits its host and all subdomains."""
    rule = verdict = None
    for decision, text in sorted(rules, key=lambda r: -len(r[1])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, decision) if verdict is None else verdict.when(fits, decision)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def grams(urls, order=ORDER):
    """One row per character of ``text`` and its end: ``gram``, the character after up to ``order`` before it."""
    n = F.length("text") + 1
    padded = F.concat(F.lit("\x02" * order), F.col("text"), F.lit("\x03"))
    # Long texts are cut first, so that a position is found in a short piece.
    pieces = urls.select("*", n.alias("_n"), F.explode(F.sequence(F.lit(0), n - 1, F.lit(PIECE))).alias("_at"), padded.alias("_padded"))
    pieces = pieces.select(
        *urls.columns, F.least(F.lit(PIECE), F.col("_n") - F.col("_at")).alias("_n"), F.substr("_padded", F.col("_at") + 1, F.lit(PIECE + order)).alias("_piece"))
    at = F.transform(F.sequence(F.lit(1), "_n"), lambda i: F.substr("_piece", i, F.lit(order + 1)))
    return pieces.select(*urls.columns, F.explode(at).alias("gram")).drop("text")


def log_ratios(counted, order=ORDER):
    """(gram, ratio): log of the accepted over the rejected model's estimate, for counts (gram, allow, block)."""
    below = None
    for rows in range(1, order + 2):
        text = F.substr("gram", F.lit(order + 2 - rows), F.lit(rows))
        level = counted.groupBy(text.alias("s")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        context = W.partitionBy(F.substr("s", F.lit(1), F.lit(rows - 1)))
        level = level.withColumns({f"{c}_all": F.sum(c).over(context) for c in ("allow", "block")} | {
            f"{c}_kinds": F.sum(F.when(F.col(c) > 0, 1).otherwise(0)).over(context) for c in ("allow", "block")})
        if below is None:
            level = level.withColumns({f"{c}_less": F.lit(1.0 / CODE_POINTS) for c in ("allow", "block")})
        else:
            shorter = below.select(F.col("s").alias("_s"), *[F.col(f"{c}_p").alias(f"{c}_less") for c in ("allow", "block")])
            level = level.join(shorter, F.substr("s", F.lit(2), F.lit(rows)) == F.col("_s"))
        # A context that never occurred leaves the estimate of the shorter one.
        below = level.select("s", *[
            F.when(F.col(f"{c}_all") > 0, (F.col(c) + F.col(f"{c}_kinds") * F.col(f"{c}_less")) / (F.col(f"{c}_all") + F.col(f"{c}_kinds")))
            .otherwise(F.col(f"{c}_less")).alias(f"{c}_p") for c in ("allow", "block")])
    return below.select(F.col("s").alias("gram"), (F.ln("allow_p") - F.ln("block_p")).alias("ratio"))


def scores(urls, ratios, order=ORDER):
    """(name, score): mean log ratio per character, the end included, to 6 places. ``urls`` has name and text."""
    rows = grams(urls.select("name", "text"), order)
    table = broadcast_if_small(ratios)
    if table is ratios:
        # A frequent gram is looked up in as many places as there are salts.
        rows = rows.withColumn("salt", F.pmod(F.hash("name"), F.lit(SALTS)))
        table = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.join(table, ["gram", "salt"])
    else:
        joined = rows.join(table, "gram")
    return joined.groupBy("name").agg(F.round(F.sum("ratio") / F.count(F.lit(1)), 6).alias("score"))


def threshold(scored):
    """The score from which a URL is accepted: the best mean of both recalls over (score, decided, n).

    Ties go to the value nearest to 0, then to the smaller one; without URLs of both kinds it is 0.
    """
    step = F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(F.col("score") * STEPS))).cast("int")
    n = {c: F.sum(F.when(F.col("decided") == c, F.col("n")).otherwise(0)) for c in ("allow", "block")}
    steps = scored.groupBy(step.alias("step")).agg(*[e.alias(c) for c, e in n.items()])  # at most 2 * LIMIT + 1 rows
    whole, before = W.partitionBy(), W.orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    recalls = (
        (F.sum("allow").over(whole) - F.coalesce(F.sum("allow").over(before), F.lit(0))) / F.nullif(F.sum("allow").over(whole), F.lit(0))
        + F.coalesce(F.sum("block").over(before), F.lit(0)) / F.nullif(F.sum("block").over(whole), F.lit(0)))
    best = steps.select("step", F.round(recalls, 9).alias("recalls")).filter("recalls IS NOT NULL")
    first = best.orderBy(F.desc("recalls"), F.abs("step"), "step").first()
    return first["step"] / STEPS if first else 0.0


def judge(pages, rules=RULES, id_col="page_id", url_col="url", order=ORDER):
    """One row per page: id, host, path, rule (null for none), verdict (allow or block) and the model's score.

    The verdict is the longest fitting rule's; else allow from the calibrated score on. A null URL is scored as an empty
    one, like an empty one and one without ``://`` it has neither host nor path. Without URLs that rules allow, or that
    rules block, all others are allowed. Repeated rows and ids, null ids too, are judged row by row. Other columns
    are ignored.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    pages = pages.select(F.col(f"`{id_col}`").alias(id_col), url.alias("text"))
    host, path = parsed(F.col("text"))
    pages = pages.withColumns({"host": host, "path": path})
    rule, decided = ruled(F.col("host"), F.col("path"), rules)
    pages = pages.withColumns({"rule": rule, "decided": decided, "name": F.unhex(F.md5("text"))})
    urls = pages.groupBy("name", "text", "host", "decided").agg(F.count(F.lit(1)).alias("n"))
    urls = stored(spark, urls.withColumn("seen", F.crc32(F.encode("host", "UTF-8")) % FOLDS != 0), "urls")
    taught = {c: F.sum(F.when(F.col("seen") & (F.col("decided") == c), F.col("n")).otherwise(0)).alias(c) for c in ("allow", "block")}
    counted = stored(spark, grams(urls, order).groupBy("gram").agg(*taught.values()), "grams")
    ratios = stored(spark, log_ratios(counted, order), "ratios")
    scored = stored(spark, urls.drop("text", "host").join(scores(urls, ratios, order), "name"), "scores")
    least = threshold(scored.filter("NOT seen AND decided IS NOT NULL"))
    total = scored.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > HOT_SHARE * total
    hot = F.broadcast(scored.filter(often).select("name", F.col("score").alias("_hot")))
    rest = scored.filter(~often).select(F.col("name").alias("_name"), F.col("score").alias("_cold"))
    # What is found already is dealt anywhere.
    out = pages.join(hot, "name", "left")
    other = F.when(F.col("_hot").isNull(), F.col("name")).otherwise(F.unhex(F.md5(F.concat(F.lit("hot:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))))
    out = out.withColumn("_other", other).join(rest, F.col("_other") == F.col("_name"), "left")
    score = F.coalesce("_hot", "_cold")
    verdict = F.coalesce("decided", F.when(score >= least, "allow").otherwise("block"))
    return out.select(id_col, "host", "path", "rule", verdict.alias("verdict"), score.alias("score"))


def oracle(rules=RULES, order=ORDER):
    """DuckDB SQL for the columns of the registered query."""
    longest = sorted(rules, key=lambda r: -len(r[1]))

    def fits(text):
        name, _, start = text.partition("/")
        return f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{start}')"

    rule = " ".join(f"WHEN {fits(t)} THEN '{t}'" for _, t in longest)
    decided = " ".join(f"WHEN {fits(t)} THEN '{d}'" for d, t in longest)
    levels = ""
    for rows in range(1, order + 2):
        less = {c: f"1.0::DOUBLE / {CODE_POINTS}" if rows == 1 else f"b.{c}_p" for c in ("allow", "block")}
        p = ", ".join(
            f"CASE WHEN {c}_all > 0 THEN ({c} + {c}_kinds * {less[c]}) / ({c}_all + {c}_kinds) ELSE {less[c]} END AS {c}_p" for c in ("allow", "block"))
        join = "" if rows == 1 else f" JOIN p{rows - 1} b ON substr(l.s, 2, {rows}) = b.s"
        levels += f"""
l{rows} AS (SELECT s, allow, block, {", ".join(f"sum({c}) OVER w AS {c}_all, count(*) FILTER ({c} > 0) OVER w AS {c}_kinds" for c in ("allow", "block"))}
  FROM (SELECT substr(gram, {order + 2 - rows}, {rows}) AS s, sum(allow) AS allow, sum(block) AS block FROM counted GROUP BY 1)
  WINDOW w AS (PARTITION BY substr(s, 1, {rows - 1}))),
p{rows} AS (SELECT l.s, {p} FROM l{rows} l{join}),"""
    return f"""
WITH split AS (
  SELECT page_id, coalesce(url, '') AS text, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parsed AS (
  SELECT page_id, text, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') AS path FROM split),
ruled AS (SELECT *, CASE {rule} END AS rule, CASE {decided} END AS decided FROM parsed),
folds AS ({CRC32_SQL.format(table="(SELECT DISTINCT host AS t FROM ruled)")}),
texts AS (SELECT text, decided, crc % {FOLDS} <> 0 AS seen, count(*) AS n FROM ruled JOIN folds ON t = host GROUP BY ALL),
chars AS (SELECT * EXCLUDE i, substr(repeat(chr(2), {order}) || text || chr(3), i + 1, {order + 1}) AS gram
  FROM (SELECT *, unnest(range(0, length(text) + 1)) AS i FROM texts)),
counted AS (SELECT gram, coalesce(sum(n) FILTER (seen AND decided = 'allow'), 0) AS allow, coalesce(sum(n) FILTER (seen AND decided = 'block'), 0) AS block FROM chars GROUP BY gram),
{levels}
scored AS (SELECT text, decided, seen, n, round(sum(ln(allow_p) - ln(block_p)) / count(*), 6) AS score
  FROM chars JOIN p{order + 1} ON s = gram GROUP BY text, decided, seen, n),
steps AS (SELECT greatest(-{LIMIT}, least({LIMIT}, floor(score * {STEPS}))) AS step, coalesce(sum(n) FILTER (decided = 'allow'), 0) AS a, coalesce(sum(n) FILTER (decided = 'block'), 0) AS b
  FROM scored WHERE NOT seen AND decided IS NOT NULL GROUP BY 1),
recalls AS (SELECT step, round((sum(a) OVER () - coalesce(sum(a) OVER before, 0)) / nullif(sum(a) OVER (), 0) + coalesce(sum(b) OVER before, 0) / nullif(sum(b) OVER (), 0), 9) AS r
  FROM steps WINDOW before AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
best AS (SELECT coalesce((SELECT step / {STEPS} FROM recalls WHERE r IS NOT NULL ORDER BY r DESC, abs(step), step LIMIT 1), 0) AS least)
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.decided, CASE WHEN s.score >= least THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled r JOIN scored s USING (text) CROSS JOIN best
"""
