"""Exact deduplication by a tree merge of sorted digest runs, in DataFrame operations only."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, stored, unused

RUNS = 64
FAN_IN = 4


def digests(docs, id_col="doc_id", text_col="text", normalise=lower_ascii):
    """(id, sha, check): SHA-256 of the normalised text; length and a second hash verify a match."""
    text = normalise(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    return docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("t")).select(
        "id", F.unhex(F.sha2("t", 256)).alias("sha"), F.struct(F.octet_length("t").alias("bytes"), F.xxhash64("t").alias("xx")).alias("check")
    )


def merge_runs(rows, runs=RUNS, fan_in=FAN_IN, keep="min"):
    """One row per digest: (sha, check, keep_id, group_size), merged round by round.

    Input partitions form ``runs`` runs; each holds a digest once, collapsed before its first exchange. In
    round r, runs whose numbers agree above the r-th digit (base ``fan_in``) send their digest ranges to the
    first of them, which sorts what it gets by digest and keeps, of adjacent rows that agree in digest, length
    and second hash, the one with the smallest (or largest) id and the sum of their rows. Spark's sort merges
    the sorted runs it receives. A digest has at most ``fan_in`` rows there, however many copies exist.
    """
    best = F.min if keep == "min" else F.max
    first = F.asc_nulls_last("keep_id") if keep == "min" else F.desc_nulls_last("keep_id")
    ranges = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    level = rows.select(
        (F.spark_partition_id() % runs).alias("run"),
        # the digest's leading bits, so that ranges follow digest order
        F.floor(F.conv(F.hex(F.substring("sha", 1, 4)), 16, 10).cast("long") * ranges / F.lit(2**32)).cast("int").alias("range"),
        "sha", "check", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
    )
    level = level.groupBy("sha", "check", "range", "run").agg(best("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    same = Window.partitionBy("sha", "check", "range", "run").orderBy(first)
    stride = 1
    while stride < runs:
        stride *= fan_in
        level = (
            level.withColumn("run", F.col("run") - F.col("run") % stride)
            .repartition(ranges, "range", "run")
            .withColumn("place", F.row_number().over(same))
            .withColumn("group_size", F.sum("group_size").over(same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .filter("place = 1").drop("place")
        )
    return level.drop("range", "run")


def exact_dedup(docs, id_col="doc_id", text_col="text", normalise=lower_ascii, keep="max", runs=RUNS):
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Null texts count as empty. Of equal texts the row with the largest (or smallest) id stays; a null
    id stays only if every id of its group is null. Of rows that repeat an id and a text exactly one
    can stay. Other columns, also clashing ones, are ignored; an empty table gives an empty result.
    """
    # Stored, so that texts are read and hashed once.
    rows = stored(docs.sparkSession, digests(docs, id_col, text_col, normalise), "digests")
    groups = merge_runs(rows, runs, keep=keep)
    # Rows that repeat id and text are counted, not gathered, and laid out again at the end.
    own = rows.groupBy("id", "sha", "check").agg(F.count("*").alias("n"))
    same = [F.col("o.sha") == F.col("g.sha"), F.col("o.check.bytes") == F.col("g.check.bytes"), F.col("o.check.xx") == F.col("g.check.xx")]
    joined = own.alias("o").join(groups.alias("g"), same[0] & same[1] & same[2])
    spread = joined.select("o.id", "g.keep_id", "g.group_size", F.lower(F.hex("o.sha")).alias("text_sha256"),
                           F.explode(F.sequence(F.lit(1).cast("long"), "o.n")).alias("copy"))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return spread.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def kept_rows(docs, decisions, id_col="doc_id", text_col="text", normalise=lower_ascii):
    """The input rows, all columns, that ``exact_dedup`` keeps: one per text."""

    def named(sha, i):
        return F.concat(sha, F.lit(":"), F.coalesce(i.cast("string"), F.lit("null")))

    sha = F.sha2(normalise(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))), 256)
    row = unused("_row", *docs.columns)
    winners = decisions.filter("kept").select(named(F.col("text_sha256"), F.col(id_col)).alias(row))
    rows = docs.withColumn(row, named(sha, docs[id_col]))
    return rows.join(winners, row, "left_semi").dropDuplicates([row]).drop(row)
