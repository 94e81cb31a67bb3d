"""Connected components of a table of links by alternating stars, in DataFrame operations."""

from pyspark.sql import functions as F

from tidemark.llm.common import discard, stored


def _with_least(pairs):
    """(u, v, m) with m the least of u and its neighbours v. Hot nodes are aggregated first, then joined."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("m", "u"))


def _is_settled(pairs):
    """Every node hangs on one other that hangs on none."""
    roles = pairs.select(F.col("u").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        pairs.select(F.col("v").alias("n"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    each = roles.groupBy("n").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return each.filter("hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()


def components(spark, links, most_rounds=60):
    """(node, label) of every node in ``links`` (a, b): the label is the smallest node of its component.

    Every round hangs larger neighbours, then smaller ones, on the least neighbour; the table of pairs is
    written after each round. It ends when every node hangs on its label.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    for _ in range(most_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = _with_least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        before, pairs = pairs, stored(spark, small.filter("u <> v").distinct(), "pairs")
        discard(before)
        if _is_settled(pairs):
            break
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
