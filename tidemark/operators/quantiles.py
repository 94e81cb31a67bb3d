"""Exact quantiles of groups of any size.

``percentile`` keeps every value of a group in one aggregation buffer. Groups of up to ``LIMIT`` rows take that way,
together with all other aggregates. For larger ones, mergeable sketches give borders by rank: every pass puts
a grid of approximate quantiles over what is left of a group, keeps the few grid steps that surely hold the wanted
rank, and counts exactly what lies below. The share left does not depend on the distribution. Values equal to a
border are only counted, so copies never pile up.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import broadcast_if_small, scratch_dir

LIMIT = 100_000
GRID = 256
ACCURACY = 4096


def exact_quantiles(
    df: DataFrame, keys, value: str, wanted: dict, sizes: DataFrame | None = None, aggregates=(), limit: int = LIMIT
) -> DataFrame:
    """One row per key: ``aggregates`` and a column for each ``{name: probability}``, interpolated linearly.

    ``aggregates`` use no other columns than ``value`` and the keys. NULL and NaN are left out of the quantiles; a group
    of nothing else has NULL ones. ``sizes`` may name a cheaper frame of upper bounds ``rows`` of group sizes.
    """
    keys = list(keys)
    spark = df.sparkSession
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")) if sizes is None else sizes
    largest = sizes.agg(F.max("rows")).first()[0] or 0
    number = F.col(value).cast("double")
    known = F.when(~F.isnan(number), number)
    if largest <= limit:
        found = df.groupBy(*keys).agg(*aggregates, F.percentile(known, [float(p) for p in wanted.values()]).alias("_q"))
        rest = [c for c in found.columns if c != "_q"]
        return found.select(*rest, *[F.col("_q")[i].alias(n) for i, n in enumerate(wanted)])
    df = _written(df.select(*keys, value), "values")
    groups = df.groupBy(*keys).agg(*aggregates) if aggregates else df.select(*keys).distinct()
    values = df.select(*keys, known.alias("_v")).where("_v IS NOT NULL")
    return groups.join(narrowed_quantiles(values, keys, wanted, limit), keys, "left")


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrowed_quantiles(values: DataFrame, keys, wanted: dict, limit: int = LIMIT, left: list | None = None) -> DataFrame:
    """Quantiles of a stored table (keys, _v), narrowed until at most ``limit`` values lie between the borders of a group.

    ``left`` collects the largest number of values between two borders before each pass and at the end.
    """
    keys, left = list(keys), [] if left is None else left
    each = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in wanted.items()])
    at = (F.col("_n") - 1) * F.col("_q.p")
    none, zero = F.lit(None).cast("double"), F.lit(0).cast("long")
    # The wanted ranks lie in [_lo, _hi] (NULL: no border): _below values are smaller, _equal ones equal to _lo, and _n
    # lie strictly between.
    state = (
        values.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_q", F.explode(each))
        .select(*keys, F.col("_q.name").alias("_name"), none.alias("_lo"), none.alias("_hi"), zero.alias("_below"), zero.alias("_equal"), "_n",
                F.floor(at).alias("_r0"), F.ceil(at).alias("_r1"), (at - F.floor(at)).alias("_part"))
    )
    columns = state.columns
    closed = "(_lo IS NULL OR _v >= _lo) AND (_hi IS NULL OR _v <= _hi)"
    points = [i / GRID for i in range(GRID + 1)]

    def held(frame):
        return values.join(broadcast_if_small(frame), keys).where(closed)

    while True:
        state = _written(state, "borders")
        left.append(state.agg(F.max("_n")).first()[0] or 0)
        if left[-1] <= limit or len(left) > 1 and left[-1] > left[-2] / 2:
            break
        open_ = F.when((F.col("_lo").isNull() | (F.col("_v") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_v") < F.col("_hi"))), F.col("_v"))
        grid = held(state).groupBy(*keys, "_name").agg(F.percentile_approx(open_, points, ACCURACY).alias("_g"))
        # The true rank of a grid point is off by at most n / ACCURACY.
        first, last = [F.try_divide(F.col(r) - F.col("_below") - F.col("_equal"), F.col("_n")) for r in ("_r0", "_r1")]
        low = F.least(F.floor(GRID * (first - 2 / ACCURACY)), F.lit(GRID)).cast("int")
        high = F.greatest(F.ceil(GRID * (last + 2 / ACCURACY)), F.lit(0)).cast("int")
        tried = _written(state.join(grid, [*keys, "_name"], "left").withColumns({
            "_lo2": F.when(low >= 0, F.get("_g", low)), "_hi2": F.when(high <= GRID, F.get("_g", high))}).drop("_g"), "borders")
        counts = {"_lt_lo": "_v < _lo2", "_le_lo": "_v <= _lo2", "_lt_hi": "_v < _hi2", "_le_hi": "_v <= _hi2", "_lt_old": "_hi IS NULL OR _v < _hi"}
        counted = held(tried).groupBy(*keys, "_name").agg(*[F.count_if(F.expr(e)).alias(n) for n, e in counts.items()])
        # A border that would miss a rank is not taken.
        up = F.coalesce((F.col("_below") + F.col("_lt_lo") <= F.col("_r0")) & F.col("_lo2").isNotNull(), F.lit(False))
        down = F.coalesce((F.col("_below") + F.col("_le_hi") > F.col("_r1")) & F.col("_hi2").isNotNull(), F.lit(False))
        state = tried.join(counted, [*keys, "_name"]).withColumns({
            "_n": F.greatest(zero, F.when(down, F.col("_lt_hi")).otherwise(F.col("_lt_old")) - F.when(up, F.col("_le_lo")).otherwise(F.col("_equal"))),
            "_below": F.col("_below") + F.when(up, F.col("_lt_lo")).otherwise(zero),
            "_equal": F.when(up, F.col("_le_lo") - F.col("_lt_lo")).otherwise(F.col("_equal")),
            "_lo": F.when(up, F.col("_lo2")).otherwise(F.col("_lo")),
            "_hi": F.when(down, F.col("_hi2")).otherwise(F.col("_hi"))}).select(*columns)
    # Copies of a value are one row here.
    rest = held(state).groupBy(*keys, "_name", "_below", "_r0", "_r1", "_part", "_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.col("_below") + F.sum("_n").over(W.partitionBy(*keys, "_name").orderBy("_v"))
    found = (
        rest.withColumn("_upto", upto)
        .groupBy(*keys, "_name", "_part")
        .agg(*[F.min(F.when(F.col("_upto") > F.col(r), F.col("_v"))).alias(v) for r, v in (("_r0", "_v0"), ("_r1", "_v1"))])
        .withColumn("_value", F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_part"))
    )
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == n, F.col("_value"))).alias(n) for n in wanted])
