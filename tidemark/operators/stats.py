"""Summaries, distributions, correlation, gaps and error measures."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio, round_half_up
from tidemark.functions.timeframes import bars_between, epoch_seconds, later_bar, seconds_of
from tidemark.operators.indicators import returns_pct, returns_step
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators.series import Step, over_block, run
from tidemark.schemas import SERIES
from tidemark.session import BROADCAST_ROWS, broadcast_if_small, scratch_dir


def rows():
    return F.count(F.lit(1))


def table_stats(candles: DataFrame) -> DataFrame:
    days = F.floor((epoch_seconds(F.max("time")) - epoch_seconds(F.min("time"))) / 86400)
    return candles.agg(
        F.count_distinct("symbol").alias("nb_symbols"),
        rows().alias("total_candles"),
        F.min("time").alias("first_date"),
        F.max("time").alias("last_date"),
        days.alias("days"),
    )


def count_per_symbol(candles: DataFrame) -> DataFrame:
    return (
        candles.groupBy("symbol").agg(rows().alias("count")).orderBy(F.desc("count"), "symbol")
    )


def distinct_symbols(candles: DataFrame) -> DataFrame:
    return candles.select("symbol").distinct()


def symbol_stats(candles: DataFrame) -> DataFrame:
    return (
        candles.groupBy("symbol")
        .agg(
            rows().alias("nb_candles"),
            F.min("time").alias("first_date"),
            F.max("time").alias("last_date"),
            round_half_up(F.avg("close"), 2).alias("avg_price"),
            round_half_up(F.min("low"), 2).alias("min_price"),
            round_half_up(F.max("high"), 2).alias("max_price"),
            round_half_up(F.sum("volume"), 2).alias("total_volume"),
        )
        .orderBy(F.desc_nulls_first("total_volume"), "symbol")
    )


def summary(candles: DataFrame) -> DataFrame:
    """Whole-period change, extremes and volume per symbol."""
    return (
        candles.groupBy("symbol")
        .agg(
            rows().alias("nb_candles"),
            F.min_by("close", "time").alias("_first"),
            F.max_by("close", "time").alias("_last"),
            round_half_up(F.min("low"), 2).alias("min_price"),
            round_half_up(F.max("high"), 2).alias("max_price"),
            round_half_up(F.avg("volume"), 2).alias("avg_volume"),
            round_half_up(F.sum("volume"), 2).alias("total_volume"),
        )
        .select(
            "symbol",
            "nb_candles",
            round_half_up(F.col("_first"), 2).alias("first_price"),
            round_half_up(F.col("_last"), 2).alias("last_price"),
            round_half_up(ratio(F.col("_last") - F.col("_first"), F.col("_first")) * 100, 2).alias(
                "total_change_pct"
            ),
            "min_price",
            "max_price",
            "avg_volume",
            "total_volume",
        )
        .orderBy(F.desc_nulls_first("total_volume"), "symbol")
    )


def collection_summary(candles: DataFrame) -> DataFrame:
    """Per symbol and, with a NULL symbol, over all of them."""
    return candles.rollup("symbol").agg(
        rows().alias("candles"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        F.min("low").alias("min_price"),
        F.max("high").alias("max_price"),
        F.sum("volume").alias("total_volume"),
    )


def collection_report(candles: DataFrame) -> DataFrame:
    """One row: symbols (sorted) and candles that a collection delivered."""
    per_symbol = candles.groupBy("symbol").agg(rows().alias("_n"))
    return per_symbol.agg(
        F.count(F.lit(1)).alias("total_symbols"),
        F.sort_array(F.collect_set("symbol")).alias("symbols"),
        F.sum("_n").alias("total_candles"),
    )


def feature_coverage(features: DataFrame) -> DataFrame:
    return features.groupBy("symbol").agg(
        rows().alias("nb_rows"),
        F.count("sma_7").alias("sma_count"),
        F.count("rsi_14").alias("rsi_count"),
        F.count("macd").alias("macd_count"),
    )


def returns_stats(candles: DataFrame, **layout) -> DataFrame:
    """Mean, exact median, deviation and extremes of percent returns per symbol, to 4 places."""
    returns = returns_pct(candles, **layout).where(F.col("returns_pct").isNotNull())
    aggregates = [fn("returns_pct").alias(n) for n, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    sizes = candles.groupBy("symbol").agg(rows().alias("rows"))
    found = exact_quantiles(returns, ["symbol"], "returns_pct", {"median": 0.5}, sizes, aggregates)
    return found.select(
        "symbol",
        *[round_half_up(F.col(c), 4).alias(c) for c in ("mean", "median", "std", "min", "max")],
    )


def describe(
    df: DataFrame, columns=("open", "high", "low", "close", "volume"), by=("symbol",)
) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per group and column, in long form."""
    long = df.select(
        *by,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v"))
                    for c in columns
                ]
            )
        ).alias("_e"),
    ).select(*by, F.col("_e.k").alias("column"), F.col("_e.v").alias("value"))
    aggregates = [
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    sizes = df.groupBy(*by).agg(rows().alias("rows"))
    return exact_quantiles(long, [*by, "column"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, sizes, aggregates)


def returns_histogram(candles: DataFrame, bins: int = 50, **layout) -> DataFrame:
    """Percent returns counted in equal-width bins over each symbol's own range."""
    returns = returns_pct(candles, **layout).where(F.col("returns_pct").isNotNull())
    edges = returns.groupBy("symbol").agg(
        F.min("returns_pct").alias("_lo"), F.max("returns_pct").alias("_hi")
    )
    symbols = distinct_symbols(candles)
    if symbols.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        edges = F.broadcast(edges)
    place = ratio(F.col("returns_pct") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    bin_no = F.least(F.floor(F.coalesce(place, F.lit(0.0)) * bins), F.lit(bins - 1))
    return (
        returns.join(edges, "symbol")
        .groupBy("symbol", bin_no.cast("int").alias("bin"))
        .agg(rows().alias("count"))
    )


def pivot_close(candles: DataFrame, symbols=None) -> DataFrame:
    """One close column per symbol; two candles for one time and symbol are an error."""
    # Copies are counted in a hash aggregation first, so no pivot cell ever sees more than one row.
    unique = (
        candles.groupBy("time", "symbol")
        .agg(F.max("close").alias("close"), rows().alias("_n"))
        .withColumn(
            "close",
            F.when(F.col("_n") == 1, F.col("close")).otherwise(
                F.raise_error(F.lit("duplicate (time, symbol) in pivot"))
            ),
        )
    )
    return unique.groupBy("time").pivot("symbol", symbols).agg(F.max("close"))


# Symbols of one side and times that a task multiplies at once.
CORRELATION_GROUP = 64
CORRELATION_TIMES = 1024


def returns_correlation(candles: DataFrame, **layout) -> DataFrame:
    """Pearson correlation of returns for every ordered pair of symbols; NULL for a symbol that never moves.

    A symbol without a candle at a time keeps its last close there, so its
    return is zero; times before every symbol has a return, and times at which a
    symbol's return is undefined, are left out. ``candles`` must hold one timeframe.

    Symbols are numbered and taken in groups. A task holds the returns of two groups over a range of times as
    matrices and adds up their products, sums included; Spark adds the partial products of all ranges. Neither
    the grid of times nor any matrix of all symbols is ever formed.
    """
    spark = candles.sparkSession
    group = CORRELATION_GROUP

    def kept(frame, label):
        path = scratch_dir(spark, label)
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    ends = candles.groupBy("symbol").agg(
        F.min("time").alias("begins"), F.min("timeframe").alias("f0"), F.max("timeframe").alias("f1"))
    symbols = kept(ends.withColumn("i", F.row_number().over(W.orderBy("symbol")) - 1), "symbols")
    total = symbols.agg(F.count("*").alias("n"), F.max("begins").alias("t"), F.min("f0").alias("f0"), F.max("f1").alias("f1")).first()
    if total["f0"] != total["f1"]:
        raise ValueError("candles of several timeframes; filter one first")
    groups = max(1, -(-total["n"] // group))
    complete_from = F.lit(total["t"])
    symbols = symbols.select("symbol", "i")
    returns = run(candles, [returns_step()], **layout).where(F.col("time") > complete_from)
    returns = returns.groupBy("time", "symbol", "timeframe").agg(F.max("returns").alias("r"))
    span = seconds_of(F.col("timeframe")).cast("long") * CORRELATION_TIMES
    returns = returns.join(broadcast_if_small(symbols), "symbol").select(
        "time", F.floor(epoch_seconds(F.col("time")) / span).alias("range"), "i", "r")
    returns = kept(returns, "returns")
    undefined = returns.where("r IS NULL OR isnan(r)").select("time").distinct()
    returns = returns.join(undefined, "time", "left_anti")
    own = F.floor(F.col("i") / group).cast("int")
    met = returns.withColumn("g", own).withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    met = met.select("range", F.least("g", "h").alias("a"), F.greatest("g", "h").alias("b"), "i", "time", "r")
    products = met.groupBy("a", "b", "range").applyInArrow(_products(group), "i int, j int, p double")
    products = kept(products.groupBy("i", "j").agg(F.sum("p").alias("p")), "products")
    sums = products.where("j = -1").select("i", F.col("p").alias("s"))
    sums = sums.join(products.where("i = j").select("i", F.col("p").alias("q")), "i")
    n = returns.select("time").distinct().count()
    named = symbols.select("symbol", "i").join(sums, "i", "left").fillna(0.0, ["s", "q"])
    of_a = named.selectExpr("symbol AS symbol_a", "i AS ia", "s AS sa", "q AS qa").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    of_b = named.selectExpr("symbol AS symbol_b", "i AS ib", "s AS sb", "q AS qb").withColumn("g", F.floor(F.col("ib") / group).cast("int"))
    pairs = of_a.join(of_b, "g")
    known = pairs.join(products.where("j >= i"), (F.least("ia", "ib") == F.col("i")) & (F.greatest("ia", "ib") == F.col("j")), "left")
    known = known.withColumns({"p": F.coalesce("p", F.lit(0.0)), "n": F.lit(float(n))})

    def spread(side):
        # What rounding leaves of a flat series' variance is no variance.
        v = F.col("n") * F.col(f"q{side}") - F.col(f"s{side}") * F.col(f"s{side}")
        return F.when(v > F.col("n") * F.col(f"q{side}") * 1e-13, v)

    together = F.col("n") * F.col("p") - F.col("sa") * F.col("sb")
    corr = together / (F.sqrt(spread("a")) * F.sqrt(spread("b")))
    one = F.when(spread("a").isNotNull(), F.lit(1.0))
    return known.select("symbol_a", "symbol_b", F.when(F.col("symbol_a") == F.col("symbol_b"), one).otherwise(corr).alias("corr"))


def _products(group: int):
    """A function of one range of times of two groups of symbols: partial sums of products (i <= j), and sums as j = -1."""

    def partial(key, table):
        a, b = key[0].as_py(), key[1].as_py()
        at = np.unique(table["time"].cast("int64").to_numpy(), return_inverse=True)[1]
        i, r = table["i"].to_numpy(), table["r"].to_numpy()
        m = np.zeros((2 * group, at.max() + 1))
        row = i % group + group * (i // group != a)  # the first group above the second
        m[row, at] = r
        there = np.bincount(row, minlength=2 * group) > 0
        left, right = m[:group], m[group:] if a != b else m[:group]
        keep = np.outer(there[:group], there[group:] if a != b else there[:group])
        if a == b:
            keep = np.triu(keep)
        x, y = np.nonzero(keep)
        out = [(x + a * group, y + b * group, (left @ right.T)[x, y])]
        if a == b:
            x = np.flatnonzero(there[:group])
            out.append((x + a * group, np.full(len(x), -1), left.sum(axis=1)[x]))
        i, j, p = (np.concatenate(c) for c in zip(*out))
        return pa.table({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "p": pa.array(p, pa.float64())})

    return partial


def gaps(candles: DataFrame, **layout) -> DataFrame:
    """Every missing bar between a series' first and last candle; months count by the calendar.

    An unknown timeframe fails the job.
    """
    step = Step(("_before",), ({"_before": f"lag(time) {over_block()}"},), behind=1)
    frame, after = F.col("timeframe"), F.col("_before")
    bars = bars_between(frame, after, F.col("time"))
    missing = run(candles.select("time", *SERIES), [step], **layout).where(after.isNotNull()).where(bars > 0)
    # A long gap is cut into runs of bars before it is expanded.
    run_rows = 10_000
    cut = missing.select(
        *SERIES,
        after.alias("_from"),
        bars.alias("_bars"),
        F.explode(F.sequence(F.lit(0), F.floor((bars - 1) / run_rows))).alias("_run"),
    )
    last = F.least(F.col("_bars"), (F.col("_run") + 1) * run_rows)
    return cut.select(
        *SERIES,
        "_from",
        F.explode(F.sequence(F.col("_run") * run_rows + 1, last)).alias("_k"),
    ).select(*SERIES, later_bar(frame, F.col("_from"), F.col("_k")).alias("time"))


def outliers(candles: DataFrame, sigmas: float = 3.0, **layout) -> DataFrame:
    """Candles whose return lies more than ``sigmas`` deviations from the series mean."""
    returns = run(candles, [returns_step()], **layout).select("time", *SERIES, "close", "returns")
    moments = returns.groupBy(*SERIES).agg(
        F.avg("returns").alias("_mean"), F.stddev_samp("returns").alias("_std")
    )
    series = candles.select(*SERIES).distinct()
    if series.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        moments = F.broadcast(moments)
    return (
        returns.join(moments, list(SERIES))
        .where(F.abs(F.col("returns") - F.col("_mean")) > sigmas * F.col("_std"))
        .drop("_mean", "_std")
    )


def error_metrics(scored: DataFrame, by=("model_name", "symbol"), actual="actual", predicted="predicted"):
    """rmse, mae, mape in percent and r2; rows whose actual value is zero do not enter mape."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    known = scored.where(y.isNotNull() & p.isNotNull())
    return known.groupBy(*by).agg(
        rows().alias("samples"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (F.avg(F.abs(ratio(y - p, y))) * 100).alias("mape"),
        (1 - ratio(F.sum((y - p) * (y - p)), F.var_pop(y) * rows())).alias("r2"),
    )


def directional_accuracy(
    scored: DataFrame,
    by=("model_name", "symbol", "timeframe"),
    time="target_time",
    actual="actual",
    predicted="predicted",
    **layout,
) -> DataFrame:
    """Percent of rows in which the actual and the predicted value moved the same way."""
    by = list(by)
    window = over_block(keys=by)
    before = Step(
        ("_a", "_p"),
        ({"_a": f"lag({actual}) {window}", "_p": f"lag({predicted}) {window}"},),
        behind=1,
    )
    moved = run(scored.where(F.col(actual).isNotNull()), [before], keys=by, time=time, **layout)
    same = F.signum(F.col(actual) - F.col("_a")) == F.signum(F.col(predicted) - F.col("_p"))
    return moved.groupBy(*by).agg(
        F.coalesce(F.avg(same.cast("double")) * 100, F.lit(0.0)).alias("directional_accuracy")
    )


def mape_alerts(metrics: DataFrame, threshold_pct: float = 10.0) -> DataFrame:
    return metrics.where(F.col("mape") > threshold_pct)


def rank_models(metrics: DataFrame, by=("symbol",)) -> DataFrame:
    """Metrics sorted by rmse, with a flag on the best model of each group (a row per model)."""
    place = F.row_number().over(W.partitionBy(*by).orderBy("rmse", "model_name"))
    return metrics.withColumn("is_best", place == 1).orderBy(*by, "rmse", "model_name")
