"""Bars: ticks to candles, candles to coarser candles, daily statistics.

Every operator is one hash aggregation by (series, bucket) with map-side
partial results; nothing is sorted by series.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeframes import time_bucket


def ticks_to_candles(
    ticks: DataFrame, timeframe="1h", time="time", price="price", size="size", order="id"
) -> DataFrame:
    """Candles of (time, symbol, price, size) ticks; equal times are ordered by ``order``."""
    at = F.struct(time, order)
    return (
        ticks.groupBy("symbol", time_bucket(timeframe, F.col(time)).alias("time"))
        .agg(
            F.min_by(price, at).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, at).alias("close"),
            F.sum(size).alias("volume"),
            F.sum(F.col(price) * F.col(size)).alias("quote_volume"),
            F.count(F.lit(1)).alias("trades_count"),
        )
        .select(
            "time",
            "symbol",
            F.lit(timeframe).alias("timeframe"),
            "open",
            "high",
            "low",
            "close",
            "volume",
            "quote_volume",
            "trades_count",
        )
    )


def resample(candles: DataFrame, timeframe: str) -> DataFrame:
    """Candles of one timeframe merged into a coarser one (the source timeframe is dropped)."""
    return (
        candles.groupBy("symbol", time_bucket(timeframe, F.col("time")).alias("bucket"))
        .agg(
            F.min_by("open", "time").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "time").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("quote_volume").alias("quote_volume"),
            F.sum("trades_count").alias("trades_count"),
        )
        .select(
            F.col("bucket").alias("time"),
            "symbol",
            F.lit(timeframe).alias("timeframe"),
            "open",
            "high",
            "low",
            "close",
            "volume",
            "quote_volume",
            "trades_count",
        )
    )


def _day_columns():
    return [
        F.min_by("open", "time").alias("day_open"),
        F.max("high").alias("day_high"),
        F.min("low").alias("day_low"),
        F.max_by("close", "time").alias("day_close"),
        F.sum("volume").alias("day_volume"),
    ]


def daily_stats(candles: DataFrame) -> DataFrame:
    """First open, extremes, last close, volume and candle count by day and series."""
    return candles.groupBy(
        time_bucket("1d", F.col("time")).alias("day"), "symbol", "timeframe"
    ).agg(*_day_columns(), F.count(F.lit(1)).alias("candles_count"))


def daily_latest(candles: DataFrame, rows: int = 50) -> DataFrame:
    """The newest days over all timeframes, at most ``rows`` of them."""
    days = candles.groupBy(time_bucket("1d", F.col("time")).alias("day"), "symbol").agg(
        *_day_columns()
    )
    return days.orderBy(F.desc("day"), "symbol").limit(rows)


def partial_bars(candles: DataFrame) -> DataFrame:
    """Daily bars that can be merged: opening and closing price with their times, extremes and sums."""
    return candles.groupBy(time_bucket("1d", F.col("time")).alias("time_"), "symbol", "timeframe").agg(
        F.min("time").alias("open_time"), F.max("time").alias("close_time"), *_day_columns(), F.count(F.lit(1)).alias("candles_count")
    ).withColumnRenamed("time_", "time")


def merged_bars(bars: DataFrame) -> DataFrame:
    """One bar per day and series from several partial ones of disjoint candles."""
    return bars.groupBy("time", "symbol", "timeframe").agg(
        F.min("open_time").alias("open_time"),
        F.max("close_time").alias("close_time"),
        F.min_by("day_open", "open_time").alias("day_open"),
        F.max("day_high").alias("day_high"),
        F.min("day_low").alias("day_low"),
        F.max_by("day_close", "close_time").alias("day_close"),
        F.sum("day_volume").alias("day_volume"),
        F.sum("candles_count").alias("candles_count"),
    )


def finished_bars(bars: DataFrame) -> DataFrame:
    """The columns of :func:`daily_stats` from merged bars."""
    values = ["day_open", "day_high", "day_low", "day_close", "day_volume", "candles_count"]
    return bars.select(F.col("time").alias("day"), "symbol", "timeframe", *values)
