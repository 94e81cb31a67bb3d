"""Latest, as-of and 24-hour lookups, tickers and top lists."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio, round_half_up
from tidemark.operators.series import with_position
from tidemark.schemas import SERIES
from tidemark.session import broadcast_if_small


def newest_time(candles: DataFrame):
    """The newest candle time as a scalar subquery: the default ``as_of``."""
    return candles.agg(F.max("time")).scalar()


def scan(candles: DataFrame, timeframe: str = "1h", symbol: str | None = None) -> DataFrame:
    """Candles of one timeframe, optionally of one symbol, by symbol and time."""
    picked = candles.where(F.col("timeframe") == timeframe)
    if symbol is not None:
        picked = picked.where(F.col("symbol") == symbol)
    return picked.select(
        "time", "symbol", "open", "high", "low", "close", "volume", "timeframe"
    ).orderBy("symbol", "time")


def scan_limit(candles: DataFrame, symbol: str | None = None, limit: int | None = None) -> DataFrame:
    """Candles by time, with symbol and timeframe as tie-breaks, optionally the first ``limit``."""
    picked = candles if symbol is None else candles.where(F.col("symbol") == symbol)
    picked = picked.orderBy("time", "symbol", "timeframe")
    return picked if limit is None else picked.limit(limit)


def latest_prices(candles: DataFrame) -> DataFrame:
    """Newest candle of each series."""
    return candles.groupBy("symbol", "timeframe").agg(
        F.max("time").alias("time"),
        F.max_by("close", "time").alias("price"),
        F.max_by("volume", "time").alias("volume"),
    )


def _newest_close(candles: DataFrame) -> DataFrame:
    # Per series in a hash aggregation, then over the few timeframes of a symbol.
    series = candles.groupBy("symbol", "timeframe").agg(
        F.max("time").alias("_t"), F.max_by("close", "time").alias("_close")
    )
    newest = F.struct("_t", "timeframe")
    return series.groupBy("symbol").agg(
        F.max("_t").alias("time"), F.max_by("_close", newest).alias("close")
    )


def asof_price(candles: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """Last close of each symbol at or before ``as_of`` minus ``hours``."""
    as_of = newest_time(candles) if as_of is None else as_of
    old = candles.where(F.col("time") <= as_of - F.make_dt_interval(hours=F.lit(hours)))
    return _newest_close(old).select("symbol", "time", F.col("close").alias("price_ago"))


def asof_many(candles: DataFrame, requests: DataFrame, at: str = "at", value: str = "close", **layout) -> DataFrame:
    """Every request (symbol, timeframe, ``at``, ...) with the last known ``value`` of its series at or before that time, and its time.

    Requests and candles are laid out together by time chunks, and the last known value is carried along, over
    chunks too; no series is one task. NULL where nothing is known yet. Equal requests are looked up once; requests
    without a series or time find nothing.
    """
    known = F.col(value).isNotNull()
    if candles.schema[value].dataType.typeName() in ("double", "float"):
        known &= ~F.isnan(value)
    moments = requests.select(*SERIES, F.col(at).alias("_t")).distinct()
    given = candles.where(known).select(*SERIES, F.col("time").alias("_t"), F.col(value).alias("_v"), F.col("time").alias("_vt"), F.lit(0).alias("_ask"))
    rows = given.unionByName(moments.withColumn("_ask", F.lit(1)), allowMissingColumns=True)
    carries = {"_value": "_v", "_value_time": "_vt"}
    placed = with_position(rows, SERIES, "_t", carries=carries, then=("_ask",), **layout)
    found = placed.where("_ask = 1").select(*SERIES, F.col("_t").alias(at), F.col("_value").alias(f"{value}_then"), F.col("_value_time").alias(f"{value}_time"))
    return requests.join(found, [*SERIES, at], "left")


def performance_24h(candles: DataFrame, as_of=None) -> DataFrame:
    """Current price, price 24 hours before ``as_of`` and the change in percent, in one aggregation.

    Without ``as_of`` the newest time is looked up first, from the time column alone.
    """
    if as_of is None:
        as_of = F.lit(candles.agg(F.max("time")).first()[0]).cast(candles.schema["time"].dataType)
    old = F.when(F.col("time") <= as_of - F.make_dt_interval(hours=F.lit(24)), F.col("time"))
    series = candles.groupBy("symbol", "timeframe").agg(
        F.max("time").alias("_t"), F.max_by("close", "time").alias("_now"), F.max(old).alias("_old"), F.max_by("close", old).alias("_ago"))
    both = series.groupBy("symbol").agg(
        F.max_by("_now", F.struct("_t", "timeframe")).alias("_now"),
        F.max_by("_ago", F.when(F.col("_old").isNotNull(), F.struct("_old", "timeframe"))).alias("_ago"), F.max("_old").alias("_old"))
    change = ratio(F.col("_now") - F.col("_ago"), F.col("_ago")) * 100
    return (
        both.where("_old IS NOT NULL")
        .select(
            "symbol",
            round_half_up(F.col("_now"), 2).alias("current_price"),
            round_half_up(F.col("_ago"), 2).alias("price_24h_ago"),
            round_half_up(change, 2).alias("change_24h_pct"),
        )
        .orderBy(F.desc_nulls_first("change_24h_pct"), "symbol")
    )


def tickers(candles: DataFrame, as_of=None) -> DataFrame:
    """Rolling 24-hour ticker per symbol: last, quote volume, change, extremes, time."""
    as_of = newest_time(candles) if as_of is None else as_of
    day = candles.where(
        (F.col("time") > as_of - F.make_dt_interval(hours=F.lit(24))) & (F.col("time") <= as_of)
    )
    opening, last = F.min_by("open", "time"), F.max_by("close", "time")

    def optional(name):
        if name in candles.columns:
            return F.max_by(name, "time").alias(name)
        return F.lit(None).cast("double").alias(name)

    return day.groupBy("symbol").agg(
        last.alias("last_price"),
        F.sum("quote_volume").alias("volume_24h"),
        (ratio(last - opening, opening) * 100).alias("change_24h_pct"),
        F.max("high").alias("high_24h"),
        F.min("low").alias("low_24h"),
        optional("bid"),
        optional("ask"),
        F.max("time").alias("timestamp"),
    )


def market_summary(candles: DataFrame, symbols=None, as_of=None) -> DataFrame:
    picked = candles if symbols is None else candles.where(F.col("symbol").isin(*symbols))
    return tickers(picked, as_of).orderBy(F.desc_nulls_last("volume_24h"), "symbol")


def available_symbols(ticker: DataFrame, quote="USDT", min_volume_24h: float = 1e6) -> DataFrame:
    """Symbols whose name holds ``quote`` and that trade at least the minimum, largest first."""
    volume = F.col("volume_24h")
    return (
        ticker.where(
            F.col("symbol").contains(quote) & (volume >= min_volume_24h) & (volume != 0)
        )
        .select("symbol", "volume_24h")
        .orderBy(F.desc("volume_24h"), "symbol")
    )


def top_symbols(ticker: DataFrame, top_n=20, quote="USDT", min_volume_24h: float = 1e6) -> DataFrame:
    return available_symbols(ticker, quote, min_volume_24h).limit(top_n)


def score_predictions(predictions: DataFrame, candles: DataFrame) -> DataFrame:
    """Actual price at the target time and the errors, NULL while it is not known."""
    actual = candles.select(
        "symbol",
        "timeframe",
        F.col("time").alias("target_time"),
        F.col("close").alias("actual_price"),
    )
    error = F.abs(F.col("actual_price") - F.col("predicted_price"))
    return predictions.join(actual, ["symbol", "timeframe", "target_time"], "left").withColumns(
        {
            "absolute_error": error,
            "percentage_error": ratio(error, F.col("actual_price")) * 100,
        }
    )


def join_features(features: DataFrame, candles: DataFrame) -> DataFrame:
    """Stored features next to the close of their candle."""
    close = candles.select("time", "symbol", "timeframe", "close")
    return features.join(close, ["time", "symbol", "timeframe"])


def known_symbols(frame: DataFrame, metadata: DataFrame) -> DataFrame:
    return frame.join(broadcast_if_small(metadata.select("symbol")), "symbol", "left_semi")


def unknown_symbols(frame: DataFrame, metadata: DataFrame) -> DataFrame:
    return frame.join(broadcast_if_small(metadata.select("symbol")), "symbol", "left_anti")
