"""Market inputs derived from the generic event and order tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.symbols import base_currency, quote_currency
from tidemark.functions.timeframes import plus_seconds, time_bucket
from tidemark.operators.bars import resample, ticks_to_candles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_ticks(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").alias("time"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("size"),
        F.col("event_id").alias("id"),
    )


def ticks(spark, sf_dir) -> DataFrame:
    return as_ticks(table(spark, sf_dir, "events"))


def candles(spark, sf_dir) -> DataFrame:
    """Hourly candles of the event values."""
    return ticks_to_candles(ticks(spark, sf_dir), "1h")


def candles_two_frames(spark, sf_dir) -> DataFrame:
    """Hourly and daily candles in one table."""
    hourly = candles(spark, sf_dir)
    return hourly.unionByName(resample(hourly, "1d"))


def order_candles(spark, sf_dir) -> DataFrame:
    """Daily candles of order totals by priority: a longer series."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("time"),
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_totalprice").alias("price"),
        F.lit(1.0).alias("size"),
        F.col("o_orderkey").alias("id"),
    )
    return ticks_to_candles(orders, "1d")


def line_candles(spark, sf_dir) -> DataFrame:
    """Order lines as one-minute candles: one long series with about two thirds of all rows and some short ones."""
    price, long = F.col("l_extendedprice").cast("double"), F.col("l_orderkey") % 3 < 2
    return table(spark, sf_dir, "lineitem").select(
        F.timestamp_seconds(F.col("l_orderkey") * 600 + F.col("l_linenumber") * 60).cast("timestamp_ntz").alias("time"),
        F.when(long, F.lit("all")).otherwise(F.concat("l_returnflag", "l_linestatus")).alias("symbol"),
        F.lit("1m").alias("timeframe"),
        *[price.alias(c) for c in ("open", "high", "low", "close")],
        F.col("l_quantity").cast("double").alias("volume"),
    )


def metadata(spark, sf_dir) -> DataFrame:
    """Known symbols; the event type ``error`` is left out and serves as an orphan."""
    symbol = F.col("event_type")
    return (
        table(spark, sf_dir, "events")
        .where(symbol != "error")
        .select(
            symbol.alias("symbol"),
            base_currency(symbol).alias("base_currency"),
            quote_currency(symbol).alias("quote_currency"),
        )
        .distinct()
        .withColumns({"exchange": F.lit("binance"), "is_active": F.lit(True)})
    )


def dirty_candles(spark, sf_dir) -> DataFrame:
    """Candles with inverted prices at 3h, negative volume at 5h and one day written twice."""
    hour = F.hour("time")
    broken = candles(spark, sf_dir).withColumns(
        {
            "high": F.when(hour == 3, F.col("low") - 1).otherwise(F.col("high")),
            "volume": F.when(hour == 5, -F.col("volume")).otherwise(F.col("volume")),
        }
    )
    twice = broken.where(
        (F.col("time") >= F.lit("2024-01-10").cast("timestamp_ntz"))
        & (F.col("time") < F.lit("2024-01-11").cast("timestamp_ntz"))
    )
    return broken.unionByName(twice)


def existing_and_incoming(spark, sf_dir):
    """A stored part and a later delivery that overlaps it with other closes."""
    base = candles(spark, sf_dir)
    stored = base.where(F.col("time") < F.lit("2024-01-20").cast("timestamp_ntz"))
    arriving = base.where(
        F.col("time") >= F.lit("2024-01-15").cast("timestamp_ntz")
    ).withColumn("close", F.col("close") * 1.01)
    return stored, arriving


def signals(spark, sf_dir) -> DataFrame:
    """One signal per candle whose type cycles through the hours; BAD is not a valid type."""
    kind = (
        F.when(F.hour("time") % 4 == 0, "BUY")
        .when(F.hour("time") % 4 == 1, "SELL")
        .when(F.hour("time") % 4 == 2, "HOLD")
        .otherwise("BAD")
    )
    return candles(spark, sf_dir).select(
        "time",
        "symbol",
        kind.alias("signal_type"),
        F.col("close").alias("price"),
        F.lit("active").alias("status"),
    )


def naive_predictions(spark, sf_dir) -> DataFrame:
    """Two one-hour forecasts per candle: the close, and the mean of the hour's high and low."""
    made = candles(spark, sf_dir)
    target = plus_seconds(F.col("time"), F.lit(3600))
    columns = ["symbol", "timeframe", F.col("time").alias("prediction_time"), target.alias("target_time")]

    def model(name, price):
        return made.select(
            F.lit(name).alias("model_name"), *columns, price.alias("predicted_price")
        )

    return model("last_close", F.col("close")).unionByName(
        model("midrange", (F.col("high") + F.col("low")) / 2)
    )
