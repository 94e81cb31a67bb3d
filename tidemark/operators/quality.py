"""Constraints as data-quality operators: keep the valid rows, set the others aside with reasons."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import SIGNAL_STATUSES, SIGNAL_TYPES


def price_rule():
    o, h, lo, c = (F.col(n) for n in ("open", "high", "low", "close"))
    return (h >= lo) & (h >= o) & (h >= c) & (lo <= o) & (lo <= c)


def volume_rule():
    return F.col("volume") >= 0


def not_null_rule(*columns):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def signal_type_rule():
    return F.col("signal_type").isin(*SIGNAL_TYPES)


def signal_status_rule():
    return F.col("status").isin(*SIGNAL_STATUSES)


CANDLE_COLUMNS = ("time", "symbol", "timeframe", "open", "high", "low", "close", "volume")


def candle_rules() -> dict:
    return {
        "not_null": not_null_rule(*CANDLE_COLUMNS),
        "check_prices": price_rule(),
        "check_volume": volume_rule(),
    }


def signal_rules() -> dict:
    return {
        "not_null": not_null_rule("time", "symbol", "signal_type", "price"),
        "signal_type": signal_type_rule(),
        "status": signal_status_rule(),
    }


def with_reasons(df: DataFrame, rules: dict) -> DataFrame:
    """Add ``reasons``, the names of the violated rules. As in SQL, NULL passes a check."""
    broken = [F.when(~F.coalesce(p, F.lit(True)), F.lit(n)) for n, p in rules.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: dict, mode: str = "split"):
    """(valid rows, rejected rows with reasons); ``mode="fail"`` raises at the first rejected row."""
    if mode not in ("split", "fail"):
        raise ValueError(f"unknown mode {mode!r}")
    marked = with_reasons(df, rules)
    rejected = marked.where(F.size("reasons") > 0)
    passes = F.size("reasons") == 0
    if mode == "fail":
        message = F.concat(F.lit("constraint violated: "), F.array_join("reasons", ", "))
        passes = F.when(passes, True).otherwise(F.raise_error(message).cast("boolean"))
    return marked.where(passes).drop("reasons"), rejected


def violations(df: DataFrame, rule) -> DataFrame:
    return df.where(~F.coalesce(rule, F.lit(True)))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once; copies are merged on the map side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def null_share_filter(df: DataFrame, columns) -> DataFrame:
    """Keep rows in which fewer than half of ``columns`` are NULL."""
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in columns])
    return df.where(nulls < len(columns) / 2)


def nan_to_null(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})
