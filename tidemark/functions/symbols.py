"""Trading-pair names."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_currency(symbol: Column) -> Column:
    return F.split_part(symbol, F.lit("/"), F.lit(1))


def quote_currency(symbol: Column, default: str = "USDT") -> Column:
    return F.when(symbol.contains("/"), F.split_part(symbol, F.lit("/"), F.lit(2))).otherwise(default)


def safe_name(symbol: Column) -> Column:
    return F.replace(symbol, F.lit("/"), F.lit("_"))
