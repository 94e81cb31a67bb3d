"""Small numeric expressions shared by the operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(a, b)


def round_half_up(x: Column, places: int) -> Column:
    """Round like SQL NUMERIC (half away from zero), back to double."""
    return F.round(x.cast("decimal(38,8)"), places).cast("double")
