"""Timeframe arithmetic and calendar columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bar length in seconds of each timeframe name (1M has no fixed length; 30 days serve for sizing).
TIMEFRAME_SECONDS = {
    "1m": 60,
    "5m": 300,
    "15m": 900,
    "30m": 1800,
    "1h": 3600,
    "4h": 14400,
    "1d": 86400,
    "1w": 604800,
    "1M": 2592000,
}


def seconds_of(timeframe: Column) -> Column:
    """Bar length in seconds of a timeframe column; unknown names count as one minute."""
    expr = F.lit(60)
    for name, secs in TIMEFRAME_SECONDS.items():
        expr = F.when(timeframe == name, secs).otherwise(expr)
    return expr


def known_timeframe(timeframe: Column) -> Column:
    """The name itself; an unknown one fails the job."""
    message = F.concat(F.lit("unknown timeframe "), F.coalesce(timeframe, F.lit("NULL")))
    return F.when(timeframe.isin(*TIMEFRAME_SECONDS), timeframe).otherwise(F.raise_error(message))


def bars_between(timeframe: Column, start: Column, end: Column) -> Column:
    """Bars that begin after ``start`` and before ``end``; months by the calendar, other bars by their length."""
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start) - 1
    seconds = F.ceil((epoch_seconds(end) - epoch_seconds(start)) / seconds_of(timeframe)) - 1
    return F.when(known_timeframe(timeframe) == "1M", months.cast("bigint")).otherwise(seconds)


def later_bar(timeframe: Column, start: Column, bars: Column) -> Column:
    """Start of the bar that lies ``bars`` bars after the one at ``start``."""
    month = F.add_months(F.trunc(start, "month"), bars.cast("int")).cast("timestamp_ntz")
    return F.when(timeframe == "1M", month).otherwise(plus_seconds(start, bars * seconds_of(timeframe)).cast("timestamp_ntz"))


def epoch_seconds(time: Column) -> Column:
    return F.unix_seconds(time.cast("timestamp"))


def time_bucket(timeframe: str, time: Column) -> Column:
    """Start of the bar that holds ``time``; weeks start on Monday.

    The result keeps no time zone, so it joins and prints the same everywhere.
    """
    if timeframe == "1w":
        return F.date_trunc("week", time).cast("timestamp_ntz")
    if timeframe == "1M":
        return F.date_trunc("month", time).cast("timestamp_ntz")
    if timeframe == "1d":
        return F.date_trunc("day", time).cast("timestamp_ntz")
    secs = TIMEFRAME_SECONDS[timeframe]
    start = F.floor(epoch_seconds(time) / secs) * secs
    return F.timestamp_seconds(start).cast("timestamp_ntz")


def plus_seconds(time: Column, seconds: Column) -> Column:
    return time + F.make_dt_interval(secs=seconds)


def calendar_sql(time: str) -> dict:
    """Date parts (Monday is 0), their sine/cosine pairs and the weekend flag, as SQL expressions."""
    hour, dow, month = f"hour({time})", f"weekday({time})", f"month({time})"

    def wave(fn, part, period):
        return f"{fn}(2 * pi() * {part} / {period})"

    return {
        "hour": hour,
        "day_of_week": dow,
        "day_of_month": f"dayofmonth({time})",
        "month": month,
        "quarter": f"quarter({time})",
        "year": f"year({time})",
        "hour_sin": wave("sin", hour, 24),
        "hour_cos": wave("cos", hour, 24),
        "day_sin": wave("sin", dow, 7),
        "day_cos": wave("cos", dow, 7),
        "month_sin": wave("sin", month, 12),
        "month_cos": wave("cos", month, 12),
        "is_weekend": f"CAST({dow} IN (5, 6) AS INT)",
    }


def calendar_columns(time: str) -> dict:
    return {name: F.expr(sql) for name, sql in calendar_sql(time).items()}
