"""Keyed table maintenance without a table format: the new content is a plan over the old one.

Write the result to a new path (or overwrite only the affected day partitions);
never overwrite a path that the plan still reads.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.symbols import base_currency, quote_currency
from tidemark.schemas import CANDLE_KEY, SEED_SYMBOLS, SERIES
from tidemark.session import broadcast_if_small


def first_per_key(df: DataFrame, keys, order: str) -> DataFrame:
    """The row with the smallest ``order`` of each key.

    ``order`` must be unique within a key. One aggregation: copies collapse on
    the map side, so a key that fills a third of the table is no hot task.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    return (
        df.groupBy(*keys)
        .agg(*[F.min_by(c, order).alias(c) for c in rest], F.min(order).alias(order))
        .select(*df.columns)
    )


def last_per_key(df: DataFrame, keys, order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c != order]
    return (
        df.groupBy(*keys)
        .agg(*[F.max_by(c, order).alias(c) for c in rest], F.max(order).alias(order))
        .select(*df.columns)
    )


def one_per_key(df: DataFrame, keys, order=None, last: bool = False) -> DataFrame:
    """One row per key: the first or last by ``order``, else by all other columns from left to right.

    ``order`` is dropped. Either way the choice is deterministic and made in one aggregation.
    """
    if order is not None:
        return (last_per_key if last else first_per_key)(df, keys, order).drop(order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    whole = (F.max if last else F.min)(F.struct(*rest)).alias("_row")
    return df.groupBy(*keys).agg(whole).select(*[c if c in keys else f"_row.{c}" for c in df.columns])


def insert_ignore(existing: DataFrame, incoming: DataFrame, keys=CANDLE_KEY, order=None) -> DataFrame:
    """Stored rows win over incoming ones; of incoming copies one is taken, the first by ``order`` (see one_per_key)."""
    fresh = one_per_key(incoming, keys, order)
    fresh = fresh.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys=CANDLE_KEY,
    keep=("created_at",),
    order=None,
    touch: dict | None = None,
) -> DataFrame:
    """Incoming rows replace stored ones of the same key, whole rows at a time.

    Columns in ``keep`` (and columns that do not arrive) hold the stored value
    where there is one. ``touch`` sets columns of replaced rows, such as
    ``updated_at``. Of incoming copies one is taken, the last by ``order`` (see one_per_key).
    """
    incoming = one_per_key(incoming, keys, order, last=True)
    touch = touch or {}
    old = existing.withColumn("_old", F.lit(True)).alias("o")
    new = incoming.withColumn("_new", F.lit(True)).alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    columns = []
    for c in existing.columns:
        if c in keys:
            value = F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}"))
        elif c in incoming.columns and c not in keep:
            value = F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        elif c in incoming.columns:
            value = F.when(F.col("o._old"), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))
        else:
            value = F.col(f"o.{c}")
        if c in touch:
            value = F.when(F.col("o._old") & F.col("n._new"), touch[c]).otherwise(value)
        columns.append(value.alias(c))
    return old.join(new, on, "full_outer").select(*columns)


def seed_metadata(spark) -> DataFrame:
    """The symbols a new metadata table starts with."""
    rows = spark.createDataFrame([list(r) for r in SEED_SYMBOLS], "symbol string, name string")
    return rows.withColumns(
        {
            "base_currency": base_currency(F.col("symbol")),
            "quote_currency": quote_currency(F.col("symbol")),
            "exchange": F.lit("binance"),
            "is_active": F.lit(True),
        }
    )


def ensure_symbols(metadata: DataFrame, candles: DataFrame) -> DataFrame:
    """Metadata plus a default row for every symbol it does not hold yet."""
    symbol = F.col("symbol")
    new = (
        candles.select("symbol")
        .distinct()
        .join(metadata.select("symbol"), "symbol", "left_anti")
        .select(
            "symbol",
            base_currency(symbol).alias("base_currency"),
            quote_currency(symbol).alias("quote_currency"),
            F.lit("binance").alias("exchange"),
            F.lit(True).alias("is_active"),
        )
    )
    return metadata.unionByName(new, allowMissingColumns=True)


def retain(df: DataFrame, as_of, months: int, time: str = "time") -> DataFrame:
    """Rows not older than ``months`` before ``as_of``: candles 12, predictions 6, signals 3."""
    return df.where(F.col(time) >= as_of - F.make_ym_interval(months=F.lit(months)))


def cascade_delete(child: DataFrame, deleted: DataFrame) -> DataFrame:
    """Rows of a child table whose symbol was not deleted."""
    return child.join(broadcast_if_small(deleted.select("symbol")), "symbol", "left_anti")


def typed_candles(raw: DataFrame, timeframe: str = "1h") -> DataFrame:
    """Prices as double; absent or NULL quote volume and trade count become 0."""
    have = set(raw.columns)

    def default(name, kind):
        value = F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind)) if name in have else F.lit(0).cast(kind)
        return value.alias(name)

    frame = F.coalesce(F.col("timeframe"), F.lit(timeframe)) if "timeframe" in have else F.lit(timeframe)
    return raw.select(
        "time",
        "symbol",
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
        default("quote_volume", "double"),
        default("trades_count", "int"),
        frame.alias("timeframe"),
    )


def normalize_candles(raw: DataFrame, order: str) -> DataFrame:
    """Raw [epoch ms, open, high, low, close, volume] rows per series: first of equal times, typed time."""
    keyed = first_per_key(raw, ["ms", *SERIES], order).drop(order)
    return keyed.select(
        F.timestamp_millis("ms").alias("timestamp"), *[c for c in keyed.columns if c != "ms"]
    )
