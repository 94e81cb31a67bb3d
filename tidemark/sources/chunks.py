"""Stored tables in day chunks, maintained chunk by chunk: what a change does not touch keeps its files.

A chunk cannot be overwritten while it is read, so new content is staged under the shared scratch folder first. Every
function may be repeated after a failure and gives the same table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import merged_bars, partial_bars
from tidemark.operators.tables import one_per_key, upsert
from tidemark.schemas import CANDLE_KEY
from tidemark.session import broadcast_if_small, scratch_dir
from tidemark.sources.candles import with_chunk, write_by_day

DAY_LIMIT = 10_000


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def remove_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def chunk_folders(spark: SparkSession, target: str) -> dict:
    """{first day as text: folder} of a chunked table; rows without a time are under None."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    found = {}
    for status in hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hadoop):
        name = status.getPath().getName()
        if name.startswith("day="):
            day = name.removeprefix("day=")
            found[None if day.startswith("__") else day] = status.getPath().toString()
    return found


def only_days(table: DataFrame, days: DataFrame) -> DataFrame:
    """The day folders that occur in ``days``: named one by one while they are few, else joined."""
    found = days.limit(DAY_LIMIT + 1).collect()
    if len(found) <= DAY_LIMIT:
        return table.where(F.col("day").isin([r["day"] for r in found]))
    return table.join(days, "day", "left_semi")


def merge_chunks(target: str, delivery: DataFrame, keys=CANDLE_KEY, time: str = "time", merge=upsert, days: int = 1, first=None) -> None:
    """Merge a delivery into the chunks of ``days`` days that it touches; no other chunk is read or written.

    ``merge(stored, delivery, keys)`` is :func:`upsert`, or ``insert_ignore`` to let stored rows win; copies in a
    delivery count once. ``first(delivery, keys)`` makes the content of a table that does not exist yet.
    """
    spark = delivery.sparkSession
    stage = scratch_dir(spark, "merge")
    with_chunk(delivery, time, days).write.parquet(f"{stage}/delivery")
    fresh = spark.read.parquet(f"{stage}/delivery")
    if exists(spark, target):
        old = only_days(spark.read.parquet(target), fresh.select("day").distinct())
        merged = merge(old.drop("day"), fresh.drop("day"), keys)
    elif first:
        merged = first(fresh.drop("day"), keys)
    else:
        merged = one_per_key(fresh.drop("day"), keys, last=merge is upsert)
    merged.write.parquet(f"{stage}/merged")
    write_by_day(spark.read.parquet(f"{stage}/merged"), target, time, days)
    remove_folder(spark, stage)


def _rewrite(target: str, kept: DataFrame, days: list, time: str, chunk_days: int) -> None:
    """Put ``kept`` in the place of the chunks ``days`` (texts); chunks without rows left go."""
    spark = kept.sparkSession
    stage = scratch_dir(spark, "rewrite")
    kept.drop("day").write.parquet(stage)
    staged = spark.read.parquet(stage)
    write_by_day(staged, target, time, chunk_days)
    left = {str(r["day"]) for r in with_chunk(staged, time, chunk_days).select("day").distinct().collect()}
    folders = chunk_folders(spark, target)
    for day in set(days) - left:
        if day in folders:
            remove_folder(spark, folders[day])
    remove_folder(spark, stage)


def drop_older(spark: SparkSession, target: str, as_of, months: int, time: str = "time", days: int = 1) -> None:
    """Retention of a stored table: chunks wholly before ``as_of`` minus ``months`` go as folders, only the border is rewritten.

    Rows without a time go too, as in :func:`tidemark.operators.tables.retain`.
    """
    cut = (as_of - F.make_ym_interval(months=F.lit(months))).cast("timestamp_ntz")
    row = with_chunk(spark.range(1).select(cut.alias("cut")), "cut", days).first()
    border = str(row["day"])
    folders = chunk_folders(spark, target)
    if border in folders:
        kept = spark.read.parquet(target).where(F.col("day") == F.lit(border).cast("date"))
        kept = kept.where(F.col(time).cast("timestamp_ntz") >= F.lit(row["cut"]).cast("timestamp_ntz"))
        _rewrite(target, kept, [border], time, days)
    for day, folder in folders.items():
        if day is None or day < border:
            remove_folder(spark, folder)


def drop_symbols(target: str, deleted: DataFrame, time: str = "time", days: int = 1) -> None:
    """Cascade of a deletion into a stored table: only chunks that hold a deleted symbol are rewritten."""
    spark = deleted.sparkSession
    gone = broadcast_if_small(deleted.select("symbol").distinct())
    table = spark.read.parquet(target)
    touched = table.join(gone, "symbol", "left_semi").select("day").distinct().collect()
    if touched:
        some = table.where(F.col("day").isin([r["day"] for r in touched]))
        _rewrite(target, some.join(gone, "symbol", "left_anti"), [str(r["day"]) for r in touched], time, days)


def refresh_bars(target: str, candles: DataFrame, days: int = 1) -> None:
    """Merge new candles into stored daily bars (see ``partial_bars``); bars of other days are not read.

    A candle must be delivered once: bars are sums of their candles.
    """
    merge_chunks(target, partial_bars(candles), keys=("time", "symbol", "timeframe"), days=days,
                 merge=lambda old, new, keys: merged_bars(old.unionByName(new)), first=lambda new, keys: new)
