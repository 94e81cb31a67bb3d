"""The incremental jobs as Structured Streaming; each equals its batch twin on the same closed input."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bars import finished_bars, merged_bars, partial_bars
from tidemark.operators.indicators import moved_rsi, moves
from tidemark.operators.series import (
    Step,
    ema,
    ema_reach,
    over_block,
    run,
    twice_averaged,
)
from tidemark.operators.tables import upsert
from tidemark.schemas import CANDLE_KEY, SERIES
from tidemark.session import broadcast_if_small, scratch_dir
from tidemark.sources.chunks import exists, merge_chunks, remove_folder


def read_stream(spark: SparkSession, folder: str, schema, glob="*.parquet", files_per_batch=None):
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def ingest(candles: DataFrame, keys=CANDLE_KEY, delay: str = "1 day") -> DataFrame:
    """Candles without copies that arrive within ``delay``; older copies meet the insert-ignore of the table."""
    return candles.withWatermark("time", delay).dropDuplicatesWithinWatermark(list(keys))


def daily_bars(candles: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Daily bars, final when the watermark has passed the end of the day; later rows are dropped.

    In append mode a bar is emitted then; in update mode (:func:`run_updates`) an open day is delivered too.
    """
    return (
        candles.withWatermark("time", delay)
        .groupBy(F.window("time", "1 day"), *SERIES)
        .agg(
            F.min_by("open", "time").alias("day_open"),
            F.max("high").alias("day_high"),
            F.min("low").alias("day_low"),
            F.max_by("close", "time").alias("day_close"),
            F.sum("volume").alias("day_volume"),
            F.count(F.lit(1)).alias("candles_count"),
        )
        .select(F.col("window.start").alias("day"), *SERIES, "day_open", "day_high", "day_low",
                "day_close", "day_volume", "candles_count")
    )


def latest(candles: DataFrame) -> DataFrame:
    """Newest candle of each series, for update mode: the state is one row per series."""
    return candles.groupBy(*SERIES).agg(
        F.max("time").alias("time"),
        F.max_by("close", "time").alias("price"),
        F.max_by("volume", "time").alias("volume"),
    )


def known_only(candles: DataFrame, metadata: DataFrame) -> DataFrame:
    return candles.join(broadcast_if_small(metadata.select("symbol")), "symbol", "left_semi")


_HELD = ("ema_7", "ema_25", "ema_99", "ema_9", "ema_12", "ema_26", "gain", "loss")
_SEEDS = ("time", "close", *_HELD, "rsi_14")
_RESULTS = ("ema_7", "ema_25", "ema_99", "rsi_14", "macd", "macd_signal", "macd_histogram")


def _seeded_averages() -> Step:
    """EMA, RSI and MACD of a batch that go on from the ``_was_`` columns of the series."""
    before = f"coalesce(lag(close) {over_block()}, _was_close)"
    averages = ema(
        {
            **{n: ("close", int(n.split("_")[1])) for n in _HELD if n.startswith("ema_")},
            "gain": ("_gain", 14),
            "loss": ("_loss", 14),
        },
        seeds={n: f"_was_{n}" for n in _HELD},
    )
    of_fast = twice_averaged("ema_12", "ema_9", 12, 9)
    of_slow = twice_averaged("ema_26", "ema_9", 26, 9)
    return Step(
        (*_HELD, *[n for n in _RESULTS if n not in _HELD]),
        (
            {"_delta": f"close - {before}"},
            {**moves("_delta", "_gain", "_loss"), **averages[0]},
            *averages[1:],
            {
                "_rsi": moved_rsi("gain", "loss", "_delta"),
                "macd": "ema_12 - ema_26",
                "macd_signal": f"{of_fast} - {of_slow}",
            },
            {"macd_histogram": "macd - macd_signal"},
        ),
        behind=max(ema_reach(14) + 1, ema_reach(99)),
        holds={"rsi_14": ("_rsi", "_was_rsi_14")},
    )


def averages_by_batch(folder: str, **layout):
    """A ``foreachBatch`` function: EMA, RSI and MACD of each batch, under ``folder/out``.

    The same results as one pass over all rows, without a task per series: a
    batch is laid out in blocks like a table and goes on from the last values of
    each series, one row per series under ``folder/state``. Both are written
    per batch, so a repeated batch replaces its own output. Rows that are not newer than the
    state of their series, or without a close, are set aside under ``folder/late``.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stage = f"{scratch_dir(spark, 'averages')}/{batch_id}"
        batch.select(*SERIES, "time", "close").write.parquet(stage)
        rows = spark.read.parquet(stage)
        missing = F.col("close").isNull() | F.isnan("close")
        aside = rows.where(missing)
        rows = rows.where(~missing)
        before = f"{folder}/state/v={batch_id - 1}"
        known = exists(spark, before)
        if batch_id > 0 and not known:
            raise ValueError(f"no state of batch {batch_id - 1} under {folder}; the folder belongs to another checkpoint")
        if batch_id == 0 and exists(spark, f"{folder}/state/v=1"):
            raise ValueError(f"{folder} already holds later batches; a new checkpoint needs a new folder")
        if known:
            state = spark.read.parquet(before)
            was = state.select(*SERIES, *[F.col(n).alias(f"_was_{n}") for n in _SEEDS])
            rows = rows.join(broadcast_if_small(was), list(SERIES), "left")
            late = F.col("_was_time").isNotNull() & (F.col("time") <= F.col("_was_time"))
            aside = aside.unionByName(rows.where(late).select(*aside.columns))
            rows = rows.where(~late)
        else:
            nothing = {f"_was_{n}": F.lit(None).cast("double") for n in _SEEDS}
            rows = rows.withColumns(nothing)
        aside.write.mode("overwrite").parquet(f"{folder}/late/batch={batch_id}")
        made = run(rows, [_seeded_averages()], **layout).select(
            *SERIES, "time", "close", *dict.fromkeys((*_HELD, *_RESULTS))
        )
        made.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
        held = spark.read.parquet(f"{folder}/out/batch={batch_id}").select(*SERIES, *_SEEDS)
        if known:
            held = held.unionByName(state)
        rest = [n for n in _SEEDS if n != "time"]
        newest = held.groupBy(*SERIES).agg(
            F.max("time").alias("time"), *[F.max_by(n, "time").alias(n) for n in rest]
        )
        newest.write.mode("overwrite").parquet(f"{folder}/state/v={batch_id}")
        remove_folder(spark, stage)

    return apply


def read_averages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/out").select(*SERIES, "time", "close", *_RESULTS)


def upsert_days(target: str, keys=CANDLE_KEY, time: str = "time", merge=upsert, days: int = 1):
    """A ``foreachBatch`` function that merges each batch into the chunks of ``days`` days it touches (see merge_chunks).

    A repeated batch gives the same table. The function also serves batch deliveries: ``apply(delivery, 0)``.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_chunks(target, batch, keys, time, merge, days)

    return apply


def daily_bars_by_batch(folder: str, delay: str = "1 hour"):
    """A ``foreachBatch`` function: final daily bars under ``folder/out``, open ones in ``folder/open``, late rows in ``folder/late``.

    The watermark is the newest time of all earlier batches minus ``delay``. A row is late if its day ended at or
    before it, as in :func:`daily_bars`, which drops such rows; here they are kept, so the candles of final and open bars
    and the late rows are together the input. Bars are merged from partial ones, one row per open day and series. All is
    written per batch, so a repeated batch replaces its own output. Rows without a time are set aside too.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stage = f"{scratch_dir(spark, 'bars')}/{batch_id}"
        batch.write.parquet(stage)
        rows = spark.read.schema(batch.schema).parquet(stage)
        before, mark = f"{folder}/open/v={batch_id - 1}", None
        if batch_id and not exists(spark, before):
            raise ValueError(f"no open bars of batch {batch_id - 1} under {folder}; the folder belongs to another checkpoint")
        if batch_id == 0 and exists(spark, f"{folder}/open/v=1"):
            raise ValueError(f"{folder} already holds later batches; a new checkpoint needs a new folder")
        if batch_id:
            mark = spark.read.parquet(f"{folder}/mark/v={batch_id - 1}").first()["newest"]

        def ended(time, newest):
            """Whether the day of ``time`` ended at or before the watermark of ``newest``."""
            if newest is None:
                return F.lit(False)
            watermark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
            return F.date_trunc("day", time) + F.expr("INTERVAL 1 DAY") <= watermark

        late = F.col("time").isNull() | ended(F.col("time"), mark)
        rows.where(late).write.mode("overwrite").parquet(f"{folder}/late/batch={batch_id}")
        bars = partial_bars(rows.where(~late))
        if batch_id:
            bars = merged_bars(spark.read.parquet(before).unionByName(bars))
        bars.write.mode("overwrite").parquet(f"{stage}-bars")
        bars = spark.read.parquet(f"{stage}-bars")
        newest = rows.agg(F.max("time")).first()[0]
        newest = max((t for t in (mark, newest) if t is not None), default=None)
        done = ended(F.col("time"), newest)
        bars.where(done).write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
        spark.createDataFrame([(newest,)], "newest timestamp").write.mode("overwrite").parquet(f"{folder}/mark/v={batch_id}")
        bars.where(~done).write.mode("overwrite").parquet(f"{folder}/open/v={batch_id}")
        remove_folder(spark, stage)
        remove_folder(spark, f"{stage}-bars")

    return apply


def read_bars(spark: SparkSession, folder: str, batches: int) -> tuple:
    """(bars, late rows) after ``batches`` batches: final bars and those still open."""
    bars = spark.read.parquet(f"{folder}/out").drop("batch").unionByName(spark.read.parquet(f"{folder}/open/v={batches - 1}"))
    return finished_bars(bars), spark.read.parquet(f"{folder}/late").drop("batch")


def run_to_end(stream: DataFrame, mode: str = "append", foreach=None) -> DataFrame | None:
    """Process all available input once and return what was written (append mode) as a table."""
    spark = stream.sparkSession
    base = scratch_dir(spark, "stream")
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{base}/state")
    if foreach is not None:
        writer.outputMode(mode).foreachBatch(foreach).start().awaitTermination()
        return None
    writer.outputMode(mode).format("parquet").option("path", f"{base}/out").start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def run_updates(stream: DataFrame, keys, newest: str) -> DataFrame:
    """Run an update-mode stream to its end; the last update of each key, read from the written batches."""
    spark = stream.sparkSession
    base = scratch_dir(spark, "updates")

    def keep(batch, batch_id):
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{base}/out/b={batch_id}"
        )

    (
        stream.writeStream.trigger(availableNow=True)
        .outputMode("update")
        .option("checkpointLocation", f"{base}/state")
        .foreachBatch(keep)
        .start()
        .awaitTermination()
    )
    written = spark.read.parquet(f"{base}/out").drop("b")
    rest = [c for c in stream.columns if c not in keys]
    return written.groupBy(*keys).agg(*[F.max_by(c, "_batch").alias(c) for c in rest])
