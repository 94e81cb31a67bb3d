import numpy as np
import pandas as pd
import pytest
from frames import expected_features, to_spark, walk
from pyspark.sql import functions as F

from tidemark.operators import bars
from tidemark.operators import indicators as ind
from tidemark.operators.tables import insert_ignore
from tidemark.streaming import jobs


def feed(spark, folder, *batches):
    """One file per batch, named and dated so that the source reads them in this order."""
    import glob
    import os
    import shutil

    os.makedirs(folder, exist_ok=True)
    for i, pdf in enumerate(batches):
        part = str(folder) + f"-part{i}"
        frame = to_spark(spark, pdf).withColumn("time", F.col("time").cast("timestamp"))
        frame.coalesce(1).write.parquet(part)
        target = os.path.join(folder, f"{i:03d}.parquet")
        shutil.copy(glob.glob(f"{part}/*.parquet")[0], target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    schema = frame.schema
    return jobs.read_stream(spark, str(folder), schema, files_per_batch=1)


def test_daily_bars_drop_late_rows(spark, tmp_path):
    pdf = walk("A", 96)
    late = pdf.iloc[[2]].assign(close=9999.0, high=9999.0)
    # A batch is measured against the watermark of the batch before the previous one.
    stream = feed(spark, tmp_path / "in", pdf[:60], pdf[60:70], late, pdf[70:])
    got = jobs.run_to_end(jobs.daily_bars(stream)).orderBy("day").toPandas()
    want = bars.daily_stats(to_spark(spark, pdf)).orderBy("day").toPandas()[:3]
    assert list(got["day_close"]) == list(want["day_close"])
    assert list(got["day_high"]) == list(want["day_high"])
    assert list(got["candles_count"]) == [24, 24, 24]


def test_ingest_drops_copies(spark, tmp_path):
    pdf = walk("A", 20)
    stream = feed(spark, tmp_path / "in", pdf, pdf[5:], pdf[:3])
    assert jobs.run_to_end(jobs.ingest(stream)).count() == 20


def test_latest_over_batches(spark, tmp_path):
    pdf = walk("A", 40)
    stream = feed(spark, tmp_path / "in", pdf[:10], pdf[20:], pdf[10:20])
    row = jobs.run_updates(jobs.latest(stream), ("symbol", "timeframe"), "time").first()
    assert row["price"] == pytest.approx(pdf["close"].iloc[-1])


def test_open_day_in_update_mode(spark, tmp_path):
    pdf = walk("A", 60)
    stream = feed(spark, tmp_path / "in", pdf[:30], pdf[30:40], pdf[40:])
    got = jobs.run_updates(jobs.daily_bars(stream), ("day", "symbol", "timeframe"), "day").orderBy("day").toPandas()
    assert list(got["candles_count"]) == [24, 24, 12]


def test_late_and_missing_rows_are_set_aside(spark, tmp_path):
    pdf = walk("A", 40)
    hole = pdf[25:26].assign(close=float("nan"))
    folder = str(tmp_path / "averages")
    stream = feed(spark, tmp_path / "in", pdf[:20], pdf[18:25], pd.concat([hole, pdf[26:]]))
    jobs.run_to_end(stream, foreach=jobs.averages_by_batch(folder))
    assert jobs.read_averages(spark, folder).count() == 39
    assert spark.read.parquet(f"{folder}/late").count() == 3


def test_a_new_checkpoint_needs_a_new_folder(spark, tmp_path):
    pdf = walk("A", 10)
    folder = str(tmp_path / "averages")
    stream = feed(spark, tmp_path / "in", pdf[:5], pdf[5:])
    jobs.run_to_end(stream, foreach=jobs.averages_by_batch(folder))
    with pytest.raises(Exception, match="already holds later batches"):
        jobs.run_to_end(feed(spark, tmp_path / "again", pdf[:5]), foreach=jobs.averages_by_batch(folder))


def test_a_repeated_batch_with_copies_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "table")
    base = to_spark(spark, walk("A", 60)).withColumn("time", F.col("time").cast("timestamp"))
    apply = jobs.upsert_days(target, days=7)
    apply(base.unionByName(base.limit(9).withColumn("close", F.lit(1.0))), 0)
    once = sorted(map(tuple, spark.read.parquet(target).collect()))
    apply(base.unionByName(base.limit(9).withColumn("close", F.lit(1.0))), 0)
    spark.catalog.clearCache()
    assert len(once) == 60 and sorted(map(tuple, spark.read.parquet(target).collect())) == once


def test_batchwise_averages_equal_one_pass(spark, tmp_path):
    still = walk("A", 400, seed=1)
    still.loc[200:260, "close"] = still.loc[199, "close"]
    pdf = pd.concat([still, walk("B", 90, seed=2)]).sort_values("time")
    stream = feed(spark, tmp_path / "in", pdf[:50], pdf[50:51], pdf[40:300], pdf[300:])
    folder = str(tmp_path / "averages")
    jobs.run_to_end(stream, foreach=jobs.averages_by_batch(folder, chunk_rows=30))
    got = jobs.read_averages(spark, folder).toPandas()
    for symbol in "AB":
        want = expected_features(pdf[pdf["symbol"] == symbol].reset_index(drop=True))
        mine = got[got["symbol"] == symbol].sort_values("time").reset_index(drop=True)
        assert len(mine) == len(want)
        for name in ("ema_7", "ema_25", "ema_99", "rsi_14", "macd", "macd_signal", "macd_histogram"):
            pd.testing.assert_series_equal(
                mine[name].astype(float), want[name], check_names=False, rtol=1e-9, atol=1e-9
            )


def test_stream_upsert_into_days(spark, tmp_path):
    target = str(tmp_path / "table")
    pdf = walk("A", 60)
    again = pdf[10:30].assign(close=1.0)
    stream = feed(spark, tmp_path / "in", pdf, again)
    jobs.run_to_end(stream, foreach=jobs.upsert_days(target))
    got = spark.read.parquet(target).orderBy("time").toPandas()
    assert len(got) == 60
    assert list(got["close"][10:30]) == [1.0] * 20
    assert got["close"][5] == pytest.approx(pdf["close"][5])


def test_stream_insert_ignore_into_days(spark, tmp_path):
    target = str(tmp_path / "table")
    pdf = walk("A", 60)
    stream = feed(spark, tmp_path / "in", pdf[:40], pdf[30:].assign(close=1.0))
    jobs.run_to_end(stream, foreach=jobs.upsert_days(target, merge=insert_ignore))
    got = spark.read.parquet(target).orderBy("time").toPandas()
    assert list(got["close"]) == pytest.approx(list(pdf["close"][:40]) + [1.0] * 20)


def test_known_symbols_only(spark, tmp_path):
    pdf = pd.concat([walk("A", 5), walk("X", 5)])
    stream = feed(spark, tmp_path / "in", pdf)
    known = spark.createDataFrame([("A",)], "symbol string")
    assert jobs.run_to_end(jobs.known_only(stream, known)).count() == 5


def test_rsi_of_batches_is_held_over_a_long_flat_stretch(spark, tmp_path):
    pdf = walk("A", 6500, seed=3, step="1min", timeframe="1m")
    pdf.loc[300:6400, "close"] = pdf.loc[299, "close"]
    folder = str(tmp_path / "held")
    apply = jobs.averages_by_batch(folder, block_rows=600)
    for i, part in enumerate((pdf[:3000], pdf[3000:6000], pdf[6000:])):
        apply(to_spark(spark, part), i)
    got = jobs.read_averages(spark, folder).toPandas().sort_values("time")["rsi_14"].to_numpy(float)
    want = ind.rsi(to_spark(spark, pdf)).toPandas().sort_values("time")["rsi_14"].to_numpy(float)
    np.testing.assert_allclose(got, want, rtol=1e-7)
    np.testing.assert_allclose(got[300:6401], got[299], rtol=1e-9)
