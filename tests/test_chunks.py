import glob
import os

import pandas as pd
import pytest
from frames import to_spark, walk
from pyspark.sql import functions as F

from tidemark.operators import bars, lookups, tables
from tidemark.plans import features
from tidemark.sources import chunks
from tidemark.sources.candles import write_by_day
from tidemark.streaming import jobs


def files_of(target):
    """{day: names of its data files}."""
    out = {}
    for path in glob.glob(f"{target}/day=*/*.parquet"):
        out.setdefault(os.path.basename(os.path.dirname(path))[4:], set()).add(os.path.basename(path))
    return out


@pytest.fixture
def stored(spark, tmp_path):
    """Ten days of two series in day chunks."""
    frame = to_spark(spark, pd.concat([walk("A", 240), walk("B", 100, seed=1)]))
    target = str(tmp_path / "table")
    write_by_day(frame, target)
    return frame, target


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()


def test_merge_touches_only_delivered_days(spark, stored):
    frame, target = stored
    before = files_of(target)
    delivery = frame.where("time >= '2024-01-03' AND time < '2024-01-04 12:00'").withColumn("close", F.col("close") + 1)
    chunks.merge_chunks(target, delivery.unionByName(delivery))
    after = files_of(target)
    assert {d for d in before if before[d] != after[d]} == {"2024-01-03", "2024-01-04"}
    assert same(tables.upsert(frame, delivery), spark.read.parquet(target))
    chunks.merge_chunks(target, delivery)
    assert same(tables.upsert(frame, delivery), spark.read.parquet(target))


def test_merge_reads_only_delivered_days(spark, stored):
    _, target = stored
    days = spark.createDataFrame([("2024-01-03",)], "d string").select(F.col("d").cast("date").alias("day"))
    picked = chunks.only_days(spark.read.parquet(target), days)
    assert len(picked.inputFiles()) >= 1
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(day" in plan or "PartitionFilters: [day" in plan


@pytest.mark.parametrize("days", [1, 7])
def test_retention_drops_whole_chunks(spark, tmp_path, days):
    frame = to_spark(spark, walk("A", 24 * 40))
    target = str(tmp_path / f"t{days}")
    write_by_day(frame, target, days=days)
    before = files_of(target)
    as_of = F.lit("2024-02-20 05:00:00").cast("timestamp_ntz")
    chunks.drop_older(spark, target, as_of, months=1, days=days)
    after = files_of(target)
    assert same(tables.retain(frame, as_of, 1), spark.read.parquet(target))
    border = min(after)
    assert all(before[d] == after[d] for d in after if d != border) and before[border] != after[border]
    assert all(d < border for d in set(before) - set(after))
    chunks.drop_older(spark, target, F.lit("2030-01-01").cast("timestamp_ntz"), months=1, days=days)
    assert files_of(target) == {}


def test_cascade_rewrites_only_chunks_with_deleted_symbols(spark, stored):
    frame, target = stored
    before = files_of(target)
    chunks.drop_symbols(target, spark.createDataFrame([("B",), ("nobody",)], "symbol string"))
    after = files_of(target)
    assert same(frame.where("symbol <> 'B'"), spark.read.parquet(target))
    assert {d for d in before if before[d] != after.get(d)} == {f"2024-01-0{d}" for d in range(1, 6)}
    chunks.drop_symbols(target, spark.createDataFrame([("nobody",)], "symbol string"))
    assert files_of(target) == after
    chunks.drop_symbols(target, spark.createDataFrame([("A",)], "symbol string"))
    assert files_of(target) == {}


def test_refreshed_bars_equal_a_full_computation(spark, stored, tmp_path):
    frame, _ = stored
    target = str(tmp_path / "bars")
    parts = [frame.where("time < '2024-01-06'"), frame.where("time >= '2024-01-06' AND hour(time) >= 9"), frame.where("time >= '2024-01-06' AND hour(time) < 9")]
    for i, part in enumerate(parts):
        chunks.refresh_bars(target, part)
        if i == 0:
            first = files_of(target)
    last = files_of(target)
    assert all(first[d] == last[d] for d in first)
    got = bars.finished_bars(spark.read.parquet(target)).toPandas().sort_values(["day", "symbol"]).reset_index(drop=True)
    want = bars.daily_stats(frame).toPandas().sort_values(["day", "symbol"]).reset_index(drop=True)[got.columns.tolist()]
    got["day"], want["day"] = pd.to_datetime(got["day"]), pd.to_datetime(want["day"])
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_stored_features_are_upserted_by_day(spark, tmp_path):
    frame = to_spark(spark, walk("A", 200))
    target = str(tmp_path / "features")
    features.store_features(frame, target)
    features.store_features(frame, target)
    assert same(features.refresh_features(frame), spark.read.parquet(target).drop("day"))


def test_asof_many_equals_pandas(spark):
    a, b = walk("A", 60, drop=(5, 6, 7, 30)), walk("B", 10, seed=3, start="2024-01-02")
    a.loc[10, "close"] = None
    pdf = pd.concat([a, b])
    asked = pd.DataFrame({"symbol": ["A"] * 6 + ["B", "B", "C", None], "timeframe": "1h", "id": range(10),
                          "at": pd.to_datetime(["2023-12-31", "2024-01-01", "2024-01-01 06:30", "2024-01-01 10:59", "2024-01-01 10:59", "2030-01-01",
                                                "2024-01-02 03:00", "2024-01-01", "2024-01-02", "2024-01-02"], format="mixed")})
    requests = spark.createDataFrame(asked).withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = lookups.asof_many(to_spark(spark, pdf), requests, chunk_rows=7).toPandas().sort_values("id")
    known = pdf.dropna(subset=["close"])
    want = []
    for _, r in asked.iterrows():
        rows = known[(known["symbol"] == r["symbol"]) & (known["time"] <= r["at"])]
        want.append((rows["time"].max(), rows.loc[rows["time"].idxmax(), "close"]) if len(rows) else (None, None))
    assert len(got) == 10
    for (_, g), (t, v) in zip(got.iterrows(), want):
        assert (pd.isna(g["close_then"]) and v is None) or (g["close_then"] == v and g["close_time"] == t)


def test_performance_reads_the_table_once(spark, stored):
    _, target = stored
    table = spark.read.parquet(target)
    frame = lookups.performance_24h(table)
    assert frame._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    as_of = table.agg(F.max("time")).first()[0]
    ago = {r["symbol"]: r["price_ago"] for r in lookups.asof_price(table, F.lit(as_of).cast("timestamp_ntz")).collect()}
    assert {r["symbol"]: round(r["price_24h_ago"], 2) for r in frame.collect()} == {s: pytest.approx(round(p, 2), abs=0.006) for s, p in ago.items()}


def test_bars_by_batch_keep_late_rows(spark, tmp_path):
    """Final and open bars and late rows are together the input; a repeated batch changes nothing."""
    frame = to_spark(spark, pd.concat([walk("A", 120), walk("B", 90, seed=2)])).withColumn("time", F.col("time").cast("timestamp"))
    parts = ["time < '2024-01-02 12:00'", "time >= '2024-01-04'", "time >= '2024-01-02 12:00' AND time < '2024-01-03 20:00'",
             "time >= '2024-01-03 20:00' AND time < '2024-01-04'"]
    folder = str(tmp_path / "bars")
    apply = jobs.daily_bars_by_batch(folder)
    for i, part in enumerate(parts):
        apply(frame.where(part), i)
        apply(frame.where(part), i)
    made, late = jobs.read_bars(spark, folder, len(parts))
    # The watermark after the second batch is 22:00 or 23:00 of the newest day, so all days before it are closed.
    assert late.count() == frame.where(f"({parts[2]}) OR ({parts[3]})").count()
    assert made.agg(F.sum("candles_count")).first()[0] + late.count() == frame.count()
    on_time = frame.where(f"({parts[0]}) OR ({parts[1]})").withColumn("time", F.col("time").cast("timestamp_ntz"))
    want = {(str(r["day"]), r["symbol"]): r["day_close"] for r in bars.daily_stats(on_time).collect()}
    assert {(str(r["day"]), r["symbol"]): r["day_close"] for r in made.collect()} == want
    with pytest.raises(ValueError, match="another checkpoint"):
        apply(frame, 9)
