import numpy as np
import pandas as pd
import pytest
from frames import to_spark, walk
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import bars, lookups, quality, stats, tables
from tidemark.operators.quantiles import exact_quantiles, narrowed_quantiles
from tidemark.plans import features


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(st.floats(-1e12, 1e12), st.sampled_from([0.0, 1.0, -1.0])), min_size=1, max_size=60
    )
)
def test_quantiles_equal_numpy(spark, values):
    frame = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    wanted = {"lo": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "hi": 1.0}
    row = exact_quantiles(frame, ["k"], "v", wanted).first()
    for name, p in wanted.items():
        assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)


def test_quantiles_with_outliers_and_copies(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(size=3000), np.zeros(1500), [1e15, -1e15]])
    frame = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    row = exact_quantiles(frame, ["k"], "v", {"a": 0.1, "b": 0.5, "c": 0.999}).first()
    np.testing.assert_allclose(list(row)[1:], np.quantile(values, [0.1, 0.5, 0.999]), rtol=1e-12)


@pytest.mark.parametrize("kind", ["log-uniform", "normal", "copies", "few values", "two lumps"])
def test_quantiles_narrow_by_rank(spark, kind):
    """Every pass leaves a small fixed share of a group, whatever the distribution."""
    rng = np.random.default_rng(5)
    size = 60_000
    values = {
        "log-uniform": 10.0 ** rng.uniform(-30, 30, size),
        "normal": rng.normal(size=size),
        "copies": np.concatenate((np.zeros(size // 2), rng.normal(size=size // 2))),
        "few values": rng.integers(0, 3, size).astype(float),
        "two lumps": np.concatenate((rng.normal(size=size // 2) * 1e-9, 1e9 + rng.normal(size=size // 2))),
    }[kind]
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9999, "e": 1.0}
    frame = spark.createDataFrame(pd.DataFrame({"k": np.arange(size) % 2, "_v": values})).repartition(7)
    left = []
    got = narrowed_quantiles(frame, ["k"], wanted, limit=50, left=left).collect()
    for row in got:
        want = np.quantile(values[row["k"] :: 2], list(wanted.values()))
        np.testing.assert_allclose([row[n] for n in wanted], want, rtol=1e-12)
    assert left[0] == size // 2 and all(b <= a * 0.05 + 2 for a, b in zip(left, left[1:])), left


def test_quantiles_of_small_and_large_groups_agree(spark):
    pdf = pd.DataFrame({"k": ["a"] * 999 + ["b"] * 5 + ["c", "c"], "v": [*np.random.default_rng(0).normal(size=1004), np.nan, None]})
    frame = spark.createDataFrame(pdf)
    wanted = {"x": 0.5, "y": 0.1}
    total = [F.count("v").alias("n")]
    small = sorted(map(tuple, exact_quantiles(frame, ["k"], "v", wanted, aggregates=total).collect()), key=repr)
    large = sorted(map(tuple, exact_quantiles(frame, ["k"], "v", wanted, aggregates=total, limit=3).collect()), key=repr)
    for a, b in zip(small, large):
        assert a[:2] == b[:2] and all(x == y or x == pytest.approx(y, rel=1e-12) for x, y in zip(a[2:], b[2:]))


def test_correlation_equals_pandas(spark):
    a, b = walk("A", 300, seed=1, drop=(3, 40, 41)), walk("B", 260, seed=2, start="2024-01-02", drop=(7,))
    c = walk("C", 280, seed=3)
    pdf = pd.concat([a, b, c])
    matrix = pdf.pivot(index="time", columns="symbol", values="close")
    filled = matrix.ffill()
    want = (filled / filled.shift() - 1).dropna().corr()
    got = stats.returns_correlation(to_spark(spark, pdf)).toPandas()
    assert len(got) == 9
    for _, row in got.iterrows():
        assert row["corr"] == pytest.approx(want.loc[row["symbol_a"], row["symbol_b"]], abs=1e-12)


@pytest.mark.parametrize("count, group", [(5, 64), (31, 8), (600, 64)])
def test_correlation_of_any_number_of_symbols(spark, monkeypatch, count, group):
    monkeypatch.setattr(stats, "CORRELATION_GROUP", group)
    rows = 60 if count < 100 else 12
    pdf = pd.concat([walk(f"S{i}", rows, seed=i, drop=(i % (rows - 2) + 1,)) for i in range(count)])
    pdf.loc[pdf["symbol"] == "S3", "close"] = 100.0
    filled = pdf.pivot(index="time", columns="symbol", values="close").ffill()
    want = (filled / filled.shift() - 1).dropna().corr()
    got = stats.returns_correlation(to_spark(spark, pdf)).toPandas()
    assert len(got) == len(got[["symbol_a", "symbol_b"]].drop_duplicates()) == count * count
    table = got.pivot(index="symbol_a", columns="symbol_b", values="corr").astype(float)
    assert table["S3"].isna().all() and table.loc["S3"].isna().all()
    np.testing.assert_allclose(table.drop("S3").drop(columns="S3"), want.drop("S3").drop(columns="S3"), atol=1e-9)


def test_correlation_refuses_mixed_timeframes(spark):
    pdf = pd.concat([walk("A", 9), walk("A", 9, timeframe="4h")])
    with pytest.raises(ValueError, match="timeframes"):
        stats.returns_correlation(to_spark(spark, pdf))


def test_copies_in_a_delivery_count_once(spark):
    old = to_spark(spark, walk("A", 4))
    new = to_spark(spark, walk("A", 6, seed=5))
    twice = new.unionByName(new).unionByName(new.withColumn("close", F.lit(1.0)))
    assert tables.insert_ignore(old, twice).count() == 6
    merged = tables.upsert(old, twice)
    assert merged.count() == 6 and tables.upsert(merged, twice).exceptAll(merged).count() == 0


def test_gaps_of_months_and_unknown_frames(spark):
    months = walk("A", 12, timeframe="1M", step="MS", start="2023-01-01", drop=(2, 3))
    got = {r["time"] for r in stats.gaps(to_spark(spark, months)).collect()}
    assert got == {pd.Timestamp("2023-03-01").to_pydatetime(), pd.Timestamp("2023-04-01").to_pydatetime()}
    with pytest.raises(PySparkException, match="unknown timeframe"):
        stats.gaps(to_spark(spark, walk("A", 5, timeframe="2h", step="2h"))).collect()


def test_overflow_leaves_other_series_stored(spark):
    bad = walk("B", 120)
    bad.loc[60, ["close", "high"]] = 1e12
    bad.loc[100, "close"] = float("nan")
    base = to_spark(spark, pd.concat([walk("A", 120), bad]))
    made = features.all_features(base)
    kept, aside = features.stored_features(made), features.overflowing_features(made)
    row = {r["symbol"]: r for r in features.feature_run_stats(base, kept, aside).collect()}
    assert row["A"]["features_overflowing"] == 0 and row["A"]["features_stored"] > 80
    assert row["B"]["features_overflowing"] > 0 and row["B"]["features_stored"] > 0
    assert "returns" in {c for r in aside.collect() for c in r["overflow"]}


def test_pivot_rejects_duplicates(spark):
    frame = to_spark(spark, walk("A", 4))
    with pytest.raises(PySparkException, match="duplicate"):
        stats.pivot_close(frame.unionByName(frame)).collect()


def test_gaps_finds_missing_bars(spark):
    pdf = walk("A", 100, drop=(5, 6, 7, 50))
    got = {r["time"] for r in stats.gaps(to_spark(spark, pdf), chunk_rows=9, block_rows=5).collect()}
    full = pd.date_range("2024-01-01", periods=100, freq="1h")
    assert got == {full[i].to_pydatetime() for i in (5, 6, 7, 50)}


def test_outliers(spark):
    pdf = walk("A", 200)
    pdf.loc[120, "close"] *= 10
    times = [r["time"] for r in stats.outliers(to_spark(spark, pdf)).collect()]
    assert pdf["time"][120].to_pydatetime() in times


def test_resample_of_resample(spark):
    base = to_spark(spark, walk("A", 100))
    direct = bars.resample(base, "1d").orderBy("time").drop("timeframe").toPandas()
    twice = bars.resample(bars.resample(base, "4h"), "1d").orderBy("time").drop("timeframe").toPandas()
    pd.testing.assert_frame_equal(direct, twice)


def test_upsert_is_idempotent_and_null_overwrites(spark):
    old = spark.createDataFrame([(1, "a", 1.0, "x"), (2, "b", 2.0, "x")], "id int, name string, v double, created_at string")
    new = spark.createDataFrame([(2, None, 5.0, "y"), (3, "c", 3.0, "y")], old.schema)
    once = tables.upsert(old, new, keys=["id"])
    twice = tables.upsert(once, new, keys=["id"])
    want = {(1, "a", 1.0, "x"), (2, None, 5.0, "x"), (3, "c", 3.0, "y")}
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()} == want


def test_insert_ignore_keeps_first_incoming(spark):
    old = spark.createDataFrame([(1, 1.0)], "id int, v double")
    new = spark.createDataFrame([(1, 9.0, 1), (2, 5.0, 3), (2, 4.0, 2)], "id int, v double, seq int")
    got = tables.insert_ignore(old, new, keys=["id"], order="seq")
    assert {tuple(r) for r in got.collect()} == {(1, 1.0), (2, 4.0)}


def test_ensure_symbols_splits_pairs(spark):
    seeds = tables.seed_metadata(spark)
    assert seeds.count() == 10
    frame = spark.createDataFrame([("BTC/USDT",), ("ETH/BTC",), ("GOLD",)], "symbol string")
    got = {r["symbol"]: (r["base_currency"], r["quote_currency"]) for r in tables.ensure_symbols(seeds, frame).collect()}
    assert len(got) == 12
    assert got["ETH/BTC"] == ("ETH", "BTC") and got["GOLD"] == ("GOLD", "USDT")


def test_checks_pass_on_null_and_split(spark):
    frame = spark.createDataFrame(
        [(1.0, 2.0, 0.5, 1.5, 1.0), (1.0, None, 0.5, 1.5, -1.0), (1.0, 0.1, 0.5, 1.5, -2.0)],
        "open double, high double, low double, close double, volume double",
    )
    rules = {"check_prices": quality.price_rule(), "check_volume": quality.volume_rule()}
    valid, rejected = quality.split_valid(frame, rules)
    assert valid.count() == 1
    assert sorted(map(len, (r["reasons"] for r in rejected.collect()))) == [1, 2]
    with pytest.raises(PySparkException, match="constraint violated"):
        quality.split_valid(frame, rules, mode="fail")[0].collect()


def test_unknown_status_is_rejected(spark):
    rows = [("BUY", "active"), ("BUY", "gone"), ("HODL", "active"), ("SELL", None)]
    frame = spark.createDataFrame(rows, "signal_type string, status string")
    rules = {"t": quality.signal_type_rule(), "s": quality.signal_status_rule()}
    assert quality.split_valid(frame, rules)[0].count() == 2


def test_directional_accuracy_edges(spark):
    rows = [("m", "A", "1h", i, float(a), float(p)) for i, (a, p) in enumerate([(1, 1), (1, 1), (2, 3), (1, 5)])]
    rows.append(("m", "ONE", "1h", 0, 1.0, 1.0))
    frame = spark.createDataFrame(rows, "model_name string, symbol string, timeframe string, i int, actual double, predicted double")
    frame = frame.withColumn("target_time", F.timestamp_seconds(F.col("i") * 3600))
    got = {r["symbol"]: r["directional_accuracy"] for r in stats.directional_accuracy(frame).collect()}
    assert got["A"] == pytest.approx(200 / 3) and got["ONE"] == 0.0


def test_rank_models_flags_one_best(spark):
    frame = spark.createDataFrame([("a", "S", 2.0), ("b", "S", 1.0), ("a", "T", 1.0)], "model_name string, symbol string, rmse double")
    best = {(r["model_name"], r["symbol"]) for r in stats.rank_models(frame).collect() if r["is_best"]}
    assert best == {("b", "S"), ("a", "T")}


def test_asof_takes_explicit_time(spark):
    frame = to_spark(spark, walk("A", 72))
    as_of = F.lit("2024-01-03 00:30:00").cast("timestamp_ntz")
    row = lookups.asof_price(frame, as_of).first()
    assert str(row["time"]) == "2024-01-02 00:00:00"
