import numpy as np
import pandas as pd
import pytest
from frames import expected_features, to_spark, walk
from pyspark.sql import functions as F

from tidemark.operators import indicators as ind
from tidemark.operators.series import run, with_position
from tidemark.plans import features


def check(spark, series, **layout):
    made = features.all_features(to_spark(spark, pd.concat(series)), **layout).toPandas()
    for pdf in series:
        want = expected_features(pdf)
        got = made[made["symbol"] == pdf["symbol"].iloc[0]].sort_values("time")
        assert len(got) == len(want)
        for name in want.columns[1:]:
            np.testing.assert_allclose(
                got[name].to_numpy(float), want[name].to_numpy(float), rtol=1e-9, atol=1e-9, err_msg=name
            )


def test_features_equal_pandas_for_many_lengths(spark):
    lengths = (1, 6, 120, 255, 256, 257, 600)
    check(spark, [walk(f"S{n}", n, seed=n) for n in lengths])


def test_features_do_not_depend_on_the_layout(spark):
    # Chunks of 40 rows and blocks as short as the reach: every window crosses borders.
    series = [walk("A", 9000, seed=1), walk("B", 500, seed=2, drop=range(100, 160))]
    check(spark, series, chunk_rows=40, block_rows=64)


def test_bounded_windows_with_tiny_blocks(spark):
    pdf = walk("A", 700, seed=3, drop=(10, 11, 300))
    steps = [ind.sma_step(), ind.volatility_step(), ind.stochastic_step(), ind.lag_step(), ind.target_step(horizons=(1, 24))]
    got = run(to_spark(spark, pdf), steps, chunk_rows=7, block_rows=1).toPandas().sort_values("time")
    want = expected_features(pdf)
    for name in ("sma_99", "volatility_30", "price_volatility_14", "stoch_d", "close_lag_24"):
        np.testing.assert_allclose(got[name].to_numpy(float), want[name].to_numpy(float), rtol=1e-9, atol=1e-9)
    np.testing.assert_array_equal(got["target_24"].to_numpy(float), pdf["close"].shift(-24).to_numpy(float))


@pytest.mark.parametrize("periods", [(1, 2, 3), (7, 101), (150, 1000)])
def test_ema_of_any_span(spark, periods):
    pdf = walk("A", 7000, seed=5)
    frame = ind.exponential_average(to_spark(spark, pdf), periods=periods, block_rows=3000)
    got = frame.toPandas().sort_values("time")
    for p in periods:
        want = pdf["close"].ewm(span=p, adjust=False).mean()
        np.testing.assert_allclose(got[f"ema_{p}"].to_numpy(float), want.to_numpy(float), rtol=1e-12)


def test_macd_with_signal_equal_to_fast(spark):
    pdf = walk("A", 400, seed=6)
    got = ind.macd(to_spark(spark, pdf), fast=9, slow=26, signal=9).toPandas().sort_values("time")
    c = pdf["close"]
    line = c.ewm(span=9, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
    want = line.ewm(span=9, adjust=False).mean()
    np.testing.assert_allclose(got["macd_signal"].to_numpy(float), want.to_numpy(float), atol=1e-10)


def test_rsi_edges(spark):
    up, flat = walk("UP", 50), walk("FLAT", 50)
    up["close"] = np.arange(50) + 10.0
    flat["close"] = 5.0
    still = walk("STILL", 3000, seed=8)
    still.loc[500:, "close"] = still.loc[499, "close"]
    made = ind.rsi(to_spark(spark, pd.concat([up, flat, still])), block_rows=600).toPandas()
    by = {s: g.sort_values("time")["rsi_14"].to_numpy(float) for s, g in made.groupby("symbol")}
    assert np.isnan(by["UP"][0]) and (by["UP"][1:] == 100).all()
    assert np.isnan(by["FLAT"]).all()
    # A flat stretch keeps the value, as the averages shrink together.
    np.testing.assert_allclose(by["STILL"], expected_features(still)["rsi_14"].to_numpy(float), rtol=1e-9)


def test_results_do_not_depend_on_blocks(spark):
    pdf = walk("A", 14000, seed=3, step="1min", timeframe="1m")
    pdf.loc[2000:11000, "close"] = pdf.loc[1999, "close"]
    pdf["close"] = pdf["close"].astype(object)
    pdf.loc[1200, "close"] = float("nan")
    pdf.loc[12500, "close"] = None
    base = to_spark(spark, pdf.astype({"close": float})).withColumn(
        "close", F.when(F.col("time") == F.lit(pdf["time"][12500]), F.lit(None)).otherwise(F.col("close")))
    steps = [ind.rsi_step(), ind.ema_step(), ind.macd_step(), ind.atr_step()]
    names = [n for s in steps for n in s.adds]
    made = [run(base, steps, block_rows=b).toPandas().sort_values("time")[names].to_numpy(float) for b in (600, 6000, 32768)]
    for other in made[1:]:
        np.testing.assert_allclose(other, made[0], rtol=1e-9, atol=1e-9)
    rsi = made[0][:, 0]
    known = pdf["close"].astype(float).ffill()
    want = expected_features(pdf.assign(close=known))
    np.testing.assert_allclose(rsi[:6000], want["rsi_14"][:6000].to_numpy(float), rtol=1e-7)
    # The value is held for a fixed number of rows after the last move.
    assert not np.isnan(rsi[1999 + ind.RSI_HOLD]) and np.isnan(rsi[2000 + ind.RSI_HOLD]) and not np.isnan(rsi[11002])
    np.testing.assert_allclose(made[0][:, 2], want["ema_25"].to_numpy(float), rtol=1e-9)


def test_rsi_is_held_over_any_flat_stretch(spark):
    pdf = walk("A", 14000, seed=3, step="1min", timeframe="1m")
    pdf.loc[2000:11000, "close"] = pdf.loc[1999, "close"]
    want = expected_features(pdf)["rsi_14"].to_numpy(float)
    for rows in (600, 6000, 32768):
        got = ind.rsi(to_spark(spark, pdf), block_rows=rows).toPandas().sort_values("time")["rsi_14"].to_numpy(float)
        np.testing.assert_allclose(got[:7000], want[:7000], rtol=1e-7)  # the reference underflows after some 5,200 flat rows
        np.testing.assert_allclose(got[2000:11001], got[1999], rtol=1e-9)
        np.testing.assert_allclose(got[11001:], want[11001:], rtol=1e-7)


def test_averages_start_at_the_first_known_value(spark):
    pdf = walk("A", 50)
    pdf.loc[:4, "close"] = float("nan")
    got = ind.exponential_average(to_spark(spark, pdf), chunk_rows=7).toPandas().sort_values("time")["ema_7"].to_numpy(float)
    want = pdf["close"][5:].ewm(span=7, adjust=False).mean().to_numpy(float)
    assert np.isnan(got[:5]).all()
    np.testing.assert_allclose(got[5:], want, rtol=1e-12)


def test_zero_close_and_flat_windows_give_null(spark):
    pdf = walk("Z", 60)
    pdf.loc[:, ["open", "high", "low", "close"]] = 1.0
    pdf.loc[30, "close"] = 0.0
    made = features.all_features(to_spark(spark, pdf)).toPandas().sort_values("time")
    assert pd.isna(made["returns"].iloc[31]) and made["returns"].iloc[30] == -1
    assert pd.isna(made["log_returns"].iloc[30])
    assert made["stoch_k"].isna().all()
    assert made["price_volatility_7"].iloc[10] == 0


def test_positions_and_length(spark):
    pdf = pd.concat([walk("A", 333, drop=(5, 200)), walk("B", 10)])
    got = with_position(to_spark(spark, pdf), with_length=True, chunk_rows=16).toPandas()
    for symbol, n in (("A", 331), ("B", 10)):
        part = got[got["symbol"] == symbol].sort_values("time")
        assert list(part["_pos"]) == list(range(n)) and set(part["_length"]) == {n}


def test_feature_list(spark):
    names = features.feature_names()
    assert len(names) == len(set(names)) == 52
    base = to_spark(spark, walk("A", 3))
    assert set(features.all_features(base).columns) - set(base.columns) == set(names)


def test_first_stored_and_first_complete_row(spark):
    base = to_spark(spark, walk("A", 120))
    made = features.all_features(base)
    assert features.stored_features(made).count() == 120 - 6
    assert made.dropna("any").count() == 120 - 98


def test_layout_never_sorts_a_whole_series(spark):
    plan = features.all_features(to_spark(spark, walk("A", 5)))._jdf.queryExecution().executedPlan().toString()
    shuffles = [x.split("hashpartitioning(")[1].split("]")[0] for x in plan.split("\n") if "hashpartitioning(" in x]
    assert any("_block" in s for s in shuffles) and any("_chunk" in s for s in shuffles)
    # Only the table of chunk sizes is shuffled by series alone, after it was aggregated.
    assert sum("_block" not in s and "_chunk" not in s for s in shuffles) == 1
    assert plan.count("hashpartitioning(symbol") <= 5


def test_null_key_or_time_rows_are_left_out(spark):
    base = to_spark(spark, walk("A", 5))
    broken = base.withColumn("time", F.when(F.col("volume") >= 0, F.lit(None)).otherwise(F.col("time")))
    assert ind.sma(base.unionByName(broken)).count() == 5
