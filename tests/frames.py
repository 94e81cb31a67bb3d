"""Small candle frames and their pandas computations, as independent checks."""

import numpy as np
import pandas as pd


def walk(symbol, rows, seed=0, timeframe="1h", start="2024-01-01", step="1h", drop=()):
    rng = np.random.default_rng(seed)
    close = 100 + np.cumsum(rng.normal(size=rows))
    open_ = close + rng.normal(size=rows) * 0.3
    frame = pd.DataFrame(
        {
            "time": pd.date_range(start, periods=rows, freq=step),
            "symbol": symbol,
            "timeframe": timeframe,
            "open": open_,
            "high": np.maximum(open_, close) + rng.random(rows),
            "low": np.minimum(open_, close) - rng.random(rows),
            "close": close,
            "volume": rng.integers(1, 1000, rows).astype(float),
            "quote_volume": 1.0,
            "trades_count": 1,
        }
    )
    return frame.drop(index=list(drop)).reset_index(drop=True)


def to_spark(spark, pdf):
    from pyspark.sql import functions as F

    return spark.createDataFrame(pdf).withColumn("time", F.col("time").cast("timestamp_ntz"))


def expected_features(pdf):
    """pandas columns of one series, straight from the formulas."""
    c, h, lo, v = (pdf[n] for n in ("close", "high", "low", "volume"))
    out = pd.DataFrame({"time": pdf["time"]})

    def span(x, n):
        return x.ewm(span=n, adjust=False).mean()

    for n in (7, 25, 99):
        out[f"sma_{n}"] = c.rolling(n).mean()
        out[f"ema_{n}"] = span(c, n)
    move = c.diff()
    out["rsi_14"] = 100 - 100 / (1 + span(move.clip(lower=0).fillna(0), 14) / span((-move).clip(lower=0).fillna(0), 14))
    out["macd"] = span(c, 12) - span(c, 26)
    out["macd_signal"] = span(out["macd"], 9)
    out["macd_histogram"] = out["macd"] - out["macd_signal"]
    out["bb_middle"] = c.rolling(20).mean()
    out["bb_upper"] = out["bb_middle"] + 2 * c.rolling(20).std()
    out["bb_lower"] = out["bb_middle"] - 2 * c.rolling(20).std()
    ranges = pd.concat([h - lo, (h - c.shift()).abs(), (lo - c.shift()).abs()], axis=1)
    out["atr_14"] = span(ranges.max(axis=1), 14)
    low, high = lo.rolling(14).min(), h.rolling(14).max()
    out["stoch_k"] = 100 * (c - low) / (high - low)
    out["stoch_d"] = out["stoch_k"].rolling(3).mean()
    out["returns"] = c / c.shift() - 1
    out["log_returns"] = np.log(c / c.shift())
    out["cumulative_returns"] = (1 + out["returns"]).cumprod() - 1
    out["volume_sma_7"] = v.rolling(7).mean()
    out["volume_ratio"] = v / v.rolling(25).mean()
    out["vwap"] = (v * (h + lo + c) / 3).cumsum() / v.cumsum()
    for n in (7, 14, 30):
        out[f"volatility_{n}"] = out["returns"].rolling(n).std()
        out[f"price_volatility_{n}"] = c.rolling(n).std()
    for k in (1, 3, 6, 12, 24):
        out[f"close_lag_{k}"] = c.shift(k)
    return out
