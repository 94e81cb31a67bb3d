"""Analytics for market candles and similar keyed time series, built on PySpark DataFrames."""
