"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from tidemark.operators import indicators as ind
from tidemark.operators.series import run as series
from tidemark.plans.catalog import QUERIES
from tidemark.plans.market import line_candles
from tidemark.session import SETTINGS

HEADLINES = (
    "daily_stats",
    "resample_4h",
    "latest_prices",
    "performance_24h",
    "symbol_stats",
    "summary",
    "returns_stats",
    "describe",
    "returns_corr",
    "gaps",
    "sma",
    "ema",
    "rsi",
    "macd",
    "volatility",
    "all_features",
    "features_store",
    "training_frame",
    "scale_features",
    "chrono_split",
    "upsert_update",
    "upsert_ignore",
    "eval_metrics",
    "directional_accuracy",
    "ridge_predict",
    "stream_daily",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def run(name):
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("ticks_to_candles")  # starts the engine; not measured
    times = {name: run(name) for name in HEADLINES}
    # Throughput: six indicators over all order lines as candles.
    steps = [ind.sma_step(), ind.ema_step(), ind.rsi_step(), ind.macd_step(), ind.bollinger_step(), ind.volatility_step()]
    lines = line_candles(spark, sf_dir)
    count = lines.count()
    start = time.perf_counter()
    series(lines, steps).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "indicator_rows": count,
        "indicator_rows_per_sec": round(count / seconds),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
