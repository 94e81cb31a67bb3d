"""Every registered query: a callable over (session, table folder) per operator.

Double columns are rounded to six places, so that results compare across engines. A
small constant moves values off the half-way points first: prices have two decimals, so
their means often lie exactly half-way, where the last bit would decide.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import bars, lookups, quality, stats, tables
from tidemark.operators import indicators as ind
from tidemark.plans import features, learning, market, model_checks
from tidemark.schemas import SERIES, STORED_FEATURES
from tidemark.session import broadcast_if_small, configure, scratch_dir
from tidemark.sources import candles as files
from tidemark.sources import chunks
from tidemark.streaming import jobs

QUERIES = {}
NUDGE = 3.3e-9
KEY = ["time", "symbol", "timeframe"]


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to six places (and no negative zero), decimals to double, times without a zone."""

    def plain(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double") + NUDGE, places) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        return c.alias(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(fn):
    """Register ``fn(spark, sf_dir)`` under its own name."""

    def registered(spark, sf_dir):
        configure(spark)
        return rounded(fn(spark, sf_dir))

    QUERIES[fn.__name__] = registered
    return fn


def _fixed_time(text):
    return F.lit(text).cast("timestamp_ntz")


# --- bars -------------------------------------------------------------------


@query
def daily_stats(spark, sf):
    return bars.daily_stats(market.candles(spark, sf))


@query
def daily_latest50(spark, sf):
    return bars.daily_latest(market.candles_two_frames(spark, sf), 50)


@query
def resample_4h(spark, sf):
    return bars.resample(market.candles(spark, sf), "4h")


@query
def resample_1w(spark, sf):
    return bars.resample(market.order_candles(spark, sf), "1w")


@query
def resample_1month(spark, sf):
    return bars.resample(market.order_candles(spark, sf), "1M")


@query
def ticks_to_candles(spark, sf):
    return market.candles(spark, sf)


# --- summaries --------------------------------------------------------------


@query
def table_stats(spark, sf):
    return stats.table_stats(market.candles(spark, sf))


@query
def count_per_symbol(spark, sf):
    return stats.count_per_symbol(market.candles(spark, sf))


@query
def distinct_symbols(spark, sf):
    return stats.distinct_symbols(market.candles(spark, sf))


@query
def symbol_stats(spark, sf):
    return stats.symbol_stats(market.candles(spark, sf))


@query
def summary(spark, sf):
    return stats.summary(market.candles(spark, sf))


@query
def collection_summary(spark, sf):
    return stats.collection_summary(market.candles(spark, sf))


@query
def collection_report(spark, sf):
    report = stats.collection_report(market.candles(spark, sf))
    return report.withColumn("symbols", F.array_join("symbols", ","))


@query
def returns_stats(spark, sf):
    return stats.returns_stats(market.candles(spark, sf))


@query
def describe(spark, sf):
    return stats.describe(market.candles(spark, sf))


@query
def returns_hist(spark, sf):
    return stats.returns_histogram(market.candles(spark, sf))


@query
def returns_corr(spark, sf):
    return stats.returns_correlation(market.candles(spark, sf))


@query
def pivot_close(spark, sf):
    return stats.pivot_close(market.candles(spark, sf))


@query
def gaps(spark, sf):
    # Hours of all symbols, and months with every fourth one missing.
    monthly = bars.resample(market.order_candles(spark, sf), "1M").where(F.month("time") % 4 != 2)
    return stats.gaps(market.candles(spark, sf).unionByName(monthly))


@query
def outliers(spark, sf):
    return stats.outliers(market.candles(spark, sf))


# --- lookups ----------------------------------------------------------------


@query
def scan_ohlcv(spark, sf):
    return lookups.scan(market.candles_two_frames(spark, sf), "1h")


@query
def scan_limit(spark, sf):
    return lookups.scan_limit(market.candles_two_frames(spark, sf), "click", 25)


@query
def latest_prices(spark, sf):
    return lookups.latest_prices(market.candles_two_frames(spark, sf))


@query
def asof_price(spark, sf):
    return lookups.asof_price(market.candles_two_frames(spark, sf))


@query
def performance_24h(spark, sf):
    return lookups.performance_24h(market.candles_two_frames(spark, sf))


@query
def asof_many(spark, sf):
    """The hourly close known at every event, and 90 minutes before it."""
    made = market.candles(spark, sf)
    late = market.plus_seconds(F.col("time"), F.lit(-5400))
    asked = market.ticks(spark, sf).select("symbol", F.lit("1h").alias("timeframe"), F.explode(F.array("time", late)).alias("at"), F.col("id").alias("request"))
    return lookups.asof_many(made, asked, chunk_rows=50)


@query
def market_summary(spark, sf):
    return lookups.market_summary(market.candles(spark, sf))


@query
def available_symbols(spark, sf):
    ticker = lookups.tickers(market.candles(spark, sf))
    return lookups.available_symbols(ticker, quote="i", min_volume_24h=1000.0)


@query
def top_symbols(spark, sf):
    ticker = lookups.tickers(market.candles(spark, sf))
    return lookups.top_symbols(ticker, top_n=3, quote="", min_volume_24h=1.0)


# --- window indicators ------------------------------------------------------


def _columns(df, *names):
    return df.select(*KEY, *names)


@query
def sma(spark, sf):
    return _columns(ind.sma(market.candles(spark, sf)), "sma_7", "sma_25", "sma_99")


@query
def sma_partial(spark, sf):
    windows = {"sma_7": 7, "sma_25": 25, "sma_99": 99}
    return _columns(ind.partial_means(market.candles(spark, sf), "close", windows), *windows)


@query
def volume_sma24(spark, sf):
    made = ind.partial_means(market.candles(spark, sf), "volume", {"volume_sma_24": 24})
    return _columns(made, "volume", "volume_sma_24")


@query
def ema(spark, sf):
    return _columns(ind.exponential_average(market.candles(spark, sf)), "ema_7", "ema_25", "ema_99")


@query
def ema_orders(spark, sf):
    made = ind.exponential_average(market.order_candles(spark, sf))
    return rounded(_columns(made, "ema_7", "ema_25", "ema_99"), 4)


@query
def rsi(spark, sf):
    return _columns(ind.rsi(market.candles(spark, sf)), "rsi_14")


@query
def ema_missing(spark, sf):
    """Averages of closes of which some are NULL and some NaN."""
    hour, day = F.hour("time"), F.dayofmonth("time")
    close = F.when((hour == 3) & (day % 5 == 3), F.lit(None)).when((hour == 7) & (day % 5 == 4), F.lit(float("nan"))).otherwise(F.col("close"))
    return _columns(ind.exponential_average(market.candles(spark, sf).withColumn("close", close)), "ema_7", "ema_25", "ema_99")


@query
def macd(spark, sf):
    made = ind.macd(market.candles(spark, sf))
    return _columns(made, "macd", "macd_signal", "macd_histogram")


@query
def bollinger(spark, sf):
    made = ind.bollinger(market.candles(spark, sf))
    return _columns(made, "bb_upper", "bb_middle", "bb_lower", "bb_width")


@query
def atr(spark, sf):
    return _columns(ind.atr(market.candles(spark, sf)), "atr_14")


@query
def stochastic(spark, sf):
    return _columns(ind.stochastic(market.candles(spark, sf)), "stoch_k", "stoch_d")


@query
def returns(spark, sf):
    made = ind.price_features(market.candles(spark, sf))
    return _columns(made, "returns", "log_returns")


@query
def cumulative_returns(spark, sf):
    return _columns(ind.price_features(market.candles(spark, sf)), "cumulative_returns")


@query
def price_features(spark, sf):
    made = ind.candle_shape(market.candles(spark, sf))
    return _columns(made, "price_change", "price_change_pct", "daily_range", "daily_range_pct")


@query
def volume_features(spark, sf):
    made = ind.volume_features(market.candles(spark, sf))
    return _columns(made, "volume_sma_7", "volume_sma_25", "volume_ratio")


@query
def vwap(spark, sf):
    return _columns(ind.volume_features(market.candles(spark, sf)), "vwap")


@query
def volatility(spark, sf):
    names = [f"{p}volatility_{w}" for p in ("", "price_") for w in (7, 14, 30)]
    return _columns(ind.volatility_features(market.candles(spark, sf)), *names)


@query
def lags(spark, sf):
    names = [f"close_lag_{k}" for k in (1, 3, 6, 12, 24)]
    return _columns(ind.lag_features(market.candles(spark, sf)), *names)


@query
def target(spark, sf):
    return _columns(ind.target(market.candles(spark, sf)), "close", "target_1")


@query
def multi_target(spark, sf):
    made = ind.target(market.candles(spark, sf), horizons=(1, 6, 24, 168))
    return _columns(made, "target_1", "target_6", "target_24", "target_168")


@query
def returns_pct(spark, sf):
    made = ind.returns_pct(market.candles(spark, sf))
    return _columns(made, "close", "prev_close", "returns_pct")


@query
def temporal(spark, sf):
    made = ind.temporal_features(market.candles(spark, sf).select(*KEY))
    return made


# --- features ---------------------------------------------------------------


@query
def all_features(spark, sf):
    made = features.all_features(market.candles(spark, sf))
    return _columns(made, *features.feature_names())


@query
def features_store(spark, sf):
    return features.refresh_features(market.candles(spark, sf))


@query
def null_threshold(spark, sf):
    made = features.all_features(market.candles(spark, sf)).withColumn(
        "volatility_24h", F.col("volatility_7")
    )
    return quality.null_share_filter(made, STORED_FEATURES).select(*KEY, "sma_7", "rsi_14")


@query
def dropna_any(spark, sf):
    made = ind.returns_pct(market.candles(spark, sf))
    return _columns(made, "prev_close", "returns_pct").dropna("any")


@query
def feature_coverage(spark, sf):
    return stats.feature_coverage(features.refresh_features(market.candles(spark, sf)))


@query
def feature_run_stats(spark, sf):
    base = market.candles(spark, sf)
    return features.feature_run_stats(base, features.refresh_features(base))


@query
def feature_overflow(spark, sf):
    # One series has prices that no store type holds; the others are stored all the same.
    huge = F.when((F.col("symbol") == "click") & (F.hour("time") == 9), 1e9).otherwise(F.col("close"))
    base = market.candles(spark, sf).withColumn("close", huge).withColumn("high", F.greatest("high", "close"))
    made = features.all_features(base)
    kept, aside = features.stored_features(made), features.overflowing_features(made)
    return features.feature_run_stats(base, kept, aside)


@query
def features_join(spark, sf):
    base = market.candles(spark, sf)
    joined = lookups.join_features(features.refresh_features(base), base)
    return joined.select(*KEY, "close", *STORED_FEATURES)


# --- quality ----------------------------------------------------------------


@query
def check_prices(spark, sf):
    rejected = quality.violations(market.dirty_candles(spark, sf), quality.price_rule())
    return rejected.select(*KEY, "open", "high", "low", "close")


@query
def check_volume(spark, sf):
    rejected = quality.violations(market.dirty_candles(spark, sf), quality.volume_rule())
    return rejected.select(*KEY, "volume")


@query
def check_not_null(spark, sf):
    holes = market.candles(spark, sf).withColumn(
        "close", F.when(F.hour("time") != 7, F.col("close"))
    )
    rule = quality.not_null_rule(*quality.CANDLE_COLUMNS)
    return quality.violations(holes, rule).select(*KEY, "open", "close")


@query
def check_unique(spark, sf):
    return quality.duplicate_keys(market.dirty_candles(spark, sf), KEY)


@query
def check_reasons(spark, sf):
    _, rejected = quality.split_valid(market.dirty_candles(spark, sf), quality.candle_rules())
    return rejected.select(*KEY, F.array_join("reasons", ",").alias("reasons"))


@query
def check_fk(spark, sf):
    kept = lookups.known_symbols(market.candles(spark, sf), market.metadata(spark, sf))
    return kept.select(*KEY, "close")


@query
def fk_orphans(spark, sf):
    orphans = lookups.unknown_symbols(market.candles(spark, sf), market.metadata(spark, sf))
    return orphans.select(*KEY, "close")


@query
def check_enum(spark, sf):
    valid, _ = quality.split_valid(market.signals(spark, sf), quality.signal_rules())
    return valid


# --- tables -----------------------------------------------------------------


@query
def typed_candles(spark, sf):
    hour = F.hour("time")
    raw = market.candles(spark, sf).withColumns(
        {
            "quote_volume": F.when(hour != 2, F.col("quote_volume")),
            "trades_count": F.when(hour != 4, F.col("trades_count")),
        }
    )
    return tables.typed_candles(raw)


@query
def normalize_candles(spark, sf):
    base = market.candles(spark, sf).select(
        F.unix_millis(F.col("time").cast("timestamp")).alias("ms"),
        *SERIES,
        "open",
        "high",
        "low",
        "close",
        "volume",
        F.unix_millis(F.col("time").cast("timestamp")).alias("seq"),
    )
    again = base.where(F.pmod(F.col("ms") / 3600000, F.lit(6)) == 0).withColumns(
        {"close": F.col("close") * 2, "seq": F.col("seq") + 10_000_000_000_000}
    )
    return tables.normalize_candles(base.unionByName(again), "seq")


@query
def upsert_ignore(spark, sf):
    stored, arriving = market.existing_and_incoming(spark, sf)
    arriving = arriving.unionByName(arriving.withColumn("open", F.col("open") + 1))  # copies: the smaller row counts
    return tables.insert_ignore(stored, arriving).select(*KEY, "open", "close")


@query
def upsert_update(spark, sf):
    stored, arriving = market.existing_and_incoming(spark, sf)
    stored = stored.withColumn("created_at", _fixed_time("2024-02-01"))
    arriving = arriving.withColumn("created_at", _fixed_time("2024-02-02"))
    arriving = arriving.unionByName(arriving.withColumn("open", F.col("open") + 1))  # copies: the larger row counts
    merged = tables.upsert(stored, arriving)
    return merged.select(*KEY, "open", "close", "created_at")


@query
def upsert_stored(spark, sf):
    """A delivery merged into a stored table: only the days it touches are read and written."""
    stored, arriving = market.existing_and_incoming(spark, sf)
    target = scratch_dir(spark, "table")
    files.write_by_day(stored.withColumn("created_at", _fixed_time("2024-02-01")), target)
    arriving = arriving.withColumn("created_at", _fixed_time("2024-02-02"))
    chunks.merge_chunks(target, arriving.unionByName(arriving.withColumn("open", F.col("open") + 1)))
    return spark.read.parquet(target).select(*KEY, "open", "close", "created_at")


@query
def upsert_touch(spark, sf):
    stored = market.metadata(spark, sf).withColumn("updated_at", _fixed_time("2024-01-01"))
    arriving = (
        stats.distinct_symbols(market.candles(spark, sf))
        .where(F.col("symbol").isin("click", "error"))
        .select(
            "symbol",
            F.upper("symbol").alias("base_currency"),
            F.lit("EUR").alias("quote_currency"),
            F.lit("binance").alias("exchange"),
            F.lit(False).alias("is_active"),
            _fixed_time("2024-01-05").alias("updated_at"),
        )
    )
    touch = {"updated_at": _fixed_time("2024-03-01")}
    return tables.upsert(stored, arriving, keys=["symbol"], keep=(), touch=touch)


@query
def ensure_symbols(spark, sf):
    return tables.ensure_symbols(market.metadata(spark, sf), market.candles(spark, sf))


@query
def retention(spark, sf):
    as_of = _fixed_time("2025-01-15 00:00:00")
    return tables.retain(market.candles(spark, sf), as_of, months=12).select(*KEY, "close")


@query
def retention_stored(spark, sf):
    """Old chunks go as folders; only the chunk at the border is rewritten."""
    target = scratch_dir(spark, "table")
    files.write_by_day(market.candles(spark, sf), target, days=7)
    chunks.drop_older(spark, target, _fixed_time("2025-01-15 00:00:00"), months=12, days=7)
    return spark.read.parquet(target).select(*KEY, "close")


@query
def cascade_stored(spark, sf):
    """Only chunks that hold a deleted symbol are rewritten."""
    target = scratch_dir(spark, "table")
    files.write_by_day(market.candles(spark, sf), target)
    chunks.drop_symbols(target, market.metadata(spark, sf).where(F.col("symbol") == "view"))
    return spark.read.parquet(target).select(*KEY, "close")


@query
def daily_refresh(spark, sf):
    """Daily bars refreshed by three deliveries, the last one back in time."""
    made, target = market.candles(spark, sf), scratch_dir(spark, "bars")
    hour = F.hour("time") % 3
    for part in (1, 2, 0):
        chunks.refresh_bars(target, made.where(hour == part))
    return bars.finished_bars(spark.read.parquet(target))


@query
def cascade_delete(spark, sf):
    deleted = market.metadata(spark, sf).where(F.col("symbol") == "view")
    return tables.cascade_delete(market.candles(spark, sf), deleted).select(*KEY, "close")


# --- learning ---------------------------------------------------------------


def _training(spark, sf):
    # The features are stored and read back, as a training job would find them.
    base = market.candles(spark, sf)
    stored = learning.materialize(features.refresh_features(base), "features")
    return learning.training_frame(stored, base)


def _prepared(spark, sf):
    split = learning.chronological_split(_training(spark, sf))
    return learning.scale(split, learning.scaler_stats(split, STORED_FEATURES), STORED_FEATURES)


@query
def training_frame(spark, sf):
    return _training(spark, sf)


@query
def ml_frame(spark, sf):
    return learning.ml_frame(market.candles(spark, sf))


@query
def chrono_split(spark, sf):
    return learning.chronological_split(market.candles(spark, sf)).select(*KEY, "split")


@query
def scale_features(spark, sf):
    return _prepared(spark, sf).select(*KEY, *STORED_FEATURES, "target", "split")


def _scored(spark, sf):
    return lookups.score_predictions(
        market.naive_predictions(spark, sf), market.candles(spark, sf)
    ).withColumnsRenamed({"actual_price": "actual", "predicted_price": "predicted"})


@query
def score_predictions(spark, sf):
    scored = lookups.score_predictions(
        market.naive_predictions(spark, sf), market.candles(spark, sf)
    )
    return scored.select(
        "model_name",
        "symbol",
        "prediction_time",
        "target_time",
        "predicted_price",
        "actual_price",
        "absolute_error",
        "percentage_error",
    )


@query
def eval_metrics(spark, sf):
    return stats.error_metrics(_scored(spark, sf))


@query
def directional_accuracy(spark, sf):
    return stats.directional_accuracy(_scored(spark, sf))


@query
def model_ranking(spark, sf):
    return stats.rank_models(stats.error_metrics(_scored(spark, sf)))


@query
def model_performance(spark, sf):
    return learning.model_performance(_scored(spark, sf), "2024-02-01")


@query
def mape_alerts(spark, sf):
    return stats.mape_alerts(stats.error_metrics(_scored(spark, sf)), 200.0)


@query
def confidence_band(spark, sf):
    scored = _scored(spark, sf)
    rmse = stats.error_metrics(scored).where(F.col("model_name") == "last_close")
    rmse = rmse.select("model_name", "symbol", "rmse")
    known = scored.join(broadcast_if_small(rmse), ["model_name", "symbol"], "left")
    banded = learning.confidence_band(known)
    return banded.select(
        "model_name",
        "symbol",
        "prediction_time",
        "predicted",
        "confidence_lower",
        "confidence_upper",
    )


# --- models -----------------------------------------------------------------


def _fitted(spark, sf, kind):
    frame = learning.materialize(_prepared(spark, sf), "scaled")
    return learning.fit(kind, frame, STORED_FEATURES), frame


def _predicted(spark, sf, kind, facts):
    """Every row with its actual value, whether it has a finite prediction, and the facts of the fit."""
    trained, frame = _fitted(spark, sf, kind)
    rows = learning.predict(trained, frame)
    p = F.col("predicted")
    rows = rows.withColumn("finite", p.isNotNull() & ~F.isnan(p) & (F.abs(p) < 1e300)).drop("predicted")
    return rows.withColumns({n: F.lit(bool(v)) for n, v in facts(trained, frame).items()})


@query
def lr_predict(spark, sf):
    return _predicted(spark, sf, "linear", model_checks.linear_facts)


@query
def ridge_predict(spark, sf):
    return _predicted(spark, sf, "linear_ridge", lambda t, f: model_checks.linear_facts(t, f, alpha=1.0))


@query
def lasso_predict(spark, sf):
    return _predicted(spark, sf, "linear_lasso", lambda t, f: model_checks.linear_facts(t, f, alpha=1.0, l1=True))


@query
def rf_predict(spark, sf):
    return _predicted(spark, sf, "random_forest", model_checks.tree_facts)


@query
def gbt_predict(spark, sf):
    return _predicted(spark, sf, "xgboost", lambda t, f: model_checks.tree_facts(t, f, bounded=False))


# The fits themselves, beside the facts that SQL can state about them: every row with its predicted value.


def _predictions(spark, sf, kind):
    return learning.predict(*_fitted(spark, sf, kind))


@query
def lr_predictions(spark, sf):
    return _predictions(spark, sf, "linear")


@query
def ridge_predictions(spark, sf):
    return _predictions(spark, sf, "linear_ridge")


@query
def lasso_predictions(spark, sf):
    return _predictions(spark, sf, "linear_lasso")


@query
def rf_predictions(spark, sf):
    return _predictions(spark, sf, "random_forest")


@query
def gbt_predictions(spark, sf):
    return _predictions(spark, sf, "xgboost")


@query
def feature_importances(spark, sf):
    """All features with their importance in the forest."""
    trained, _ = _fitted(spark, sf, "random_forest")
    return learning.feature_importance(trained, spark, len(STORED_FEATURES))


@query
def feature_importance(spark, sf):
    """All features by rank of importance; the importances are not negative, descend, and sum to 1."""
    trained, _ = _fitted(spark, sf, "random_forest")
    every = learning.feature_importance(trained, spark, len(STORED_FEATURES)).collect()
    top = learning.feature_importance(trained, spark, 15).collect()
    whole = abs(sum(r["importance"] for r in every) - 1) < 1e-9
    falling = all(a["importance"] >= b["importance"] >= 0 for a, b in zip(every, every[1:]))
    rows = [(r["feature"], whole, falling, top == every[:15]) for r in every]
    return spark.createDataFrame(rows, "feature string, sums_to_one boolean, descending boolean, top_is_prefix boolean")


def _compared(spark, sf):
    """All model types, fitted with their default parameters and ranked."""
    _, scored = learning.train_models(_prepared(spark, sf), STORED_FEATURES, tuple(learning.MODEL_TYPES))
    return learning.compare_models(scored, "val")


@query
def model_measures(spark, sf):
    """The measures and the rank of every model."""
    return _compared(spark, sf)


@query
def model_comparison(spark, sf):
    ranked = _compared(spark, sf)
    place = W.partitionBy("split").orderBy("rmse", "model_name")
    first = F.row_number().over(place) == 1
    return ranked.select("model_name", "split", "samples", (first == F.col("is_best")).alias("best_is_first"))


@query
def model_roundtrip(spark, sf):
    """Every row, and whether the saved and loaded model predicts the same."""
    frame = learning.materialize(_prepared(spark, sf), "scaled")
    path = scratch_dir(spark, "model")
    trained = learning.fit("linear", frame, STORED_FEATURES)
    learning.save_model(trained, path, spark)
    before = learning.predict(trained, frame)
    after = learning.predict(learning.load_model(path, spark), frame).withColumnRenamed("predicted", "again")
    both = before.join(after.select(*KEY, "again"), KEY)
    return both.select("model_name", *KEY, "split", "actual", (F.col("predicted") == F.col("again")).alias("same"))


# --- files ------------------------------------------------------------------


@query
def src_csv_candles(spark, sf):
    base = market.candles(spark, sf).withColumnRenamed("time", "timestamp")
    path = scratch_dir(spark, "csv")
    base.write.option("header", True).csv(path)
    rows, _ = files.read_candle_csv(spark, path, columns=base.columns)
    return tables.typed_candles(rows)


def _mixed_folder(spark, sf):
    """Candle files with a plain, a reordered and a quoted header, and files that cannot be used."""
    base = market.candles(spark, sf).withColumnRenamed("time", "timestamp")
    path = scratch_dir(spark, "csv")
    wide = base
    narrow = base.select("symbol", *[c for c in base.columns if c not in ("symbol", "quote_volume", "trades_count")])
    day = F.dayofmonth("timestamp")
    wide.where(day <= 10).write.option("header", True).csv(path)
    narrow.where((day > 10) & (day <= 20)).write.mode("append").option("header", True).csv(path)
    quoted = wide.where(day > 20).withColumnsRenamed({"open": " open", "close": "close "})
    quoted.write.mode("append").option("header", True).option("quoteAll", True).csv(path)
    lacking = base.where(day == 1).select("timestamp", "open", "symbol")
    lacking.coalesce(1).write.mode("append").option("header", True).csv(path)
    text = narrow.where(day == 2).withColumn("close", F.lit("none"))
    text.write.mode("append").option("header", True).csv(path)
    return path


@query
def src_csv_dir(spark, sf):
    rows, _ = files.read_candle_csv(spark, _mixed_folder(spark, sf))
    return tables.typed_candles(rows)


@query
def csv_quarantine(spark, sf):
    _, bad = files.read_candle_csv(spark, _mixed_folder(spark, sf))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


@query
def sink_csv(spark, sf):
    path = scratch_dir(spark, "csv")
    files.write_candle_csv(market.candles(spark, sf), path)
    made = market.candles(spark, sf).schema.add("symbol_safe", "string").add("frame", "string")
    return spark.read.schema(made).option("header", True).csv(path)


@query
def sink_report(spark, sf):
    path = scratch_dir(spark, "report")
    files.write_report(market.candles(spark, sf), path)
    schema = "total_symbols bigint, symbols array<string>, total_candles bigint"
    return spark.read.schema(schema).json(path).withColumn("symbols", F.array_join("symbols", ","))


@query
def sink_summary(spark, sf):
    path = scratch_dir(spark, "summary")
    made = stats.summary(market.candles(spark, sf))
    files.write_summary(made, path)
    return spark.read.schema(made.schema).option("header", True).csv(path)


@query
def sink_by_day(spark, sf):
    path = scratch_dir(spark, "days")
    files.write_by_day(market.candles(spark, sf), path)
    return spark.read.parquet(path).select(*KEY, "close", "volume", "day")


@query
def sink_by_week(spark, sf):
    path = scratch_dir(spark, "weeks")
    files.write_by_day(market.naive_predictions(spark, sf), path, "prediction_time", days=7)
    return spark.read.parquet(path).select("model_name", "symbol", "prediction_time", "predicted_price", "day")


# --- streams ----------------------------------------------------------------


def _candle_stream(spark, sf, source=market.candles, order=(0, 1, 2, 3)):
    """Candles as a folder of one file per week, written in the ``order`` of weeks, read back as a stream of one file per batch."""
    folder = scratch_dir(spark, "feed")
    made = source(spark, sf).withColumn("time", F.col("time").cast("timestamp"))
    ends = [_fixed_time(f"2024-01-{day:02d}").cast("timestamp") for day in (8, 15, 22)]
    weeks = [F.col("time") < ends[0], *[(F.col("time") >= a) & (F.col("time") < b) for a, b in zip(ends, ends[1:])], F.col("time") >= ends[-1]]
    for week in (weeks[i] for i in order):
        made.where(week).coalesce(1).write.mode("append").parquet(folder)
    return jobs.read_stream(spark, folder, made.schema, files_per_batch=1)


@query
def stream_ingest(spark, sf):
    stream = jobs.ingest(_candle_stream(spark, sf, market.dirty_candles))
    return jobs.run_to_end(stream).select(*KEY, "close")


@query
def stream_daily(spark, sf):
    # Update mode delivers the last day too, whose end the watermark never passes.
    return jobs.run_updates(jobs.daily_bars(_candle_stream(spark, sf)), ("day", *SERIES), "day")


@query
def stream_daily_late(spark, sf):
    """Bars of a stream whose first week arrives after the second one: it is late and kept aside, one row per day and series."""
    folder = scratch_dir(spark, "bars")
    stream = _candle_stream(spark, sf, order=(1, 0, 2, 3))
    jobs.run_to_end(stream, foreach=jobs.daily_bars_by_batch(folder))
    made, late = jobs.read_bars(spark, folder, batches=4)
    aside = late.groupBy(F.date_trunc("day", "time").alias("day"), *SERIES).agg(F.count(F.lit(1)).alias("late_count"))
    return made.join(aside, ["day", *SERIES], "full_outer")


@query
def stream_latest(spark, sf):
    stream = jobs.latest(_candle_stream(spark, sf, market.candles_two_frames))
    return jobs.run_updates(stream, SERIES, "time")


@query
def stream_ema(spark, sf):
    # Small blocks: every batch is laid out in several.
    folder = scratch_dir(spark, "averages")
    jobs.run_to_end(_candle_stream(spark, sf), foreach=jobs.averages_by_batch(folder, chunk_rows=50))
    return jobs.read_averages(spark, folder)


@query
def stream_ema_batches(spark, sf):
    folder = scratch_dir(spark, "averages")
    jobs.run_to_end(_candle_stream(spark, sf), foreach=jobs.averages_by_batch(folder))
    return jobs.read_averages(spark, folder)


@query
def stream_fk(spark, sf):
    stream = jobs.known_only(_candle_stream(spark, sf), market.metadata(spark, sf))
    return jobs.run_to_end(stream).select(*KEY, "close")


@query
def stream_upsert(spark, sf):
    stored, arriving = market.existing_and_incoming(spark, sf)
    target = scratch_dir(spark, "table")
    files.write_by_day(stored.withColumn("time", F.col("time").cast("timestamp")), target)
    twice = arriving.unionByName(arriving.withColumn("open", F.col("open") - 1))  # copies count once
    stream = _candle_stream(spark, sf, lambda *_: twice)
    jobs.run_to_end(stream, foreach=jobs.upsert_days(target))
    return spark.read.parquet(target).select(*KEY, "open", "close")
