"""The feature matrix of a candle table and the stored feature table."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import indicators as ind
from tidemark.operators.quality import nan_to_null, null_share_filter
from tidemark.operators.series import run
from tidemark.operators.stats import rows
from tidemark.operators.tables import upsert
from tidemark.schemas import CANDLE_KEY, FEATURE_STORE_TYPES, SERIES, STORED_FEATURES
from tidemark.sources.chunks import merge_chunks


def feature_steps() -> list:
    return [
        ind.returns_step(),
        ind.cumulative_returns_step(),
        ind.candle_shape_step(),
        ind.sma_step(),
        ind.ema_step(),
        ind.rsi_step(hold=None),
        ind.macd_step(),
        ind.bollinger_step(),
        ind.atr_step(),
        ind.stochastic_step(),
        ind.volume_step(),
        ind.volatility_step(),
        ind.calendar_step(),
        ind.lag_step(),
    ]


def feature_names() -> list:
    """The 52 derived columns, in output order."""
    return [n for step in feature_steps() for n in step.adds]


def all_features(candles: DataFrame, **layout) -> DataFrame:
    """Every derived column for every series in one layout of the candles."""
    return run(candles, feature_steps(), **layout)


def all_features_with_target(candles: DataFrame, horizon: int = 1, **layout) -> DataFrame:
    return run(candles, [*feature_steps(), ind.target_step(horizons=(horizon,))], **layout)


def _store_candidates(features: DataFrame) -> DataFrame:
    """Rows that are at most half NULL, NaN counted as NULL. ``volatility_24h`` is filled with ``volatility_7``."""
    chosen = features.where(F.col("time").isNotNull()).select(
        *CANDLE_KEY,
        *[
            F.col("volatility_7" if n == "volatility_24h" else n).cast("double").alias(n)
            for n in STORED_FEATURES
        ],
    )
    return null_share_filter(nan_to_null(chosen, STORED_FEATURES), STORED_FEATURES)


def stored_features(features: DataFrame) -> DataFrame:
    """Rows of the features table: 19 columns in store types. Rows that don't fit are left out (overflowing_features).

    One condition per column: the optimizer rewrites a condition once for every subset of the casts that it shares
    with the columns selected, so a single one over all 19 exhausts the driver.
    """
    fits = [F.col(n).isNull() | F.col(n).try_cast(t).isNotNull() for n, t in FEATURE_STORE_TYPES.items()]
    return _store_candidates(features).where(reduce(and_, fits)).select(
        *CANDLE_KEY, *[F.col(n).try_cast(t).alias(n) for n, t in FEATURE_STORE_TYPES.items()]
    )


def overflowing_features(features: DataFrame) -> DataFrame:
    """Key and columns of the rows that don't fit the store types."""
    broken = [
        F.when(F.col(n).isNotNull() & F.col(n).try_cast(t).isNull(), F.lit(n))
        for n, t in FEATURE_STORE_TYPES.items()
    ]
    overflow = F.array_compact(F.array(*broken)).alias("overflow")
    return _store_candidates(features).select(*CANDLE_KEY, overflow).where(F.size("overflow") > 0)


def refresh_features(
    candles: DataFrame, existing: DataFrame | None = None, timeframe: str | None = None, **layout
) -> DataFrame:
    """Content of the features table after computing all series and upserting them."""
    if timeframe is not None:
        candles = candles.where(F.col("timeframe") == timeframe)
    fresh = stored_features(all_features(candles, **layout))
    return fresh if existing is None else upsert(existing, fresh)


def store_features(candles: DataFrame, target: str, timeframe: str | None = None, days: int = 1, **layout) -> None:
    """Compute all series and upsert them into the stored features table ``target``: only the chunks they touch are read."""
    merge_chunks(target, refresh_features(candles, timeframe=timeframe, **layout), days=days)


def feature_run_stats(candles: DataFrame, stored: DataFrame, overflow: DataFrame | None = None) -> DataFrame:
    """Candle rows, stored feature rows and rows set aside of each series."""
    read = candles.groupBy(*SERIES).agg(rows().alias("rows"))
    kept = stored.groupBy(*SERIES).agg(rows().alias("features_stored"))
    out = read.join(kept, list(SERIES), "left").withColumn(
        "features_stored", F.coalesce("features_stored", F.lit(0))
    )
    if overflow is None:
        return out
    aside = overflow.groupBy(*SERIES).agg(rows().alias("features_overflowing"))
    return out.join(aside, list(SERIES), "left").withColumn(
        "features_overflowing", F.coalesce("features_overflowing", F.lit(0))
    )
