"""Training frames, chronological split, scaling and MLlib regressors."""

import json
import logging
import time as clock
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio
from tidemark.operators.indicators import target
from tidemark.operators.lookups import join_features
from tidemark.operators.series import with_position
from tidemark.operators.stats import directional_accuracy, error_metrics, rank_models
from tidemark.plans.features import all_features_with_target, feature_names
from tidemark.schemas import SERIES, STORED_FEATURES
from tidemark.session import BROADCAST_ROWS, scratch_dir

log = logging.getLogger(__name__)

# Machine epsilon of a double: below it a column counts as constant.
EPSILON = 2.220446049250313e-16


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def training_frame(features: DataFrame, candles: DataFrame, horizon: int = 1, **layout) -> DataFrame:
    """Stored features with their close and the close ``horizon`` rows later; complete rows only."""
    joined = join_features(features, candles).select("time", *SERIES, "close", *STORED_FEATURES)
    with_target = target(joined, horizons=(horizon,), **layout)
    return with_target.withColumnRenamed(f"target_{horizon}", "target").dropna("any")


def ml_frame(candles: DataFrame, horizon: int = 1, **layout) -> DataFrame:
    """All 52 features and ``target_h`` for complete rows."""
    complete = all_features_with_target(candles, horizon, **layout).dropna("any")
    return complete.select("time", *SERIES, *feature_names(), f"target_{horizon}")


def chronological_split(
    df: DataFrame, test_size: float = 0.2, val_size: float = 0.1, **layout
) -> DataFrame:
    """Add ``split``: the first rows of each series train, then validation, the last ones test."""
    for name, share in (("test_size", test_size), ("val_size", val_size)):
        if not 0 < share < 1:
            raise ValueError(f"{name} must lie between 0 and 1")
    if test_size + val_size >= 1:
        raise ValueError("test_size + val_size must stay below 1")
    placed = with_position(df, with_length=True, **layout)
    n, at = F.col("_length").cast("double"), F.col("_pos")
    part = (
        F.when(at < F.floor(n * (1 - test_size - val_size)), "train")
        .when(at < F.floor(n * (1 - test_size)), "val")
        .otherwise("test")
    )
    return placed.withColumn("split", part).drop("_pos", "_length")


def scaler_stats(df: DataFrame, columns, by=SERIES) -> DataFrame:
    """Mean and population deviation of the training rows of each series; constants get deviation 1."""
    train = df.where(F.col("split") == "train")
    raw = train.groupBy(*by).agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        *[F.avg(F.col(c).cast("double")).alias(f"{c}_mean") for c in columns],
        *[F.var_pop(F.col(c).cast("double")).alias(f"{c}_var") for c in columns],
    )

    def deviation(c):
        var, mean, n = F.col(f"{c}_var"), F.col(f"{c}_mean"), F.col("_n")
        noise = n * EPSILON * var + (n * mean * EPSILON) * (n * mean * EPSILON)
        return F.when(var <= noise, 1.0).otherwise(F.sqrt(var)).alias(f"{c}_std")

    return raw.select(
        *by, *[F.col(f"{c}_mean") for c in columns], *[deviation(c) for c in columns]
    )


def scale(df: DataFrame, stats: DataFrame, columns, by=SERIES) -> DataFrame:
    """Standardize ``columns`` with the statistics of the row's own series."""
    by = list(by)
    if stats.select(*by).limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        stats = F.broadcast(stats)
    scaled = {
        c: (F.col(c).cast("double") - F.col(f"{c}_mean")) / F.col(f"{c}_std") for c in columns
    }
    return (
        df.join(stats, by)
        .withColumns(scaled)
        .drop(*[f"{c}_{k}" for c in columns for k in ("mean", "std")])
    )


def _ridge(train, alpha=1.0, label="target", **kw):
    # The penalty of the closed form, in the units of MLlib's objective.
    size = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    return LinearRegression(
        solver="normal",
        standardization=False,
        regParam=alpha * size["s"] / size["n"],
        elasticNetParam=0.0,
        **kw,
    )


def _lasso(train, alpha=1.0, label="target", **kw):
    return LinearRegression(
        standardization=False, regParam=alpha, elasticNetParam=1.0, maxIter=1000, tol=1e-10, **kw
    )


def _linear(train, label="target", **kw):
    return LinearRegression(solver="normal", standardization=False, regParam=0.0, **kw)


def _forest(train, label="target", numTrees=100, maxDepth=10, seed=42, **kw):
    return RandomForestRegressor(
        numTrees=numTrees, maxDepth=maxDepth, featureSubsetStrategy="all", seed=seed, **kw
    )


def _boosted(train, label="target", maxIter=100, maxDepth=6, stepSize=0.1, seed=42, **kw):
    return GBTRegressor(maxIter=maxIter, maxDepth=maxDepth, stepSize=stepSize, seed=seed, **kw)


def _boosted_deep(train, label="target", maxDepth=8, **kw):
    return _boosted(train, label, maxDepth=maxDepth, **kw)


MODEL_TYPES = {
    "linear": _linear,
    "linear_ridge": _ridge,
    "linear_lasso": _lasso,
    "random_forest": _forest,
    "xgboost": _boosted,
    "lightgbm": _boosted_deep,
}


@dataclass
class Trained:
    name: str
    model: PipelineModel
    features: tuple
    metadata: dict
    metrics: dict = field(default_factory=dict)


def create_model(kind: str, train: DataFrame, label="target", **params):
    if kind not in MODEL_TYPES:
        raise ValueError(f"unknown model type {kind!r}; choose from {sorted(MODEL_TYPES)}")
    return MODEL_TYPES[kind](
        train, label=label, featuresCol="features", labelCol=label, predictionCol="prediction", **params
    )


def fit(kind: str, df: DataFrame, columns, label="target", **params) -> Trained:
    """Train one model on the rows of the training split (all rows without a split)."""
    train = df.where(F.col("split") == "train") if "split" in df.columns else df
    train = train.withColumn(label, F.col(label).cast("double"))
    estimator = create_model(kind, train, label, **params)
    if "split" in df.columns and isinstance(estimator, GBTRegressor):
        # Boosting stops where the validation rows no longer improve.
        held = F.col("split") == "val"
        both = df.where(held | (F.col("split") == "train")).withColumn(label, F.col(label).cast("double"))
        if not both.where(held).isEmpty():
            train = both.withColumn("_validation", held)
            estimator.setValidationIndicatorCol("_validation")
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    start = clock.monotonic()
    model = Pipeline(stages=[assembler, estimator]).fit(train)
    meta = {
        "model_type": kind,
        "params": params,
        "n_features": len(columns),
        "training_time": clock.monotonic() - start,
    }
    return Trained(kind, model, tuple(columns), meta)


def predict(trained: Trained, df: DataFrame, label="target") -> DataFrame:
    """Key, split, actual and predicted value of every row."""
    scored = trained.model.transform(df)
    split = ["split"] if "split" in df.columns else []
    return scored.select(
        F.lit(trained.name).alias("model_name"),
        *SERIES,
        "time",
        *split,
        F.col(label).cast("double").alias("actual"),
        F.col("prediction").alias("predicted"),
    )


def evaluate(predictions: DataFrame, by=("model_name", "split"), **layout) -> DataFrame:
    """Error measures and directional accuracy per model and split.

    Directions are compared inside each series; the accuracy of a group is the
    share over all its moves.
    """
    by = list(by)
    errors = error_metrics(predictions, by)
    series = list(dict.fromkeys([*by, *SERIES]))
    per_series = directional_accuracy(predictions, series, time="time", **layout)
    moves = predictions.groupBy(*series).agg((F.count(F.lit(1)) - 1).alias("_moves"))
    shares = (
        per_series.join(moves, series)
        .groupBy(*by)
        .agg(
            F.coalesce(
                ratio(F.sum(F.col("directional_accuracy") * F.col("_moves")), F.sum("_moves")),
                F.lit(0.0),
            ).alias("directional_accuracy")
        )
    )
    return errors.join(shares, by)


def train_models(
    df: DataFrame,
    columns,
    kinds=("linear", "random_forest", "xgboost"),
    label="target",
    params: dict | None = None,
    on_error: str = "raise",
):
    """Train several models on one materialized frame.

    Returns the trained models and the predictions of all of them. If a model
    fails the others are still trained; then the failures are raised together, or
    with ``on_error="skip"`` logged and left out.
    """
    frame = materialize(df, "training")
    trained, scored, failed = {}, None, {}
    for kind in kinds:
        try:
            fitted = fit(kind, frame, columns, label, **(params or {}).get(kind, {}))
        except Exception as e:
            log.exception("training %s failed", kind)
            failed[kind] = e
            continue
        trained[kind] = fitted
        rows = predict(fitted, frame, label)
        scored = rows if scored is None else scored.unionByName(rows)
    if failed and on_error == "raise":
        raise RuntimeError(f"training failed: {', '.join(failed)}; trained: {', '.join(trained) or 'none'}") from next(iter(failed.values()))
    return trained, scored


def compare_models(predictions: DataFrame, split: str = "val", **layout) -> DataFrame:
    """Models ranked by rmse on one split; the best is flagged."""
    metrics = evaluate(predictions.where(F.col("split") == split), **layout)
    return rank_models(metrics, by=("split",))


def feature_importance(trained: Trained, spark, top: int = 15) -> DataFrame | None:
    """The ``top`` features by importance; None for a model without importances."""
    stage = trained.model.stages[-1]
    if not hasattr(stage, "featureImportances"):
        return None
    pairs = [(n, float(v)) for n, v in zip(trained.features, stage.featureImportances.toArray())]
    return (
        spark.createDataFrame(pairs, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(top)
    )


def confidence_band(predictions: DataFrame, level: float = 0.95, predicted="predicted", rmse="rmse"):
    """Prediction plus and minus 1.96 rmse, or 5 % of the prediction where no rmse is known."""
    if level != 0.95:
        raise ValueError("only the 95 % band is defined")
    p = F.col(predicted)
    margin = p * 0.05
    if rmse in predictions.columns:
        margin = F.coalesce(F.col(rmse) * 1.96, margin)
    return predictions.withColumns({"confidence_lower": p - margin, "confidence_upper": p + margin})


def model_performance(predictions: DataFrame, evaluation_date, by=("model_name", *SERIES), time="target_time",
                      model_version: str = "1.0", train_samples: int = 0, **layout):
    """Rows to append to the performance table: measures per model and series at a date.

    ``train_samples`` is the number of rows the models were fitted on, 0 for a rule that needs no fit.
    """
    by = list(by)
    errors = error_metrics(predictions, by)
    moves = directional_accuracy(predictions, by, time=time, **layout)
    return errors.join(moves, by).select(
        *by,
        F.lit(evaluation_date).cast("date").alias("evaluation_date"),
        F.col("rmse").cast("decimal(20,8)").alias("rmse"),
        F.col("mae").cast("decimal(20,8)").alias("mae"),
        F.col("mape").cast("decimal(10,4)").alias("mape"),
        F.col("r2").cast("decimal(10,6)").alias("r2_score"),
        F.col("directional_accuracy").cast("decimal(10,4)").alias("directional_accuracy"),
        F.col("samples").cast("int").alias("test_samples"),
        F.lit(model_version).alias("model_version"),
        F.lit(train_samples).cast("int").alias("train_samples"),
    )


def save_model(trained: Trained, path: str, spark, scaler: DataFrame | None = None) -> None:
    """Model, scaler statistics, metadata and metrics under one folder."""
    trained.model.write().overwrite().save(f"{path}/model")
    info = {"name": trained.name, "features": list(trained.features), "metadata": trained.metadata}
    rows = [(json.dumps(info), json.dumps(trained.metrics))]
    spark.createDataFrame(rows, "info string, metrics string").coalesce(1).write.mode(
        "overwrite"
    ).json(f"{path}/metadata")
    if scaler is not None:
        scaler.write.mode("overwrite").parquet(f"{path}/scaler")


def load_model(path: str, spark) -> Trained:
    row = spark.read.schema("info string, metrics string").json(f"{path}/metadata").first()
    info = json.loads(row["info"])
    return Trained(
        info["name"],
        PipelineModel.load(f"{path}/model"),
        tuple(info["features"]),
        info["metadata"],
        json.loads(row["metrics"]),
    )


def load_scaler(path: str, spark) -> DataFrame:
    return spark.read.parquet(f"{path}/scaler")
