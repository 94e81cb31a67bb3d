import numpy as np
import pandas as pd
import pytest
from frames import to_spark, walk
from pyspark.sql import functions as F

from tidemark.operators.lookups import join_features
from tidemark.plans import features, learning
from tidemark.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def linear_frame(spark):
    """Ten normal columns, y = 2*f0 + 3*f1 + noise, in time order."""
    rng = np.random.default_rng(42)
    x = rng.normal(size=(400, 10))
    y = 2 * x[:, 0] + 3 * x[:, 1] + 0.1 * rng.normal(size=400)
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(10)])
    pdf["target"] = y
    pdf["time"] = pd.date_range("2024-01-01", periods=400, freq="1h")
    pdf["symbol"], pdf["timeframe"] = "A", "1h"
    frame = learning.chronological_split(to_spark(spark, pdf))
    return pdf, learning.materialize(frame, "linear")


COLUMNS = [f"f{i}" for i in range(10)]


def test_split_is_chronological(linear_frame):
    _, frame = linear_frame
    parts = {r["split"]: (r["n"], r["a"], r["b"]) for r in frame.groupBy("split").agg(
        F.count("*").alias("n"), F.min("time").alias("a"), F.max("time").alias("b")).collect()}
    cut, end = int(400 * (1 - 0.2 - 0.1)), int(400 * (1 - 0.2))
    assert (parts["train"][0], parts["val"][0], parts["test"][0]) == (cut, end - cut, 400 - end)
    assert parts["train"][2] < parts["val"][1] and parts["val"][2] < parts["test"][1]


@pytest.mark.parametrize("test_size,val_size", [(0, 0.1), (1, 0.1), (0.2, 0), (0.6, 0.5)])
def test_split_rejects_bad_shares(linear_frame, test_size, val_size):
    with pytest.raises(ValueError):
        learning.chronological_split(linear_frame[1], test_size, val_size)


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    pdf = walk("A", 100)
    pdf["flat"] = 0.1
    frame = learning.chronological_split(to_spark(spark, pdf))
    stats = learning.scaler_stats(frame, ["close", "flat"])
    got = learning.scale(frame, stats, ["close", "flat"]).orderBy("time").toPandas()
    train = pdf["close"][:70]
    np.testing.assert_allclose(got["close"], (pdf["close"] - train.mean()) / train.std(ddof=0), rtol=1e-9)
    assert got["flat"].abs().max() < 1e-12


def _closed_form(pdf, alpha):
    x, y = pdf[COLUMNS].to_numpy()[:280], pdf["target"].to_numpy()[:280]
    xc, yc = x - x.mean(axis=0), y - y.mean()
    beta = np.linalg.solve(xc.T @ xc + alpha * np.eye(10), xc.T @ yc)
    return pdf[COLUMNS].to_numpy() @ beta + y.mean() - x.mean(axis=0) @ beta


@pytest.mark.parametrize("kind,alpha", [("linear", 0.0), ("linear_ridge", 1.0), ("linear_ridge", 25.0)])
def test_linear_models_equal_closed_form(linear_frame, kind, alpha):
    pdf, frame = linear_frame
    params = {"alpha": alpha} if kind == "linear_ridge" else {}
    got = learning.predict(learning.fit(kind, frame, COLUMNS, **params), frame).orderBy("time").toPandas()
    np.testing.assert_allclose(got["predicted"], _closed_form(pdf, alpha), rtol=1e-7, atol=1e-8)


def test_lasso_equals_coordinate_descent(linear_frame):
    pdf, frame = linear_frame
    x, y = pdf[COLUMNS].to_numpy()[:280], pdf["target"].to_numpy()[:280]
    xc, yc, n = x - x.mean(axis=0), y - y.mean(), 280
    beta = np.zeros(10)
    for _ in range(500):
        for j in range(10):
            rest = xc[:, j] @ (yc - xc @ beta + xc[:, j] * beta[j]) / n
            beta[j] = np.sign(rest) * max(abs(rest) - 1.0, 0) / (xc[:, j] @ xc[:, j] / n)
    want = pdf[COLUMNS].to_numpy() @ beta + y.mean() - x.mean(axis=0) @ beta
    got = learning.predict(learning.fit("linear_lasso", frame, COLUMNS), frame).orderBy("time").toPandas()
    np.testing.assert_allclose(got["predicted"], want, rtol=1e-5, atol=1e-6)


def test_several_models_and_comparison(linear_frame, spark):
    _, frame = linear_frame
    small = {"random_forest": {"numTrees": 5, "maxDepth": 4}, "xgboost": {"maxIter": 3}}
    trained, scored = learning.train_models(
        frame, COLUMNS, ("linear", "random_forest", "xgboost", "no_such"), params=small, on_error="skip"
    )
    with pytest.raises(RuntimeError, match="no_such"):
        learning.train_models(frame, COLUMNS, ("linear", "no_such"))
    assert set(trained) == {"linear", "random_forest", "xgboost"}
    table = learning.compare_models(scored, "test").collect()
    assert [r["model_name"] for r in table if r["is_best"]] == ["linear"]
    linear = next(r for r in table if r["model_name"] == "linear")
    assert linear["r2"] > 0.99 and linear["directional_accuracy"] > 90
    top = learning.feature_importance(trained["random_forest"], spark, 3).collect()
    assert len(top) == 3 and top[0]["feature"] == "f1"
    assert learning.feature_importance(trained["linear"], spark) is None


def test_deep_boosting_and_unknown_kind(linear_frame):
    _, frame = linear_frame
    assert learning.fit("lightgbm", frame, COLUMNS, maxIter=2, maxDepth=3).name == "lightgbm"
    with pytest.raises(ValueError, match="unknown model"):
        learning.create_model("nothing", frame)


def test_save_and_load(linear_frame, spark, tmp_path):
    _, frame = linear_frame
    trained = learning.fit("linear", frame, COLUMNS)
    trained.metrics = {"rmse": 0.5}
    scaler = learning.scaler_stats(frame, COLUMNS)
    learning.save_model(trained, str(tmp_path), spark, scaler)
    back = learning.load_model(str(tmp_path), spark)
    assert back.metrics == {"rmse": 0.5} and back.features == tuple(COLUMNS)
    assert learning.load_scaler(str(tmp_path), spark).count() == 1
    a = learning.predict(trained, frame).orderBy("time").toPandas()["predicted"]
    b = learning.predict(back, frame).orderBy("time").toPandas()["predicted"]
    np.testing.assert_array_equal(a, b)


def test_training_frame_keeps_complete_rows(spark):
    base = to_spark(spark, walk("A", 150))
    stored = features.refresh_features(base)
    frame = learning.training_frame(stored, base, horizon=3)
    assert frame.count() == 150 - 98 - 3
    assert join_features(stored, base).count() == 150 - 6


def test_plan_of_the_training_frame_stays_small(spark):
    base = to_spark(spark, walk("A", 150))
    frame = learning.training_frame(features.refresh_features(base), base)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 400_000
    assert max(map(len, plan.splitlines())) < 30_000


def test_confidence_band(spark):
    frame = spark.createDataFrame([(100.0, 2.0), (100.0, None)], "predicted double, rmse double")
    got = [(r["confidence_lower"], r["confidence_upper"]) for r in learning.confidence_band(frame).collect()]
    assert got == [(pytest.approx(96.08), pytest.approx(103.92)), (95.0, 105.0)]
    with pytest.raises(ValueError):
        learning.confidence_band(frame, 0.9)


def test_models_are_compared_with_default_fits_and_measures(spark, sf_dir, monkeypatch):
    given, fit = {}, learning.fit

    def recorded(kind, df, columns, label="target", **params):
        given[kind] = params
        return fit(kind, df, columns, label, **params)

    monkeypatch.setattr(learning, "fit", recorded)
    rows = QUERIES["model_measures"](spark, sf_dir).collect()
    assert given == {kind: {} for kind in learning.MODEL_TYPES}
    assert {r.model_name for r in rows} == set(learning.MODEL_TYPES)
    assert all(r.rmse > 0 and r.mae > 0 and r.r2 is not None for r in rows)
    best = [r for r in rows if r.is_best]
    assert len(best) == 1 and best[0].rmse == min(r.rmse for r in rows)
    predicted = QUERIES["lr_predictions"](spark, sf_dir).toPandas()
    held = predicted[predicted["split"] == "val"]
    rmse = float(np.sqrt(((held["predicted"] - held["actual"]) ** 2).mean()))
    assert rmse == pytest.approx(next(r.rmse for r in rows if r.model_name == "linear"), rel=1e-6)
