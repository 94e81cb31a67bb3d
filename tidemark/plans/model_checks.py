"""Facts that a fitted model must satisfy exactly, whatever the solver: optimality conditions and bounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.learning import Trained


def _sums(scored: DataFrame, columns) -> dict:
    """Sums over the training rows: residuals, their products with the features, squares."""
    e = F.col("target").cast("double") - F.col("prediction")
    row = (
        scored.where("split = 'train'")
        .select(e.alias("_e"), F.col("target").cast("double").alias("_y"), *columns)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("_e").alias("e"),
            F.sum(F.col("_e") * F.col("_e")).alias("ee"),
            F.var_pop("_y").alias("vy"),
            *[F.sum(F.col("_e") * F.col(c)).alias(f"ex_{c}") for c in columns],
            *[F.sum(F.col(c) * F.col(c)).alias(f"xx_{c}") for c in columns],
        )
        .first()
    )
    return row.asDict()


def linear_facts(trained: Trained, frame: DataFrame, alpha: float = 0.0, l1: bool = False, tolerance: float = 1e-4) -> dict:
    """Conditions of the least squares optimum, with an L2 penalty ``alpha`` or an L1 penalty.

    Residuals sum to 0. Their product with a feature is 0 (least squares), ``alpha * w`` (ridge), or over
    the number of rows ``alpha * sign(w)`` where w is not 0 and at most ``alpha`` else (lasso).
    """
    sums = _sums(trained.model.transform(frame), trained.features)
    weights = dict(zip(trained.features, trained.model.stages[-1].coefficients.toArray()))
    n = sums["n"]
    met = []
    for c, w in weights.items():
        scale = (sums[f"xx_{c}"] * n * sums["vy"]) ** 0.5 or 1.0
        got = sums[f"ex_{c}"]
        if not l1:
            met.append(abs(got - alpha * w) <= tolerance * scale)
        elif w:
            met.append(abs(got / n - alpha * (1 if w > 0 else -1)) <= tolerance * scale / n)
        else:
            met.append(abs(got / n) <= alpha + tolerance * scale / n)
    return {
        "residuals_sum_to_zero": abs(sums["e"]) <= tolerance * (n * n * sums["vy"]) ** 0.5,
        "optimal": all(met),
    }


def tree_facts(trained: Trained, frame: DataFrame, bounded: bool = True) -> dict:
    """Better than the mean on the training rows; means of targets (a forest) stay within their range."""
    scored = trained.model.transform(frame)
    sums = _sums(scored, [])
    facts = {"better_than_mean": sums["ee"] < sums["n"] * sums["vy"]}
    if bounded:
        y = F.col("target").cast("double")
        low, high = scored.where("split = 'train'").agg(F.min(y), F.max(y)).first()
        slack = 1e-9 * max(abs(low), abs(high))
        outside = scored.where((F.col("prediction") < low - slack) | (F.col("prediction") > high + slack))
        facts["within_range"] = outside.isEmpty()
    return facts
