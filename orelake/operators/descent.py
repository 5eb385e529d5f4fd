"""Logistic regression by mini-batch gradient descent with a learning rate.

Every step is one aggregate over the rows of a batch; the driver holds the weights
only.  Batches are dealt by hash of the row key, so they do not depend on file layout.
Models that differ in their rate or in the rows they leave out (folds) go through the
steps together: one pass gives the gradients of all.  A longer run passes through the
shorter one, so the weights after fewer epochs are kept on the way.

Steps are v = momentum * v + g, w = w - rate * v with the mean gradient g of the batch
over the model's rows.  A batch without rows for a model leaves it as it is.  Rows with
a missing label or feature are left out (``complete_rows``); an empty table gives the
starting weights, 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.constants import FOLDS, SEED
from orelake.functions.columns import hash_number
from orelake.operators.clean import complete_rows
from orelake.operators.evaluate import auc, weighted_scores
from orelake.operators.sampling import balanced_folds
from orelake.operators.scaling import zscore
from orelake.storage import write_out

MOMENTUM = 0.9
BATCHES = 2

# The settings that are tried: learning rate and epochs.
GRID = ({"learningRate": 0.001, "epochs": 50}, {"learningRate": 0.001, "epochs": 100}, {"learningRate": 0.0005, "epochs": 100})


@dataclass(frozen=True)
class Learner:
    """One of the models trained side by side: its rate, and the fold it does not see (None: it sees all)."""

    rate: float
    without: int | None = None


@dataclass
class Descent:
    """A fitted model: weights of the scaled features and, last, the intercept."""

    weights: list[float]
    params: dict[str, Any]
    scores: dict[str, float] | None = None

    def probability(self, features: str = "features") -> Column:
        return F.expr(_probability(f"`{features}`", self.weights))


def _number(x: float) -> str:
    return f"{x!r}D" if math.isfinite(x) else f"double('{x}')"


def _probability(features: str, weights: Sequence[float]) -> str:
    """SQL of the probability of class 1; one text per model keeps a step's planning short."""
    *inner, start = map(_number, map(float, weights))
    dot = f"aggregate(zip_with({features}, array({', '.join(inner)}), (a, b) -> a * b), {start}, (total, x) -> total + x)"
    return f"1D / (1D + exp(-{dot}))"


def with_batches(df: DataFrame, keys: Sequence[str], batches: int = BATCHES, seed: int = SEED) -> DataFrame:
    return df.withColumn("batch", (hash_number(seed + 2, *keys) % batches).cast("int"))


def descend(
    rows: DataFrame,
    n_features: int,
    learners: Sequence[Learner],
    epochs: int,
    kept: Sequence[int] = (),
    batches: int = BATCHES,
    momentum: float = MOMENTUM,
) -> dict[tuple[Learner, int], list[float]]:
    """Weights of every learner after the ``kept`` numbers of epochs and after the last.

    ``rows`` holds label, features (array), batch and, where a learner leaves a fold
    out, fold.  It is read once per step: keep it where reading is cheap.
    """
    size = n_features + 1
    weights = [[0.0] * size for _ in learners]
    speed = [[0.0] * size for _ in learners]
    found = {}
    by_batch = [rows.filter(F.col("batch") == b) for b in range(batches)]
    for epoch in range(1, epochs + 1):
        for batch in by_batch:
            gaps = []
            for i, (learner, own) in enumerate(zip(learners, weights)):
                seen = "true" if learner.without is None else f"fold <> {learner.without}"
                gaps.append(f"CASE WHEN {seen} THEN {_probability('features', own)} - label END AS gap{i}")
            inputs = [*[f"features[{j}]" for j in range(n_features)], "1D"]
            totals = [
                f"array(double(count(gap{i})), {', '.join(f'sum(gap{i} * {x})' for x in inputs)}) AS m{i}" for i in range(len(learners))
            ]
            sums = batch.selectExpr("features", *gaps).selectExpr(*totals).first()
            for i, learner in enumerate(learners):
                n, *total = sums[i]
                if not n:
                    continue
                speed[i] = [momentum * v + g / n for v, g in zip(speed[i], total)]
                weights[i] = [w - learner.rate * v for w, v in zip(weights[i], speed[i])]
        if epoch in kept or epoch == epochs:
            found.update({(learner, epoch): list(own) for learner, own in zip(learners, weights)})
    return found


def _scored(rows: DataFrame, models: Sequence[tuple[str, Sequence[float], Column]]) -> DataFrame:
    """Rows (model_name, label, prediction, prob), one per model that scores the row."""
    one_each = [
        F.when(where, F.struct(F.lit(name).alias("model_name"), F.expr(_probability("features", weights)).alias("prob")))
        for name, weights, where in models
    ]
    scored = rows.select(F.col("label").cast("int").alias("label"), F.explode(F.array_compact(F.array(*one_each))).alias("m"))
    return scored.select("m.model_name", "label", (F.col("m.prob") > 0.5).cast("int").alias("prediction"), "m.prob")


def train(
    train_rows: DataFrame,
    test_rows: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    label: str = "label",
    grid: Sequence[dict[str, Any]] = GRID,
    folds: int = FOLDS,
    batches: int = BATCHES,
    momentum: float = MOMENTUM,
    seed: int = SEED,
    partitions: int | None = None,
) -> tuple[Descent, DataFrame, DataFrame]:
    """The setting with the best mean AUC over the folds, its scored test rows, and the AUC of every setting.

    All folds, rates and the final models of all settings are trained in one run of steps.
    """
    train_rows, test_rows = (complete_rows(r, [label, *features]) for r in (train_rows, test_rows))
    folded = balanced_folds(train_rows, keys, label, folds, seed + 1)
    batched = with_batches(zscore(folded, train_rows, features), keys, batches, seed)
    rows = write_out(batched.select(F.col(label).cast("double").alias("label"), "features", "fold", "batch"), "descent")
    rows = (rows if partitions is None else rows.repartition(partitions)).persist(StorageLevel.MEMORY_AND_DISK)
    rates = sorted({g["learningRate"] for g in grid})
    learners = [Learner(rate, fold) for rate in rates for fold in (*range(folds), None)]
    epochs = sorted({g["epochs"] for g in grid})
    try:
        found = descend(rows, len(features), learners, epochs[-1], epochs, batches, momentum)
        models = [
            (f"{i}/{fold}", found[Learner(g["learningRate"], fold), g["epochs"]], F.col("fold") == fold)
            for i, g in enumerate(grid)
            for fold in range(folds)
        ]
        of_fold = auc(_scored(rows, models), ["model_name"]).select(F.split("model_name", "/")[0].cast("int").alias("setting"), "auc")
        areas = {r.setting: r.auc for r in of_fold.groupBy("setting").agg(F.avg("auc").alias("auc")).collect()}
        best = max(range(len(grid)), key=lambda i: (areas.get(i) or 0.0, -i))
        weights = found[Learner(grid[best]["learningRate"]), grid[best]["epochs"]]
        model = Descent(weights, dict(grid[best]))
        ready = zscore(test_rows, train_rows, features)
        prob = model.probability()
        scored = ready.select(*keys, F.col(label).cast("int").alias("label"), (prob > 0.5).cast("int").alias("prediction"), prob.alias("prob"))
        scored = write_out(scored, "scored")
        figures = weighted_scores(scored).first()
        model.scores = {k: figures[k] for k in ("f1", "accuracy", "precision", "recall")}
        model.scores["auc_test"] = auc(scored).first().auc
        model.scores["auc_train"] = auc(_scored(rows, [("all", weights, F.lit(True))])).first().auc
    finally:
        rows.unpersist()
    spark = train_rows.sparkSession
    tried = [(g["learningRate"], g["epochs"], areas.get(i), i == best) for i, g in enumerate(grid)]
    return model, scored, spark.createDataFrame(tried, "learning_rate double, epochs int, auc double, chosen boolean")
