"""Silver code metrics to model result tables and a saved champion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from orelake.constants import FEATURES, FOLDS, SEED, TRAIN_SHARE
from orelake.operators import ml, sampling
from orelake.plans import lake as names
from orelake.plans.lake import Lake, Run
from orelake.sinks.tables import append_table, save_table

KEYS = ["name", "_project", "_version"]


def build(
    spark: SparkSession,
    lake: Lake,
    run: Run,
    candidates: Sequence[ml.Candidate] | None = None,
    folds: int = FOLDS,
    parallelism: int = 2,
) -> str:
    """Train, compare, write four tables and save the champion; returns its folder."""
    candidates = candidates or [ml.logistic(), ml.random_forest(), ml.boosting()]
    rows = ml.training_set(spark.table(f"{lake.silver}.{names.CODE_CLEAN}"), "is_buggy", FEATURES, KEYS)
    train, test = sampling.split(rows, KEYS, "label", TRAIN_SHARE, SEED)
    trained = ml.train_candidates(train, test, FEATURES, KEYS, candidates, folds, SEED, parallelism)
    champion = ml.champion_of(trained)

    append_table(
        ml.score_table(spark, trained, run.run_id, run.ts),
        f"{lake.gold}.{names.MODEL_SCORES}",
        comment="Model scores, one row per run and model.",
    )
    save_table(
        ml.prediction_table(champion, run.run_id, run.ts),
        f"{lake.gold}.{names.PREDICTIONS}",
        comment="Holdout predictions of the champion.",
    )
    save_table(
        ml.confusion_table(champion, run.run_id, run.ts),
        f"{lake.gold}.{names.CONFUSION}",
        comment="Confusion cells of the champion on the holdout.",
    )
    save_table(
        ml.importance_table(spark, champion, FEATURES, run.run_id, run.ts),
        f"{lake.gold}.{names.IMPORTANCE}",
        comment="Features of the champion by importance.",
    )
    return ml.save_champion(spark, champion, FEATURES, lake.artifacts, run.run_id, run.ts)
