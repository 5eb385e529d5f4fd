"""Queries on models: each candidate is trained once per version of the tables with its full grid, when a query first asks for it.

SQL cannot train a model.  The checks state what must hold of any right one:
which rows and settings appear, and how the figures hang together.
"""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.constants import FOLDS
from orelake.functions.columns import hash_number  # noqa: F401 - a test compares rows in this order
from orelake.operators import descent, ml, sampling
from orelake.storage import new_path, shared_folder
from orelake.workload import views as v
from orelake.workload.profiles import TRAIN_SQL
from orelake.workload.registry import query

_RUN = ("run-1", datetime(2001, 1, 1, tzinfo=timezone.utc))
# The feature that the flag is a product of is left out, or every model is perfect.
_FEATURES = [f for f in v.FEATURES if f != "l_quantity"]
# Models are fitted on all training rows: this is Spark's largest limit, and no query applies it.
FIT_ROWS = 2**31 - 1
# Training rows of a task, and tasks of all fits that run side by side.
ROWS_A_TASK = 250_000
TASKS = 8
# The descent runs by itself, so its rows are spread further, up to all cores.
ROWS_A_STEP = 5_000
_FITTED: dict[tuple, ml.Trained] = {}
_CANDIDATES = {c.__name__: c for c in (ml.logistic, ml.random_forest, ml.boosting)}


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return ml.training_set(v.silver_modules(spark, folder), "is_buggy", _FEATURES, v.MODULE_KEYS)


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All training rows, written once for all candidates, and the whole holdout."""
    train, test = sampling.split(_rows(spark, folder), v.MODULE_KEYS, "label")
    return v.written(spark, folder, "fit-rows", lambda: train), test


def _layout(train: DataFrame) -> dict[str, int]:
    """Partitions of the training rows, and how many fits run side by side: more rows take more tasks a fit."""
    partitions = max(1, -(-train.count() // ROWS_A_TASK))
    return {"partitions": partitions, "parallelism": max(1, TASKS // partitions)}


def _one(spark: SparkSession, folder: str, candidate: str) -> ml.Trained:
    """A candidate with its grid and five stratified folds; kept in the shared folder per version of the tables."""
    version = v.version_of(spark, folder, "lineitem", "part")
    key = (spark.sparkContext.applicationId, folder, version, candidate)
    if key not in _FITTED:
        made = _CANDIDATES[candidate]()
        grid = json.dumps([dict(g) for g in made.grid], sort_keys=True)
        mark = hashlib.sha256(repr((folder, version, candidate, grid, "all", FOLDS, _FEATURES)).encode()).hexdigest()
        place = f"{shared_folder(spark)}/orelake/models/{mark}"
        found = ml.kept_models(spark, place)
        if found is None:
            train, test = _split(spark, folder)
            found = ml.train_candidates(train, test, _FEATURES, v.MODULE_KEYS, [made], FOLDS, **_layout(train))
            ml.keep_models(found, place)
        _FITTED[key] = found[0]
    return _FITTED[key]


def _trained(spark: SparkSession, folder: str) -> list[ml.Trained]:
    """All three candidates."""
    return [_one(spark, folder, name) for name in _CANDIDATES]


def _champion(spark: SparkSession, folder: str) -> ml.Trained:
    return ml.champion_of(_trained(spark, folder))


def _setting(spark: SparkSession, folder: str, candidate: str) -> DataFrame:
    """Whether the chosen setting is one of the grid, and whether the figures are sound."""
    grid = [json.dumps(dict(s), sort_keys=True) for s in _CANDIDATES[candidate]().grid]
    row = ml.score_table(spark, [_one(spark, folder, candidate)], *_RUN)
    figures = ("auc_train", "auc_test", "f1_test", "accuracy_test", "precision_test", "recall_test")
    return row.select(
        "run_id", "model_name", "framework",
        F.lit(len(grid)).alias("settings"),
        F.col("best_params").isin(grid).alias("setting_from_grid"),
        sum((F.col(c).between(0, 1).cast("int") for c in figures), F.lit(0)).alias("figures_in_range"),
        (F.col("auc_test") > 0.5).alias("better_than_chance"),
    )


def _setting_sql(name: str, settings: int) -> str:
    return f"""SELECT 'run-1' AS run_id, '{name}' AS model_name, 'spark.ml' AS framework, CAST({settings} AS INTEGER) AS settings,
                      true AS setting_from_grid, CAST(6 AS INTEGER) AS figures_in_range, true AS better_than_chance"""


@query(_setting_sql("LogisticRegression", 3))
def ml_logistic(spark: SparkSession, folder: str) -> DataFrame:
    return _setting(spark, folder, "logistic")


@query(
    """SELECT learning_rate, epochs, true AS auc_above_chance, CAST(1 AS BIGINT) AS chosen, true AS chosen_has_highest_auc
       FROM (VALUES (0.001::DOUBLE, 50), (0.001, 100), (0.0005, 100)) AS grid(learning_rate, epochs)"""
)
def ml_logistic_sgd(spark: SparkSession, folder: str) -> DataFrame:
    """The learning-rate grid by mini-batch descent: every setting, and whether one with the best score is chosen."""
    train, test = _split(spark, folder)
    spread = min(-(-train.count() // ROWS_A_STEP), spark.sparkContext.defaultParallelism)
    _, _, tried = descent.train(
        train, test, _FEATURES, v.MODULE_KEYS, folds=FOLDS, partitions=max(1, spread, _layout(train)["partitions"])
    )
    best = tried.agg(F.max("auc").alias("best"), F.count_if("chosen").alias("chosen"), F.max(F.when(F.col("chosen"), F.col("auc"))).alias("own"))
    one = best.select(F.struct("*")).scalar()
    return tried.select("learning_rate", "epochs", (F.col("auc") > 0.5).alias("auc_above_chance"), one.alias("_b")).select(
        "learning_rate", "epochs", "auc_above_chance", "_b.chosen", (F.col("_b.own") == F.col("_b.best")).alias("chosen_has_highest_auc")
    )


@query(_setting_sql("RandomForest", 6))
def ml_random_forest(spark: SparkSession, folder: str) -> DataFrame:
    return _setting(spark, folder, "random_forest")


@query(_setting_sql("GradientBoosting", 4))
def ml_gbt(spark: SparkSession, folder: str) -> DataFrame:
    return _setting(spark, folder, "boosting")


@query(
    """SELECT CAST(3 AS BIGINT) AS models, CAST(3 AS BIGINT) AS names, CAST(1 AS BIGINT) AS champions,
              true AS champion_has_highest_auc, true AS all_above_chance"""
)
def ml_champion_scores(spark: SparkSession, folder: str) -> DataFrame:
    table = ml.score_table(spark, _trained(spark, folder), *_RUN)
    return table.agg(
        F.count(F.lit(1)).alias("models"),
        F.count_distinct("model_name").alias("names"),
        F.count_if("is_champion").alias("champions"),
        (F.max("auc_test") == F.max(F.when(F.col("is_champion"), F.col("auc_test")))).alias("champion_has_highest_auc"),
        F.every(F.col("auc_test") > 0.5).alias("all_above_chance"),
    )


_HOLDOUT = f"SELECT name, _project, _version, is_buggy FROM m WHERE NOT ({TRAIN_SQL})"


@query(
    v.with_views(
        "m",
        """SELECT 'run-1' AS run_id, name AS module_name, _project AS project, _version AS version, is_buggy AS label,
                  true AS probability_in_range, true AS prediction_agrees FROM h""",
        h=_HOLDOUT,
    )
)
def ml_predictions(spark: SparkSession, folder: str) -> DataFrame:
    table = ml.prediction_table(_champion(spark, folder), *_RUN)
    p = F.col("prob_buggy")
    return table.select(
        "run_id", "module_name", "project", "version", "label",
        p.between(0, 1).alias("probability_in_range"),
        (F.col("prediction") == (p > 0.5).cast("int")).alias("prediction_agrees"),
    )


@query(
    v.with_views(
        "m",
        """SELECT CAST(4 AS BIGINT) AS cells, CAST(count(*) FILTER (is_buggy = 1) AS BIGINT) AS positives,
                  CAST(count(*) FILTER (is_buggy = 0) AS BIGINT) AS negatives FROM h""",
        h=_HOLDOUT,
    )
)
def ml_confusion(spark: SparkSession, folder: str) -> DataFrame:
    table = ml.confusion_table(_champion(spark, folder), *_RUN)
    of = lambda *cells: F.sum(F.when(F.col("cell").isin(*cells), F.col("count")).otherwise(0)).cast("long")
    return table.agg(
        F.count_distinct("cell").alias("cells"), of("TP", "FN").alias("positives"), of("TN", "FP").alias("negatives")
    )


@query(
    f"""SELECT CAST({len(_FEATURES)} AS BIGINT) AS features, CAST({len(_FEATURES)} AS BIGINT) AS names,
               CAST({len(_FEATURES)} AS BIGINT) AS ranks, true AS ranked_by_importance"""
)
def ml_importance(spark: SparkSession, folder: str) -> DataFrame:
    table = ml.importance_table(spark, _champion(spark, folder), _FEATURES, *_RUN)
    ordered = F.array_sort(F.collect_list(F.struct("rank", (-F.col("importance")).alias("down"))))
    falling = ordered.getField("down")
    return table.agg(
        F.count(F.lit(1)).alias("features"),
        F.count_distinct(F.when(F.col("feature").isin(*_FEATURES), F.col("feature"))).alias("names"),
        F.count_distinct(F.when(F.col("rank").between(1, len(_FEATURES)), F.col("rank"))).alias("ranks"),
        (F.array_sort(falling) == falling).alias("ranked_by_importance"),
    )


@query(v.with_views("m", "SELECT name, _project, _version, is_buggy AS label, true AS same_score FROM m"))
def ml_saved_model(spark: SparkSession, folder: str) -> DataFrame:
    """Save the champion, load it and score all rows, not only the holdout."""
    champion = _champion(spark, folder)
    saved = ml.save_champion(spark, champion, _FEATURES, new_path(spark, "models"), *_RUN)
    rows = _rows(spark, folder)
    before = champion.model.transform(rows).select("*", F.col("probability").alias("first_probability"))
    before = before.drop("raw_features", "features", "rawPrediction", "probability", "prediction")
    both = ml.score_rows(ml.load_champion(saved), before, [*v.MODULE_KEYS, "first_probability"])
    first = ml.vector_to_array("first_probability")[1]
    return both.select(*v.MODULE_KEYS, "label", (F.abs(F.col("prob") - first) < 1e-9).alias("same_score"))
