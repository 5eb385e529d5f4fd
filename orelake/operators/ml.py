"""Training, comparing, scoring and keeping classifiers with ``pyspark.ml``.

Data stays in Spark from split to prediction table; the driver sees scores,
parameters and one importance per feature.

Ensembles are compared in stages: the settings of a grid that differ in the
number of trees only share one fit per fold, whose first trees are scored as the
smaller models (``prefix``).  Fits of different folds and settings run side by side.

A forest on many rows is grown some trees at a time (``GROWN_AT_ONCE``).  While settings
are compared, the trees' votes are added to the held-out rows and the trees let go; only
the chosen forest is held whole, on the driver as any model of ``pyspark.ml``.
"""

from __future__ import annotations

import json
import time
import warnings
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import SparkContext, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from orelake.constants import FOLDS, SEED
from orelake.operators.clean import complete_rows
from orelake.operators.evaluate import auc, confusion_cells, pick_champion, rank_features, weighted_scores
from orelake.operators.ranking import merge_groups
from orelake.operators.sampling import balanced_folds
from orelake.schemas import CONFUSION, IMPORTANCE, MODEL_SCORES, PREDICTIONS
from orelake.storage import release, shared_folder, write_out

FRAMEWORK = "spark.ml"
# Training rows times trees that one fit of a forest grows: its tasks hold two numbers for each.
GROWN_AT_ONCE = 4_000_000
# Between the seeds of a forest's parts; more than the partitions, whose numbers Spark adds to a seed.
_NEXT_SEED = 1_000_003


@dataclass(frozen=True)
class Candidate:
    """A classifier with the settings to try; ``size`` names the parameter that counts an ensemble's trees."""

    name: str
    estimator: Estimator
    grid: Sequence[Mapping[str, Any]] = ({},)
    size: str | None = None


@dataclass
class Trained:
    """A fitted candidate: the whole pipeline, its setting and its scored rows."""

    name: str
    model: PipelineModel
    best_params: dict[str, Any]
    seconds: float
    scored_test: DataFrame | None = None
    scores: dict[str, float] = field(default_factory=dict)


def logistic(grid: Sequence[Mapping[str, Any]] | None = None) -> Candidate:
    grid = grid or [{"regParam": 0.0, "maxIter": 50}, {"regParam": 0.0, "maxIter": 100}, {"regParam": 0.01, "maxIter": 100}]
    return Candidate("LogisticRegression", LogisticRegression(standardization=False), grid)


def random_forest(grid: Sequence[Mapping[str, Any]] | None = None, seed: int = SEED) -> Candidate:
    """Depth 30 is the deepest tree Spark grows and stands for unlimited.

    Rows keep the node they have reached, or every pass sends all trees to the tasks and walks them from the root.
    """
    grid = grid or [{"numTrees": n, "maxDepth": d} for n in (50, 100) for d in (5, 10, 30)]
    return Candidate("RandomForest", RandomForestClassifier(seed=seed, cacheNodeIds=True), grid, "numTrees")


def boosting(grid: Sequence[Mapping[str, Any]] | None = None, seed: int = SEED) -> Candidate:
    grid = grid or [{"maxIter": n, "maxDepth": d, "stepSize": 0.1} for n in (50, 100) for d in (3, 5)]
    return Candidate("GradientBoosting", GBTClassifier(seed=seed), grid, "maxIter")


def training_set(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Label, features as doubles and keys; rows with a missing value are left out."""
    rest = [k for k in keys if k not in features]
    chosen = df.select(
        F.col(label).cast("int").alias("label"), *[F.col(f).cast("double").alias(f) for f in features], *rest
    )
    return complete_rows(chosen, ["label", *features])


def fit_features(train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Vector and z-score steps, fitted on the training rows once for all candidates."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return PipelineModel([assembler, scaler.fit(assembler.transform(train))])


def fitted(estimator: Estimator, df: DataFrame, params: Mapping[Any, Any]) -> Model:
    """Fit a model and drop its training summary.

    The summary holds the session, which tasks cannot carry once anything was observed in it.
    """
    model = estimator.fit(df, params)
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def prefix(model: Model, size: int) -> Model:
    """The ensemble of the first ``size`` trees of a fitted one, a model like any other.

    Boosted trees are fitted one after another, so their prefix is what fewer rounds
    would have given; a forest's trees are drawn alike, so any of them are a forest.
    """
    trees = list(model._java_obj.trees())
    return model if size >= len(trees) else _of_trees(model, trees[:size])


def _of_trees(model: Model, trees: Sequence[Any]) -> Model:
    """An ensemble like ``model`` of JVM trees; boosted ones take the model's first weights.

    ``pyspark.ml`` has no public constructor for it: the one of the JVM class is called.
    """
    java, size = model._java_obj, len(trees)
    gateway = SparkContext._active_spark_context._gateway
    kind = java.getClass().getName()
    part = gateway.new_array(getattr(gateway.jvm, trees[0].getClass().getName()), size)
    for i, tree in enumerate(trees):
        part[i] = tree
    parts = [f"{model.uid}_{size}", part]
    if kind.endswith("GBTClassificationModel"):
        weights = gateway.new_array(gateway.jvm.double, size)
        for i, weight in enumerate(list(java.treeWeights())[:size]):
            weights[i] = weight
        parts.append(weights)
    made = getattr(gateway.jvm, kind)(*parts, java.numFeatures(), java.numClasses())
    settings = gateway.jvm.org.apache.spark.ml.param.ParamMap()
    settings.put(java.getParam("maxIter" if kind.endswith("GBTClassificationModel") else "numTrees"), size)
    java.copyValues(made, settings)
    return type(model)(made)


def _parts(candidate: Candidate, sizes: Sequence[int | None], rows: int) -> list[int]:
    """Numbers of trees that a forest is grown by, with a cut at each of the sizes; one or none where one fit does."""
    if not isinstance(candidate.estimator, RandomForestClassifier) or None in sizes:
        return []
    most = max(1, GROWN_AT_ONCE // max(1, rows))
    if max(sizes) <= most:
        return [max(sizes)]
    ends = sorted({*sizes, *range(most, max(sizes), most)})
    return [end - start for start, end in zip([0, *ends], ends)]


def _grown(candidate: Candidate, df: DataFrame, setting: Mapping[str, Any], parts: Sequence[int]) -> Iterator[Model]:
    """The parts of a forest, fitted one after another; the first has the seed that a single fit has."""
    estimator = candidate.estimator
    for k, trees in enumerate(parts):
        own = {**setting, candidate.size: trees, "seed": estimator.getSeed() + k * _NEXT_SEED}
        yield fitted(estimator, df, {estimator.getParam(name): v for name, v in own.items()})


def _fit_whole(candidate: Candidate, df: DataFrame, setting: Mapping[str, Any], rows: int) -> Model:
    """One model of a setting, a forest on many rows put together from its parts."""
    estimator = candidate.estimator
    parts = _parts(candidate, [setting.get(candidate.size) if candidate.size else None], rows)
    if len(parts) < 2:
        return fitted(estimator, df, {estimator.getParam(k): v for k, v in setting.items()})
    grown = list(_grown(candidate, df, setting, parts))
    return _of_trees(grown[0], [tree for model in grown for tree in model._java_obj.trees()])


def _scores_in_parts(
    candidate: Candidate,
    df: DataFrame,
    setting: Mapping[str, Any],
    parts: Sequence[int],
    members: Sequence[tuple[int, int]],
    held_out: DataFrame,
    evaluator: BinaryClassificationEvaluator,
) -> list[tuple[int, float]]:
    """Scores of a forest's sizes by the sum of its trees' votes, which the held-out rows carry from part to part."""
    by_votes = evaluator.copy({evaluator.rawPredictionCol: "votes"})
    standing = held_out.select("label", "features", F.lit(0.0).alias("votes"))
    found, trees = [], 0
    for more, model in zip(parts, _grown(candidate, df, setting, parts)):
        votes = (F.col("votes") + more * vector_to_array("probability")[1]).alias("votes")
        before, standing = standing, write_out(model.transform(standing).select("label", "features", votes), "votes")
        release(before)
        trees += more
        found += [(i, by_votes.evaluate(standing)) for i, size in members if size == trees]
    release(standing)
    return found


def _families(candidate: Candidate) -> list[tuple[dict[str, Any], list[tuple[int, int | None]]]]:
    """Settings that one fit serves: what they share (with the largest size), and each one's place in the grid and size."""
    families: dict[tuple, list[int]] = {}
    for i, setting in enumerate(candidate.grid):
        alone = candidate.size is None or candidate.size not in setting
        shared = (i,) if alone else tuple(sorted((k, repr(v)) for k, v in setting.items() if k != candidate.size))
        families.setdefault(shared, []).append(i)
    found = []
    for places in families.values():
        sizes = [candidate.grid[i].get(candidate.size) if candidate.size else None for i in places]
        largest = max(range(len(places)), key=lambda k: sizes[k] or 0)
        found.append((dict(candidate.grid[places[largest]]), list(zip(places, sizes))))
    return found


def _best_model(
    candidate: Candidate, prepared: DataFrame, folds: int, parallelism: int
) -> tuple[Model, dict[str, Any]]:
    """Choice by mean AUC over the folds; a setting that fails is left out."""
    estimator = candidate.estimator
    params = lambda setting: {estimator.getParam(k): v for k, v in setting.items()}
    settings = [dict(s) for s in candidate.grid]
    rows = prepared.count()
    if len(settings) == 1:
        return _fit_whole(candidate, prepared, settings[0], rows), settings[0]
    # numBins=0: the curve has a point per distinct score.
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)

    def fold_scores(task: tuple[tuple, int]) -> list[tuple[int, float]]:
        (setting, members), fold = task
        try:
            seen, held_out = prepared.filter(F.col("fold") != fold), prepared.filter(F.col("fold") == fold)
            parts = _parts(candidate, [n for _, n in members], rows)
            if len(parts) > 1:
                return _scores_in_parts(candidate, seen, setting, parts, members, held_out, evaluator)
            model = fitted(estimator, seen, params(setting))
            return [(i, evaluator.evaluate((prefix(model, n) if n else model).transform(held_out))) for i, n in members]
        except Exception as error:  # noqa: BLE001 - any setting may fail in its own way
            warnings.warn(f"{candidate.name} {setting}: {error}", stacklevel=2)
            return []

    tasks = [(family, fold) for family in _families(candidate) for fold in range(folds)]
    # The longest fits first, so that none is left for the end.
    tasks.sort(key=lambda t: str(sorted(t[0][0].items())), reverse=True)
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        scores = [found for some in pool.map(fold_scores, tasks, chunksize=1) for found in some]
    sums: dict[int, list[float]] = {}
    for i, score in scores:
        sums.setdefault(i, []).append(score)
    whole = {i: sum(s) / folds for i, s in sums.items() if len(s) == folds}
    for place in sorted(whole, key=lambda i: (-whole[i], i)):
        try:
            return _fit_whole(candidate, prepared, settings[place], rows), settings[place]
        except Exception as error:  # noqa: BLE001
            warnings.warn(f"{candidate.name} {settings[place]}: {error}", stacklevel=2)
    raise RuntimeError(f"{candidate.name}: no setting could be trained")


def score_rows(model: Model, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Apply a fitted or loaded pipeline: keys, prediction, probability of class 1 and the label if present."""
    label = ["label"] if "label" in df.columns else []
    return model.transform(df).select(
        *keys,
        *label,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("prob"),
    )


def train_candidates(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    candidates: Sequence[Candidate],
    folds: int = FOLDS,
    seed: int = SEED,
    parallelism: int = 1,
    partitions: int | None = None,
) -> list[Trained]:
    """Fit every candidate and score it on train and test.

    A candidate that cannot be trained is left out; none at all is an error.
    ``partitions`` deals the training rows by key and sorts them there, so that models do
    not depend on the layout of the files.  A boosted model takes hundreds of short jobs,
    each with a task per partition: few rows belong together.
    """
    context = train.sparkSession.sparkContext
    # Boosting cuts its growing lineage there.
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(train.sparkSession)}/checkpoints")
    steps = fit_features(train, features)
    # Another seed than the split, so that folds do not follow its buckets.
    folded = balanced_folds(train, keys, "label", folds, seed + 1)
    if partitions is not None:
        folded = folded.repartition(partitions, *keys).sortWithinPartitions(*keys)
    prepared = steps.transform(folded).select("label", "features", "fold").persist(StorageLevel.MEMORY_AND_DISK)
    trained = []
    try:
        for candidate in candidates:
            started = time.time()
            try:
                model, setting = _best_model(candidate, prepared, folds, parallelism)
            except Exception as error:  # noqa: BLE001
                warnings.warn(f"left out {candidate.name}: {error}", stacklevel=2)
                continue
            whole = PipelineModel([*steps.stages, model])
            one = Trained(candidate.name, whole, setting, time.time() - started)
            # Written once; scores, confusion cells and predictions all read it.
            one.scored_test = write_out(score_rows(whole, test, keys), "scored")
            trained.append(one)
        if not trained:
            raise RuntimeError("no candidate could be trained")
        _add_scores(trained, prepared)
    finally:
        prepared.unpersist()
    return trained


def _add_scores(trained: Sequence[Trained], prepared: DataFrame) -> None:
    """Figures of all models from one ranked pass and one pass over the test rows; three rows per model come back."""

    def tagged(name: str, part: str, scored: DataFrame) -> DataFrame:
        return scored.select(
            F.lit(name).alias("model_name"), F.lit(part).alias("part"), "label", "prediction", "prob"
        )

    test = reduce(DataFrame.unionByName, [tagged(t.name, "test", t.scored_test) for t in trained])
    train = [tagged(t.name, "train", score_rows(t.model.stages[-1], prepared)) for t in trained]
    areas = auc(reduce(DataFrame.unionByName, train, test), ["model_name", "part"]).collect()
    area = {(r.model_name, r.part): r.auc for r in areas}
    figures = {r.model_name: r.asDict() for r in weighted_scores(test, ["model_name"]).collect()}
    for one in trained:
        one.scores = {k: figures[one.name][k] for k in ("f1", "accuracy", "precision", "recall")}
        one.scores.update(auc_train=area[one.name, "train"], auc_test=area[one.name, "test"])


def champion_of(trained: Sequence[Trained]) -> Trained:
    """Highest test AUC; the first candidate wins ties."""
    return max(trained, key=lambda t: t.scores["auc_test"])


def score_table(spark: SparkSession, trained: Sequence[Trained], run_id: str, run_ts: datetime) -> DataFrame:
    """One row per candidate with a boolean champion mark."""
    best = champion_of(trained)
    rows = [
        (
            run_id, run_ts, t.name, FRAMEWORK,
            t.scores["auc_train"], t.scores["auc_test"], t.scores["f1"], t.scores["accuracy"],
            t.scores["precision"], t.scores["recall"], t.seconds, json.dumps(t.best_params, sort_keys=True), t is best,
        )
        for t in trained
    ]
    return spark.createDataFrame(rows, MODEL_SCORES)


def scores_of_run(log: DataFrame, run_id: str) -> DataFrame:
    return log.filter(F.col("run_id") == run_id).select(
        "model_name",
        "framework",
        F.round("auc_test", 4).alias("auc_test"),
        F.round("f1_test", 4).alias("f1_test"),
        F.round("precision_test", 4).alias("precision_w"),
        F.round("recall_test", 4).alias("recall_w"),
        "is_champion",
    ).orderBy(F.desc("auc_test"), "model_name")


def _stamped(df: DataFrame, run_id: str, run_ts: datetime, model: str, schema: StructType) -> DataFrame:
    stamped = df.withColumns(
        {"run_id": F.lit(run_id), "run_ts": F.lit(run_ts).cast("timestamp"), "model_name": F.lit(model)}
    )
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def prediction_table(champion: Trained, run_id: str, run_ts: datetime, name: str = "name", project: str = "_project", version: str = "_version") -> DataFrame:
    renamed = champion.scored_test.withColumnsRenamed(
        {name: "module_name", project: "project", version: "version", "prob": "prob_buggy"}
    )
    return _stamped(renamed, run_id, run_ts, champion.name, PREDICTIONS)


def confusion_table(champion: Trained, run_id: str, run_ts: datetime) -> DataFrame:
    return _stamped(confusion_cells(champion.scored_test), run_id, run_ts, champion.name, CONFUSION)


def importances_of(model: Model, n_features: int) -> tuple[str, list[float]]:
    """Tree importance, else absolute coefficient, else zeros."""
    if hasattr(model, "featureImportances"):
        return "feature_importance", [float(v) for v in model.featureImportances.toArray()]
    if hasattr(model, "coefficients"):
        return "abs_coefficient", [abs(float(v)) for v in model.coefficients.toArray()]
    return "n/a", [0.0] * n_features


def importance_table(spark: SparkSession, champion: Trained, features: Sequence[str], run_id: str, run_ts: datetime) -> DataFrame:
    kind, values = importances_of(champion.model.stages[-1], len(features))
    shape = StructType(
        [
            StructField("feature", StringType(), False),
            StructField("importance", DoubleType(), False),
            StructField("importance_type", StringType(), False),
        ]
    )
    rows = spark.createDataFrame([(f, v, kind) for f, v in zip(features, values)], shape)
    return _stamped(rank_features(rows), run_id, run_ts, champion.name, IMPORTANCE)


def save_champion(spark: SparkSession, champion: Trained, features: Sequence[str], folder: str, run_id: str, run_ts: datetime) -> str:
    """Save the whole pipeline (scaler included) and a JSON run record; returns the folder."""
    target = f"{folder.rstrip('/')}/champion_{run_ts:%Y%m%d_%H%M%S}_{run_id}"
    champion.model.write().overwrite().save(f"{target}/model")
    record = {
        "run_id": run_id,
        "run_ts": run_ts.isoformat(),
        "champion": champion.name,
        "framework": FRAMEWORK,
        "metrics": {k: champion.scores[s] for k, s in (("auc_test", "auc_test"), ("f1_test", "f1"), ("accuracy", "accuracy"))},
        "feature_cols": list(features),
        "best_params": {k: str(v) for k, v in champion.best_params.items()},
    }
    # A single record, written as text to keep its nested form.
    one_row = spark.createDataFrame([(json.dumps(record),)], "value string")
    one_row.coalesce(1).write.mode("overwrite").text(f"{target}/metadata")
    return target


def keep_models(trained: Sequence[Trained], folder: str) -> None:
    """Keep fitted candidates with their scores and scored rows under ``folder``, for ``kept_models``; the marker comes last."""
    for one in trained:
        one.model.write().overwrite().save(f"{folder}/{one.name}/model")
        one.scored_test.write.mode("overwrite").parquet(f"{folder}/{one.name}/scored")
    spark = trained[0].scored_test.sparkSession
    rows = [(i, t.name, json.dumps(t.best_params), t.seconds, json.dumps(t.scores)) for i, t in enumerate(trained)]
    spark.createDataFrame(rows, _KEPT).coalesce(1).write.mode("overwrite").parquet(f"{folder}/index")


_KEPT = "place int, name string, best_params string, seconds double, scores string"


def kept_models(spark: SparkSession, folder: str) -> list[Trained] | None:
    """What ``keep_models`` left under ``folder``, or None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/index/_SUCCESS")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = spark.read.schema(_KEPT).parquet(f"{folder}/index").orderBy("place").collect()
    return [
        Trained(
            r.name, PipelineModel.load(f"{folder}/{r.name}/model"), json.loads(r.best_params), r.seconds,
            spark.read.parquet(f"{folder}/{r.name}/scored"), json.loads(r.scores),
        )
        for r in rows
    ]


def load_champion(folder: str) -> PipelineModel:
    return PipelineModel.load(f"{folder.rstrip('/')}/model")


def compare(scored: DataFrame, model: str = "model_name") -> DataFrame:
    """Scores of several models' rows with the champion mark."""
    both = merge_groups([model], auc(scored, [model]), weighted_scores(scored, [model]))
    return pick_champion(both, "auc", model)
