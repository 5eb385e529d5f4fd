from __future__ import annotations

import json
import warnings
from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from orelake.operators import ml, sampling, scaling
from orelake.schemas import CONFUSION, IMPORTANCE, MODEL_SCORES, PREDICTIONS

RUN = ("r1", datetime(2020, 1, 2, 3, 4, 5, tzinfo=timezone.utc))
FEATURES = ["good", "noise"]
KEYS = ["name", "_project", "_version"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    label = rng.integers(0, 2, 600)
    data = [
        (f"m{i}", f"p{i % 3}", "1", int(y), float(y + rng.normal(0, 0.7)), float(rng.normal())) for i, y in enumerate(label)
    ]
    df = spark.createDataFrame(data, "name string, _project string, _version string, is_buggy int, good double, noise double")
    return ml.training_set(df.repartition(4), "is_buggy", FEATURES, KEYS)


@pytest.fixture(scope="module")
def trained(rows):
    train, test = sampling.split(rows, KEYS, "label")
    candidates = [
        ml.logistic([{"regParam": 0.0, "maxIter": 20}, {"regParam": 0.1, "maxIter": 20}]),
        ml.random_forest([{"numTrees": 5, "maxDepth": 3}]),
    ]
    return ml.train_candidates(train, test, FEATURES, KEYS, candidates, folds=3)


def test_split_is_disjoint_complete_and_layout_free(rows):
    train, test = sampling.split(rows, KEYS, "label")
    names = [{r.name for r in part.collect()} for part in (train, test)]
    assert not names[0] & names[1] and len(names[0] | names[1]) == 600
    assert 0.7 < len(names[0]) / 600 < 0.9
    again, _ = sampling.split(rows.repartition(13), KEYS, "label")
    assert {r.name for r in again.collect()} == names[0]


def test_shares_per_class(rows):
    train, _ = sampling.split(rows, KEYS, "label", {1: 1.0, 0: 0.0})
    assert {r.label for r in train.select("label").distinct().collect()} == {1}


def test_folds_are_balanced_per_class(rows):
    folds = sampling.balanced_folds(rows, KEYS, "label", 5).groupBy("label", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r.label == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_constant_feature_and_single_row_scale_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = [r.features for r in scaling.zscore(df, df, ["a", "b"]).orderBy("a").collect()]
    assert out[0] == pytest.approx([-(2**-0.5), 0.0]) and out[1] == pytest.approx([2**-0.5, 0.0])
    assert [r.features for r in scaling.zscore(df, df, ["a"], population=True).orderBy("a").collect()] == [[-1.0], [1.0]]
    one = df.limit(1)
    assert scaling.zscore(one, one, ["a"]).first().features == [0.0]


def test_models_beat_chance_and_repeat(rows, trained):
    assert [t.name for t in trained] == ["LogisticRegression", "RandomForest"]
    assert all(t.scores["auc_test"] > 0.7 for t in trained)
    train, test = sampling.split(rows, KEYS, "label")
    again = ml.train_candidates(train, test, FEATURES, KEYS, [ml.random_forest([{"numTrees": 5, "maxDepth": 3}])])
    assert again[0].scores == trained[1].scores


def test_result_tables(spark, rows, trained):
    champion = ml.champion_of(trained)
    scores = ml.score_table(spark, trained, *RUN)
    assert scores.schema == MODEL_SCORES
    assert [r.model_name for r in scores.filter("is_champion").collect()] == [champion.name]
    assert ml.scores_of_run(scores, "r1").count() == 2 and ml.scores_of_run(scores, "other").count() == 0

    _, test = sampling.split(rows, KEYS, "label")
    predictions = ml.prediction_table(champion, *RUN)
    assert predictions.columns == PREDICTIONS.fieldNames() and predictions.count() == test.count()
    cells = ml.confusion_table(champion, *RUN)
    assert cells.columns == CONFUSION.fieldNames()
    assert cells.agg(F.sum("count")).first()[0] == test.count()

    for one, kind in zip(trained, ("abs_coefficient", "feature_importance")):
        table = ml.importance_table(spark, one, FEATURES, *RUN)
        assert table.columns == IMPORTANCE.fieldNames()
        first = table.orderBy("rank").first()
        assert (first.feature, first.importance_type, first["rank"]) == ("good", kind, 1)


def test_saved_champion_scores_alike(spark, rows, trained, folder):
    champion = ml.champion_of(trained)
    target = ml.save_champion(spark, champion, FEATURES, folder, *RUN)
    assert target.endswith("champion_20200102_030405_r1")
    record = json.loads(spark.read.text(f"{target}/metadata").first().value)
    assert record["champion"] == champion.name and record["feature_cols"] == FEATURES
    _, test = sampling.split(rows, KEYS, "label")
    again = ml.score_rows(ml.load_champion(target), test, ["name"]).select("name", "prob", "prediction")
    first = champion.scored_test.select("name", "prob", "prediction")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first.collect()))


def test_prefix_scores_like_its_trees_one_by_one(rows):
    train, test = sampling.split(rows, KEYS, "label")
    steps = ml.fit_features(train, FEATURES)
    prepared, held_out = steps.transform(train), steps.transform(test)
    points = [(r.name, r.features) for r in held_out.select("name", "features").collect()]

    def vote(tree, x):
        """Class counts of the leaf that ``x`` falls into, or the leaf's value."""
        node = tree._java_obj.rootNode()
        while node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            node = node.leftChild() if x[split.featureIndex()] <= split.threshold() else node.rightChild()
        return node

    forest = ml.RandomForestClassifier(seed=3, numTrees=6, maxDepth=4).fit(prepared)
    some = ml.prefix(forest, 4)
    assert (some.getNumTrees, forest.getNumTrees) == (4, 6) and some.getFeaturesCol() == "features"
    got = {r.name: r.prob for r in ml.score_rows(some, held_out, ["name"]).collect()}
    for name, x in points:
        votes = [list(vote(t, x).impurityStats().stats()) for t in forest.trees[:4]]
        assert got[name] == pytest.approx(sum(s[1] / sum(s) for s in votes) / 4, abs=1e-12)

    boosted = ml.GBTClassifier(seed=3, maxIter=6, maxDepth=2, stepSize=0.1).fit(prepared)
    got = {r.name: r.prob for r in ml.score_rows(ml.prefix(boosted, 4), held_out, ["name"]).collect()}
    for name, x in points:
        margin = sum(w * vote(t, x).prediction() for w, t in zip(boosted.treeWeights[:4], boosted.trees[:4]))
        assert got[name] == pytest.approx(1 / (1 + np.exp(-2 * margin)), abs=1e-12)
    fewer = ml.GBTClassifier(seed=3, maxIter=4, maxDepth=2, stepSize=0.1).fit(prepared)
    assert {r.name: r.prob for r in ml.score_rows(fewer, held_out, ["name"]).collect()} == got


def test_sizes_of_an_ensemble_share_fits(rows, monkeypatch):
    fits = []
    fit = ml.RandomForestClassifier.fit
    monkeypatch.setattr(ml.RandomForestClassifier, "fit", lambda self, df, params=None: (fits.append(params), fit(self, df, params))[1])
    train, test = sampling.split(rows, KEYS, "label")
    grid = [{"numTrees": n, "maxDepth": d} for n in (2, 4) for d in (2, 3)]
    one = ml.train_candidates(train, test, FEATURES, KEYS, [ml.random_forest(grid)], folds=3, parallelism=4, partitions=1)[0]
    # Three folds of two depths, and the chosen setting.
    assert len(fits) == 7 and one.best_params in grid and one.model.stages[-1].getNumTrees == one.best_params["numTrees"]


def test_logistic_coefficients_match_newton_steps(rows):
    train, _ = sampling.split(rows, KEYS, "label")
    prepared = ml.fit_features(train, FEATURES).transform(train)
    model = ml.LogisticRegression(standardization=False, regParam=0.01, maxIter=200, tol=1e-12).fit(prepared)
    pairs = [(list(r.features), r.label) for r in prepared.select("features", "label").collect()]
    x = np.hstack([np.array([p for p, _ in pairs]), np.ones((len(pairs), 1))])
    y = np.array([label for _, label in pairs])
    weights, penalty = np.zeros(3), np.diag([0.01, 0.01, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ weights))
        gradient = x.T @ (p - y) / len(y) + penalty @ weights
        weights -= np.linalg.solve((x.T * (p * (1 - p))) @ x / len(y) + penalty, gradient)
    assert [*model.coefficients, model.intercept] == pytest.approx(list(weights), abs=1e-6)


def test_models_train_and_score_after_something_was_observed(spark, rows):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    train, test = sampling.split(rows, KEYS, "label")
    candidates = [ml.logistic([{"maxIter": 5}, {"maxIter": 6}]), ml.random_forest([{"numTrees": 2, "maxDepth": 2}])]
    trained = ml.train_candidates(train, test, FEATURES, KEYS, candidates, folds=2)
    assert [t.name for t in trained] == ["LogisticRegression", "RandomForest"]
    assert all(t.scored_test.count() == test.count() for t in trained)


def test_kept_models_come_back(spark, trained, folder):
    assert ml.kept_models(spark, folder) is None
    ml.keep_models(trained, folder)
    again = ml.kept_models(spark, folder)
    assert [(t.name, t.best_params, t.scores) for t in again] == [(t.name, t.best_params, t.scores) for t in trained]
    for one, other in zip(trained, again):
        assert sorted(map(tuple, one.scored_test.collect())) == sorted(map(tuple, other.scored_test.collect()))


def test_failing_settings_and_candidates_are_left_out(rows):
    train, test = sampling.split(rows, KEYS, "label")
    # Depth 31 is more than Spark grows: it fails when set.
    broken = ml.random_forest([{"numTrees": 3, "maxDepth": 2}, {"numTrees": 3, "maxDepth": 31}])
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        one = ml.train_candidates(train, test, FEATURES, KEYS, [broken], folds=2)
    assert one[0].best_params == {"numTrees": 3, "maxDepth": 2} and seen
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        only_broken = [ml.random_forest([{"maxDepth": 31}])]
        with pytest.raises(RuntimeError):
            ml.train_candidates(train, test, FEATURES, KEYS, only_broken)
        kept = ml.train_candidates(train, test, FEATURES, KEYS, [*only_broken, ml.logistic([{"maxIter": 5}])])
    assert [t.name for t in kept] == ["LogisticRegression"]


def test_candidates_share_the_picked_rows(spark):
    """The rows to fit on are picked in one pass over the table; a candidate reads what was written."""
    from conftest import SMALL

    from orelake.workload import models

    train, _ = models._split(spark, SMALL)
    assert train.inputFiles() and all("/fit-rows-" in f for f in train.inputFiles())
    again, _ = models._split(spark, SMALL)
    assert sorted(train.inputFiles()) == sorted(again.inputFiles())
    keys = models.v.MODULE_KEYS
    rows = models._rows(spark, SMALL)
    wanted = models.sampling.split(rows, keys, "label")[0].orderBy(models.hash_number(7, *keys), *keys).limit(models.FIT_ROWS)
    assert sorted(train.collect()) == sorted(wanted.collect())


@pytest.fixture()
def tables(spark, folder):
    """Given tables with 2,400 items of keys of their own."""
    item = {
        "l_orderkey": "id", "l_linenumber": "1", "l_partkey": "id % 40", "l_suppkey": "id % 7", "l_quantity": "double(1 + id * 7 % 50)",
        "l_discount": "id * 13 % 11 / 100D", "l_tax": "id * 3 % 9 / 100D", "l_extendedprice": "1000D + id * 37 % 9001",
        "l_shipdate": "timestamp_ntz'1995-01-01'",
    }
    part = {"p_partkey": "id", "p_brand": "concat('Brand#', id % 5)", "p_size": "int(id)", "p_retailprice": "900D + id"}
    for name, n, columns in (("lineitem", 2400, item), ("part", 40, part), *((x, 1, {"id": "id"}) for x in ("orders", "customer", "nation"))):
        spark.range(n).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()]).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", ["ml_champion_scores", "ml_confusion", "ml_predictions"])
def test_models_are_fitted_on_all_training_rows(spark, tables, monkeypatch, name):
    from orelake.workload import QUERIES, models

    seen = []
    train_candidates = ml.train_candidates

    def watched(train, *args, **kwargs):
        seen.append(sorted(r.name for r in train.select("name").collect()))
        return train_candidates(train, *args, **kwargs)

    monkeypatch.setattr(ml, "train_candidates", watched)
    small = {"logistic": lambda: ml.logistic([{"maxIter": 5}]), "random_forest": lambda: ml.random_forest([{"numTrees": 2, "maxDepth": 2}])}
    monkeypatch.setattr(models, "_CANDIDATES", small)
    found = QUERIES[name](spark, tables).collect()
    train, test = sampling.split(models._rows(spark, tables), KEYS, "label")
    wanted = sorted(r.name for r in train.select("name").collect())
    assert seen == [wanted, wanted] and len(wanted) > 1800
    if name == "ml_champion_scores":
        assert (found[0].models, found[0].champions) == (2, 1)
    if name == "ml_confusion":
        assert found[0].positives + found[0].negatives == test.count()
    if name == "ml_predictions":
        assert sorted(r.module_name for r in found) == sorted(r.name for r in test.select("name").collect())


def test_more_rows_take_more_tasks_and_fewer_fits_side_by_side(rows, monkeypatch):
    from orelake.workload import models

    assert models._layout(rows) == {"partitions": 1, "parallelism": models.TASKS}
    monkeypatch.setattr(models, "ROWS_A_TASK", 250)
    assert models._layout(rows) == {"partitions": 3, "parallelism": models.TASKS // 3}
    assert models._layout(rows.limit(0)) == {"partitions": 1, "parallelism": models.TASKS}


def test_parts_of_a_forest_end_at_its_sizes():
    forest = ml.random_forest()
    assert ml._parts(forest, [50, 100], 1000) == [100]
    assert ml._parts(forest, [50, 100], 100_000) == [40, 10, 30, 20]
    assert ml._parts(forest, [2, 3], 10**9) == [1, 1, 1]
    assert ml._parts(forest, [None], 10**9) == [] and ml._parts(ml.boosting(), [50, 100], 10**9) == []


def test_forest_in_parts_scores_like_the_forest_of_all_parts(rows, monkeypatch):
    train, test = sampling.split(rows, KEYS, "label")
    steps = ml.fit_features(train, FEATURES)
    prepared, held_out = steps.transform(train), steps.transform(test)
    monkeypatch.setattr(ml, "GROWN_AT_ONCE", 1200)
    candidate = ml.random_forest([{"numTrees": n, "maxDepth": 3} for n in (4, 6)])
    evaluator = ml.BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
    setting, parts = dict(candidate.grid[1]), ml._parts(candidate, [4, 6], 600)
    assert parts == [2, 2, 2]
    whole = ml._fit_whole(candidate, prepared, setting, 600)
    assert whole.getNumTrees == 6 and len({t.toDebugString for t in whole.trees}) == 6
    got = dict(ml._scores_in_parts(candidate, prepared, setting, parts, [(0, 4), (1, 6)], held_out, evaluator))
    for place, size in ((0, 4), (1, 6)):
        assert got[place] == pytest.approx(evaluator.evaluate(ml.prefix(whole, size).transform(held_out)), abs=1e-9)
    one = ml.train_candidates(train, test, FEATURES, KEYS, [candidate], folds=3, parallelism=2, partitions=2)[0]
    assert one.model.stages[-1].getNumTrees == one.best_params["numTrees"] and one.scores["auc_test"] > 0.7
