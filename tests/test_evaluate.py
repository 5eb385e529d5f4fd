from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orelake.operators import evaluate


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    label = rng.integers(0, 2, 300)
    prob = np.round(np.clip(label * 0.2 + rng.random(300) * 0.8, 0, 1), 2)
    return [(int(y), float(p), int(p >= 0.5)) for y, p in zip(label, prob)]


@pytest.fixture(scope="module")
def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, prob double, prediction int").repartition(4)


def brute_auc(rows):
    pos = [p for y, p, _ in rows if y == 1]
    neg = [p for y, p, _ in rows if y == 0]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_and_area_equal_all_pairs(scored, rows):
    want = brute_auc(rows)
    assert evaluate.auc(scored).first().auc == pytest.approx(want)
    assert evaluate.roc_area(scored).first().area == pytest.approx(want)


def test_reversed_score(scored, rows):
    flipped = scored.withColumn("prob", 1 - F.col("prob"))
    assert evaluate.auc(flipped).first().auc == pytest.approx(1 - brute_auc(rows))


def test_roc_ends_at_one_and_never_falls(scored):
    points = evaluate.roc_points(scored).orderBy(F.desc("prob")).collect()
    assert (points[-1].fpr, points[-1].tpr) == (1.0, 1.0)
    assert all(a.fpr <= b.fpr and a.tpr <= b.tpr for a, b in zip(points, points[1:]))


def test_cells_sum_to_rows_and_keep_zeros(spark, scored, rows):
    assert sum(r["count"] for r in evaluate.confusion_cells(scored).collect()) == len(rows)
    one = spark.createDataFrame([(0, 0.1, 0)], "label int, prob double, prediction int")
    assert {r.cell: r["count"] for r in evaluate.confusion_cells(one).collect()} == {"TP": 0, "FP": 0, "TN": 1, "FN": 0}


def test_scores_without_predicted_positives(spark):
    none = spark.createDataFrame([(1, 0.1, 0), (0, 0.2, 0)], "label int, prob double, prediction int")
    assert tuple(evaluate.positive_class_scores(none).first()) == (0.0, 0.0, 0.0)
    weighted = evaluate.weighted_scores(none).first()
    assert (weighted.accuracy, weighted.recall, weighted.precision) == (0.5, 0.5, 0.25)


def test_one_class_has_no_auc(spark):
    only = spark.createDataFrame([(1, 0.1, 0), (1, 0.9, 1)], "label int, prob double, prediction int")
    assert evaluate.auc(only).first().auc is None


def test_first_name_wins_ties(spark):
    scores = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.1)], "model_name string, auc double")
    assert [r.model_name for r in evaluate.pick_champion(scores).filter("is_champion").collect()] == ["a"]
