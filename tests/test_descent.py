from __future__ import annotations

import numpy as np
import pytest

from orelake.operators import descent as d
from orelake.operators import sampling

FEATURES, KEYS = ["good", "noise"], ["name"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    data = [(f"m{i}", int(y), float(y + rng.normal(0, 0.8)), float(rng.normal())) for i, y in enumerate(rng.integers(0, 2, 400))]
    data += [("gap1", 1, None, 0.0), ("gap2", None, 0.0, 0.0)]
    return spark.createDataFrame(data, "name string, label int, good double, noise double").repartition(3)


def loop(points, rate, epochs, batches, momentum, without=None):
    """The same steps in numpy; points are (x, y, fold, batch)."""
    weights, speed = np.zeros(3), np.zeros(3)
    x = np.array([[*p[0], 1.0] for p in points])
    y, fold, batch = (np.array([p[k] for p in points]) for k in (1, 2, 3))
    for _ in range(epochs):
        for b in range(batches):
            own = (batch == b) & (True if without is None else fold != without)
            if own.any():
                gap = 1 / (1 + np.exp(-x[own] @ weights)) - y[own]
                speed = momentum * speed + x[own].T @ gap / own.sum()
                weights = weights - rate * speed
    return list(weights)


def test_steps_match_a_plain_loop(rows):
    complete = rows.dropna()
    folded = sampling.balanced_folds(complete, KEYS, "label", 3)
    batched = d.with_batches(d.zscore(folded, complete, FEATURES), KEYS, 5)
    data = d.write_out(batched.select("label", "features", "fold", "batch"), "test-descent")
    learners = [d.Learner(0.1), d.Learner(0.02, 1), d.Learner(0.1, 2)]
    found = d.descend(data, 2, learners, 6, kept=[2], batches=5, momentum=0.8)
    points = [tuple(r) for r in data.select("features", "label", "fold", "batch").collect()]
    for learner in learners:
        for epochs in (2, 6):
            assert found[learner, epochs] == pytest.approx(loop(points, learner.rate, epochs, 5, 0.8, learner.without), abs=1e-9)


def test_batches_do_not_depend_on_the_layout(rows):
    of = lambda df: {r.name: r.batch for r in d.with_batches(df, KEYS, 7).collect()}
    assert of(rows) == of(rows.repartition(11)) and len(set(of(rows).values())) == 7


def test_training_chooses_from_the_grid(rows):
    train, test = sampling.split(rows, KEYS, "label")
    grid = [{"learningRate": 0.1, "epochs": 1}, {"learningRate": 0.1, "epochs": 4}, {"learningRate": 0.0, "epochs": 4}]
    model, scored, tried = d.train(train, test, FEATURES, KEYS, grid=grid, folds=3, batches=2, partitions=1)
    assert model.params in grid[:2] and model.scores["auc_test"] > 0.7
    assert scored.count() == test.dropna().count() and scored.columns == ["name", "label", "prediction", "prob"]
    assert {(r.learning_rate, r.epochs): r.auc for r in tried.collect()}[0.0, 4] == 0.5
    assert [r.chosen for r in tried.orderBy("epochs").collect()].count(True) == 1


def test_no_rows_leave_the_weights(spark):
    empty = spark.createDataFrame([], "label double, features array<double>, fold int, batch int")
    assert d.descend(empty, 2, [d.Learner(0.1)], 1, batches=1) == {(d.Learner(0.1), 1): [0.0, 0.0, 0.0]}
