"""Distributed ranks against plain Python on small groups, one of them hot."""

from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from orelake.operators import ranking
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def groups():
    """A third of all rows in one group, a NULL group, tied values, tiny groups."""
    rng = np.random.default_rng(5)
    rows = [("hot", float(x)) for x in rng.integers(0, 40, 400) / 8]
    rows += [(f"g{i % 7}", float(x)) for i, x in enumerate(rng.random(500))]
    rows += [(None, float(x)) for x in range(20)] + [("tiny", 1.0), ("tiny", 2.0), ("tiny", 2.0)]
    return rows


@pytest.fixture(scope="module")
def frame(spark, groups):
    rows = [(i, g, x) for i, (g, x) in enumerate(groups)]
    return spark.createDataFrame(rows, "id int, g string, x double").repartition(5)


@pytest.fixture(scope="module")
def sorted_values(groups):
    out = defaultdict(list)
    for g, x in groups:
        out[g].append(x)
    return {g: sorted(xs) for g, xs in out.items()}


def test_row_numbers(frame, groups):
    got = {r.id: (r.n, r.n_total) for r in ranking.row_numbers(frame, ["g"], ["x", "id"], "n").collect()}
    by_group = defaultdict(list)
    for i, (g, x) in enumerate(groups):
        by_group[g].append((x, i))
    want = {}
    for rows in by_group.values():
        for n, (_, i) in enumerate(sorted(rows), 1):
            want[i] = (n, len(rows))
    assert got == want


def test_row_numbers_without_group(frame, groups):
    got = [r.id for r in ranking.row_numbers(frame, [], [F.desc("x"), "id"], "n").orderBy("n").collect()]
    assert got == [i for i, (_, x) in sorted(enumerate(groups), key=lambda r: (-r[1][1], r[0]))]


def test_bounded_and_spread_totals_agree(frame):
    counts = ranking.value_counts(frame, ["g"], "x")
    ways = [
        ranking.running_totals(counts, ["g"], ["x"], {"upto": "n"}, bounded).select("g", "x", "upto", "upto_total")
        for bounded in (True, False)
    ]
    assert sorted(map(str, ways[0].collect())) == sorted(map(str, ways[1].collect()))


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 0.95, 1.0])
def test_quantiles(frame, sorted_values, p):
    ranked = ranking.ranked_values(frame, ["g"], "x")
    disc = {r.g: r.q for r in ranking.discrete_quantiles(ranked, ["g"], "x", {"q": p}).collect()}
    cont = {r.g: r.q for r in ranking.interpolated_quantiles(ranked, ["g"], "x", {"q": p}).collect()}
    for g, xs in sorted_values.items():
        assert disc[g] == xs[max(1, math.ceil(Fraction(str(p)) * len(xs))) - 1]
        assert cont[g] == pytest.approx(np.percentile(xs, 100 * p))


@pytest.mark.parametrize("p", [0.1, 0.7, 0.9, 0.95, 0.99])
def test_quantile_rank_is_exact(spark, p):
    """Values 1..n per group of n rows: the quantile is the smallest whole number >= p * n."""
    n_groups = 300
    rows = spark.range(1, n_groups + 1).select(F.col("id").alias("g"), F.explode(F.sequence(F.lit(1), "id")).alias("x"))
    ranked = ranking.ranked_values(rows, ["g"], "x", bounded=True)
    got = {r.g: r.q for r in ranking.discrete_quantiles(ranked, ["g"], "x", {"q": p}).collect()}
    assert got == {n: math.ceil(Fraction(str(p)) * n) for n in range(1, n_groups + 1)}


def _tiles(n, tiles):
    small, larger = divmod(n, tiles)
    return [t for t in range(1, tiles + 1) for _ in range(small + (t <= larger))]


def test_ntile_rows_and_summary(frame, sorted_values):
    rows = ranking.ntile_rows(frame, ["g"], ["x", "id"], 5).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.x, r.id)):
        got[r.g].append(r.tile)
    for g, xs in sorted_values.items():
        assert got[g] == _tiles(len(xs), 5)

    summary = {(r.g, r.tile): r for r in ranking.ntile_summary(frame, ["g"], "x", 5).collect()}
    want = defaultdict(list)
    for g, xs in sorted_values.items():
        for t, x in zip(_tiles(len(xs), 5), xs):
            want[g, t].append(x)
    assert set(summary) == set(want)
    for key, xs in want.items():
        r = summary[key]
        assert (r.rows, r.min_value, r.max_value) == (len(xs), xs[0], xs[-1])
        assert r.sum_value == pytest.approx(sum(xs))


def test_hot_group_is_spread_over_tasks(spark, frame):
    """The rows of one group are ranked in many tasks, not in one."""
    hot = spark.range(0, 20000, 1, 8).select(F.lit("hot").alias("g"), F.xxhash64("id").alias("x"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.row_numbers(hot, ["g"], ["x"], "n")
        per_task = [r["count"] for r in ranked.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) > 2 and max(per_task) < 20000 * 0.7
    assert ranked.agg(F.max("n"), F.count_distinct("n")).first() == (20000, 20000)


def test_merge_groups_keeps_null_group(spark):
    a = spark.createDataFrame([(None, 1), ("k", 2)], "g string, a int")
    b = spark.createDataFrame([(None, 3)], "g string, b int")
    rows = {r.g: (r.a, r.b) for r in ranking.merge_groups(["g"], a, b).collect()}
    assert rows == {None: (1, 3), "k": (2, None)}


def test_ranges_are_as_many_as_shuffle_partitions(spark, plan_of):
    """Small ranges are not laid together, and each is read by a task of its own without a further shuffle."""
    df = spark.range(4000).select((F.col("id") % 2).alias("g"), F.hash("id").alias("x"), "id")
    out = ranking.row_numbers(df, ["g"], ["x", "id"])
    assert sorted(r.row_number for r in out.filter("g = 1").collect()) == list(range(1, 2001))
    plan = plan_of(out)
    n = spark.conf.get("spark.sql.shuffle.partitions")
    assert "shufflepartitionidpassthrough(direct_shuffle_partition_id(_range_part" in plan and f", {n}), REPARTITION_BY_NUM" in plan
