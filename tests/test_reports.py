"""Edge cases of the report tables on hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orelake.operators import decision, dimension, kpi, profile


@pytest.fixture(scope="module")
def modules(spark):
    rows = [("few", "1", f"f{i}", 2, 10.0 * (i + 1)) for i in range(3)]
    rows += [("many", "1", f"m{i:03}", 1 + i % 3, 50.0) for i in range(60)]
    rows += [("none", "2", f"n{i}", 0, 5.0) for i in range(4)]
    df = spark.createDataFrame(rows, "_project string, _version string, name string, bug int, loc double")
    return df.withColumns({"is_buggy": (F.col("bug") > 0).cast("int"), "bug_density": F.col("bug") / F.col("loc")})


def _issue(key, name, kind, days):
    return (f"{key}-{kind}-{days}", key, name, kind, 2020, 0 if days is None else 1, days)


@pytest.fixture(scope="module")
def issues(spark):
    rows = [_issue("A", "Alpha", "Bug", d) for d in range(100)] + [_issue("A", "Alpha", "Task", d) for d in range(99)]
    rows += [_issue("A", "Alpha", "Bug", None)] * 50 + [_issue("B", "Old", "Bug", 1), _issue("B", "New", "Bug", 3)]
    return spark.createDataFrame(
        rows,
        "issue_key string, project_key string, project_name string, issue_type string, year_created int, "
        "is_resolved int, cycle_time_days int",
    )


def test_group_profile_exact_and_approximate(modules):
    exact = {r.project: r for r in kpi.defect_by_group(modules).collect()}
    assert (exact["none"].pct_buggy, exact["none"].median_bug_density) == (0.0, 0.0)
    assert (exact["few"].modules, exact["few"].buggy_modules, exact["few"].total_bugs) == (3, 3, 6)
    assert exact["few"].median_bug_density == 0.1
    approximate = {r.project: r for r in kpi.defect_by_group(modules, accuracy=10000).collect()}
    assert approximate == exact


def test_tied_rows_at_the_limit(modules):
    top = kpi.top_modules(modules).orderBy("rank_global", "module").collect()
    assert len(top) == 25 and top[0].bugs == 3
    # 20 modules share the first rank; then two bugs, ordered by density.
    assert [r.rank_global for r in top[:20]] == [1] * 20
    assert [(r.project, r.module) for r in top[20:23]] == [("few", "f0"), ("few", "f1"), ("few", "f2")]
    assert [r.rank_global for r in top[20:25]] == [2, 3, 4, 5, 5]


def test_quintiles_of_a_small_group(modules):
    rows = kpi.density_quintiles(modules).collect()
    assert [(r.quintile, r.modules) for r in rows if r.project == "few"] == [(1, 1), (2, 1), (3, 1)]
    assert [(r.quintile, r.modules) for r in rows if r.project == "many"] == [(q, 12) for q in range(1, 6)]
    assert not [r for r in rows if r.project == "none"]


def test_correlation_of_a_constant_is_null(modules):
    row = kpi.correlations(modules.withColumn("one", F.lit(1.0)), ["one"]).first()
    assert row.corr_with_bug is None


def test_row_minimum_is_inclusive(issues):
    rows = kpi.cycle_time_by_type(issues).collect()
    assert [(r.issue_type, r.issues, r.pct_resolved) for r in rows] == [("Bug", 102, 100.0)]
    assert {r.issue_type for r in kpi.cycle_time_by_type(issues, min_rows=99).collect()} == {"Bug", "Task"}


def test_years_outside_the_range_are_left_out(issues):
    assert kpi.throughput_yearly(issues, (2021, 2022)).count() == 0
    row = kpi.throughput_yearly(issues).first()
    assert (row.year, row.issues_created, row.issues_resolved, row.active_systems) == (2020, 251, 201, 2)
    assert (row.median_cycle_days, row.p95_cycle_days) == (49, 94)
    assert profile.open_by_year(kpi.throughput_yearly(issues)).first().issues_open == 50


def test_renamed_project_counts_in_both_rows(modules, issues):
    dim = dimension.project_dimension(modules, issues, "code", "tickets")
    assert dim.filter("project_id = 'tickets:B'").count() == 2
    cross = kpi.cross_domain(modules, issues, dim, "code", "tickets")
    renamed = {r.project_name: r for r in cross.filter("project_id = 'tickets:B'").collect()}
    assert {n: (r.records, r.avg_cycle_days, r.avg_bug_density) for n, r in renamed.items()} == {
        "Old": (2, 2.0, None),
        "New": (2, 2.0, None),
    }
    code = cross.filter("project_id = 'code:none'").first()
    assert (code.project_name, code.records, code.positive_rate_pct, code.avg_cycle_days) == ("None", 4, 0.0, None)


def test_project_without_predictions_is_last_with_the_lowest_tier(spark, modules):
    predictions = spark.createDataFrame([("few", 0.4, 0), ("many", 0.0, 0)], "project string, prob_buggy double, prediction int")
    rows = decision.prioritization_tiers(kpi.defect_by_group(modules), predictions).collect()
    assert [(r.project, r.combined_risk_score, r.slt_priority) for r in rows] == [
        ("few", 70.0, "[P0] CRITICAL"),
        ("many", 50.0, "[P0] CRITICAL"),
        ("none", None, "[P3] LOW"),
    ]


def test_summary_without_a_champion_keeps_its_totals(spark, modules, issues):
    scores = spark.createDataFrame(
        [], "model_name string, framework string, auc_test double, f1_test double, precision_test double, "
        "recall_test double, is_champion boolean, run_ts timestamp"
    )
    row = decision.executive_summary(kpi.defect_by_group(modules), kpi.throughput_yearly(issues), scores).first()
    assert (row.total_modules, row.n_projects, row.total_issues, row.model_name) == (67, 3, 251, None)


def test_box_whiskers_stay_inside_the_reach(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("g", x) for x in values] + [("g", 0.0), (None, 1.0)], "g string, x double")
    rows = profile.box_stats(df, "g", "x").collect()
    assert [tuple(r) for r in rows] == [("g", 1.0, 2.0, 3.0, 4.0, 4.0)]
