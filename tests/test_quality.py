from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from orelake.operators import quality
from orelake.schemas import CHECK_LOG

RUN = ("r1", datetime(2020, 1, 1, tzinfo=timezone.utc))


def test_status_by_level(spark):
    df = spark.range(3)
    states = {
        level: quality.row_count_check(df, "t", "rows", 4, level).first().status for level in quality.LEVELS
    }
    assert states == {"critical": "FAIL", "warning": "WARN", "info": "WARN"}
    assert quality.row_count_check(df, "t", "rows", 3, "critical").first().status == "PASS"
    with pytest.raises(ValueError):
        quality.row_count_check(df, "t", "rows", 3, "urgent")


def test_empty_tables_give_whole_suites(spark):
    raw = spark.createDataFrame([], "name string, _project string, _version string, loc double, bug int")
    rows = quality.module_suite(raw, raw).collect()
    assert len(rows) == 7 and {r.status for r in rows} == {"PASS"} and {r.actual for r in rows} == {"0"}


def test_suite_reports_duplicates_and_drops(spark):
    raw = spark.createDataFrame(
        [("a", "p", "1", 1.0, 1), ("a", "p", "1", 1.0, 1), (None, "p", "1", 1.0, -1)],
        "name string, _project string, _version string, loc double, bug int",
    )
    clean = raw.filter("name IS NOT NULL")
    checks = quality.module_suite(raw, clean)
    got = {r.check_name: (r.actual, r.status) for r in checks.collect()}
    assert got["nulls_in_name"] == ("1", "FAIL") and got["negative_bug"] == ("1", "FAIL")
    assert got["duplicate_natural_keys"] == ("1", "FAIL")
    assert got["rows_dropped_in_silver"] == ("1", "PASS")
    log = quality.as_log(checks, *RUN)
    assert log.columns == CHECK_LOG.fieldNames()
    assert quality.check_exceptions(log, "r1").count() == 3
    assert quality.check_exceptions(log, "other").count() == 0
    with pytest.raises(ValueError, match="duplicate_natural_keys"):
        quality.raise_on_failure(checks)


def test_null_breaks_a_constraint_unless_allowed(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    rules = [("strict", "x >= 0"), ("allows_null", "x IS NULL OR x >= 0")]
    got = {r.constraint_name: r.violations for r in quality.constraint_violations(df, rules).collect()}
    assert got == {"strict": 2, "allows_null": 1}


def test_renamed_project_is_a_duplicate_id(spark):
    dim = spark.createDataFrame([("t:A",), ("t:A",), ("t:B",)], "project_id string")
    got = {r.check_name: (r.actual, r.status) for r in quality.dimension_suite(dim).collect()}
    assert got == {"duplicate_project_id": ("1", "FAIL"), "row_count": ("3", "PASS")}


def test_reconcile_counts_a_missing_group(spark):
    files = spark.createDataFrame([("a", 5), ("b", 2), ("b", 1)], "k string, data_rows bigint")
    table = spark.createDataFrame([("a",)] * 4, "k string")
    diff = quality.reconcile(files, table, ["k"])
    assert [tuple(r) for r in diff.collect()] == [("b", 3, 0, 3), ("a", 5, 4, 1)]
    assert tuple(quality.reconcile_totals(diff).first()) == (8, 4, 4)


def test_retention_of_an_emptied_table(spark):
    out = quality.retention([("t", spark.range(4), spark.range(4).filter(F.lit(False)))])
    assert tuple(out.first()) == ("t", 4, 0, 0.0)


def test_both_runs_log_suites_that_were_computed_once(spark, monkeypatch):
    from conftest import SMALL

    from orelake.workload import files as queries

    seen, as_log = [], quality.as_log
    monkeypatch.setattr(queries.quality, "as_log", lambda checks, *run: seen.append(checks) or as_log(checks, *run))
    log = queries.dq_log_append(spark, SMALL)
    assert {r.run_id: r["count"] for r in log.groupBy("run_id").count().collect()} == {"run-1": 15, "run-2": 16}
    assert len(seen) == 2 and all(any("/suites-" in f for f in checks.inputFiles()) for checks in seen)
