"""The layered build from landing files to the priority table."""

from __future__ import annotations

import os
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from orelake.constants import FEATURES, TICKET_COLUMNS
from orelake.operators import evaluate, ml, profile, quality
from orelake.plans import bronze, decisions, full_build, lake as names, silver
from orelake.plans.lake import Lake, Run
from orelake.sinks.tables import ConstraintViolation

N_CODE, N_TICKETS = 600, 900


def _land(root: str) -> None:
    rng = np.random.default_rng(7)
    header = ",".join(["name", *FEATURES, "bug"])
    for p, project in enumerate(("ant", "camel", "ivy")):
        for version in ("1.0", "1.1"):
            os.makedirs(f"{root}/code/{project}", exist_ok=True)
            lines = [header]
            for i in range(N_CODE // 6):
                bug = int(rng.poisson(0.3 + 0.4 * p))
                values = rng.random(len(FEATURES)) * 10 + bug
                lines.append(",".join([f"org.{project}.C{i}", *[f"{x:.4f}" for x in values], str(bug)]))
            lines.append(lines[-1])  # a copy
            with open(f"{root}/code/{project}/{project}-{version}.csv", "w") as f:
                f.write("\n".join(lines) + "\n")
    os.makedirs(f"{root}/tickets")
    for s, system in enumerate(("ALPHA", "BETA")):
        lines = [",".join(TICKET_COLUMNS)]
        for i in range(N_TICKETS // 2):
            created = datetime(2012 + i % 4, 1 + i % 12, 1 + i % 28, i % 24, i % 60)
            resolved = "" if i % 5 == 0 else f"{created + timedelta(days=int(rng.integers(0, 90)) - (1 if i % 50 == 1 else 0)):%d/%m/%Y %H:%M}"
            if i % 50 == 1:
                resolved = f"{created - timedelta(days=2):%d/%m/%Y %H:%M}"
            kind = ("Bug", "Task", "Story")[i % 3]
            lines.append(f"{system}-{i},{kind},Closed,{system},{system.title()},software,Done,{created:%d/%m/%Y %H:%M},{resolved}")
        with open(f"{root}/tickets/{system}.csv", "w") as f:
            f.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def lake(tmp_path_factory, spark):
    root = str(tmp_path_factory.mktemp("lake"))
    _land(f"{root}/landing")
    tag = f"b{os.getpid()}"
    return Lake(
        landing=f"{root}/landing", artifacts=f"{root}/artifacts", warehouse=f"{root}/warehouse",
        bronze=f"bronze_{tag}", silver=f"silver_{tag}", gold=f"gold_{tag}",
    )


@pytest.fixture(scope="module")
def run(spark, lake):
    candidates = [ml.logistic([{"maxIter": 10}]), ml.random_forest([{"numTrees": 5, "maxDepth": 3}])]
    return full_build.build_all(spark, lake, Run("run-1", datetime(2020, 1, 1, tzinfo=timezone.utc)), candidates)


def test_all_tables_exist_with_comments(spark, lake, run):
    assets = decisions.assets(spark, lake).collect()
    assert [sum(a.table_schema == d for a in assets) for d in (lake.bronze, lake.silver, lake.gold)] == [2, 4, 13]
    assert all(a.comment for a in assets)


def test_rows_per_layer(spark, lake, run):
    kept = {r.source: (r.bronze_rows, r.silver_rows) for r in silver.retention(spark, lake).collect()}
    assert kept[names.CODE_RAW] == (N_CODE + 6, N_CODE)
    inverted = 2 * len([i for i in range(N_TICKETS // 2) if i % 50 == 1 and i % 5])
    assert kept[names.TICKETS_RAW] == (N_TICKETS, N_TICKETS - inverted)
    diff = quality.reconcile_totals(bronze.reconcile_code(spark, lake)).first()
    assert tuple(diff) == (N_CODE + 6, N_CODE + 6, 0)


def test_check_log_passes_or_warns(spark, lake, run):
    log = spark.table(f"{lake.silver}.{names.CHECKS}")
    assert log.count() == 19 and log.select("run_id").distinct().count() == 1
    assert {r.check_name for r in quality.check_exceptions(log, "run-1").collect()} == {"inverted_created_resolved"}


def test_reports(spark, lake, run):
    by_group = spark.table(f"{lake.gold}.{names.KPI_DEFECTS}")
    assert by_group.agg(F.sum("modules")).first()[0] == N_CODE
    assert spark.table(f"{lake.gold}.{names.KPI_CORRELATIONS}").count() == 20
    assert spark.table(f"{lake.gold}.{names.KPI_TOP_MODULES}").count() == 25
    assert spark.table(f"{lake.gold}.{names.KPI_CROSS_DOMAIN}").count() == 5
    years = profile.open_by_year(spark.table(f"{lake.gold}.{names.KPI_THROUGHPUT}")).collect()
    assert {r.year for r in years} == {2012, 2013, 2014, 2015}
    quintiles = spark.table(f"{lake.gold}.{names.KPI_QUINTILES}").groupBy("project").agg(
        (F.max("modules") - F.min("modules")).alias("spread")
    )
    assert all(r.spread <= 1 for r in quintiles.collect())


def test_models_and_decisions(spark, lake, run):
    scores = spark.table(f"{lake.gold}.{names.MODEL_SCORES}")
    assert scores.count() == 2 and scores.filter("is_champion").count() == 1
    dashboard = decisions.model_dashboard(spark, lake)
    n = spark.table(f"{lake.gold}.{names.PREDICTIONS}").count()
    assert sum(dashboard["cells"].first()) == n and dashboard["importance"].count() == 10
    summary = decisions.summary(spark, lake).first()
    assert (summary.total_modules, summary.n_projects, summary.first_year) == (N_CODE, 3, 2012)
    assert summary.model_name == scores.filter("is_champion").first().model_name
    tiers = spark.table(f"{lake.gold}.{names.PRIORITIES}")
    assert tiers.count() == 3 and tiers.filter("slt_priority IS NULL").count() == 0


def test_second_run_appends_logs_and_replaces_tables(spark, lake, run):
    silver.build(spark, lake, Run("run-2", datetime(2020, 1, 2, tzinfo=timezone.utc)), fail_on_critical=True)
    log = spark.table(f"{lake.silver}.{names.CHECKS}")
    assert log.select("run_id").distinct().count() == 2
    assert spark.table(f"{lake.silver}.{names.CODE_CLEAN}").count() == N_CODE
    assert evaluate.roc_points(spark.table(f"{lake.gold}.{names.PREDICTIONS}").withColumnRenamed("prob_buggy", "prob")).count() > 2


def test_faults_are_logged_before_the_run_stops(spark, lake, run, tmp_path):
    """A wrong header, an empty file, a lost row and a negative size: the log holds each, the tables stay."""
    root = str(tmp_path / "landing")
    _land(root)
    with open(f"{root}/code/ant/ant-9.csv", "w") as f:
        f.write("a,b\n1,2\n")
    open(f"{root}/code/ant/ant-8.csv", "w").close()
    header = ["name", *FEATURES, "bug"]
    with open(f"{root}/code/ivy/ivy-7.csv", "w") as f:
        f.write(",".join(header) + "\n" + ",".join(["x.Y", *["-1" if c == "loc" else "1" for c in FEATURES], "0"]) + "\n")
    bad = Lake(
        landing=root, artifacts=str(tmp_path), warehouse=lake.warehouse, bronze=lake.bronze + "_bad", silver=lake.silver + "_bad",
        gold=lake.gold + "_bad", expected_rows=((names.CODE_RAW, 1),),
    )
    bad.bootstrap(spark)
    bronze.build(spark, bad)
    with pytest.raises(ConstraintViolation, match="loc_non_negative"):
        silver.build(spark, bad, Run("bad", datetime(2020, 1, 1, tzinfo=timezone.utc)))
    failed = {(r.check_name, r.status, (r.details or "").rsplit("/", 1)[-1]) for r in spark.table(f"{bad.silver}.{names.CHECKS}").filter("status <> 'PASS'").collect()}
    assert {("file_left_out", "WARN", "ant-9.csv"), ("file_left_out", "WARN", "ant-8.csv"), ("constraint", "FAIL", "loc_non_negative"),
            (f"bronze_row_count_{names.CODE_RAW}", "FAIL", "")} <= failed
    assert not spark.catalog.tableExists(f"{bad.silver}.{names.CODE_CLEAN}")
