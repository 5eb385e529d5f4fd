from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orelake.constants import TICKET_DATE_FORMAT
from orelake.functions import columns as c
from orelake.operators import clean


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def test_rename_ignores_missing(spark):
    df = spark.createDataFrame([(1,)], "`Issue key` int")
    assert clean.rename(df, {"Issue key": "issue_key", "Status": "status"}).columns == ["issue_key"]


def test_dates_are_parsed_strictly(spark):
    df = spark.createDataFrame([("16/06/2022 23:13",), ("1/6/2022 3:13",), ("31/02/2022 10:00",), ("",), (None,)], "t string")
    out = [r.d for r in clean.parse_dates(df, {"d": "t"}, TICKET_DATE_FORMAT).collect()]
    assert out == [ts("2022-06-16 23:13"), None, None, None, None]


def test_modules(spark):
    rows = [
        ("a", "p", "1", 10.0, 2, 1),
        ("a", "p", "1", 10.0, 3, 2),  # the latest copy of a
        ("a", "p", "1", 10.0, 4, 0),
        ("b", "p", "1", 0.0, 1, 1),  # size 0
        ("c", "p", "1", 5.0, 0, 1),
        (None, "p", "1", 5.0, 0, 1),
        ("d", "p", "1", None, 0, 1),
        ("e", "p", "1", 5.0, None, 1),
        ("f", "p", "1", 5.0, -1, 1),
    ]
    df = spark.createDataFrame(rows, "name string, _project string, _version string, loc double, bug int, t int")
    out = {r.name: r for r in clean.clean_modules(df, [F.desc("t")]).collect()}
    assert set(out) == {"a", "b", "c"}
    assert (out["a"].bug, out["a"].is_buggy, out["a"].bug_density) == (3, 1, 0.3)
    assert (out["b"].is_buggy, out["b"].bug_density) == (1, 0.0)
    assert (out["c"].is_buggy, out["c"].bug_density) == (0, 0.0)


def test_issues(spark):
    rows = [
        ("open", ts("2020-01-01 10:00"), None, 1),
        ("same", ts("2020-01-01 10:00"), ts("2020-01-01 10:00"), 1),
        ("night", ts("2020-01-01 23:59"), ts("2020-01-02 00:01"), 1),
        ("inverted", ts("2020-01-02 10:00"), ts("2020-01-02 09:59"), 1),
        ("future", ts("2021-01-02 00:00"), None, 1),
        ("unparsed", None, None, 1),
        (None, ts("2020-01-01 10:00"), None, 1),
        # The latest copy is inverted: it is dropped before copies are compared.
        ("copy", ts("2020-03-01 10:00"), ts("2020-03-04 10:00"), 1),
        ("copy", ts("2020-03-01 10:00"), ts("2020-02-04 10:00"), 2),
    ]
    df = spark.createDataFrame(rows, "issue_key string, created timestamp, resolved timestamp, t int")
    as_of = F.lit("2021-01-01").cast("timestamp")
    out = {r.issue_key: r for r in clean.clean_issues(df, [F.desc("t")], as_of).collect()}
    assert set(out) == {"open", "same", "night", "copy"}
    assert {k: r.cycle_time_days for k, r in out.items()} == {"open": None, "same": 0, "night": 1, "copy": 3}
    assert (out["open"].is_resolved, out["same"].is_resolved) == (0, 1)
    assert (out["open"].year_created, out["open"].month_created, out["open"].age_days) == (2020, 1, 366)


def test_dedup_drops_copies_before_the_shuffle(spark, plan_of):
    df = spark.range(100).select((F.col("id") > 2).alias("k"), "id")
    out = clean.dedup_latest(df, ["k"], [F.desc("id")])
    assert sorted(tuple(r) for r in out.collect()) == [(False, 2), (True, 99)]
    plan = plan_of(clean.dedup_latest(df, ["k"], [F.desc("id")]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_set_difference_is_distinct_and_null_safe(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (3, "y")], "a int, b string")
    right = spark.createDataFrame([("y", 3), ("z", 9), (None, 4)], "b string, a int")
    assert sorted(map(str, clean.set_difference(left, right).collect())) == sorted(map(str, left.subtract(right.select("a", "b")).collect()))
    same_null = spark.createDataFrame([(None, 1)], "b string, a int")
    assert {r.a for r in clean.set_difference(left, same_null).collect()} == {2, 3}


def test_decimals_to_double(spark):
    df = spark.createDataFrame([(Decimal("1.25"), 7, "s")], "`a.b` decimal(5,2), i int, s string")
    out = clean.decimals_to_double(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["double", "int", "string"]
    assert tuple(out.first()) == (1.25, 7, "s")


def test_feature_array_and_complete_rows(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 3.0)], "a int, b double")
    assert clean.feature_array(clean.complete_rows(df, ["a"]), ["a", "b"]).first().features == [1.0, 2.0]


@pytest.mark.parametrize(
    ("score", "tier"),
    [(50.0, "[P0] CRITICAL"), (49.9, "[P1] HIGH"), (30.0, "[P1] HIGH"), (20.0, "[P2] MEDIUM"), (19.9, "[P3] LOW"), (None, "[P3] LOW")],
)
def test_tiers(spark, score, tier):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(c.priority_tier("s")).first()[0] == tier


def test_column_functions(spark):
    df = spark.createDataFrame([("a.b.Name", "log4j foo-bar", None)], "n string, t string, z string")
    row = df.select(
        c.last_part("n").alias("last"),
        c.short_label("t", "n").alias("label"),
        c.letter_bucket("t").alias("letter"),
        F.initcap("t").alias("title"),
        c.percent(F.lit(1), F.lit(0), 2).alias("no_whole"),
        c.percent(F.lit(201), F.lit(20000), 2).alias("half_up"),
        c.rate_band(F.lit(50.0)).alias("band"),
    ).first()
    assert row.last == "Name" and row.label == "log4j foo-bar • Name" and row.letter == "L"
    assert row.title == "Log4j Foo-bar" and row.no_whole is None and row.half_up == 1.01 and row.band == "medium"


def test_dealt_rows_are_sorted_after_the_shuffle_only(spark, plan_of):
    """No task sorts a whole split of its input; rows are those of the plain form, copies and null parts of a key included."""
    df = spark.range(60).select(
        (F.col("id") % 7).alias("o"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("n"), F.lit("x" * 20).alias("t"), "id"
    )
    out = clean.dedup_latest(df, ["o", "n"], [F.desc("id")], dealt_by=["o"])
    assert sorted(map(str, out.collect())) == sorted(map(str, clean.dedup_latest(df, ["o", "n"], [F.desc("id")]).collect()))
    plan = plan_of(clean.dedup_latest(df, ["o", "n"], [F.desc("id")], dealt_by=["o"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Sort [" not in plan.partition("Exchange hashpartitioning")[2]


def test_items_are_shuffled_once_on_the_way_to_issues(spark, plan_of):
    """The join lays the items of an order together; cleaning them takes no further shuffle."""
    from conftest import SMALL

    from orelake.workload import views as v

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = v.item_issues(v.raw_issues(spark, SMALL))
        rows.count()
        plan = plan_of(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "hashpartitioning(issue_key" not in plan
    assert plan.partition("hashpartitioning(l_orderkey")[0].count("Exchange") == 1
