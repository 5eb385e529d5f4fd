from __future__ import annotations

import glob
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from orelake.sinks import tables
from orelake.sources.tables import list_tables, rows_to_frame
from orelake.storage import new_path, shared_folder, write_out


def test_overwrite_replaces_rows_schema_and_comment(spark, database):
    name = f"{database}.t"
    tables.save_table(spark.range(5), name, comment="it's old")
    tables.save_table(spark.createDataFrame([("x", 1)], "k string, n int"), name, comment="new", properties={"team": "me"})
    assert spark.table(name).columns == ["k", "n"] and spark.table(name).count() == 1
    assert tables.table_properties(spark, name)["team"] == "me"
    listed = list_tables(spark, [database]).collect()
    assert [(r.table_name, r.table_type, r.comment) for r in listed] == [("t", "MANAGED", "new")]


def test_catalog_listing_by_prefix_leaves_out_views(spark, database):
    for name in ("ml_b", "ml_a", "kpi_a"):
        tables.save_table(spark.range(1), f"{database}.{name}")
    spark.range(1).createOrReplaceTempView("ml_temp")
    assert [r.table_name for r in list_tables(spark, [database], like="ml%").collect()] == ["ml_a", "ml_b"]


def test_bootstrap_is_repeatable(spark, folder):
    name = "layer_" + folder.rsplit("-", 1)[-1]
    for _ in range(2):
        tables.create_layers(spark, {name: "a layer's comment"}, folder)
    assert spark.catalog.getDatabase(name).description == "a layer's comment"


def test_partitioned_write_prunes_and_splits_a_hot_partition(spark, database, plan_of):
    df = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 10).cast("string"))).alias("p"),
        (F.col("id") % 50).cast("string").alias("v"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        out = tables.save_table(df, f"{database}.p", ["p"], ["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert out.count() == 40000
    assert "PartitionFilters: [isnotnull(p" in plan_of(out.filter("p = 'hot'"))
    location = spark.catalog.getDatabase(database).locationUri
    hot_files = glob.glob(os.path.join(location.removeprefix("file:"), "p", "p=hot", "*.parquet"))
    assert len(hot_files) > 1


def test_append_adds_columns_and_fills_missing_ones(spark, database):
    name = f"{database}.log"
    tables.append_table(spark.createDataFrame([(1, "a")], "id int, v string"), name)
    tables.append_table(spark.createDataFrame([("b", 2, 0.5)], "v string, id int, score double"), name)
    tables.append_table(spark.createDataFrame([(3,)], "id int"), name)
    assert [tuple(r) for r in spark.table(name).orderBy("id").collect()] == [(1, "a", None), (2, "b", 0.5), (3, None, None)]


def test_append_to_partitioned_table(spark, database):
    name = f"{database}.log"
    tables.save_table(spark.createDataFrame([("p1", 1)], "p string, id int"), name, ["p"])
    tables.append_table(spark.createDataFrame([(2, "p2", "x")], "id int, p string, extra string"), name)
    assert [(r.id, r.extra, r.p) for r in spark.table(name).orderBy("id").collect()] == [(1, None, "p1"), (2, "x", "p2")]


RULES = [("positive", "x > 0"), ("small", "x IS NULL OR x < 10")]


def test_checked_write_keeps_the_old_table_on_violation(spark, database):
    name = f"{database}.t"
    good, bad = spark.createDataFrame([(1,), (2,)], "x int"), spark.createDataFrame([(1,), (None,), (11,)], "x int")
    tables.save_checked(good, name, RULES, comment="checked")
    with pytest.raises(tables.ConstraintViolation, match=r"positive \(1 rows\), small \(1 rows\)"):
        tables.save_checked(bad, name, RULES)
    assert sorted(r.x for r in spark.table(name).collect()) == [1, 2]
    assert [r.table_name for r in list_tables(spark, [database]).collect()] == ["t"]
    assert tables.constraints_of(spark, name) == RULES


def test_quarantine_loses_no_row(spark, database):
    bad = spark.createDataFrame([(1,), (None,), (11,)], "x int")
    kept = tables.save_checked(bad, f"{database}.t", RULES, quarantine=f"{database}.bad")
    assert [r.x for r in kept.collect()] == [1]
    assert {r.x for r in spark.table(f"{database}.bad").collect()} == {None, 11}


def test_rules_are_added_once_and_hold_for_appends(spark, database):
    name = f"{database}.t"
    tables.save_table(spark.createDataFrame([(5,)], "x int"), name)
    tables.add_constraints(spark, name, RULES)
    tables.add_constraints(spark, name, RULES)
    with pytest.raises(ValueError, match="another rule"):
        tables.add_constraints(spark, name, [("positive", "x > 1")])
    with pytest.raises(tables.ConstraintViolation):
        tables.append_table(spark.createDataFrame([(0,)], "x int"), name)
    with pytest.raises(tables.ConstraintViolation):
        tables.add_constraints(spark, name, [("large", "x > 100")])
    assert spark.table(name).count() == 1


class FakeSession:
    """A session with given settings only."""

    def __init__(self, **settings):
        self.conf = SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default))
        self.sparkContext = SimpleNamespace(applicationId="fake")


def test_shared_folder_is_read_from_the_session(spark):
    assert new_path(FakeSession(spark_checkpoint_dir="hdfs:/shared/", spark_master="yarn"), "x").startswith("hdfs:/shared/orelake/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession(spark_master="yarn"))
    local = FakeSession(spark_master="local[2]")
    assert shared_folder(local) == shared_folder(local) and os.path.isdir(shared_folder(local))
    out = write_out(spark.range(3), "x")
    assert out.count() == 3 and shared_folder(spark) in out.inputFiles()[0]


def test_rows_to_frame(spark):
    schema = spark.createDataFrame([], "a int, b string").schema
    assert rows_to_frame(spark, [(1, "x")], schema).first().b == "x"


def test_append_keeps_values_or_raises(spark, database):
    name = f"{database}.kept"
    tables.append_table(spark.createDataFrame([(1, 10)], "id int, big bigint"), name)
    with pytest.raises(TypeError, match="id: double into int"):
        tables.append_table(spark.createDataFrame([(2.9, 1)], "id double, big bigint"), name)
    tables.append_table(spark.createDataFrame([(2, 20)], "ID int, Big int"), name)
    assert spark.table(name).columns == ["id", "big"]
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 10), (2, 20)]


def test_refused_append_leaves_the_table_alone(spark, database):
    name = f"{database}.ruled"
    tables.save_checked(spark.createDataFrame([(1,)], "id int"), name, [("positive", "id > 0")])
    with pytest.raises(tables.ConstraintViolation):
        tables.append_table(spark.createDataFrame([(-1, "x")], "id int, more string"), name)
    assert spark.table(name).columns == ["id"] and spark.table(name).count() == 1
    seen = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda x: (seen.add(1), x)[1], "int")
    tables.append_table(spark.createDataFrame([(5,)], "id int").select(counted("id").alias("id")), name)
    assert seen.value == 1 and spark.table(name).count() == 2


def test_files_per_partition_and_key_spans(spark, database):
    df = spark.range(0, 200_000, 1, 16).select(
        (F.col("id") % 20).alias("p"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("k"), F.md5(F.col("id").cast("string")).alias("payload")
    )
    where = spark.catalog.getDatabase(database).locationUri.removeprefix("file:")
    tables.save_table(df, f"{database}.parts", ["p"], ["k"])
    per = [len(glob.glob(os.path.join(d, "*.parquet"))) for d in glob.glob(os.path.join(where, "parts", "p=*"))]
    assert len(per) == 20 and max(per) <= 2
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = tables.save_table(df.drop("p"), f"{database}.ranged", cluster_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = out.groupBy(F.input_file_name()).agg((F.max("k") - F.min("k")).alias("span")).collect()
    assert len(spans) > 4 and max(r.span for r in spans) < 400


def test_a_released_table_is_gone_and_others_stay(spark):
    from orelake.storage import release

    first, second = write_out(spark.range(5), "kept"), write_out(spark.range(7), "spent")
    path = second._written_path.removeprefix("file:")
    assert os.path.exists(path)
    release(second, second, first.select("id"))
    assert not os.path.exists(path) and first.count() == 5
