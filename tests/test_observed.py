from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orelake.operators import clean, observed, quality
from orelake.storage import write_out

KEYS = ["name", "_project", "_version"]
CONSTRAINTS = [("bug_small", "bug < 5"), ("loc_set", "loc IS NOT NULL"), ("never_null", "extra > 0")]


@pytest.fixture(scope="module")
def raw(spark):
    i = F.col("id")
    df = spark.range(5000).select(
        F.when(i % 50 != 3, F.concat(F.lit("m"), (i % 900).cast("string"))).alias("name"),
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.lit("p")).alias("_project"), F.lit("1").alias("_version"),
        F.when(i % 41 != 0, i % 700).cast("double").alias("loc"), (i % 9 - 1).cast("int").alias("bug"), i.alias("at"),
        F.when(i % 13 != 0, i).alias("extra"),
    )
    return write_out(df.repartition(6), "observed-raw")


def cleaned(rows):
    return clean.clean_modules(rows, [F.col("at")])


def scanned(spark) -> int:
    """Records read by all stages so far."""
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, none, spark._jvm.java.util.ArrayList())
    return sum(stages.apply(k).inputRecords() for k in range(stages.size()))


def test_observed_checks_are_those_of_the_plain_suite(raw):
    done = observed.write_observed(raw, cleaned, "test", quality.module_rules(), KEYS, CONSTRAINTS)
    plain = cleaned(raw)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(done.rows) == rows(plain)
    assert rows(observed.suite(done, "t", quality.module_rules(), "dup")) == rows(quality.suite("t", raw, plain, quality.module_rules(), KEYS, "dup"))
    assert rows(observed.constraint_checks(done, "t")) == rows(quality.constraint_checks(plain, CONSTRAINTS, "t"))
    assert {k for k, n in done.after.items() if n} == {"rows", "constraint:bug_small", "constraint:never_null"}


def test_rows_are_read_once_and_duplicates_take_no_shuffle(spark, raw, plan_of):
    before = scanned(spark)
    observed.write_observed(raw, cleaned, "test", quality.module_rules(), KEYS, CONSTRAINTS)
    # The raw rows, and the row counts that the footers of both hold.
    once = scanned(spark) - before
    quality.suite("t", raw, cleaned(raw), quality.module_rules(), KEYS, "dup").collect()
    plain = scanned(spark) - before - once
    assert once <= 5000 * 2 + cleaned(raw).count() and plain >= 2 * 5000
    numbered = cleaned(raw).withColumn("n", F.row_number().over(observed.Window.partitionBy(*KEYS).orderBy(*KEYS)))
    assert plan_of(numbered).count("Exchange hashpartitioning") == plan_of(cleaned(raw)).count("Exchange hashpartitioning")


def test_duplicate_keys_are_counted_once_each(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 1), ("c", 1)], "k string, v int")
    done = observed.write_observed(rows, lambda df: df, "test", [], ["k"])
    assert done.after == {"rows": 6, "duplicates": 2} and done.before == {"rows": 6}


def test_doubled_figures_are_taken_again(raw):
    figures = {"odd": F.col("at") % 2 == 1}
    right = {"rows": 5000, "odd": 2500}
    assert observed._settled({"rows": 5700, "odd": 2900}, 5000, raw, figures) == right
    assert observed._settled(dict(right), 5000, raw, figures) == right


def test_empty_table(raw):
    done = observed.write_observed(write_out(raw.limit(0), "observed-none"), cleaned, "test", quality.module_rules(), KEYS, CONSTRAINTS)
    assert done.rows.count() == 0 and set(done.before.values()) == {0} and set(done.after.values()) == {0}
