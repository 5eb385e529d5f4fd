from __future__ import annotations

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orelake.operators import clean, fingerprint, sketches
from orelake.sinks import interleave, tables
from orelake.sources import quarantine
from orelake.storage import new_path


def points(spark, n=20000):
    rng = random.Random(2)
    # The first column is skewed: half its rows are one value.
    rows = [(i, rng.choice([0, rng.randrange(10**6)]), f"k{rng.randrange(10**4):05d}") for i in range(n)]
    rows += [(n, None, None), (n + 1, 5, None)]
    return spark.createDataFrame(rows, "id long, a long, b string").repartition(4)


def test_keys_interleave_the_bits_of_exact_quantile_bins(spark):
    df = points(spark, 3000)
    rows = interleave.with_key(df, ["a", "b"], bits=4).collect()

    def bins(values):
        present = sorted(v for v in values if v is not None)
        below = {v: present.index(v) for v in set(present)}
        return [0 if v is None else below[v] * 16 // len(present) for v in values]

    for r, a, b in zip(rows, bins([r.a for r in rows]), bins([r.b for r in rows])):
        key = int("".join(x + y for x, y in zip(f"{a:04b}", f"{b:04b}")), 2)
        assert r.layout_key == key
    with pytest.raises(ValueError):
        interleave.interleaved([F.lit(0)] * 8, 8)
    empty = interleave.with_key(df.limit(0), ["a", "b"])
    assert empty.count() == 0


def groups_read(path: str, column: str, value) -> tuple[int, int]:
    """Row groups that may hold ``value`` by their statistics, and all."""
    hit = total = 0
    for file in glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        place = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(place).statistics
            total += 1
            hit += stats.min <= value <= stats.max
    return hit, total


def test_filter_on_the_second_column_reads_fewer_row_groups(spark, database):
    df = points(spark).filter("a is not null and b is not null")
    location = spark.catalog.getDatabase(database).locationUri
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        tables.save_table(df, f"{database}.plain", cluster_by=["a", "b"])
        both = tables.save_table(df, f"{database}.both", cluster_by=["a", "b"], interleave=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, df.collect()))
    plain, all_plain = groups_read(f"{location}/plain", "b", "k05000")
    woven, all_woven = groups_read(f"{location}/both", "b", "k05000")
    assert all_plain > 30 and all_woven > 30
    assert woven / all_woven < 0.4 < plain / all_plain
    first, _ = groups_read(f"{location}/both", "a", 500_000)
    assert first / all_woven < 0.75


def test_sketches_of_days_merge_to_the_whole_and_grow_by_appends(spark, database):
    rng = random.Random(1)
    rows = [(f"2020-01-{rng.randrange(1, 29):02d}", rng.choice("ab"), rng.gauss(0, 1), rng.randrange(700)) for _ in range(20000)]
    df = spark.createDataFrame(rows, "d string, g string, v double, u int")
    day = F.to_date("d")
    early, late = df.filter("d < '2020-01-15'"), df.filter("d >= '2020-01-15'")
    name = f"{database}.days"
    for part in (early, late):
        stored = tables.append_table(sketches.daily(part, day, ["g"], ["v"], ["u"]), name)
    whole = sketches.daily(df, day, ["g"], ["v"], ["u"])
    figures = {"q1": ("v", 0.25), "q9": ("v", 0.9)}
    by_append = {r.g: r for r in sketches.report(stored, ["g"], figures, ["u"]).collect()}
    rebuilt = {r.g: r for r in sketches.report(whole, ["g"], figures, ["u"]).collect()}
    for g in "ab":
        values = sorted(r[2] for r in rows if r[1] == g)
        exact = len({r[3] for r in rows if r[1] == g})
        assert by_append[g].n == rebuilt[g].n == len(values)
        assert by_append[g].u_distinct == rebuilt[g].u_distinct
        assert abs(by_append[g].u_distinct - exact) <= sketches.COUNT_ERROR * exact
        for r in (by_append[g], rebuilt[g]):
            for q, share in (("q1", 0.25), ("q9", 0.9)):
                rank = sum(x <= r[q] for x in values) / len(values)
                assert abs(rank - share) <= sketches.RANK_ERROR
    none = spark.createDataFrame([("2020-01-01", "a", None, None)], df.schema)
    empty = sketches.report(sketches.daily(none, day, ["g"], ["v"], ["u"]), ["g"], figures, ["u"]).first()
    assert (empty.n, empty.q1, empty.u_distinct) == (1, None, 0)


def test_every_physical_row_is_parsed_or_in_quarantine(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,price\n1,ok,2.5\n2,"broken,3\nx,wrong type,1\n\n4,short\n5,too,1,many\n6,,\n  \n"7","quo""ted",8\n')
    (tmp_path / "b.csv").write_text("id,name,price\n")
    (tmp_path / "c.csv").write_text("id,name,price\n8,last,0.5")
    schema = spark.createDataFrame([], "id int, name string, price double").schema
    glob_ = f"{tmp_path}/*.csv"
    parsed = quarantine.read(spark, glob_, schema, escape='"')
    assert sorted((r.id, r.name, r.price) for r in parsed.rows.collect()) == [(1, "ok", 2.5), (6, None, None), (7, 'quo"ted', 8.0), (8, "last", 0.5)]
    bad = {(r.line, r.reason) for r in parsed.quarantine.collect()}
    assert bad == {('2,"broken,3', "malformed"), ("x,wrong type,1", "malformed"), ("", "blank"), ("4,short", "malformed"), ("5,too,1,many", "malformed"), ("  ", "blank")}
    assert [r.missing for r in quarantine.accounted(spark, glob_, parsed).collect()] == [0, 0, 0]


def test_one_changed_cell_is_found_where_counts_are_equal(spark):
    rows = [("x", i, f"v{i % 7}", None if i % 5 else i) for i in range(400)] + [("y", 1, "a", 2)] * 3 + [(None, 1, None, "a")[:3] + (4,)]
    df = spark.createDataFrame(rows, "k string, i long, s string, n long").repartition(5)
    columns = ["i", "s", "n"]
    again = {r.k: tuple(r)[1:] for r in fingerprint.reconcile_content(df, df.repartition(3), ["k"], columns).collect()}
    assert again == {"x": (400, 400, True), "y": (3, 3, True), None: (1, 1, True)}
    swapped = df.withColumn("s", F.when((F.col("k") == "x") & (F.col("i") == 77), F.lit("v1")).otherwise(F.col("s")))
    assert {r.k: r.same_content for r in fingerprint.reconcile_content(df, swapped, ["k"], columns).collect()} == {"x": False, "y": True, None: True}
    # A value that moves from one column to another, and one copy more or less.
    one = spark.createDataFrame([("x", None, 5)], "k string, a long, b long")
    other = spark.createDataFrame([("x", 5, None)], "k string, a long, b long")
    assert not fingerprint.reconcile_content(one, other, ["k"], ["a", "b"]).first().same_content
    fewer = fingerprint.reconcile_content(df.distinct(), df, ["k"], columns).filter("k = 'y'").first()
    assert (fewer.left_rows, fewer.right_rows, fewer.same_content) == (1, 3, False)
    # Parts add up.
    parts = fingerprint.fingerprints(df.withColumn("p", F.col("i") % 3), ["k", "p"], columns)
    whole = {r.k: tuple(r) for r in fingerprint.fingerprints(df, ["k"], columns).collect()}
    assert {r.k: tuple(r) for r in fingerprint.combined(parts, ["k"]).collect()} == whole
    assert fingerprint.reconcile_content(df.limit(0), df.limit(0), ["k"], columns).count() == 0


def test_bucketed_tables_join_and_rank_without_an_exchange(spark, database, plan_of):
    facts = spark.range(500).select((F.col("id") % 90).alias("k"), F.col("id").alias("at"), F.md5(F.col("id").cast("string")).alias("v"))
    other = spark.range(120).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    left = tables.save_bucketed(facts, f"{database}.facts", ["k"], 4, ["at"])
    right = tables.save_bucketed(other, f"{database}.other", ["k"], 4, path=new_path(spark, "bucketed"), comment="by k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = clean.dedup_latest(left, ["k"], [F.desc("at")]).join(right, "k", "left")
        assert "Exchange" not in plan_of(joined)
        plain = clean.dedup_latest(facts, ["k"], [F.desc("at")]).join(other, "k", "left")
        assert "Exchange" in plan_of(plain)
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
