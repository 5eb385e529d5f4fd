"""Queries on layouts, sketches, quarantine and reconciliation by content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.operators import clean, fingerprint, sketches
from orelake.sinks import interleave
from orelake.sinks import tables as sinks
from orelake.sources import quarantine
from orelake.storage import new_path
from orelake.workload import views as v
from orelake.workload.files import _FOLDER, _ITEM_COLUMNS, _database, _item_files, files
from orelake.workload.registry import query

_BIN = "CAST(floor((rank() OVER (ORDER BY {c}) - 1) * 256 / count(*) OVER ()) AS BIGINT)"
_BITS = " | ".join(f"(((a >> {k}) & 1) << {2 * k + 1}) | (((b >> {k}) & 1) << {2 * k})" for k in range(8))


@query(
    f"""SELECT o_orderkey, CAST({_BITS} AS BIGINT) AS layout_key FROM (
          SELECT o_orderkey, {_BIN.format(c="o_custkey")} AS a, {_BIN.format(c="o_totalprice")} AS b FROM orders)"""
)
def interleaved_key(spark: SparkSession, folder: str) -> DataFrame:
    """Key of every order over two columns of equal weight."""
    return interleave.with_key(v.table(spark, folder, "orders"), ["o_custkey", "o_totalprice"]).select("o_orderkey", "layout_key")


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def save_interleaved(spark: SparkSession, folder: str) -> DataFrame:
    """A partitioned table whose files are narrow in two columns, read back."""
    orders = v.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    name = _database(spark, "interleaved") + ".orders"
    return sinks.save_table(orders, name, ["o_orderstatus"], ["o_custkey", "o_totalprice"], interleave=True)


@query(
    v.with_views(
        "i",
        """SELECT issue_type, count(*) AS n, true AS median_in_bound, true AS p90_in_bound, true AS systems_in_bound
           FROM i WHERE cycle_time_days IS NOT NULL GROUP BY issue_type""",
    )
)
def sketched_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """Days to resolve and active projects from daily sketches, held against exact ranks and counts."""
    issues = v.silver_issues(spark, folder).filter("cycle_time_days is not null")
    days = sketches.daily(issues, F.to_date("created"), ["issue_type"], ["cycle_time_days"], ["project_key"])
    stored = sinks.append_table(days, _database(spark, "sketches") + ".days")
    figures = sketches.report(stored, ["issue_type"], {"median": ("cycle_time_days", 0.5), "p90": ("cycle_time_days", 0.9)}, ["project_key"])
    # The exact place of a reported value is between the shares of rows below it and up to it.
    one = issues.join(F.broadcast(figures), "issue_type").groupBy("issue_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("project_key").alias("exact"), F.max("project_key_distinct").alias("estimate"),
        *[F.count_if(F.col("cycle_time_days") < F.col(q)).alias(f"{q}_below") for q in ("median", "p90")],
        *[F.count_if(F.col("cycle_time_days") <= F.col(q)).alias(f"{q}_upto") for q in ("median", "p90")],
    )
    bound = lambda q, share: (
        (F.col(f"{q}_below") / F.col("n") <= share + sketches.RANK_ERROR) & (F.col(f"{q}_upto") / F.col("n") >= share - sketches.RANK_ERROR)
    ).alias(f"{q}_in_bound")
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), sketches.COUNT_ERROR * F.col("exact"))
    return one.select("issue_type", "n", bound("median", 0.5), bound("p90", 0.9), near.alias("systems_in_bound"))


@query(
    """SELECT kind, count(*) AS physical, count(*) FILTER (l_quantity > 10) AS parsed,
              count(*) FILTER (l_quantity <= 10) AS quarantined, CAST(0 AS BIGINT) AS missing
       FROM (SELECT l_returnflag AS kind, l_quantity FROM lineitem) GROUP BY kind"""
)
def quarantined_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Files in which small quantities are spoiled in four ways: every row is parsed or in quarantine."""
    items = v.table(spark, folder, "lineitem")
    schema = items.select(*_ITEM_COLUMNS).schema
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _ITEM_COLUMNS]
    good = F.concat_ws(",", *cells)
    way = F.pmod(F.col("l_orderkey"), F.lit(4))
    spoiled = (
        F.when(way == 0, F.concat(F.lit("x"), good))
        .when(way == 1, F.concat(good, F.lit(",more,cells")))
        .when(way == 2, F.concat(F.lit('"'), good))
        .otherwise(F.substring_index(good, ",", 2))
    )
    lines = items.select(F.when(F.col("l_quantity") > 10, good).otherwise(spoiled).alias(",".join(_ITEM_COLUMNS)), F.col("l_returnflag").alias("kind"))
    path = new_path(spark, "spoiled-csv")
    # Quotes are written as they are; the one column's name is the header line.
    writer = lines.write.partitionBy("kind").option("header", "true").option("quote", "\u0000").option("sep", "\u0001")
    writer.option("escapeQuotes", "false").option("emptyValue", "").csv(path)
    glob = f"{path}/*/*.csv"
    parsed = quarantine.read(spark, glob, schema)
    counted = quarantine.accounted(spark, glob, parsed)
    parts = [
        counted.select(files.SOURCE_FILE, F.col("data_rows").alias("physical"), F.lit(0).alias("parsed"), F.lit(0).alias("quarantined"), "missing"),
        *[
            rows.groupBy(files.SOURCE_FILE).agg(F.count(F.lit(1)).alias("k")).select(
                files.SOURCE_FILE, F.lit(0).alias("physical"), *[(F.col("k") if name == own else F.lit(0)).alias(name) for name in ("parsed", "quarantined")], F.lit(0).alias("missing")
            )
            for own, rows in (("parsed", parsed.rows), ("quarantined", parsed.quarantine))
        ],
    ]
    all_ = parts[0].unionByName(parts[1]).unionByName(parts[2])
    per = files.with_path_columns(all_, _FOLDER).groupBy("kind")
    return per.agg(*[F.sum(c).cast("long").alias(c) for c in ("physical", "parsed", "quarantined", "missing")])


@query(
    """SELECT l_returnflag AS kind, count(*) AS left_rows, count(*) AS right_rows,
              count(*) FILTER (l_orderkey % 3 = 0 AND l_returnflag = 'A') = 0 AS same_content
       FROM lineitem GROUP BY l_returnflag"""
)
def reconcile_by_content(spark: SparkSession, folder: str) -> DataFrame:
    """Files against a table of as many rows in which one cell of some rows is another."""
    items = v.table(spark, folder, "lineitem").select(*_ITEM_COLUMNS, F.col("l_returnflag").alias("kind"))
    schema = items.select(*_ITEM_COLUMNS).schema
    landed = files.with_path_columns(files.read_typed_csv(spark, _item_files(spark, folder), schema), _FOLDER)
    spoiled = (F.col("l_orderkey") % 3 == 0) & (F.col("kind") == "A")
    table = items.withColumn("l_suppkey", F.when(spoiled, F.col("l_suppkey") + 1).otherwise(F.col("l_suppkey")))
    return fingerprint.reconcile_content(landed, table, ["kind"], _ITEM_COLUMNS)


@query(
    """SELECT o_orderkey, o_totalprice, count(l_linenumber) AS items, max(l_extendedprice) AS largest
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_totalprice"""
)
def colocated_join(spark: SparkSession, folder: str) -> DataFrame:
    """Two bucketed tables: the latest row per key, their join and the group over it need no exchange."""
    base = _database(spark, "bucketed")
    orders = v.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    items = v.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_extendedprice")
    orders = sinks.save_bucketed(orders, f"{base}.orders", ["o_orderkey"], 16)
    items = sinks.save_bucketed(items, f"{base}.items", ["o_orderkey"], 16, ["l_linenumber"])
    latest = clean.dedup_latest(orders, ["o_orderkey"], [F.desc("o_orderdate"), F.col("o_totalprice")])
    both = latest.join(items.hint("merge"), "o_orderkey", "left")
    return both.groupBy("o_orderkey", "o_totalprice").agg(F.count("l_linenumber").alias("items"), F.max("l_extendedprice").alias("largest"))
