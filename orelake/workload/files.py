"""Queries on files and tables that Spark first writes from the given tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.constants import TICKET_COLUMNS, TICKET_DATE_FORMAT
from orelake.functions import columns as c
from orelake.operators import clean, quality
from orelake.sinks import tables as sinks
from orelake.sources import files
from orelake.storage import new_path, one_writer_per_value, write_out
from orelake.workload import checks
from orelake.workload import views as v
from orelake.workload.registry import query

_DAY = datetime(2001, 1, 1, tzinfo=timezone.utc)
_ITEM_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_FOLDER = {"kind": r"/kind=([^/]+)/[^/]+\.csv$"}


def _item_files(spark: SparkSession, folder: str) -> str:
    """Line items as CSV, one folder per flag; returns the glob of the files."""
    path = new_path(spark, "items-csv")
    items = v.table(spark, folder, "lineitem").select(*_ITEM_COLUMNS, F.col("l_returnflag").alias("kind"))
    with one_writer_per_value(spark):
        items.write.partitionBy("kind").option("header", "true").csv(path)
    return f"{path}/*/*.csv"


@query(f"SELECT {', '.join(_ITEM_COLUMNS)}, l_returnflag AS kind FROM lineitem")
def scan_csv_typed(spark: SparkSession, folder: str) -> DataFrame:
    glob = _item_files(spark, folder)
    schema = v.table(spark, folder, "lineitem").select(*_ITEM_COLUMNS).schema
    rows = files.with_path_columns(files.read_typed_csv(spark, glob, schema), _FOLDER)
    return rows.drop(files.SOURCE_FILE)


@query(
    """SELECT l_orderkey || '-' || l_linenumber AS issue_key, o_orderpriority AS issue_type, o_orderstatus AS status,
              n_name || '-' || c_mktsegment AS project_key, upper(left(n_name, 1)) AS _system_bucket,
              date_trunc('minute', o_orderdate) AS created, date_trunc('minute', l_shipdate) AS resolved
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
)
def scan_csv_strings(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets written with the landing header, read as text, renamed and parsed."""
    path = new_path(spark, "tickets-csv")
    header = {new: old for old, new in TICKET_COLUMNS.items()}
    issues = v.raw_issues(spark, folder).select(
        "issue_key",
        "issue_type",
        "status",
        "project_key",
        F.date_format("created", TICKET_DATE_FORMAT).alias("created_str"),
        F.date_format("l_shipdate", TICKET_DATE_FORMAT).alias("resolved_str"),
    )
    clean.rename(issues, header).write.option("header", "true").csv(path)
    texts = clean.rename(files.read_text_csv(spark, f"{path}/*.csv"), TICKET_COLUMNS)
    dated = clean.parse_dates(texts, {"created": "created_str", "resolved": "resolved_str"}, TICKET_DATE_FORMAT)
    return dated.withColumn("_system_bucket", c.letter_bucket("project_key")).drop(files.SOURCE_FILE)


@query("SELECT l_returnflag AS kind, count(*) AS data_rows FROM lineitem GROUP BY l_returnflag")
def file_line_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines per file, summed per folder since the number of files is up to Spark."""
    counts = files.file_line_counts(spark, _item_files(spark, folder))
    per_folder = files.with_path_columns(counts, _FOLDER).groupBy("kind")
    return per_folder.agg(F.sum("data_rows").alias("data_rows"))


@query("SELECT count(*) AS data_rows FROM lineitem")
def landing_totals(spark: SparkSession, folder: str) -> DataFrame:
    return files.landing_totals(spark, _item_files(spark, folder)).select("data_rows")


@query(
    """SELECT l_returnflag AS kind, CAST(6 AS INTEGER) AS n_columns, true AS all_conform, count(*) AS data_rows
       FROM lineitem GROUP BY l_returnflag"""
)
def check_headers(spark: SparkSession, folder: str) -> DataFrame:
    checked = files.check_headers(spark, _item_files(spark, folder), len(_ITEM_COLUMNS))
    return (
        files.with_path_columns(checked, _FOLDER)
        .groupBy("kind")
        .agg(
            F.max("n_columns").alias("n_columns"),
            F.every("conforms").alias("all_conform"),
            F.sum("data_rows").alias("data_rows"),
        )
    )


@query(
    """SELECT kind, count(*) AS data_rows, count(*) FILTER (l_quantity > 10) AS table_rows,
              count(*) FILTER (l_quantity <= 10) AS missing
       FROM (SELECT l_returnflag AS kind, l_quantity FROM lineitem) GROUP BY kind"""
)
def reconcile_files(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the files against the rows of a table that lost some."""
    counts = files.with_path_columns(files.file_line_counts(spark, _item_files(spark, folder)), _FOLDER)
    kept = v.table(spark, folder, "lineitem").filter("l_quantity > 10").withColumnRenamed("l_returnflag", "kind")
    return quality.reconcile(counts, kept, ["kind"])


# --- table writes: a database of its own in the shared folder per query ------


def _database(spark: SparkSession, label: str) -> str:
    path = new_path(spark, label)
    name = "orelake_" + path.rsplit("/", 1)[-1].replace("-", "_")
    sinks.create_layers(spark, {name: "tables written by a query"}, path)
    return name


_ORDER_COLUMNS = "o_orderkey, o_custkey, o_totalprice, o_orderpriority"


@query(f"SELECT {_ORDER_COLUMNS}, o_orderstatus FROM orders")
def save_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """Partitioned, clustered overwrite, done twice, then read back."""
    name = _database(spark, "partitioned") + ".orders"
    orders = v.table(spark, folder, "orders").drop("o_orderdate")
    sinks.save_table(orders.select("o_orderkey"), name)
    return sinks.save_table(orders, name, ["o_orderstatus"], ["o_orderpriority", "o_custkey"], comment="orders")


@query(
    f"""SELECT {_ORDER_COLUMNS}, NULL AS o_orderstatus FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT {_ORDER_COLUMNS}, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL SELECT o_orderkey, NULL, o_totalprice, NULL, o_orderstatus FROM orders"""
)
def append_new_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Appends that bring a new column and leave out known ones."""
    name = _database(spark, "append") + ".orders"
    orders = v.table(spark, folder, "orders").drop("o_orderdate")
    sinks.append_table(orders.filter("o_orderstatus = 'F'").drop("o_orderstatus"), name)
    sinks.append_table(orders.filter("o_orderstatus <> 'F'"), name)
    return sinks.append_table(orders.select("o_orderstatus", "o_totalprice", "o_orderkey"), name)


_RULES = [("bug_non_negative", "bug >= 0"), ("loc_non_negative", "loc >= 0")]


@query(
    v.with_views(
        "m_dirty",
        """SELECT CASE WHEN bug >= 0 AND loc >= 0 THEN 'kept' ELSE 'quarantined' END AS target, _project, _version,
                  name, bug, loc FROM m_dirty""",
    )
)
def save_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that meet the rules and, apart from them, those that do not."""
    base = _database(spark, "checked")
    rows = v.dirty_modules(spark, folder).select("_project", "_version", "name", "bug", "loc")
    kept = sinks.save_checked(rows, f"{base}.modules", _RULES, ["_project"], ["_version"], quarantine=f"{base}.bad")
    bad = spark.table(f"{base}.bad")
    return kept.withColumn("target", F.lit("kept")).unionByName(bad.withColumn("target", F.lit("quarantined")))


@query(
    checks.with_both(
        """SELECT run_id, table_name, check_name, status, actual FROM log, (VALUES ('run-1'), ('run-2')) AS r(run_id)
           UNION ALL
           SELECT 'run-2', 'nation', 'row_count', 'PASS', CAST(count(*) AS VARCHAR) FROM nation"""
    )
)
def dq_log_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs appended to a check log and read back."""
    name = _database(spark, "log") + ".checks"
    # Both runs log these rows: they are computed once.
    suites = write_out(checks.both_suites(spark, folder), "suites")
    extra = quality.row_count_check(v.table(spark, folder, "nation"), "nation", "row_count", 25)
    sinks.append_table(quality.as_log(suites, "run-1", _DAY), name)
    log = sinks.append_table(quality.as_log(suites.unionByName(extra), "run-2", _DAY), name)
    return log.select("run_id", "table_name", "check_name", "status", "actual")
