"""Cleaning queries: columns, filters, deduplication, set difference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.constants import TICKET_DATE_FORMAT
from orelake.functions import columns as c
from orelake.operators import clean
from orelake.operators.kpi import first_rows
from orelake.sources.files import with_path_columns
from orelake.workload import views as v
from orelake.workload.registry import half_up, query


@query("SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total, o_orderstatus FROM orders")
def rename_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = v.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return clean.rename(
        orders,
        {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "total", "not_there": "ignored"},
    )


@query(
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus <> 'P' THEN date_trunc('minute', o_orderdate) END AS created,
              CAST(NULL AS TIMESTAMP) AS resolved
       FROM orders"""
)
def parse_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    """Dates written in the ticket format and read back; other text gives NULL."""
    texts = v.table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", TICKET_DATE_FORMAT))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("created_str"),
        F.date_format("o_orderdate", "d.M.yyyy").alias("resolved_str"),
    )
    return clean.parse_dates(texts, {"created": "created_str", "resolved": "resolved_str"}, TICKET_DATE_FORMAT)


@query(
    """SELECT upper(left(n_name, 1)) AS bucket, count(*) AS customers
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""
)
def letter_bucket(spark: SparkSession, folder: str) -> DataFrame:
    customers, nations = v.table(spark, folder, "customer"), v.table(spark, folder, "nation")
    named = customers.join(nations, customers.c_nationkey == nations.n_nationkey)
    return named.groupBy(c.letter_bucket("n_name").alias("bucket")).agg(F.count(F.lit(1)).alias("customers"))


@query(
    v.with_views(
        "m_dirty",
        """SELECT name, _project, _version, bug, loc FROM m_dirty
           WHERE name IS NOT NULL AND loc IS NOT NULL AND bug IS NOT NULL AND bug >= 0""",
    )
)
def filter_required(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.dirty_modules(spark, folder).select("name", "_project", "_version", "bug", "loc")
    return clean.filter_required(rows, ["name", "loc", "bug"], non_negative=["bug"])


@query(
    v.with_views(
        "i_raw",
        """SELECT issue_key, created, resolved FROM i_raw
           WHERE created <= TIMESTAMP '2001-01-01' AND NOT coalesce(resolved < created, false)""",
    )
)
def filter_temporal(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.raw_issues(spark, folder).select("issue_key", "created", "resolved")
    return clean.filter_temporal(rows, "created", "resolved", v.as_of())


@query(
    v.with_views(
        "m_dirty i_raw",
        """SELECT 'bug' AS kind, name AS item, CASE WHEN bug > 0 THEN 1 ELSE 0 END AS flag FROM m_dirty
           UNION ALL
           SELECT 'resolved', issue_key, CASE WHEN resolved IS NULL THEN 0 ELSE 1 END FROM i_raw""",
    )
)
def derive_flags(spark: SparkSession, folder: str) -> DataFrame:
    modules, issues = v.dirty_modules(spark, folder), v.raw_issues(spark, folder)
    return modules.select(
        F.lit("bug").alias("kind"), F.col("name").alias("item"), c.flag(F.col("bug") > 0).alias("flag")
    ).unionByName(
        issues.select(
            F.lit("resolved").alias("kind"),
            F.col("issue_key").alias("item"),
            c.flag(F.col("resolved").isNotNull()).alias("flag"),
        )
    )


@query(
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_discount > 0 THEN l_tax / l_discount ELSE 0.0 END AS ratio FROM lineitem"""
)
def guarded_ratio(spark: SparkSession, folder: str) -> DataFrame:
    items = v.table(spark, folder, "lineitem")
    return items.select("l_orderkey", "l_linenumber", c.guarded_ratio("l_tax", "l_discount").alias("ratio"))


_DERIVED = ["issue_key", "year_created", "month_created"]


@query(v.with_views("i", f"SELECT {', '.join(_DERIVED)} FROM i"))
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    issues = v.item_issues(v.raw_issues(spark, folder))
    return issues.select(*_DERIVED)


@query(
    v.with_views(
        "i_raw",
        """SELECT issue_key, created, resolved,
                  CAST(datediff('day', created, resolved) AS INTEGER) AS cycle_time_days,
                  CAST(datediff('day', created, TIMESTAMP '2001-01-01') AS INTEGER) AS age_days
           FROM i_raw""",
    )
)
def day_differences(spark: SparkSession, folder: str) -> DataFrame:
    issues = clean.derive_issues(v.raw_issues(spark, folder), v.as_of())
    return issues.select("issue_key", "created", "resolved", "cycle_time_days", "age_days")


@query(
    v.with_views("m_dirty", "SELECT name, bug, loc, l_tax FROM m_dirty WHERE bug IS NOT NULL AND loc IS NOT NULL AND l_tax IS NOT NULL")
)
def dropna_subset(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.dirty_modules(spark, folder).select("name", "bug", "loc", "l_tax")
    return clean.complete_rows(rows, ["bug", "loc", "l_tax"])


@query(
    """SELECT 'customer:' || c_custkey AS id, 'customers' AS source,
              upper(left(n_name, 1)) || lower(substr(n_name, 2)) AS name
       FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def build_labels(spark: SparkSession, folder: str) -> DataFrame:
    customers, nations = v.table(spark, folder, "customer"), v.table(spark, folder, "nation")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        c.prefixed("customer:", F.col("c_custkey").cast("string")).alias("id"),
        F.lit("customers").alias("source"),
        F.initcap("n_name").alias("name"),
    )


@query(
    f"""SELECT l_returnflag, {half_up("sum(CAST(l_extendedprice AS DECIMAL(12,2)))", 2)} AS price,
               CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY l_returnflag"""
)
def decimals_to_double(spark: SparkSession, folder: str) -> DataFrame:
    items = v.table(spark, folder, "lineitem")
    sums = items.groupBy("l_returnflag").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("price"), F.count(F.lit(1)).alias("n")
    )
    return clean.decimals_to_double(sums)


@query(
    """SELECT c_custkey,
              CASE WHEN c_acctbal / 100 >= 50 THEN '[P0] CRITICAL' WHEN c_acctbal / 100 >= 30 THEN '[P1] HIGH'
                   WHEN c_acctbal / 100 >= 20 THEN '[P2] MEDIUM' ELSE '[P3] LOW' END AS tier,
              CASE WHEN c_acctbal / 100 > 50 THEN 'high' WHEN c_acctbal / 100 > 30 THEN 'medium' ELSE 'low' END AS band
       FROM customer"""
)
def tier_by_threshold(spark: SparkSession, folder: str) -> DataFrame:
    score = F.col("c_acctbal") / 100
    return v.table(spark, folder, "customer").select(
        "c_custkey", c.priority_tier(score).alias("tier"), c.rate_band(score).alias("band")
    )


@query(
    """SELECT p_partkey, p_brand || ' • ' || string_split(dotted, '.')[-1] AS label, left(dotted, 30) AS head
       FROM (SELECT p_partkey, p_brand, replace(p_name || ' ' || p_type, ' ', '.') AS dotted FROM part)"""
)
def short_labels(spark: SparkSession, folder: str) -> DataFrame:
    parts = v.table(spark, folder, "part").withColumn(
        "dotted", F.replace(F.concat_ws(" ", "p_name", "p_type"), F.lit(" "), F.lit("."))
    )
    return parts.select(
        "p_partkey", c.short_label("p_brand", "dotted").alias("label"), c.head_text("dotted").alias("head")
    )


@query(
    """SELECT p_partkey, p_brand AS folder_name, CAST(p_size AS VARCHAR) AS version,
              CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END AS stem FROM part"""
)
def path_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Folder, version suffix and file stem from built paths; '' where a pattern does not match."""
    paths = v.table(spark, folder, "part").select(
        "p_partkey",
        F.concat(
            F.lit("file:/landing/"), F.col("p_brand"), F.lit("/"), F.col("p_brand"), F.lit("-"),
            F.col("p_size").cast("string"), F.lit(".csv"),
        ).alias("_source_file"),
        F.when(F.col("p_size") % 2 == 1, F.concat(F.lit("file:/other/"), F.col("p_brand"), F.lit(".csv")))
        .otherwise(F.lit("file:/other/none.txt"))
        .alias("_second"),
    )
    out = with_path_columns(
        paths, {"folder_name": r"/landing/([^/]+)/", "version": r"-([0-9][0-9.a-z]*)\.csv$"}
    )
    return with_path_columns(out, {"stem": r"/other/([^/]+)\.csv$"}, "_second").drop("_source_file", "_second")


@query(v.with_views("m", "SELECT name, _project, _version, bug, loc, l_extendedprice, is_buggy, bug_density FROM m"))
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.item_modules(v.raw_modules(spark, folder))
    return rows.select("name", "_project", "_version", "bug", "loc", "l_extendedprice", "is_buggy", "bug_density")


@query(
    """SELECT DISTINCT l_partkey, l_suppkey, CASE WHEN l_linenumber > 1 THEN l_returnflag END AS kind FROM lineitem
       WHERE l_discount >= 0.05
       EXCEPT
       SELECT l_partkey, l_suppkey, CASE WHEN l_linenumber > 1 THEN l_returnflag END FROM lineitem
       WHERE l_quantity >= 25"""
)
def set_difference(spark: SparkSession, folder: str) -> DataFrame:
    items = v.table(spark, folder, "lineitem").withColumn(
        "kind", F.when(F.col("l_linenumber") > 1, F.col("l_returnflag"))
    )
    names = ["l_partkey", "l_suppkey", "kind"]
    return clean.set_difference(
        items.filter("l_discount >= 0.05").select(*names), items.filter("l_quantity >= 25").select(*names)
    )


@query(v.with_views("m", "SELECT name, _project, _version, bug, loc FROM m ORDER BY name, _project, _version LIMIT 5"))
def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.silver_modules(spark, folder).select("name", "_project", "_version", "bug", "loc")
    return first_rows(rows, v.MODULE_KEYS, 5)
