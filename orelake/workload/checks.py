"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.operators import observed, quality
from orelake.workload import views as v
from orelake.workload.registry import pct, query

_M_CLEAN = """SELECT name, _project, _version FROM m_dirty
    WHERE name IS NOT NULL AND loc IS NOT NULL AND bug >= 0 GROUP BY ALL"""
_I_CLEAN = """SELECT issue_key FROM i_dirty
    WHERE issue_key IS NOT NULL AND created <= TIMESTAMP '2001-01-01' AND (resolved IS NULL OR resolved >= created)
    GROUP BY ALL"""


def _zero(name: str, table: str, level: str, count: str, drops: bool = False) -> str:
    details = f"'will drop ' || {count} || ' rows'" if drops else "''"
    miss = "FAIL" if level == "critical" else "WARN"
    return f"""SELECT '{table}' AS table_name, '{name}' AS check_name, '{level}' AS level, '0' AS expected,
        CAST({count} AS VARCHAR) AS actual, CASE WHEN {count} = 0 THEN 'PASS' ELSE '{miss}' END AS status,
        {details} AS details FROM s"""


def _note(name: str, table: str, expected: str, actual: str) -> str:
    return f"""SELECT '{table}', '{name}', 'info', {expected}, CAST({actual} AS VARCHAR), 'PASS', '' FROM s"""


_MT, _IT = "code_metrics_clean", "process_issues_clean"
_M_STATS = f"""SELECT count(*) AS raw, count(*) FILTER (name IS NULL) AS n1, count(*) FILTER (loc IS NULL) AS n2,
    count(*) FILTER (bug IS NULL) AS n3, count(*) FILTER (bug < 0) AS n4, (SELECT count(*) FROM ({_M_CLEAN})) AS kept
    FROM m_dirty"""
_I_STATS = f"""SELECT count(*) AS raw, count(*) FILTER (issue_key IS NULL) AS n1, count(*) FILTER (created IS NULL) AS n2,
    count(*) FILTER (created > TIMESTAMP '2001-01-01') AS n3, count(*) FILTER (resolved < created) AS n4,
    (SELECT count(*) FROM ({_I_CLEAN})) AS kept FROM i_dirty"""

M_SUITE_SQL = " UNION ALL ".join(
    [
        _zero("nulls_in_name", _MT, "critical", "n1"),
        _zero("nulls_in_loc", _MT, "critical", "n2"),
        _zero("nulls_in_bug", _MT, "critical", "n3"),
        _zero("negative_bug", _MT, "critical", "n4"),
        _note("post_dedup_row_count", _MT, "'<= ' || raw", "kept"),
        _zero("duplicate_natural_keys", _MT, "critical", "0"),
        _note("rows_dropped_in_silver", _MT, "'= ' || (raw - kept)", "raw - kept"),
    ]
)
I_SUITE_SQL = " UNION ALL ".join(
    [
        _zero("nulls_in_issue_key", _IT, "critical", "n1"),
        _zero("nulls_in_created", _IT, "warning", "n2", True),
        _zero("future_created_dates", _IT, "warning", "n3"),
        _zero("inverted_created_resolved", _IT, "warning", "n4", True),
        _note("post_dedup_row_count", _IT, "'<= ' || raw", "kept"),
        _zero("duplicate_issue_keys", _IT, "critical", "0"),
        _note("rows_dropped_inverted_dates", _IT, "'= ' || n4", "n4"),
        _note("rows_dropped_in_silver", _IT, "'= ' || (raw - kept)", "raw - kept"),
    ]
)


@query(v.with_views("m_dirty", M_SUITE_SQL, s=_M_STATS))
def dq_suite_modules(spark: SparkSession, folder: str) -> DataFrame:
    raw = v.dirty_modules(spark, folder)
    return quality.module_suite(raw, v.item_modules(raw))


@query(v.with_views("i_dirty", I_SUITE_SQL, s=_I_STATS))
def dq_suite_issues(spark: SparkSession, folder: str) -> DataFrame:
    raw = v.dirty_issues(spark, folder)
    return quality.issue_suite(raw, v.item_issues(raw), v.as_of(), keys=["l_orderkey", "issue_key"])


def both_suites(spark: SparkSession, folder: str) -> DataFrame:
    return dq_suite_modules(spark, folder).unionByName(dq_suite_issues(spark, folder))


@query(v.with_views("m_dirty", M_SUITE_SQL, s=_M_STATS))
def dq_suite_observed(spark: SparkSession, folder: str) -> DataFrame:
    """The module suite from figures that were taken while the cleaned rows were written."""
    raw, rules = v.dirty_modules(spark, folder), quality.module_rules()
    done = observed.write_observed(
        raw, v.item_modules, "observed", rules, v.MODULE_KEYS, [("bug_non_negative", "bug >= 0")]
    )
    return observed.suite(done, "code_metrics_clean", rules, "duplicate_natural_keys").unionByName(
        observed.constraint_checks(done, "code_metrics_clean")
    )


_BOTH_SQL = {
    "ms": M_SUITE_SQL.replace("FROM s", "FROM s1"),
    "is_": I_SUITE_SQL.replace("FROM s", "FROM s2"),
}


def with_both(body: str) -> str:
    return v.with_views(
        "m_dirty i_dirty", body, s1=_M_STATS, s2=_I_STATS, **_BOTH_SQL,
        log="SELECT * FROM ms UNION ALL SELECT * FROM is_",
    )


@query(with_both("SELECT level, status, count(*) AS checks FROM log GROUP BY ALL"))
def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_summary(both_suites(spark, folder))


@query(with_both("SELECT table_name, check_name, level, expected, actual, status FROM log WHERE status <> 'PASS'"))
def dq_exceptions(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_exceptions(both_suites(spark, folder))


@query(
    v.with_views(
        "dim",
        """SELECT 'dim_project' AS table_name, 'duplicate_project_id' AS check_name, 'critical' AS level, '0' AS expected,
                  CAST(count(*) - count(DISTINCT project_id) AS VARCHAR) AS actual,
                  CASE WHEN count(*) = count(DISTINCT project_id) THEN 'PASS' ELSE 'FAIL' END AS status, '' AS details FROM dim
           UNION ALL
           SELECT 'dim_project', 'row_count', 'info', '= ' || count(*), CAST(count(*) AS VARCHAR), 'PASS', '' FROM dim""",
    )
)
def dq_records(spark: SparkSession, folder: str) -> DataFrame:
    return quality.dimension_suite(v.dimension(spark, folder))


def _row_count_sql(table: str, expected: str, level: str, miss: str) -> str:
    return f"""SELECT '{table}' AS table_name, 'row_count' AS check_name, '{level}' AS level, '{expected}' AS expected,
        CAST(count(*) AS VARCHAR) AS actual, CASE WHEN count(*) = {expected} THEN 'PASS' ELSE '{miss}' END AS status,
        '' AS details FROM {table}"""


@query(
    " UNION ALL ".join(
        [
            _row_count_sql("nation", "25", "critical", "FAIL"),
            _row_count_sql("lineitem", "1", "critical", "FAIL"),
            _row_count_sql("orders", "1", "warning", "WARN"),
        ]
    )
)
def dq_row_count(spark: SparkSession, folder: str) -> DataFrame:
    """One passing, one failing and one warning check."""
    wanted = [("nation", 25, "critical"), ("lineitem", 1, "critical"), ("orders", 1, "warning")]
    first, *rest = [
        quality.row_count_check(v.table(spark, folder, name), name, "row_count", n, level) for name, n, level in wanted
    ]
    for other in rest:
        first = first.unionByName(other)
    return first


_RULES = [
    ("bug_non_negative", "bug >= 0"),
    ("loc_large", "loc >= 200"),
    ("small_or_unset", "loc IS NULL OR loc < 900"),
    ("flag_binary", "CASE WHEN bug > 0 THEN 1 ELSE 0 END IN (0, 1)"),
]


@query(
    v.with_views(
        "m_dirty",
        " UNION ALL ".join(
            f"SELECT '{name}' AS constraint_name, count(*) FILTER (({rule}) IS NOT TRUE) AS violations FROM m_dirty"
            for name, rule in _RULES
        ),
    )
)
def constraint_violations(spark: SparkSession, folder: str) -> DataFrame:
    return quality.constraint_violations(v.dirty_modules(spark, folder), _RULES)


@query(
    v.with_views(
        "i_dirty",
        """SELECT count(*) AS rows, count(*) FILTER (issue_key IS NULL) AS nulls_in_issue_key,
                  count(*) FILTER (created IS NULL) AS nulls_in_created,
                  count(*) FILTER (created > TIMESTAMP '2001-01-01') AS future_created_dates,
                  count(*) FILTER (resolved < created) AS inverted_created_resolved FROM i_dirty""",
    )
)
def violation_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.violation_counts(v.dirty_issues(spark, folder), quality.issue_rules(v.as_of()))


@query("""SELECT count(*) AS duplicates FROM (
            SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(v.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    v.with_views(
        "m i",
        f"""SELECT source, bronze_rows, silver_rows, {pct("silver_rows", "bronze_rows", 2)} AS retention_pct FROM (
                SELECT 'modules' AS source, (SELECT count(*) FROM m_raw) AS bronze_rows, (SELECT count(*) FROM m) AS silver_rows
                UNION ALL SELECT 'issues', (SELECT count(*) FROM i_raw), (SELECT count(*) FROM i))""",
    )
)
def layer_retention(spark: SparkSession, folder: str) -> DataFrame:
    return quality.retention(
        [
            ("modules", v.raw_modules(spark, folder), v.silver_modules(spark, folder)),
            ("issues", v.raw_issues(spark, folder), v.silver_issues(spark, folder)),
        ]
    )


@query(
    """SELECT f.l_returnflag, f.l_linenumber, f.data_rows, coalesce(t.table_rows, 0) AS table_rows,
              f.data_rows - coalesce(t.table_rows, 0) AS missing
       FROM (SELECT l_returnflag, l_linenumber, count(*) AS data_rows FROM lineitem GROUP BY ALL) f
       LEFT JOIN (SELECT l_returnflag, l_linenumber, count(*) AS table_rows FROM lineitem
                  WHERE l_quantity > 10 AND l_linenumber <> 3 GROUP BY ALL) t USING (l_returnflag, l_linenumber)"""
)
def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    items = v.table(spark, folder, "lineitem")
    keys = ["l_returnflag", "l_linenumber"]
    expected = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("data_rows"))
    return quality.reconcile(expected, items.filter("l_quantity > 10 AND l_linenumber <> 3"), keys)


@query(
    """SELECT CAST(count(*) AS BIGINT) AS file_total,
              CAST(count(*) FILTER (l_quantity > 10 AND l_linenumber <> 3) AS BIGINT) AS table_total,
              CAST(count(*) FILTER (l_quantity <= 10 OR l_linenumber = 3) AS BIGINT) AS total_missing FROM lineitem"""
)
def reconcile_totals(spark: SparkSession, folder: str) -> DataFrame:
    return quality.reconcile_totals(reconcile_counts(spark, folder))
