"""Queries for the gold tables and the dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.operators import dimension, kpi
from orelake.operators.ranking import ntile_rows
from orelake.workload import views as v
from orelake.workload.registry import half_up, pct, query

YEARS = (1995, 2001)

BY_GROUP_SQL = f"""
    SELECT _project AS project, count(*) AS modules, CAST(sum(is_buggy) AS BIGINT) AS buggy_modules,
           {pct("sum(is_buggy)", "count(*)", 2)} AS pct_buggy, CAST(sum(bug) AS BIGINT) AS total_bugs,
           {half_up("avg(bug_density)", 5)} AS avg_bug_density,
           {half_up("quantile_disc(bug_density, 0.5)", 5)} AS median_bug_density,
           {half_up("avg(loc)", 1)} AS avg_loc, {half_up("stddev(loc)", 1)} AS std_loc
    FROM m GROUP BY _project"""

YEARLY_SQL = f"""
    SELECT year_created AS year, count(*) AS issues_created, CAST(sum(is_resolved) AS BIGINT) AS issues_resolved,
           {pct("sum(is_resolved)", "count(*)", 2)} AS pct_resolved,
           {half_up("avg(cycle_time_days)", 1)} AS avg_cycle_days,
           quantile_disc(cycle_time_days, 0.5) AS median_cycle_days,
           quantile_disc(cycle_time_days, 0.95) AS p95_cycle_days,
           count(DISTINCT project_key) AS active_systems
    FROM i WHERE year_created BETWEEN {YEARS[0]} AND {YEARS[1]} GROUP BY year_created"""

CORR_SQL = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, {half_up(f"corr({f}, bug)", 4)} AS corr_with_bug,
               {half_up(f"corr({f}, is_buggy)", 4)} AS corr_with_is_buggy FROM m"""
    for f in v.FEATURES
)

TOP_SQL = f"""
    SELECT _project AS project, _version AS version, name AS module, bug AS bugs, loc AS lines_of_code,
           {half_up("bug_density", 5)} AS bug_density, l_quantity, l_discount,
           CAST(dense_rank() OVER (ORDER BY bug DESC, m.bug_density DESC) AS INTEGER) AS rank_global
    FROM m WHERE bug > 0 ORDER BY bug DESC, m.bug_density DESC, _project, _version, name LIMIT 25"""

_CROSS_COLS = "d.project_id, d.source_system, d.domain_layer, d.project_name"
CROSS_SQL = f"""
    SELECT {_CROSS_COLS}, count(f.name) AS records, CAST(sum(is_buggy) AS BIGINT) AS positive_target,
           {pct("sum(is_buggy)", "count(f.name)", 2)} AS positive_rate_pct,
           {half_up("avg(bug_density)", 5)} AS avg_bug_density, CAST(NULL AS DOUBLE) AS avg_cycle_days
    FROM dim d JOIN m f ON d.project_key = f._project AND d.source_system = '{v.CODE}' GROUP BY {_CROSS_COLS}
    UNION ALL
    SELECT {_CROSS_COLS}, count(f.issue_key), CAST(sum(is_resolved) AS BIGINT),
           {pct("sum(is_resolved)", "count(f.issue_key)", 2)}, NULL, {half_up("avg(cycle_time_days)", 1)}
    FROM dim d JOIN i f ON d.project_key = f.project_key AND d.source_system = '{v.PROCESS}' GROUP BY {_CROSS_COLS}"""


def by_group(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.defect_by_group(v.silver_modules(spark, folder))


def yearly(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.throughput_yearly(v.silver_issues(spark, folder), YEARS)


@query(v.with_views("m", BY_GROUP_SQL))
def kpi_defect_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return by_group(spark, folder)


@query(v.with_views("m", CORR_SQL))
def kpi_correlations(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.correlations(v.silver_modules(spark, folder), v.FEATURES)


@query(v.with_views("m", TOP_SQL))
def kpi_top_modules(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.top_modules(v.silver_modules(spark, folder), ["l_quantity", "l_discount"])


@query(
    v.with_views(
        "m",
        f"""SELECT project, quintile, count(*) AS modules, {half_up("min(x)", 5)} AS min_density,
                   {half_up("max(x)", 5)} AS max_density, {half_up("avg(x)", 5)} AS avg_density
            FROM (SELECT _project AS project, bug_density AS x, CAST(ntile(5) OVER (
                      PARTITION BY _project ORDER BY bug_density, name, _version) AS INTEGER) AS quintile
                  FROM m WHERE bug_density > 0)
            GROUP BY project, quintile""",
    )
)
def kpi_density_quintiles(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.density_quintiles(v.silver_modules(spark, folder))


@query(
    v.with_views(
        "m",
        """SELECT _project, name, _version, bug_density, CAST(ntile(5) OVER (
               PARTITION BY _project ORDER BY bug_density, name, _version) AS INTEGER) AS quintile
           FROM m WHERE bug_density > 0""",
    )
)
def ntile_in_group(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.silver_modules(spark, folder).filter("bug_density > 0").select("_project", "name", "_version", "bug_density")
    return ntile_rows(rows, ["_project"], ["bug_density", "name", "_version"], 5, "quintile")


@query(v.with_views("i", YEARLY_SQL))
def kpi_throughput_yearly(spark: SparkSession, folder: str) -> DataFrame:
    return yearly(spark, folder)


@query(
    v.with_views(
        "i",
        f"""SELECT project_key, count(*) AS issues, CAST(sum(is_resolved) AS BIGINT) AS resolved,
                   {half_up("avg(cycle_time_days)", 1)} AS avg_cycle_days,
                   quantile_disc(cycle_time_days, 0.5) AS median_cycle_days,
                   quantile_disc(cycle_time_days, 0.9) AS p90_cycle_days,
                   {pct("sum(is_resolved)", "count(*)", 1)} AS pct_resolved
            FROM i WHERE is_resolved = 1 GROUP BY project_key HAVING count(*) >= 100""",
    )
)
def kpi_cycle_by_group(spark: SparkSession, folder: str) -> DataFrame:
    """By system, where the row minimum leaves groups out."""
    return kpi.cycle_time_by_type(v.silver_issues(spark, folder), "project_key")


@query(
    v.with_views(
        "i",
        f"""SELECT issue_type, count(*) AS issues, CAST(sum(is_resolved) AS BIGINT) AS resolved,
                   {half_up("avg(cycle_time_days)", 1)} AS avg_cycle_days,
                   quantile_disc(cycle_time_days, 0.5) AS median_cycle_days,
                   quantile_disc(cycle_time_days, 0.9) AS p90_cycle_days,
                   {pct("sum(is_resolved)", "count(*)", 1)} AS pct_resolved
            FROM i WHERE is_resolved = 1 GROUP BY issue_type HAVING count(*) >= 100""",
    )
)
def kpi_cycle_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.cycle_time_by_type(v.silver_issues(spark, folder))


@query(
    v.with_views(
        "i",
        f"""SELECT project_key AS system_code, project_name AS system_name, count(*) AS total_issues,
                   CAST(count(*) FILTER (issue_type = '{v.BUG_TYPE}') AS BIGINT) AS bugs,
                   {pct(f"count(*) FILTER (issue_type = '{v.BUG_TYPE}')", "count(*)", 1)} AS pct_bugs,
                   {half_up("avg(cycle_time_days)", 1)} AS avg_cycle_days,
                   min(year_created) AS first_year, max(year_created) AS last_year
            FROM i GROUP BY project_key, project_name
            ORDER BY total_issues DESC, system_code, system_name LIMIT 20""",
    )
)
def kpi_top_systems(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.top_systems(v.silver_issues(spark, folder), v.BUG_TYPE)


@query(v.with_views("m i dim", CROSS_SQL))
def kpi_cross_domain(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.cross_domain(
        v.silver_modules(spark, folder), v.silver_issues(spark, folder), v.dimension(spark, folder), v.CODE, v.PROCESS
    )


@query(v.with_views("dim", "SELECT * FROM dim"))
def dim_project(spark: SparkSession, folder: str) -> DataFrame:
    return dimension.project_dimension(
        v.silver_modules(spark, folder), v.silver_issues(spark, folder), v.CODE, v.PROCESS
    )


@query(
    v.with_views(
        "m dim",
        f"""SELECT name, _version, project_id, project_name, n_records, n_versions
            FROM m JOIN dim ON _project = project_key AND source_system = '{v.CODE}'""",
    )
)
def join_dimension(spark: SparkSession, folder: str) -> DataFrame:
    joined = kpi.join_dimension(v.silver_modules(spark, folder), v.dimension(spark, folder), "_project", v.CODE)
    return joined.select("name", "_version", "project_id", "project_name", "n_records", "n_versions")


@query(
    v.with_views(
        "m",
        """SELECT rank_global, project, version, module, bugs, project || ' • ' || module AS label
           FROM top ORDER BY rank_global, project, version, module LIMIT 15""",
        top=TOP_SQL,
    )
)
def top_modules_15(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.labelled_top_modules(kpi.top_modules(v.silver_modules(spark, folder)))


@query(
    v.with_views(
        "m i dim",
        f"""SELECT project_id, source_system, project_name, records, positive_rate_pct, avg_cycle_days
            FROM (SELECT *, row_number() OVER (PARTITION BY source_system ORDER BY records DESC, project_id) AS rn FROM x)
            WHERE rn <= CASE source_system WHEN '{v.CODE}' THEN 11 ELSE 10 END""",
        x=CROSS_SQL,
    )
)
def top_n_per_source(spark: SparkSession, folder: str) -> DataFrame:
    top = kpi.top_per_group(
        kpi_cross_domain(spark, folder),
        "source_system",
        [F.desc("records"), F.col("project_id")],
        {v.CODE: 11, v.PROCESS: 10},
    )
    return top.select("project_id", "source_system", "project_name", "records", "positive_rate_pct", "avg_cycle_days")


@query(v.with_views("m", "SELECT * FROM x ORDER BY abs(corr_with_is_buggy) DESC, feature LIMIT 5", x=CORR_SQL))
def strongest_correlations(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.strongest(kpi_correlations(spark, folder), "corr_with_is_buggy", 5, "feature")


@query(v.with_views("i", "SELECT year, issues_created, pct_resolved, avg_cycle_days FROM y ORDER BY year DESC LIMIT 5", y=YEARLY_SQL))
def last_years(spark: SparkSession, folder: str) -> DataFrame:
    last = kpi.first_rows(yearly(spark, folder), [F.desc("year")], 5)
    return last.select("year", "issues_created", "pct_resolved", "avg_cycle_days")


@query(v.with_views("m", "SELECT project, pct_buggy, buggy_modules, modules, total_bugs FROM g ORDER BY pct_buggy DESC, project LIMIT 3", g=BY_GROUP_SQL))
def top_groups_by_rate(spark: SparkSession, folder: str) -> DataFrame:
    top = kpi.first_rows(by_group(spark, folder), [F.desc("pct_buggy"), "project"], 3)
    return top.select("project", "pct_buggy", "buggy_modules", "modules", "total_bugs")
