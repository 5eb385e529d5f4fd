"""Dashboard and priority queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.operators import decision
from orelake.operators.ranking import row_numbers
from orelake.workload import kpis
from orelake.workload import views as v
from orelake.workload.registry import half_up, pct, query

_DEFECT_SQL = f"""SELECT CAST(sum(modules) AS BIGINT) AS total_modules, CAST(sum(buggy_modules) AS BIGINT) AS total_buggy,
    count(*) AS n_projects, {pct("sum(buggy_modules)", "sum(modules)", 1)} AS overall_pct_buggy FROM g"""
_YEARLY_SQL = f"""SELECT CAST(sum(issues_created) AS BIGINT) AS total_issues, CAST(sum(issues_resolved) AS BIGINT) AS total_resolved,
    min(year) AS first_year, max(year) AS last_year, {half_up("avg(avg_cycle_days)", 1)} AS avg_of_yearly_cycle_days FROM y"""
_CHAMPION_SQL = f"""SELECT 'events-' || cell AS model_name, 'rules' AS framework, {half_up("max(value)", 4)} AS auc_test,
    {half_up("avg(value)", 4)} AS f1_test, {half_up("min(value)", 4)} AS precision_w, {half_up("stddev(value)", 4)} AS recall_w
    FROM runs WHERE cell = (SELECT min(cell) FROM runs) GROUP BY run_ts, cell ORDER BY run_ts DESC, model_name LIMIT 1"""


def _score_log(spark: SparkSession, folder: str) -> DataFrame:
    """A score log derived from events: one row per day and type, one type marked as champion."""
    runs = v.runs(spark, folder)
    first = runs.agg(F.min("cell").alias("cell"))
    return runs.groupBy("run_ts", "cell").agg(
        F.max("value").alias("auc_test"),
        F.avg("value").alias("f1_test"),
        F.min("value").alias("precision_test"),
        F.stddev("value").alias("recall_test"),
    ).select(
        "run_ts",
        F.concat(F.lit("events-"), "cell").alias("model_name"),
        F.lit("rules").alias("framework"),
        "auc_test", "f1_test", "precision_test", "recall_test",
        (F.col("cell") == first.scalar()).alias("is_champion"),
    )


@query(v.with_views("runs", "SELECT * FROM runs WHERE run_ts = (SELECT max(run_ts) FROM runs)"))
def latest_run_rows(spark: SparkSession, folder: str) -> DataFrame:
    return decision.latest_rows(v.runs(spark, folder))


@query(v.with_views("runs", _CHAMPION_SQL))
def latest_champion(spark: SparkSession, folder: str) -> DataFrame:
    return decision.latest_champion(_score_log(spark, folder))


@query(v.with_views("m i", f"SELECT * FROM ({_DEFECT_SQL}), ({_YEARLY_SQL})", g=kpis.BY_GROUP_SQL, y=kpis.YEARLY_SQL))
def headline_totals(spark: SparkSession, folder: str) -> DataFrame:
    return decision.headline_totals(kpis.by_group(spark, folder), kpis.yearly(spark, folder))


@query(
    v.with_views(
        "m i runs", f"SELECT * FROM ({_DEFECT_SQL}), ({_YEARLY_SQL}), ({_CHAMPION_SQL})", g=kpis.BY_GROUP_SQL, y=kpis.YEARLY_SQL
    )
)
def executive_summary(spark: SparkSession, folder: str) -> DataFrame:
    return decision.executive_summary(
        kpis.by_group(spark, folder), kpis.yearly(spark, folder), _score_log(spark, folder)
    )


_RISK_SQL = f"""SELECT project, count(*) AS n_test_modules, {half_up("avg(prob_buggy)", 4)} AS avg_predicted_risk,
    {half_up("100.0 * avg(prediction)", 1)} AS pct_predicted_buggy FROM pred GROUP BY project"""


@query(v.with_views("pred_all", _RISK_SQL.replace("FROM pred ", "FROM pred_all ")))
def risk_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return decision.risk_by_group(v.predictions(spark, folder, left_out=()))


@query(
    v.with_views(
        "m pred",
        """SELECT g.project, modules, buggy_modules, pct_buggy, avg_bug_density, avg_loc, n_test_modules,
                  avg_predicted_risk, pct_predicted_buggy FROM g LEFT JOIN r USING (project)""",
        g=kpis.BY_GROUP_SQL,
        r=_RISK_SQL,
    )
)
def risk_overlay(spark: SparkSession, folder: str) -> DataFrame:
    return decision.risk_overlay(kpis.by_group(spark, folder), decision.risk_by_group(v.predictions(spark, folder)))


PRIORITY_SQL = f"""SELECT g.project, modules, {half_up("pct_buggy", 1)} AS pct_buggy_hist,
    {half_up("100 * risk", 1)} AS pct_predicted_risk, {half_up("(pct_buggy + 100 * risk) / 2", 1)} AS combined_risk_score,
    {half_up("avg_bug_density", 4)} AS avg_bug_density
    FROM g LEFT JOIN (SELECT project, avg(prob_buggy) AS risk FROM pred GROUP BY project) USING (project)"""


@query(v.with_views("m pred", PRIORITY_SQL, g=kpis.BY_GROUP_SQL))
def prioritization(spark: SparkSession, folder: str) -> DataFrame:
    return decision.prioritization(kpis.by_group(spark, folder), v.predictions(spark, folder))


@query(
    v.with_views(
        "m pred",
        """SELECT *, CASE WHEN combined_risk_score >= 50 THEN '[P0] CRITICAL' WHEN combined_risk_score >= 30 THEN '[P1] HIGH'
                          WHEN combined_risk_score >= 20 THEN '[P2] MEDIUM' ELSE '[P3] LOW' END AS slt_priority FROM x""",
        g=kpis.BY_GROUP_SQL,
        x=PRIORITY_SQL,
    )
)
def prioritization_tiers(spark: SparkSession, folder: str) -> DataFrame:
    return decision.prioritization_tiers(kpis.by_group(spark, folder), v.predictions(spark, folder))


_ROLLUP_SQL = f"""SELECT source_system, domain_layer, count(*) AS n_projects, CAST(sum(records) AS BIGINT) AS total_records,
    {half_up("avg(positive_rate_pct)", 1)} AS avg_positive_rate_pct FROM x GROUP BY ALL"""


@query(v.with_views("m i dim", _ROLLUP_SQL, x=kpis.CROSS_SQL))
def cross_domain_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return decision.cross_domain_rollup(kpis.kpi_cross_domain(spark, folder))


@query(
    v.with_views(
        "m i dim",
        f"""SELECT figure, max(value) FILTER (source_system = '{v.CODE}') AS {v.CODE},
                   max(value) FILTER (source_system = '{v.PROCESS}') AS {v.PROCESS} FROM (
                SELECT source_system, 'projects' AS figure, CAST(n_projects AS DOUBLE) AS value FROM u
                UNION ALL SELECT source_system, 'records', CAST(total_records AS DOUBLE) FROM u
                UNION ALL SELECT source_system, 'avg_positive_rate', avg_positive_rate_pct FROM u) GROUP BY figure""",
        x=kpis.CROSS_SQL,
        u=_ROLLUP_SQL,
    )
)
def comparison_card(spark: SparkSession, folder: str) -> DataFrame:
    return decision.comparison_card(cross_domain_rollup(spark, folder), [v.CODE, v.PROCESS])


@query(
    v.with_views(
        "runs",
        """SELECT feature, CAST(importance AS DOUBLE) AS importance, rank FROM (
               SELECT run_ts, feature, importance, CAST(row_number() OVER (PARTITION BY run_ts ORDER BY importance DESC, feature) AS INTEGER) AS rank
               FROM (SELECT run_ts, 'user-' || user_id AS feature, sum(value) AS importance FROM (
                     SELECT run_ts, user_id, CAST(value AS DECIMAL(18,6)) AS value FROM runs) GROUP BY ALL))
           WHERE run_ts = (SELECT max(run_ts) FROM runs) ORDER BY rank LIMIT 10""",
    )
)
def dashboard_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Leading users of the newest day, in the shape of an importance table."""
    sums = (
        v.runs(spark, folder)
        .groupBy("run_ts", F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("feature"))
        .agg(F.sum(F.col("value").cast("decimal(18,6)")).alias("importance"))
    )
    ranked = row_numbers(sums, ["run_ts"], [F.desc("importance"), F.col("feature")], "rank")
    table = ranked.withColumns({"rank": F.col("rank").cast("int"), "importance": F.col("importance").cast("double")})
    return decision.top_importance(table)
