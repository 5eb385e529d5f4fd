"""Profile queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.operators import profile, sampling, scaling
from orelake.operators.dimension import rollup_dimension
from orelake.operators.kpi import throughput_yearly
from orelake.workload import views as v
from orelake.workload.registry import half_up, pct, query


@query(
    v.with_views(
        "m_raw",
        f"""SELECT _project, count(*) AS rows, count(DISTINCT _version) AS versions,
                   CAST(count(*) FILTER (bug > 0) AS BIGINT) AS buggy_modules,
                   {pct("count(*) FILTER (bug > 0)", "count(*)", 1)} AS pct_buggy
            FROM m_raw GROUP BY _project""",
    )
)
def bronze_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.bronze_profile(v.raw_modules(spark, folder))


@query(
    v.with_views(
        "i_raw",
        f"""SELECT issue_type, count(*) AS issues,
                   {half_up("avg(datediff('day', created, resolved))", 1)} AS avg_days_to_resolve
            FROM i_raw GROUP BY issue_type""",
    )
)
def avg_days_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return profile.avg_days_by_type(v.raw_issues(spark, folder))


@query(
    v.with_views(
        "m",
        f"""SELECT _project, count(*) AS rows, CAST(sum(is_buggy) AS BIGINT) AS buggy_rows,
                   {half_up("avg(bug_density)", 5)} AS avg_bug_density, {half_up("avg(loc)", 0)} AS avg_loc,
                   {pct("sum(is_buggy)", "count(*)", 1)} AS pct_buggy
            FROM m GROUP BY _project""",
    )
)
def silver_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.silver_module_profile(v.silver_modules(spark, folder))


@query(
    v.with_views(
        "i",
        f"""SELECT year_created, count(*) AS issues, CAST(sum(is_resolved) AS BIGINT) AS resolved_issues,
                   {half_up("avg(cycle_time_days)", 1)} AS avg_cycle_days,
                   quantile_disc(cycle_time_days, 0.5) AS median_cycle_days,
                   {pct("sum(is_resolved)", "count(*)", 1)} AS pct_resolved
            FROM i WHERE year_created BETWEEN 1996 AND 2000 GROUP BY year_created""",
    )
)
def silver_profile_issues(spark: SparkSession, folder: str) -> DataFrame:
    return profile.silver_issue_profile(v.silver_issues(spark, folder), 1996, 2000)


_SUMMARY = ["bug", "loc", "bug_density", "is_buggy", *v.FEATURES]


@query(
    v.with_views(
        "m",
        " UNION ALL ".join(
            f"""SELECT '{n}' AS "column", count({n}) AS count, {half_up(f"avg({n})", 6)} AS mean,
                       {half_up(f"stddev({n})", 6)} AS stddev, CAST(min({n}) AS DOUBLE) AS min,
                       CAST(max({n}) AS DOUBLE) AS max,
                       CAST(quantile_disc({n}, 0.25) AS DOUBLE) AS q25, CAST(quantile_disc({n}, 0.5) AS DOUBLE) AS q50,
                       CAST(quantile_disc({n}, 0.75) AS DOUBLE) AS q75 FROM m"""
            for n in _SUMMARY
        ),
    )
)
def numeric_summary(spark: SparkSession, folder: str) -> DataFrame:
    out = profile.numeric_summary(v.silver_modules(spark, folder), _SUMMARY, accuracy=None)
    return out.withColumns({n: F.round(n, 6) for n in ("mean", "stddev")})


@query(
    v.with_views(
        "m",
        f"""SELECT _project, {", ".join(half_up(n, 8) + f" AS {n}" for n in ("whisker_low", "q1", "median", "q3", "whisker_high"))}
            FROM (SELECT d._project, least(min(x) FILTER (x >= q1 - 1.5 * (q3 - q1)), any_value(q1)) AS whisker_low,
                         any_value(q1) AS q1, any_value(med) AS median, any_value(q3) AS q3,
                         greatest(max(x) FILTER (x <= q3 + 1.5 * (q3 - q1)), any_value(q3)) AS whisker_high
                  FROM d JOIN q ON d._project = q._project GROUP BY d._project)""",
        d="SELECT _project, bug_density AS x FROM m WHERE bug_density > 0",
        q="""SELECT _project, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med,
                    quantile_cont(x, 0.75) AS q3 FROM d GROUP BY _project""",
    )
)
def box_stats(spark: SparkSession, folder: str) -> DataFrame:
    out = profile.box_stats(v.silver_modules(spark, folder), "_project", "bug_density")
    return out.select("_project", *[F.round(n, 8).alias(n) for n in out.columns if n != "_project"])


_BUCKET = "('0x' || left(md5('42|' || name || '|' || _project || '|' || _version), 8))::BIGINT"
TRAIN_SQL = f"{_BUCKET} < {round(0.8 * 2**32)}"
_SPLIT = f"SELECT name, _project, _version, is_buggy, {TRAIN_SQL} AS is_train FROM m"
# One share per class, one of them below a thousandth.
_SHARES = {0: 0.0004, 1: 0.7505}


def _marked(spark: SparkSession, folder: str, shares: dict[int, float]) -> DataFrame:
    rows = v.silver_modules(spark, folder).select(*v.MODULE_KEYS, "is_buggy")
    return sampling.mark_train(rows, v.MODULE_KEYS, "is_buggy", shares)


@query(
    v.with_views(
        "m",
        f"""SELECT name, _project, _version, is_buggy,
                   {_BUCKET} < CASE is_buggy WHEN 0 THEN {round(_SHARES[0] * 2**32)} ELSE {round(_SHARES[1] * 2**32)} END AS is_train
            FROM m""",
    )
)
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return _marked(spark, folder, _SHARES)


@query(
    v.with_views(
        "m",
        f"""SELECT name, _project, _version, is_buggy,
                   CAST((row_number() OVER (PARTITION BY is_buggy ORDER BY {_BUCKET}, name, _project, _version) - 1) % 5 AS INTEGER) AS fold
            FROM m""",
    )
)
def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.silver_modules(spark, folder).select(*v.MODULE_KEYS, "is_buggy")
    return sampling.balanced_folds(rows, v.MODULE_KEYS, "is_buggy")


@query(
    v.with_views(
        "m",
        f"""SELECT part, is_buggy, count(*) AS rows,
                   {pct("count(*)", "sum(count(*)) OVER (PARTITION BY part)", 1)} AS pct
            FROM (SELECT 'all' AS part, is_buggy FROM s
                  UNION ALL SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END, is_buggy FROM s)
            GROUP BY part, is_buggy""",
        s=_SPLIT,
    )
)
def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    marked = _marked(spark, folder, {0: 0.8, 1: 0.8})
    parts = F.explode(F.array(F.lit("all"), F.when(F.col("is_train"), F.lit("train")).otherwise(F.lit("test"))))
    return profile.class_balance(marked.select("is_buggy", parts.alias("part")), "is_buggy", ["part"])


@query(
    v.with_views(
        "m",
        " UNION ALL ".join(
            f"""SELECT '{f}' AS feature, {half_up(f"avg({f})", 6)} AS mean, {half_up(f"stddev({f})", 6)} AS std
                FROM t""" for f in v.FEATURES
        ),
        t=f"SELECT * FROM m WHERE {TRAIN_SQL}",
    )
)
def scaling_params(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = sampling.split(v.silver_modules(spark, folder), v.MODULE_KEYS, "is_buggy")
    out = scaling.scaling_params(train, v.FEATURES)
    return out.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


_Z = [*v.FEATURES, "constant"]


@query(
    v.with_views(
        "m",
        f"""SELECT name, _project, _version, {", ".join(half_up(f"({f} - {f}_m) / coalesce(nullif({f}_s, 0), 1)", 6) + f" AS {f}_z" for f in _Z)}
            FROM c, t""",
        c="SELECT *, 1.0 AS constant FROM m",
        t="SELECT " + ", ".join(f"avg({f}) AS {f}_m, stddev({f}) AS {f}_s" for f in _Z) + f" FROM c WHERE {TRAIN_SQL}",
    )
)
def zscore(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.silver_modules(spark, folder).withColumn("constant", F.lit(1.0))
    train, _ = sampling.split(rows, v.MODULE_KEYS, "is_buggy")
    scaled = scaling.zscore(rows, train, _Z)
    return scaled.select(
        *v.MODULE_KEYS, *[F.round(F.col("features")[i], 6).alias(f"{f}_z") for i, f in enumerate(_Z)]
    )


_YEARS = (1995, 2001)


@query(
    v.with_views(
        "i",
        f"""SELECT year_created AS year, CAST(sum(is_resolved) AS BIGINT) AS issues_resolved,
                   CAST(sum(1 - is_resolved) AS BIGINT) AS issues_open, {pct("sum(is_resolved)", "count(*)", 2)} AS pct_resolved
            FROM i GROUP BY year_created""",
    )
)
def open_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return profile.open_by_year(throughput_yearly(v.silver_issues(spark, folder), _YEARS))


@query(
    v.with_views(
        "i",
        f"""SELECT year_created AS year, {half_up("avg(cycle_time_days)", 1)} AS avg_cycle_days,
                   quantile_disc(cycle_time_days, 0.5) AS median_cycle_days,
                   quantile_disc(cycle_time_days, 0.95) AS p95_cycle_days
            FROM i GROUP BY year_created""",
    )
)
def cycle_bands(spark: SparkSession, folder: str) -> DataFrame:
    return profile.cycle_bands(throughput_yearly(v.silver_issues(spark, folder), _YEARS))


@query(
    v.with_views(
        "dim",
        """SELECT source_system, domain_layer, count(*) AS projects, CAST(sum(n_records) AS BIGINT) AS total_records
           FROM dim GROUP BY ALL""",
    )
)
def dim_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollup_dimension(v.dimension(spark, folder))
