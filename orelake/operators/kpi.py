"""The gold tables that are computed from silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orelake.constants import MIN_GROUP, TOP_MODULES, TOP_SYSTEMS, YEAR_RANGE
from orelake.functions import columns as c
from orelake.operators.ranking import discrete_quantiles, merge_groups, ntile_summary, ranked_values


def _day_quantiles(df: DataFrame, by: Sequence[str], days: str, points: dict[str, float]) -> DataFrame:
    # Whole days between two dates: distinct values per group have a fixed limit.
    return discrete_quantiles(ranked_values(df, by, days, bounded=True), by, days, points)


def _near_quantiles(value: str, points: dict[str, float], accuracy: int | None) -> list[Column]:
    """Quantiles in the pass of the other aggregates, right to 1 / ``accuracy`` of the rows; none without it."""
    return [F.percentile_approx(value, p, accuracy).alias(n) for n, p in points.items()] if accuracy else []


def defect_by_group(
    df: DataFrame,
    group: str = "_project",
    flag: str = "is_buggy",
    count: str = "bug",
    density: str = "bug_density",
    size: str = "loc",
    accuracy: int | None = None,
) -> DataFrame:
    """Flagged share, totals, density and size per group.

    The median is exact; with ``accuracy`` it is ``percentile_approx`` in the
    same pass.
    """
    aggs = [
        F.count(F.lit(1)).alias("modules"),
        F.sum(flag).alias("buggy_modules"),
        F.sum(count).alias("total_bugs"),
        c.rounded_avg(density, 5).alias("avg_bug_density"),
        c.rounded_avg(size, 1).alias("avg_loc"),
        F.round(F.stddev(size), 1).alias("std_loc"),
    ]
    if accuracy:
        aggs.append(F.percentile_approx(density, 0.5, accuracy).alias("median_bug_density"))
    out = df.groupBy(group).agg(*aggs)
    if not accuracy:
        median = discrete_quantiles(ranked_values(df, [group], density), [group], density, {"median_bug_density": 0.5})
        out = merge_groups([group], out, median)
    return out.select(
        F.col(group).alias("project"),
        "modules",
        "buggy_modules",
        c.percent("buggy_modules", "modules", 2).alias("pct_buggy"),
        "total_bugs",
        "avg_bug_density",
        F.round("median_bug_density", 5).alias("median_bug_density"),
        "avg_loc",
        "std_loc",
    ).orderBy(F.desc("pct_buggy"), "project")


def correlations(df: DataFrame, features: Sequence[str], count: str = "bug", flag: str = "is_buggy") -> DataFrame:
    """Pearson correlation of every feature with two targets, in one scan.

    Features become rows first: two short aggregates per row run in generated
    code, while dozens of them side by side are too long to be compiled.
    """
    targets = {"_count": F.col(count).cast("double"), "_flag": F.col(flag).cast("double")}
    wide = df.select(
        *[e.alias(n) for n, e in targets.items()], *[F.col(f).cast("double").alias(f) for f in features]
    )
    return (
        wide.unpivot(list(targets), list(features), "feature", "_x")
        .groupBy("feature")
        .agg(
            F.round(c.pearson("_x", "_count"), 4).alias("corr_with_bug"),
            F.round(c.pearson("_x", "_flag"), 4).alias("corr_with_is_buggy"),
        )
    )


def top_modules(df: DataFrame, extra: Sequence[str] = (), limit: int = TOP_MODULES, keys: Sequence[str] = ("_project", "_version", "name")) -> DataFrame:
    """Largest positive counts with their global dense rank.

    The rank of a row depends only on rows above it, so the ordered limit comes
    first and the window sees ``limit`` rows instead of the whole table.
    """
    leading = [F.desc("bug"), F.desc("bug_density")]
    top = df.filter(F.col("bug") > 0).orderBy(*leading, *keys).limit(limit)
    return top.select(
        F.col("_project").alias("project"),
        F.col("_version").alias("version"),
        F.col("name").alias("module"),
        F.col("bug").alias("bugs"),
        F.col("loc").alias("lines_of_code"),
        F.round("bug_density", 5).alias("bug_density"),
        *extra,
        F.dense_rank().over(Window.orderBy(*leading)).alias("rank_global"),
    )


def density_quintiles(df: DataFrame, group: str = "_project", density: str = "bug_density", tiles: int = 5) -> DataFrame:
    """Count and range of positive densities per fifth of each group."""
    summary = ntile_summary(df.filter(F.col(density) > 0), [group], density, tiles, "quintile")
    return summary.select(
        F.col(group).alias("project"),
        "quintile",
        F.col("rows").alias("modules"),
        F.round("min_value", 5).alias("min_density"),
        F.round("max_value", 5).alias("max_density"),
        F.round(F.col("sum_value") / F.col("rows"), 5).alias("avg_density"),
    ).orderBy("project", "quintile")


def throughput_yearly(df: DataFrame, years: tuple[int, int] = YEAR_RANGE, accuracy: int | None = None) -> DataFrame:
    """Created and resolved tickets, days to resolve and active systems per year; ``accuracy`` as above."""
    inside = df.filter(F.col("year_created").between(*years))
    points = {"median_cycle_days": 0.5, "p95_cycle_days": 0.95}
    counts = inside.groupBy("year_created").agg(
        *_near_quantiles("cycle_time_days", points, accuracy),
        F.count(F.lit(1)).alias("issues_created"),
        F.sum("is_resolved").alias("issues_resolved"),
        c.rounded_avg("cycle_time_days", 1).alias("avg_cycle_days"),
        F.count_distinct("project_key").alias("active_systems"),
    )
    if not accuracy:
        counts = merge_groups(["year_created"], counts, _day_quantiles(inside, ["year_created"], "cycle_time_days", points))
    return (
        counts.select(
            F.col("year_created").alias("year"),
            "issues_created",
            "issues_resolved",
            c.percent("issues_resolved", "issues_created", 2).alias("pct_resolved"),
            "avg_cycle_days",
            "median_cycle_days",
            "p95_cycle_days",
            "active_systems",
        )
        .orderBy("year")
    )


def cycle_time_by_type(
    df: DataFrame, group: str = "issue_type", min_rows: int = MIN_GROUP, accuracy: int | None = None
) -> DataFrame:
    """Days to resolve per group of resolved tickets; small groups are left out; ``accuracy`` as above."""
    resolved = df.filter(F.col("is_resolved") == 1)
    points = {"median_cycle_days": 0.5, "p90_cycle_days": 0.9}
    counts = resolved.groupBy(group).agg(
        *_near_quantiles("cycle_time_days", points, accuracy),
        F.count(F.lit(1)).alias("issues"),
        F.sum("is_resolved").alias("resolved"),
        c.rounded_avg("cycle_time_days", 1).alias("avg_cycle_days"),
    )
    if not accuracy:
        counts = merge_groups([group], counts, _day_quantiles(resolved, [group], "cycle_time_days", points))
    return (
        counts.filter(F.col("issues") >= min_rows)
        .select(
            group,
            "issues",
            "resolved",
            c.percent("resolved", "issues", 1).alias("pct_resolved"),
            "avg_cycle_days",
            "median_cycle_days",
            "p90_cycle_days",
        )
        .orderBy(F.desc("issues"), group)
    )


def top_systems(df: DataFrame, bug_type: str = "Bug", limit: int = TOP_SYSTEMS) -> DataFrame:
    """Systems with the most tickets."""
    is_bug = c.flag(F.col("issue_type") == bug_type)
    return (
        df.groupBy("project_key", "project_name")
        .agg(
            F.count(F.lit(1)).alias("total_issues"),
            F.sum(is_bug).alias("bugs"),
            c.rounded_avg("cycle_time_days", 1).alias("avg_cycle_days"),
            F.min("year_created").alias("first_year"),
            F.max("year_created").alias("last_year"),
        )
        .select(
            F.col("project_key").alias("system_code"),
            F.col("project_name").alias("system_name"),
            "total_issues",
            "bugs",
            c.percent("bugs", "total_issues", 1).alias("pct_bugs"),
            "avg_cycle_days",
            "first_year",
            "last_year",
        )
        .orderBy(F.desc("total_issues"), "system_code", "system_name")
        .limit(limit)
    )


def join_dimension(facts: DataFrame, dim: DataFrame, fact_key: str, source: str) -> DataFrame:
    """Facts with the dimension rows of one source.

    No broadcast hint: the dimension grows with the projects, so the join side
    is picked at run time by measured size, and hot keys are split by AQE.
    """
    side = dim.filter(F.col("source_system") == source)
    return facts.join(side, facts[fact_key] == side["project_key"], "inner")


_DIM = ["project_id", "source_system", "domain_layer", "project_name"]


def _one_domain(
    facts: DataFrame, dim: DataFrame, fact_key: str, source: str, id_col: str, flag: str, measure: str, digits: int, out: str
) -> DataFrame:
    # Facts shrink to one row per key before they meet the dimension.
    per_key = facts.groupBy(F.col(fact_key).alias("_key")).agg(
        F.count(id_col).alias("records"),
        F.sum(flag).alias("positive_target"),
        F.sum(F.col(measure).cast("double")).alias("_sum"),
        F.count(measure).alias("_n"),
    )
    merged = join_dimension(per_key, dim, "_key", source).groupBy(*_DIM).agg(
        F.sum("records").alias("records"),
        F.sum("positive_target").alias("positive_target"),
        F.round(F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0)), digits).alias(out),
    )
    return merged.select(
        *_DIM,
        "records",
        "positive_target",
        c.percent("positive_target", "records", 2).alias("positive_rate_pct"),
        *[
            (F.col(m) if m == out else F.lit(None).cast("double")).alias(m)
            for m in ("avg_bug_density", "avg_cycle_days")
        ],
    )


def cross_domain(modules: DataFrame, issues: DataFrame, dim: DataFrame, code_source: str, process_source: str) -> DataFrame:
    """Both subject areas in one shape, one row per dimension row."""
    code = _one_domain(modules, dim, "_project", code_source, "name", "is_buggy", "bug_density", 5, "avg_bug_density")
    process = _one_domain(
        issues, dim, "project_key", process_source, "issue_key", "is_resolved", "cycle_time_days", 1, "avg_cycle_days"
    )
    return code.unionByName(process)


def strongest(df: DataFrame, value: str, limit: int, *ties: str) -> DataFrame:
    """Rows with the largest absolute value."""
    return df.orderBy(F.abs(F.col(value)).desc_nulls_last(), *ties).limit(limit)


def top_per_group(df: DataFrame, by: str, order: Sequence[Column], limits: dict[str, int]) -> DataFrame:
    """The first n rows per group value, n given per value."""
    ranked = df.filter(F.col(by).isin(*limits)).withColumn(
        "_rn", F.row_number().over(Window.partitionBy(by).orderBy(*order))
    )
    widest = ranked.filter(F.col("_rn") <= max(limits.values()))
    keep = F.lit(False)
    for value, n in limits.items():
        keep = keep | ((F.col(by) == value) & (F.col("_rn") <= n))
    return widest.filter(keep).drop("_rn")


def first_rows(df: DataFrame, order: Sequence[Column | str], limit: int) -> DataFrame:
    """An ordered limit."""
    return df.orderBy(*order).limit(limit)


def labelled_top_modules(ranking: DataFrame, limit: int = 15) -> DataFrame:
    """First rows of the stored module ranking with chart labels, sorted on read."""
    return first_rows(ranking, ["rank_global", "project", "version", "module"], limit).select(
        "rank_global", "project", "version", "module", "bugs", c.short_label("project", "module").alias("label")
    )
