"""Profiles of raw and clean tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orelake.functions import columns as c
from orelake.operators.ranking import discrete_quantiles, interpolated_quantiles, merge_groups, ranked_values

_SALTS = 32


def bronze_profile(df: DataFrame, group: str = "_project", version: str = "_version", count: str = "bug") -> DataFrame:
    """Rows, versions and rows with a positive count per group."""
    return (
        df.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_distinct(version).alias("versions"),
            F.sum(c.flag(F.col(count) > 0)).alias("buggy_modules"),
        )
        .withColumn("pct_buggy", c.percent("buggy_modules", "rows", 1))
        .orderBy(group)
    )


def avg_days_by_type(df: DataFrame, group: str = "issue_type", created: str = "created", resolved: str = "resolved") -> DataFrame:
    return (
        df.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("issues"),
            c.rounded_avg(c.days_between(created, resolved), 1).alias("avg_days_to_resolve"),
        )
        .orderBy(F.desc("issues"), group)
    )


def silver_module_profile(df: DataFrame, group: str = "_project") -> DataFrame:
    return (
        df.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("is_buggy").alias("buggy_rows"),
            c.rounded_avg("bug_density", 5).alias("avg_bug_density"),
            c.rounded_avg("loc", 0).alias("avg_loc"),
        )
        .withColumn("pct_buggy", c.percent("buggy_rows", "rows", 1))
        .orderBy(group)
    )


def silver_issue_profile(df: DataFrame, first_year: int, last_year: int) -> DataFrame:
    years = df.filter(F.col("year_created").between(first_year, last_year))
    counts = years.groupBy("year_created").agg(
        F.count(F.lit(1)).alias("issues"),
        F.sum("is_resolved").alias("resolved_issues"),
        c.rounded_avg("cycle_time_days", 1).alias("avg_cycle_days"),
    )
    # Whole days: the number of distinct values per year has a fixed limit.
    ranked = ranked_values(years, ["year_created"], "cycle_time_days", bounded=True)
    median = discrete_quantiles(ranked, ["year_created"], "cycle_time_days", {"median_cycle_days": 0.5})
    return (
        merge_groups(["year_created"], counts, median)
        .withColumn("pct_resolved", c.percent("resolved_issues", "issues", 1))
        .orderBy("year_created")
    )


def numeric_summary(df: DataFrame, names: Sequence[str], accuracy: int | None = 10000) -> DataFrame:
    """Count, mean, stddev, min, quartiles and max per column, as typed rows.

    One aggregate over one scan; quartiles are right to 1 / ``accuracy`` of the
    rows.  With None they are exact, which takes two shuffles of all values.
    """
    numbers = df.select(*[F.col(n).cast("double").alias(n) for n in names])
    basics = numbers.agg(
        *[
            F.struct(
                F.lit(n).alias("column"),
                F.count(n).alias("count"),
                F.avg(n).alias("mean"),
                F.stddev(n).alias("stddev"),
                F.min(n).alias("min"),
                F.max(n).alias("max"),
                *([F.percentile_approx(n, [0.25, 0.5, 0.75], accuracy).alias("_q")] if accuracy else []),
            ).alias(n)
            for n in names
        ]
    ).select(F.inline(F.array(*[F.col(n) for n in names])))
    if accuracy:
        return basics.select("*", *[F.col("_q")[i].alias(q) for i, q in enumerate(("q25", "q50", "q75"))]).drop("_q")
    long = numbers.unpivot([], list(names), "column", "value")
    ranked = ranked_values(long, ["column"], "value")
    quartiles = discrete_quantiles(ranked, ["column"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return merge_groups(["column"], basics, quartiles)


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles and whiskers (inside 1.5 times the quartile range) of positive values."""
    positive = df.filter((F.col(value) > 0) & F.col(group).isNotNull())
    ranked = ranked_values(positive, [group], value)
    quartiles = interpolated_quantiles(ranked, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    low, high = F.col("q1") - reach, F.col("q3") + reach
    # The values of a hot group are spread over several join keys.
    salted = ranked.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(_SALTS).cast("long")))
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)).cast("array<bigint>"))
    return (
        salted.join(quartiles.withColumn("_salt", salts), [group, "_salt"])
        .groupBy(group)
        .agg(
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(F.col(value) >= low, F.col(value))).alias("low_in"),
            F.max(F.when(F.col(value) <= high, F.col(value))).alias("high_in"),
        )
        .select(
            group,
            F.least("low_in", "q1").alias("whisker_low"),
            "q1",
            "median",
            "q3",
            F.greatest("high_in", "q3").alias("whisker_high"),
        )
        .orderBy("median", group)
    )


def class_balance(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows and share per class; the window runs over one row per class."""
    whole = Window.partitionBy(*by)
    return (
        df.groupBy(*by, label)
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("pct", c.percent("rows", F.sum("rows").over(whole), 1))
    )


def open_by_year(throughput: DataFrame) -> DataFrame:
    """Created, resolved and still open per year."""
    return throughput.select(
        "year",
        "issues_resolved",
        (F.col("issues_created") - F.col("issues_resolved")).alias("issues_open"),
        "pct_resolved",
    )


def cycle_bands(throughput: DataFrame) -> DataFrame:
    """Mean and the median to 95th percentile band per year."""
    return throughput.select("year", "avg_cycle_days", "median_cycle_days", "p95_cycle_days")
