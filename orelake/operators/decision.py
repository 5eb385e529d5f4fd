"""Dashboard data and the priority table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.functions import columns as c


def latest_rows(df: DataFrame, time: str = "run_ts") -> DataFrame:
    """Rows of the newest run; the newest time is a scalar subquery."""
    newest = df.agg(F.max(time).alias("newest"))
    return df.filter(F.col(time) == newest.scalar())


def defect_headline(by_group: DataFrame) -> DataFrame:
    return by_group.agg(
        F.sum("modules").alias("total_modules"),
        F.sum("buggy_modules").alias("total_buggy"),
        F.count(F.lit(1)).alias("n_projects"),
    ).withColumn("overall_pct_buggy", c.percent("total_buggy", "total_modules", 1))


def throughput_headline(yearly: DataFrame) -> DataFrame:
    """The overall days are the plain mean of the yearly means."""
    return yearly.agg(
        F.sum("issues_created").alias("total_issues"),
        F.sum("issues_resolved").alias("total_resolved"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.round(F.avg("avg_cycle_days"), 1).alias("avg_of_yearly_cycle_days"),
    )


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two one-row results in one row, the right one as a scalar subquery."""
    packed = right.select(F.struct(*right.columns).alias("row"))
    return left.withColumn("_right", packed.scalar()).select(*left.columns, "_right.*")


def headline_totals(by_group: DataFrame, yearly: DataFrame) -> DataFrame:
    return _beside(defect_headline(by_group), throughput_headline(yearly))


def latest_champion(scores: DataFrame) -> DataFrame:
    """The newest row marked as champion."""
    return (
        scores.filter("is_champion")
        .orderBy(F.desc("run_ts"), "model_name")
        .limit(1)
        .select(
            "model_name",
            "framework",
            F.round("auc_test", 4).alias("auc_test"),
            F.round("f1_test", 4).alias("f1_test"),
            F.round("precision_test", 4).alias("precision_w"),
            F.round("recall_test", 4).alias("recall_w"),
        )
    )


def executive_summary(by_group: DataFrame, yearly: DataFrame, scores: DataFrame) -> DataFrame:
    return _beside(headline_totals(by_group, yearly), latest_champion(scores))


def risk_by_group(predictions: DataFrame, group: str = "project") -> DataFrame:
    """Mean probability and share of positive predictions."""
    return (
        predictions.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("n_test_modules"),
            F.round(F.avg("prob_buggy"), 4).alias("avg_predicted_risk"),
            F.round(100.0 * F.avg("prediction"), 1).alias("pct_predicted_buggy"),
        )
        .orderBy(F.desc("avg_predicted_risk"), group)
    )


def risk_overlay(by_group: DataFrame, risk: DataFrame) -> DataFrame:
    """Known rate beside predicted rate; groups without predictions stay."""
    known = by_group.select("project", "modules", "buggy_modules", "pct_buggy", "avg_bug_density", "avg_loc")
    return known.join(risk, "project", "left").orderBy(F.desc("pct_buggy"), "project")


def prioritization(by_group: DataFrame, predictions: DataFrame) -> DataFrame:
    """Mean of the known and the predicted rate per project."""
    predicted = predictions.groupBy("project").agg(F.avg("prob_buggy").alias("_risk"))
    risk = 100 * F.col("_risk")
    return (
        by_group.join(predicted, "project", "left")
        .select(
            "project",
            "modules",
            F.round("pct_buggy", 1).alias("pct_buggy_hist"),
            F.round(risk, 1).alias("pct_predicted_risk"),
            F.round((F.col("pct_buggy") + risk) / 2, 1).alias("combined_risk_score"),
            F.round("avg_bug_density", 4).alias("avg_bug_density"),
        )
        .orderBy(F.col("combined_risk_score").desc_nulls_last(), "project")
    )


def prioritization_tiers(by_group: DataFrame, predictions: DataFrame) -> DataFrame:
    """Scores with their tier; a project without predictions is in the lowest."""
    return prioritization(by_group, predictions).withColumn("slt_priority", c.priority_tier("combined_risk_score"))


def cross_domain_rollup(cross: DataFrame) -> DataFrame:
    """Projects, records and plain mean of the rates per source."""
    return (
        cross.groupBy("source_system", "domain_layer")
        .agg(
            F.count(F.lit(1)).alias("n_projects"),
            F.sum("records").alias("total_records"),
            F.round(F.avg("positive_rate_pct"), 1).alias("avg_positive_rate_pct"),
        )
        .orderBy("source_system", "domain_layer")
    )


def comparison_card(rollup: DataFrame, sources: list[str]) -> DataFrame:
    """One row per figure, one column per source."""
    figures = {
        "projects": F.col("n_projects"),
        "records": F.col("total_records"),
        "avg_positive_rate": F.col("avg_positive_rate_pct"),
    }
    rows = rollup.select(
        "source_system",
        F.inline(
            F.array(*[F.struct(F.lit(k).alias("figure"), v.cast("double").alias("value")) for k, v in figures.items()])
        ),
    )
    return rows.groupBy("figure").pivot("source_system", sources).agg(F.max("value"))


def top_importance(importances: DataFrame, limit: int = 10) -> DataFrame:
    """Leading features of the newest run."""
    return latest_rows(importances).select("feature", "importance", "rank").orderBy("rank").limit(limit)
