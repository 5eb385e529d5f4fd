"""Gold tables to the summary, the dashboard data and the priority table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orelake.operators import decision
from orelake.operators.evaluate import cells_to_row, roc_points
from orelake.plans import lake as names
from orelake.plans.lake import Lake
from orelake.sinks.tables import save_table
from orelake.sources.tables import list_tables


def _gold(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    return spark.table(f"{lake.gold}.{table}")


def summary(spark: SparkSession, lake: Lake) -> DataFrame:
    return decision.executive_summary(
        _gold(spark, lake, names.KPI_DEFECTS),
        _gold(spark, lake, names.KPI_THROUGHPUT),
        _gold(spark, lake, names.MODEL_SCORES),
    )


def model_dashboard(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """ROC points, confusion cells and leading features of the newest run."""
    predictions = _gold(spark, lake, names.PREDICTIONS).withColumnRenamed("prob_buggy", "prob")
    return {
        "roc": roc_points(predictions),
        "cells": cells_to_row(decision.latest_rows(_gold(spark, lake, names.CONFUSION))),
        "importance": decision.top_importance(_gold(spark, lake, names.IMPORTANCE)),
    }


def build(spark: SparkSession, lake: Lake) -> DataFrame:
    rows = decision.prioritization_tiers(
        _gold(spark, lake, names.KPI_DEFECTS), _gold(spark, lake, names.PREDICTIONS)
    )
    return save_table(
        rows,
        f"{lake.gold}.{names.PRIORITIES}",
        comment="Projects by the mean of known and predicted defect rate.",
    )


def assets(spark: SparkSession, lake: Lake) -> DataFrame:
    """All tables of the three layers with their comments."""
    return list_tables(spark, [lake.bronze, lake.silver, lake.gold])
