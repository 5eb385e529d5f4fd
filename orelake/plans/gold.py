"""Silver tables to the eight report tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orelake.constants import FEATURES, YEAR_RANGE
from orelake.operators import kpi
from orelake.plans import lake as names
from orelake.plans.lake import Lake
from orelake.sinks.tables import save_table


# Quantiles are right to this share of the rows (1 / ACCURACY) and need no pass of their own.
ACCURACY = 10000


def reports(
    spark: SparkSession, lake: Lake, years: tuple[int, int] = YEAR_RANGE, accuracy: int | None = ACCURACY
) -> dict[str, tuple[Callable[[], DataFrame], str]]:
    """Table name -> (what builds its rows, comment); nothing runs until a report is built.

    ``accuracy=None`` makes quantiles exact, at the cost of a shuffle of the values.
    """
    code = spark.table(f"{lake.silver}.{names.CODE_CLEAN}")
    tickets = spark.table(f"{lake.silver}.{names.TICKETS_CLEAN}")
    projects = spark.table(f"{lake.silver}.{names.PROJECTS}")
    return {
        names.KPI_DEFECTS: (lambda: kpi.defect_by_group(code, accuracy=accuracy), "Defect share, density and size per project."),
        names.KPI_CORRELATIONS: (lambda: kpi.correlations(code, FEATURES), "Correlation of each feature with both targets."),
        names.KPI_TOP_MODULES: (
            lambda: kpi.top_modules(code, ["wmc", "rfc", "cbo", "lcom"]),
            "Modules with the most defects.",
        ),
        names.KPI_QUINTILES: (lambda: kpi.density_quintiles(code), "Defect density per fifth of each project."),
        names.KPI_THROUGHPUT: (lambda: kpi.throughput_yearly(tickets, years, accuracy), "Tickets created and resolved per year."),
        names.KPI_CYCLE_TIME: (lambda: kpi.cycle_time_by_type(tickets, accuracy=accuracy), "Days to resolve per ticket type."),
        names.KPI_TOP_SYSTEMS: (lambda: kpi.top_systems(tickets), "Systems with the most tickets."),
        names.KPI_CROSS_DOMAIN: (
            lambda: kpi.cross_domain(code, tickets, projects, lake.code_source, lake.ticket_source),
            "Both subject areas in one shape.",
        ),
    }


def build(
    spark: SparkSession, lake: Lake, years: tuple[int, int] = YEAR_RANGE, accuracy: int | None = ACCURACY
) -> None:
    for table, (rows, comment) in reports(spark, lake, years, accuracy).items():
        save_table(rows(), f"{lake.gold}.{table}", comment=comment)
