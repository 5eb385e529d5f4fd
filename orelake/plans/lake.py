"""Where a lake keeps its files and tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from orelake.sinks.tables import create_layers


@dataclass(frozen=True)
class Lake:
    """Folders, databases and source names of one lake.

    ``landing`` holds ``<code_area>/<project>/<project>-<version>.csv`` and
    ``<ticket_area>/<system>.csv``.
    """

    landing: str
    artifacts: str
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    warehouse: str | None = None
    code_area: str = "code"
    ticket_area: str = "tickets"
    code_source: str = "code"
    ticket_source: str = "tickets"
    excluded_files: tuple[str, ...] = ()
    # (bronze table, rows it must hold); without an entry the lines of its files count.
    expected_rows: tuple[tuple[str, int], ...] = ()

    def code_files(self) -> str:
        return f"{self.landing}/{self.code_area}/*/*.csv"

    def ticket_files(self) -> str:
        return f"{self.landing}/{self.ticket_area}/*.csv"

    def bootstrap(self, spark: SparkSession) -> None:
        """Create the three layers; safe to run again."""
        comments = {
            self.bronze: "Rows as they landed, with their file and load time",
            self.silver: "Typed, checked and deduplicated rows",
            self.gold: "Reports, model results and decisions",
        }
        create_layers(spark, comments, self.warehouse)


@dataclass(frozen=True)
class Run:
    """Identity and clock of one run; every age and future check uses ``ts``."""

    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc))


# Names of the stored tables.
CODE_RAW = "code_metrics_raw"
TICKETS_RAW = "process_issues_raw"
CODE_CLEAN = "code_metrics_clean"
TICKETS_CLEAN = "process_issues_clean"
PROJECTS = "dim_project"
CHECKS = "_dq_metrics"
KPI_DEFECTS = "kpi_defect_distribution_by_project"
KPI_CORRELATIONS = "kpi_metric_correlations_with_target"
KPI_TOP_MODULES = "kpi_top_buggy_modules"
KPI_QUINTILES = "kpi_defect_density_quintiles"
KPI_THROUGHPUT = "kpi_throughput_yearly"
KPI_CYCLE_TIME = "kpi_cycle_time_by_issue_type"
KPI_TOP_SYSTEMS = "kpi_top_systems_by_volume"
KPI_CROSS_DOMAIN = "kpi_cross_domain_summary"
MODEL_SCORES = "ml_model_metrics"
PREDICTIONS = "ml_predictions"
CONFUSION = "ml_confusion_matrix"
IMPORTANCE = "ml_feature_importance"
PRIORITIES = "app_slt_prioritization"
