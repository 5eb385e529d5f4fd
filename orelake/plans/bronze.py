"""Landing files to bronze tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.constants import TICKET_COLUMNS, TICKET_DATE_FORMAT, VERSION_PATTERN
from orelake.functions.columns import letter_bucket
from orelake.operators import clean, quality
from orelake.plans.lake import CODE_RAW, TICKETS_RAW, Lake
from orelake.schemas import CODE_METRICS
from orelake.sinks.tables import save_table
from orelake.sources import files


def checked_files(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """Header check of every landed file of a bronze table; files left out by name are not checked."""
    paths, columns = {
        CODE_RAW: (lake.code_files(), len(CODE_METRICS)), TICKETS_RAW: (lake.ticket_files(), len(TICKET_COLUMNS))
    }[table]
    return files.exclude_files(files.check_headers(spark, paths, columns), lake.excluded_files)


def file_checks(spark: SparkSession, lake: Lake) -> DataFrame:
    """Check rows of the landing: one row count per bronze table, and one row per file that was left out.

    A table must hold as many rows as ``lake.expected_rows`` says, else as many
    as its conforming files have lines.
    """
    rows = None
    for table in (CODE_RAW, TICKETS_RAW):
        checked = checked_files(spark, lake, table)
        expected = dict(lake.expected_rows).get(table)
        lines = checked.filter("conforms").agg(F.coalesce(F.sum("data_rows"), F.lit(0)).alias("n")).scalar()
        counted = quality.row_count_check(
            spark.table(f"{lake.bronze}.{table}"), table, f"bronze_row_count_{table}",
            lines if expected is None else expected, "critical",
        )
        both = counted.unionByName(quality.left_out_checks(checked, table))
        rows = both if rows is None else rows.unionByName(both)
    return rows


def landed_code(spark: SparkSession, lake: Lake) -> DataFrame:
    rows = files.read_typed_csv(spark, lake.code_files(), CODE_METRICS)
    rows = files.keep_conforming(files.exclude_files(rows, lake.excluded_files), checked_files(spark, lake, CODE_RAW))
    return files.with_path_columns(
        clean.with_ingestion_time(rows), {"_project": rf"/{re.escape(lake.code_area)}/([^/]+)/[^/]+\.csv$", "_version": VERSION_PATTERN}
    )


def landed_tickets(spark: SparkSession, lake: Lake) -> DataFrame:
    rows = files.read_text_csv(spark, lake.ticket_files())
    rows = files.keep_conforming(files.exclude_files(rows, lake.excluded_files), checked_files(spark, lake, TICKETS_RAW))
    dated = clean.parse_dates(
        clean.rename(rows, TICKET_COLUMNS), {"created": "created_str", "resolved": "resolved_str"}, TICKET_DATE_FORMAT
    )
    named = files.with_path_columns(
        clean.with_ingestion_time(dated), {"_system": rf"/{re.escape(lake.ticket_area)}/([^/]+)\.csv$"}
    )
    return named.withColumn("_system_bucket", letter_bucket("project_key"))


def build(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Write both bronze tables, each from one scan of its files."""
    code = save_table(
        landed_code(spark, lake),
        f"{lake.bronze}.{CODE_RAW}",
        partition_by=["_project"],
        cluster_by=["_version"],
        comment="Code metrics per module and version with the number of defects.",
    )
    tickets = save_table(
        landed_tickets(spark, lake),
        f"{lake.bronze}.{TICKETS_RAW}",
        partition_by=["_system_bucket"],
        cluster_by=["project_key", "status"],
        comment="Tickets with the times they were created and resolved.",
    )
    return code, tickets


def reconcile_code(spark: SparkSession, lake: Lake) -> DataFrame:
    """Lines per landed file against rows of the bronze table."""
    lines = files.with_path_columns(
        files.file_line_counts(spark, lake.code_files()),
        {"_project": rf"/{re.escape(lake.code_area)}/([^/]+)/[^/]+\.csv$", "_version": VERSION_PATTERN},
    )
    return quality.reconcile(lines, spark.table(f"{lake.bronze}.{CODE_RAW}"), ["_project", "_version"])
