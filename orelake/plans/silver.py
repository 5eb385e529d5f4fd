"""Bronze tables to silver tables, with the check log."""

from __future__ import annotations

from datetime import timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.operators import clean, dimension, observed, quality
from orelake.plans import bronze
from orelake.plans.lake import CHECKS, CODE_CLEAN, CODE_RAW, PROJECTS, TICKETS_CLEAN, TICKETS_RAW, Lake, Run
from orelake.sinks.tables import append_table, save_checked, save_table
from orelake.storage import write_out

CODE_RULES = [
    ("bug_non_negative", "bug >= 0"),
    ("loc_non_negative", "loc >= 0"),
    ("is_buggy_binary", "is_buggy IN (0, 1)"),
]


def ticket_rules(run: Run) -> list[tuple[str, str]]:
    """A ticket is judged by the clock of its run, whenever the rule is applied."""
    return [
        ("created_not_future", f"created <= to_timestamp('{run.ts.astimezone(timezone.utc):%Y-%m-%d %H:%M:%S.%f}+00:00')"),
        ("cycle_time_non_negative", "cycle_time_days IS NULL OR cycle_time_days >= 0"),
        ("is_resolved_binary", "is_resolved IN (0, 1)"),
    ]


def latest_first(df: DataFrame) -> list[Column]:
    """Latest load first; one load stamps all its rows alike, so file and content decide ties."""
    return [F.desc("_ingestion_ts"), F.col("_source_file"), F.xxhash64(*df.columns)]


def build(spark: SparkSession, lake: Lake, run: Run, fail_on_critical: bool = False) -> None:
    """Compute silver rows and all their checks in one scan of each bronze table, log the checks, then replace the tables.

    The log is written before a broken constraint or a failed critical check
    stops the run, and the tables are only replaced after that.
    """
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT", "Z"):
        raise ValueError("dates are parsed and compared in UTC: set spark.sql.session.timeZone to UTC")
    as_of = F.lit(run.ts).cast("timestamp")
    raw_code = spark.table(f"{lake.bronze}.{CODE_RAW}")
    raw_tickets = spark.table(f"{lake.bronze}.{TICKETS_RAW}")

    rules = ticket_rules(run)

    def clean_code(rows: DataFrame) -> DataFrame:
        kept = clean.clean_modules(rows, latest_first(rows)).drop("_source_file")
        return clean.with_audit(kept, run.run_id, run.ts)

    def clean_tickets(rows: DataFrame) -> DataFrame:
        kept = clean.clean_issues(rows, latest_first(rows), as_of).drop("_source_file", "_system", "_system_bucket")
        return clean.with_audit(kept, run.run_id, run.ts)

    code_rules, issue_rules = quality.module_rules(), quality.issue_rules(as_of)
    code_pass = observed.write_observed(raw_code, clean_code, "silver-code", code_rules, ["name", "_project", "_version"], CODE_RULES)
    tickets_pass = observed.write_observed(raw_tickets, clean_tickets, "silver-tickets", issue_rules, ["issue_key"], rules)
    code, tickets = code_pass.rows, tickets_pass.rows
    projects = dimension.project_dimension(code, tickets, lake.code_source, lake.ticket_source)
    projects = write_out(clean.with_audit(projects, run.run_id, run.ts), "silver-projects")

    checks = (
        bronze.file_checks(spark, lake)
        .unionByName(observed.suite(code_pass, CODE_CLEAN, code_rules, "duplicate_natural_keys"))
        .unionByName(observed.suite(tickets_pass, TICKETS_CLEAN, issue_rules, "duplicate_issue_keys"))
        .unionByName(quality.dimension_suite(projects, PROJECTS))
        .unionByName(observed.constraint_checks(code_pass, CODE_CLEAN))
        .unionByName(observed.constraint_checks(tickets_pass, TICKETS_CLEAN))
    )
    log = append_table(
        quality.as_log(checks, run.run_id, run.ts),
        f"{lake.silver}.{CHECKS}",
        comment="Check results, one row per run, table and check.",
    )
    if fail_on_critical:
        quality.raise_on_failure(log.filter(F.col("run_id") == run.run_id))

    save_checked(
        code,
        f"{lake.silver}.{CODE_CLEAN}",
        CODE_RULES,
        partition_by=["_project"],
        cluster_by=["is_buggy", "_version"],
        comment="Code metrics, one row per module and version, with flag and density.",
        staged=True,
        interleave=True,
    )
    save_checked(
        tickets,
        f"{lake.silver}.{TICKETS_CLEAN}",
        rules,
        partition_by=["year_created"],
        cluster_by=["project_key", "issue_type"],
        comment="Tickets, one row per key, with days to resolve; inverted dates left out.",
        staged=True,
        interleave=True,
    )
    save_table(
        projects,
        f"{lake.silver}.{PROJECTS}",
        cluster_by=["source_system", "domain_layer"],
        comment="Projects of both subject areas under one id.",
    )


def retention(spark: SparkSession, lake: Lake) -> DataFrame:
    return quality.retention(
        [
            (raw, spark.table(f"{lake.bronze}.{raw}"), spark.table(f"{lake.silver}.{kept}"))
            for raw, kept in ((CODE_RAW, CODE_CLEAN), (TICKETS_RAW, TICKETS_CLEAN))
        ]
    )
