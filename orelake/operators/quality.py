"""Data quality: rules counted in one pass, check rows, retention, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.functions import columns as c
from orelake.schemas import CHECK_LOG

LEVELS = ("critical", "warning", "info")


@dataclass(frozen=True)
class Rule:
    """A condition that rows must not meet."""

    name: str
    level: str
    violation: Column
    drops: bool = False  # violating rows are dropped by the cleaning step
    note: str | None = None  # name of an extra info row with the dropped count


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: ``rows`` and one count per rule, all in a single pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(r.violation).alias(r.name) for r in rules])


def constraint_violations(df: DataFrame, constraints: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows per named SQL rule that are not clearly true; NULL is a violation."""
    one_row = df.agg(
        *[
            F.struct(
                F.lit(name).alias("constraint_name"),
                F.count_if(~F.coalesce(F.expr(rule), F.lit(False))).alias("violations"),
            ).alias(name)
            for name, rule in constraints
        ]
    )
    return one_row.select(F.inline(F.array(*[F.col(name) for name, _ in constraints])))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of key values that occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.count_if(F.col("_n") > 1).alias("duplicates"))
    )


def status(passed: Column, level: str) -> Column:
    return F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL" if level == "critical" else "WARN"))


def _check(table: str, name: str, level: str, expected: Column, actual: Column, state: Column, details: Column) -> Column:
    if level not in LEVELS:
        raise ValueError(f"level {level!r} is none of {LEVELS}")
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(name).alias("check_name"),
        F.lit(level).alias("level"),
        expected.cast("string").alias("expected"),
        actual.cast("string").alias("actual"),
        state.alias("status"),
        details.alias("details"),
    )


def _zero_check(table: str, name: str, level: str, actual: Column, details: Column | None = None) -> Column:
    return _check(table, name, level, F.lit("0"), actual, status(actual == 0, level), F.lit("") if details is None else details)


def _note(table: str, name: str, expected: Column, actual: Column, details: str = "") -> Column:
    return _check(table, name, "info", expected, actual, F.lit("PASS"), F.lit(details))


def row_count_check(df: DataFrame, table: str, name: str, expected: int | Column, level: str = "info") -> DataFrame:
    """PASS on the expected count, else FAIL for a critical check and WARN for others."""
    wanted = expected if isinstance(expected, Column) else F.lit(expected)
    counted = df.agg(F.count(F.lit(1)).alias("n")).select("n", wanted.cast("long").alias("wanted"))
    same = status(F.col("n") == F.col("wanted"), level)
    check = _check(table, name, level, F.col("wanted"), F.col("n"), same, F.lit(""))
    return counted.select(F.inline(F.array(check)))


def left_out_checks(checked: DataFrame, table: str) -> DataFrame:
    """One warning per landed file that does not conform; none when all do."""
    columns = F.concat(F.col("n_columns").cast("string"), F.lit(" columns, "), F.col("data_rows").cast("string"), F.lit(" rows"))
    check = _check(table, "file_left_out", "warning", F.lit("expected header and rows"), columns, F.lit("WARN"), F.col("_source_file"))
    return checked.filter("NOT conforms").select(F.inline(F.array(check)))


def constraint_checks(df: DataFrame, constraints: Sequence[tuple[str, str]], table: str) -> DataFrame:
    """One failed critical check per constraint that some rows break; none when all hold."""
    return broken_constraint_rows(constraint_violations(df, constraints).filter("violations > 0"), table)


def broken_constraint_rows(broken: DataFrame, table: str) -> DataFrame:
    """Check rows of broken constraints (constraint_name, violations)."""
    check = _check(table, "constraint", "critical", F.lit("0"), F.col("violations"), F.lit("FAIL"), F.col("constraint_name"))
    return broken.select(F.inline(F.array(check)))


def _before_after(raw: DataFrame, rules: Sequence[Rule], clean: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with raw counts, clean rows and duplicate keys of the clean table."""
    # The clean table is grouped by its key anyway, which also gives its rows.
    grouped = clean.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    after = grouped.agg(
        F.struct(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(F.col("_n") > 1).alias("duplicates")
        ).alias("after")
    )
    return violation_counts(raw, rules).withColumn("after", after.scalar())


def suite(
    table: str, raw: DataFrame, clean: DataFrame, rules: Sequence[Rule], keys: Sequence[str], duplicate_check: str
) -> DataFrame:
    """Check rows for one table: rules before cleaning, keys and row counts after."""
    return suite_rows(_before_after(raw, rules, clean, keys), table, rules, duplicate_check)


def suite_rows(one_row: DataFrame, table: str, rules: Sequence[Rule], duplicate_check: str) -> DataFrame:
    """Check rows from one row of figures: ``rows``, a count per rule, and ``after`` (rows, duplicates)."""
    checks = []
    for rule in rules:
        count = F.col(rule.name)
        details = F.concat(F.lit("will drop "), count.cast("string"), F.lit(" rows")) if rule.drops else None
        checks.append(_zero_check(table, rule.name, rule.level, count, details))
    after = F.col("after")
    checks.append(
        _note(table, "post_dedup_row_count", F.concat(F.lit("<= "), F.col("rows").cast("string")), after["rows"])
    )
    checks.append(_zero_check(table, duplicate_check, "critical", after["duplicates"]))
    for rule in rules:
        if rule.note:
            expected = F.concat(F.lit("= "), F.col(rule.name).cast("string"))
            checks.append(_note(table, rule.note, expected, F.col(rule.name)))
    dropped = F.col("rows") - after["rows"]
    checks.append(
        _note(table, "rows_dropped_in_silver", F.concat(F.lit("= "), dropped.cast("string")), dropped)
    )
    return one_row.select(F.inline(F.array(*checks)))


def module_rules() -> list[Rule]:
    return [
        Rule("nulls_in_name", "critical", F.col("name").isNull()),
        Rule("nulls_in_loc", "critical", F.col("loc").isNull()),
        Rule("nulls_in_bug", "critical", F.col("bug").isNull()),
        Rule("negative_bug", "critical", F.col("bug") < 0),
    ]


def module_suite(raw: DataFrame, clean: DataFrame, table: str = "code_metrics_clean") -> DataFrame:
    return suite(table, raw, clean, module_rules(), ["name", "_project", "_version"], "duplicate_natural_keys")


def issue_rules(as_of: Column) -> list[Rule]:
    return [
        Rule("nulls_in_issue_key", "critical", F.col("issue_key").isNull()),
        Rule("nulls_in_created", "warning", F.col("created").isNull(), drops=True),
        Rule("future_created_dates", "warning", F.col("created") > as_of),
        Rule(
            "inverted_created_resolved",
            "warning",
            F.col("resolved").isNotNull() & (F.col("resolved") < F.col("created")),
            drops=True,
            note="rows_dropped_inverted_dates",
        ),
    ]


def issue_suite(
    raw: DataFrame, clean: DataFrame, as_of: Column, table: str = "process_issues_clean", keys: Sequence[str] = ("issue_key",)
) -> DataFrame:
    """``keys`` may start with columns that the issue key determines and the clean rows are dealt by."""
    return suite(table, raw, clean, issue_rules(as_of), keys, "duplicate_issue_keys")


def dimension_suite(dim: DataFrame, table: str = "dim_project") -> DataFrame:
    """Unique id and number of rows."""
    one_row = dim.groupBy("project_id").agg(F.count(F.lit(1)).alias("_n")).agg(
        F.count_if(F.col("_n") > 1).alias("duplicates"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")
    )
    return one_row.select(
        F.inline(
            F.array(
                _zero_check(table, "duplicate_project_id", "critical", F.col("duplicates")),
                _note(table, "row_count", F.concat(F.lit("= "), F.col("rows").cast("string")), F.col("rows")),
            )
        )
    )


def as_log(checks: DataFrame, run_id: str, run_ts: datetime) -> DataFrame:
    """Check rows with run id and time, in the order of the log table."""
    logged = checks.withColumns({"run_id": F.lit(run_id), "run_ts": F.lit(run_ts).cast("timestamp")})
    return logged.select(*CHECK_LOG.fieldNames())


def check_summary(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Checks per level and status."""
    if run_id is not None:
        log = log.filter(F.col("run_id") == run_id)
    return log.groupBy("level", "status").agg(F.count(F.lit(1)).alias("checks")).orderBy("level", "status")


def check_exceptions(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Checks that did not pass."""
    if run_id is not None:
        log = log.filter(F.col("run_id") == run_id)
    return (
        log.filter(F.col("status") != "PASS")
        .select("table_name", "check_name", "level", "expected", "actual", "status")
        .orderBy(F.desc("level"), "table_name", "check_name")
    )


def raise_on_failure(checks: DataFrame) -> None:
    """Stop a run whose critical checks failed (at most one row per check reaches the driver)."""
    failed = checks.filter(F.col("status") == "FAIL").select("table_name", "check_name", "actual").collect()
    if failed:
        raise ValueError("; ".join(f"{r.table_name}.{r.check_name}: {r.actual}" for r in failed))


def retention(pairs: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Rows before and after a layer per table, with the share kept; empty tables count 0."""
    lines = []
    for name, before, after in pairs:
        counted = before.agg(F.count(F.lit(1)).alias("bronze_rows"))
        kept = after.agg(F.count(F.lit(1)).alias("silver_rows")).scalar()
        lines.append(counted.select(F.lit(name).alias("source"), "bronze_rows", kept.alias("silver_rows")))
    return reduce(DataFrame.unionByName, lines).withColumn("retention_pct", c.percent("silver_rows", "bronze_rows", 2))


def reconcile(file_rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines per file group against rows per table group.

    ``file_rows`` holds the keys and ``data_rows``; a group the table lacks
    counts as 0 rows.
    """
    per_file = file_rows.groupBy(*keys).agg(F.sum("data_rows").alias("data_rows"))
    per_table = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("table_rows"))
    return (
        per_file.join(per_table, list(keys), "left")
        .fillna({"table_rows": 0})
        .withColumn("missing", F.col("data_rows") - F.col("table_rows"))
        .orderBy(F.desc("missing"), *keys)
    )


def reconcile_totals(diff: DataFrame) -> DataFrame:
    return diff.agg(
        F.sum("data_rows").alias("file_total"),
        F.sum("table_rows").alias("table_total"),
        F.sum("missing").alias("total_missing"),
    )
