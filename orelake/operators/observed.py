"""Checks counted in the very pass that writes the rows.

``DataFrame.observe`` takes the figures while rows stream by, so a build scans its input
once: rules are counted on the raw rows, keys and constraints on the cleaned ones.

An executor that is lost can make a task run again after its figures were taken.  Each set
of figures holds its number of rows, which is compared with the rows of the raw table and
of the written files (their footers hold it; no column is read): where they differ, the
figures are taken again by an aggregate of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from orelake.operators import quality
from orelake.operators.quality import Rule
from orelake.storage import write_out

_NTH = "_nth_of_key"


@dataclass(frozen=True)
class Written:
    """The written rows, and what was counted on the way: before cleaning and after."""

    rows: DataFrame
    before: dict[str, int]
    after: dict[str, int]


def _counts(figures: Mapping[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(name) for name, c in figures.items()]]


def _settled(found: dict[str, int], rows: int, df: DataFrame, figures: Mapping[str, Column]) -> dict[str, int]:
    return found if found["rows"] == rows else df.agg(*_counts(figures)).first().asDict()


def write_observed(
    raw: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    label: str,
    rules: Sequence[Rule],
    keys: Sequence[str],
    constraints: Sequence[tuple[str, str]] = (),
) -> Written:
    """Write ``clean(raw)`` to the shared folder; ``before`` counts the rules, ``after`` duplicate keys and broken constraints.

    Where ``clean`` deals rows by ``keys`` last, as a deduplication does, counting
    duplicates takes no shuffle: a key that occurs more than once has one second row.
    """
    seen, kept = Observation(), Observation()
    of_rules = {r.name: r.violation for r in rules}
    cleaned = clean(raw.observe(seen, *_counts(of_rules)))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    broken = {f"constraint:{name}": ~F.coalesce(F.expr(rule), F.lit(False)) for name, rule in constraints}
    numbered = cleaned.withColumn(_NTH, nth)
    numbered = numbered.observe(kept, *_counts({"duplicates": F.col(_NTH) == 2, **broken})).drop(_NTH)
    rows = write_out(numbered, label)
    before = _settled(seen.get, raw.count(), raw, of_rules)
    after = _settled(kept.get, rows.count(), rows.withColumn(_NTH, nth), {"duplicates": F.col(_NTH) == 2, **broken})
    return Written(rows, before, after)


def suite(written: Written, table: str, rules: Sequence[Rule], duplicate_check: str) -> DataFrame:
    """The check rows of ``quality.suite`` from figures that are there already."""
    spark = written.rows.sparkSession
    names = ["rows", *[r.name for r in rules]]
    schema = ", ".join(f"`{n}` bigint" for n in names) + ", after struct<rows: bigint, duplicates: bigint>"
    values = (*[written.before[n] for n in names], (written.after["rows"], written.after["duplicates"]))
    return quality.suite_rows(spark.createDataFrame([values], schema), table, rules, duplicate_check)


def constraint_checks(written: Written, table: str) -> DataFrame:
    """One failed critical check per constraint that some rows break; none when all hold."""
    counts = [(k.partition(":")[2], n) for k, n in written.after.items() if k.startswith("constraint:") and n]
    frame = written.rows.sparkSession.createDataFrame(counts, "constraint_name string, violations bigint")
    return quality.broken_constraint_rows(frame, table)
