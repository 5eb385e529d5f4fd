"""Reconciliation by content: fingerprints of sets of rows that do not depend on their order.

A row is hashed twice, with different salts, into 64 bits; a set of rows is the two sums
of its hashes (as exact decimals, modulo 2 ** 64) and its number of rows.  Equal multisets
have equal fingerprints; different ones agree by chance once in about 2 ** 128 cases.  Sums are
formed in each task, so a group of any size passes the shuffle as one row per task, and
fingerprints of parts add up to those of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIGURES = ("n", "sum_a", "sum_b")
_MODULUS = "18446744073709551616"


def row_hash(columns: Sequence[str], salt: int) -> Column:
    """64-bit hash of the values and of which of them are missing."""
    parts = [part for c in columns for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(F.lit(salt), *parts)


def _sum(column: Column) -> Column:
    return F.pmod(F.sum(column.cast("decimal(38,0)")), F.lit(_MODULUS).cast("decimal(38,0)")).cast("decimal(20,0)")


def fingerprints(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per group: keys, number of rows and two sums."""
    hashed = df.select(*keys, row_hash(columns, 1).alias("_a"), row_hash(columns, 2).alias("_b"))
    return hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), _sum(F.col("_a")).alias("sum_a"), _sum(F.col("_b")).alias("sum_b"))


def combined(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fingerprints of unions of parts, such as the files of a folder."""
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), _sum(F.col("sum_a")).alias("sum_a"), _sum(F.col("sum_b")).alias("sum_b"))


def reconcile_content(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per group of either side: rows on both sides and whether the same rows are there; null keys are equal."""
    side = lambda df, other: fingerprints(df, keys, columns).withColumn("_right", F.lit(other))
    both = side(left, False).unionByName(side(right, True))
    of = lambda figure, right: F.max(F.when(F.col("_right") == right, F.col(figure)))
    met = both.groupBy(*keys).agg(*[of(f, r).alias(f"_{f}_{r}") for f in FIGURES for r in (False, True)])
    same = F.lit(True)
    for f in FIGURES:
        same = same & F.col(f"_{f}_False").eqNullSafe(F.col(f"_{f}_True"))
    rows = [F.coalesce(f"_n_{r}", F.lit(0)).alias(name) for r, name in ((False, "left_rows"), (True, "right_rows"))]
    return met.select(*keys, *rows, same.alias("same_content"))
