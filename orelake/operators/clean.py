"""Cleaning: from raw rows to typed, deduplicated and derived rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from orelake.functions import columns as c


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; names without a column are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def parse_dates(df: DataFrame, targets: Mapping[str, str], pattern: str) -> DataFrame:
    """``{new column: text column}``; the text columns are dropped."""
    parsed = df.withColumns({new: c.parse_timestamp(old, pattern) for new, old in targets.items()})
    return parsed.drop(*targets.values())


def with_ingestion_time(df: DataFrame) -> DataFrame:
    return df.withColumn("_ingestion_ts", F.current_timestamp())


def with_audit(df: DataFrame, run_id: str, run_ts: datetime) -> DataFrame:
    return df.withColumns(
        {"_silver_run_id": F.lit(run_id), "_silver_ingested_at": F.lit(run_ts).cast("timestamp")}
    )


def filter_required(df: DataFrame, required: Sequence[str], non_negative: Sequence[str] = ()) -> DataFrame:
    """Keep rows where all required columns are set and counts are not negative."""
    for name in required:
        df = df.filter(F.col(name).isNotNull())
    for name in non_negative:
        df = df.filter(F.col(name) >= 0)
    return df


def filter_temporal(df: DataFrame, start: str, end: str, as_of: Column) -> DataFrame:
    """Keep rows that start no later than ``as_of`` and do not end before they start."""
    return df.filter(F.col(start) <= as_of).filter(F.col(end).isNull() | (F.col(end) >= F.col(start)))


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], dealt_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, the first by ``order``, which the caller makes total.

    Spark limits each key to one row inside every map task before the shuffle
    (WindowGroupLimit), so a key with very many copies stays small.  That limit sorts
    all a task has read, which drops nothing where keys have few copies: then
    ``dealt_by`` names columns that the key determines, or the keys, and rows are
    dealt by them before the only sort.  After a join on these columns that takes no
    shuffle.  Copies of one key then meet in one task, where their sort can spill.
    """
    if dealt_by:
        df = df.repartition(*dealt_by)
    first = Window.partitionBy(*dict.fromkeys([*dealt_by, *keys])).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") == 1).drop("_rn")


def derive_modules(df: DataFrame, count: str = "bug", size: str = "loc") -> DataFrame:
    """Binary flag and count per unit of size."""
    return df.withColumns(
        {"is_buggy": c.flag(F.col(count) > 0), "bug_density": c.guarded_ratio(count, size)}
    )


def derive_issues(df: DataFrame, as_of: Column, created: str = "created", resolved: str = "resolved") -> DataFrame:
    """Date parts, resolution flag, days to resolve and age in days."""
    return df.withColumns(
        {
            "year_created": F.year(created),
            "month_created": F.month(created),
            "is_resolved": c.flag(F.col(resolved).isNotNull()),
            "cycle_time_days": c.days_between(created, resolved),
            "age_days": c.days_between(created, as_of),
        }
    )


def clean_modules(
    df: DataFrame,
    order: Sequence[Column],
    keys: Sequence[str] = ("name", "_project", "_version"),
    required: Sequence[str] = ("name", "loc", "bug"),
    dealt_by: Sequence[str] = (),
) -> DataFrame:
    """Filter, then deduplicate, then derive; ``dealt_by`` as in ``dedup_latest``."""
    kept = filter_required(df, required, non_negative=["bug"])
    return derive_modules(dedup_latest(kept, keys, order, dealt_by))


def clean_issues(
    df: DataFrame, order: Sequence[Column], as_of: Column, keys: Sequence[str] = ("issue_key",), dealt_by: Sequence[str] = ()
) -> DataFrame:
    """Filter (before deduplication, so a bad copy cannot win), deduplicate, derive; ``dealt_by`` as in ``dedup_latest``."""
    kept = filter_temporal(filter_required(df, [*keys, "created"]), "created", "resolved", as_of)
    return derive_issues(dedup_latest(kept, keys, order, dealt_by), as_of)


def complete_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double, leave the others."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def feature_array(df: DataFrame, names: Sequence[str], out: str = "features") -> DataFrame:
    return df.withColumn(out, F.array(*[F.col(n).cast("double") for n in names]))


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not hold; NULLs are equal.

    One aggregate over both sides: copies shrink before the only shuffle.
    """
    names = left.columns
    both = left.withColumn("_in_right", F.lit(0)).unionByName(right.select(*names).withColumn("_in_right", F.lit(1)))
    return both.groupBy(*names).agg(F.max("_in_right").alias("_in_right")).filter("_in_right = 0").drop("_in_right")
