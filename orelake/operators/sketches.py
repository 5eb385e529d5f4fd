"""Figures per day that add up to figures of any range: quantile and distinct-count sketches.

A day is aggregated once into sketches of bounded size; a report over months merges
the few sketches of its days and reads no fact rows.  New days are appended as rows.

Quantiles are KLL sketches: the rank of a reported value is off by at most
``RANK_ERROR`` of the rows (the library's bound at its default size, with 99 % confidence
per value).  Distinct counts are HLL sketches of 2 ** ``LG_K`` registers: a relative error of
about 1.04 / sqrt(2 ** LG_K) as one standard deviation, ``COUNT_ERROR`` being four.  Nulls are
not counted; a group without values has no quantile and 0 distinct values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANK_ERROR = 0.0166
LG_K = 12
COUNT_ERROR = 4 * 1.04 / 2 ** (LG_K / 2)


def daily(df: DataFrame, day: Column, by: Sequence[str], values: Sequence[str] = (), distinct: Sequence[str] = ()) -> DataFrame:
    """One row per day and group: ``n``, a quantile sketch of each value, a distinct sketch of each column."""
    quantiles = [F.kll_sketch_agg_double(F.col(v).cast("double")).alias(f"{v}_kll") for v in values]
    counts = [F.hll_sketch_agg(F.col(c), F.lit(LG_K)).alias(f"{c}_hll") for c in distinct]
    return df.groupBy(day.alias("day"), *by).agg(F.count(F.lit(1)).alias("n"), *quantiles, *counts)


def merged(days: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group over all its days; the same columns without ``day``.  Merging in steps gives the same counts."""
    held = [c for c in days.columns if c.endswith(("_kll", "_hll"))]
    union = lambda c: F.kll_merge_agg_double(c) if c.endswith("_kll") else F.hll_union_agg(c)
    return days.groupBy(*by).agg(F.sum("n").alias("n"), *[union(c).alias(c) for c in held])


def quantile(value: str, share: float) -> Column:
    """The value at ``share`` of a merged sketch; NULL where it holds no value."""
    sketch = F.col(f"{value}_kll")
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(share))))


def distinct_count(column: str) -> Column:
    """Estimate from the registers alone: the union with itself drops what depends on the order of the values."""
    return F.hll_sketch_estimate(F.hll_union(f"{column}_hll", f"{column}_hll"))


def report(days: DataFrame, by: Sequence[str], quantiles: Mapping[str, tuple[str, float]], distinct: Sequence[str] = ()) -> DataFrame:
    """Figures per group: ``n``, ``{name: (value, share)}`` and ``<column>_distinct``."""
    return merged(days, by).select(
        *by, "n", *[quantile(v, share).alias(name) for name, (v, share) in quantiles.items()],
        *[distinct_count(c).alias(f"{c}_distinct") for c in distinct],
    )
