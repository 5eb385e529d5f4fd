"""z-score scaling with parameters from the training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _params(df: DataFrame, features: Sequence[str], population: bool) -> DataFrame:
    spread = F.stddev_pop if population else F.stddev
    return df.agg(
        *[
            F.struct(F.lit(f).alias("feature"), F.avg(f).alias("mean"), spread(f).alias("std")).alias(f)
            for f in features
        ]
    )


def scaling_params(df: DataFrame, features: Sequence[str], population: bool = False) -> DataFrame:
    """Mean and standard deviation per feature, computed in one pass."""
    return _params(df, features, population).select(F.inline(F.array(*[F.col(f) for f in features])))


def zscore(
    df: DataFrame, train: DataFrame, features: Sequence[str], population: bool = False, out: str = "features"
) -> DataFrame:
    """Add ``<feature>_z`` columns and their array.

    A spread of 0, or none at all, counts as 1.  The parameters are one row,
    read as one scalar subquery.
    """
    usable = [
        F.struct(
            F.col(f"{f}.mean").alias("mean"),
            F.coalesce(F.nullif(F.col(f"{f}.std"), F.lit(0.0)), F.lit(1.0)).alias("std"),
        ).alias(f)
        for f in features
    ]
    packed = _params(train, features, population).select(F.struct(*usable).alias("p"))
    held = df.withColumn("_params", packed.scalar())
    scaled = {f"{f}_z": (F.col(f) - F.col(f"_params.{f}.mean")) / F.col(f"_params.{f}.std") for f in features}
    return held.withColumns(scaled).withColumn(out, F.array(*[F.col(name) for name in scaled])).drop("_params")
