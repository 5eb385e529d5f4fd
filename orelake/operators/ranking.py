"""Ranks, running totals, quantiles and tiles that do not need a whole group in one task.

A plain window puts every row of its partition key in one task, which fails
when one group holds a large share of the data.  Here the rows are spread by
range over (group, order); each range adds the totals of the ranges before it.
Values are counted per distinct value first, so copies shrink before any
shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orelake.functions.columns import col
from orelake.storage import write_out

_PART = "_range_part"
_DATA = "_is_data"


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    sums: Mapping[str, Column | str],
    bounded: bool = False,
) -> DataFrame:
    """Add, per name in ``sums``, the total up to and including each row.

    ``<name>`` is the running total inside the group and ``<name>_total`` the
    total of the group.  ``order`` should make rows of a group distinct: equal
    rows share a range.  ``bounded`` states that the number of rows per group
    has a fixed limit, then one window does the work.
    """
    order = [col(o) for o in order]
    df = df.withColumns({name: col(expr) for name, expr in sums.items()})
    names = list(sums)

    if bounded:
        ordered = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy(*by)
        out = df.withColumns({f"{n}_total": F.sum(n).over(whole) for n in names})
        return out.withColumns({n: F.sum(n).over(ordered) for n in names})

    # As many ranges as the session has shuffle partitions: Spark would lay small ones
    # together up to a size that counts packed bytes, and a task sorts and holds its ranges unpacked.
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(ranges, *by, *order).withColumn(_PART, F.spark_partition_id())
    # The range number must be the same for both readers below, so it is stored.
    fixed = write_out(spread, "ranges")

    parts = fixed.groupBy(_PART, *by).agg(*[F.sum(n).alias(n) for n in names])
    earlier = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    starts = parts.select(
        _PART,
        *by,
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names],
        *[F.sum(n).over(group).alias(f"{n}_total") for n in names],
        F.lit(False).alias(_DATA),
    )
    # One start row per (range, group) takes part in the running sum, which
    # saves a join and treats NULL groups like any other.
    rows = fixed.withColumn(_DATA, F.lit(True)).unionByName(starts, allowMissingColumns=True)
    rows = rows.repartitionById(ranges, F.col(_PART))
    inside = Window.partitionBy(_PART, *by).orderBy(_DATA, *order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns(
        {
            **{n: F.sum(n).over(inside) for n in names},
            **{f"{n}_total": F.max(f"{n}_total").over(inside) for n in names},
        }
    )
    return out.filter(_DATA).drop(_DATA, _PART)


def row_numbers(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str = "row_number") -> DataFrame:
    """``row_number`` per group plus ``<name>_total``, without one task per group."""
    return running_totals(df, by, order, {name: F.lit(1).cast("long")})


def value_counts(
    df: DataFrame, by: Sequence[str], value: str, sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per group and distinct value with its count ``n`` and further sums."""
    extra = [F.sum(c).alias(name) for name, c in (sums or {}).items()]
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"), *extra)


def ranked_values(df: DataFrame, by: Sequence[str], value: str, bounded: bool = False) -> DataFrame:
    """Distinct values per group with ``n``, ranks ``upto - n + 1 .. upto`` and ``upto_total``."""
    return running_totals(value_counts(df, by, value), by, [value], {"upto": "n"}, bounded)


def _value_at(rank: Column, value: str) -> Column:
    held = (F.col("upto") - F.col("n") < rank) & (rank <= F.col("upto"))
    return F.max(F.when(held, F.col(value)))


def discrete_quantiles(ranked: DataFrame, by: Sequence[str], value: str, points: Mapping[str, float]) -> DataFrame:
    """Smallest value whose share of rows reaches each point.

    The rank is computed in decimals: 0.1 of 30 rows is rank 3, not 4.
    """
    total = F.col("upto_total")

    def rank(p: float) -> Column:
        return F.greatest(F.ceil(total * F.lit(Decimal(str(p)))).cast("long"), F.lit(1))

    return ranked.groupBy(*by).agg(*[_value_at(rank(p), value).alias(name) for name, p in points.items()])


def interpolated_quantiles(ranked: DataFrame, by: Sequence[str], value: str, points: Mapping[str, float]) -> DataFrame:
    """Linear interpolation between the two closest ranks."""
    place = {name: (F.col("upto_total") - 1) * F.lit(p) for name, p in points.items()}
    sides = ranked.groupBy(*by).agg(
        F.max("upto_total").alias("upto_total"),
        *[_value_at(F.floor(place[n]) + 1, value).alias(f"_lo_{n}") for n in points],
        *[_value_at(F.ceil(place[n]) + 1, value).alias(f"_hi_{n}") for n in points],
    )
    mixed = [
        (F.col(f"_lo_{n}") + (place[n] - F.floor(place[n])) * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n)
        for n in points
    ]
    return sides.select(*by, *mixed)


def _tile_of(rank: Column, total: Column, tiles: int) -> Column:
    small = F.floor(total / tiles)
    larger = total % tiles
    border = larger * (small + 1)
    return F.when(rank <= border, F.ceil(rank / (small + 1))).otherwise(
        larger + F.ceil((rank - border) / F.nullif(small, F.lit(0)))
    )


def ntile_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], tiles: int, name: str = "tile") -> DataFrame:
    """``ntile`` per group for every row; ``order`` must be total."""
    numbered = row_numbers(df, by, order, "_rank")
    tile = _tile_of(F.col("_rank"), F.col("_rank_total"), tiles).cast("int")
    return numbered.withColumn(name, tile).drop("_rank", "_rank_total")


def ntile_summary(df: DataFrame, by: Sequence[str], value: str, tiles: int, name: str = "tile") -> DataFrame:
    """Count, minimum, maximum and sum of ``value`` per ``ntile`` of each group.

    These depend only on the sorted values, not on how ties are broken, so
    distinct values are ranked and a value crossing a border counts in both
    tiles with its share of rows.
    """
    ranked = ranked_values(df, by, value)
    total, before = F.col("upto_total"), F.col("upto") - F.col("n")
    small, larger = F.floor(total / tiles), total % tiles
    tile = F.col(name).cast("long")
    start = (tile - 1) * small + F.least(tile - 1, larger)
    end = tile * small + F.least(tile, larger)
    return (
        ranked.withColumn(
            name,
            F.explode(
                F.sequence(
                    _tile_of(before + 1, total, tiles).cast("int"), _tile_of(F.col("upto"), total, tiles).cast("int")
                )
            ),
        )
        .withColumn("_rows", F.least(F.col("upto"), end) - F.greatest(before, start))
        .groupBy(*by, name)
        .agg(
            F.sum("_rows").alias("rows"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            F.sum(F.col(value) * F.col("_rows")).alias("sum_value"),
        )
    )


def merge_groups(by: Sequence[str], *parts: DataFrame) -> DataFrame:
    """Put columns of several one-row-per-group results side by side.

    A union and one aggregate instead of joins: NULL groups stay, and every
    column comes from the only part that has it.
    """
    if not by:
        raise ValueError("merge_groups needs at least one group column")
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    names = [c for c in stacked.columns if c not in by]
    return stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in names])
