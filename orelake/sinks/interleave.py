"""Layout over several columns at once: quantile ranks with their bits interleaved.

A sort by (a, b) gives narrow ranges of ``a`` and leaves ``b`` spread over every
file.  Here each column counts by its *bin*, the quantile its value falls into, so
skewed values still fill all bins, and the bins' bits are dealt in turn into one key.
Rows are spread by ranges of that key: every file holds a narrow range of each column.

Bins come from exact boundaries (``ranking``), at most ``2 ** BITS - 1`` values per
column on the driver; marking rows with their key takes no shuffle.  A null is in
bin 0.  Equal values share a bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.operators.ranking import ranked_values

# Bits per column: quantiles are cut into 2 ** BITS bins.
BITS = 8


def boundaries(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Per column the values at the ranks k / 2 ** bits, ascending; empty for a column without values."""
    found, bins = {}, 2**bits
    for name in columns:
        ranked = ranked_values(df.select(F.col(f"`{name}`").alias("value")), [], "value")
        # The ranks of a value are upto - n + 1 .. upto; it is the boundary of each rank k / bins among them.
        first, last = F.expr(f"(upto - n) * {bins} div upto_total + 1"), F.least(F.expr(f"upto * {bins} div upto_total"), F.lit(bins - 1))
        held = ranked.select("value", first.cast("int").alias("first"), last.cast("int").alias("last")).filter("first <= last")
        rows = held.select("value", F.explode(F.sequence("first", "last")).alias("k")).collect()
        found[name] = [r["value"] for r in sorted(rows, key=lambda r: r["k"])]
    return found


def bin_of(column: str, bounds: Sequence, kind: str) -> Column:
    """Number of boundaries below the value, searched in runs of about the root of their number."""
    if not bounds:
        return F.lit(0)
    width = max(1, round(len(bounds) ** 0.5))
    runs = [list(bounds[i : i + width]) for i in range(0, len(bounds), width)]
    literal = lambda values: F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")
    value = F.col(f"`{column}`")
    # All runs whose last boundary is below the value count whole, the next one in part.
    whole = F.size(F.filter(literal([r[-1] for r in runs]), lambda b: b < value))
    part = F.size(F.filter(F.get(F.array(*[literal(r) for r in runs]), whole), lambda b: b < value))
    found = F.least(whole * width + F.greatest(part, F.lit(0)), F.lit(len(bounds)))
    return F.when(value.isNull(), 0).otherwise(found).cast("int")


def interleaved(bins: Sequence[Column], bits: int = BITS) -> Column:
    """One key from the bits of all bins, highest bits first, in turn by column."""
    if bits * len(bins) > 63:
        raise ValueError(f"{len(bins)} columns of {bits} bits do not fit into one key")
    key = F.lit(0).cast("long")
    for k in range(bits):
        for c, value in enumerate(bins):
            bit = F.shiftright(value, k).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(bit, k * len(bins) + len(bins) - 1 - c))
    return key


def with_key(df: DataFrame, columns: Sequence[str], name: str = "layout_key", bits: int = BITS) -> DataFrame:
    """Add the interleaved key of ``columns``."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    bounds = boundaries(df, columns, bits)
    return df.withColumn(name, interleaved([bin_of(c, bounds[c], kinds[c]) for c in columns], bits))


def lay_out(df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """Rows spread by ranges of (partition columns, interleaved key) and sorted by it.

    A hot partition is many ranges; the columns themselves order rows of equal key.
    ``df`` is read once for the boundaries and once more here.
    """
    order = [*partition_by, "_layout_key", *columns]
    keyed = with_key(df, columns, "_layout_key", bits)
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_layout_key")
