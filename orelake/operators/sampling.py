"""Train/test split and folds that depend on the key only, never on the layout of the files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.constants import FOLDS, SEED, TRAIN_SHARE
from orelake.functions.columns import hash_number
from orelake.operators.ranking import row_numbers

# Hash numbers are below this.
_HASHES = 2**32


def mark_train(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    shares: Mapping[int, float] | float = TRAIN_SHARE,
    seed: int = SEED,
    name: str = "is_train",
) -> DataFrame:
    """Mark a share of every class for training.

    ``shares`` is one share, or one per class (others get none).  Rows with
    the same key fall on the same side, and no shuffle is needed.
    """
    if isinstance(shares, Mapping):
        limit = F.lit(0).cast("long")
        for value, share in shares.items():
            limit = F.when(F.col(label) == value, F.lit(round(share * _HASHES))).otherwise(limit)
    else:
        limit = F.lit(round(shares * _HASHES))
    return df.withColumn(name, hash_number(seed, *keys) < limit)


def split(df: DataFrame, keys: Sequence[str], label: str, shares: Mapping[int, float] | float = TRAIN_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Disjoint and complete train and test rows."""
    marked = mark_train(df, keys, label, shares, seed, "_train")
    return marked.filter("_train").drop("_train"), marked.filter("NOT _train").drop("_train")


def balanced_folds(df: DataFrame, keys: Sequence[str], label: str, folds: int = FOLDS, seed: int = SEED, name: str = "fold") -> DataFrame:
    """Folds whose sizes differ by at most one row inside every class; keys must be unique.

    Rows are numbered by range, so a class may hold most of the table.
    """
    hashed = df.withColumn("_hash", hash_number(seed, *keys))
    numbered = row_numbers(hashed, [label], ["_hash", *keys], "_rn")
    return numbered.withColumn(name, ((F.col("_rn") - 1) % folds).cast("int")).drop("_rn", "_rn_total", "_hash")


def hashed_folds(df: DataFrame, keys: Sequence[str], folds: int = FOLDS, seed: int = SEED, name: str = "fold") -> DataFrame:
    """Folds by hash of the key: balanced in expectation for every class, and free of any shuffle."""
    return df.withColumn(name, (hash_number(seed, *keys) % folds).cast("int"))
