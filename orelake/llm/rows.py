"""Taking whole rows of a table by decisions made on narrow ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ("_key", "_mark")


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column that filters above it do not reach through.

    Spark moves a filter below the projections that compute its column, and would
    write their expressions out once per use, also within lambda functions.
    """
    others = [F.col(f"`{n}`") for n in df.columns if n != name]
    return df.select(*others, F.explode_outer(F.array(F.col(name))).alias(name))


def keyed(docs: DataFrame, mark: Column | None = None) -> DataFrame:
    """Each row packed in ``_row`` beside what tells rows apart: id and a hash of the text (or ``mark``)."""
    return docs.select(
        F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("_row"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key"),
        (F.xxhash64("text") if mark is None else mark).alias("_mark"),
    )


def once(docs: DataFrame, mark: Column | None = None) -> DataFrame:
    """Keyed rows, of those with equal id and text one.

    Copies are cut to one in each map task, before the shuffle on the key.
    """
    rank = F.expr("row_number() over (partition by _key, _mark order by _key)")
    return keyed(docs, mark).withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def keep(docs: DataFrame, kept: DataFrame, mark: Column | None = None) -> DataFrame:
    """Rows of ``docs`` whose key is in ``kept``, all columns unchanged; one shuffle of the texts."""
    stay = once(docs, mark).join(kept.select(*KEY), list(KEY), "left_semi")
    return stay.select(*[F.col("_row").getField(n).alias(n) for n in docs.columns])
