"""Table writes: overwrite, append with new columns, clustered and bucketed layout, checked writes.

Rules of a table hold for what ``save_checked`` and ``append_table`` write; a plain
``write`` to the table's files by other means is not stopped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
)

from orelake.operators.quality import constraint_violations
from orelake.sinks.interleave import lay_out as _interleaved
from orelake.storage import write_out

_RULE = "constraint."


class ConstraintViolation(ValueError):
    """Rows that do not meet the named rules of a table."""


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_layers(spark: SparkSession, comments: Mapping[str, str], location: str | None = None) -> None:
    """One database per layer; running it again changes nothing."""
    for name, comment in comments.items():
        place = f" LOCATION {_quoted(f'{location}/{name}.db')}" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {_quoted(comment)}{place}")


def lay_out(
    df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (), interleave: bool = False
) -> DataFrame:
    """Rows of a partition together, sorted by the cluster keys, in few files of a good size.

    Partitions are dealt by their key alone, so a cold one has one writer;
    REBALANCE merges small shuffle partitions and splits hot ones by measured
    size, so one project with a third of all rows gets many.  Without partitions
    rows are dealt by ranges of the cluster keys.  Either way the sort gives files
    and row groups narrow key ranges, which readers skip by.

    With ``interleave`` the cluster keys count alike (``sinks.interleave``): readers skip
    by any of them, not only by the first.
    """
    if interleave and len(cluster_by) > 1:
        return _interleaved(df, cluster_by, partition_by)
    if partition_by:
        dealt = df.hint("rebalance", *[F.col(k) for k in partition_by])
    elif cluster_by:
        dealt = df.repartitionByRange(*cluster_by)
    else:
        return df
    return dealt.sortWithinPartitions(*partition_by, *cluster_by)


def set_comment(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(comment)}")


def set_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def save_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    interleave: bool = False,
) -> DataFrame:
    """Replace a table (rows, schema and layout) and return a scan of it.

    ``df`` must not read the table it replaces.
    """
    spark = df.sparkSession
    writer = lay_out(df, partition_by, cluster_by, interleave).write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    if properties:
        set_properties(spark, table, properties)
    if comment:
        set_comment(spark, table, comment)
    return spark.table(table)


_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def _keeps_values(given: DataType, stored: DataType) -> bool:
    """Whether every value of one type is also a value of the other."""
    if given == stored or isinstance(given, NullType):
        return True
    if type(given) in _WHOLE and type(stored) in _WHOLE:
        return _WHOLE.index(type(given)) <= _WHOLE.index(type(stored))
    if isinstance(stored, DoubleType):
        return isinstance(given, (ByteType, ShortType, IntegerType, FloatType))
    if isinstance(given, DecimalType) and isinstance(stored, DecimalType):
        return given.scale <= stored.scale and given.precision - given.scale <= stored.precision - stored.scale
    return given.simpleString() == stored.simpleString()


def save_bucketed(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = (), path: str | None = None, comment: str | None = None
) -> DataFrame:
    """Replace a table with one in ``buckets`` buckets of its keys, each sorted, and return a scan of it.

    Tables with the same keys and number of buckets join without a shuffle, and a
    window or group over the keys needs none either.  Rows are dealt to the buckets'
    own tasks first, so there is one file per bucket; a key that holds much of the table
    makes its bucket large, so keys that are unique, or nearly, are meant.
    """
    spark = df.sparkSession
    sort_by = [*keys, *[c for c in sort_by if c not in keys]]
    writer = df.repartition(buckets, *keys).sortWithinPartitions(*sort_by).write.format("parquet").mode("overwrite")
    writer = writer.bucketBy(buckets, *keys).sortBy(*sort_by)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    if comment:
        set_comment(spark, table, comment)
    return spark.table(table)


def append_table(df: DataFrame, table: str, comment: str | None = None, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Append by column name; new columns are added, missing ones are NULL.

    Names match as Spark matches them, without case.  A type that could lose
    values on the way into the stored one raises.  A table with stored rules only
    takes rows that meet them: the rows are computed once and checked, then the
    table gets its new columns, then the checked rows are written.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return save_table(df, table, cluster_by=cluster_by, comment=comment)
    stored = {f.name.lower(): f for f in spark.table(table).schema.fields}
    given = {f.name.lower(): f for f in df.schema.fields}
    if len(given) < len(df.columns):
        raise ValueError(f"{table}: column names that differ in case only: {df.columns}")
    lost = [
        f"{f.name}: {f.dataType.simpleString()} into {stored[name].dataType.simpleString()}"
        for name, f in given.items()
        if name in stored and not _keeps_values(f.dataType, stored[name].dataType)
    ]
    if lost:
        raise TypeError(f"{table}: types would lose values: {', '.join(lost)}")
    rules = constraints_of(spark, table)
    if rules:
        df = write_out(df, "append")
        _require(df, rules, table)
    added = [f for name, f in given.items() if name not in stored]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    aligned = df.select(
        *[
            (F.col(f"`{given[f.name.lower()].name}`") if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema.fields
        ]
    )
    partition_by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    lay_out(aligned, partition_by, cluster_by).write.insertInto(table)
    if comment:
        set_comment(spark, table, comment)
    return spark.table(table)


def constraints_of(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    found = table_properties(spark, table).items()
    return [(k[len(_RULE):], v) for k, v in sorted(found) if k.startswith(_RULE)]


def _require(df: DataFrame, rules: Sequence[tuple[str, str]], table: str) -> None:
    broken = constraint_violations(df, rules).filter("violations > 0").collect()
    if broken:
        raise ConstraintViolation(
            f"{table}: " + ", ".join(f"{r.constraint_name} ({r.violations} rows)" for r in broken)
        )


def add_constraints(spark: SparkSession, table: str, rules: Sequence[tuple[str, str]]) -> None:
    """Name rules for a table after one pass over its rows; adding one again is harmless."""
    known = dict(constraints_of(spark, table))
    for name, rule in rules:
        if name in known and known[name] != rule:
            raise ValueError(f"{table} has another rule named {name}: {known[name]}")
    new = [(name, rule) for name, rule in rules if name not in known]
    if new:
        _require(spark.table(table), new, table)
        set_properties(spark, table, {_RULE + name: rule for name, rule in new})


def save_checked(
    df: DataFrame,
    table: str,
    rules: Sequence[tuple[str, str]],
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    comment: str | None = None,
    quarantine: str | None = None,
    staged: bool = False,
    interleave: bool = False,
) -> DataFrame:
    """Replace a table with rows that meet all rules.

    The rows are computed once into the shared folder and checked there, so
    what is checked is what is kept; ``staged`` says that ``df`` is such rows.  Without ``quarantine`` a violation raises
    and the old table stays; with it, bad rows go to that table.
    """
    spark = df.sparkSession
    rows = df if staged else write_out(df, "staging")
    if quarantine is None:
        _require(rows, rules, table)
        save_table(rows, table, partition_by, cluster_by, interleave=interleave)
    else:
        good = F.lit(True)
        for _, rule in rules:
            good = good & F.coalesce(F.expr(rule), F.lit(False))
        save_table(rows.filter(~good), quarantine)
        save_table(rows.filter(good), table, partition_by, cluster_by, interleave=interleave)
    if rules:
        set_properties(spark, table, {_RULE + name: rule for name, rule in rules})
    if comment:
        set_comment(spark, table, comment)
    return spark.table(table)
