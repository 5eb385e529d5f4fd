"""Stored tables, the catalog and small in-memory rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orelake.schemas import TABLE_LIST


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def list_tables(spark: SparkSession, databases: Sequence[str], like: str | None = None, table_type: str = "MANAGED") -> DataFrame:
    """Tables of the given layers with their comments, sorted."""
    rows = [
        (database, t.name, t.tableType, t.description)
        for database in databases
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    ]
    out = spark.createDataFrame(rows, TABLE_LIST).filter(F.col("table_type") == table_type)
    if like is not None:
        out = out.filter(F.col("table_name").like(like))
    return out.orderBy("table_schema", "table_name")


def rows_to_frame(spark: SparkSession, rows: Sequence[tuple[Any, ...]], schema: StructType) -> DataFrame:
    """Run records (a handful of rows) as a DataFrame with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)
