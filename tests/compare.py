"""Run a query in Spark and its check in DuckDB and compare the rows."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float):
        return None if value != value else repr(value + 0.0)
    if hasattr(value, "item"):
        return _plain(value.item())
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def normal_rows(frame: pd.DataFrame) -> list[tuple]:
    names = sorted(frame.columns)
    rows = []
    for row in frame[names].itertuples(index=False, name=None):
        rows.append(tuple("" if (p := _plain(x)) is None else str(float(p)) if _number(p) else p for x in row))
    return sorted(rows)


# Spark type -> DuckDB type of the same column.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def type_difference(df, relation) -> str | None:
    """None when every column has the same type on both sides."""
    ours = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    theirs = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    wrong = {n: (ours.get(n), theirs.get(n)) for n in {*ours, *theirs} if ours.get(n) != theirs.get(n)}
    return str(wrong) if wrong else None


def _number(text: str) -> bool:
    try:
        float(text)
        return True
    except ValueError:
        return False


def difference(spark_frame: pd.DataFrame, check_frame: pd.DataFrame) -> str | None:
    """None when equal, else a short report."""
    if sorted(spark_frame.columns) != sorted(check_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(check_frame.columns)}"
    left, right = normal_rows(spark_frame), normal_rows(check_frame)
    if left == right:
        return None
    only_left = sorted(set(left) - set(right))[:3]
    only_right = sorted(set(right) - set(left))[:3]
    return f"rows {len(left)} / {len(right)}; only Spark {only_left}; only SQL {only_right}"
