"""Queries and their SQL checks, registered side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""

    def add(run: Query) -> Query:
        key = name or run.__name__
        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = run
        if check is not None:
            CHECKS[key] = check
        return run

    return add


def half_up(x: str, digits: int) -> str:
    """SQL that rounds half away from zero on decimals, like Spark's ``round``."""
    return f"CAST(round(CAST({x} AS DECIMAL(28,12)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int) -> str:
    return half_up(f"100.0 * CAST({part} AS DOUBLE) / {whole}", digits)
