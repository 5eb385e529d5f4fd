"""All stages in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from orelake.constants import YEAR_RANGE
from orelake.operators.ml import Candidate
from orelake.plans import bronze, decisions, gold, modelling, silver
from orelake.plans.lake import Lake, Run


def build_all(
    spark: SparkSession,
    lake: Lake,
    run: Run | None = None,
    candidates: Sequence[Candidate] | None = None,
    years: tuple[int, int] = YEAR_RANGE,
    fail_on_critical: bool = False,
) -> Run:
    run = run or Run()
    lake.bootstrap(spark)
    bronze.build(spark, lake)
    silver.build(spark, lake, run, fail_on_critical)
    gold.build(spark, lake, years)
    modelling.build(spark, lake, run, candidates)
    decisions.build(spark, lake)
    return run
