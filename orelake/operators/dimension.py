"""The conformed project dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.functions import columns as c

_SHAPE = ["project_id", "source_system", "project_key", "project_name", "domain_layer", "n_records", "n_versions"]


def code_projects(modules: DataFrame, source: str, layer: str = "code") -> DataFrame:
    return (
        modules.groupBy(F.col("_project").alias("project_key"))
        .agg(F.count(F.lit(1)).alias("n_records"), F.count_distinct("_version").alias("n_versions"))
        .withColumns(
            {
                "project_id": c.prefixed(f"{source}:", "project_key"),
                "source_system": F.lit(source),
                "project_name": F.initcap("project_key"),
                "domain_layer": F.lit(layer),
            }
        )
        .select(*_SHAPE)
    )


def process_projects(issues: DataFrame, source: str, layer: str = "process") -> DataFrame:
    """One row per key and name: a renamed project shows up as a duplicate id."""
    return (
        issues.groupBy("project_key", "project_name")
        .agg(F.count(F.lit(1)).alias("n_records"))
        .withColumns(
            {
                "project_id": c.prefixed(f"{source}:", "project_key"),
                "source_system": F.lit(source),
                "domain_layer": F.lit(layer),
                "n_versions": F.lit(None).cast("long"),
            }
        )
        .select(*_SHAPE)
    )


def project_dimension(modules: DataFrame, issues: DataFrame, code_source: str, process_source: str) -> DataFrame:
    return code_projects(modules, code_source).unionByName(process_projects(issues, process_source))


def rollup_dimension(dim: DataFrame) -> DataFrame:
    return (
        dim.groupBy("source_system", "domain_layer")
        .agg(F.count(F.lit(1)).alias("projects"), F.sum("n_records").alias("total_records"))
        .orderBy("source_system", "domain_layer")
    )
