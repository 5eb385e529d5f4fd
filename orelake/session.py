"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Sizes are left to the cluster; these switches only let Spark re-plan at run
# time (coalesce small shuffle partitions, split hot ones, pick join sides by
# measured size).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app_name: str = "orelake", cores: str = "*", memory: str = "8g") -> SparkSession:
    """A session for one machine, as used by the tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
