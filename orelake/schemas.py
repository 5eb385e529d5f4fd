"""Schemas of files read and tables written."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from orelake.constants import FEATURES


def _schema(*fields: tuple) -> StructType:
    """Fields as (name, type) for required and (name, type, True) for optional."""
    return StructType([StructField(f[0], f[1], len(f) > 2 and f[2]) for f in fields])


# File sources ignore the required mark: a null name still has to be checked.
CODE_METRICS = StructType(
    [StructField("name", StringType(), False)]
    + [StructField(c, DoubleType(), True) for c in FEATURES]
    + [StructField("bug", IntegerType(), True)]
)

CHECK_LOG = _schema(
    ("run_id", StringType()),
    ("run_ts", TimestampType()),
    ("table_name", StringType()),
    ("check_name", StringType()),
    ("level", StringType()),
    ("expected", StringType(), True),
    ("actual", StringType(), True),
    ("status", StringType()),
    ("details", StringType(), True),
)

MODEL_SCORES = _schema(
    ("run_id", StringType()),
    ("run_ts", TimestampType()),
    ("model_name", StringType()),
    ("framework", StringType()),
    ("auc_train", DoubleType()),
    ("auc_test", DoubleType()),
    ("f1_test", DoubleType()),
    ("accuracy_test", DoubleType()),
    ("precision_test", DoubleType()),
    ("recall_test", DoubleType()),
    ("training_seconds", DoubleType()),
    ("best_params", StringType()),
    ("is_champion", BooleanType()),
)

PREDICTIONS = _schema(
    ("run_id", StringType()),
    ("run_ts", TimestampType()),
    ("model_name", StringType()),
    ("module_name", StringType()),
    ("project", StringType()),
    ("version", StringType(), True),
    ("label", IntegerType()),
    ("prediction", IntegerType()),
    ("prob_buggy", DoubleType()),
)

CONFUSION = _schema(
    ("run_id", StringType()),
    ("run_ts", TimestampType()),
    ("model_name", StringType()),
    ("cell", StringType()),
    ("count", LongType()),
)

IMPORTANCE = _schema(
    ("run_id", StringType()),
    ("run_ts", TimestampType()),
    ("model_name", StringType()),
    ("importance_type", StringType()),
    ("feature", StringType()),
    ("importance", DoubleType()),
    ("rank", IntegerType()),
)

TABLE_LIST = StructType(
    [
        StructField("table_schema", StringType(), False),
        StructField("table_name", StringType(), False),
        StructField("table_type", StringType(), True),
        StructField("comment", StringType(), True),
    ]
)
