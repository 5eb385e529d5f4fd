"""Typed CSV whose malformed rows are kept apart instead of turned into nulls.

Each physical row of the files is in exactly one of two places: parsed, or in
quarantine with its file, text and reason.  A row is malformed when a cell is not
of its type or the row has too few or too many cells (a broken quote swallows cells to
the end of its line).  Blank lines hold no cells and are in quarantine as ``blank``.
An empty cell is NULL and no fault.  The first line of a file is its header.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orelake.operators.quality import reconcile
from orelake.sources.files import SOURCE_FILE, _file_path, file_line_counts, with_source_file
from orelake.storage import write_out

_BAD = "_malformed"


@dataclass(frozen=True)
class Parsed:
    """Rows of the declared schema with their file, and quarantined ones (file, line, reason)."""

    rows: DataFrame
    quarantine: DataFrame


def read(spark: SparkSession, paths: str | list[str], schema: StructType, **options: str) -> Parsed:
    """Parse the files once, into the shared folder, and part good from malformed rows there."""
    marked = StructType([*schema.fields, StructField(_BAD, StringType())])
    reader = spark.read.schema(marked).option("header", "true").option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", _BAD).options(**options)
    # Written with all columns: a scan of fewer would not parse, and so not see, the cells it leaves out.
    staged = write_out(with_source_file(reader.csv(paths)), "parsed")
    line = F.col("value")
    blank = spark.read.text(paths).select(line, _file_path(), (F.col("_metadata.file_block_start") == 0).alias("_first"), F.monotonically_increasing_id().alias("_line"))
    first = F.min(F.when(F.col("_first"), F.col("_line")))
    heads = blank.groupBy(SOURCE_FILE).agg(first.alias("_line"))
    # The reader takes the first line that is not blank as the header; blank ones before it are its place.
    blank = blank.filter(F.trim(F.regexp_replace(line, r"[\r\t]", "")) == "").join(heads, [SOURCE_FILE, "_line"], "left_anti")
    bad = staged.filter(F.col(_BAD).isNotNull()).select(SOURCE_FILE, F.col(_BAD).alias("line"), F.lit("malformed").alias("reason"))
    empty = blank.select(SOURCE_FILE, line.alias("line"), F.lit("blank").alias("reason"))
    return Parsed(staged.filter(F.col(_BAD).isNull()).drop(_BAD), bad.unionByName(empty))


def accounted(spark: SparkSession, paths: str | list[str], parsed: Parsed) -> DataFrame:
    """Per file: physical rows, rows found again (parsed or quarantined) and ``missing``, which is 0."""
    found = parsed.rows.select(SOURCE_FILE).unionAll(parsed.quarantine.select(SOURCE_FILE))
    return reconcile(file_line_counts(spark, paths), found, [SOURCE_FILE])
