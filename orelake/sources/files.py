"""Landing files: typed and untyped CSV, lineage and file checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SOURCE_FILE = "_source_file"


def _file_path(uri: str = "_metadata.file_path") -> Column:
    """Path of the file a row comes from, with spaces and letters as they are on disk."""
    plain = F.try_url_decode(F.replace(F.col(uri), F.lit("+"), F.lit("%2B")))
    # Listings and scans write the root of a local path differently.
    return F.regexp_replace(F.coalesce(plain, F.col(uri)), "^file:/+", "file:///").alias(SOURCE_FILE)


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the path of the file each row comes from."""
    return df.select("*", _file_path())


def list_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every file, empty ones too, which no scan would show.

    It is the listing that the driver holds for any scan of these paths.
    """
    uris = spark.read.text(paths).inputFiles()
    return spark.createDataFrame([(u,) for u in uris], "uri string").select(_file_path("uri"))


def with_path_columns(df: DataFrame, patterns: Mapping[str, str], path: str = SOURCE_FILE) -> DataFrame:
    """Add one column per pattern with its first group; ``''`` where it does not match."""
    return df.withColumns({name: F.regexp_extract(path, pattern, 1) for name, pattern in patterns.items()})


def read_typed_csv(spark: SparkSession, paths: str | list[str], schema: StructType, **options: str) -> DataFrame:
    """CSV with header and a declared schema.

    Bad cells become NULL and short rows are padded; the schema's required
    marks are not enforced by file sources.
    """
    reader = spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE").options(**options)
    return with_source_file(reader.csv(paths))


def read_text_csv(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """CSV with header, all columns string, no inference pass over the data."""
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE").options(**options)
    return with_source_file(reader.csv(paths))


def file_line_counts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Physical lines minus the header per file (blank lines and line breaks in cells count); 0 for an empty file."""
    lines = spark.read.text(paths).groupBy(F.col("_metadata.file_path").alias("uri")).agg(F.count(F.lit(1)).alias("_lines"))
    lines = lines.select(_file_path("uri"), "_lines")
    return (
        list_files(spark, paths)
        .join(lines, SOURCE_FILE, "left")
        .select(SOURCE_FILE, F.greatest(F.coalesce("_lines", F.lit(0)) - 1, F.lit(0)).alias("data_rows"))
    )


def landing_totals(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Number of files and data rows over all of them."""
    return file_line_counts(spark, paths).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("data_rows"), F.lit(0)).alias("data_rows")
    )


def check_headers(spark: SparkSession, paths: str | list[str], n_columns: int, separator: str = ",") -> DataFrame:
    """Per file: header columns, data rows and whether both are as expected.

    The header is the first line of the split that starts at byte 0.  An empty
    file has no columns and does not conform.  ``separator`` is plain text.

    Of a line only its number and its number of columns are kept: these aggregate in
    a hash table of one row per file, where the line's text would have all lines sorted.
    """
    if not separator:
        raise ValueError("a separator is at least one character")
    mark = F.lit(separator)
    separators = (F.octet_length("value") - F.octet_length(F.replace("value", mark, F.lit("")))) / F.octet_length(mark)
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("uri"),
        (F.col("_metadata.file_block_start") == 0).alias("_first_split"),
        F.monotonically_increasing_id().alias("_line"),
        (separators.cast("int") + 1).alias("_columns"),
    )
    first = lambda name: F.when(F.col("_first_split"), F.col(name))
    per_file = lines.groupBy("uri").agg(
        F.min_by(first("_columns"), first("_line")).alias("_columns"), F.count(F.lit(1)).alias("_lines")
    )
    per_file = per_file.select(_file_path("uri"), "_columns", "_lines")
    per_file = list_files(spark, paths).join(per_file, SOURCE_FILE, "left").withColumn(
        "data_rows", F.greatest(F.coalesce("_lines", F.lit(0)) - 1, F.lit(0))
    )
    columns = F.coalesce("_columns", F.lit(0))
    return per_file.select(
        SOURCE_FILE,
        columns.alias("n_columns"),
        "data_rows",
        ((columns == n_columns) & (F.col("data_rows") >= 1)).alias("conforms"),
    )


def conforming_paths(spark: SparkSession, paths: str | list[str], n_columns: int, separator: str = ",") -> DataFrame:
    """Files to load: those whose header is as expected and that hold data."""
    return check_headers(spark, paths, n_columns, separator).filter("conforms").select(SOURCE_FILE)


def keep_conforming(df: DataFrame, checked: DataFrame) -> DataFrame:
    """Rows of conforming files only (leaves out schema outliers)."""
    bad = checked.filter("NOT conforms").select(SOURCE_FILE)
    return df.join(bad, SOURCE_FILE, "left_anti")


def exclude_files(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Leave out files by their base name."""
    base = F.element_at(F.split(SOURCE_FILE, "/"), -1)
    return df.filter(~base.isin(*names)) if names else df
