"""Written intermediate results.

Some operators need a result to be fixed before it is read twice (for example
a partition number that both a count and a join use).  Such results are
written to the shared folder named by ``spark.checkpoint.dir``, so a lost
executor can only cause a re-read, never a different answer.

An operator that goes through rounds gives a table back with ``release`` when what was
made from it is written too; results that are still to be read stay.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, read from the session.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="orelake-")
    return _LOCAL[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/orelake/{label}-{uuid.uuid4().hex}"


def write_out(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet and return a scan of what was written."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


_OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def one_writer_per_value(spark: SparkSession, most: int = 32) -> Iterator[None]:
    """Partitioned writes inside keep a file open per value, up to ``most``, instead of sorting all rows of a task.

    Rows of further values are sorted, as they all would be without this.
    """
    before = spark.conf.get(_OPEN_WRITERS)
    spark.conf.set(_OPEN_WRITERS, str(most))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_WRITERS, before)


def release(*tables: DataFrame) -> None:
    """Delete the files of tables that ``write_out`` returned; frames made from one by a transformation are not such tables.

    Only for tables that nothing unwritten depends on.
    """
    for table in tables:
        path = table.__dict__.pop("_written_path", None)
        if path is not None:
            spark = table.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
