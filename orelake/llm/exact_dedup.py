"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed size.  Equal blocks get one integer name
by sorting blocks, dealt by their content, within each share; the names of a text form a shorter text, whose
adjacent pairs are named in the same way, until one name is left.  Names come
from sorted contents and never from hashes, so two texts have the same final
(level, name) exactly when they are equal.

Each task keeps a dictionary of the blocks it has met and sends a block only
once, so a block that fills a third of the corpus reaches the sort as one row
per task.  The dictionary is emptied when it holds ``HELD`` bytes.

Texts are equal when identical after every run of space and tab..carriage
return became one space; null counts as empty, and empty texts form a group.
Of equal texts the smallest ``doc_id`` stays (null ids last; of rows with equal
ids, one).  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm import rows as _rows
from orelake.storage import release, write_out

# Bytes of text in a block of the first level; later levels name pairs.
BLOCK = 4096
# Bytes of blocks that a task's dictionary may hold.
HELD = 64 << 20

_NAMED = "uid bigint, doc_id bigint, sha string"
_STAGED = f"{_NAMED}, task int, refs array<bigint>, fresh array<struct<ref: bigint, block: binary>>"


def plain(text: Column) -> Column:
    """The text as it is compared; the pattern only matches where something changes."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _cut(size: int, first: bool):
    """Per text: the task's numbers of its blocks, and the blocks that are new to the task's dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import zstandard
        from pyspark import TaskContext

        # Equal blocks have equal compressed bytes, and only they.
        pack = zstandard.ZstdCompressor(level=1).compress
        task = TaskContext.get().partitionId()
        seen: dict[bytes, int] = {}
        held = made = row = 0
        for batch in batches:
            refs, fresh = [], []
            for content in batch.column("content").to_pylist():
                if not first:
                    content = np.array(content, ">i8").tobytes()
                own, new = [], []
                for at in range(0, max(len(content), 1), size):
                    block = content[at : at + size]
                    ref = seen.get(block)
                    if ref is None:
                        ref = seen[block] = made
                        made += 1
                        held += len(block) + 100
                        new.append({"ref": ref, "block": pack(block) if first else block})
                    own.append(ref)
                refs.append(own)
                fresh.append(new)
                if held > HELD:
                    seen.clear()
                    held = 0
            n = batch.num_rows
            uid = pa.array(range((task << 33) + row, (task << 33) + row + n), pa.int64()) if first else batch.column("uid")
            row += n
            yield pa.RecordBatch.from_arrays(
                [
                    uid, batch.column("doc_id"), batch.column("sha"), pa.array([task] * n, pa.int32()),
                    pa.array(refs, pa.list_(pa.int64())),
                    pa.array(fresh, pa.list_(pa.struct([("ref", pa.int64()), ("block", pa.binary())]))),
                ],
                ["uid", "doc_id", "sha", "task", "refs", "fresh"],
            )

    return run


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted blocks of one share: equal neighbours have one name, others the next."""
    from pyspark import TaskContext

    name, last = TaskContext.get().partitionId() << 40, None
    for batch in batches:
        names = []
        for block in batch.column("block").to_pylist():
            if last is not None and block != last:
                name += 1
            last = block
            names.append(name)
        yield pa.RecordBatch.from_arrays(
            [batch.column("task"), batch.column("ref"), pa.array(names, pa.int64())], ["task", "ref", "name"]
        )


def identities(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: uid, doc_id, sha and the identity (level, name) of its text."""
    text = plain(F.col("text"))
    current = docs.select(F.col("doc_id").cast("long"), text.alias("text")).select(
        "doc_id", F.sha2("text", 256).alias("sha"), F.col("text").cast("binary").alias("content")
    )
    done, level = None, 0
    while True:
        cut = _cut(block if level == 0 else 16, level == 0)
        staged = write_out(current.mapInArrow(cut, _STAGED), "blocks")
        names = (
            staged.select("task", F.inline("fresh"))
            .repartition("block")
            .sortWithinPartitions("block")
            .mapInArrow(_number, "task int, ref bigint, name bigint")
        )
        named = write_out(
            staged.select("uid", "doc_id", "sha", "task", F.posexplode("refs").alias("at", "ref"))
            .join(names, ["task", "ref"])
            .groupBy("uid", "doc_id", "sha")
            .agg(F.array_sort(F.collect_list(F.struct("at", "name"))).getField("name").alias("names")),
            "names",
        )
        # The texts' blocks have names now; the blocks themselves are read no more.
        release(staged)
        ended = named.filter(F.size("names") == 1).select(
            "uid", "doc_id", "sha", F.lit(level).alias("level"), F.col("names")[0].alias("name")
        )
        done = ended if done is None else done.union(ended)
        rest = named.filter(F.size("names") > 1)
        if rest.isEmpty():
            return done
        current, level = rest.select("uid", "doc_id", "sha", F.col("names").alias("content")), level + 1


def groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    named = identities(docs, block)
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "uid")
    per_text = named.groupBy("level", "name").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
    # Written, so that both sides of the join are plain shuffles, which Spark splits where a text is hot.
    per_text = write_out(per_text, "texts")
    return named.join(per_text, ["level", "name"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("first.uid")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of ``docs`` that stay, all columns unchanged.

    Texts are found again by id and digest; rows with both in common are cut to
    one in each map task, before the one shuffle that the join needs.
    """
    kept = groups(docs, block).filter("kept")
    stay = kept.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key"), F.col("text_sha256").alias("_mark"))
    return _rows.keep(docs, stay, F.sha2(plain(F.col("text")), 256))
