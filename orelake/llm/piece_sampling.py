"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

``encode`` adds a sampled segmentation of every whole text over the lattice of
all its pieces (see ``piece_lattice``); the row key ``doc_id`` and a seed fix the
sample, wherever and whenever it is drawn.  ``decode`` gives the text back
exactly: spaces are kept as they are, and characters without a piece are spelled
in bytes.

The vocabulary is read from the model file by the driver and sent to the tasks;
its size is fixed by that file (tens of thousands of pieces).  Null and empty
texts have no pieces and decode to the empty text.  Rows with equal id and text
get equal pieces; a null id counts as 0.  An empty table gives an empty result;
other columns pass through untouched, except that one named as the new column is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orelake.llm.piece_lattice import Sampler, Vocabulary

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED = 42
# Exponent of 1 / (rank + 1): 0 draws all segmentations alike, large values the most frequent pieces.
SHARPNESS = 1.0
# Characters of text in a batch that goes back to Spark (a longer text comes alone).
_BATCH = 1 << 20


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary.load(path)


def _slices(batch: pa.RecordBatch, text: pa.Array):
    """Neighbouring rows of a batch with about ``_BATCH`` bytes of text."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + _BATCH, "right")), start + 1)
        yield start, stop
        start = stop


def _encoder(shared, seed: int, sharpness: float, place: int, checked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        sampler = Sampler(shared.value, seed, sharpness)
        for batch in batches:
            rows = batch.column("_row")
            text = rows.field(place)
            for start, stop in _slices(batch, text):
                texts = [t or "" for t in text.slice(start, stop - start).to_pylist()]
                keys = [k or 0 for k in batch.column("_row_key").slice(start, stop - start).to_pylist()]
                ids, sizes = sampler.encode(keys, texts)
                ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
                columns = [rows.slice(start, stop - start), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))]
                names = ["_row", "_pieces"]
                if checked:
                    columns.append(pa.array(sampler.lossless(ids, sizes, texts), pa.bool_()))
                    names.append("_lossless")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode(
    df: DataFrame, path: str = MODEL, seed: int = SEED, sharpness: float = SHARPNESS, column: str = "pieces", check: str | None = None
) -> DataFrame:
    """Add the sampled pieces of ``text`` and, as ``check``, whether they decode to it (null counts as empty)."""
    shared = df.sparkSession.sparkContext.broadcast(_vocabulary(path))
    names = [n for n in df.columns if n not in (column, check)]
    # A text that the new column replaces is read all the same.
    carried = names if "text" in names else [*names, "text"]
    made = {"_pieces": (column, "array<int>")} | ({"_lossless": (check, "boolean")} if check else {})
    run = _encoder(shared, seed, sharpness, carried.index("text"), check is not None)
    return _beside(df, run, names, carried, made)


def decode(df: DataFrame, path: str = MODEL, pieces: str = "pieces", column: str = "decoded") -> DataFrame:
    """Add the text that the pieces spell."""
    shared = df.sparkSession.sparkContext.broadcast(_vocabulary(path))
    names = [n for n in df.columns if n != column]
    carried = names if pieces in names else [*names, pieces]
    place = carried.index(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(shared.value)
        for batch in batches:
            rows = batch.column("_row")
            for start in range(0, batch.num_rows, 256):
                some = rows.slice(start, 256)
                texts = [sampler.decode(p or []) for p in some.field(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([some, pa.array(texts, pa.string())], ["_row", "_decoded"])

    return _beside(df, run, names, carried, {"_decoded": (column, "string")})


def _beside(df: DataFrame, run, names: list[str], carried: list[str], made: dict[str, tuple[str, str]]) -> DataFrame:
    """Run over rows packed in one column, so that no name can clash, and unpack them beside the new columns."""
    row = F.struct(*[F.col(f"`{n}`") for n in carried]).alias("_row")
    packed = df.select(row, F.col("doc_id").cast("long").alias("_row_key"))
    new = StructType.fromDDL(", ".join(f"{n} {kind}" for n, (_, kind) in made.items()))
    out = packed.mapInArrow(run, StructType([*packed.select("_row").schema.fields, *new.fields]))
    return out.select(*[F.col("_row").getField(n).alias(n) for n in names], *[F.col(n).alias(as_) for n, (as_, _) in made.items()])
