"""URL filters: ordered rules, then exact list membership by a Bloom filter cascade.

Level 0 of the cascade encodes the listed keys.  Level 1 encodes the unlisted
keys of the corpus that pass level 0, level 2 the listed keys that pass level 1,
and so on until no key passes wrongly.  A key belongs to the list exactly when
the first level that rejects it is odd (or, if none does, when the number of
levels is odd).  As the complete key universe of the corpus is tested while the
levels are built, the answer is exact for every key of the corpus, and a page is
judged without a join: the bits are sent to the tasks.

Keys are hosts; the list is a table of them, of any origin (``judge``).  The bits take
about ten per listed key.  A list of at most ``SEGMENT`` keys is one cascade that every
task holds.  A longer one is cut into segments by a hash, each with a cascade of its
own: pages are dealt to the tasks of their host's segment, a hot host to ``SALTS`` of
them, and a task holds the one segment it is at, so neither a task nor the driver ever
holds more than one.

Null urls and urls without ``://`` have empty host and path: no rule fits, and
the empty host is never listed.  Rows are judged one by one, so ties and
repeated rows need no care; an empty table gives an empty result.  Columns other
than ``page_id`` and ``url`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from orelake.storage import write_out

# (host, path, verdict): fits the host and its subdomains where the path begins so.
RULES: tuple[tuple[str, str, str], ...] = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
# The block list of the query: hosts with one of these words between dots and hyphens.
LISTED = r"(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)"
# Listed keys in one segment.
SEGMENT = 4_000_000
# Tasks that share the pages of a segment.
SALTS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    # (?s): a line break is a character like others.
    host = F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def rule_of(rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path`` (null: none), and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        name, verdict = F.when(fits, F.lit(host + path)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.select("*", F.xxhash64(F.lit(1), "host").alias("h1"), F.xxhash64(F.lit(2), "host").alias("h2"))


def _places(h1, h2, bits: int, hashes: int, level: int):
    """Bit numbers of keys at a level: keys x hashes."""
    import numpy as np

    u = np.uint64
    a, b = h1.astype(np.int64).view(u), h2.astype(np.int64).view(u)
    x = (a ^ u(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * u(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> u(29)))[:, None] + np.arange(hashes, dtype=u)[None, :] * (b | u(1))[:, None]
    x = (x ^ (x >> u(32))) * u(0x94D049BB133111EB)
    return (x ^ (x >> u(31))) % u(bits)


class Level:
    def __init__(self, number: int, bits: int, hashes: int, data: bytes):
        self.number, self.bits, self.hashes, self.data = number, bits, hashes, data

    def passes(self, h1, h2):
        import numpy as np

        place = _places(h1, h2, self.bits, self.hashes, self.number)
        held = np.frombuffer(self.data, np.uint8)
        return ((held[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _encode(keys: DataFrame, n: int, number: int, wrong: float) -> Level:
    """Bits of a level: pages of them are filled in the tasks and gathered."""
    import numpy as np

    bits = max(64, math.ceil(-n * math.log(wrong) / math.log(2) ** 2))
    hashes = max(1, round(bits / n * math.log(2)))

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _places(batch.column("h1").to_numpy(), batch.column("h2").to_numpy(), bits, hashes, number).ravel().astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place >> 6), pa.array(place & 63)], ["word", "bit"])

    words = keys.select("h1", "h2").mapInArrow(spots, "word bigint, bit bigint").groupBy("word").agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("held")
    )
    data = np.zeros(bits // 64 + 1, np.int64)
    found = words.toArrow()
    data[found.column("word").to_numpy()] = found.column("held").to_numpy()
    return Level(number, bits, hashes, data.tobytes())


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = shared.value.passes(batch.column("h1").to_numpy(), batch.column("h2").to_numpy())
            yield batch.filter(pa.array(good))

    return write_out(keys.mapInArrow(run, keys.schema), "cascade")


def build(universe: DataFrame, listed: str = "listed") -> list[Level]:
    """Levels over the key universe: distinct ``host`` rows with a ``listed`` mark."""
    keys = write_out(_hashed(universe).select("h1", "h2", listed), "cascade")
    yes, no = keys.filter(listed).select("h1", "h2"), keys.filter(f"NOT {listed}").select("h1", "h2")
    n_yes, n_no = yes.count(), no.count()
    levels: list[Level] = []
    # The set a level encodes, and the other one, which it is tested on.
    inside, n_inside, outside, n_outside = yes, n_yes, no, n_no
    while n_inside:
        wrong = 0.5 if levels else min(0.5, max(1e-6, n_yes / (math.sqrt(2) * max(n_no, 1))))
        level = _encode(inside, n_inside, len(levels), wrong)
        levels.append(level)
        if not n_outside:
            break
        failed = _passing(outside, level)
        inside, n_inside, outside, n_outside = failed, failed.count(), inside, n_inside
    return levels


def is_listed(levels: Sequence[Level], h1, h2):
    """Membership of keys of the universe."""
    import numpy as np

    answer = np.full(len(h1), len(levels) % 2 == 1)
    open_ = np.ones(len(h1), bool)
    for level in levels:
        rejected = open_.copy()
        rejected[open_] = ~level.passes(h1[open_], h2[open_])
        answer[rejected] = level.number % 2 == 1
        open_ &= ~rejected
    return answer


def mark(pages: DataFrame, universe: DataFrame, listed: str = "listed", segment: int = SEGMENT) -> DataFrame:
    """``pages`` (with ``host``) and whether the host is listed, in ``is_listed``."""
    segments = max(1, math.ceil(universe.filter(listed).count() / segment))
    if segments > 1:
        return _mark_by_segment(pages, universe, listed, segments)
    shared = pages.sparkSession.sparkContext.broadcast(build(universe, listed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = is_listed(shared.value, batch.column("h1").to_numpy(), batch.column("h2").to_numpy())
            yield batch.set_column(batch.schema.names.index("is_listed"), "is_listed", pa.array(found))

    df = _hashed(pages).withColumn("is_listed", F.lit(False))
    return df.mapInArrow(run, df.schema).select(*pages.columns, "is_listed")


_HELD = "_segment int, _salt int, number int, bits bigint, hashes int, held binary"


def _mark_by_segment(pages: DataFrame, universe: DataFrame, listed: str, segments: int) -> DataFrame:
    """Each segment's levels go as rows to the tasks of the segment, ahead of its pages."""
    spark = pages.sparkSession
    of = lambda c: F.pmod(F.xxhash64(F.lit(3), c), F.lit(segments)).cast("int")
    universe = write_out(universe.select("host", listed, of("host").alias("_segment")), "segments")
    parts = []
    for s in range(segments):
        levels = build(universe.filter(F.col("_segment") == s), listed)
        rows = [(s, k.number, k.bits, k.hashes, k.data) for k in levels]
        frame = spark.createDataFrame(rows, "_segment int, number int, bits bigint, hashes int, held binary")
        # One segment at a time is on the driver; it leaves it for the shared folder.
        parts.append(write_out(frame.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "levels"))
    own = parts[0]
    for part in parts[1:]:
        own = own.union(part)
    none = lambda kind: F.lit(None).cast(kind)
    row = F.struct(*[F.col(f"`{n}`") for n in pages.columns]).alias("_row")
    hashed = _hashed(pages.select(row, "host")).select(
        "_row", "h1", "h2", of("host").alias("_segment"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("_salt"),
        none("int").alias("number"), none("bigint").alias("bits"), none("int").alias("hashes"), none("binary").alias("held"),
    )
    levels = own.select(
        none(hashed.schema["_row"].dataType.simpleString()).alias("_row"), none("bigint").alias("h1"), none("bigint").alias("h2"),
        "_segment", "_salt", "number", "bits", "hashes", "held",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        at, held = None, []
        for batch in batches:
            segment, salt = (batch.column(c).to_numpy() for c in ("_segment", "_salt"))
            number = batch.column("number")
            level = ~np.asarray(number.is_null())
            cuts = np.flatnonzero((segment[1:] != segment[:-1]) | (salt[1:] != salt[:-1]) | (level[1:] != level[:-1])) + 1
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(first, last - first)
                if last > first and level[first]:
                    if (segment[first], salt[first]) != at:
                        at, held = (segment[first], salt[first]), []
                    columns = [part.column(c).to_pylist() for c in ("number", "bits", "hashes", "held")]
                    held += [Level(*values) for values in zip(*columns)]
                elif last > first:
                    # A segment without listed keys has no levels.
                    own = held if (segment[first], salt[first]) == at else []
                    found = is_listed(own, part.column("h1").to_numpy(), part.column("h2").to_numpy()) if own else np.zeros(last - first, bool)
                    yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(found)], ["_row", "is_listed"])

    dealt = hashed.union(levels).repartition("_segment", "_salt").sortWithinPartitions("_segment", "_salt", F.col("number").isNull(), "number")
    marked = dealt.mapInArrow(run, StructType([hashed.schema["_row"], StructField("is_listed", BooleanType())]))
    return marked.select(*[F.col("_row").getField(n).alias(n) for n in pages.columns], "is_listed")


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, listed: str | DataFrame = LISTED, segment: int = SEGMENT
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``listed`` is a table with the unwanted hosts in ``host`` (repeats and hosts that no page
    has are harmless), or a pattern, which stands for the hosts of the pages that it fits.
    """
    host, path = url_parts(F.col("url"))
    split = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    hosts = split.filter("host <> ''").select("host").distinct()
    if isinstance(listed, DataFrame):
        known = listed.select(F.translate("host", _UPPER, _LOWER).alias("host")).filter("host <> ''").distinct()
        marked = hosts.join(known.withColumn("listed", F.lit(True)), "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    else:
        marked = hosts.withColumn("listed", F.col("host").rlike(listed))
    found = mark(split, write_out(marked, "hosts"), segment=segment)
    rule, verdict = rule_of(rules)
    own = F.when(F.col("is_listed") & (F.col("host") != ""), "block").otherwise("allow")
    return found.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))
