"""WARC archives: written from pages, read back by verified chains of record boundaries.

Writing.  Payloads of at least 100 bytes are stored once: of equal ones the row
with the smallest ``page_id`` (null last, then by url) is a ``response``, the
others are ``revisit`` records that refer to it.  Which digests repeat is found on
narrow rows.  Payloads whose digest falls in no slot of a repeated one are written
straight from the scan; of the rest one row per digest passes the shuffle, since
each map task keeps the first of its copies only.  The table of slots has at most
``SLOTS`` rows, however many digests repeat.  Records are text with the record
separator of the format between them, so Spark's own writer makes the files.

Reading.  1. Tasks look through ranges of the files for the magic and emit
*candidates*: start, and the successor that the header's length implies.  A payload
may hold the magic, even whole records, so a candidate proves nothing.
2. Within a range every candidate follows its successors to the *exit* beyond the
range; the candidates that lead to one exit form a tree, numbered so that "b is
reached from a" is a comparison of numbers.
3. Pointer jumping over the few candidates that other ranges exit to (file,
start -> exit), from the start of each file, doubles the verified distance a round.
4. Records are the candidates reached from their range's verified entry; only
their payloads are read.

Pages: a null url writes no target header; characters of an url that cannot stand
in a header are percent-encoded; a null html is an empty payload; repeated rows are
records of their own.  A file that does not begin with a record gives no records;
where a chain breaks (truncated file) the records up to there are kept.  An empty
table gives an archive without records.  Other columns than page_id, url and html
are not read.

Ranges are read through Arrow's file systems (local, HDFS, S3, GCS, ABFS), names and
lengths of the files by Spark.  A task holds one header, one payload and ``WINDOW``
bytes at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.storage import new_path, release, write_out

# Payloads below this size are never replaced by a reference.
LEAST = 100
# Rows of the table that tells which payloads may repeat.
SLOTS = 1 << 20
# Bytes of a file in the care of one task, and read at a time.
RANGE = 16 << 20
WINDOW = 1 << 20
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the format.
MAGIC = "WARC/1.1"
SEPARATOR = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ID = "urn:orelake"


def _lines(*fields: tuple[str, Column]) -> Column:
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in fields])


def _header_value(url: Column) -> Column:
    """``url`` with what cannot stand in a header line percent-encoded."""
    for code in (*range(0x21), 0x7F):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def _record(kind: str, record_id: Column, n_bytes: Column, digest: Column, refers_to: Column | None, payload: Column | None) -> Column:
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), n_bytes.cast("string"), F.lit(SEPARATOR)
    )
    length = F.octet_length(http) + (F.lit(0) if payload is None else n_bytes)
    named = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    more = [] if refers_to is None else [("WARC-Refers-To", named(refers_to)), ("WARC-Profile", F.lit(PROFILE))]
    header = _lines(
        ("WARC-Type", F.lit(kind)), ("WARC-Record-ID", named(record_id)), ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", _header_value(F.col("url"))), ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)), *more,
        ("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", length.cast("string")),
    )
    parts = [F.lit(f"{MAGIC}\r\n"), header, F.lit("\r\n"), http]
    return F.concat(*parts, *([] if payload is None else [payload]))


def _read(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
        F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("n_bytes"),
    )


_FIELDS = ("page_id", "url", "html", "digest", "n_bytes")


def _slot() -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(SLOTS))


def records(pages: DataFrame) -> DataFrame:
    """The records of an archive, as text, one per row of ``pages``."""
    narrow = _read(pages).filter(F.col("n_bytes") >= LEAST).select("page_id", "url", "digest", "n_bytes")
    narrow = write_out(narrow.withColumn("uid", F.monotonically_increasing_id()), "payloads")
    order = F.struct(F.col("page_id").isNull().alias("late"), "page_id", F.col("url").isNull().alias("bare"), "url", "uid")
    repeated = narrow.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = write_out(repeated, "repeated")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    single = F.concat_ws(":", F.lit(_ID), page, "digest")

    # Both sides are plain shuffles of narrow rows, which Spark splits where a payload is hot.
    revisits = narrow.join(repeated, "digest").filter("uid <> first.uid")
    target = F.concat_ws(":", F.lit(_ID), F.coalesce(F.col("first.page_id").cast("string"), F.lit("")), "digest")
    own = F.concat_ws(":", single, F.col("uid").cast("string"))
    revisits = revisits.select(_record("revisit", own, F.col("n_bytes"), F.col("digest"), target, None).alias("value"))

    # Small payloads have no slot, so that none can match.
    whole = _read(pages).withColumn("_slot", F.when(F.col("n_bytes") >= LEAST, _slot()))
    slots = F.broadcast(repeated.select(_slot().alias("_slot")).distinct())
    once = whole.join(slots, "_slot", "left_semi").withColumn(
        "_rank", F.expr("row_number() over (partition by digest order by page_id is null, page_id, url is null, url)")
    )
    responses = whole.join(slots, "_slot", "left_anti").select(*_FIELDS).union(once.filter("_rank = 1").select(*_FIELDS))
    numbered = F.concat_ws(":", single, F.monotonically_increasing_id().cast("string"))
    name = F.when(F.col("n_bytes") < LEAST, numbered).otherwise(single)
    return responses.select(_record("response", name, F.col("n_bytes"), F.col("digest"), None, F.col("html")).alias("value")).union(revisits)


def write(pages: DataFrame, path: str) -> None:
    """Write the archive of ``pages`` under ``path``."""
    records(pages).write.option("lineSep", SEPARATOR).text(path)


class _File:
    """Reads at any place of a file, from a window that moves forward with them."""

    def __init__(self, uri: str, size: int):
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
        self.source, self.size, self.begin, self.held = store.open_input_file(path), size, 0, b""

    def read(self, at: int, n: int) -> bytes:
        n = max(min(n, self.size - at), 0)
        if at < self.begin or at + n > self.begin + len(self.held):
            self.begin, self.held = at, self.source.read_at(min(max(n, WINDOW), self.size - at), at)
        return self.held[at - self.begin : at - self.begin + n]

    def close(self) -> None:
        self.source.close()


_HEADER = re.compile(rb"WARC/1\.[01]\r\n(?:[!-9;-~]+:[^\r\n]*\r\n)*\r\n")
_BEGUN = re.compile(rb"WARC/1\.[01]\r?\n?(?:[!-9;-~]+:[^\r\n]*\r\n)*(?:[!-9;-~]+(?::[^\r\n]*\r?)?)?\r?")
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*([0-9]{1,18})[ \t]*\r\n", re.I)
_MAGIC = b"WARC/1."


def _header(source: _File, start: int) -> bytes | None:
    """The header block at ``start``, however long, or None where there is none."""
    want = 2048
    while True:
        held = source.read(start, want)
        end = held.find(b"\r\n\r\n")
        if end >= 0:
            found = _HEADER.fullmatch(held[: end + 4])
            return found and found.group()
        # A line that cannot be a header line ends the search before the blank line.
        if len(held) < want or not _BEGUN.fullmatch(held):
            return None
        want *= 4


def _starts(source: _File, first: int, last: int) -> Iterator[int]:
    """Offsets in [first, last) at which the magic stands at the start of a line."""
    for at in range(first, last, WINDOW // 2):
        # The line end before and the rest of a magic on the border are read along.
        begin, end = max(at - 1, 0), min(at + WINDOW // 2, last)
        held = source.read(begin, end - begin + len(_MAGIC))
        place = held.find(_MAGIC)
        while place >= 0:
            start = begin + place
            if at <= start < end and (start == 0 or held[place - 1 : place] == b"\n"):
                yield start
            place = held.find(_MAGIC, place + 1)


def numbered(starts: list[int], following: list[int]) -> tuple[list[int], list[int], list[int]]:
    """For each start its exit and its numbers (low, high): b is reached from a exactly where low[b] <= low[a] < high[b]."""
    place = {s: i for i, s in enumerate(starts)}
    n = len(starts)
    exits, weight = list(following), [1] * n
    parent = [place.get(f, -1) for f in following]
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            exits[i] = exits[parent[i]]
    for i in range(n):
        # Successors stand later, so a start's own tree is complete when it is met.
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
    low, taken, free = [0] * n, [1] * n, 0
    for i in range(n - 1, -1, -1):
        if parent[i] < 0:
            low[i], free = free, free + weight[i]
        else:
            low[i] = low[parent[i]] + taken[parent[i]]
            taken[parent[i]] += weight[i]
    return exits, low, [a + w for a, w in zip(low, weight)]


_CANDIDATE = "file string, size bigint, range bigint, start bigint, head int, next bigint, exit bigint, low bigint, high bigint"


def _candidates(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                starts, heads, following = [], [], []
                size, first = row["size"], row["range"] * width
                source = _File(row["file"], size)
                for start in list(_starts(source, first, min(first + width, size))):
                    header = _header(source, start)
                    length = header and _LENGTH.search(header)
                    if length:
                        starts.append(start)
                        heads.append(len(header))
                        following.append(start + len(header) + int(length[1]) + len(SEPARATOR))
                source.close()
                exits, low, high = numbered(starts, following)
                n = len(starts)
                long = lambda x: pa.array(x, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * n, pa.string()), long([size] * n), long([row["range"]] * n), long(starts),
                        pa.array(heads, pa.int32()), long(following), long(exits), long(low), long(high),
                    ],
                    ["file", "size", "range", "start", "head", "next", "exit", "low", "high"],
                )

    return run


def candidates(spark: SparkSession, path: str, width: int = RANGE) -> DataFrame:
    """Every place of the archive at which a record could begin, with its successor; ``width`` bytes a range."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.filter("length > 0").select(F.col("path").alias("file"), F.col("length").alias("size"))
    last = F.floor((F.col("size") - 1) / width).cast("long")
    ranges = files.withColumn("range", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return ranges.repartition("file", "range").mapInArrow(_candidates(width), _CANDIDATE)


def verified(found: DataFrame) -> DataFrame:
    """Of the candidates those that a chain from the start of their file reaches."""
    found = write_out(found, "candidates")
    entered = found.select("file", F.col("exit").alias("start")).union(found.filter("start = 0").select("file", "start"))
    entries = found.join(entered.distinct(), ["file", "start"], "left_semi")
    state = write_out(entries.select("file", "start", F.col("exit").alias("jump"), (F.col("start") == 0).alias("reached")), "chain")
    while True:
        on = state.select("file", F.col("start").alias("jump"), F.col("jump").alias("further"))
        ahead = state.join(on, ["file", "jump"])
        if ahead.isEmpty():
            break
        # What a reached candidate jumps to is reached; every jump becomes twice as long.
        reached = state.filter("reached").select("file", F.col("jump").alias("start"), F.lit(None).cast("long").alias("jump"), "reached")
        longer = state.join(on, ["file", "jump"], "left").select("file", "start", F.coalesce("further", "jump").alias("jump"), "reached")
        merged = longer.union(reached).groupBy("file", "start").agg(F.max("jump").alias("jump"), F.max("reached").alias("reached"))
        # An exit that is no candidate (the file's end) has no jump of its own.
        spent, state = state, write_out(merged.filter("jump is not null"), "chain")
        release(spent)
    entry = state.filter("reached").select("file", "start").join(found, ["file", "start"])
    entry = entry.select("file", "range", F.col("low").alias("_low"))
    return found.join(entry, ["file", "range"]).filter("low <= _low and _low < high and next <= size").drop("_low")


_HELD = 8 << 20
_RECORD = "file string, start bigint, header string, payload binary"


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * 4
        kinds = (pa.string(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "start", "header", "payload"])

    name = source = None
    held, rows = 0, []
    for batch in batches:
        for row in batch.select(["file", "size", "start", "head", "next"]).to_pylist():
            if row["file"] != name:
                if source is not None:
                    source.close()
                name, source = row["file"], _File(row["file"], row["size"])
            content = source.read(row["start"], row["next"] - len(SEPARATOR) - row["start"])
            # The block is an HTTP response: its own header ends with the first blank line.
            cut = content.find(b"\r\n\r\n", row["head"]) + 4
            header = content[:cut].decode("utf-8", "replace")
            rows.append((name, row["start"], header, content[cut:]))
            held += len(content)
            if held > _HELD:
                yield batch_of(rows)
                held, rows = 0, []
    if source is not None:
        source.close()
    yield batch_of(rows)


def _value(name: str) -> Column:
    """A header's value without the brackets of an identifier, null where it is missing or empty."""
    return F.nullif(F.regexp_extract("header", rf"(?i)\r\n{name}:[ \t]*<?([^\r\n]*?)>?\r\n", 1), F.lit(""))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive of HTTP responses: file, start, record_id, record_type, target_uri, refers_to, digest, n_bytes, payload.

    ``digest`` and ``n_bytes`` are those of the full payload: of a response as it is
    stored, of a revisit as its headers state them.
    """
    chain = verified(candidates(spark, path))
    rows = chain.repartition("file", "range").sortWithinPartitions("file", "start").mapInArrow(_payloads, _RECORD)
    stored = _value("WARC-Type") == "response"
    stated = F.regexp_extract("header", r"(?is)\r\n\r\n.*?\r\ncontent-length:[ \t]*([0-9]+)", 1).cast("long")
    return rows.select(
        "file", "start", _value("WARC-Record-ID").alias("record_id"), _value("WARC-Type").alias("record_type"),
        _value("WARC-Target-URI").alias("target_uri"), _value("WARC-Refers-To").alias("refers_to"),
        F.when(stored, F.sha2("payload", 256)).otherwise(F.regexp_extract("header", r"(?i)\r\nWARC-Payload-Digest:[ \t]*sha256:([0-9a-f]+)", 1)).alias("digest"),
        F.when(stored, F.octet_length("payload").cast("long")).otherwise(stated).alias("n_bytes"),
        F.when(stored, F.col("payload")).alias("payload"),
    )


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to an archive in the shared folder, read it back and state what each page became."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write(pages, path)
    page = lambda name: F.nullif(F.split(name, ":")[2], F.lit("")).cast("long")
    return read(spark, path).select(
        page(F.col("record_id")).alias("page_id"), F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", page(F.col("refers_to")).alias("refers_to"),
    )
