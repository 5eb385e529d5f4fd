"""How far the sources of a language diverge in their words.

1. Document frequencies: every task counts the distinct terms of its texts; terms in
   at least ``LEAST`` documents of a language are its vocabulary.
2. The vocabulary is spread by *range*, numbered in order (ordinals) and cut into
   shards of ``SHARD`` neighbours; a task builds each shard's minimal acyclic
   transducer (``term_transducer``).
3. Recount: whole texts stream through the transducers, which give ordinals; counts
   per (language, source, ordinal) are summed in each task first.  The transducers go
   to all tasks while they hold at most ``HELD`` bytes together; beyond that each
   shard's transducer goes to the tasks of its shard and the texts' terms, counted per
   task, are routed to it.  Both ways give the same counts.
4. Smoothed shares and divergences in whole numbers.  Pairs of sources meet in tiles
   of sources and blocks of ordinals, and leave a task as one sum per pair.

Terms are runs of letters A-Z, a-z and of all characters beyond ASCII, only A-Z
lower-cased.  Null text, language and source count as ''.  Texts without terms still
make their (language, source) group occur.  Equal values are ranked by ordinal, which
is the order of the terms' bytes, or by the source's bytes.  Repeated rows count each.
Texts of a language are taken in pieces, whose terms are told apart in columns of bytes;
Python touches the distinct ones of a piece only.  Very long texts pass in several pieces.  An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orelake.llm.merkle_manifest import placed
from orelake.storage import write_out

LEAST = 10
TOP = 10
SHARD = 1 << 18
# Bytes of transducers that every task may hold.
HELD = 64 << 20
# Terms that a task counts before it hands them on, and known terms before it forgets them.
ENTRIES = 500_000
# Counts of ordinals, as columns, that a task holds before it hands them on.
CELLS = 2_000_000
# Sources on either side of a tile, and ordinals in a block.
TILE, BLOCK = 256, 4096
# Tasks a shard is dealt to where terms are routed.
SALTS = 8

SCALE = 1_000_000_000

_KEPT = bytes(b | 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
# Bytes of text whose terms are told apart at a time.
_PIECE = 4 << 20
# A byte that is in no term, as a term between two texts.
_MARK = b"\0"


def _texts(batch: pa.RecordBatch, of: str = "lang") -> Iterator[tuple[str, list[str], list[bytes]]]:
    """Rows of one language at a time, about ``_PIECE`` bytes of them or one longer text: (lang, ``of``, texts)."""
    held: dict[str, tuple[list[str], list[bytes]]] = {}
    size: dict[str, int] = {}
    for lang, source, text in zip(*[batch.column(c).to_pylist() for c in ("lang", of, "text")]):
        if len(text) > _PIECE:
            yield lang, [source], [text]
            continue
        sources, texts = held.setdefault(lang, ([], []))
        sources.append(source)
        texts.append(text)
        size[lang] = size.get(lang, 0) + len(text)
        if size[lang] > _PIECE:
            yield lang, *held.pop(lang)
            del size[lang]
    for lang, (sources, texts) in held.items():
        yield lang, sources, texts


def told(texts: list[bytes]) -> Iterator[tuple]:
    """(terms, which of them each word is, text of each word) of all words; a long text alone comes in pieces."""
    import numpy as np

    plain = (b" " + _MARK + b" ").join([t.translate(_KEPT) for t in texts]) + b" "
    at = 0
    while at < len(plain):
        cut = plain.find(b" ", at + 2 * _PIECE) if len(texts) == 1 else -1
        cut = len(plain) if cut < 0 else cut + 1
        part = np.frombuffer(plain, np.uint8, cut - at, at)
        at = cut
        # Every word ends with its blank; the others go.
        blank = part == 0x20
        stay = np.append(not blank[0], ~(blank[1:] & blank[:-1]))
        ends = np.flatnonzero(blank[stay]) + 1
        buffers = [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(part[stay])]
        column = pa.Array.from_buffers(pa.large_binary(), len(ends), buffers).dictionary_encode()
        terms = b"".join(filter(None, column.dictionary.buffers()[2:])).split(b" ")[: len(column.dictionary)]
        code = column.indices.to_numpy().astype(np.int64)
        row = np.zeros(len(code), np.int64)
        if len(texts) > 1:
            mark = code == terms.index(_MARK)
            row, code = np.cumsum(mark)[~mark], code[~mark]
        yield terms, code, row


def _table(columns: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    """Columns put together from (values, or one value and how often) of each group."""
    arrays = []
    for kind, parts in zip(kinds, zip(*columns) if columns else [()] * len(kinds)):
        made = [pa.repeat(pa.scalar(p[0], kind), p[1]) if isinstance(p, tuple) else pa.array(p, kind) for p in parts]
        arrays.append(pa.concat_arrays(made) if made else pa.array([], kind))
    return pa.RecordBatch.from_arrays(arrays, names)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    counts: dict[str, dict[bytes, int]] = {}

    def emptied() -> pa.RecordBatch:
        rows = [((lang, len(own)), list(own), list(own.values())) for lang, own in counts.items()]
        counts.clear()
        return _table(rows, [pa.string(), pa.binary(), pa.int64()], ["lang", "term", "n"])

    def found(texts: list[bytes]) -> Iterator[tuple[bytes, int]]:
        if len(texts) == 1:
            distinct: set[bytes] = set()
            for terms, code, _ in told(texts):
                distinct.update([terms[i] for i in np.unique(code).tolist()])
            yield from zip(distinct, repeat(1))
        else:
            for terms, code, row in told(texts):
                n = np.bincount(_distinct(row * len(terms) + code)[0] % len(terms), minlength=len(terms))
                some = np.flatnonzero(n)
                yield from zip([terms[i] for i in some.tolist()], n[some].tolist())

    for batch in batches:
        for lang, _, texts in _texts(batch):
            own = counts.setdefault(lang, {})
            for term, n in found(texts):
                own[term] = own.get(term, 0) + n
            if sum(map(len, counts.values())) > ENTRIES:
                yield emptied()
    yield emptied()


def _distinct(numbers) -> tuple:
    """Distinct numbers in order, and how often each occurs."""
    import numpy as np

    held = np.sort(numbers)
    first = np.flatnonzero(np.append(held[:1] == held[:1], held[1:] != held[:-1]))
    return held[first], np.diff(np.append(first, len(held)))


def _read(docs: DataFrame) -> DataFrame:
    plain = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    return docs.select(plain("lang").alias("lang"), plain("source").alias("source"), plain("text").cast("binary").alias("text"))


def vocabulary(texts: DataFrame) -> DataFrame:
    """(lang, term, at, n): the kept terms, their ordinals and how many their language has."""
    counts = texts.select("lang", "text").mapInArrow(_document_counts, "lang string, term binary, n bigint")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)
    return placed(kept.select(F.col("lang").alias("tree"), "term"), ["term"]).withColumnRenamed("tree", "lang")


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from orelake.llm.term_transducer import Transducer

    def shards() -> Iterator[tuple]:
        key, terms = None, []
        for batch in batches:
            for *own, term in zip(*[batch.column(c).to_pylist() for c in ("lang", "shard", "term")]):
                if own != key:
                    if terms:
                        yield (*key, terms)
                    key, terms = own, []
                terms.append(term)
        if terms:
            yield (*key, terms)

    for lang, shard, terms in shards():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang], pa.string()), pa.array([shard], pa.int64()), pa.array([terms[0]], pa.binary()),
                pa.array([Transducer.build(terms).pack()], pa.binary()),
            ],
            ["lang", "shard", "first", "packed"],
        )


def transducers(kept: DataFrame, shard: int = SHARD) -> DataFrame:
    """(lang, shard, first, packed): one transducer per shard of neighbouring terms."""
    rows = kept.select("lang", F.floor(F.col("at") / shard).cast("long").alias("shard"), "term", "at")
    rows = rows.repartition("lang", "shard").sortWithinPartitions("lang", "shard", "at").drop("at")
    return rows.mapInArrow(_build, "lang string, shard bigint, first binary, packed binary")


class _Shards:
    """Transducers of all shards, each unpacked when it is first used."""

    def __init__(self, packed: list[tuple[str, int, bytes, bytes]], shard: int):
        self.size, self.of = shard, {}
        for lang, number, first, data in sorted(packed):
            firsts, rest = self.of.setdefault(lang, ([], []))
            firsts.append(first)
            rest.append((number, data))

    def lookup(self, lang: str, terms: list[bytes]) -> list[int]:
        """Ordinals of ``terms``, -1 for one that is not kept."""
        from bisect import bisect_right

        import numpy as np

        from orelake.llm.term_transducer import Transducer

        firsts, rest = self.of.get(lang, ((), ()))
        ordinals = np.full(len(terms), -1, np.int64)
        own = np.fromiter(map(bisect_right, repeat(firsts), terms), np.int64, len(terms)) - 1
        for i in np.unique(own[own >= 0]).tolist():
            number, found = rest[i]
            if isinstance(found, bytes):
                found = Transducer.unpack(found)
                rest[i] = (number, found)
            place = np.flatnonzero(own == i)
            at = found.lookup_all([terms[k] for k in place.tolist()])
            ordinals[place] = np.where(at < 0, -1, number * self.size + at)
        return ordinals.tolist()


# Bits of an ordinal beside the number of a group.
_ORDINAL = 38
_COUNTED = "lang string, source string, at bigint, n bigint"


def _counted(counts: dict, key: pa.DataType) -> pa.RecordBatch:
    rows = [((lang, len(own)), (source, len(own)), list(own), list(own.values())) for (lang, source), own in counts.items()]
    counts.clear()
    return _table(rows, [pa.string(), pa.string(), key, pa.int64()], ["lang", "source", "at", "n"])


def _cells(sources: list[str], texts: list[bytes]) -> Iterator[tuple]:
    """(sources, terms, source, term, n) of a piece: both as numbers, each pair that occurs and how often."""
    import numpy as np

    names = {name: i for i, name in enumerate(dict.fromkeys(sources))}
    of = np.array([names[name] for name in sources], np.int64)
    for terms, code, row in told(texts):
        cell, n = _distinct(of[row] * len(terms) + code)
        yield list(names), terms, cell // len(terms), cell % len(terms), n


def _streamed(shared, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import defaultdict

        import numpy as np

        shards = _Shards(shared.value, shard)
        known: dict[str, dict[bytes, int]] = defaultdict(dict)
        groups: dict[tuple[str, str], int] = {}
        # Cells as one number of group and ordinal, and their counts; the first pair of columns is summed.
        cells: list[tuple] = []

        def summed() -> tuple:
            cell, n = (np.concatenate(x) for x in zip(*cells))
            order = np.argsort(cell)
            cell, n = cell[order], n[order]
            first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            return cell[first], np.add.reduceat(n, first)

        def emptied() -> pa.RecordBatch:
            cell, n = summed()
            group = pa.array(cell >> _ORDINAL)
            own = [pa.array(x, pa.string()).take(group) for x in zip(*groups)]
            cells.clear()
            groups.clear()
            return pa.RecordBatch.from_arrays([*own, pa.array(cell & ((1 << _ORDINAL) - 1)), pa.array(n)], ["lang", "source", "at", "n"])

        for batch in batches:
            for lang, sources, texts in _texts(batch, "source"):
                for names, terms, source, term, n in _cells(sources, texts):
                    seen = known[lang]
                    new = [t for t in terms if t not in seen]
                    seen.update(zip(new, shards.lookup(lang, new)))
                    # Terms that are not kept have the ordinal -1.
                    at = np.fromiter(map(seen.__getitem__, terms), np.int64, len(terms))[term]
                    kept = at >= 0
                    if kept.any():
                        group = np.array([groups.setdefault((lang, name), len(groups)) for name in names], np.int64)
                        cells.append(((group[source] << _ORDINAL | at)[kept], n[kept]))
                    if sum(map(len, known.values())) > ENTRIES:
                        known.clear()
                    if sum(len(n) for _, n in cells) > CELLS or len(groups) > ENTRIES:
                        cells[:] = [summed()]
                        if len(cells[0][0]) > CELLS // 2 or len(groups) > ENTRIES:
                            yield emptied()
        if cells:
            yield emptied()

    return run


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], dict[bytes, int]] = {}
    for batch in batches:
        for lang, sources, texts in _texts(batch, "source"):
            for names, terms, source, term, n in _cells(sources, texts):
                for i, at, more in zip(source.tolist(), term.tolist(), n.tolist()):
                    own = counts.setdefault((lang, names[i]), {})
                    own[terms[at]] = own.get(terms[at], 0) + more
                if sum(map(len, counts.values())) > ENTRIES:
                    yield _counted(counts, pa.binary())
    yield _counted(counts, pa.binary())


def _routed(shard: int):
    """Rows of a shard: its transducer first, then the terms that may be in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from orelake.llm.term_transducer import Transducer

        found, number = None, 0
        for batch in batches:
            rows = []
            names = ("lang", "source", "shard", "term", "n", "packed")
            for lang, source, own, term, n, packed in zip(*[batch.column(c).to_pylist() for c in names]):
                if packed is not None:
                    found, number = Transducer.unpack(packed), own
                    continue
                ordinal = found.lookup(term)
                if ordinal >= 0:
                    rows.append((lang, source, number * shard + ordinal, n))
            columns = zip(*rows) if rows else ((), (), (), ())
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "source", "at", "n"])

    return run


def recount(texts: DataFrame, machines: DataFrame, shard: int = SHARD, held: int = HELD) -> DataFrame:
    """(lang, source, at, n): occurrences of every kept term in every group that has any."""
    size = machines.agg(F.coalesce(F.sum(F.octet_length("packed")), F.lit(0)).alias("bytes")).first()["bytes"]
    if size <= held:
        packed = [(r.lang, r.shard, bytes(r.first), bytes(r.packed)) for r in machines.collect()]
        shared = texts.sparkSession.sparkContext.broadcast(packed)
        counts = texts.mapInArrow(_streamed(shared, shard), _COUNTED)
    else:
        counts = _route(texts, machines).mapInArrow(_routed(shard), _COUNTED)
    return counts.groupBy("lang", "source", "at").agg(F.sum("n").alias("n"))


def _route(texts: DataFrame, machines: DataFrame) -> DataFrame:
    """Terms and transducers by shard: a term is in the last shard of its language that begins at or before it."""
    terms = texts.mapInArrow(_term_counts, "lang string, source string, at binary, n bigint")
    terms = terms.groupBy("lang", "source", F.col("at").alias("term")).agg(F.sum("n").alias("n"))
    # Shards' first terms and the terms in one order by range; each range begins with the last shard before it.
    none = lambda kind: F.lit(None).cast(kind)
    firsts = machines.select("lang", none("string").alias("source"), F.col("first").alias("term"), none("bigint").alias("n"), "shard")
    both = firsts.union(terms.withColumn("shard", none("bigint")))
    order = ["lang", "term", F.col("shard").isNull()]
    both = both.repartitionByRange("lang", "term", "source").sortWithinPartitions(*order)
    both = write_out(both.withColumn("_place", F.monotonically_increasing_id()), "routes")
    share = F.shiftright("_place", 33)
    lasts = both.filter("shard is not null").groupBy("lang", share.alias("_share")).agg(F.max("shard").alias("_last"))
    shares = both.groupBy("lang", share.alias("_share")).agg(F.lit(1).alias("_one")).join(lasts, ["lang", "_share"], "left")
    earlier = Window.partitionBy("lang").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    shares = write_out(shares.select("lang", "_share", F.max("_last").over(earlier).alias("_before")), "shares")
    within = Window.partitionBy("lang", "_share").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    placed_ = both.withColumn("_share", share).join(shares, ["lang", "_share"])
    placed_ = placed_.withColumn("_shard", F.coalesce(F.max("shard").over(within), "_before")).filter("shard is null and _shard is not null")
    rows = placed_.select(
        "lang", "source", F.col("_shard").alias("shard"), "term", "n", none("binary").alias("packed"),
        F.pmod(F.xxhash64("term"), F.lit(SALTS)).alias("salt"),
    )
    own = machines.select(
        "lang", none("string").alias("source"), "shard", none("binary").alias("term"), none("bigint").alias("n"), "packed",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"),
    )
    dealt = rows.union(own).repartition("lang", "shard", "salt")
    return dealt.sortWithinPartitions("lang", "shard", "salt", F.col("packed").isNull()).drop("salt")


def share_of(n: str, total: str, v: str) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 v)) in whole numbers; 1 where there are no terms."""
    parts = f"cast({SCALE} as decimal(10, 0)) * cast({n} + 2 as decimal(20, 0))"
    wide = f"{parts} div nullif(cast({total} + 2 * {v} as decimal(20, 0)), 0)"
    # 64 bits hold the product for less than nine thousand million occurrences.
    plain = f"({SCALE}L * ({n} + 2)) div nullif({total} + 2 * {v}, 0)"
    return F.expr(f"1 + coalesce(if({n} < 9000000000L, {plain}, {wide}), 0)")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def _tile_sums(size: int):
    """Rows by (lang, block, i, j): sums of the divergences of every pair of sources of the two tiles over a block's ordinals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def sums(key: tuple, sides: dict) -> pa.RecordBatch:
            lang, _, i, j = key
            found: list[tuple] = []
            if i in sides and j in sides:
                left, right = sides[i], sides[j]
                present = np.array(sorted(right[0]), np.int64)
                for a in sorted(left[0]):
                    other = present[present > a] if i == j else present
                    p, q = left[1][a][None, :], right[1][other]
                    total = ((p - q) ** 2 // (p + q)).sum(axis=1)
                    one, names = left[0][a], [right[0][b] for b in other.tolist()]
                    found.append(((lang, 2 * len(names)), [one] * len(names) + names, names + [one] * len(names), np.concatenate([total, total])))
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
            return _table(found, kinds, ["lang", "source", "item", "value"])

        key, sides = None, {}
        for batch in batches:
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            langs, blocks, i, j, width, tile, local, place, p = map(
                column, ("lang", "block", "i", "j", "width", "tile", "local", "place", "p")
            )
            new = (blocks[1:] != blocks[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (langs[1:] != langs[:-1])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            for first, last in zip(cuts[:-1], cuts[1:]):
                if first == last:
                    continue
                own = (langs[first], blocks[first], i[first], j[first])
                if own != key:
                    if sides:
                        yield sums(key, sides)
                    key, sides = own, {}
                part = slice(first, last)
                # Rows without a place come first: the share of a term that the source does not have.
                bare = first + np.flatnonzero(place[part] < 0)
                for row, name in zip(bare.tolist(), batch.column("source").take(pa.array(bare)).to_pylist()):
                    if tile[row] not in sides:
                        sides[tile[row]] = ({}, np.zeros((size, width[row]), np.int64))
                    sides[tile[row]][0][int(local[row])] = name
                    sides[tile[row]][1][local[row]] = p[row]
                for t in {own[2], own[3]}:
                    cells = first + np.flatnonzero((tile[part] == t) & (place[part] >= 0))
                    if len(cells):
                        sides[t][1][local[cells], place[cells]] = p[cells]
        if sides:
            yield sums(key, sides)

    return run


def pairs(counts: DataFrame, groups: DataFrame, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language."""
    per_lang = Window.partitionBy("lang")
    tiles = F.ceil(F.count(F.lit(1)).over(per_lang) / tile).cast("int")
    last = F.greatest(F.ceil(F.col("v") / block).cast("long"), F.lit(1)) - 1
    number = F.row_number().over(per_lang.orderBy("source")) - 1
    own = groups.select("lang", "source", "total", "v", tiles.alias("tiles"), last.alias("last"), number.alias("number"))
    own = own.withColumns({"tile": F.floor(F.col("number") / tile).cast("int"), "local": F.pmod("number", F.lit(tile))})
    own = write_out(own.drop("number"), "sources")
    named = ("lang", "tile", "local", "tiles", "v")
    absent = own.select(
        *named, F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("block"), F.lit(-1).alias("place"),
        share_of("0", "total", "v").alias("p"), "source",
    )
    present = counts.join(own, ["lang", "source"]).select(
        *named, F.floor(F.col("at") / block).cast("long").alias("block"), F.pmod("at", F.lit(block)).cast("int").alias("place"),
        share_of("n", "total", "v").alias("p"), F.lit(None).cast("string").alias("source"),
    )
    # A row meets every tile once: as the upper or the lower of the two.
    rows = absent.union(present).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    width = F.least(F.lit(block), F.col("v") - F.col("block") * block).cast("int")
    rows = rows.select(
        "lang", "block", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), width.alias("width"),
        "tile", "local", "place", "p", "source",
    )
    dealt = rows.repartition("lang", "block", "i", "j").sortWithinPartitions("lang", "block", "i", "j", "place")
    sums = dealt.mapInArrow(_tile_sums(tile), "lang string, source string, item string, value bigint")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, shard: int = SHARD, held: int = HELD, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): every other source by divergence, and the terms that stand out most."""
    texts = _read(docs)
    kept = write_out(vocabulary(texts), "vocabulary")
    machines = write_out(transducers(kept, shard), "transducers")
    counts = write_out(recount(texts, machines, shard, held), "recount")
    sizes = kept.groupBy("lang").agg(F.max("n").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = write_out(groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "v")]), "groups")

    ranked = lambda rows, *order: rows.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), *order))
    )
    pair = ranked(pairs(counts, groups, tile, block), "item").withColumn("part", F.lit("pair"))

    whole = counts.groupBy("lang", "at").agg(F.sum("n").alias("all_n"))
    per_lang = groups.groupBy("lang").agg(F.sum("total").alias("all_total"))
    terms = counts.join(whole, ["lang", "at"]).join(groups, ["lang", "source"]).join(per_lang, "lang")
    terms = terms.select("lang", "source", "at", share_of("n", "total", "v").alias("p"), share_of("all_n", "all_total", "v").alias("q"))
    terms = terms.filter("p > q").select("lang", "source", "at", divergence("p", "q").alias("value"))
    # Ordinals stand for the terms until the few that are shown are known.
    top = ranked(terms, "at").filter(F.col("rank") <= TOP)
    term = top.join(kept.select("lang", "at", "term"), ["lang", "at"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank"
    )
    return pair.select(term.columns).union(term)
