"""Modified Kneser-Ney model over words, counted and asked in rounds.

Words are runs of letters, digits and marks in lower case; every other visible
character, and every letter of a script written without spaces, is a word of its
own.  A word is known by a 64-bit number, so a gram is three numbers whatever its
alphabet.  The model is of order 3 with the bound of a text as a word.

Grams are dealt into shards by their middle word, so that a shard has all that
estimates them: the grams themselves, their contexts and their endings, save how
many words come before an ending's last one.  That is summed over the shards
(``train``) and comes back to them in a join.  A middle word too frequent for a
shard is spread over several by the first word; its endings are counted over all
of them and come back in the same join.  A pair of first and middle word that is too
frequent as well, such as the bounds before every text, is spread by the last word
too, and its figures as a context are summed over all shards.

Shards are worked through in rounds, each of which reads the texts again and
shuffles its share of the grams only: what is on disk at a time is a part of the
input, and no count table is kept.  Two models are fitted at once, of the trusted
rows and of those marked ``SEEN``.  Logarithms of the estimates add up to a
document's, so a shard answers one sum per document.

Nothing of the models reaches the driver save three discounts an order, the size
and mass of the first order, figures of at most ``COMMON`` words, and figures of the
words and pairs that are spread (at most ``FINER`` of either to a shard, most often far fewer).  A task holds one shard:
about ``SHARD`` words, more only where one gram is more frequent or a spread word has
more endings.  Texts are read in small pieces, and the grams that a task has put
together leave it packed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cache, cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelake.storage import release, write_out

# The least number of words that share the first order's remainder.
LEAST_WORDS = 32
# Words a shard is to hold, and rounds in which shards are counted and asked.
SHARD = 3 << 18
COUNT_ROUNDS = 3
ROUNDS = 5
# A word or pair of more than this part of a shard is spread, in such parts.
FINER = 2
# At most so many words that follow the most others go to all tasks; those of the rest to the shards that have them.
COMMON = 1 << 16
# Bits of a row's mark: counted by the first model, by the second, asked of the second.
TRUSTED, SEEN, ASKED = 1, 2, 4
_BLANK = r"[\s\x{A0}\x{1680}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_SINGLE = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]|[^\p{L}\p{N}\p{M}\s]"
# Bytes of text handled at a time and sent to Python at a time, and grams put together before they are dealt.
_PIECE = 1 << 17
_SENT = 1 << 22
_DEALT = 1 << 20
# Words and pairs of a lower share than one in so many are not looked at for being too frequent.
_RARE = 1 << 14
_PARTS = ("a", "b", "c", "doc", "rid", "mark")


def words(docs: DataFrame, *carried: str) -> DataFrame:
    """``carried`` and the whole ``text`` in lower case, whose words are told apart where they are counted."""
    return docs.select(*carried, F.lower(F.coalesce("text", F.lit(""))).alias("plain"))


@cache
def _points() -> bytes:
    """Whether a character belongs to a word (0), is blank (1) or a word of its own (2), for all of Unicode, packed."""
    import zlib

    spark = SparkSession.getActiveSession()
    blocks = [(i, "".join(chr(x) if not 0xD800 <= x < 0xE000 else "a" for x in range(i << 12, (i + 1) << 12))) for i in range(0x110)]
    kind = F.regexp_replace(F.regexp_replace(F.regexp_replace("s", _BLANK, " "), _SINGLE, "."), r"[^ .]", "a")
    rows = spark.createDataFrame(blocks, "i int, s string").select("i", kind.alias("s")).collect()
    return zlib.compress("".join(r["s"] for r in sorted(rows)).translate({97: 0, 32: 1, 46: 2}).encode())


@cache
def _tables(points: bytes):
    """(kind by code point, kind by byte, number by place in the word and byte)."""
    import zlib

    import numpy as np

    kinds = np.frombuffer(zlib.decompress(points), np.uint8)
    first = np.zeros(256, np.uint8)
    first[:128] = kinds[:128]
    slots = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 64, (64, 256), np.uint64)
    # Blanks add nothing to the word before them.
    slots[:, :128][:, kinds[:128] == 1] = 0
    return kinds, first, slots.reshape(-1)


def _numbers(data, bounds, tables):
    """The numbers of the words of texts that lie one after the other, and how many words each has."""
    import numpy as np

    kinds, first, slots = tables
    kind = first[data]
    high = np.flatnonzero(data >= 0x80)
    blank = None
    if len(high):
        lead = high[data[high] >= 0xC0]
        b = data[lead].astype(np.int32)
        size = 2 + (b >= 0xE0) + (b >= 0xF0)
        point = b & (0xFF >> (size + 1))
        for k in range(1, 4):
            more = size > k
            point[more] = point[more] << 6 | (data[np.minimum(lead[more] + k, len(data) - 1)] & 0x3F)
        of = kinds[np.minimum(point, 0x10FFFF)]
        kind[lead] = of
        for k in range(1, 4):
            more = size > k
            # 3: the rest of a word of one character.
            kind[np.minimum(lead[more] + k, len(data) - 1)] = np.where(of[more] == 2, 3, of[more])
        blank = high[kind[high] == 1]
    letter = kind == 0
    begin = letter.copy()
    begin[1:] &= ~letter[:-1]
    at = bounds[:-1][bounds[:-1] < len(data)]
    begin[at] |= letter[at]
    begin |= kind == 2
    starts = np.flatnonzero(begin)
    counts = np.diff(np.searchsorted(starts, bounds))
    if not len(starts):
        return np.zeros(0, np.int64), counts
    place = np.arange(starts[0], len(data), dtype=np.int64)
    place -= np.repeat(starts, np.diff(np.append(starts, len(data))))
    part = slots[((place & 63) << 8) | data[starts[0] :]]
    if blank is not None and len(blank):
        part[blank[blank >= starts[0]] - starts[0]] = 0
    far = np.flatnonzero(place >= 64)
    if len(far):
        part[far] *= np.power(np.uint64(0x9E3779B97F4A7C15), (place[far] >> 6).astype(np.uint64))
    return np.add.reduceat(part, starts - starts[0]).view(np.int64), counts


def _pieces(batch: pa.RecordBatch, tables):
    """(rows with words, numbers of their words, how many each has) of pieces of the batch; a text is never parted."""
    import numpy as np

    column = batch.column(batch.schema.names.index("plain")).cast(pa.large_string())
    if not len(column):
        return
    _, offsets, held = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        stop = min(max(start + 1, int(np.searchsorted(ends, ends[start] + _PIECE, "right")) - 1), len(column))
        low, high = int(ends[start]), int(ends[stop])
        if high - low <= _PIECE:
            found, counts = _numbers(data[low:high], ends[start : stop + 1] - low, tables)
        else:
            # One long text, cut at spaces.
            parts = []
            while low < high:
                cut = low + _PIECE
                spaces = np.flatnonzero(data[cut:high] == 0x20)[:1]
                cut = cut + int(spaces[0]) if len(spaces) else high
                parts.append(_numbers(data[low:cut], np.array([0, cut - low]), tables)[0])
                low = cut
            found = np.concatenate(parts)
            counts = np.array([len(found)])
        some = np.flatnonzero(counts)
        if len(some):
            yield some + start, found, counts[some]
        start = stop


def _grams(batch: pa.RecordBatch, tables):
    """(rows, owner within them, a, b, c) of all predicted words c: every word and the closing bound, 0."""
    import numpy as np

    for rows, found, size in _pieces(batch, tables):
        # Two bounds before and one after each text.
        owner = np.repeat(np.arange(len(rows)), size + 1)
        seq = np.zeros(len(found) + 3 * len(rows), np.int64)
        seq[np.arange(len(found)) + 3 * np.repeat(np.arange(len(rows)), size) + 2] = found
        at = np.arange(len(owner)) + 2 * owner + 2
        yield rows, owner, seq[at - 2], seq[at - 1], seq[at]


def _mixed(*parts):
    """One 64-bit number of equal-length columns of numbers."""
    import numpy as np

    u = np.uint64
    x = np.zeros(len(parts[0]), u)
    for p in parts:
        x = (x ^ p.astype(np.int64, copy=False).view(u)) * u(0x9E3779B97F4A7C15)
        x ^= x >> u(29)
        x *= u(0xBF58476D1CE4E5B9)
        x ^= x >> u(32)
    return x.view(np.int64)


def _told(*columns):
    """One place of each distinct row, and which of them every row is; rows are told apart by a 64-bit number."""
    import numpy as np

    key = _mixed(*columns)
    rank = np.argsort(key)
    new = np.ones(len(rank), bool)
    new[1:] = key[rank[1:]] != key[rank[:-1]]
    of = np.empty(len(rank), np.int64)
    of[rank] = np.cumsum(new) - 1
    return rank[new], of


def _at(keys, table):
    """The places of ``keys`` in the sorted ``table``, behind its end where they are not in it."""
    import numpy as np

    if not len(table):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, len(table))


def _scaled(numbers, n):
    """Evenly spread numbers of 64 bits brought below ``n``."""
    import numpy as np

    u = np.uint64
    return (numbers.astype(np.int64, copy=False).view(u) >> u(32)) * u(n) >> u(32)


def _often(numbers, n):
    """Where those of evenly spread numbers are that can make up one part in ``_RARE`` of ``n``; few others are among them."""
    import numpy as np

    low = numbers & 0xFFFF
    return np.flatnonzero((np.bincount(low, minlength=1 << 16) * _RARE >= n)[low])


def triples(tokens: DataFrame) -> DataFrame:
    """(a, b, c, n): how often each gram of three words occurs."""
    points = _points()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for _, _, *gram in _grams(batch, _tables(points)):
                at, of = _told(*gram)
                yield pa.RecordBatch.from_arrays([pa.array(w[at]) for w in gram] + [pa.array(np.bincount(of))], ["a", "b", "c", "n"])

    some = tokens.select("plain").mapInArrow(run, "a bigint, b bigint, c bigint, n bigint")
    return some.groupBy("a", "b", "c").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Layout:
    """How many shards there are, and over how many each of the most frequent words and pairs is spread.

    Pairs are known by their number (``_mixed``), with the middle word beside their share.
    """

    shards: int
    spread: dict[int, int]
    pairs: dict[int, tuple[int, int]]

    @cached_property
    def _wide(self):
        """(words, shares, whether a pair of theirs is spread, place by low bits, places that share theirs with others)."""
        import numpy as np

        key = np.array(sorted(self.spread), np.int64)
        place = np.full(1 << 16, -1, np.int32)
        place[key & 0xFFFF] = np.arange(len(key))
        return key, np.array([self.spread[int(x)] for x in key], np.uint64), np.array([int(x) in self._most for x in key], bool), place, np.flatnonzero(place[key & 0xFFFF] != np.arange(len(key)))

    @cached_property
    def _pairs(self):
        import numpy as np

        key = np.array(sorted(self.pairs), np.int64)
        return key, np.array([self.pairs[int(x)][1] for x in key] + [1], np.uint64)

    def shard(self, a, b, c):
        import numpy as np

        u = np.uint64
        own = _scaled(b, self.shards)
        if self.spread:
            key, over, paired, place, others = self._wide
            of = place[b & 0xFFFF]
            wide = np.flatnonzero(of >= 0)
            of = of[wide]
            known = key[of] == b[wide]
            wide, of = wide[known], of[known]
            for i in others:
                more = np.flatnonzero(b == key[i])
                wide, of = np.append(wide, more), np.append(of, np.full(len(more), i, of.dtype))
            own[wide] += _scaled(a[wide], 1 << 32) * over[of] >> u(32)
            some = wide[paired[of]]
            if len(some):
                keys, times = self._pairs
                own[some] += _scaled(c[some], 1 << 32) * times[_at(_mixed(a[some], b[some]), keys)] >> u(32)
            own[wide] %= u(self.shards)
        return own.astype(np.int32)

    @cached_property
    def _most(self):
        most = {}
        for b, n in self.pairs.values():
            most[b] = max(most.get(b, 1), n)
        return most

    def places(self, word: int) -> list[int]:
        """The shards of a word that is spread."""
        import numpy as np

        own = int(_scaled(np.array([word]), self.shards)[0])
        over = self.spread[word] + self._most.get(word, 1) - 1
        return sorted({(own + i) % self.shards for i in range(over)})


@dataclass(frozen=True)
class Model:
    """What the shards need beside the grams: tables of words and of endings of spread words, and fixed figures.

    ``discounts``, ``first`` (mass and what an unseen word is worth) and the figures of
    ``spread`` words and of ``contexts``, the pairs that are spread, are of the two models in their order.
    """

    trusted: DataFrame
    layout: Layout
    rounds: int
    discounts: list[dict[int, tuple[float, float, float]]]
    first: list[tuple[float, float]]
    spread: dict[int, list[tuple[float, float, int]]]
    contexts: dict[int, tuple[int, list[tuple[float, float]]]]
    common: tuple
    needed: DataFrame
    endings: DataFrame

    @property
    def grams(self) -> dict[int, DataFrame]:
        """The count table of the highest order, computed when it is asked for."""
        return {3: triples(self.trusted)}


@contextmanager
def _set(spark: SparkSession, **settings: str) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _sparing(spark: SparkSession):
    """What is shuffled inside leaves the disk at the end of its query; nothing is read again.  Texts go to Python in small batches."""
    return _set(
        spark,
        **{"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(_SENT)},
    )


def _written(df: DataFrame, label: str) -> DataFrame:
    with _sparing(df.sparkSession):
        return write_out(df, label)


def _frequent(tokens: DataFrame) -> tuple[int, dict[int, int], dict[int, tuple[int, int]]]:
    """How many grams there are, and about how many have the middle words and the pairs that are too frequent for a shard."""
    points = _points()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held, n = [], 0

        def out():
            a, b = (np.concatenate(x) for x in zip(*held))
            # What is below this share everywhere is below it in all.
            some = _often(b, len(b))
            word, times = np.unique(b[some], return_counts=True)
            often = times * _RARE >= len(b)
            word, times = word[often], times[often]
            key = _mixed(a[some], b[some])
            many = _often(key, len(b))
            pair, at, paired = np.unique(key[many], return_index=True, return_counts=True)
            often = paired * _RARE >= len(b)
            some = some[many]
            words = pa.array([None] + word.tolist() + b[some[at[often]]].tolist(), pa.int64())
            pairs = pa.array([None] * (len(word) + 1) + pair[often].tolist(), pa.int64())
            return pa.RecordBatch.from_arrays([words, pairs, pa.array(np.concatenate(([len(b)], times, paired[often])))], ["word", "pair", "n"])

        for batch in batches:
            for _, _, a, b, _ in _grams(batch, _tables(points)):
                held.append((a, b))
                n += len(b)
                if n >= _DEALT:
                    yield out()
                    held, n = [], 0
        if n:
            yield out()

    found = tokens.select("plain").mapInArrow(run, "word bigint, pair bigint, n bigint").groupBy("word", "pair").agg(F.sum("n").alias("n"))
    with _sparing(tokens.sparkSession):
        rows = found.filter(F.col("word").isNull() | (F.col("n") * FINER > SHARD)).collect()
    words = {r["word"]: r["n"] for r in rows if r["word"] is not None and r["pair"] is None}
    pairs = {r["pair"]: (r["word"], r["n"]) for r in rows if r["pair"] is not None and r["word"] in words}
    return sum(r["n"] for r in rows if r["word"] is None), words, pairs


def _dealt(tokens: DataFrame, layout: Layout, rounds: int, turn: int) -> DataFrame:
    """The grams of the shards of one round: (shard, packed words, documents and their marks)."""
    points = _points()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        u, held, n, docs = np.uint64, [], 0, 0
        packer = pa.Codec("zstd", 1)

        def out():
            shard, a, b, c, doc = (np.concatenate([x[i] for x in held]) for i in range(5))
            rids, marks = (np.concatenate([x[i] for x in held]) for i in (5, 6))
            held.clear()
            # Shard, middle word and place in one number; grams of one middle word lie together, which packs well.
            names = np.unique(shard)
            by, bits = np.searchsorted(names, shard).astype(np.uint64), len(shard).bit_length()
            own = len(names).bit_length()
            order = by << u(64 - own) | b.view(u) >> u(own + bits) << u(bits) | np.arange(len(b), dtype=u)
            order.sort()
            order = (order & u((1 << bits) - 1)).astype(np.int64)
            rows, size = [], 0
            for part in np.split(order, np.cumsum(np.bincount(by.astype(np.int64)))[:-1]):
                some = np.zeros(len(rids), bool)
                some[doc[part]] = True
                at = np.flatnonzero(some)
                number = np.cumsum(some)[doc[part]] - 1
                columns = (a[part], b[part], c[part], number.astype(_width(len(at))), rids[at], marks[at])
                rows.append((int(shard[part[0]]), len(part), len(at), *(packer.compress(x.tobytes(), asbytes=True) for x in columns)))
                size += sum(map(len, rows[-1][3:]))
                if size > _SENT:
                    yield packed(rows)
                    rows, size = [], 0
            if rows:
                yield packed(rows)

        def packed(rows):
            kinds = [pa.int32()] * 3 + [pa.binary()] * len(_PARTS)
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], ["shard", "n", "docs", *_PARTS])

        for batch in batches:
            rids, marks = batch.column("rid").to_numpy(), batch.column("mark").to_numpy().astype(np.uint8)
            for rows, owner, a, b, c in _grams(batch, _tables(points)):
                shard = layout.shard(a, b, c)
                mine = np.flatnonzero(shard % rounds == turn)
                held.append((shard[mine], a[mine], b[mine], c[mine], (owner[mine] + docs).astype(np.uint32), rids[rows], marks[rows]))
                n, docs = n + len(mine), docs + len(rows)
                if n >= _DEALT:
                    yield from out()
                    n, docs = 0, 0
        if n:
            yield from out()

    return tokens.select("rid", "mark", "plain").mapInArrow(run, "shard int, n int, docs int, " + ", ".join(f"{x} binary" for x in _PARTS))


def _width(n: int):
    """The kind of numbers below ``n``."""
    import numpy as np

    return np.uint8 if n <= 1 << 8 else np.uint16 if n <= 1 << 16 else np.uint32


def _opened(table: pa.Table):
    """(a, b, c, document, ids of documents, their marks) of a shard."""
    import numpy as np

    packer = pa.Codec("zstd")
    found, first = {x: [] for x in _PARTS}, 0
    for n, docs, *row in zip(*(table.column(x) for x in ("n", "docs", *_PARTS))):
        n, docs = n.as_py(), docs.as_py()
        kinds = dict(zip(_PARTS, ((n, np.int64), (n, np.int64), (n, np.int64), (n, _width(docs)), (docs, np.int64), (docs, np.uint8))))
        for x, packed in zip(_PARTS, row):
            size, kind = kinds[x]
            found[x].append(np.frombuffer(packer.decompress(packed.as_buffer(), size * np.dtype(kind).itemsize), kind))
        found["doc"][-1] = found["doc"][-1].astype(np.uint32) + np.uint32(first)
        first += docs
    return tuple(np.concatenate(found.pop(x)) for x in _PARTS)


def _counted(table: pa.Table, spread, contexts) -> pa.Table:
    """What a shard hands on to the models: counts of counts, words before each word, endings of spread words, counts of spread pairs."""
    import numpy as np

    a, b, c, doc, _, mark = _opened(table)
    at, of = _told(a, b, c)
    n = np.bincount(of)
    seen = np.bincount(of, weights=(mark[doc] & SEEN) != 0).astype(np.int64)
    a, b, c = a[at], b[at], c[at]
    # Of contexts that are spread: how often they occur, and how many of their grams do so once, twice and more often.
    key = _mixed(a, b)
    wide = np.flatnonzero(np.isin(key, contexts))
    some, of = np.unique(key[wide], return_inverse=True)
    parts = []
    for x in (n[wide], seen[wide]):
        weights = (x, *(np.minimum(x, 3) == i for i in (1, 2, 3)))
        parts.append(np.concatenate([np.bincount(of, weights=w, minlength=len(some)).astype(np.int64) for w in weights]))
    rows = [(np.full(4 * len(some), 4), np.tile(some, 4), np.repeat(np.arange(4), len(some)), *parts)]
    pair, of = _told(b, c)
    n2, seen2 = np.bincount(of), np.bincount(of, weights=seen > 0).astype(np.int64)
    b, c = b[pair], c[pair]
    wide = np.isin(b, spread)
    rows += [(np.full(4, order), np.arange(1, 5), np.zeros(4, np.int64), *(np.array([(x == i).sum() for i in range(1, 5)]) for x in both))
             for order, both in ((3, (n, seen)), (2, (n2[~wide], seen2[~wide])))]
    rows.append((np.zeros(int(wide.sum()), np.int64), b[wide], c[wide], n2[wide], seen2[wide]))
    # The words of the shard, with the numbers of words before them here; middle words of their own as well.
    last = np.append(c[~wide], np.unique(b[~wide]))
    one = np.arange(len(last)) < int((~wide).sum())
    at, of = _told(last) if len(last) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    seen2 = np.append(seen2[~wide] > 0, np.zeros(len(last) - int(one.sum()), bool))
    shard = np.full(len(at), table.column("shard")[0].as_py())
    rows.append((np.ones(len(at), np.int64), shard, last[at], *(np.bincount(of, weights=x, minlength=len(at)).astype(np.int64) for x in (one, seen2))))
    return pa.table([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*rows)], ["kind", "x", "c", "n", "seen"])


def _taken(n: str, d: tuple[float, float, float]):
    return F.when(F.col(n) == 0, 0.0).when(F.col(n) == 1, d[0]).when(F.col(n) == 2, d[1]).otherwise(d[2])


def train(tokens: DataFrame, discounts: Callable[[dict[int, int]], tuple[float, float, float]], trusted: DataFrame | None = None) -> Model:
    """The two models of ``trusted`` (all of ``tokens``, where none is given), laid out for asking about ``tokens``.

    ``discounts`` gives the three discounts of an order from its counts of counts.
    """
    spark = tokens.sparkSession
    trusted = tokens if trusted is None else trusted
    if "rid" not in trusted.columns:
        trusted = trusted.select(F.lit(0).cast("long").alias("rid"), F.lit(TRUSTED | SEEN).alias("mark"), "plain")
    total, often, pairs = _frequent(tokens)
    rounds = ROUNDS if total > SHARD else 1
    parts_of = lambda n, least=0: max(1, -(-n // max(SHARD // FINER, least)))
    # Small shards are put together no further than twelve a round.
    shards = rounds * max(-(-total // (SHARD * rounds)), min(12, -(-16 * total // (SHARD * rounds))), 1)
    layout = Layout(shards, {w: parts_of(n) for w, n in often.items()}, {k: (w, parts_of(n)) for k, (w, n) in pairs.items()})
    spread, contexts = sorted(often), sorted(pairs)
    turns = min(COUNT_ROUNDS, rounds)
    schema = "kind bigint, x bigint, c bigint, n bigint, seen bigint"
    made = [
        _written(_dealt(trusted, layout, turns, i).groupBy("shard").applyInArrow(lambda table: _counted(table, spread, contexts), schema), "word-counts")
        for i in range(turns)
    ]
    counts = made[0]
    for x in made[1:]:
        counts = counts.unionByName(x)
    hot = counts.filter("kind = 0").groupBy(F.col("x").alias("b"), "c").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    hot = _written(hot, "word-spread")
    one = lambda n: F.when(F.col(n) > 0, 1).otherwise(0).cast("long").alias(n)
    before = counts.filter("kind = 1").select("c", "n", "seen").unionByName(hot.select("c", one("n"), one("seen")))
    before = _written(before.groupBy("c").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")), "word-before")

    parts = counts.filter("kind in (2, 3)").groupBy("kind", "x").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")).collect()
    few, first, figures, over, ends_of = [], [], {}, {}, {}
    for n in ("n", "seen"):
        of = {k: {r["x"]: r[n] for r in parts if r["kind"] == k} for k in (3, 2)}
        for k, table in ((2, hot), (1, before)):
            some = of.setdefault(k, {})
            for r in table.filter(f"{n} between 1 and 4").groupBy(n).count().collect():
                some[r[0]] = some.get(r[0], 0) + r[1]
        few.append({k: discounts(x) for k, x in of.items()})
        row = before.agg(F.count_if(F.col(n) > 0), F.sum(n), F.sum(_taken(n, few[-1][1]))).first()
        first.append((float(row[1] or 1), row[2] / row[1] / max(LEAST_WORDS, row[0] + 1) if row[1] else 1.0 / LEAST_WORDS))
    if spread:
        sums = [f(x) for n, d in (("n", few[0]), ("seen", few[1])) for f, x in ((F.sum, F.col(n)), (F.sum, _taken(n, d[2])))]
        sizes = {r[0]: r[1:] for r in hot.groupBy("b").agg(*sums, F.count(F.lit(1))).collect()}
        words_before = {r["c"]: (r["n"], r["seen"]) for r in before.filter(F.col("c").isin(spread)).collect()}
        for w in spread:
            mass, taken, mass_seen, taken_seen, ends = sizes.get(w, (0, 0.0, 0, 0.0, 0))
            b, s = words_before.get(w, (0, 0))
            figures[w] = [(float(mass), float(taken), b), (float(mass_seen), float(taken_seen), s)]
            # Each of its shards is given all endings, so it is to have twice as many grams.
            ends_of[w], over[w] = 2 * ends, parts_of(often[w], 2 * ends)
    sums = {}
    for r in counts.filter("kind = 4").groupBy("x", "c").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")).collect():
        sums.setdefault(r["x"], {})[r["c"]] = (r["n"], r["seen"])
    # A pair's mass, and what the discounts take of it.
    part = lambda k, m: [sums.get(k, {}).get(i, (0, 0))[m] for i in range(4)]
    held = {k: (pairs[k][0], [(float((x := part(k, m))[0]), sum(d * y for d, y in zip(few[m][3], x[1:]))) for m in (0, 1)]) for k in contexts}
    pairs = {k: (w, parts_of(n, ends_of[w])) for k, (w, n) in pairs.items()}
    both = before.withColumnsRenamed({"n": "n1", "seen": "seen1"})
    # Words that nearly every shard has are not told to each of them: those from the least power on that leaves ``COMMON``.
    power = F.floor(F.log2("n") * 8)
    least, size = None, 0
    for r in before.filter("n > 0").groupBy(power.alias("power")).count().orderBy(F.desc("power")).collect():
        size += r["count"]
        if size > COMMON:
            break
        least = r["power"]
    common = before.filter("n > 0").filter(F.lit(False) if least is None else power >= least)
    rows = sorted((r["c"], r["n"], r["seen"]) for r in common.collect())
    rest = counts.filter("kind = 1").select(F.col("x").cast("int").alias("shard"), "c").join(F.broadcast(common.select("c")), "c", "left_anti")
    needed = _written(rest.join(both.filter("n1 > 0"), "c"), "word-needed")
    endings = _written(hot.join(both, "c"), "word-endings")
    release(*made, hot, before)
    return Model(trusted, Layout(shards, over, pairs), rounds, few, first, figures, held, tuple(zip(*rows)) or ((), (), ()), needed, endings)


def _asked(left: pa.Table, right: pa.Table, model, buckets: int) -> pa.Table:
    """A shard's share in every document's figures, as ``_REPLY``."""
    import numpy as np

    discounts, first, spread, held, common = model
    if not len(left):
        return pa.table([pa.array([], kind) for kind in _REPLY.values()], list(_REPLY))
    a, b, c, doc, rid, mark = _opened(left)
    at, of = _told(a, b, c)
    ub, uc = b[at], c[at]
    contexts, context = _told(a[at], ub)
    ca, cb = a[at[contexts]], ub[contexts]
    del a, b, c
    pairs, pair = _told(ub, uc)
    pb, pc = ub[pairs], uc[pairs]
    middles, middle = _told(pb)
    mb = pb[middles]
    # What the shard is told: of words, and of the endings of spread words.
    told = {x: right.column(x).to_numpy() for x in ("b", "c", "n", "seen", "n1", "seen1")}
    plain = np.flatnonzero(told["n"] < 0)
    words = np.append(told["c"][plain], common[0])
    rank = np.argsort(words)
    words = words[rank]
    before = {name: np.append(np.append(told[name][plain], x)[rank], 0) for name, x in (("n1", common[1]), ("seen1", common[2]))}
    ends = np.flatnonzero(told["n"] >= 0)
    ends_key = _mixed(told["b"][ends], told["c"][ends])
    ends, ends_key = ends[np.argsort(ends_key)], np.sort(ends_key)
    hot = np.array(sorted(spread), np.int64)
    wide_middle = np.isin(mb, hot)
    wide = wide_middle[middle]
    # Figures of what is not told are 0.
    of_last, of_middle, of_end = _at(pc, words), _at(mb, words), _at(_mixed(pb[wide], pc[wide]), ends_key)
    some = np.flatnonzero(np.isin(cb, np.array(sorted({w for w, _ in held.values()}), np.int64)))
    key = _mixed(ca[some], cb[some])
    far = [(some[i], int(key[i])) for i in np.flatnonzero(np.isin(key, np.array(sorted(held), np.int64)))]
    ending = {name: np.append(told[name][ends], 0)[of_end] for name in ("n", "seen", "n1", "seen1")}
    del ub, uc, ca, cb, pb, pc, told, right
    sums = []
    for m, (own, own_before, bit) in enumerate((("n", "n1", TRUSTED), ("seen", "seen1", SEEN))):
        d = {k: np.array([0.0, *x]) for k, x in discounts[m].items()}
        taken = lambda k, n: d[k][np.minimum(n, 3).astype(np.int64)]  # noqa: E731, B023
        mass1, unseen = first[m]
        n = np.bincount(of, weights=(mark[doc] & bit) != 0)
        mass3 = np.bincount(context, weights=n)
        taken3 = np.bincount(context, weights=taken(3, n))
        for i, key in far:
            mass3[i], taken3[i] = held[key][1][m]
        n2 = np.bincount(pair, weights=n > 0)
        n2[wide] = ending[own]
        mass2 = np.bincount(middle, weights=n2)
        taken2 = np.bincount(middle, weights=taken(2, n2))
        n1, own1 = before[own_before][of_last], before[own_before][of_middle]
        n1[wide] = ending[own_before]
        for i in np.flatnonzero(wide_middle):
            mass2[i], taken2[i], own1[i] = spread[int(mb[i])][m]
        p1 = lambda x: (x - taken(1, x)) / mass1 + unseen  # noqa: E731, B023
        share = lambda x, mass, none: np.divide(x, mass, out=np.full(len(x), none), where=mass > 0)
        back2, back3 = share(taken2, mass2, 1.0)[middle], share(taken3, mass3, 1.0)[context]
        p2 = share(n2 - taken(2, n2), mass2[middle], 0.0) + back2 * p1(n1)
        full = share(n - taken(3, n), mass3[context], 0.0) + back3 * p2[pair]
        # How likely c is by itself is only known of endings that were counted.  So every gram brings in that of its
        # middle word, of which there are as many as of last words, and counted endings leave out that of their last.
        known = n2 > 0
        value = np.where(known[pair], np.log(full) - np.log(p1(n1))[pair], np.log(back3) + np.log(back2)[pair])
        value += np.log(p1(own1))[middle[pair]]
        sums.append(np.bincount(doc, weights=value[of], minlength=len(rid)))
    docs, of = np.unique(rid, return_inverse=True)
    n = np.bincount(of, weights=np.bincount(doc, minlength=len(rid))).astype(np.int32)
    logp = np.bincount(of, weights=sums[0])
    seen = np.bincount(of, weights=np.where(mark & ASKED, sums[1], 0.0))
    to = _scaled(docs, buckets).astype(np.int32)
    order = np.argsort(to, kind="stable")
    packer = pa.Codec("zstd", 1)
    rows = []
    for part in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
        # Ids ascend: they are kept as steps, and all numbers byte by byte, so that what is alike lies together.
        columns = (np.diff(docs[part], prepend=np.int64(0)), n[part], logp[part], seen[part])
        columns = [np.ascontiguousarray(x.view(np.uint8).reshape(len(part), -1).T) for x in columns]
        rows.append((int(to[part[0]]), len(part), *(packer.compress(x.tobytes(), asbytes=True) for x in columns)))
    return pa.table([pa.array(x, kind) for x, kind in zip(zip(*rows), _REPLY.values())], list(_REPLY))


_ANSWER = ["rid", "n_symbols", "logp", "logp_seen"]
# A shard's figures go to the documents packed, by bucket of their ids.
_REPLY = {"bucket": pa.int32(), "n": pa.int32()} | {x: pa.binary() for x in _ANSWER}


def _summed(table: pa.Table) -> pa.Table:
    """The figures of the documents of one bucket, summed over shards."""
    import numpy as np

    packer = pa.Codec("zstd")
    parts = {}
    for name, kind in zip(_ANSWER, (np.int64, np.int32, np.float64, np.float64)):
        found = []
        for n, packed in zip(table.column("n").to_pylist(), table.column(name)):
            data = packer.decompress(packed.as_buffer(), n * np.dtype(kind).itemsize)
            found.append(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).reshape(-1))
        parts[name] = np.concatenate([np.cumsum(x) for x in found] if name == "rid" else found)
    docs, of = np.unique(parts["rid"], return_inverse=True)
    sums = [np.bincount(of, weights=parts[x]) for x in _ANSWER[1:]]
    return pa.table([pa.array(docs), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], _ANSWER)


def score(tokens: DataFrame, model: Model) -> DataFrame:
    """(rid, n_symbols, logp, logp_seen) of every text with words; the last of rows that are ``ASKED``, others get 0.

    Rows of one rid add up.  The rows the model was trained on are to be among ``tokens``.
    """
    import numpy as np

    spark = tokens.sparkSession
    layout, fixed = model.layout, (model.discounts, model.first, model.spread, model.contexts, tuple(np.array(x, np.int64) for x in model.common))
    places = spark.createDataFrame([(w, i) for w in layout.spread for i in layout.places(w)], "b bigint, shard int")
    none = F.lit(-1).cast("long")
    told = model.needed.select("shard", F.lit(0).cast("long").alias("b"), "c", none.alias("n"), none.alias("seen"), "n1", "seen1")
    if layout.spread:
        told = told.unionByName(model.endings.join(F.broadcast(places), "b").select("shard", "b", "c", "n", "seen", "n1", "seen1"))
    sums, buckets = [], layout.shards // model.rounds
    for turn in range(model.rounds):
        left = _dealt(tokens, layout, model.rounds, turn).groupBy("shard")
        right = told.filter(F.col("shard") % model.rounds == turn).groupBy("shard")
        part = left.cogroup(right).applyInArrow(lambda x, y: _asked(x, y, fixed, buckets), "bucket int, n int, " + ", ".join(f"{x} binary" for x in _ANSWER))
        total = part.groupBy("bucket").applyInArrow(_summed, "rid bigint, n_symbols bigint, logp double, logp_seen double")
        sums.append(_written(total, "word-sums"))
    release(model.needed, model.endings)
    out = sums[0]
    for x in sums[1:]:
        out = out.unionByName(x)
    return out
