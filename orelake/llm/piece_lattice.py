"""Sampled segmentations over a piece lattice, in numpy over a batch of texts.

The lattice of a text has a vertex between any two characters and an edge for
every piece of the vocabulary.  No piece reaches over the start of a word's
spaces or over a line break, so the lattice falls apart into segments (spaces
and a word, spaces, or one line break), which are built once per distinct
segment.

Forward filtering sums the weight of all paths into every vertex; backward
sampling then draws, from the end of each segment to its start, an edge in
proportion to the weight of the paths that end with it.  The draws of a text
come from its row key, the number of the segment and of the step, so they do
not depend on the batch, the partition or the executor.  Shares and draws are
multiples of 2**-30, which the tables hold exactly beside a place in them.

Lattices are kept in two generations of at most ``_EDGES`` edges together: when the
younger one is full, the older one goes.  A text is read in pieces of ``_CHUNK``
bytes or the segment that is longer.  Segments are cut and told apart in columns of
bytes; Python touches the distinct ones of a piece only.

A piece of rank r has the weight 1 / (r + 1) ** sharpness.  Characters without
a piece become their bytes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_A, _B = _U(0xD1B54A32D192ED03), _U(0x8CB92BA72F3D8DD7)
# Places where a segment begins: line breaks and the first of some spaces.
_BEGIN = re.compile(rb"\n|(?<! ) ")
# Edges that are kept in both generations together.
_EDGES = 2_000_000
# Bytes that are sampled at a time.
_CHUNK = 512 << 10
_GRID = float(1 << 30)
# The number of a segment that is not known.
_NONE = 1 << 62


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as text with plain spaces (None: not for texts), their ranks, and the piece of each byte."""

    pieces: tuple[str | None, ...]
    ranks: tuple[float, ...]
    bytes_: tuple[int, ...]

    @staticmethod
    def load(path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces, bytes_ = [], [-1] * 256
        for i in range(n):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                bytes_[int(name[3:5], 16)] = i
            usable = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            pieces.append(name.replace("▁", " ") if usable else None)
        if -1 in bytes_:
            raise ValueError(f"{path} has no piece for some bytes")
        return Vocabulary(tuple(pieces), tuple(-model.get_score(i) for i in range(n)), tuple(bytes_))


class _Level:
    """Hashes of the prefixes of one length, and the piece where one is whole: slots of few neighbours each."""

    def __init__(self, found: dict[int, int]):
        keys, pieces = np.array(list(found), _U), np.array(list(found.values()))
        bits = (8 * len(keys)).bit_length()
        self.shift = _U(64 - bits)
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        held = np.bincount(slot, minlength=1 << bits)
        self.most = int(held.max())
        self.first = (np.cumsum(held) - held).astype(np.int32)
        # The last keys again, so that a look-up may go beyond the end.
        order = np.append(order, np.repeat(order[-1:], self.most + 1))
        self.keys, self.pieces = keys[order], pieces[order]

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return ((h * _A) >> self.shift).astype(np.int64)

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are those of prefixes, and the pieces of these (-1: no whole one)."""
        place = self.first[self._slot(h)]
        prefix = self.keys[place] == h
        for _ in range(self.most - 1):
            place += ~prefix
            prefix = self.keys[place] == h
        return prefix, self.pieces[place[prefix]]


class _Generation:
    """Lattices of segments: per edge where its share ends (vertex + share), the vertex before and the piece; grown in place."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.bound, self.before, self.piece = np.empty(0), np.empty(0, np.int32), np.empty(0, np.int32)
        self.last, self.first = np.empty(0, np.int32), np.empty(0, np.int32)
        self.edges = self.vertices = self.segments = 0

    @staticmethod
    def _put(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
        if used + len(more) > len(held):
            grown = np.empty(max(used + len(more), len(held) * 3 // 2, 1024), held.dtype)
            grown[:used] = held[:used]
            held = grown
        held[used : used + len(more)] = more
        return held

    def add(self, bound: np.ndarray, before: np.ndarray, piece: np.ndarray, last: np.ndarray, first: np.ndarray, vertices: int) -> None:
        self.bound = self._put(self.bound, self.edges, bound + self.vertices)
        self.before = self._put(self.before, self.edges, before + self.vertices)
        self.piece = self._put(self.piece, self.edges, piece)
        self.last = self._put(self.last, self.segments, last + self.vertices)
        self.first = self._put(self.first, self.segments, first + self.vertices)
        self.edges += len(bound)
        self.segments += len(last)
        self.vertices += vertices


class Sampler:
    """Lattices of the segments met so far and the draws over them."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 0, sharpness: float = 1.0):
        self.size = len(vocabulary.pieces)
        self.seed = seed
        self.bytes_ = np.array(vocabulary.bytes_)
        spelled = [(p, i) for i, p in enumerate(vocabulary.pieces) if p]
        self.cost = -sharpness * np.log(np.maximum(np.array(vocabulary.ranks), 0) + 1.0)
        self.byte_cost = float(self.cost.min()) - sharpness
        # Per length: hashes of all prefixes of pieces, and the piece where the prefix is a whole one.
        found: list[dict[int, int]] = []
        for piece, i in spelled:
            h = 0
            for k, c in enumerate(piece):
                h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                while len(found) <= k:
                    found.append({})
                if k + 1 == len(piece):
                    found[k][h] = i
                else:
                    found[k].setdefault(h, -1)
        self.levels = [_Level(by) for by in found]
        self.spelling = [(p or "").encode() for p in vocabulary.pieces]
        for b, i in enumerate(vocabulary.bytes_):
            self.spelling[i] = bytes([b])
        self.spelled = pa.array(self.spelling, pa.large_binary())
        self.young, self.old = _Generation(), _Generation()

    def _build(self, segments: list[bytes]) -> None:
        """Append the lattices of new segments to the younger generation."""
        joined = b"".join(segments)
        # Characters of a segment are its bytes that do not go on with one.
        starts = np.cumsum([0, *map(len, segments[:-1])])
        length = np.add.reduceat((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80, starts, dtype=np.int64)
        code = np.frombuffer(joined.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U)
        n = len(code)
        char_end = np.repeat(np.cumsum(length), length)
        # One more vertex than characters in each segment.
        vertex = np.arange(n) + np.repeat(np.arange(len(segments)), length)
        at, h = np.arange(n), np.zeros(n, _U)
        covered = np.zeros(n, bool)
        begin, span, piece, score = [], [], [], []
        for k, level in enumerate(self.levels):
            inside = at + k < char_end[at]
            at, h = at[inside], h[inside]
            if not len(at):
                break
            h = h * _BASE + code[at + k] + _U(1)
            prefix, hit = level.lookup(h)
            at, h = at[prefix], h[prefix]
            whole = hit >= 0
            begin.append(at[whole])
            span.append(np.full(whole.sum(), k + 1))
            piece.append(hit[whole])
            score.append(self.cost[hit[whole]])
            if k == 0:
                covered[at[whole]] = True
        bare = np.flatnonzero(~covered)
        begin.append(bare)
        span.append(np.ones(len(bare), np.int64))
        piece.append(np.where(code[bare] < 128, self.bytes_[np.minimum(code[bare], 255).astype(int)], self.size + code[bare].astype(np.int64)))
        score.append(np.full(len(bare), self.byte_cost))
        # Edges into one vertex are summed by length, a bare character last.
        tie = np.repeat(np.arange(len(begin)), [len(x) for x in begin])
        wide = len(begin)
        begin, span, piece, score = (np.concatenate(x) for x in (begin, span, piece, score))
        start = vertex[begin]
        end = start + span
        # Number of the end within its segment: all edges into one number can be summed at once.
        depth = begin + span - (char_end - np.repeat(length, length))[begin]
        total = n + len(segments)
        order = np.argsort((depth * total + end) * wide + tie)
        start, end, piece, score, depth, tie = (x[order] for x in (start, end, piece, score, depth, tie))
        alpha = np.full(total, -np.inf)
        alpha[np.append(0, np.cumsum(length + 1)[:-1])] = 0.0
        cuts = np.searchsorted(depth, np.arange(1, int(length.max()) + 2))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            value, to = alpha[start[a:b]] + score[a:b], end[a:b]
            first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            top = np.maximum.reduceat(value, first)
            width = np.diff(np.append(first, b - a))
            alpha[to[first]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, width)), first))
        order = np.argsort(end * wide + tie)
        start, end, piece, score = start[order], end[order], piece[order], score[order]
        chance = np.exp(alpha[start] + score - alpha[end])
        first = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
        width = np.diff(np.append(first, len(end)))
        run = np.cumsum(chance)
        run -= np.repeat(run[first] - chance[first], width)
        run[np.append(first[1:], len(end)) - 1] = 1.0
        share = np.minimum(np.rint(np.minimum(run, 1.0) * _GRID), _GRID) / _GRID
        last = np.cumsum(length + 1) - 1
        self.young.add(end + share, start, piece, last, last - length, total)

    def _draw(self, held: _Generation, numbers: np.ndarray, seed: np.ndarray, token: np.ndarray, drawn: list, count: np.ndarray) -> None:
        """Walk from the end of each token's segment to its start; ``drawn`` gets (tokens, pieces) of each step."""
        bound, before, piece = held.bound[: held.edges], held.before, held.piece
        # Neighbouring look-ups stay near each other.
        order = np.argsort(numbers, kind="stable")
        at, stop, seed, token = held.last[numbers[order]], held.first[numbers[order]], seed[order], token[order]
        step = 0
        while len(token):
            turn = _U((step + 1) * int(_B) & 0xFFFFFFFFFFFFFFFF)
            u = (_mix(seed + turn) >> _U(34)).astype(np.float64) / _GRID
            edge = np.searchsorted(bound, at + u, "right")
            if step == len(drawn):
                drawn.append([])
            drawn[step].append((token, piece[edge]))
            count[token] += 1
            at = before[edge]
            on = at > stop
            token, at, stop, seed = token[on], at[on], stop[on], seed[on]
            step += 1

    def _sample(self, parts: pa.Array, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of segments one after another, and how many each has."""
        if self.young.edges > _EDGES // 2:
            self.old, self.young = self.young, _Generation()
        young, old = self.young.known, self.old.known
        told = parts.dictionary_encode()
        values = told.dictionary.to_pylist()
        own = np.fromiter(map(young.get, values, repeat(_NONE)), np.int64, len(values))
        missed = np.flatnonzero(own == _NONE)
        asked = [values[i] for i in missed.tolist()]
        older = np.fromiter(map(old.get, asked, repeat(_NONE)), np.int64, len(asked))
        unknown = np.flatnonzero(older == _NONE)
        new = [asked[i] for i in unknown.tolist()]
        # Segments of the older generation are the numbers below 0.
        older = -older - 1
        older[unknown] = len(young) + np.arange(len(new))
        own[missed] = older
        young.update(zip(new, older[unknown].tolist()))
        numbers = own[told.indices.to_numpy()]
        if new:
            self._build(new)
        drawn: list[list[tuple[np.ndarray, np.ndarray]]] = []
        count = np.zeros(len(parts), np.int64)
        for held, own in ((self.young, np.flatnonzero(numbers >= 0)), (self.old, np.flatnonzero(numbers < 0))):
            if len(own):
                place = numbers[own]
                self._draw(held, place if held is self.young else -place - 1, seed[own], own, drawn, count)
        last = np.cumsum(count) - 1
        out = np.empty(int(last[-1]) + 1, np.int64)
        for step, walks in enumerate(drawn):
            for token, found in walks:
                out[last[token] - step] = found
        spelled = np.flatnonzero(out >= self.size)
        if len(spelled):
            # A virtual piece stands for a character; its bytes take its place.
            width = np.ones(len(out), np.int64)
            codes = [chr(int(c)).encode("utf-8", "surrogatepass") for c in out[spelled] - self.size]
            width[spelled] = [len(p) for p in codes]
            count = np.bincount(np.repeat(np.arange(len(parts)), count), weights=width, minlength=len(parts)).astype(np.int64)
            begin = np.cumsum(width) - width
            out = np.repeat(out, width)
            for i, p in zip(spelled, codes):
                out[begin[i] : begin[i] + len(p)] = self.bytes_[list(p)]
        return out.astype(np.int32), count

    @staticmethod
    def _pieces(data: bytes) -> list[bytes]:
        """Whole segments of a text in pieces of about ``_CHUNK`` bytes."""
        found, at = [], 0
        while len(data) - at > _CHUNK:
            cut = _BEGIN.search(data, at + _CHUNK)
            if cut is None:
                break
            found.append(data[at : cut.start()])
            at = cut.start()
        return [*found, data[at:]]

    def encode(self, keys: list[int], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all texts one after another, and how many each text has."""
        start = np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], _U)
        rows = _mix(start + _U(self.seed * int(_A) + int(_B) & 0xFFFFFFFFFFFFFFFF))
        sizes = np.zeros(len(texts), np.int64)
        pieces: list[np.ndarray] = []
        read: list[bytes] = []
        of_row: list[int] = []
        # Segments of the text that are done before what is read of it.
        before: list[int] = []

        def done() -> int:
            """Sample what is read; how many segments of the last text are done by now."""
            data = b"".join(read)
            byte = np.frombuffer(data, np.uint8)
            blank, line = byte == 0x20, byte == 0x0A
            begin = line.copy()
            begin[1:] |= line[:-1] | (blank[1:] & ~blank[:-1])
            first = np.cumsum([0, *map(len, read[:-1])])
            begin[first] = True
            offsets = np.flatnonzero(begin)
            number = np.searchsorted(offsets, first)
            count = np.diff(np.append(number, len(offsets)))
            of_text = np.arange(len(offsets)) - np.repeat(number - before, count)
            row = np.repeat(of_row, count)
            ends = pa.py_buffer(np.append(offsets, len(data)).astype(np.int64))
            parts = pa.Array.from_buffers(pa.large_binary(), len(offsets), [None, ends, pa.py_buffer(data)])
            found, each = self._sample(parts, _mix(rows[row] + of_text.astype(_U) * _A))
            pieces.append(found)
            sizes[of_row] += np.add.reduceat(each, number)
            for some in (read, of_row, before):
                some.clear()
            return int(of_text[-1]) + 1

        held = 0
        for i, text in enumerate(texts):
            if not text:
                continue
            gone = 0
            # All pieces of a text but the last fill a chunk.
            for piece in self._pieces(b" " + text.encode("utf-8", "surrogatepass")):
                read.append(piece)
                of_row.append(i)
                before.append(gone)
                held += len(piece)
                if held >= _CHUNK:
                    gone, held = done(), 0
        if read:
            done()
        return (np.concatenate(pieces) if pieces else np.zeros(0, np.int32)), sizes

    def decode(self, pieces: list[int]) -> str:
        """The text that ``pieces`` spell, without the space that ``encode`` put before it."""
        return b"".join(map(self.spelling.__getitem__, pieces))[1:].decode("utf-8", "surrogatepass")

    def lossless(self, pieces: np.ndarray, sizes: np.ndarray, texts: list[str]) -> list[bool]:
        """Whether the pieces of each text spell it, as ``decode`` does for one text."""
        spelled = self.spelled.take(pa.array(pieces))
        offsets = np.frombuffer(spelled.buffers()[1], np.int64, len(pieces) + 1) if len(pieces) else np.zeros(1, np.int64)
        data = memoryview(spelled.buffers()[2] or b"").cast("B")
        ends = offsets[np.append(0, np.cumsum(sizes))].tolist()
        return [data[a + 1 : b] == t.encode("utf-8", "surrogatepass") for a, b, t in zip(ends[:-1], ends[1:], texts)]
