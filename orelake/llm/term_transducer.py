"""Minimal acyclic transducer over sorted terms, with their lexicographic ordinals.

States are made while the terms come in order: the part of a term that the next
one does not share is closed, and a closed state that equals an earlier one (same
finality, same edges) is that one.  Every edge carries the number of terms that
come before all terms behind it, so the sum along a path is the term's ordinal.
States and edges lie in flat arrays, which are also the serialised form.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterable


class Transducer:
    """Ordinals of terms: ``lookup`` walks one edge per byte."""

    def __init__(self, first: array, labels: bytes, targets: array, before: array, final: bytes):
        self.first, self.labels, self.targets, self.before, self.final = first, labels, targets, before, final
        self.edges = None

    @staticmethod
    def build(terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in ascending order of their bytes."""
        known: dict[tuple, int] = {}
        size: list[int] = []
        first, targets, before, labels, final = array("q", [0]), array("q"), array("q"), bytearray(), bytearray()

        def close(state: list) -> int:
            key = (state[0], bytes(state[1]), tuple(state[2]))
            found = known.get(key)
            if found is None:
                found = known[key] = len(size)
                terms_before = int(state[0])
                for label, target in zip(state[1], state[2]):
                    labels.append(label)
                    targets.append(target)
                    before.append(terms_before)
                    terms_before += size[target]
                size.append(terms_before)
                final.append(state[0])
                first.append(len(labels))
            return found

        # Open states along the last term: final, labels, targets (the last edge's target is the next open state).
        path: list[list] = [[False, bytearray(), []]]
        last = b""

        def close_below(depth: int) -> None:
            while len(path) > depth + 1:
                state = path.pop()
                path[-1][2].append(close(state))

        for term in terms:
            if path[-1][0] and term <= last:
                raise ValueError("terms must be distinct and in ascending order")
            shared = 0
            while shared < len(last) and shared < len(term) and last[shared] == term[shared]:
                shared += 1
            close_below(shared)
            for byte in term[shared:]:
                path[-1][1].append(byte)
                path.append([False, bytearray(), []])
            path[-1][0] = True
            last = term
        close_below(0)
        close(path[0])
        return Transducer(first, bytes(labels), targets, before, bytes(final))

    def __len__(self) -> int:
        """Number of states."""
        return len(self.final)

    def lookup(self, term: bytes) -> int:
        """Ordinal of ``term``, or -1 where it is none of the terms."""
        labels, first, targets, before = self.labels, self.first, self.targets, self.before
        state, ordinal = len(self.final) - 1, 0
        for byte in term:
            edge = labels.find(byte, first[state], first[state + 1])
            if edge < 0:
                return -1
            ordinal += before[edge]
            state = targets[edge]
        return ordinal if self.final[state] else -1

    def lookup_all(self, terms: list[bytes]):
        """Ordinals of ``terms`` in an array, as ``lookup`` gives them: one step for all terms a byte."""
        import numpy as np

        first, targets, before = (np.frombuffer(a, np.int64) for a in (self.first, self.targets, self.before))
        if self.edges is None:
            # State and label of every edge as one number; these ascend.
            self.edges = np.repeat(np.arange(len(self.final)), np.diff(first)) * 256 + np.frombuffer(self.labels, np.uint8)
        found = np.full(len(terms), -1, np.int64)
        size = np.fromiter(map(len, terms), np.int64, len(terms))
        data, at = np.frombuffer(b"".join(terms), np.uint8), np.cumsum(size) - size
        final = np.frombuffer(self.final, np.uint8) != 0
        term = np.arange(len(terms))
        state, ordinal = np.full(len(terms), len(self.final) - 1), np.zeros(len(terms), np.int64)
        depth = 0
        while len(term):
            ended = size[term] == depth
            known = ended & final[state]
            found[term[known]] = ordinal[known]
            term, state, ordinal = term[~ended], state[~ended], ordinal[~ended]
            if not len(self.edges):
                break
            edge = state * 256 + data[at[term] + depth]
            place = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            on = self.edges[place] == edge
            term, place = term[on], place[on]
            state, ordinal = targets[place], ordinal[on] + before[place]
            depth += 1
        return found

    def pack(self) -> bytes:
        parts = (self.first.tobytes(), self.labels, self.targets.tobytes(), self.before.tobytes(), self.final)
        return struct.pack("<2q", len(self.final), len(self.labels)) + b"".join(parts)

    @staticmethod
    def unpack(data: bytes) -> Transducer:
        states, edges = struct.unpack_from("<2q", data)
        at, arrays = 16, []
        for n, wide in ((states + 1, True), (edges, False), (edges, True), (edges, True), (states, False)):
            part = data[at : at + n * (8 if wide else 1)]
            at += len(part)
            arrays.append(array("q", part) if wide else part)
        return Transducer(*arrays)
