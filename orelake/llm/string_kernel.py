"""Gap-weighted subsequence kernel on short strings, and a Nystrom support vector machine over it, in numpy.

A string is a word in lower case, its outer punctuation removed.  Its features
are the subsequences of 3, 4 and 5 characters within ``SPAN`` places, each
weighted by DECAY ** places; a subsequence may skip characters, so inserted and
gapped spellings keep most of their features.  The kernel is the mean over the
orders of the cosine of the feature vectors.

Landmarks are words of the training rows.  A word's Nystrom map is
k(word, landmarks) K^(-1/2); the machine is linear in it.  As the kernel is a
product of feature vectors, the trained function collapses into one weight per
subsequence, and a word is scored by looking its subsequences up.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

ORDERS = (3, 4, 5)
SPAN = 7
DECAY = 0.7
# Characters told apart; look-alikes count as the letter, everything else as 0.
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßáéíóúñàâæçèêëîïôœùû"
_LIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_CLASS = {c: i + 1 for i, c in enumerate(LETTERS)} | {k: LETTERS.index(v) + 1 for k, v in _LIKE.items()}
# The ends of a word are characters of their own, so that stems weigh more than the same letters inside.
START, END = "^", "|"
_CLASS |= {START: len(LETTERS) + 1, END: len(LETTERS) + 2}
RADIX = len(LETTERS) + 3
# Weights are kept by a hash of the subsequence.
SLOTS = 1 << 22
_EDGES = "^.,;:!?\"'()[]{}<>*%&#|+-_/\\~=…«»“”‘’"
# Longer strings are cut into overlapping windows of this many characters; the best one counts.
WINDOW = 24


def normal(token: str) -> str:
    return token.lower().strip(_EDGES)


def _windows(words: list[str]) -> tuple[list[str], np.ndarray]:
    parts, owner = [], []
    for i, word in enumerate(words):
        word = START + word + END
        if len(word) <= WINDOW:
            parts.append(word)
            owner.append(i)
        else:
            for at in range(0, len(word) - WINDOW // 2, WINDOW // 2):
                parts.append(word[at : at + WINDOW])
                owner.append(i)
    return parts, np.array(owner)


_PLACES: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _places(length: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Index tuples of all subsequences of a length, and their weights."""
    if (length, order) not in _PLACES:
        found = [
            (a, *rest)
            for a in range(length - order + 1)
            for rest in combinations(range(a + 1, min(a + SPAN, length)), order - 1)
        ]
        at = np.array(found, np.int64).reshape(-1, order)
        _PLACES[length, order] = at, (DECAY ** (at[:, -1] - at[:, 0] + 1)).astype(np.float32)
    return _PLACES[length, order]


def features(words: list[str], order: int):
    """Yields (indices of words, codes, weights) per length: rows of unit norm, equal codes side by side."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        if length < order:
            continue
        at, weight = _places(int(length), order)
        of_length = np.flatnonzero(lengths == length)
        for index in np.array_split(of_length, -(-len(of_length) * len(at) // 2_000_000)):
            text = "".join([words[i] for i in index])
            code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            kinds = _TABLE[np.minimum(code, len(_TABLE) - 1)].reshape(len(index), length)
            key = kinds[:, at[:, 0]].astype(np.int64)
            for k in range(1, order):
                key = key * RADIX + kinds[:, at[:, k]]
            key = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(42)
            rank = np.argsort(key, axis=1)
            key = np.take_along_axis(key, rank, 1)
            value = weight[rank]
            # Sum of equal subsequences, kept at the last of them.
            run = np.cumsum(value, axis=1, dtype=np.float64)
            last = np.ones(key.shape, bool)
            last[:, :-1] = key[:, 1:] != key[:, :-1]
            r, c = np.nonzero(last)
            total = run[r, c]
            before = np.append(0.0, total[:-1])
            before[np.append(True, r[1:] != r[:-1])] = 0.0
            total -= before
            norm = np.sqrt(np.bincount(r, weights=total * total, minlength=len(index)))
            yield index, r, key[r, c], (total / norm[r]).astype(np.float32)


_TABLE = np.zeros(0x180, np.int32)
for _c, _k in _CLASS.items():
    if ord(_c) < len(_TABLE):
        _TABLE[ord(_c)] = _k


class Machine:
    """One weight per subsequence of each order, and an offset."""

    def __init__(self, tables: list[np.ndarray], offset: float):
        self.tables, self.offset = tables, offset

    def score(self, words: list[str]) -> np.ndarray:
        parts, owner = _windows(words)
        out = np.zeros(len(parts))
        for order, table in zip(ORDERS, self.tables):
            for index, r, key, value in features(parts, order):
                out[index] += np.bincount(r, weights=table[key] * value, minlength=len(index))
        best = np.full(len(words), -np.inf)
        np.maximum.at(best, owner, out)
        return best + self.offset


def _against(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel matrix words x landmarks."""
    words, landmarks = [START + w + END for w in words], [START + w + END for w in landmarks]
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for order in ORDERS:
        codes, rows, values = [], [], []
        for index, r, key, value in features(landmarks, order):
            codes.append(key)
            rows.append(index[r])
            values.append(value)
        if not codes:
            continue
        known, column = np.unique(np.concatenate(codes), return_inverse=True)
        basis = np.zeros((len(known), len(landmarks)), np.float32)
        basis[column, np.concatenate(rows)] = np.concatenate(values)
        for index, r, key, value in features(words, order):
            place = np.minimum(np.searchsorted(known, key), len(known) - 1)
            hit = known[place] == key
            for a in range(0, len(index), 2000):
                of = hit & (r >= a) & (r < a + 2000)
                dense = np.zeros((min(2000, len(index) - a), len(known)), np.float32)
                dense[r[of] - a, place[of]] = value[of]
                out[index[a : a + 2000]] += dense @ basis / len(ORDERS)
    return out


def train(words: list[str], positive: np.ndarray, negative: np.ndarray, landmarks: list[str], ridge: float = 1e-6, rounds: int = 40) -> Machine:
    """Squared-hinge machine by Newton steps on words, each counted ``positive`` times as such and ``negative`` times as the other."""
    gram = _against(landmarks, landmarks).astype(np.float64)
    value, vector = np.linalg.eigh(gram)
    root = vector[:, value > 1e-6] / np.sqrt(value[value > 1e-6]) @ vector[:, value > 1e-6].T
    x = np.hstack([_against(words, landmarks).astype(np.float64) @ root, np.ones((len(words), 1))])
    w = np.zeros(x.shape[1])
    keep = np.append(np.full(x.shape[1] - 1, ridge), 1e-9)
    up, down = positive / (positive.sum() + negative.sum()), negative / (positive.sum() + negative.sum())

    def loss(w: np.ndarray) -> float:
        f = x @ w
        return up @ np.maximum(1 - f, 0) ** 2 + down @ np.maximum(1 + f, 0) ** 2 + keep @ w**2 / 2

    for _ in range(rounds):
        f = x @ w
        slope = x.T @ (2 * down * np.maximum(1 + f, 0) - 2 * up * np.maximum(1 - f, 0)) + keep * w
        held = up * (f < 1) + down * (f > -1)
        step = np.linalg.solve((x * (2 * held)[:, None]).T @ x + np.diag(keep), slope)
        now, size = loss(w), 1.0
        while size > 1e-3 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if now - loss(w) < 1e-9:
            break
    beta = root @ w[:-1] / len(ORDERS)
    tables = []
    for order in ORDERS:
        table = np.zeros(SLOTS, np.float32)
        for index, r, key, value in features([START + w + END for w in landmarks], order):
            np.add.at(table, key, (beta[index[r]] * value).astype(np.float32))
        tables.append(table)
    return Machine(tables, float(w[-1]))
