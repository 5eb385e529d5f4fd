"""BagMinHash signatures of word shingles, in numpy over a batch of texts.

A text is the multiset of its windows of five words (a shorter text is one
window).  Every shingle with weight w sees the part up to w of a fixed Poisson
process on weight x time: the weight axis is cut into the intervals (0,1],
(1,2], (2,4], (4,8], ..., and each interval has a process of its own, seeded by
the shingle, whose rate is the interval's length.  A point carries its time, its
place in the interval and a register; it counts when its place is at most w.
A register keeps the point of least time, so two texts agree in a register with
probability sum(min) / sum(max) of their weights.

Points are only made up to a time at which all registers are filled with high
probability; a text whose registers are not all filled gets twice that time.
The work is about one draw per shingle plus REGISTERS * log(REGISTERS) per text.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
BANDS, ROWS = 25, 4
REGISTERS = BANDS * ROWS

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_STEP = _U(0xD1B54A32D192ED03)
# One odd multiplier per place in a window.
_PLACES = np.array([0x8CB92BA72F3D8DD7, 0xAAAAAAAAAAAAAAAB ^ 0x5DEECE66D, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], _U) | _U(1)
_LOW48 = _U((1 << 48) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1]."""
    return ((x >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, 48-bit shingle) in order, with their counts: index of the text, shingle, count."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    inside = ~_SPACE[data]
    place = np.flatnonzero(inside)
    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int64)
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1] + 1
    start = np.flatnonzero(first)
    length = np.diff(np.append(start, len(place)))
    offset = np.arange(len(place)) - np.repeat(start, length)
    powers = np.ones(int(length.max()), _U)
    powers[1:] = _BASE
    powers = np.multiply.accumulate(powers)
    value = (data[place].astype(_U) + _U(1)) * powers[offset]
    word = mix(np.add.reduceat(value, start))
    owner = np.searchsorted(ends, place[start], "right")
    n = len(word)
    last = np.searchsorted(owner, owner, "right")
    index = np.arange(n)
    window = np.zeros(n, _U)
    for k in range(WORDS):
        at = index + k
        fits = at < last
        window[fits] += word[at[fits]] * _PLACES[k]
    new = np.ones(n, bool)
    new[1:] = owner[1:] != owner[:-1]
    full = (index + WORDS <= last) | new
    owner, window = owner[full], mix(window[full]) & _LOW48
    # Up to 65,536 texts: number of the text above the shingle, one plain sort.
    key, count = np.unique((owner.astype(_U) << _U(48)) | window, return_counts=True)
    return (key >> _U(48)).astype(np.int64), key & _LOW48, count


def _intervals(owner: np.ndarray, item: np.ndarray, count: np.ndarray):
    """One row per (text, shingle, interval of weights that its count reaches into)."""
    parts = [(np.arange(len(item)), np.zeros(len(item)), np.ones(len(item)), 0)]
    level, low = 1, 1
    while len(rows := np.flatnonzero(count > low)):
        parts.append((rows, np.full(len(rows), float(low)), np.full(len(rows), float(low)), level))
        level, low = level + 1, low * 2
    rows = np.concatenate([p[0] for p in parts])
    low = np.concatenate([p[1] for p in parts])
    rate = np.concatenate([p[2] for p in parts])
    tag = np.concatenate([np.full(len(p[0]), p[3], _U) for p in parts])
    return owner[rows], mix(item[rows] * _BASE + tag), low, rate, count[rows]


def signatures(owner: np.ndarray, item: np.ndarray, count: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """n x registers fingerprints; rows of texts without shingles are 0."""
    out = np.zeros((n, registers), _U)
    total = np.bincount(owner, weights=count, minlength=n)
    horizon = np.zeros(n)
    some = total > 0
    horizon[some] = registers / total[some] * (np.log(registers) + 4)
    text, seed, low, rate, weight = _intervals(owner, item, count)
    open_ = some.copy()
    while open_.any():
        rows = np.flatnonzero(open_[text])
        slots, times, prints = [], [], []
        made, width = np.zeros(len(rows), np.int64), 1
        clock = np.zeros(len(rows))
        while len(rows):
            step = (made[:, None] + np.arange(1, width + 1)).astype(_U)
            draw = mix(seed[rows][:, None] + step * _STEP)
            time = clock[:, None] + np.cumsum(-np.log(_uniform(draw)) / rate[rows][:, None], axis=1)
            point = mix(draw ^ _STEP)
            up = np.ceil(low[rows][:, None] + _uniform(mix(point ^ _BASE)) * rate[rows][:, None])
            good = (time < horizon[text[rows]][:, None]) & (up <= weight[rows][:, None])
            r, _ = np.nonzero(good)
            slots.append(text[rows][r] * registers + (point[good] % _U(registers)).astype(np.int64))
            times.append(time[good])
            prints.append(point[good])
            on = time[:, -1] < horizon[text[rows]]
            rows, made, clock = rows[on], made[on] + width, time[on, -1]
            width = min(width * 2, 256)
        slot, time, point = np.concatenate(slots), np.concatenate(times), np.concatenate(prints)
        order = np.lexsort((time, slot))
        slot, point = slot[order], point[order]
        least = np.ones(len(slot), bool)
        least[1:] = slot[1:] != slot[:-1]
        slot, point = slot[least], point[least]
        filled = np.bincount(slot // registers, minlength=n) == registers
        ready = open_ & filled
        of = slot // registers
        take = ready[of]
        out.reshape(-1)[slot[take]] = point[take]
        open_ &= ~filled
        horizon[open_] *= 2
    return out


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One number per text and band, different for different bands."""
    n, registers = signature.shape
    parts = signature.reshape(n, registers // rows, rows)
    key = np.arange(registers // rows, dtype=_U)[None, :] * _BASE + _U(1)
    for k in range(rows):
        key = mix(key ^ parts[:, :, k]) + _BASE
    return mix(key)


def chunks(sizes: list[int], limit: int = 2 << 20, most: int = 65536):
    """Slices of neighbouring texts of at most ``limit`` bytes together (a longer text comes alone)."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > limit or i - start >= most):
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))
