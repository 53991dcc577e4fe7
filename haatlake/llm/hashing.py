"""Numpy hashing of words, and a numpy hash table, for whole blocks of text at once."""

from __future__ import annotations

import numpy as np

# Odd multiplier of the rolling hash, and the constants of its final mix.
BASE, MIX_A, MIX_B = 0x9E6C63D0876A9A47, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, np.int8)
SPACE[[0x20, *range(0x09, 0x0E)]] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
# Bytes hashed at a time.
SLICE = 1 << 19
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX_A)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX_B)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least n of each."""
    if not _powers or _powers[0].size < n:
        size = max(n, SLICE)
        _powers.clear()
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0], _powers[1]


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words between ASCII white space in an array of bytes."""
    space = np.ones(raw.size + 2, np.int8)
    space[1:-1] = SPACE[raw]
    edge = np.flatnonzero(np.diff(space))
    starts, ends = edge[::2], edge[1::2]
    hashes = np.empty(starts.size, np.uint64)
    at = 0
    while at < starts.size:  # in slices that end with a word
        begin = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, begin + SLICE, "right")))
        part = raw[begin : ends[stop - 1]]
        power, inverse = powers(part.size)
        total = np.zeros(part.size + 1, np.uint64)
        np.cumsum(BYTE[part] * power[: part.size], out=total[1:])
        a, b = starts[at:stop] - begin, ends[at:stop] - begin
        hashes[at:stop] = (total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64)
        at = stop
    return starts, ends, np.maximum(mix(hashes), np.uint64(1))


class Lookup:
    """A numpy hash table from distinct non-zero 64-bit keys to positions 0, 1, 2 ..."""

    def __init__(self, bits: int):
        self.bits, self.size = bits, 0
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, -1 where it is not held."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], np.int32(-1))
        todo = np.flatnonzero((there != keys) & (there != 0))
        while todo.size:
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[todo]]
            found = there == keys[todo]
            out[todo[found]] = self.values[slot[todo[found]]]
            todo = todo[~found & (there != 0)]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Hold distinct new keys, at the next positions in their order."""
        slot, todo = self._slot(keys), np.arange(keys.size)
        while todo.size:
            free = todo[self.keys[slot[todo]] == 0]
            self.keys[slot[free]] = keys[free]
            won = free[self.keys[slot[free]] == keys[free]]
            self.values[slot[won]] = won + self.size
            placed = np.zeros(keys.size, bool)
            placed[won] = True
            todo = todo[~placed[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        self.size += keys.size
