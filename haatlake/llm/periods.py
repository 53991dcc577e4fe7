"""Periodic runs of words, by recursive frequency splitting and a scan over lags.

A run is a stretch of words with smallest period q and a length of at least max(LEAST, OFTEN * q)
that no neighbouring word extends keeping that period.

1. Splitting. Every word of a run occurs at least OFTEN times in it. So a word that occurs more
   rarely in a segment of the text is in no run of that segment and splits it. The parts are
   counted again, each on its own, until no word splits any more; parts of fewer than LEAST
   words go. Prose falls apart within a few rounds. All texts of a block are split together.
2. Lag scan of what survives, lags ascending. A run with period q covers three blocks of q words
   in a row that begin at a multiple of q, and they are equal. So only such anchors are compared,
   n/q for a lag q, by a polynomial hash of prefixes; and a hit is extended word by word to both
   sides, which is exact. Hits within a run found before belong to it: three blocks of
   period q in a run of a smaller one have that one too.

Edge cases: a null or empty text has no words and no runs. Words are compared as bytes, without
hashing. Equal rows give equal results; ties of the longest run go to the smallest start, then
period. Rows are independent: nothing is shuffled, and no id is needed to be set or unique. A very
long text is handled alone, in memory proportional to its own length. Other columns are kept
only if named. Result names (the caller's `out`) may be chosen, should they clash with kept ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from haatlake.llm.common import text_blocks, with_text
from haatlake.llm.hashing import BASE, mix

# Least length of a run, and least number of its periods.
LEAST, OFTEN = 6, 4
# Anchors compared at a time.
ANCHORS = 1 << 20

OUT = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def surviving(ids: np.ndarray, part: np.ndarray) -> list[tuple[int, int]]:
    """Segments (start, end) that no word splits. part numbers the texts, ascending; segments don't cross them."""
    at, done, names = np.arange(ids.size), [], int(ids.max()) + 1 if ids.size else 1
    while at.size:
        _, word, count = np.unique(part * names + ids[at], return_inverse=True, return_counts=True)
        stays = count[word] >= OFTEN
        whole = np.bincount(part, ~stays) == 0  # no word split these
        edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for k, e in zip(edges[whole[part[edges]]].tolist(), np.r_[edges[1:], at.size][whole[part[edges]]].tolist()):
            if e - k >= LEAST:
                done.append((int(at[k]), int(at[k]) + e - k))
        stays &= ~whole[part]
        at, part = at[stays], part[stays]
        if at.size:
            part = np.cumsum(np.r_[True, (at[1:] != at[:-1] + 1) | (part[1:] != part[:-1])]) - 1
            enough = np.bincount(part)[part] >= LEAST
            at, part = at[enough], part[enough]
    return sorted(done)


def _equal(w: np.ndarray, i: int, q: int, down: bool) -> int:
    """How many positions from i on (or down from i) agree with the one q later."""
    n, step = 0, 64
    while True:
        a, b = (max(0, i - n - step + 1), i - n + 1) if down else (i + n, min(w.size - q, i + n + step))
        if a >= b:
            return n
        differs = w[a:b] != w[a + q : b + q]
        if down:
            differs = differs[::-1]
        first = int(differs.argmax())
        if differs[first]:
            return n + first
        n, step = n + b - a, step * 2


def lag_scan(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one segment of word ids, by start and period."""
    n = w.size
    power = np.full(n + 1, BASE, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(w.astype(np.uint64) + np.uint64(1)) * power[:n], out=prefix[1:])
    found: list[tuple[int, int, int]] = []
    low = 1
    while low <= n // OFTEN:
        high = min(2 * low, n // OFTEN + 1)  # none of these lags divides another one
        high = max(low + 1, min(high, low + ANCHORS * low // n))
        lags = np.arange(low, high)
        anchors = n // lags - 2
        q = np.repeat(lags, anchors)
        at = (np.arange(q.size) - np.repeat(np.cumsum(anchors) - anchors, anchors)) * q
        first, second = prefix[at + q] - prefix[at], prefix[at + 2 * q] - prefix[at + q]
        hit = np.flatnonzero(first * power[q] == second)
        q, at, second = q[hit], at[hit], second[hit]
        hit = second * power[q] == prefix[at + 3 * q] - prefix[at + 2 * q]
        q, at = q[hit], at[hit]
        if found and q.size:
            runs = np.array(sorted((s, s + length) for s, length, _ in found))
            reach = np.r_[0, np.maximum.accumulate(runs[:, 1])]
            fresh = reach[np.searchsorted(runs[:, 0], at, "right")] < at + 3 * q
            q, at = q[fresh], at[fresh]
        last = (0, 0)  # lag and end of the run found last
        for i, lag in zip(at.tolist(), q.tolist()):
            if last[0] == lag and i + 3 * lag <= last[1]:
                continue
            right = _equal(w, i, lag, False)
            if right < 2 * lag:  # equal hashes of unequal blocks
                continue
            left = _equal(w, i - 1, lag, True)
            if left + right + lag >= max(LEAST, OFTEN * lag):
                found.append((i - left, left + right + lag, lag))
                last = (lag, i + right + lag)
        low = high
    return sorted(found, key=lambda r: (r[0], r[2]))


def block_runs(words: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for text in words for w in text), np.int64, sum(map(len, words)))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for a, b in surviving(ids, np.repeat(np.arange(sizes.size), sizes)):
        k = int(np.searchsorted(ends, a, "right"))
        begin = a - int(ends[k] - sizes[k])
        out[k] += [(begin + s, length, q) for s, length, q in lag_scan(ids[a:b])]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words but for those that a run contains after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, q in runs:
        kept[start + q : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def _row(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    start, length, q = best or (None, None, None)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (len(runs), start, length, q, best and 1000 * length // q, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest())


def periodic_runs(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), out: tuple[str, ...] = OUT,
                  edit: Callable[[list[bytes], dict], list[bytes]] | None = None, collapsed: str | None = None) -> DataFrame:
    """The kept columns, then n_runs, start, length, period, exponent_milli of the longest run, and two digests.

    edit(words, kept columns of the row) may give other words to search. With `collapsed`, a column
    of that name holds the text left when every run is cut to its first period, words joined by a space.
    """
    rows, column = with_text(df, list(keep), text)
    kind = [LongType()] * 5 + [StringType()] * 2
    schema = StructType([*df.select(*keep).schema, *(StructField(c, t) for c, t in zip(out, kind)),
                         *([StructField(collapsed, StringType())] if collapsed else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, column):
            words = [t.encode("utf-8", "surrogatepass").split() for t in texts]  # of bytes: splits at ASCII white space
            if edit:
                words = [edit(w, row) for w, row in zip(words, batch.select(list(keep)).to_pylist())]
            runs = block_runs(words)
            found = [_row(w, r) for w, r in zip(words, runs)]
            columns = [pa.array(c, pa.int64() if i < 5 else pa.string()) for i, c in enumerate(zip(*found))]
            if collapsed:
                columns.append(pa.array([b" ".join(collapse(w, r)).decode("utf-8", "surrogatepass") for w, r in zip(words, runs)], pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], schema.names)

    return rows.mapInArrow(run, schema)
