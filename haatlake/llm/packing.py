"""Packing token sequences into windows with minimum bin slack.

A document longer than a window is cut into full windows and one remainder. Only
how often each remaining length occurs matters for packing, and that table has
fewer rows than the window has tokens. From it the driver fills window after
window: the largest length left, and with it the multiset of lengths that comes
closest to capacity, by subset-sum dynamic programming over a bitset; counts are
backtracked from the bitsets. A pattern found is used as often as its counts last,
so there are at most as many patterns as lengths, whatever the number of documents.
Tasks then give every remainder its number among those of its length, which is its
place in a pattern. No text is shuffled, and no length gathers in one task.

Edge cases: a null or empty text is its end token alone; a document that fills its
windows exactly has no remainder; repeated rows are packed once each; null ids stay
null; an empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haatlake.llm.bpe import encoder, tokenizer_file
from haatlake.llm.common import stage, text_blocks

CAPACITY, END_ID = 2048, 1
# Remainders of one length that one task numbers.
NUMBERED = 100_000

PIECES = "doc_id {id}, piece long, start long, length long, ids_crc32 long, doc_tokens long, whole long"


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Windows that hold all remainders: (count of each length in the window, number of such windows)."""
    left = {k: v for k, v in counts.items() if v > 0}
    found = []
    while left:
        largest = max(left)
        left_now = dict(left)
        left_now[largest] -= 1
        chosen = _fill(left_now, capacity - largest)
        chosen[largest] = chosen.get(largest, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        found.append((chosen, times))
        for k, n in chosen.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return found


def _fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths whose sum comes closest to room from below; few, long ones are preferred."""
    reach, mask = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((k for k, v in counts.items() if v and k <= room), reverse=True):
        steps.append((length, min(counts[length], room // length), reach))
        part, most = 1, steps[-1][1]
        while most:  # a count in binary parts
            use = min(part, most)
            reach |= (reach << (use * length)) & mask
            most, part = most - use, part * 2
        if reach >> room & 1:
            break
    target, chosen = reach.bit_length() - 1, {}
    for length, most, before in reversed(steps):
        n = next(n for n in range(most + 1) if n * length <= target and before >> (target - n * length) & 1)
        if n:
            chosen[length], target = n, target - n * length
    return chosen


def cut(df: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
        path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of each document: full windows (whole: their number) and remainders (whole: null).

    piece is a number of its own for each row; with_ids adds the ids themselves.
    """
    file = df.sparkSession.sparkContext.broadcast(tokenizer_file(path))
    schema = PIECES.format(id=df.schema[doc_id].dataType.simpleString()) + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task = encoder(file.value), TaskContext.get().partitionId()
        piece = whole = task << 36
        for batch, texts in text_blocks(batches, "text"):
            flat, ends = bpe.encode(texts)
            rows: list[tuple] = []
            begin = 0
            for i, end in enumerate(ends.tolist()):
                ids = np.append(flat[begin:end], np.uint32(END_ID)).astype("<u4")
                begin, n = end, ids.size
                for start in range(0, n, capacity):
                    part = ids[start : start + capacity]
                    full = part.size == capacity
                    rows.append((i, piece, start, part.size, zlib.crc32(part.tobytes()), n, whole if full else None, part))
                    piece, whole = piece + 1, whole + full
            columns = list(zip(*rows)) or [()] * 8
            made = [batch.column("doc_id").take(pa.array(columns[0], pa.int64()))]
            made += [pa.array(c, pa.int64()) for c in columns[1:7]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "whole"]
            if with_ids:
                made, names = [*made, pa.array([p.astype(np.int32) for p in columns[7]], pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(made, names)

    return df.select(df[doc_id].alias("doc_id"), df[text].alias("text")).mapInArrow(run, schema)


def _numbered(rest: DataFrame, counts: dict[int, int]) -> DataFrame:
    """rest with nth: the number of a row among those of its length. A frequent length is split over salts."""
    salts = -(-max(counts.values()) // NUMBERED)
    rest = rest.withColumn("salt", F.pmod(F.xxhash64("piece"), F.lit(salts)))
    sizes = rest.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("length").orderBy("salt")
    sizes = sizes.select("length", "salt", (F.sum("size").over(before) - F.col("size")).alias("before"))
    among = Window.partitionBy("length", "salt").orderBy("piece")
    return (rest.withColumn("nth", F.row_number().over(among) - 1).join(sizes, ["length", "salt"])
            .withColumn("nth", F.col("nth") + F.col("before")).drop("salt", "before"))


def pack(df: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         path: str | None = None, with_ids: bool = False) -> DataFrame:
    """cut() with sequence_id and offset of each piece. Odd sequences are full windows of one document."""
    spark = df.sparkSession
    pieces = stage(cut(df, doc_id, text, capacity, path, with_ids), "pieces")
    whole = (pieces.where("whole is not null")
             .withColumn("sequence_id", F.col("whole") * 2 + 1).withColumn("offset", F.lit(0).cast("long")).drop("whole", "piece"))
    rest = pieces.where("whole is null").drop("whole")
    counts = {r[0]: r[1] for r in rest.groupBy("length").count().collect()}  # fewer rows than capacity
    if not counts:
        return whole
    uses: dict[int, list[tuple[int, int, int, int]]] = {length: [] for length in counts}
    used, first = dict.fromkeys(counts, 0), 0
    for chosen, times in patterns(counts, capacity):
        at = 0
        for length, n in sorted(chosen.items(), reverse=True):
            uses[length].append((used[length], n, first, at))
            used[length] += n * times
            at += n * length
        first += times
    # For each length, by the first number: how many in a window, the first window, the place in it.
    plan = spark.sparkContext.broadcast({k: np.array(v, np.int64).T for k, v in uses.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, nth = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "nth"))
            sequence, offset = np.zeros(nth.size, np.int64), np.zeros(nth.size, np.int64)
            for k in np.unique(length).tolist():
                rows = np.flatnonzero(length == k)
                begin, each, window, at = plan.value[k]
                use = np.searchsorted(begin, nth[rows], "right") - 1
                turn, slot = np.divmod(nth[rows] - begin[use], each[use])
                sequence[rows], offset[rows] = (window[use] + turn) * 2, at[use] + slot * k
            kept = [c for c in batch.schema.names if c not in ("nth", "piece")]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)],
                                             [*kept, "sequence_id", "offset"])

    numbered = _numbered(rest, counts)
    return whole.unionByName(numbered.select(*[c for c in whole.columns if c not in ("sequence_id", "offset")], "piece", "nth")
                             .mapInArrow(run, whole.schema))
