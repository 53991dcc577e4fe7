"""Exact rows at given ranks of a total order, found without ordering the whole frame in one task."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import Scratch

# Rows of a range of an order, about; a range of fewer distinct rows is ordered by one task.
RANGE_ROWS = 500_000


def ranges_for(df: DataFrame, rows: int, most: int = RANGE_ROWS) -> int:
    """How many ranges so many rows are dealt to."""
    return max(-(-rows // most), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def dealt(df: DataFrame, order: list[str], number: str, ranges: int) -> DataFrame:
    """df by ranges of its order, with the number of each row's range. Write it before it is read: bounds are sampled."""
    return df.repartitionByRange(ranges, *order).withColumn(number, F.spark_partition_id())


def select_ranks(df: DataFrame, order: list[str], ranks: list[int], most: int = RANGE_ROWS, unique: bool = False) -> dict[int, tuple]:
    """What the rows at the given ranks have in the columns of `order`; rank 1 is the least row, nulls are least.

    Spark deals the rows by ranges, whose bounds it samples in the order of the columns' own types. Rows are
    counted by range, and only the ranges that hold a rank go on: into finer ranges, all ranks at once, while one of
    them has more than `most` distinct rows, and then to one task for each range. Equal rows are one row
    with a count before they are dealt; `unique` says that there are next to none, which saves that step. Either way
    the result is exact, ranks beyond the last row are left out. df is read several times.
    """
    names = [f"c{i}" for i in range(len(order))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(order, names)], F.lit(1).cast("long").alias("n"))
    merge = lambda frame, *keys: frame.groupBy(*keys, *names).agg(F.sum("n").alias("n"))
    with Scratch(df.sparkSession) as scratch:
        if not unique:
            rows = scratch(merge(rows))
        path: list[str] = []
        size = rows.count()
        wanted: dict[tuple, list[tuple[int, int]]] = {(): [(r, r) for r in sorted(set(ranks)) if r >= 1]}
        while True:
            path.append(f"r{len(path)}")
            rows = scratch(dealt(rows, path[:-1] + names, path[-1], ranges_for(df, size, most)))
            # A row for each range, and for each boundary between the ranges before.
            counted = rows.groupBy(*path).agg(F.sum("n").alias("weight"), F.count(F.lit(1)).alias("size")).collect()
            wanted, size, largest = _located(wanted, sorted(tuple(c) for c in counted))
            if not wanted:
                return {}
            rows = rows.where(reduce(or_, [_at(path, key) for key in wanted]))
            if largest <= most:
                break
            rows = scratch(merge(rows, *path))
        running = F.sum("n").over(W.partitionBy(*path).orderBy(*names))
        ends = rows.groupBy(*path, *names).agg(F.sum("n").alias("n")).withColumn("end", running)
        holds = [_at(path, key) & (F.col("end") >= k) & (F.col("end") - F.col("n") < k) for key, inside in wanted.items() for k, _ in inside]
        found = ends.where(reduce(or_, holds)).collect()
    out = {}
    for row in found:
        for k, rank in wanted[tuple(row[p] for p in path)]:
            if row["end"] - row["n"] < k <= row["end"]:
                out[rank] = tuple(row[c] for c in names)
    return out


def _at(path: list[str], key: tuple) -> Column:
    return reduce(and_, [F.col(p) == v for p, v in zip(path, key)])


def _located(wanted: dict[tuple, list[tuple[int, int]]], counted: list[tuple]) -> tuple[dict, int, int]:
    """The finer ranges that hold the ranks, with each rank's place within; their rows, and the rows of the largest."""
    out: dict[tuple, list[tuple[int, int]]] = {}
    before: dict[tuple, int] = {}
    size = largest = 0
    for *key, weight, n in counted:
        outer, start = tuple(key[:-1]), before.get(tuple(key[:-1]), 0)
        inside = [(k - start, rank) for k, rank in wanted.get(outer, ()) if start < k <= start + weight]
        before[outer] = start + weight
        if inside:
            out[tuple(key)] = inside
            size, largest = size + n, max(largest, n)
    return out, size, largest
