"""Connected components of a table of links, by alternating large and small stars.

Links are dealt to as few tasks as can hold them, CONTRACTED a task, and each task contracts its
links to stars of their own: what is connected within a task needs no round of joins, and links that one
task holds are done. Rounds of stars connect what several tasks hold.

Edge cases: a link with a null end connects nothing and is left out, as is a link of a node with
itself; repeated links count once; nodes without a link aren't in the result; no links give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haatlake.llm.common import stage


# Links that a task contracts at a time.
CONTRACTED = 300_000


def _contract(links: DataFrame) -> DataFrame:
    """The same connections with each node linked to the least one it reaches among links held together."""
    def stars(pairs: list[tuple]) -> pa.RecordBatch:
        up: dict = {}

        def least(x):
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y]
                x = y
            return x

        for u, v in pairs:
            a, b = least(u), least(v)
            if a != b:
                up[max(a, b)] = min(a, b)
        found = [(x, r) for x in up if (r := least(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c in (list(zip(*found)) or [(), ()])], ["u", "v"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(links.schema["u"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[tuple] = []
        for batch in batches:
            pairs += zip(batch.column("u").to_pylist(), batch.column("v").to_pylist())
            if len(pairs) >= CONTRACTED:
                yield stars(pairs)
                pairs = []
        yield stars(pairs)

    return links.select("u", "v").mapInArrow(run, links.select("u", "v").schema)


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large: greater neighbours of a node move to its least one. Small: it and its lesser ones do."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v <= u")
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").dropDuplicates(["u", "v"])


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node and root (the least node of its component) of every node with a link. links: u, v of one type.

    Each round is written to the shared folder. Links shrink to stars; equal link tables
    in two rounds end the work; links that still change after the last one are an error.
    """
    at = stage(_contract(links.where("u <> v")), "links")
    mark = None
    for _ in range(rounds):
        now = at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        if now[0] <= CONTRACTED:  # one task sees all of them
            at = stage(_contract(at.repartition(1)), "links")
            break
        dealt = at.repartition(-(-now[0] // CONTRACTED), "u")
        at = stage(_star(stage(_star(_contract(dealt), True), "star"), False), "links")
    else:
        raise RuntimeError(f"links weren't found to stay equal within {rounds} rounds")
    return at.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        at.select(F.col("v").alias("node"), F.col("v").alias("root")).dropDuplicates(["node"]))
