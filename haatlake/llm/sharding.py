"""Sharding by extendible hashing under a byte limit.

A row's 62-bit hash leads through a directory of hash prefixes. A bucket that holds more
than the limit is split on one more bit, others are left alone, until every shard fits.
All levels of the split are computed at once: rows are summed by a long prefix (a cell),
each cell's bytes are added to all its shorter prefixes, and the shard is the shortest
prefix that fits. Only cells that are still too large are divided further, on STEP more bits.
The hash covers the row's key and its number, so equal keys spread like others. What no
bit can split, a single row beyond the limit, is a shard of its own, marked `over`.

Sizes travel as one row for each cell, about CELLS cells for each shard; texts aren't
shuffled to find the shards. Edge cases: null keys and texts count as empty; a shard of
empty rows has 0 bytes; repeated rows are sharded one by one; an empty table has no
shard; columns with the names that are added are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haatlake.llm.common import stage

LIMIT, CELLS, STEP, BITS = 4 << 20, 32, 8, 62


def prefix(name: str, bits: int | str) -> F.Column:
    """The leading bits of a BITS-bit hash."""
    return F.expr(f"shiftright({name}, {BITS} - {bits})")


def hashed(df: DataFrame, key: str, text: str, keep: list[str]) -> DataFrame:
    """keep, bytes and hash of each row, written once so that a row's number stays the same."""
    size = F.coalesce(F.octet_length(df[text]), F.lit(0)).cast("long")
    rows = df.select(*[df[c] for c in keep], size.alias("bytes"), F.coalesce(df[key].cast("string"), F.lit("")).alias("_key"),
                     F.monotonically_increasing_id().alias("_row"))
    spread = F.expr(f"shiftrightunsigned(xxhash64(_key, _row), {64 - BITS})")
    return stage(rows.select(*keep, "bytes", spread.alias("hash")), "hashed")


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Shards of rows (bytes, hash): bits and prefix of each, its bytes and rows, and whether it is over the limit."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, math.ceil(math.log2(max(1, total / limit * CELLS))))
    cells = rows.withColumn("cell", prefix("hash", depth)).groupBy("cell").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    done, start = None, 0
    while True:
        cells = stage(cells, "cells")
        shards, rest = _split(cells, start, depth, limit)
        shards = stage(shards, "shards")
        done = shards if done is None else done.unionByName(shards)
        rest = stage(rest, "rest")
        if depth == BITS or not rest.limit(1).count():
            break
        # Cells no prefix of which fits: their rows alone go on, by more bits.
        start, depth, at = depth, min(BITS, depth + STEP), depth
        within = rows.withColumn("old", prefix("hash", at)).join(rest.select(F.col("cell").alias("old")), "old", "left_semi")
        cells = within.withColumn("cell", prefix("hash", depth)).groupBy("cell").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    last = rest.select(F.lit(depth).alias("bits"), F.col("cell").alias("prefix"), "bytes", "rows")
    return done.unionByName(last).withColumn("over", F.col("bytes") > limit)


def _split(cells: DataFrame, start: int, depth: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Shards among the prefixes of start to depth bits, and the cells that are left."""
    levels = cells.select("cell", "bytes", "rows", F.explode(F.sequence(F.lit(start), F.lit(depth))).alias("bits"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {depth} - bits)"))
    sums = levels.groupBy("bits", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    # A row alone can't be split further: it is a shard whatever its bytes.
    fits = stage(sums.where((F.col("bytes") <= limit) | (F.col("rows") == 1)), "fits")
    up = fits.select((F.col("bits") + 1).alias("bits"), F.col("prefix").alias("up"))
    highest = fits.join(up, (fits["bits"] == up["bits"]) & (F.expr("shiftright(prefix, 1)") == up["up"]), "left_anti")
    leaves = fits.where(F.col("bits") == depth).select(F.col("prefix").alias("cell"))
    return highest.select("bits", "prefix", "bytes", "rows"), cells.join(leaves, "cell", "left_anti")


def assign(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """rows with shard (its prefix in bits, as text), shard_bytes and over. The shards' depths are few; a join for each finds them."""
    depths = sorted(r[0] for r in shards.select("bits").distinct().collect()) or [0]  # at most BITS
    tried = rows.withColumn("_tries", F.array(*[F.struct(F.lit(d).alias("bits"), prefix("hash", d).alias("prefix")) for d in depths]))
    named = shards.select("bits", "prefix", F.col("bytes").alias("shard_bytes"), "over")
    from haatlake.sources.staging import bounded

    flat = tried.select(*rows.columns, F.explode("_tries").alias("_at")).select(*rows.columns, F.col("_at.bits").alias("bits"), F.col("_at.prefix").alias("prefix"))
    name = F.concat_ws("/", F.lpad(F.col("bits").cast("string"), 2, "0"), F.hex("prefix"))
    return flat.join(bounded(stage(named, "named")), ["bits", "prefix"]).withColumn("shard", name).drop("bits", "prefix")


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, bytes, shard, shard_bytes and over of each row."""
    rows = hashed(df, key, text, list(keep))
    shards = directory(rows.select("bytes", "hash"), limit)
    return assign(rows, stage(shards, "directory")).drop("hash")


def write_shards(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Write the rows of df as Parquet with a folder and one file for each shard; returns what was written."""
    names = [c for c in df.columns if c not in ("bytes", "shard", "shard_bytes", "over", "hash")]
    placed = shard(df, key, text, limit, keep=tuple(names))
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.parquet(path)
