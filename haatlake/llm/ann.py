"""Approximate nearest neighbours by inner product: an adaptive dimension scan of inverted lists.

A vector x gets one more component, sqrt(M**2 - |x|**2) with M the largest norm, a query a
zero; the smallest distance is then the largest inner product. A random rotation spreads a
distance evenly over the dimensions. k-means on a bounded sample gives the lists, every
vector goes to its nearest one, and each query probes so many lists that on the sample the
share TARGET of true neighbours lies in them, and half of them for the share WORST of queries. Within a list the rotated vectors are scanned in
blocks of columns: after d of D dimensions the distance so far, scaled by D / d, is tested
against the query's 20th best, and a candidate that exceeds it by more than chance explains
(a factor 1 + EPSILON / sqrt(d)) is abandoned. What survives all columns is scored in double
precision on the original vectors. The nearest list is searched first and gives each
query its bound; the other lists return only what is within it.

A list is dealt in blocks of at most about BLOCK vectors and BLOCK queries, so that no task
holds a list, however large.

Edge cases: vectors that are null, empty, zero or hold null, NaN or infinite components take
no part, as queries or as candidates. Vectors of one length are searched among themselves: products of
unequal lengths aren't defined. Components keep their type, so scores of doubles are exact; the scan
sees them scaled by the largest norm, in single precision. Ties go to the smaller id; repeated rows and ids are candidates one by one, and only a
query's own row is left out; a null id is never a query and comes last among ties. With
fewer than k candidates a query gets all. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haatlake.llm.common import runs, stage

SAMPLE, SAMPLE_QUERIES, MOST_LISTS, ROUNDS = 20_000, 300, 2_048, 8
TARGET, EPSILON, COLUMNS = 0.97, 2.1, 16
# Share of the sample's queries that find at least half of their neighbours.
WORST = 0.995
# Vectors and queries of a block; candidates and queries scanned at a time.
BLOCK, SCAN, BATCH = 8_192, 2_048, 256
RADIUS = 1 + 1e-9


@dataclass
class Index:
    dim: int
    scale: float  # one by the largest norm: scaled vectors have norms of at most RADIUS
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int
    k: int

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """With the extra component, not rotated."""
        x = x.astype(np.float64) * self.scale
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, RADIUS**2 - (x**2).sum(1)))
        return np.concatenate([x, last[:, None]], 1).astype(np.float32)

    def order(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Lists by distance."""
        return np.argsort(self._far(x, query), axis=1, kind="stable")

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return self._far(x, False).argmin(1)

    def _far(self, x: np.ndarray, query: bool) -> np.ndarray:
        return (self.centroids**2).sum(1) - 2 * self.lifted(x, query) @ self.centroids.T


def build(sample: np.ndarray, total: int, largest: float, k: int, seed: int = 1) -> Index:
    """Lists, rotation and number of probes, from a sample of the vectors."""
    dim, rng = sample.shape[1], np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0].astype(np.float32)
    lists = int(min(MOST_LISTS, max(1, round(total**0.5 / 4)), max(1, len(sample) // 4)))
    index = Index(dim, 1 / largest, rotation, np.zeros((1, dim + 1), np.float32), 1, k)
    points = index.lifted(sample, False)
    index.centroids = points[rng.permutation(len(points))[:lists]].copy()
    for _ in range(ROUNDS):
        own = np.concatenate([index.nearest(part) for part in np.array_split(sample, max(1, len(sample) // 2_000))])
        count = np.bincount(own, minlength=lists)
        for d in range(dim + 1):
            sums = np.bincount(own, points[:, d], minlength=lists)
            index.centroids[:, d] = np.where(count > 0, sums / np.maximum(count, 1), index.centroids[:, d])
    own = np.concatenate([index.nearest(part) for part in np.array_split(sample, max(1, len(sample) // 2_000))])
    asked = rng.permutation(len(sample))[:SAMPLE_QUERIES]
    places = np.argsort(index.order(sample[asked], True), axis=1)  # of each list in the query's order
    near = sample[asked].astype(np.float64) @ sample.T
    near[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-near, axis=1)[:, : min(k, len(sample) - 1)]
    rank = np.take_along_axis(places, own[best], 1)
    share = np.cumsum(np.bincount(rank.ravel(), minlength=lists)) / max(1, rank.size)
    if rank.size:
        half = np.sort(rank, axis=1)[:, (rank.shape[1] - 1) // 2]  # lists that hold half of a query's neighbours
        index.probes = 1 + max(int(np.argmax(share >= TARGET)), int(np.quantile(half, WORST, method="higher")))
    else:
        index.probes = lists
    return index


def top(who: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best, ties to the smaller id."""
    order = np.lexsort((ids, -score, who))
    first = np.r_[True, who[order][1:] != who[order][:-1]] if order.size else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(order.size), 0)) if order.size else np.zeros(0, np.int64)
    return order[np.arange(order.size) - begin < k]


def scan(index: Index, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, q: np.ndarray, q_rows: np.ndarray, bound: np.ndarray
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, candidate and score of each query's k best in a block, at or above its bound."""
    size, k = index.dim + 1, index.k
    xr, norms = index.lifted(x, False) @ index.rotation, ((q.astype(np.float64) * index.scale) ** 2).sum(1)
    found: list[tuple[np.ndarray, ...]] = []
    for q0 in range(0, len(q), BATCH):
        batch = slice(q0, q0 + BATCH)
        qb, least = q[batch], bound[batch].copy()
        qr = index.lifted(qb, True) @ index.rotation
        who, what, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for x0 in range(0, len(x), SCAN):
            xs = xr[x0 : x0 + SCAN]
            # The squared distance at which a candidate would tie with the bound.
            limit = np.maximum(0, norms[batch] + RADIUS**2 - 2 * least * index.scale**2) * (1 + 1e-5) + 1e-6
            part = np.maximum(0, (qr[:, :COLUMNS] ** 2).sum(1)[:, None] + (xs[:, :COLUMNS] ** 2).sum(1) - 2 * qr[:, :COLUMNS] @ xs[:, :COLUMNS].T)
            d = min(COLUMNS, size)
            a, b = np.nonzero(part * (size / d) <= (limit * (1 + EPSILON / d**0.5 * (d < size)) ** 2)[:, None])
            so_far = part[a, b]
            while d < size and a.size:
                end = min(d + COLUMNS, size)
                so_far = so_far + ((qr[a, d:end] - xs[b, d:end]) ** 2).sum(1)
                d = end
                keep = so_far * (size / d) <= limit[a] * (1 + EPSILON / d**0.5 * (d < size)) ** 2
                a, b, so_far = a[keep], b[keep], so_far[keep]
            b = b + x0
            other = rows[b] != q_rows[batch][a]
            a, b = a[other], b[other]
            exact = np.concatenate([(qb[a[i : i + 50_000]].astype(np.float64) * x[b[i : i + 50_000]].astype(np.float64)).sum(1) for i in range(0, a.size, 50_000)] or [np.zeros(0)])
            good = exact >= least[a]
            who, what, score = np.r_[who, a[good]], np.r_[what, b[good]], np.r_[score, exact[good]]
            best = top(who, score, ids[what], k)
            who, what, score = who[best], what[best], score[best]
            full = np.bincount(who, minlength=len(qb)) == k
            worst = np.full(len(qb), np.inf)
            np.minimum.at(worst, who, score)
            least = np.where(full, np.maximum(least, worst), least)
        found.append((who + q0, what, score))
    return tuple(np.concatenate(c) for c in zip(*found))


LAST = 2**63 - 1


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _kind(vectors: DataFrame) -> str:
    return vectors.schema["x"].dataType.simpleString()


def _placed(vectors: DataFrame, index: Index) -> DataFrame:
    """Every vector with a number of its row and its list."""
    held = vectors.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"), held.value.dim)
                own = held.value.nearest(x)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.arange(row, row + len(x))), pa.array(own.astype(np.int32)), batch.column("x"), batch.column("asks")],
                                                 ["id", "row", "list", "x", "asks"])
                row += len(x)

    return vectors.mapInArrow(run, f"id long, row long, list int, x {_kind(vectors)}, asks boolean")


def _asked(queries: DataFrame, index: Index, sizes: np.ndarray) -> DataFrame:
    """A row for each query and list to probe: the nearest (turn 0), and the others (turn 1)."""
    held = queries.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = held.value.order(_matrix(batch.column("x"), held.value.dim), True)
            enough = (np.cumsum(sizes[order], axis=1) <= held.value.k).sum(1) + 1  # lists that surely hold k others
            use = np.minimum(np.maximum(held.value.probes, enough), len(sizes))
            # Empty lists are passed over; the first that isn't is searched first.
            probe = (np.arange(len(sizes)) < use[:, None]) & (sizes[order] > 0)
            who, place = np.nonzero(probe)
            turn = np.r_[True, who[1:] != who[:-1]]
            take = pa.array(who)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(take), batch.column("row").take(take), batch.column("x").take(take),
                                              pa.array(order[who, place].astype(np.int32)), pa.array((~turn).astype(np.int32))], ["id", "row", "x", "list", "turn"])

    return queries.select("id", "row", "x").mapInArrow(run, f"id long, row long, x {_kind(queries)}, list int, turn int")


FOUND = "query long, query_id long, id long, row long, score double"


def _joined(placed: DataFrame, asked: DataFrame, index: Index, sizes: np.ndarray) -> DataFrame:
    """Each query's best in each block of the lists it asks. asked: id, row, x, list, bound."""
    spark = placed.sparkSession
    wanted = {r[0]: r[1] for r in asked.groupBy("list").count().collect()}  # a row for each list
    deal = spark.createDataFrame([(l, -(-int(sizes[l]) // BLOCK), -(-n // BLOCK)) for l, n in wanted.items()] or [(-1, 1, 1)], "list int, nb int, nc int")
    deal = F.broadcast(deal)  # at most MOST_LISTS rows
    h = F.xxhash64("row")
    left = placed.join(deal, "list").select("list", F.pmod(h, "nb").alias("i"), F.explode(F.sequence(F.lit(0), F.col("nc") - 1)).alias("j"),
                                            F.lit(False).alias("asks"), "id", "row", "x", F.lit(0.0).alias("bound"))
    right = asked.join(deal, "list").select("list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb").cast("long") - 1)).alias("i"), F.pmod(h, "nc").cast("int").alias("j"),
                                            F.lit(True).alias("asks"), "id", "row", "x", "bound")
    held = spark.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, "block"):
            asks = np.array(block.column("asks").to_pylist(), bool)
            x, rows = _matrix(block.column("x"), held.value.dim), block.column("row").to_numpy()
            known = block.column("id").fill_null(LAST).to_numpy()
            bound = block.column("bound").to_numpy()
            if asks.any() and not asks.all():
                who, what, score = scan(held.value, x[~asks], known[~asks], rows[~asks], x[asks], rows[asks], bound[asks])
                ids = block.column("id")
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[asks][who]), pa.array(known[asks][who]), ids.take(pa.array(np.flatnonzero(~asks)[what])).combine_chunks(),
                    pa.array(rows[~asks][what]), pa.array(score)], ["query", "query_id", "id", "row", "score"])

    both = left.unionByName(right).withColumn("block", F.xxhash64("list", "i", "j"))
    return both.repartition("block").sortWithinPartitions("block").mapInArrow(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}")


def search(df: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the k rows of largest inner product to each query row."""
    given = df.schema[vector].dataType.elementType.simpleString()
    kind = "float" if given == "float" else "double"
    x = F.transform(df[vector], lambda v: v.cast(kind))
    rows = df.select(df[vec_id].cast("long").alias("id"), x.alias("x"), F.coalesce(is_query & df[vec_id].isNotNull(), F.lit(False)).alias("asks"))
    valid = rows.where("x is not null and size(x) > 0").where(
        F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists("x", lambda v: v != 0))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    # A row for each length; lengths without a query aren't searched.
    shapes = valid.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("largest"), F.bool_or("asks").alias("asked")).collect()
    found = [_search(valid.where(F.size("x") == r.dim), r.n, r.largest, k) for r in sorted(shapes) if r.asked]
    empty = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found) if found else empty


def _search(valid: DataFrame, total: int, largest: float, k: int) -> DataFrame:
    """search() of rows (id, x, asks) whose vectors have one length."""
    share = min(1.0, SAMPLE / total)
    drawn = valid.where(F.pmod(F.xxhash64("id", "x"), F.lit(1_000_000)) < share * 1_000_000).select("id", "x").collect() or valid.select("id", "x").limit(SAMPLE).collect()
    sample = np.array([r[1] for r in sorted(drawn, key=lambda r: (r[0] is None, r[0] or 0, r[1]))])
    index = build(sample, total, largest, k)

    placed = stage(_placed(valid, index), "placed")
    sizes = np.zeros(len(index.centroids), np.int64)
    for l, n in placed.groupBy("list").count().collect():
        sizes[l] = n
    asked = stage(_asked(placed.where("asks"), index, sizes), "asked")
    none = F.lit(float("-inf"))
    first = stage(_best(_joined(placed, asked.where("turn = 0").withColumn("bound", none), index, sizes), k), "nearest")
    bounds = first.groupBy("query").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(none).alias("bound"))
    others = asked.where("turn = 1").join(bounds, F.col("row") == F.col("query"), "left").drop("query").withColumn("bound", F.coalesce("bound", none))
    found = first.drop("rank").unionByName(_joined(placed, stage(others, "others"), index, sizes))
    return _best(found, k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
