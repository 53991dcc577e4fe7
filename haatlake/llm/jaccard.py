"""Exact Jaccard join of shingle sets by pivots and regions of the Jaccard metric.

Documents with equal sets are one point of the metric space. Two different points link if
100 * intersection >= hundredths * union; the default of 90 is distance 0.1 or less. The steps
are told for 90, their figures follow from the threshold for any other.

1. Pivots and regions. Unrelated texts share next to nothing, so nearly all distances are 1
   and a fixed number of pivots would tell them apart from nothing. Hence pivots follow the
   data: of the points that hold a shingle among their first ones, in an order that puts
   shingles of frequent words last, the least is a pivot, and they are its region. Linked points have
   at least nine tenths of the larger set in common and so meet among the first tenth of
   both sets (plus one): a point is replicated to the regions of the pivots which its
   first tenth leads to, its window, and no link is lost. Frequencies of words are those
   of a fixed number of hash classes, counted over all documents.
2. Windows by prefix. With MEET - 1 further shingles linked points meet at least MEET times.
   Points of a region that meet so often, at a size within the tenth, are connected, across
   all regions a point lies in. Every link is within such a group, most points are in none, and
   a group is the region of the exact join: each point lies in one. A shingle of many points
   says nothing of them: such a region's points are compared block by block, as any others.
3. Joins. In a region, a pivot's distances to the others give its links, and by the triangle
   inequality points whose distances to a pivot differ by more than 0.1 aren't linked. Points
   found to hang together need no further comparison with each other, so the region left
   shrinks from pivot to pivot, and copies are never expanded to all their pairs.
4. Recursion. A region of more than REGION points is joined with PIVOTS of its points by all
   tasks first. What those connect is settled; the rest is joined with the region block by
   block, under the triangle windows of all these pivots. No region meets in one task.

The links found connect exactly what all links would connect; components follow from them.
Distances use 56-bit hashes of shingles, points 128-bit hashes of sets.

Edge cases: a null text or one without words has no shingles and no link; with fewer words
than a shingle the whole sequence is one. Sets of fewer than 9 shingles (4 with hundredths of
80) can link to equal sets alone. Texts of any length are processed whole; repeated rows and equal ids are separate rows
of one point; a null id counts for no component_id, which is null only if no row of the
component has an id. Other columns aren't read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haatlake.llm.common import bit_filter, in_filter, runs, stage, text_blocks
from haatlake.llm.components import components
from haatlake.llm.hashing import LOWER, mix, word_hashes
from haatlake.operators.winners import met
from haatlake.sources.staging import bounded

# Of op10's contract: words of a shingle; linked with HUNDREDTHS / 100 of the union in common.
WORDS = 3
HUNDREDTHS = 90
# Shingles that linked points have in common among their first ones, or all they must share if that is less.
MEET = 8
CLASSES = 1 << 18
# Points that one task compares at a time by their first shingles, and by whole sets; pivots of a larger region.
MEETING, REGION, PIVOTS = 5_000, 1_000, 16


def shingle_sets(texts: list[str], words: int = WORDS, level: np.ndarray | None = None) -> list[np.ndarray]:
    """The distinct shingles of each text, A-Z lower-cased, as numbers in ascending order.

    A number has the levels of the shingle's words in its first 8 bits, so that frequent
    shingles come last, and 56 bits of a hash.
    """
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)
    starts, _, hashes = word_hashes(LOWER[np.frombuffer(b"\n".join(raws), np.uint8)])
    first = np.r_[0, np.searchsorted(starts, ends)]
    rolled, n = hashes, hashes.size
    for k in range(1, words):
        rolled = mix(rolled[: n - k] * np.uint64(3) + hashes[k:])
    rolled = rolled >> np.uint64(8)
    if level is not None and n >= words:
        each = level[_class(hashes)].astype(np.uint64)
        total = sum(each[k : n - words + 1 + k] for k in range(words))
        total = total * np.uint64(3) // np.uint64(max(3, words))  # so that 8 bits hold it
        rolled |= np.minimum(total, np.uint64(255)) << np.uint64(56)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:  # the whole sequence, apart from longer shingles
            whole = hashes[a : a + 1]
            for k in range(a + 1, b):
                whole = mix(whole * np.uint64(3) + hashes[k : k + 1])
            out.append(mix(whole ^ np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _class(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CLASSES - 1)).astype(np.int64)


def _levels(docs: DataFrame) -> np.ndarray:
    """A level for each hash class of words: the logarithm of its occurrences in all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(CLASSES, np.int64)
        for _, texts in text_blocks(batches, "text"):
            raw = "\n".join(texts).encode("utf-8", "surrogatepass")
            count += np.bincount(_class(word_hashes(LOWER[np.frombuffer(raw, np.uint8)])[2]), minlength=CLASSES)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(count[at])], ["class", "n"])

    sums = docs.select("text").mapInArrow(run, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).toArrow()  # at most CLASSES rows
    count = np.zeros(CLASSES)
    count[sums["class"].to_numpy()] = sums["n"].to_numpy()
    return np.clip(np.round(4 * np.log2(1 + count / max(1.0, count.mean()))), 0, 85).astype(np.uint8)


def least_set(hundredths: int) -> int:
    """The size below which sets are linked to equal ones alone: 100 * 7 < 90 * 8, and so on."""
    if not 1 <= hundredths <= 99:
        raise ValueError(f"hundredths must be 1 to 99, not {hundredths}")
    return -(-hundredths // (100 - hundredths))


def _common(n, hundredths: int):
    """How many shingles a set of n shares at least with each one linked to it, up to MEET. It never falls as n grows."""
    return np.minimum(MEET, -(-hundredths * n // 100))


def _first(points: np.ndarray, hundredths: int) -> np.ndarray:
    """A set's first shingles: linked sets have the smaller one's _common() of them in common."""
    return points[: points.size + hundredths * points.size // -100 + int(_common(points.size, hundredths))]


def _point(points: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(points.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _signatures(docs: DataFrame, level: np.ndarray, words: int, hundredths: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, the point (a, b), and once in each task its first keys: of pivots, and to meet by. Written once."""
    held, least = docs.sparkSession.sparkContext.broadcast(level), least_set(hundredths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch, texts in text_blocks(batches, "text"):
            sizes, points, keys, meet = [], [], [], []
            for s in shingle_sets(texts, words, held.value):
                point = _point(s) if s.size else (None, None)
                new = s.size >= least and point not in seen
                if new:
                    seen.add(point)
                sizes.append(s.size)
                points.append(point)
                first = _first(s, hundredths) if new else None
                keys.append(first[: first.size - int(_common(s.size, hundredths)) + 1].view(np.int64) if new else None)
                meet.append((first >> np.uint64(8)).astype(np.uint32).view(np.int32) if new else None)
            a, b = zip(*points)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(meet, pa.list_(pa.int32()))],
                ["doc_id", "text_hash", "n_shingles", "a", "b", "keys", "meet"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", _text_hash("text").alias("text_hash"))
    out = stage(rows.mapInArrow(run, f"doc_id {kind}, text_hash long, n_shingles long, a long, b long, keys array<long>, meet array<int>"), "signatures")
    held.destroy()
    return out


def _text_hash(text: str | F.Column) -> F.Column:
    """What tells rows of equal id apart."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def _owned(a: str, doc_id: str) -> F.Column:
    """A number for a point and the document that stands for it."""
    return F.col(a).bitwiseXOR(F.xxhash64(doc_id))


def _points(signatures: DataFrame) -> DataFrame:
    """a, b, n_shingles, keys, meet of each point that can be linked, once: of the least id among the rows that have keys.

    Copies so end before they are dealt. Only rows of one id and one set may leave several, which each region drops.
    """
    keyed = signatures.where("keys is not null")
    owner = keyed.groupBy("a", "b").agg(F.min("doc_id").alias("owner")).select(F.col("a").alias("x"), F.col("b").alias("y"), "owner")
    mine = (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")) & F.col("doc_id").eqNullSafe(F.col("owner"))
    return keyed.join(owner, mine, "left_semi").select("a", "b", "n_shingles", "keys", "meet")


def _regions(points: DataFrame) -> DataFrame:
    """cell (its pivot), a, b: points replicated to the regions of their pivots."""
    postings = points.select(F.explode("keys").alias("key"), "a", "b")
    pivots = postings.groupBy("key").agg(F.min("a").alias("cell"), F.max("a").alias("most")).where("cell <> most").drop("most")
    return postings.join(pivots, "key").select("cell", "a", "b").dropDuplicates()


class Members:
    """Sets in one flat array, for overlaps of one with many."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.fromiter(map(len, sets), np.int64, len(sets))
        self.end = np.cumsum(self.size)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        _, self.flat = np.unique(flat, return_inverse=True)
        self.flag = np.zeros(int(self.flat.max()) + 1 if self.flat.size else 0, bool)

    def of(self, i: int) -> np.ndarray:
        return self.flat[self.end[i] - self.size[i] : self.end[i]]

    def overlap(self, i: int, others: np.ndarray) -> np.ndarray:
        """How many elements of i each of the others has. No set is empty."""
        mine = self.of(i)
        self.flag[mine] = True
        size = self.size[others]
        begin = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.end[others] - size - begin, size)
        found = np.add.reduceat(self.flag[self.flat[at]], begin, dtype=np.int64)
        self.flag[mine] = False
        return found

    def near(self, i: int, hundredths: int) -> np.ndarray:
        """Whether each set's size is within reach of a link with i."""
        small, large = np.minimum(self.size, self.size[i]), np.maximum(self.size, self.size[i])
        return 100 * small >= hundredths * large


def connect(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Pairs that connect what all pairs of n positions connect for which near holds.

    near(i, window) gives the positions of a window that i is linked to. Positions that
    hang together already aren't compared; a pivot is compared with all others once.
    """
    part, found, todo = np.arange(n), [], np.ones(n, bool)
    while True:
        left = np.flatnonzero(todo)
        names, where, count = np.unique(part[left], return_inverse=True, return_counts=True)
        if names.size <= 1:
            return found
        pivot = int(left[np.argmin(count[where])])  # of a small part, which soon needs no more
        todo[pivot] = False
        for j in near(pivot, todo & (part != part[pivot])).tolist():
            if part[j] != part[pivot]:
                found.append((pivot, j))
                part[part == part[j]] = part[pivot]


def meeting(keys: list[np.ndarray], n: np.ndarray, hundredths: int = HUNDREDTHS, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs that connect the points which meet as often as links must, at a size within reach.

    With a side for each point only points of different sides are compared.
    """
    members = Members(keys)

    def near(i: int, window: np.ndarray) -> np.ndarray:
        window = window & (100 * np.minimum(n, n[i]) >= hundredths * np.maximum(n, n[i]))
        others = np.flatnonzero(window if side is None else window & (side != side[i]))
        return others[members.overlap(i, others) >= _common(np.minimum(n[others], n[i]), hundredths)] if others.size else others

    return connect(len(keys), near)


def region_links(sets: list[np.ndarray], hundredths: int = HUNDREDTHS) -> list[tuple[int, int]]:
    """Links that connect what all links of a region connect, as pairs of positions."""
    members, n = Members(sets), len(sets)
    distance: list[np.ndarray] = []  # of all to a pivot; nan where it wasn't needed
    limit = 1 - hundredths / 100 + 1e-9

    def near(pivot: int, window: np.ndarray) -> np.ndarray:
        window = window & members.near(pivot, hundredths)
        for d in distance[-8:]:  # nan compares false: it excludes nothing
            window &= ~(np.abs(d - d[pivot]) > limit)
        others = np.flatnonzero(window)
        if not others.size:
            return others
        both = members.overlap(pivot, others)
        union = members.size[others] + members.size[pivot] - both
        d = np.full(n, np.nan)
        d[others], d[pivot] = 1 - both / union, 0.0
        distance.append(d)
        return others[100 * both >= hundredths * union]

    return connect(n, near)


def _name(a: int, b: int) -> str:
    return f"{a & (2**64 - 1):016x}{b & (2**64 - 1):016x}"


def _groups(regions: DataFrame, points: DataFrame, hundredths: int) -> DataFrame:
    """u, v: points that meet, so that every link lies within a group of connected points.

    A region of more points than one task compares is dealt to blocks of half as many; every two blocks meet in a task,
    and so do the points of one block.
    """
    sized = regions.join(regions.groupBy("cell").count().withColumnRenamed("count", "points"), "cell")
    keys = points.select("a", "b", F.col("meet").alias("keys"), "n_shingles")
    blocks = F.when(F.col("points") <= MEETING, 1).otherwise(F.ceil(2 * F.col("points") / MEETING)).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, "block"):
            a, b = block.column("a").to_pylist(), block.column("b").to_pylist()
            keep = sorted({p: i for i, p in reversed(list(enumerate(zip(a, b))))}.values())  # rows of one id may repeat a point
            keys, n = _arrays(block.column("keys")), block.column("n_shingles").to_numpy()
            mine, other = block.column("mine").to_numpy()[keep], block.column("other").to_numpy()[keep]
            found = meeting([keys[i] for i in keep], n[keep], hundredths, None if mine[0] == other[0] else mine)
            if found:
                yield _pairs([(_name(a[keep[i]], b[keep[i]]), _name(a[keep[j]], b[keep[j]])) for i, j in found])

    dealt = (sized.join(keys, ["a", "b"]).withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("a", "b"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other")).alias("block"), "mine", "other", "a", "b", "keys", "n_shingles"))
    return dealt.repartition("block").sortWithinPartitions("block").mapInArrow(run, LINKS)


def _named(a: str, b: str) -> F.Column:
    """_name() as a column."""
    return F.concat(F.lpad(F.lower(F.hex(a)), 16, "0"), F.lpad(F.lower(F.hex(b)), 16, "0"))


def _pairs(pairs: list[tuple[str, str]]) -> pa.RecordBatch:
    u, v = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.string()), pa.array(v, pa.string())], ["u", "v"])


def _sets(docs: DataFrame, wanted: DataFrame, held: Broadcast, words: int, least: int) -> DataFrame:
    """cell, points, a, b, set of the wanted points (a, b, cell, points, doc_id), computed again from the texts.

    Of a point's copies only the document that stands for it sends its set: tasks drop nearly all others by a filter of
    fixed size, a join the rest. held: the levels and the filter.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, bits = held.value
        seen: set[tuple[int, int]] = set()
        for batch, texts in text_blocks(batches, "text"):
            ids, rows = batch.column("id_hash").to_numpy(), []
            for i, s in enumerate(shingle_sets(texts, words, levels)):
                if s.size < least:
                    continue
                p = _point(s)
                if in_filter(bits, np.array([p[0] ^ int(ids[i])], np.int64).view(np.uint64))[0] and (*p, ids[i]) not in seen:
                    seen.add((*p, ids[i]))
                    rows.append((*p, int(ids[i]), s.view(np.int64)))
            if rows:
                a, b, h, arrays = zip(*rows)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (a, b, h)), pa.array(arrays, pa.list_(pa.int64()))], ["a", "b", "id_hash", "set"])

    made = docs.select("text", F.xxhash64("doc_id").alias("id_hash")).mapInArrow(run, "a long, b long, id_hash long, set array<long>")
    names = wanted.select("a", "b", F.xxhash64("doc_id").alias("id_hash"), "cell", "points")
    # Merged, not broadcast: names of points stay off the driver at every size.
    return made.join(names.hint("shuffle_merge"), ["a", "b", "id_hash"]).select("cell", "points", "a", "b", "set")


def _arrays(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = flat.offsets.to_numpy()
    values = flat.values.to_numpy()
    return [values[x:y] for x, y in zip(ends[:-1], ends[1:])]


LINKS = "u string, v string"


def _small_links(rows: DataFrame, hundredths: int) -> DataFrame:
    """Links of regions that one task joins. rows: cell, a, b, set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for region in runs(batches, "cell"):
            a, b = region.column("a").to_pylist(), region.column("b").to_pylist()
            keep = sorted({p: i for i, p in reversed(list(enumerate(zip(a, b))))}.values())  # rows of one id may repeat a point
            sets = _arrays(region.column("set"))
            found = region_links([sets[i] for i in keep], hundredths)
            if found:
                yield _pairs([(_name(a[keep[i]], b[keep[i]]), _name(a[keep[j]], b[keep[j]])) for i, j in found])

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, LINKS)


def _large_links(rows: DataFrame, hundredths: int) -> DataFrame:
    """Links of regions that no task could join alone. rows: cell, points, a, b, set."""
    rows = stage(rows.dropDuplicates(["cell", "a", "b"]).withColumn("h", F.xxhash64("a", "b")), "large")
    order = Window.partitionBy("cell").orderBy("h", "a", "b")
    chosen = rows.select("cell", "points", "a", "b", "h").withColumn("rank", F.row_number().over(order)).where(f"rank <= {PIVOTS}")
    chosen = rows.join(bounded(stage(chosen.select("cell", "a", "b", "rank"), "chosen")), ["cell", "a", "b"])
    blocks = F.ceil(F.col("points") / REGION).cast("int")
    members = rows.select("cell", F.pmod("h", blocks).cast("int").alias("i"), F.lit(0).alias("rank"), "a", "b", "set")
    pivots = chosen.select("cell", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"), "rank", "a", "b", "set")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, "block"):
            rank = block.column("rank").to_numpy()
            mine = np.flatnonzero(rank == 0)
            if not mine.size:
                continue
            sets, far, mask = Members(_arrays(block.column("set"))), np.ones((len(rank), PIVOTS)), np.zeros(len(rank), np.int64)
            for p in np.flatnonzero(rank > 0).tolist():
                both = sets.overlap(p, mine)
                union = sets.size[mine] + sets.size[p] - both
                far[mine, rank[p] - 1] = 1 - both / union
                mask[mine] |= (100 * both >= hundredths * union).astype(np.int64) << (int(rank[p]) - 1)
            own = block.take(pa.array(mine))
            yield pa.RecordBatch.from_arrays([*(own.column(c).combine_chunks() for c in ("cell", "a", "b", "set")), pa.array(list(far[mine]), pa.list_(pa.float64())), pa.array(mask[mine])],
                                             ["cell", "a", "b", "set", "far", "mask"])

    measured = stage(members.unionByName(pivots).withColumn("block", F.xxhash64("cell", "i")).repartition("block").sortWithinPartitions("block")
                     .mapInArrow(measure, "cell long, a long, b long, set array<long>, far array<double>, mask long"), "measured")

    def settle(masks):  # at most 2**PIVOTS rows: the pivots that hang together and hold most points
        groups: list[list[int]] = []
        for mask, n in zip(masks["mask"], masks["count"]):
            if mask:
                joined = [g for g in groups if g[0] & mask]
                groups = [g for g in groups if not g[0] & mask] + [[int(mask) | sum_or(joined), int(n) + sum(g[1] for g in joined)]]
        best = max(groups, key=lambda g: g[1], default=[0, 0])
        return masks.iloc[:1][["cell"]].assign(main=best[0])

    main = stage(measured.groupBy("cell", "mask").count().groupBy("cell").applyInPandas(settle, "cell long, main long"), "main")
    marked = measured.join(bounded(main), "cell").withColumn("rest", F.expr("(mask & main) = 0"))
    counts = stage(marked.groupBy("cell").agg(F.count(F.lit(1)).alias("all"), F.sum(F.col("rest").cast("long")).alias("left")), "counts")
    blocks = bounded(counts.where("left > 0").select(
        "cell", F.ceil(F.col("all") / REGION).cast("int").alias("na"), F.ceil(F.col("left") / REGION).cast("int").alias("nl")))
    placed = marked.join(blocks, "cell").withColumn("h", F.xxhash64("a", "b"))
    everyone = placed.select("cell", F.pmod("h", "na").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("nl") - 1)).alias("j"), F.lit(False).alias("probe"), "a", "b", "set", "far", "rest")
    probes = placed.where("rest").select("cell", F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("i"), F.pmod("h", "nl").cast("int").alias("j"), F.lit(True).alias("probe"), "a", "b", "set", "far", "rest")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, "block"):
            probe = np.array(block.column("probe").to_pylist(), bool)
            a, b = block.column("a").to_pylist(), block.column("b").to_pylist()
            members, far = Members(_arrays(block.column("set"))), np.stack(_arrays(block.column("far")))
            settled = ~probe & ~np.array(block.column("rest").to_pylist(), bool)
            part = np.where(settled, -1, np.arange(len(a)))  # the settled ones hang together
            names, out = [_name(x, y) for x, y in zip(a, b)], []
            where: dict[str, int] = {}
            for i in np.flatnonzero(~settled).tolist():  # a point can be probe and member of a block
                part[i] = where.setdefault(names[i], int(part[i]))
            for i in np.flatnonzero(probe).tolist():
                window = ~probe & (part != part[i]) & members.near(i, hundredths)
                window &= (np.abs(far - far[i]) <= 1 - hundredths / 100 + 1e-9).all(1)
                others = np.flatnonzero(window)
                if others.size:
                    both = members.overlap(i, others)
                    for k in others[100 * both >= hundredths * (members.size[others] + members.size[i] - both)].tolist():
                        if part[k] != part[i]:
                            out.append((names[i], names[k]))
                            part[part == part[i]] = part[k]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["u", "v"])

    dealt = (everyone.unionByName(probes).withColumn("block", F.xxhash64("cell", "i", "j"))
             .repartition("block").sortWithinPartitions("block").mapInArrow(join, LINKS))

    bit = F.expr("shiftright(mask, rank - 1) & 1")
    names = bounded(stage(chosen.select("cell", "rank", _named("a", "b").alias("v")), "names"))
    direct = measured.where("mask <> 0").select("cell", "mask", _named("a", "b").alias("u")).join(names, "cell").where((bit == 1) & (F.col("u") != F.col("v")))
    return dealt.unionByName(direct.select("u", "v"))


def sum_or(groups: list[list[int]]) -> int:
    out = 0
    for g in groups:
        out |= g[0]
    return out


def _link_parts(docs: DataFrame, points: DataFrame, owners: DataFrame, level: np.ndarray, words: int, hundredths: int) -> DataFrame:
    """node, root of the points that links connect, by stages that are all written."""
    groups = components(_groups(stage(_regions(points), "regions"), points, hundredths))
    counts = groups.groupBy("root").agg(F.count(F.lit(1)).alias("points"), F.count(F.lit(1)).alias("_n"))
    number = lambda at: F.conv(F.substring("node", at, 16), 16, -10).cast("long")
    named = _of_root(groups, counts).select(number(1).alias("a"), number(17).alias("b"), F.xxhash64("root").alias("cell"), "points")
    wanted = stage(named.join(owners.select("a", "b", F.col("least").alias("doc_id")), ["a", "b"]), "wanted")
    held = docs.sparkSession.sparkContext.broadcast((level, bit_filter(wanted.select(_owned("a", "doc_id").alias("owned")), "owned")))
    rows = _sets(docs, wanted, held, words, least_set(hundredths))
    found = _small_links(rows.where(f"points <= {REGION}"), hundredths)
    if wanted.where(f"points > {REGION}").limit(1).count():
        rows = stage(rows, "sets")
        found = _small_links(rows.where(f"points <= {REGION}"), hundredths).unionByName(_large_links(rows.where(f"points > {REGION}"), hundredths))
    out = components(found)
    held.destroy()
    return out


def _solved(docs: DataFrame, words: int, hundredths: int) -> tuple[DataFrame, DataFrame]:
    """The signatures, and the root, the least id and the component_id of each point."""
    level = _levels(docs)
    signatures = _signatures(docs, level, words, hundredths)
    owners = signatures.where("a is not null").groupBy("a", "b").agg(F.min("doc_id").alias("least"))
    linked = _link_parts(docs, stage(_points(signatures), "points"), owners, level, words, hundredths)
    rooted = stage(owners.withColumn("node", _named("a", "b")).join(linked, "node", "left").withColumn("root", F.coalesce("root", "node")).drop("node"), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_n"))
    return signatures, _of_root(rooted, smallest).select("a", "b", "root", "least", "component_id")


def _of_root(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows, staged, with what was found for their root and its number of rows _n. A large component's rows stay in their tasks."""
    return met(rows, stage(found, "roots"), "root", hot_rows=max(1_000, rows.count() // 100_000), whole=False)


def jaccard_components(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, hundredths: int = HUNDREDTHS) -> DataFrame:
    """doc_id, n_shingles and component_id (the least id linked to it, directly or not) of every row."""
    docs = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))
    signatures, solved = _solved(docs, words, hundredths)
    found = signatures.select("doc_id", "n_shingles", "a", "b").join(solved.select("a", "b", "component_id"), ["a", "b"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", own.alias("component_id"))


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, hundredths: int = HUNDREDTHS) -> DataFrame:
    """The rows of df but for those that another one of their component stands for: the one of least id stays.

    Rows without shingles all stay. Of rows with equal id and equal shingles one stays.
    """
    docs = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))
    signatures, solved = _solved(docs, words, hundredths)
    # A component's row is that of its least id, and with equal ids of its least point and text.
    names = ("doc_id", "a", "b", "text_hash")
    ids = stage(signatures.where("a is not null").groupBy(*names).agg(F.count(F.lit(1)).alias("n")).join(solved.select("a", "b", "root"), ["a", "b"]), "ids")
    key = F.struct(F.col("doc_id").isNull().alias("none"), *names)
    # Of the text of a whole row, only rows that are equal in id and text may leave several here.
    first = ids.groupBy("root").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("_n"))
    decided = _of_root(ids, first).select("doc_id", "text_hash", "n", (key == F.col("first")).alias("stays"))
    judged = stage(decided.where("not stays or n > 1").select(F.col("doc_id").alias("_i"), F.col("text_hash").alias("_t"), F.col("stays").alias("_stays")), "judged")
    # Merged at every size: ids of documents don't pass through the driver. The text is shingled no more.
    rows = df.select(F.struct("*").alias("row"), df[doc_id].alias("doc_id"), _text_hash(df[text]).alias("text_hash"))
    met = rows.join(judged.hint("shuffle_merge"), F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("text_hash") == F.col("_t")), "left")
    out = met.where("_stays is null").select("row.*")
    if judged.where("_stays").limit(1).count():
        order = Window.partitionBy("doc_id", "text_hash").orderBy(F.xxhash64("row"))
        one = met.where("_stays").withColumn("nth", F.row_number().over(order)).where("nth = 1")
        out = out.unionByName(one.select("row.*"))
    return out
