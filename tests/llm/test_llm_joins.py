"""Jaccard join, nearest neighbours, shards, rollups and the pipeline against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from haatlake.llm import ann, common, jaccard, rollups, sharding
from haatlake.llm.components import components
from haatlake.sources.staging import new_path

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").encode().translate(LOWER))
    return frozenset(zip(words, words[1:], words[2:])) if len(words) >= 3 else frozenset([tuple(words)] if words else [])


def brute_components(rows):
    """component_id of each row of (id, text), by all pairs."""
    sets, part = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and part[i] != part[j] and 100 * len(a & sets[j]) >= 90 * len(a | sets[j]):
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    least = {}
    for p, (i, _) in zip(part, rows):
        if i is not None:
            least[p] = min(least.get(p, i), i)
    return [(i, len(s), least.get(p)) for p, (i, _), s in zip(part, rows, sets)]


def texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    out = ["", None, "one", "One", "two words", "two  words", "a b c", "a b c", "\x1c x", "Ä ä b", "x\x0by\x0cz"]
    shared = [rng.choice(vocabulary) for _ in range(60)]
    for family in range(8):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([10, 11, 12, 30, 80, 200]))] + (shared if family % 2 else [])
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy += [rng.choice(vocabulary)]
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("region", [1_000, 4])
def test_jaccard_equals_all_pairs(spark, monkeypatch, region):
    monkeypatch.setattr(jaccard, "REGION", region)  # 4: regions are joined block by block
    monkeypatch.setattr(jaccard, "MEETING", region)
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts(region), 1)] + [(3, "w1 w2 w3"), (3, "w1 w2 w3")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, a string, cell int")
    got = sorted(map(tuple, jaccard.jaccard_components(df).collect()), key=str)
    assert got == sorted(brute_components(rows), key=str)


def test_jaccard_of_families_in_large_regions(spark, monkeypatch):
    """A family around a base, whose members are linked through the base alone, and one apart."""
    monkeypatch.setattr(jaccard, "REGION", 16)
    base, rng = [f"b{k}" for k in range(150)], random.Random(4)
    rows = [(500, " ".join(base))]
    for i in range(60):
        copy = list(base)
        for at in rng.sample(range(150), 3 + i % 3):
            copy[at] = f"e{i}x{at}"
        rows.append((i, " ".join(copy)))
    rows += [(600 + i, " ".join(base[:75] + [f"z{k}" for k in range(75 - i % 2)])) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.jaccard_components(df).collect())) == sorted(brute_components(rows))


def five(rows):
    """Kept ids by 5-word shingles and a similarity of 0.8, by all pairs."""
    sets = []
    for _, t in rows:
        words = WORD.findall((t or "").encode().translate(LOWER))
        sets.append(frozenset(zip(*(words[k:] for k in range(5)))) if len(words) >= 5 else frozenset([tuple(words)] if words else []))
    part = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and part[i] != part[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    return sorted(min(i for p, (i, _) in zip(part, rows) if p == q) for q in set(part))


@pytest.mark.parametrize("region", [1_000, 4])
def test_pipeline_joins_by_five_words_at_80(spark, monkeypatch, region):
    import corpus_pipeline

    monkeypatch.setattr(jaccard, "REGION", region)
    monkeypatch.setattr(jaccard, "MEETING", region)
    base, rows = [f"b{k}" for k in range(100)], list(enumerate(texts(region + 1)))
    two = [f"r{k}" if k in (30, 70) else w for k, w in enumerate(base)]
    rows += [(1000, " ".join(base)), (1001, " ".join(two)), (1002, " ".join(base + [f"x{k}" for k in range(15)]))]
    for n in range(5, 15):  # sets of 1 to 10 shingles, and one shingle more: alike from 4 of 5 on
        rows += [(1100 + 2 * n, " ".join(f"s{n}x{k}" for k in range(n))), (1101 + 2 * n, " ".join(f"s{n}x{k}" for k in range(n + 1)))]
    got = sorted(r.doc_id for r in corpus_pipeline.jaccard_join(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect())
    assert got == five(rows)
    assert 1000 in got and not {1001, 1002} & set(got)
    assert {1115, 1117} & set(got) == {1115} and 1113 in got


def test_wanted_sets_are_joined_and_not_collected(spark, monkeypatch):
    """Names of points stay off the driver, and what a full filter lets through is left to the join."""
    kind, told = type(spark.range(0)), []
    collect = kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda self: (told.append(self.columns), collect(self))[1])
    rows = [(i, t) for i, t in enumerate(texts(5), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    level = jaccard._levels(docs)
    points, owner = {}, {}
    for (i, _), s in zip(rows, jaccard.shingle_sets([t or "" for _, t in rows], 3, level)):
        if s.size >= 9:
            points[jaccard._point(s)] = s
            owner.setdefault(jaccard._point(s), i)  # ids ascend
    chosen = [(a, b, k, 2, owner[a, b]) for k, (a, b) in enumerate(points) if k % 3 == 0]
    wanted = spark.createDataFrame(chosen, "a long, b long, cell long, points long, doc_id long")
    for bits in (common.FILTER, 64):
        monkeypatch.setattr(common, "FILTER", bits)
        owned = common.bit_filter(wanted.select(jaccard._owned("a", "doc_id").alias("owned")), "owned")
        assert owned.size == bits // 64
        got = jaccard._sets(docs, wanted, spark.sparkContext.broadcast((level, owned)), 3, 9).collect()
        assert sorted((r.a, r.b, r.cell, r.points) for r in got) == sorted(c[:4] for c in chosen)
        assert all(r.set == points[r.a, r.b].view(np.int64).tolist() for r in got)
    assert told and not any({"a", "b"} & set(c) for c in told)


def test_copies_reach_a_region_once(spark):
    """Four hundred copies of two texts in two hundred partitions: two points with keys, and two sets, are dealt."""
    base = [f"c{k}" for k in range(60)]
    two = " ".join(base), " ".join(base[:-1] + ["z"])
    docs = spark.createDataFrame([(i, two[i % 2]) for i in range(400)], "doc_id long, text string").repartition(200)
    level = jaccard._levels(docs)
    signatures = jaccard._signatures(docs, level, 3, 90)
    points = jaccard._points(signatures)
    assert signatures.where("keys is not null").count() > 100 and points.count() == 2
    wanted = signatures.where("a is not null").groupBy("a", "b").agg(F.min("doc_id").alias("doc_id")).withColumns({"cell": F.lit(1).cast("long"), "points": F.lit(2).cast("long")})
    held = spark.sparkContext.broadcast((level, common.bit_filter(wanted.select(jaccard._owned("a", "doc_id").alias("owned")), "owned")))
    assert jaccard._sets(docs, wanted, held, 3, 9).count() == 2
    got = jaccard.jaccard_components(docs).select("component_id").distinct().collect()
    assert [r.component_id for r in got] == [0]


def test_one_of_each_of_rows_that_repeat_an_id(spark):
    """Equal id and shingles, with equal and with other text: one row stays."""
    rows = [(1, "a b c d e f"), (1, "a  b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A b c d e f"), (3, ""), (3, "")]
    got = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == [1, 3, 3]


def test_jaccard_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(df).count() == 0 and jaccard.one_of_each(df).count() == 0
    df = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.jaccard_components(df).collect())) == [(1, 0, 1), (2, 0, 2)]


def test_region_links_connect_what_all_links_connect():
    rng = np.random.default_rng(1)
    for _ in range(20):
        base = rng.choice(1000, 60, replace=False)
        sets = [np.unique(np.r_[base[rng.random(60) > 0.05], rng.choice(1000, 2)]) for _ in range(25)]
        linked = lambda a, b: 100 * np.intersect1d(a, b).size >= 90 * np.union1d(a, b).size
        part, want = list(range(25)), list(range(25))
        for i, j in jaccard.region_links(sets):
            assert linked(sets[i], sets[j])
            part = [part[i] if p == part[j] else p for p in part]
        for i in range(25):
            for j in range(i):
                if linked(sets[i], sets[j]):
                    want = [want[i] if p == want[j] else p for p in want]
        groups = lambda ps: {frozenset(k for k, p in enumerate(ps) if p == q) for q in ps}
        assert groups(part) == groups(want)


def test_one_of_each(spark):
    rows = [(i, t) for i, t in enumerate(texts(9), 1)] + [(500, "w1 w2 w3"), (500, "w1 w2 w3"), (None, "q r s t"), (90, "q r s t"), (91, None)]
    df = spark.createDataFrame([(*r, "x", k) for k, r in enumerate(rows)], "doc_id long, text string, row string, a int")
    got = jaccard.one_of_each(df).collect()
    kept = [(r.doc_id, r.text) for r in got]
    assert got[0]["row"] == "x" and len({r.a for r in got}) == len(got)
    empty = lambda found: sorted((k for k in found if not shingles(k[1])), key=str)
    assert empty(kept) == empty(rows)
    want = brute_components(rows)
    groups = {c for (_, n, c) in want if n}
    assert len([k for k in kept if shingles(k[1])]) == len(groups) and {k[0] for k in kept if shingles(k[1])} == groups


def test_components_of_long_chains(spark):
    links = [(f"{i:03d}", f"{i + 1:03d}") for i in range(0, 120) if i % 40 != 39] + [("x", "x"), ("000", "001")]
    got = dict(map(tuple, components(spark.createDataFrame(links, "u string, v string")).collect()))
    assert all(root == f"{int(node) // 40 * 40:03d}" for node, root in got.items()) and len(got) == 120 + 0
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_components_end_with_stars_or_an_error(spark, monkeypatch):
    monkeypatch.setattr("haatlake.llm.components.CONTRACTED", 1)
    links = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(40)], "u string, v string")
    with pytest.raises(RuntimeError):
        components(links, rounds=2)
    assert {root for _, root in map(tuple, components(links).collect())} == {"000"}


def brute_nearest(x, ids, queries, k):
    for row in queries:
        score = x @ x[row]
        order = [o for o in np.lexsort((ids, -score)) if o != row][:k]
        yield row, order, score


@pytest.mark.parametrize("block", [8_192, 150])
def test_nearest_neighbours(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "SCAN", 64)
    rng = np.random.default_rng(block)
    x = rng.normal(size=(1500, 24)).astype(np.float32) * rng.uniform(0.5, 2, (1500, 1)).astype(np.float32)
    x[700:800] = x[20]  # copies: ties to the smaller id
    df = spark.createDataFrame([(i, v.tolist(), "c") for i, v in enumerate(x)], "vec_id long, embedding array<float>, list string")
    got = {}
    for r in ann.search(df, df["vec_id"] % 20 == 0, k=10).collect():
        got.setdefault(r.query_id, []).append(r)
    x, ids, right = x.astype(np.float64), np.arange(1500), 0
    for row, order, score in brute_nearest(x, ids, range(0, 1500, 20), 10):
        mine = sorted(got[row], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all(r.score == pytest.approx(score[r.vec_id], abs=1e-12) for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        right += len({r.vec_id for r in mine} & set(order))
    assert right / (75 * 10) >= 0.9


def test_nearest_neighbours_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (20, [2.0, 1.0]), (3, None), (40, []), (60, [0.0, 0.0]), (80, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (8, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in ann.search(df, df["vec_id"] % 20 == 0).orderBy("query_id", "rank").collect()]
    assert [(q, r, v, s) for q, r, v, s in got if q == 0] == [(0, 1, 20, 5.0), (0, 2, None, 5.0), (0, 3, 20, 4.0), (0, 4, 8, 0.0)]
    assert len([1 for q, *_ in got if q == 20]) == 8 and {q for q, *_ in got} == {0, 20}
    assert ann.search(df.limit(0), df["vec_id"] % 20 == 0).count() == 0
    assert ann.search(df.where("vec_id = 0"), df["vec_id"] % 20 == 0).count() == 0


def test_vectors_of_several_lengths_and_doubles(spark):
    """Each length is searched among its own; scores of doubles are exact, whatever their size."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=(2, 5, 9)[i % 3]) * 10.0 ** (40 * (i % 2))).tolist()) for i in range(600)] + [(600, [1.0]), (620, [1.0, 2.0, 3.0, 4.0]), (7, [0.1, 0.1, 0.1, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(df, df["vec_id"] % 20 == 0, k=5).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    right = total = 0
    for q, x in [(i, v) for i, v in rows if i % 20 == 0]:
        scores = sorted(((-float((np.array(x) * np.array(v)).sum()), i) for i, v in rows if len(v) == len(x) and i != q))[:5]
        assert len(got.get(q, [])) == len(scores)
        score = {i: -s for s, i in scores}
        right, total = right + sum(i in score for i, _ in got.get(q, [])), total + len(scores)
        assert all(s == pytest.approx(score[i], rel=1e-12) for i, s in got.get(q, []) if i in score)
    assert right / total >= 0.9 and 600 not in got and got[620] == [(7, pytest.approx(1.0))]


def test_worst_queries_of_clusters(spark):
    """Forty clusters: on the whole, and for nearly every query, the true neighbours are found."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16)) * 3
    x = (centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 0.5).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, df["vec_id"] % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    x, share = x.astype(np.float64), []
    for q in range(0, 4000, 20):
        score = x @ x[q]
        score[q] = -np.inf
        share.append(len(got[q] & set(np.argsort(-score)[:20].tolist())) / 20)
    assert np.mean(share) >= 0.95 and (np.array(share) >= 0.5).mean() >= 0.97


def test_shards_fit(spark):
    rows = [(i % 3, "x" * (i % 50), "keep") for i in range(2000)] + [(None, None, "keep"), (9, "y" * 5000, "keep")] + [(1, "same", "keep")] * 700
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = sharding.shard(df, limit=1000).toPandas()
    sums = got.groupby("shard").agg(b=("bytes", "sum"), n=("bytes", "size"), told=("shard_bytes", "max"), over=("over", "max"))
    assert len(got) == len(rows) and (sums.b == sums.told).all()
    assert (sums.b[~sums.over] <= 1000).all() and sums.over.sum() == 1 and (sums.n[sums.over] == 1).all()
    # Only buckets that were too large were split: two halves of one bucket exceed the limit together.
    halves = {}
    for name, b in sums.b.items():
        bits, at = name.split("/")
        halves.setdefault((bits, int(at, 16) // 2), []).append(b)
    assert all(sum(v) > 1000 for v in halves.values() if len(v) == 2)
    assert sharding.shard(df.limit(0)).count() == 0


def test_written_shards(spark):
    df = spark.createDataFrame([(i, "t" * 40) for i in range(200)], "doc_id long, text string")
    back = sharding.write_shards(df, new_path(spark, "shards"), limit=1000)
    named = back.select("shard", "text", F.input_file_name().alias("file"))
    shards = named.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("b"), F.count_distinct("file").alias("f"))
    assert back.count() == 200 and shards.count() > 5 and shards.where("b > 1000 or f > 1").count() == 0


def test_rollups(spark):
    df = spark.createDataFrame([("s", "en", "a b c"), ("s", None, "a"), ("s", "en", None), (None, "fr", "x y")], "source string, lang string, text string")
    count = F.size(F.split("text", " "))
    store = rollups.Rollup(spark, new_path(spark, "rollup"))
    totals = lambda: sorted(map(tuple, store.totals().collect()), key=str)
    assert totals() == []
    for _ in range(2):  # a repeated commit counts once
        store.commit("b1", rollups.inserts(df, "v1", count))
    want = [("s", "en", "v1", 2, 3), ("s", None, "v1", 1, 1), (None, "fr", "v1", 1, 2)]
    assert totals() == sorted(want, key=str)
    store.commit("b2", rollups.revisions(df, "v1", count, "v2", count * 2))
    store.commit("b3", rollups.deletes(df.where("lang = 'fr'"), "v2", count * 2))
    want = sorted([("s", "en", "v2", 2, 6), ("s", None, "v2", 1, 2)], key=str)
    assert totals() == want
    store.compact()
    assert totals() == want
    store.commit("b2", rollups.revisions(df, "v1", count, "v2", count * 2))
    store.commit("b4", rollups.inserts(df.where("lang = 'fr'"), "v2", count))
    store.compact()
    assert totals() == sorted([*want, (None, "fr", "v2", 1, 2)], key=str)
    store.commit("b5", rollups.inserts(df.limit(0), "v2", count))
    assert len(totals()) == 3
    with pytest.raises(ValueError):
        store.commit("no/name", rollups.inserts(df, "v1", count))


def test_points_of_a_large_region_are_compared(spark, monkeypatch):
    """Sixty texts that share their rarest shingles, and nothing else but two that are linked, don't hang together."""
    monkeypatch.setattr(jaccard, "MEETING", 8)
    rows = [(i, " ".join(["a b c"] + [f"w{i}x{k}" for k in range(60)])) for i in range(60)]
    rows.append((60, rows[59][1] + " z"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    level = jaccard._levels(docs)
    points = jaccard._points(jaccard._signatures(docs, level, 3, 90))
    # All points in one region, whatever shingles they share.
    regions = points.select(F.lit(1).cast("long").alias("cell"), "a", "b")
    found = {r.u for r in components(jaccard._groups(regions, points, 90)).select(F.col("node").alias("u")).collect()}
    linked = points.join(jaccard._signatures(docs, level, 3, 90).where("doc_id >= 59").select("a", "b"), ["a", "b"])
    assert found == {r.u for r in linked.select(jaccard._named("a", "b").alias("u")).collect()} and len(found) == 2
    got = sorted(map(tuple, jaccard.jaccard_components(docs).collect()))
    assert got == sorted(brute_components(rows))


def test_sides_are_compared_with_each_other_alone():
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(60, 20, replace=False)).astype(np.int64) for _ in range(12)]
    keys = [sets[i % 12] for i in range(48)]
    n = np.full(48, 20)
    side = np.arange(48) % 5 == 0
    part = list(range(48))
    for i, j in jaccard.meeting(keys, n, 90, side):
        assert side[i] != side[j] and np.intersect1d(keys[i], keys[j]).size >= 8
        part = [part[i] if p == part[j] else p for p in part]
    for i in range(48):
        for j in range(i):
            if side[i] != side[j] and np.intersect1d(keys[i], keys[j]).size >= 8:
                assert part[i] == part[j]
