import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from haatlake.operators import shaping as sh


def frame(spark, values, schema="g string, v double"):
    return spark.createDataFrame(values, schema)


@pytest.mark.parametrize("seed", range(3))
def test_exact_quantiles_match_numpy(spark, seed):
    rng = random.Random(seed)
    data = {
        "mixed": [rng.gauss(0, 1e6) for _ in range(501)],
        "ties": [float(rng.randint(-2, 2)) for _ in range(300)],
        "one": [3.25], "two": [1.0, 2.0], "tiny": [rng.random() * 1e-9 for _ in range(50)],
        None: [rng.uniform(900, 1e5) for _ in range(100)],
    }
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("mixed", None), ("empty", None)]
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    out = sh.exact_quantiles(frame(spark, rows).repartition(5), ["g"], "v", probs).collect()
    assert {r["g"] for r in out} == set(data)
    for r in out:
        assert r["n"] == len(data[r["g"]])
        assert np.allclose(r["q"], np.quantile(data[r["g"]], probs), rtol=1e-12, atol=1e-18)


def test_median_without_groups(spark):
    df = frame(spark, [("a", float(i)) for i in range(10)])
    assert sh.median(df, "v").collect()[0][0] == 4.5


def test_qcut_of_seven(spark):
    df = frame(spark, [("a", float(i)) for i in range(1, 8)])
    out = sh.qcut(df, {"v": "b"}, 5).orderBy("v").collect()
    assert [r["b"] for r in out] == [1, 1, 2, 3, 4, 5, 5]


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 2.5, 10.0], [5.0] * 4, list(np.random.default_rng(1).uniform(-5, 5, 500))])
def test_histogram_matches_numpy(spark, values):
    out = sh.histogram(frame(spark, [("a", float(v)) for v in values] + [("a", None)]), "v", 7).orderBy("bin")
    counts, edges = np.histogram(values, bins=7)
    rows = out.collect()
    assert [r["n"] for r in rows] == list(counts)
    assert np.allclose([r["lower"] for r in rows], edges[:-1], atol=1e-6)


def test_histogram_of_nothing(spark):
    assert sh.histogram(frame(spark, [("a", None)]), "v", 4).count() == 0


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    r = sh.box_stats(frame(spark, [("a", v) for v in values]), "g", "v").first()
    q1, med, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert (r["q1"], r["median"], r["q3"]) == (q1, med, q3)
    assert (r["whisker_low"], r["whisker_high"]) == (1.0, 5.0)


@pytest.mark.parametrize("partitions", [1, 7])
def test_global_rank_over_a_skewed_leading_key(spark, partitions):
    """90 % of the rows share one leading key; nulls order first."""
    df = spark.range(1000).selectExpr(
        "IF(id % 10 > 0, 1, IF(id % 100 = 0, NULL, id)) AS k", "concat('c', id) AS id"
    ).repartition(partitions)
    out = sh.global_rank(df, ["k", "id"], ranges=16).collect()
    expected = sorted(((r["k"] is not None, r["k"] or 0, r["id"]) for r in out))
    ranks = {r["id"]: r["rank"] for r in out}
    assert [ranks[e[2]] for e in expected] == list(range(1, 1001))


def test_shares_of_cells(spark):
    df = spark.createDataFrame([("x", "a", 3), ("x", "b", 1), ("y", "b", 2)], "r string, c string, n int")
    out = sh.share_of(df, ["r"], "n", "p").collect()
    assert {(r["r"], r["c"]): r["p"] for r in out} == {
        ("x", "a"): 75.0, ("x", "b"): 25.0, ("y", "b"): 100.0}


def test_pct_change_and_top_k(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 15.0), (3, 0.0), (4, 1.0)], "y int, v double")
    assert [r["p"] for r in sh.pct_change(df, "y", "v", "p").orderBy("y").collect()] == [
        None, 50.0, -100.0, None]
    assert [r["y"] for r in sh.top_k(df, "v", 2, "y").collect()] == [2, 1]


def test_quantiles_of_a_narrow_range_are_spread(spark):
    """A hundred thousand values of one logarithmic bucket: a task orders a small part of them."""
    df = spark.range(100_000).selectExpr("'g' AS g", "1e9D + id AS v").repartition(4)
    q = sh.exact_quantiles(df, ["g"], "v", [0.25, 0.5])
    assert list(q.first()["q"]) == [1e9 + 24999.75, 1e9 + 49999.5]
    assert sh._PARTS >= 1000 and "_p" in q._jdf.queryExecution().optimizedPlan().toString()
