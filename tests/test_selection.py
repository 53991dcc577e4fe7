"""Rows at ranks of an order, against sorted lists."""

import pytest
from pyspark.sql import functions as F

from haatlake.operators import shaping
from haatlake.operators.selection import select_ranks


@pytest.mark.parametrize("most", [500_000, 40])
@pytest.mark.parametrize("unique", [True, False])
def test_ranks_of_odd_rows(spark, most, unique):
    """Nulls are least; rows that repeat, negative numbers, and text whose order isn't that of numbers."""
    rows = [(None if i % 11 == 0 else (i * 37) % 23 - 9, None if i % 13 == 0 else f"{(i * 91) % 300}") for i in range(1200)] + [(3, "7")] * 500
    df = spark.createDataFrame(rows, "n int, r0 string").repartition(6)
    least = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    ordered = sorted(rows, key=least)
    ranks = [1, 2, 111, 600, 601, 1000, 1699, 1700, 1701, 0]
    got = select_ranks(df, ["n", "r0"], ranks, most=most, unique=unique)
    assert got == {r: ordered[r - 1] for r in ranks if 1 <= r <= 1700}


def test_no_rows(spark):
    assert select_ranks(spark.createDataFrame([], "a int"), ["a"], [1]) == {}
    df = spark.createDataFrame([], "a int, b string")
    assert df.select(shaping.rank_bucket(df, "a", "b", 5)).count() == 0


@pytest.mark.parametrize("tie,kind", [("id", "long"), ("concat('c', id)", "text"), ("id div 4", "repeated"), ("-id * 0.5D", "double")])
def test_buckets_of_a_million_ties(spark, tie, kind):
    """One value for all rows: buckets go by the tie, in the order of its own type."""
    n = 1_000_000
    df = spark.range(0, n, 1, 8).selectExpr("7 AS v", f"{tie} AS t").cache()
    counts = {r["b"]: (r["n"], r["lo"], r["hi"]) for r in df.withColumn("b", shaping.rank_bucket(df, "v", "t", 5)).groupBy("b").agg(
        F.count(F.lit(1)).alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).collect()}
    df.unpersist()
    assert [counts[b][0] for b in range(1, 6)] == [n // 5] * 5
    assert all(counts[b][2] < counts[b + 1][1] for b in range(1, 5))


def test_one_job_narrows_for_all_ranks(spark):
    """The number of jobs doesn't follow the number of ranks."""
    df = spark.range(20_000).selectExpr("id % 3 AS v", "id AS t").cache()
    df.count()

    def jobs(ranks):
        group = f"ranks-{len(ranks)}"
        spark.sparkContext.setJobGroup(group, "")
        try:
            assert len(select_ranks(df, ["v", "t"], ranks, most=300, unique=True)) == len(ranks)
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    few, many = jobs([5, 9000]), jobs([1 + 400 * k for k in range(45)])
    df.unpersist()
    assert abs(few - many) <= 6


def test_missing_values_have_no_bucket(spark):
    df = spark.createDataFrame([(None, "a"), (1, None), (1, "b"), (2, "c"), (2, None)], "v int, t string")
    got = {(r.v, r.t): r.b for r in df.withColumn("b", shaping.rank_bucket(df, "v", "t", 2)).collect()}
    assert got == {(None, "a"): None, (1, None): 1, (1, "b"): 1, (2, None): 2, (2, "c"): 2}
