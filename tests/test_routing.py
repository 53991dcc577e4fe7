"""Rows without a second one stay where they are; correlations from one pass of sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from haatlake.operators import cleaning
from haatlake.plans import explore
from haatlake.sources.staging import materialise


@pytest.mark.parametrize("words", [1 << 20, 1])
def test_filter_of_any_size_gives_the_same(spark, monkeypatch, words):
    """With one word nearly every row is a false hit."""
    monkeypatch.setattr(cleaning, "FILTER_WORDS", words)
    rows = [(f"T{i}", f"C{i % 50}" if i % 7 else None, f"P{i % 3}", "2020-01-01" if i % 5 else None, 10.0 if i % 2 else None) for i in range(400)]
    rows += [(f"S{i}", f"single{i}", "P", "2020-01-01", 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, product_id string, order_date string, final_amount_inr double")
    got = {(r.transaction_id): (r.is_bulk_order, r.bulk_qty) for r in cleaning.handle_duplicates(df.repartition(6), bulk_threshold=3).collect()}
    groups = {}
    for r in rows:
        groups.setdefault(r[1:], []).append(r[0])
    want = {}
    for key, ids in groups.items():
        if key[0] is None:
            want |= {i: (False, 1) for i in ids}
        else:
            want |= {i: (len(ids) > 1, len(ids)) for i in (sorted(ids) if len(ids) <= 3 else sorted(ids)[:1])}
    assert got == want


def test_only_repeated_rows_are_shuffled_whole(spark):
    n = 40_000
    df = materialise(spark.range(0, n, 1, 8).selectExpr(
        "concat('T', id) AS transaction_id", "concat('C', IF(id < 2000, id div 2, id)) AS customer_id", "'P' AS product_id", "'2020-01-01' AS order_date",
        "1.0D AS final_amount_inr", "repeat(sha2(cast(id AS string), 256), 8) AS wide"))
    routed = cleaning.routed(df.withColumn("_h", F.xxhash64(*cleaning.DUPLICATE_KEY)), df.select(F.xxhash64(*cleaning.DUPLICATE_KEY).alias("_h")).groupBy("_h").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1"), "_h")
    assert routed.where("_again").count() == pytest.approx(2000, abs=60)
    out = cleaning.handle_duplicates(df)
    assert out.where("bulk_qty = 2").count() == 2000 and out.count() == n

    tracker = spark._jsc.sc().statusStore()
    before = {s.stageId() for s in _stages(tracker)}
    out.write.format("noop").mode("overwrite").save()
    written = sum(s.shuffleWriteBytes() for s in _stages(tracker) if s.stageId() not in before)
    assert written < 0.3 * n * 512


def _stages(store):
    stages = store.stageList(None, False, False, spark_doubles(store), None)
    return [stages.apply(i) for i in range(stages.size())]


def spark_doubles(store):
    from pyspark import SparkContext

    gateway = SparkContext._gateway
    return gateway.new_array(gateway.jvm.double, 0)


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_correlations_equal_numpy(spark, offset):
    """Pairwise complete, with gaps of all kinds, a constant column, and an offset that a plain sum of squares would not survive."""
    rng = np.random.default_rng(4)
    n = 3000
    a = rng.normal(size=n)
    data = np.stack([a + offset, 2 * a + rng.normal(size=n) + offset, rng.normal(size=n) - offset, np.full(n, 7.0), -a + offset], 1)
    gaps = rng.random(data.shape) < 0.2
    rows = [tuple(None if g else float(v) for v, g in zip(r, gs)) for r, gs in zip(data, gaps)]
    names = ["a", "b", "c", "flat", "e"]
    out = explore.correlations(spark.createDataFrame(rows, ", ".join(f"{x} double" for x in names)).repartition(7), names)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.var_x, r.var_y): r.r for r in out.collect()}
    assert len(got) == 25
    for i, x in enumerate(names):
        for j, y in enumerate(names):
            both = ~gaps[:, i] & ~gaps[:, j]
            if "flat" in (x, y):
                assert got[x, y] is None
            else:
                assert got[x, y] == pytest.approx(np.corrcoef(data[both, i], data[both, j])[0, 1], abs=6e-5)


def test_correlations_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, None)], "a double, b double")
    assert all(r.r is None for r in explore.correlations(df, ["a", "b"]).collect())
