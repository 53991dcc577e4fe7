"""Sequences of rows against plain Python."""

from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from haatlake.operators import sequences
from haatlake.operators.sequences import followers
from haatlake.plans import explore


@pytest.mark.parametrize("ranges", [1, 5, 60, 400])
def test_followers_equal_plain_python(spark, ranges):
    """Keys of one row, of several ranges, and of rows that tie; ranges of one row and empty ones."""
    rows = [(f"k{min(i % 97, 40)}" if i % 3 else "hot", i % 7, f"t{(i * 31) % 50}" if i % 4 else None, "abcde"[(i * i) % 5]) for i in range(700)] + [("alone", 1, "t", "z")]
    rows += rows[:40]
    want, last = Counter(), {}
    for k, d, t, v in sorted(rows, key=lambda r: (r[0], r[1], r[2] is not None, r[2] or "", r[3])):
        if k in last:
            want[last[k], v] += 1
        last[k] = v
    df = spark.createDataFrame(rows, "k string, d int, t string, value string").repartition(7)
    got = {(r.value, r.next_value): r.n for r in followers(df, "k", ["d", "t"], "value", ranges=ranges).collect()}
    assert got == want


def test_nothing_follows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, d int, v string")
    assert followers(df, "k", ["d"], "v").count() == 0 and followers(df.limit(0), "k", ["d"], "v").count() == 0


def test_one_customer_day_spreads(spark):
    """A third of a million rows are of one customer and day; no range has twice the rows of the median one."""
    df = spark.range(0, 1_000_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 'C', concat('C', id % 5000)) AS customer_id", "IF(id % 3 = 0, date'2020-01-05', date_add(date'2020-01-01', cast(id % 900 AS int))) AS order_date_dt",
        "concat('T', id) AS transaction_id", "concat('k', id % 9) AS category", "1.0D AS final_amount_inr")
    laid = sequences.numbered(df, ["customer_id", "order_date_dt", "transaction_id"], 40).groupBy(sequences.range_of_place().alias("r"))
    sizes = [r["n"] for r in laid.agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 35 and max(sizes) <= 2 * median(sizes)
    moves = explore.customer_journey(df)["transitions"].agg(F.sum("moves")).first()[0]
    assert moves == 1_000_000 - df.select("customer_id").distinct().count()
