import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from haatlake.plans import explore as e


def test_shares_sum_to_hundred(ws):
    for panel, key in ((e.payment_evolution(ws.cleaned)["share"], "year"),
                       (e.prime_impact(ws.cleaned)["mix"], "prime_label"),
                       (e.customer_journey(ws.cleaned)["transitions"], "category")):
        sums = [r[0] for r in panel.groupBy(key).agg(F.sum("share_pct")).select("sum(share_pct)").collect()]
        assert sums and all(abs(s - 100) < 0.1 for s in sums)


def test_cohorts_start_at_hundred(ws):
    r = e.clv_cohort(ws.cleaned)["retention"]
    assert [x[0] for x in r.select("m00").distinct().collect()] == [100.0]
    assert len(r.columns) == 14 and r.count() <= 24


def _sales(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id string, order_date_dt date, transaction_id string, category string")


def _brute_journey(rows):
    seen, moves = {}, Counter()
    for c, d, t, cat in sorted(r for r in rows if None not in r):
        if c in seen:
            moves[seen[c], cat] += 1
        seen[c] = cat
    return moves


@pytest.mark.parametrize("partitions", [1, 8])
def test_journey_with_a_dominant_customer(spark, partitions):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        c = "HOT" if i % 3 == 0 else f"C{rng.randint(0, 40)}"
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 30))
        rows.append((c, day, f"T{i:04d}", rng.choice("ABC")))
    rows += [("C1", None, "T", "A"), ("C1", dt.date(2020, 1, 1), "T", None), (None, dt.date(2020, 1, 1), "T", "A")]
    df = _sales(spark, rows).withColumn("final_amount_inr", F.lit(1.0)).repartition(partitions)
    got = e.customer_journey(df)["transitions"].where("moves > 0").collect()
    assert {(r["category"], r["next_category"]): r["moves"] for r in got} == dict(_brute_journey(rows))


def test_rfm_of_ten_customers(spark):
    rows = [(f"C{i:02d}", dt.date(2020, 1, 1 + i), f"T{i}-{j}", "A", 100.0 * (i + 1))
            for i in range(10) for j in range(i + 1)]
    rows.append(("NODATE", None, "T", "A", 1.0))
    df = spark.createDataFrame(rows, "customer_id string, order_date_dt date, transaction_id string, category string, final_amount_inr double")
    out = {r["customer_id"]: r for r in e.rfm_segmentation(df)["scores"].collect()}
    assert len(out) == 10
    assert [out[f"C{i:02d}"]["f_score"] for i in range(10)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert (out["C09"]["score"], out["C09"]["segment"]) == (15, "Champions")
    assert (out["C00"]["score"], out["C00"]["segment"]) == (3, "Lost")
    assert out["C00"]["recency"] == 9


def test_discount_bands_are_all_listed(spark):
    df = spark.createDataFrame([(v, 10.0) for v in (0.0, 0.5, 10.0, 10.5, 100.0, 101.0, -1.0, None)],
                               "discount_percent double, final_amount_inr double")
    got = e.discount_effectiveness(df)["buckets"].orderBy("position").collect()
    assert [(r["discount_bucket"], r["orders"]) for r in got] == [
        ("0%", 1), ("1-10%", 2), ("11-20%", 1), ("21-30%", 0), ("31-50%", 0), ("50%+", 1)]
    assert got[3]["revenue"] == 0.0 and got[3]["aov"] is None


@pytest.mark.parametrize("size", [50, 5000])
def test_sample_is_deterministic_and_full(spark, size):
    df = spark.range(3000).selectExpr("concat('T', id) AS transaction_id", "id AS a", "IF(id % 10 = 0, NULL, id) AS b")
    first = e.deterministic_sample(df, ["a", "b"], size, 42).collect()
    again = e.deterministic_sample(df.repartition(9), ["a", "b"], size, 42).collect()
    assert len(first) == min(size, 2700) and sorted(first) == sorted(again)


def test_absent_columns_give_no_panels(spark):
    df = spark.createDataFrame([(1.0, dt.date(2020, 1, 1))], "final_amount_inr double, order_date_dt date")
    for analyse in (e.payment_evolution, e.category_performance, e.prime_impact, e.festival_impact,
                    e.age_groups, e.price_vs_demand, e.delivery_performance, e.returns_satisfaction,
                    e.brand_performance, e.discount_effectiveness, e.rating_patterns,
                    e.customer_journey, e.competitive_pricing):
        assert analyse(df) == {}
    with pytest.raises(KeyError):
        e.amount_column(spark.range(1))


def test_a_failing_analysis_does_not_stop_the_others(spark):
    def broken(df):
        raise ValueError("no")

    df = spark.createDataFrame([(1.0, dt.date(2020, 1, 1))], "final_amount_inr double, order_date_dt date")
    done, failed = e.run_all(df, {"bad": broken, "good": e.revenue_trend})
    assert list(done) == ["good"] and list(failed) == ["bad"]
