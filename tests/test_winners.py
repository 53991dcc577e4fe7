"""First and last rows of keys, and last known values, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from haatlake.operators import cleaning, star, winners
from haatlake.plans import explore


def sales(seed=1, n=600):
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.15 else dt.date(2020, 1, rng.randint(1, 9))
    text = lambda xs: None if rng.random() < 0.3 else rng.choice(xs)
    rows = [(f"P{min(rng.randint(0, 30), 9)}" if rng.random() < 0.97 else None, f"C{min(rng.randint(0, 60), 40)}" if rng.random() < 0.97 else None,
             text([f"T{k}" for k in range(60)]), day(), text(["Pune", "Agra", "Delhi"]), text(["18-25", "26-35"]), rng.choice([True, False, None]), rng.choice([2015, 2016, None]))
            for _ in range(n)] + [("lost", "lost", None, None, "Pune", None, None, None)] * 3
    return rows, ("product_id string, customer_id string, transaction_id string, order_date_dt date, customer_city string, age_group string, "
                  "is_prime_member boolean, launch_year int")


def least(*values):
    """A key by which nulls are least."""
    return tuple((v is not None, v if v is not None else 0) for v in values)


@pytest.mark.parametrize("few", [True, False])
def test_customers(spark, monkeypatch, few):
    if not few:  # nothing is broadcast whole; keys of more than 20 rows are hot
        monkeypatch.setattr(winners, "fits", lambda df: df.count() < 12)
        monkeypatch.setattr(winners.met, "__defaults__", (20, True))
    rows, schema = sales()
    got = {r.customer_id: (r.customer_city, r.age_group, r.is_prime_member, r.first_purchase_date, r.last_purchase_date)
           for r in star.build_dim_customers(spark.createDataFrame(rows, schema).repartition(5)).collect()}
    want = {}
    for c in {r[1] for r in rows} - {None}:
        mine = [r for r in rows if r[1] == c]
        last = lambda k: max(((least(r[3], r[2], r[k]), r[k]) for r in mine if r[k] is not None), default=(0, None))[1]  # noqa: E731, B023
        days, member = [r[3] for r in mine if r[3]], [r[6] for r in mine if r[6] is not None]
        want[c] = (last(4), last(5), any(member) if member else None, min(days, default=None), max(days, default=None))
    assert got == want


@pytest.mark.parametrize("few", [True, False])
def test_products_and_launches(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(winners, "fits", lambda df: df.count() < 4)
        monkeypatch.setattr(winners.met, "__defaults__", (60, True))
    rows, schema = sales(7)
    df = spark.createDataFrame(rows, schema).repartition(5)
    state = {r.product_id: (r.latest["at"]["day"], r.latest["at"]["id"]) for r in star.product_state(df).collect()}
    assert state == {p: (lambda r: (r[3], r[2]))(max((r for r in rows if r[0] == p), key=lambda r: least(r[3], r[2]))) for p in {r[0] for r in rows} - {None}}
    hashes = {r["launch_year"]: r["h"] for r in df.select("launch_year", F.xxhash64("launch_year").alias("h")).distinct().collect()}
    years = {}
    for p in {r[0] for r in rows}:
        first = min((r for r in rows if r[0] == p), key=lambda r: (r[3] is None, r[3] or dt.date.max, r[2] is None, r[2] or "", hashes[r[7]]))
        years[first[7]] = years.get(first[7], 0) + 1
    panel = explore.product_lifecycle(df.withColumn("final_amount_inr", F.lit(1.0)))["launches"]
    assert {r.launch_year: r.products for r in panel.collect()} == {y: n for y, n in years.items() if y is not None}


def test_no_rows_are_sorted_by_key_in_an_aggregate(spark, ws):
    catalog = ws.catalog
    for df in (star.product_state(ws.cleaned), star.customer_state(ws.cleaned), cleaning.enrich_from_catalog(ws.cleaned.drop("launch_year", "model"), catalog),
               explore.product_lifecycle(ws.cleaned)["launches"]):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan or "Window" in plan and "SortAggregate" not in plan


def test_one_key_of_a_third_of_all_rows(spark):
    """The hot product's and customer's rows stay in their tasks until their deciding day is known."""
    df = spark.range(0, 300_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 'P', concat('P', id % 900)) AS product_id", "IF(id % 3 = 0, 'C', concat('C', id % 900)) AS customer_id", "concat('T', id) AS transaction_id",
        "date_add(date'2020-01-01', cast(id % 365 AS int)) AS order_date_dt", "IF(id < 100, 'Pune', NULL) AS customer_city")
    assert star.build_dim_products(df).count() == star.build_dim_customers(df).count() == 601
    assert star.build_dim_customers(df).where("customer_id = 'C'").first()["customer_city"] == "Pune"


def test_empty_frames(spark):
    df = spark.createDataFrame([], sales()[1])
    assert star.build_dim_customers(df).count() == 0 and star.build_dim_products(df).count() == 0
