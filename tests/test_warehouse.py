import datetime as dt

import pytest
from pyspark.sql import functions as F

from haatlake.operators import quality, star
from haatlake.plans import tiles, views
from haatlake.sources.staging import new_path
from haatlake.sources.warehouse import Warehouse, write_jdbc


def test_no_key_is_violated(ws):
    assert [r["violations"] for r in quality.key_violations(ws.warehouse.tables()).collect()] == [0] * 7


def test_key_checks_find_violations(spark):
    fact = spark.createDataFrame([("T1", "P1"), ("T1", "P9"), ("T2", "P9")], "transaction_id string, product_id string")
    dim = spark.createDataFrame([("P1",)], "product_id string")
    assert [tuple(r) for r in quality.duplicate_keys(fact, "transaction_id").collect()] == [("T1", 2)]
    assert [tuple(r) for r in quality.orphans(fact, dim, "product_id").collect()] == [("P9", 2)]


def test_append_adds_only_new_keys(spark, ws):
    w = Warehouse(spark, new_path(spark, "w"))
    w.load(ws.cleaned.where("order_year_dt <= 2017"))
    counts = lambda df: {r[0]: r[1] for r in df.collect()}
    full = counts(w.load(ws.cleaned, truncate=False))
    assert full == counts(ws.warehouse.row_counts()) == counts(w.load(ws.cleaned, truncate=False))


def test_fact_keeps_first_row_per_id_even_if_one_id_dominates(spark):
    rows = spark.range(3000).selectExpr(
        "IF(id % 3 = 0, 'T', concat('T', id)) AS transaction_id", "'C1' AS customer_id",
        "'P1' AS product_id", "date_add(date'2020-01-01', cast(id % 50 + 1 AS int)) AS order_date_dt",
        "cast(id AS double) AS final_amount_inr")
    fact = star.build_fact_transactions(rows)
    assert fact.count() == 2001
    assert fact.where("transaction_id = 'T'").first()["order_date"] == dt.date(2020, 1, 2)
    assert fact.columns == list(star.FACT_COLUMNS)
    assert [r[0] for r in fact.select("bulk_qty").distinct().collect()] == [1]


@pytest.mark.parametrize("amount,stored", [(1e12, 1e12), (1e17, 1e17), (1e18, None)])
def test_money_beyond_its_type_becomes_null(spark, amount, stored):
    row = [("T", "C", "P", dt.date(2020, 1, 1), amount)]
    df = spark.createDataFrame(row, "transaction_id string, customer_id string, product_id string, order_date_dt date, final_amount_inr double")
    found = star.build_fact_transactions(df).first()["final_amount_inr"]
    assert found is None if stored is None else float(found) == stored


def test_customers_keep_last_known_values(spark):
    d = dt.date
    rows = [("C1", "T1", d(2020, 1, 1), "Pune", "18-25", False),
            ("C1", "T2", d(2020, 2, 1), None, "26-35", True),
            ("C1", "T3", None, "Agra", None, None), (None, "T4", d(2020, 1, 1), "Agra", None, None)]
    df = spark.createDataFrame(rows, "customer_id string, transaction_id string, order_date_dt date, customer_city string, customer_age_group string, is_prime_member boolean")
    r = star.build_dim_customers(df).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["customer_city"], r["city_tier"], r["age_group"], r["is_prime_member"]) == (
        "Pune", "Tier 1", "26-35", True)
    assert (r["first_purchase_date"], r["last_purchase_date"]) == (d(2020, 1, 1), d(2020, 2, 1))


def test_products_take_the_last_row(spark):
    rows = [("P1", "T1", "2020-01-01", "old", 1.0), ("P1", "T2", "2020-01-01", None, 2.0)]
    df = spark.createDataFrame(rows, "product_id string, transaction_id string, order_date string, brand string, rating double")
    r = star.build_dim_products(df.withColumn("order_date_dt", F.to_date("order_date"))).first()
    assert r["brand"] is None and float(r["product_rating"]) == 2.0


def test_calendar(spark):
    days = star.build_dim_time(spark.sql("SELECT date'2020-12-31' AS lo, date'2021-01-03' AS hi")).orderBy("date_id").collect()
    assert [r["date_id"] for r in days] == [20201231, 20210101, 20210102, 20210103]
    assert [r["week_of_year"] for r in days] == [53] * 4
    assert [r["is_weekend"] for r in days] == [False, False, True, True]
    assert (days[0]["month_name"], days[0]["day_of_week"], days[0]["quarter"]) == ("December", "Thursday", 4)


def test_views_by_name_and_bound_sql(spark, ws):
    names = views.register_views(ws.warehouse)
    assert len(names) == 15
    assert views.load_view(spark, "vw_kpi_summary").count() == 1
    with pytest.raises(KeyError):
        views.load_view(spark, "orders; DROP TABLE x")
    total = ws.warehouse.sql("SELECT count(*) AS n FROM fact_transactions WHERE customer_id = :c", {"c": "C1'"})
    assert total.first()["n"] == 0


def test_view_gaps_and_nulls(spark):
    d = [0.0, 0.5, 1.0, 10.0, 10.5, 20.5, 30.5, 50.0, 60.0, None]
    df = spark.createDataFrame([(v,) for v in d], "d double").select(views.discount_bucket(F.col("d")))
    assert [r[0] for r in df.collect()] == ["0%", "50%+", "1-10%", "1-10%", "50%+", "50%+", "50%+", "31-50%", "50%+", "50%+"]


def test_pages_list_known_frames(ws):
    assert len(tiles.PAGES) == 6
    for names in tiles.PAGES.values():
        assert all(n in views.VIEWS or n in tiles.TILES for n in names)
    assert set(tiles.page(ws.star(), "customer")) == set(tiles.PAGES["customer"])


def test_forecast_needs_three_years(spark, ws):
    assert tiles.forecast(ws.star((2015, 2016))).count() == 0
    out = tiles.forecast(ws.star((2015, 2018))).where("kind = 'forecast'").orderBy("year").collect()
    assert [r["year"] for r in out] == [2019, 2020, 2021]


def test_empty_frame_is_not_sent_to_a_database(spark):
    assert write_jdbc(spark.range(0), "jdbc:none:", "t", {}) is False


def test_labels(spark):
    from haatlake.functions.numbers import fixed_label, money_label, short_label

    df = spark.createDataFrame([(12345678.0,), (-250000.0,), (1500.0,), (12.4,), (0.0,), (None,)], "v double")
    got = [tuple(r) for r in df.select(
        money_label(F.col("v")), short_label(F.col("v")), fixed_label(F.col("v"), 1, "%")).collect()]
    assert got == [("₹1.23 Cr", "12.3M", "12345678.0%"), ("₹-2.50 L", "-250.0K", "-250000.0%"),
                   ("₹1.5K", "1.5K", "1500.0%"), ("₹12", "12", "12.4%"), ("₹0", "0", "0.0%"), ("₹0", "0", "N/A")]
