import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from haatlake.operators import cleaning as c


def one(spark, op, col, values, out=None):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {col} string")
    return [r[0] for r in op(df).orderBy("i").select(out or col).collect()]


def test_dates(spark):
    raw = ["2015-01-25", " 13/02/2015 ", "05/01/2015", "5/1/2015", "07-03-15", "32/13/2020", "",
           "2015-01-25x", None]
    d = dt.date
    assert one(spark, c.fix_dates, "order_date", raw, "order_date_dt") == [
        d(2015, 1, 25), d(2015, 2, 13), d(2015, 1, 5), d(2015, 1, 5), d(2015, 3, 7),
        None, None, None, None]
    assert one(spark, c.fix_dates, "order_date", ["13/02/2015", "x"]) == ["2015-02-13", None]


def test_prices(spark):
    raw = ["₹1,23,456.78", "Price on Request", "Rs. 500", "1 000", " 99 ", "12d", "", None]
    assert one(spark, c.fix_prices, "original_price_inr", raw) == [
        123456.78, None, None, None, 99.0, None, None, None]


def test_ratings(spark):
    raw = ["5.0", "4 stars", "3/5", "8/10", "2.5/5.0", "7/8", "6", "0.5", "3/0", "1.2.3/5", ".",
           "nan", "None", "", None]
    assert one(spark, c.fix_ratings, "customer_rating", raw) == [
        5.0, 4.0, 3.0, 4.0, 2.5, 4.38] + [None] * 9


def test_cities(spark):
    raw = ["Bangalore/Bengaluru", " BOMBAY ", "hydrabad", "o'neil-x", "Delhi|Noida", "nan", "", "none"]
    assert one(spark, c.fix_cities, "customer_city", raw) == [
        "Bengaluru", "Mumbai", "Hyderabad", "O'Neil-X", "Delhi", None, None, None]


def test_booleans(spark):
    raw = ["Y", "1", "True", " yes ", "1.0", "t", "N", "0", "False", "no", "0.0", "f", "maybe", None]
    assert one(spark, c.fix_booleans, "is_prime_member", raw) == [True] * 6 + [False] * 6 + [None] * 2


def test_categories(spark):
    raw = ["ELECTRONICS", " Home and Kitchen ", "pet care", "3d prints", "nan", ""]
    assert one(spark, c.fix_categories, "category", raw) == [
        "Electronics", "Home & Kitchen", "Pet Care", "3D Prints", None, None]


def test_delivery_days(spark):
    raw = ["Same Day", "1-2 days", "5 days", "-3", "45", "0", "3.5", "30", "soon", "", None]
    assert one(spark, c.fix_delivery_days, "delivery_days", raw) == [
        0.0, 1.5, 5.0, None, None, 0.0, 3.5, 30.0, None, None, None]


def test_payment_methods(spark):
    raw = ["PhonePe/GooglePay", "CC", "c.o.d.", "bnpl", "Net Banking", ""]
    assert one(spark, c.fix_payment_methods, "payment_method", raw) == [
        "UPI", "Credit Card", "Cash on Delivery", "Bnpl", "Net Banking", None]


@pytest.mark.parametrize("op", [
    c.fix_dates, c.fix_prices, c.fix_ratings, c.fix_cities, c.fix_booleans, c.fix_categories,
    c.fix_delivery_days, c.fix_payment_methods, c.handle_duplicates, c.fix_price_outliers])
def test_absent_column_leaves_input_alone(spark, op):
    df = spark.createDataFrame([(1,)], "unrelated int")
    assert op(df).columns == ["unrelated"]


def test_row_cleaners_are_idempotent(ws):
    once = c.fix_payment_methods(c.clean_rows(ws.raw))
    twice = c.fix_payment_methods(c.clean_rows(once)).select(once.columns)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_large_numeric_prices_pass_through(spark):
    df = spark.createDataFrame([(12345678.5,)], "original_price_inr double")
    assert c.fix_prices(df).first()[0] == 12345678.5


def _purchases(spark, groups):
    rows = [(f"T{g}-{i:05d}", g if g.startswith("C") else None, "P1", "2020-01-01", 10.0)
            for g, n in groups.items() for i in range(n)]
    return spark.createDataFrame(
        rows, "transaction_id string, customer_id string, product_id string, order_date string, "
              "final_amount_inr double")


@pytest.mark.parametrize("partitions", [1, 8])
def test_duplicates(spark, partitions):
    df = _purchases(spark, {"C1": 1, "C3": 3, "C5": 5, "C7": 7, "anon": 9}).repartition(partitions)
    out = c.handle_duplicates(df)
    got = {(r[0], r[1], r[2], r[3]) for r in out.groupBy("customer_id", "is_bulk_order", "bulk_qty")
           .agg(F.count("*")).collect()}
    assert got == {("C1", False, 1, 1), ("C3", True, 3, 3), ("C5", True, 5, 5), ("C7", True, 7, 1),
                   (None, False, 1, 9)}
    assert out.where("customer_id = 'C7'").first()["transaction_id"] == "TC7-00000"


def test_duplicates_of_identical_rows_and_hot_group(spark):
    """A third of the input is one repeated row; anonymous copies all survive."""
    same = spark.range(4000).selectExpr(
        "'T' AS transaction_id", "'C' AS customer_id", "'P' AS product_id",
        "'2020-01-01' AS order_date", "1D AS final_amount_inr")
    anon = same.withColumn("customer_id", F.lit(None).cast("string"))
    rest = spark.range(4000).selectExpr(
        "concat('T', id)", "concat('C', id)", "'P'", "'2020-01-01'", "1D")
    out = c.handle_duplicates(same.union(anon).union(rest))
    assert out.count() == 1 + 4000 + 4000
    assert out.where("bulk_qty = 4000").count() == 1


def test_duplicate_plan_limits_before_the_shuffle_and_joins_without_one(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = _purchases(spark, {"C1": 2})
        plan = c.handle_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # By the groups' key: the rows and their counts. The other exchanges are those of the filter of repeated keys.
    by_key = re.findall(r"Exchange hashpartitioning\(_h#\d+L, _k#", plan)
    assert ", Partial" in plan and len(by_key) == 2


def test_price_repair(spark):
    rows = [("A", 1000.0 + i) for i in range(12)] + [("A", 100000.0), ("A", 10.0), ("A", None)]
    rows += [("B", 5.0)] * 8 + [("B", 5000.0)] + [(None, 200.0)] * 10 + [(None, 20000.0)]
    df = spark.createDataFrame(rows, "category string, original_price_inr double")
    fixed = c.fix_price_outliers(df).where("price_was_corrected").collect()
    assert sorted((r["category"] or "", r["original_price_inr"]) for r in fixed) == [
        ("", 200.0), ("A", 1000.0), ("A", 1000.0)]
    whole = c.fix_price_outliers(df.drop("category"))
    assert whole.columns == ["original_price_inr", "price_was_corrected"]
    assert whole.count() == df.count()


def test_price_repair_without_usable_median(spark):
    df = spark.createDataFrame([("A", 0.0)] * 12 + [("A", 7.0)], "category string, original_price_inr double")
    assert c.fix_price_outliers(df).where("price_was_corrected").isEmpty()


def test_catalog_join_keeps_rows(spark):
    sales = spark.createDataFrame([("P1", "x"), ("P2", "y"), (None, "z")], "product_id string, brand string")
    catalog = spark.createDataFrame(
        [("P1", "a", 1), ("P1", "b", 2), ("P9", "c", 3)], "product_id string, brand string, w int")
    out = c.enrich_from_catalog(sales, catalog)
    assert out.columns == ["product_id", "brand", "w"]
    assert sorted(map(tuple, out.collect()), key=str) == [("P1", "x", 1), ("P2", "y", None), (None, "z", None)]


def test_catalog_beyond_broadcast_bound_gives_the_same(spark, monkeypatch):
    from haatlake.sources import staging

    sales = spark.range(50).selectExpr("concat('P', id) AS product_id")
    catalog = spark.range(30).selectExpr("concat('P', id) AS product_id", "id AS w")
    small = c.enrich_from_catalog(sales, catalog)
    monkeypatch.setattr(c, "fits", lambda df: staging.fits(df, 5))
    large = c.enrich_from_catalog(sales, catalog)
    assert "BROADCAST" not in large._jdf.queryExecution().analyzed().toString().upper()
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_clean_shape(ws):
    """35 raw columns, 44 cleaned, no row multiplied by the catalog join."""
    cleaned = ws.cleaned.drop("order_year_dt")
    assert len(ws.raw.columns) == 35 and len(cleaned.columns) == 44
    assert cleaned.count() == c.handle_duplicates(c.clean_rows(ws.raw)).count()
