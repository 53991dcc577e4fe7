"""Inputs on which results used to be lost, stale or swapped."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from haatlake.operators import cleaning, shaping, star
from haatlake.plans import explore
from haatlake.plans.workspace import Workspace
from haatlake.sources import files
from haatlake.sources.staging import new_path
from haatlake.sources.warehouse import Warehouse

SALE = ("transaction_id string, customer_id string, product_id string, order_date_dt date, final_amount_inr double, "
        "customer_city string, product_name string")


def sales(spark, rows):
    return spark.createDataFrame(rows, SALE)


@pytest.mark.parametrize("seed", range(4))
def test_sample_has_its_size_whatever_the_ids(spark, seed):
    df = spark.range(5_000).selectExpr(
        "IF(id % 3 = 0, 'T1', NULL) AS transaction_id", "'C1' AS customer_id", "id * 1.5D AS price", "'a' AS category")
    assert explore.deterministic_sample(df, ["price", "category"], 700, seed).count() == 700
    assert explore.deterministic_sample(df.limit(50), ["price", "category"], 700, seed).count() == 50


def test_large_amounts_are_kept_and_misfits_counted(spark):
    day = dt.date(2020, 1, 5)
    df = sales(spark, [("T1", "C1", "P1", day, 2.5e10, "Pune", "a"), ("T2", "C1", "P1", day, 1e25, "Pune", "a")])
    warehouse = Warehouse(spark, new_path(spark, "wide"))
    warehouse.load(df)
    amounts = {r[0]: r[1] for r in warehouse.table("fact_transactions").select("transaction_id", "final_amount_inr").collect()}
    assert float(amounts["T1"]) == 2.5e10 and amounts["T2"] is None
    assert warehouse.misfits == {"final_amount_inr": 1}


def test_first_copy_has_an_id(spark):
    day = dt.date(2020, 1, 5)
    df = sales(spark, [(f"T{i}" if i else None, "C1", "P1", day, 10.0, "Pune", "a") for i in range(7)]).withColumn("order_date", F.lit("2020-01-05"))
    kept = cleaning.handle_duplicates(df)
    assert [(r.transaction_id, r.bulk_qty) for r in kept.collect()] == [("T1", 7)]
    assert star.build_fact_transactions(kept).count() == 1


def test_append_merges_dimensions(spark):
    row = lambda t, y, city, name: (t, "C1", "P1", dt.date(y, 1 if y < 2021 else 3, 5), 10.0, city, name)
    early, later = sales(spark, [row("T1", 2020, "Pune", "old")]), sales(spark, [row("T0", 2019, "Agra", "older"), row("T2", 2021, "Delhi", "new")])
    merged, whole = Warehouse(spark, new_path(spark, "merged")), Warehouse(spark, new_path(spark, "whole"))
    merged.load(early)
    for _ in range(2):
        merged.load(later, truncate=False)
    whole.load(early.unionByName(later))
    for name in merged.tables():
        rows = lambda w: sorted(map(str, w.table(name).select(*sorted(w.table(name).columns)).collect()))  # noqa: E731, B023
        assert rows(merged) == rows(whole), name
    customer = merged.table("dim_customers").first()
    assert (customer.customer_city, str(customer.first_purchase_date), str(customer.last_purchase_date)) == ("Delhi", "2019-01-05", "2021-03-05")
    assert merged.table("dim_products").first().product_name == "new"


def test_headers_that_differ_within_a_folder_raise(spark, tmp_path):
    folder = tmp_path / "sales_2020.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("transaction_id,customer_id\nT1,C1\n")
    (folder / "b.csv").write_text("customer_id,transaction_id\nC2,T2\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.load_year_files(spark, str(tmp_path)).collect()


def test_latin_1_by_default(spark, tmp_path):
    (tmp_path / "sales_2020.csv").write_bytes("transaction_id,city\nT1,Orléans\n".encode("latin-1"))
    (tmp_path / "sales_2021.csv").write_bytes("transaction_id,city\nT2,Orléans\n".encode())
    assert {r.city for r in files.load_year_files(spark, str(tmp_path)).collect()} == {"Orléans"}


def test_implausible_years(spark):
    df = spark.createDataFrame([("0202-03-01",), ("9999-12-31",), ("01/01/0001",), ("2262-04-10",), ("1700-01-01",)], "order_date string")
    assert [r.order_date for r in cleaning.fix_dates(df).collect()] == [None, None, None, "2262-04-10", "1700-01-01"]


def test_building_panels_runs_no_job(spark, ws):
    cleaned = ws.cleaned
    spark.sparkContext.setJobGroup("panels", "")
    try:
        panels = {name: analyse(cleaned) for name, analyse in explore.ANALYSES.items()}
        assert sum(map(len, panels.values())) > 30
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("panels")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_value_that_fails_at_run_time_is_isolated(spark):
    df = spark.range(3)
    analyses = {"bad": lambda d: explore.Panels({"x": d.select(F.raise_error(F.lit("no")).alias("e"))}), "good": lambda d: explore.Panels({"y": d})}
    seen = []
    done, failed = explore.run_all(df, analyses, lambda a, p, frame: seen.append((a, frame.collect())))
    assert list(done) == ["good"] and list(failed) == ["bad"] and len(seen) == 1


def test_sums_do_not_depend_on_the_order(spark):
    values = [9e13 + 0.25, -9e13, 0.1, 0.2, 1e12 + 0.5, -1e12, 0.45] * 3
    for order in (values, values[::-1], sorted(values)):
        got = spark.createDataFrame([(v,) for v in order], "v double").coalesce(1).agg(explore.total("v")).first()[0]
        assert got == pytest.approx(3 * 1.5, abs=1e-9)


def test_rank_bucket_equals_ranks(spark):
    rows = [(f"c{i:04d}", i % 5) for i in range(1003)]
    df = spark.createDataFrame(rows, "id string, n int")
    want, order = {}, sorted(rows, key=lambda r: (r[1], r[0]))
    for rank, (i, _) in enumerate(order):
        want[i] = next(b for b in range(1, 6) if b == 5 or rank + 1 <= (len(rows) - 1) * b / 5 + 1)
    got = {r[0]: r[1] for r in df.select("id", shaping.rank_bucket(df, "n", "id", 5)).collect()}
    assert got == want


def test_named_outputs_are_opened_again(spark, ws, tmp_path):
    raw, out = ws.raw.limit(300), f"file://{tmp_path}/out"
    first = Workspace(spark, raw, ws.catalog, out)
    rows, counts = first.cleaned.count(), sorted(map(tuple, first.warehouse.row_counts().collect()))
    assert first.report().count() > 10
    again = Workspace(spark, raw.where("false"), ws.catalog, out)
    assert again.cleaned.count() == rows and sorted(map(tuple, again.warehouse.row_counts().collect())) == counts
