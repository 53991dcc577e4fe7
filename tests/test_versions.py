"""Versions of a warehouse: joint-load results, loads that fail, readers that stay at theirs."""

import datetime as dt
import itertools
import random

import pytest

from haatlake.sources import warehouse as module
from haatlake.sources.staging import new_path
from haatlake.sources.warehouse import TABLES, Warehouse

SALE = "transaction_id string, customer_id string, product_id string, order_date_dt date, final_amount_inr double, customer_city string, product_name string"


def sale(t, y, amount=10.0, customer="C1", product="P1", city="Pune", name="a"):
    return (t, customer, product, dt.date(y, 1, 5), amount, city, name)


def content(w):
    return {t: sorted(str(sorted(r.asDict().items(), key=str)) for r in w.table(t).collect()) for t in TABLES}


def warehouse(spark, *loads):
    w = Warehouse(spark, new_path(spark, "versions"))
    for k, rows in enumerate(loads):
        w.load(spark.createDataFrame(rows, SALE), truncate=k == 0)
    return w


def test_a_transaction_of_two_years_is_where_a_joint_load_has_it(spark):
    late, early = [sale("T1", 2021, 10.0), sale("T2", 2021)], [sale("T1", 2020, 20.0)]
    for first, second in ((late, early), (early, late)):
        assert content(warehouse(spark, first, second)) == content(warehouse(spark, late + early))
    w = warehouse(spark, late, early)
    fact = {r.transaction_id: (r.order_year, float(r.final_amount_inr)) for r in w.table("fact_transactions").collect()}
    assert fact == {"T1": (2020, 20.0), "T2": (2021, 10.0)} and str(w.table("dim_customers").first().first_purchase_date) == "2020-01-05"


@pytest.mark.parametrize("seed", range(3))
def test_any_sequence_of_loads_is_a_joint_load(spark, seed):
    rng = random.Random(seed)
    rows = [sale(f"T{rng.randint(0, 25)}", rng.randint(2018, 2021), float(rng.randint(1, 3)), f"C{rng.randint(0, 3)}", f"P{rng.randint(0, 3)}",
                 rng.choice(["Pune", "Agra", None]), rng.choice(["a", "b", None])) for _ in range(45)]
    cuts = sorted(rng.sample(range(1, 44), 2))
    parts = [rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] :]]
    assert content(warehouse(spark, *parts, parts[0])) == content(warehouse(spark, rows))


def test_a_year_that_loses_its_only_row_is_gone(spark):
    w = warehouse(spark, [sale("T1", 2021), sale("T2", 2019)], [sale("T1", 2018)])
    assert sorted(r.order_year for r in w.table("fact_transactions").collect()) == [2018, 2019]


def test_only_changed_years_are_written(spark):
    w = warehouse(spark, [sale("T1", 2019), sale("T2", 2020), sale("T3", 2021)])
    before = dict(w._manifest["fact_transactions"])
    w.load(spark.createDataFrame([sale("T4", 2020)], SALE), truncate=False)
    after = w._manifest["fact_transactions"]
    assert {y for y in after if after[y] != before.get(y)} == {"2020"}
    w.load(spark.createDataFrame([sale("T4", 2020)], SALE), truncate=False)
    assert w._manifest["fact_transactions"] == after


class Stopped(Exception):
    pass


def test_a_load_that_stops_anywhere_is_invisible(spark, monkeypatch):
    """The n-th step that would change something on disk fails, for every n; the old state is there, and a later load works."""
    from pyspark.sql import DataFrameWriter

    old, new = [sale("T1", 2020), sale("T2", 2021)], [sale("T1", 2019, 5.0), sale("T3", 2021, city="Delhi")]
    path = new_path(spark, "stopped")
    Warehouse(spark, path).load(spark.createDataFrame(old, SALE))
    want = content(Warehouse(spark, path))
    parquet, publish = DataFrameWriter.parquet, Warehouse._publish

    def stops_at(n):
        steps = itertools.count()

        def write(self, target, *args, **kwargs):
            if target.startswith(path) and next(steps) == n:
                raise Stopped
            return parquet(self, target, *args, **kwargs)

        def switch(self, manifest):
            if next(steps) == n:
                raise Stopped
            publish(self, manifest)

        monkeypatch.setattr(DataFrameWriter, "parquet", write)
        monkeypatch.setattr(Warehouse, "_publish", switch)

    failed = 0
    for n in itertools.count():
        stops_at(n)
        try:
            Warehouse(spark, path).load(spark.createDataFrame(new, SALE), truncate=False)
        except Stopped:
            failed += 1
            assert content(Warehouse(spark, path)) == want
        else:
            break
    monkeypatch.undo()
    assert failed == 7  # six tables and the switch
    assert content(Warehouse(spark, path)) == content(warehouse(spark, old + new))


def test_readers_stay_at_their_version_and_vacuum_frees_old_ones(spark):
    w = warehouse(spark, [sale("T1", 2020)])
    reader = Warehouse(spark, w.path)
    w.load(spark.createDataFrame([sale("T2", 2020, name="z")], SALE), truncate=False)
    assert reader.table("fact_transactions").count() == 1 and Warehouse(spark, w.path).table("fact_transactions").count() == 2
    assert w.versions() == [1, 2] and Warehouse(spark, w.path, version=1).table("fact_transactions").count() == 1
    want = content(w)
    assert w.vacuum() == 6 and w.versions() == [2] and w.vacuum() == 0
    assert content(Warehouse(spark, w.path)) == want


def test_two_writers_of_one_version(spark):
    w = warehouse(spark, [sale("T1", 2020)])
    other = Warehouse(spark, w.path)
    w.load(spark.createDataFrame([sale("T2", 2020)], SALE), truncate=False)
    with pytest.raises(RuntimeError, match="written by someone else"):
        other.load(spark.createDataFrame([sale("T3", 2020)], SALE), truncate=False)
    assert Warehouse(spark, w.path).table("fact_transactions").count() == 2


def test_misfits_count_only_rows_that_come_in(spark):
    w = warehouse(spark, [sale("T1", 2020)])
    w.load(spark.createDataFrame([sale("T1", 2021, 1e25), sale("T2", 2021, 1e25)], SALE), truncate=False)
    assert w.misfits == {"final_amount_inr": 1}


def test_nothing_loaded(spark):
    w = Warehouse(spark, new_path(spark, "none"))
    assert w.version == 0 and w.versions() == []
    with pytest.raises(FileNotFoundError):
        w.table("dim_time")
    w.load(spark.createDataFrame([], SALE), truncate=False)
    assert w.table("fact_transactions").count() == 0 and w.version == 1
    w.load(spark.createDataFrame([sale("T1", 2020)], SALE), truncate=False)
    assert w.table("fact_transactions").count() == 1 and module.FACT in w.tables()
