import pytest
from pyspark.sql import functions as F

from haatlake.sources import files
from haatlake.sources.staging import new_path


@pytest.fixture
def raw_dir(tmp_path):
    (tmp_path / "sales_2015.csv").write_text(
        "transaction_id,order_date,quantity,customer_city\nT1,01/02/2015,2,Pune\nT2,,x,Agra\n")
    (tmp_path / "sales_2016.csv").write_text(
        "customer_city,transaction_id,festival_name\nPatna,T3,Diwali\n")
    (tmp_path / "sales_2017.csv").write_bytes(
        "transaction_id,order_date,quantity,customer_city\nT4,2017-01-01,1,Orléans\n".encode("latin-1"))
    (tmp_path / "Sales_Products_Catalog.csv").write_text("product_id,launch_year\nP1,2012\nP2,bad\n")
    return str(tmp_path)


def test_year_files_align_by_name_and_tag_the_year(spark, raw_dir):
    df = files.typed(files.load_year_files(spark, raw_dir, encoding="auto"))
    rows = {r["transaction_id"]: r for r in df.collect()}
    assert set(rows) == {"T1", "T2", "T3", "T4"}
    assert rows["T1"]["quantity"] == 2 and rows["T2"]["quantity"] is None
    assert rows["T3"]["customer_city"] == "Patna" and rows["T3"]["quantity"] is None
    assert rows["T1"]["festival_name"] is None and rows["T3"]["festival_name"] == "Diwali"
    assert rows["T4"]["customer_city"] == "Orléans"
    assert {t: r["_source_year"] for t, r in rows.items()} == {
        "T1": "2015", "T2": "2015", "T3": "2016", "T4": "2017"}


def test_quotes_line_breaks_and_missing_tokens(spark, tmp_path):
    (tmp_path / "sales_2015.csv").write_text(
        'transaction_id,product_name,quantity\nT1,"a ""b"", c",1\nT2,N/A,NA\nT3,"two\nlines",3\n')
    rows = files.load_year_files(spark, str(tmp_path), multi_line=True).orderBy("transaction_id").collect()
    assert [r["product_name"] for r in rows] == ['a "b", c', None, "two\nlines"]
    assert [r["quantity"] for r in rows] == ["1", None, "3"]


def test_from_files_to_views(spark, tmp_path, ws):
    """The file route ends in the same views as the table route."""
    from haatlake.plans import registry, views
    from haatlake.plans.workspace import Workspace

    folder = registry.write_year_files(ws)
    ws.catalog.write.option("header", True).csv(f"{folder}/sales_products_catalog.csv")
    mine = Workspace.from_files(spark, folder)
    for view in (views.kpi_summary, views.category_performance, views.geographic_revenue):
        a, b = view(mine.star()), view(ws.star())
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_scratch_is_removed(spark):
    from haatlake.sources.staging import Scratch

    with Scratch(spark) as stage:
        assert stage(spark.range(3)).count() == 3
        root = stage.root
        assert files._exists(spark, root)
    assert not files._exists(spark, root)


def test_catalog_found_in_any_case(spark, raw_dir):
    rows = files.load_catalog(spark, raw_dir).orderBy("product_id").collect()
    assert [(r["product_id"], r["launch_year"]) for r in rows] == [("P1", 2012), ("P2", None)]


def test_missing_inputs_raise(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_year_files(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        files.load_catalog(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        files.read_clean(spark, str(tmp_path / "none"))


def test_row_counts_are_observed(spark, raw_dir):
    tx, catalog, seen = files.load_raw_data(spark, raw_dir)
    tx.write.format("noop").mode("overwrite").save()
    catalog.write.format("noop").mode("overwrite").save()
    assert seen["transactions"].get["row_count"] == 4 and seen["catalog"].get["row_count"] == 2


def test_clean_dataset_round_trip(spark, ws):
    path, csv = new_path(spark, "t"), new_path(spark, "t-csv")
    cleaned = ws.cleaned.drop("order_year_dt")
    files.write_clean(cleaned, path, csv)
    back = files.read_clean(spark, path)
    assert back.drop("order_year_dt").select(cleaned.columns).exceptAll(cleaned).isEmpty()
    from_csv = files.read_clean(spark, path + "-absent", csv)
    for agg in (F.count("order_date_dt"), F.count_if("is_bulk_order"), F.count("original_price_inr")):
        assert from_csv.agg(agg).first() == cleaned.agg(agg).first()


def test_header_of_the_cleaned_csv_costs_one_task(spark, tmp_path):
    """Its encoding is known, so no text is read but a first line."""
    folder = tmp_path / "clean-csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text("")
    for part in (1, 2):
        (folder / f"part-{part}.csv").write_text("transaction_id,bulk_qty,order_date_dt\n" + "".join(f"T{i},{part},2020-01-02\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20001")
    spark.sparkContext.setJobGroup("csv-header", "")
    try:
        df = files.read_clean(spark, str(tmp_path / "none"), str(folder))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    status = spark.sparkContext.statusTracker()
    stages = [s for j in status.getJobIdsForGroup("csv-header") for s in status.getJobInfo(j).stageIds]
    assert sum(status.getStageInfo(s).numTasks for s in stages) == 1
    assert df.columns == ["transaction_id", "bulk_qty", "order_date_dt"]
    assert df.groupBy("bulk_qty").count().orderBy("bulk_qty").collect() == [(1, 20_000), (2, 20_000)]
    with pytest.raises(ValueError, match="is empty"):
        (tmp_path / "empty.csv").write_text("")
        files.read_clean(spark, str(tmp_path / "none"), str(tmp_path / "empty.csv"))


def test_year_filter_prunes_partitions(ws):
    plan = ws.star((2017, 2018)).fact._jdf.queryExecution().executedPlan().toString()
    assert "order_year" in plan.split("PartitionFilters:")[1].split("]")[0]
