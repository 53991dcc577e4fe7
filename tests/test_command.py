"""The command line, layout of written tables, and owners of stages."""

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from haatlake.__main__ import arguments, run
from haatlake.plans.workspace import Workspace
from haatlake.sources.files import write_clean
from haatlake.sources.warehouse import Warehouse

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def write_raw(ws, folder, years):
    for y in years:
        ws.raw.where(F.col("_source_year") == y).drop("_source_year").coalesce(1).write.option("header", True).csv(f"{folder}/sales_{y}.csv")
    ws.catalog.coalesce(1).write.option("header", True).csv(f"{folder}/sales_products_catalog.csv")


def facts(w):
    return sorted((r.transaction_id, str(r.order_date), r.customer_id) for r in w.table("fact_transactions").collect())


def test_all_steps_then_append_then_replace(spark, ws, tmp_path):
    years = sorted(r[0] for r in ws.raw.select("_source_year").distinct().collect() if r[0])
    first, more, out = f"file://{tmp_path}/first", f"file://{tmp_path}/more", f"file://{tmp_path}/out"
    write_raw(ws, first, years[:3])
    write_raw(ws, more, years[3:])
    done = run(spark, ["all", "--raw", first, "--out", out])
    assert not done["failed"] and len(done["analyses"]) == 20 and len(done["views"]) == 15
    assert spark.read.parquet(f"{out}/explore/e01_revenue_trend/yearly").count() >= 1
    assert spark.read.json(f"{out}/report").where("section = 'missing_after'").count() > 40
    assert Workspace.from_files(spark, first, out_dir=out).warehouse.version == 1
    added = run(spark, ["load", "--raw", more, "--out", out, "--append"])["rows"]
    assert added["fact_transactions"] > done["rows"]["fact_transactions"]
    whole = Warehouse(spark, f"file://{tmp_path}/whole")
    from haatlake.operators.cleaning import clean_all, enrich_from_catalog
    from haatlake.sources.files import load_raw_data
    parts = [enrich_from_catalog(clean_all(load_raw_data(spark, f)[0]), ws.catalog) for f in (first, more)]
    whole.load(parts[0].unionByName(parts[1], allowMissingColumns=True))
    assert facts(Warehouse(spark, f"{out}/warehouse")) == facts(whole)
    again = run(spark, ["load", "--raw", first, "--out", out, "--replace"])["rows"]
    assert again == done["rows"] and Warehouse(spark, f"{out}/warehouse").version == 3


def test_arguments():
    assert arguments(["all", "--raw", "a", "--out", "b"]).prefix == "sales_"
    with pytest.raises(SystemExit):
        arguments(["load", "--raw", "a", "--out", "b", "--append", "--replace"])


def test_report_names_what_did_not_fit(spark, ws):
    raw = ws.raw.limit(60).withColumn("final_amount_inr", F.when(F.col("transaction_id").isNotNull(), F.lit(1e25)))
    found = Workspace(spark, raw, ws.catalog).report().where("section = 'misfits'").collect()
    assert [(r.column, r.metric) for r in found] == [("final_amount_inr", "values")] and int(found[0].value) > 0


def rows_read(df):
    df.write.format("noop").mode("overwrite").save()
    rows, plan = 0, [df._jdf.queryExecution().executedPlan()]
    df.collect()
    while plan:
        node = plan.pop()
        if "Scan" in node.nodeName():
            rows += node.metrics().apply("numOutputRows").value()
        children = node.children()
        plan += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            plan.append(node.executedPlan())
    return rows


def test_files_prune_by_month_and_customer(spark, tmp_path):
    """One year of rows in random order: a month's rows, and a day's customer, lie in few pages of a file."""
    n = 200_000
    df = spark.range(0, n, 1, 8).selectExpr("concat('T', id) AS transaction_id", "concat('C', pmod(xxhash64(id), 5000)) AS customer_id",
                                            "date_add(date'2020-01-01', cast(pmod(xxhash64(id, 1), 365) AS int)) AS order_date_dt", "1.0D AS final_amount_inr",
                                            "'P' AS product_id")
    path = f"file://{tmp_path}/clean"
    write_clean(df, path)
    back = spark.read.parquet(path)
    month = back.where("order_date_dt BETWEEN date'2020-03-01' AND date'2020-03-31'").select("customer_id", "order_date_dt")
    assert month.count() == df.where("month(order_date_dt) = 3").count()
    assert 0 < rows_read(month) < n / 3 and back.select("order_year_dt").distinct().count() == 1
    w = Warehouse(spark, f"file://{tmp_path}/w")
    w.load(df)
    fact = w.table("fact_transactions").where("order_date = date'2020-03-05'").select("customer_id")
    assert 0 < rows_read(fact) < n / 3


def test_stages_go_with_the_application(tmp_path):
    code = textwrap.dedent(f"""
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
        from haatlake.sources.staging import materialise
        import os
        assert materialise(spark.range(5)).count() == 5
        assert any(f.endswith(".parquet") for _, _, fs in os.walk("{tmp_path}/shared") for f in fs)
        spark.stop()
    """)
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=180)
    assert not any(f.endswith(".parquet") for _, _, fs in os.walk(f"{tmp_path}/shared") for f in fs)
