"""What moves: only rows that need another row leave the task that scans them."""

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from haatlake.operators import cleaning, quality, star
from haatlake.sources import files, staging
from haatlake.sources.sample_sales import catalog_raw, sales_raw
from haatlake.sources.staging import materialise

N = 3000


@pytest.fixture(scope="module")
def sales(spark):
    """Purchases of which the first 40 are 20 pairs; transaction ids repeat for 10 rows."""
    return materialise(spark.range(0, N, 1, 6).selectExpr(
        "concat('T', IF(id >= 2990, id - 10, id)) AS transaction_id", "IF(id % 97 = 5, NULL, concat('C', IF(id < 40, id div 2, id))) AS customer_id", "'P' AS product_id",
        "IF(id % 50 = 49, '31/02/2020', IF(id % 3 = 0, '2020-01-02', '05/06/2021')) AS order_date", "'books' AS category",
        "IF(id < 40, 7.0D, cast(id AS double)) AS final_amount_inr", "cast(10 + id % 3 AS string) AS original_price_inr"))


def test_rows_that_occur_once_are_written_once_only(spark, sales):
    written = []
    out = cleaning.clean_all(sales, lambda frame: written.append(materialise(frame)) or written[-1])
    plain = cleaning.clean_all(sales)
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    assert written[0].count() == N and all(frame.count() < N / 10 for frame in written[1:])


def test_facts_with_an_id_of_their_own_do_not_move(spark, sales, monkeypatch):
    routes, route = [], cleaning.routed
    monkeypatch.setattr(star, "routed", lambda *a: routes.append(route(*a)) or routes[-1], raising=False)
    cleaned = materialise(cleaning.clean_rows(sales))
    fact = star.build_fact_transactions(cleaned)
    whole = cleaned.where("order_date_dt IS NOT NULL AND customer_id IS NOT NULL")
    assert fact.count() == whole.select("transaction_id").distinct().count() == fact.select("transaction_id").distinct().count()
    least = {r[0]: r[1] for r in whole.groupBy("transaction_id").agg(F.min("order_date_dt")).collect()}
    assert {r.transaction_id: r.order_date for r in fact.collect()} == least
    assert len(routes) == 1 and routes[0].where("_again").count() < 40


def test_key_values_that_occur_once_are_not_shuffled(spark, sales, monkeypatch):
    routes, route = [], cleaning.routed
    monkeypatch.setattr(quality, "routed", lambda *a: routes.append(route(*a)) or routes[-1], raising=False)
    found = {r[0]: r[1] for r in quality.duplicate_keys(sales, "transaction_id").collect()}
    assert found == {f"T{i}": 2 for i in range(2980, 2990)}
    assert len(routes) == 1 and routes[0].where("_again").count() < 40
    # A missing key is a value that may repeat, too.
    plain = Counter(r[0] for r in sales.select("customer_id").collect())
    repeated = {r[0]: r[1] for r in quality.duplicate_keys(sales, "customer_id").collect()}
    assert repeated == {k: n for k, n in plain.items() if n > 1} and repeated[None] > 1


@pytest.mark.parametrize("file_rows, gathered", [(1, False), (100, True), (10 ** 9, True)])
def test_years_with_many_rows_are_written_where_they_lie(spark, tmp_path, file_rows, gathered):
    df = materialise(spark.range(0, 12_000, 1, 6).selectExpr(
        "id", "CASE WHEN id % 100 = 0 THEN NULL WHEN id % 100 = 1 THEN 1999 ELSE 2020 + id % 2 END AS y"))
    out = files.by_year(df, "y", df.select("y"), file_rows)
    assert ("rebalance" in out._jdf.queryExecution().analyzed().toString().lower()) == gathered
    out.write.partitionBy("y").parquet(f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, back.select("id", "y").collect())) == sorted(map(tuple, df.collect()), key=lambda r: r[0])
    if file_rows == 100:  # the two small groups are gathered
        assert all(len(list((tmp_path / "out").glob(f"y={y}/part-*"))) == 1 for y in ("1999", "__HIVE_DEFAULT_PARTITION__"))


def test_lines_do_not_move_for_customers(spark, tmp_path):
    """Without broadcasts orders are dealt by customer, not the lines."""
    from conftest import SF_DIR

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sales_raw(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(o_custkey" in line)
    below = plan[at + 1:next((i for i in range(at + 1, len(plan)) if depth(plan[i]) <= depth(plan[at])), len(plan))]
    assert any("orders.parquet" in line for line in below) and not any("lineitem.parquet" in line for line in below)


def test_winners_of_many_keys_move_alone(spark, monkeypatch):
    """With more keys than a broadcast may have, rows of other days than the deciding one aren't joined; the result is the same."""
    from haatlake.operators import winners

    df = materialise(spark.range(0, 4000, 1, 4).selectExpr(
        "IF(id % 100 = 7, NULL, id % 100) AS k", "IF(id % 13 = 0, NULL, date_add(date'2020-01-01', cast(id % 371 AS int))) AS d", "concat('T', id) AS t",
        "IF(id % 3 = 0, NULL, concat('v', id % 17)) AS v", "IF(id % 100 = 9, NULL, 'w') AS w"))
    rows = lambda frame: sorted(map(str, frame.collect()))
    last = lambda: winners.deciding_rows(df, "k", F.col("d"), [F.desc("t")], last=True)
    known = lambda: winners.last_known(df, "k", F.col("d"), F.col("t"), ["v", "w"], {"n": F.count("t")})
    few = rows(last()), rows(known())
    joined, meet = [], winners.met
    monkeypatch.setattr(winners, "fits", lambda frame, *a: False)
    monkeypatch.setattr(winners, "met", lambda left, *a, **k: joined.append(left.count()) or meet(left, *a, **k))
    assert (rows(last()), rows(known())) == few
    assert len(few[0]) == 100 and all(n < 1000 for n in joined) and len(joined) == 2


@pytest.mark.parametrize("name", ["x05_qcut", "c09_price_repair", "c08_duplicates"])
def test_raw_rows_are_not_written_for_one_pass(spark, monkeypatch, name):
    """Who reads raw rows once takes them from the input, with the columns that are needed; if they are staged, from there."""
    from conftest import SF_DIR

    from haatlake.plans import registry
    from haatlake.plans.workspace import Workspace

    fresh = Workspace.from_tables(spark, SF_DIR)
    monkeypatch.setattr(registry, "workspace", lambda *a: fresh)
    rows = lambda: sorted(map(str, registry.QUERIES[name](spark, SF_DIR).collect()))
    straight = rows()
    assert straight and "raw" not in vars(fresh)
    fresh.raw
    assert rows() == straight


@pytest.mark.parametrize("moved", [False, True])
def test_years_that_lie_together_are_written_where_they_lie(spark, tmp_path, moved):
    """A task that holds one year writes it, however many tasks there are; a few rows elsewhere don't change that."""
    ids = materialise(spark.range(0, 2400, 1, 8).selectExpr("id", "IF(id % 100 = 0, 2020, 2020 + id div 300) AS y"))
    out = files.by_year(ids, "y", ids.select("y"), 150, moved=moved)
    assert ("RebalancePartitions" in out._jdf.queryExecution().analyzed().toString()) == moved
    out.write.partitionBy("y").parquet(f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, back.select("id", "y").collect())) == sorted(map(tuple, ids.collect()))


def test_dates_are_parsed_once_and_printed_by_a_cast(spark):
    df = spark.createDataFrame([(x,) for x in ("1677-9-22", " 2262-04-10 ", "1677-9-21", "5/6/2021", "05-06-21", "32/13/2020", "2020-2-30", "", None, "x")], "order_date string")
    out = cleaning.fix_dates(df)
    assert [r.order_date for r in out.collect()] == ["1677-09-22", "2262-04-10", None, "2021-06-05", "2021-06-05", None, None, None, None, None]
    assert "date_format" not in out._jdf.queryExecution().analyzed().toString()
    assert [r.order_date_dt and r.order_date_dt.isoformat() for r in out.collect()] == [r.order_date for r in out.collect()]


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    """What a query shuffled is gone after it, and the same frame still gives its rows, twice."""
    from haatlake.plans.session import tune

    tune(spark)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f for f in manager.getAllFiles().mkString(" ").split() if "shuffle_" in f and f.endswith(".data")}
    df = spark.range(0, 5000, 1, 4).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count()
    before = held()
    df.write.parquet(f"{tmp_path}/out")
    rows = [sorted(map(tuple, df.collect())) for _ in range(2)]
    assert rows == [[(k, 500) for k in range(10)]] * 2
    for _ in range(50):  # files are removed in the background
        if held() <= before:
            break
        time.sleep(0.1)
    assert held() <= before


def test_parts_read_their_own_files(spark):
    """A filter by part leaves the scan of its files; the parts have all rows once."""
    staged = materialise(spark.range(0, 4000, 1, 8).selectExpr("id", "id % 3 AS y"))
    whole, one = staging.in_parts(staged)
    assert one == 1 and whole.columns == staged.columns
    dealt, parts = staging.in_parts(staged, 3000)
    assert 1 < parts <= 8
    seen = [dealt.where(F.col(staging.PART) == k) for k in range(parts)]
    assert sorted(r.id for f in seen for r in f.collect()) == list(range(4000))
    assert sorted(p for f in seen for p in f.inputFiles()) == sorted(staged.inputFiles())
    assert all(len(f.inputFiles()) < 8 for f in seen)


def test_cleaned_dataset_is_the_same_in_parts(spark, monkeypatch):
    """Part by part, and complete only with the last one: the rows that one write gives."""
    from conftest import SF_DIR
    from haatlake.plans import workspace

    def cleaned(part_bytes):
        written = []
        write = files.by_year
        with monkeypatch.context() as m:
            m.setattr(workspace, "in_parts", lambda df: staging.in_parts(df, part_bytes))
            m.setattr(files, "by_year", lambda *a: written.append(a) or write(*a))
            out = workspace.Workspace(spark, sales_raw(spark, SF_DIR).repartition(6), catalog_raw(spark, SF_DIR)).cleaned
        rows = Counter(map(str, out.select(sorted(out.columns)).collect()))
        return out.columns, rows, len(written)

    columns, rows, writes = cleaned(1 << 40)
    again, same, several = cleaned(60_000)
    assert writes == 1 and several > 1
    assert again == columns and same == rows and staging.PART not in columns
    # The mark of a whole dataset comes last.
    part, parts = staging.in_parts(materialise(sales_raw(spark, SF_DIR).select("transaction_id", "customer_id", F.to_date(F.lit("2020-01-02")).alias("order_date_dt")).repartition(6)), 20_000)
    path = staging.new_path(spark, "parts")
    with monkeypatch.context() as m:
        m.setattr(files, "by_year", lambda df, year, years: df if not files.is_complete(spark, path) else pytest.fail("complete before the last part"))
        files.write_clean(part, path, parts=parts)
    assert parts > 1 and files.is_complete(spark, path) and spark.read.parquet(path).count() == part.count()
