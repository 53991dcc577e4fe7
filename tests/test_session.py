from haatlake.plans import session
from haatlake.sources import staging
from conftest import SF_DIR


def test_input_bytes_sum_the_files_and_skip_unknown_sources(spark):
    import os

    path = f"{SF_DIR}/lineitem.parquet"
    scan = spark.read.parquet(path)
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "l_orderkey bigint")
    assert session.input_bytes(scan) == os.path.getsize(path)
    assert session.input_bytes(scan.join(unknown, "l_orderkey")) == os.path.getsize(path)


def test_shuffles_start_with_as_many_partitions_as_the_input_needs(spark, monkeypatch):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    scan = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    monkeypatch.setattr(session, "PARTITION_BYTES", 1000)
    session.tune(spark, scan)
    assert int(spark.conf.get(key)) == session.input_bytes(scan) // 1000
    monkeypatch.setattr(session, "PARTITION_BYTES", 128 << 20)
    session.tune(spark, scan)
    assert int(spark.conf.get(key)) == 8


def test_broadcast_only_within_the_bound(spark):
    small, large = staging.bounded(spark.range(5), 5), staging.bounded(spark.range(6), 5)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(small) and not hinted(large)


def test_folder_comes_from_the_session(spark):
    assert staging.shared_dir(spark) == spark.sparkContext.getCheckpointDir()
