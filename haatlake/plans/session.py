"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.staging import FREED

# Bytes of files that a task scans, at most.
SCAN_BYTES = 64 << 20

RUNTIME = {
    # Re-plan at run time: coalesce small partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods beyond 8,000 bytes of bytecode. Wide
    # cleaning projections exceed that in one fused method and would run
    # interpreted; below the limit Spark splits them into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Columns expand about tenfold in memory: what a task scans of them must still sort without a spill.
    "spark.sql.files.maxPartitionBytes": str(SCAN_BYTES),
    **FREED,
}


# For the builder of a session; these cannot change later.
STATIC = {
    # A build and its reports compile several hundred classes. The default of
    # 100 cached ones makes a long-lived session compile, and warm up, anew.
    "spark.sql.codegen.cache.maxEntries": "2000",
}

# Input bytes per initial shuffle partition, and the most partitions to start
# with: beyond it the map x reduce block count costs more than larger partitions.
# The bytes are those of compressed columns, of which a wide row is ten to thirty times as large.
PARTITION_BYTES = 8 << 20
MAX_PARTITIONS = 40_000
UNKNOWN_BYTES = 1 << 60


def input_bytes(df: DataFrame) -> int:
    """Size of all files and tables below a frame, from the scans' own statistics.

    Sources without statistics report an absurdly large default and are left out.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN_BYTES)


def tune(spark: SparkSession, source: DataFrame | None = None) -> SparkSession:
    """Apply the runtime settings, and start shuffles with partitions that suit the source's size.

    Adaptive execution merges what turns out small, so the number only has to
    be large enough; the session's own setting is never lowered.
    """
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    if source is not None:
        wanted = min(input_bytes(source) // PARTITION_BYTES, MAX_PARTITIONS)
        start = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start))
    return spark


def spread(scan: DataFrame) -> DataFrame:
    """Use every core for a scan that has fewer row groups than there are cores.

    A large input already has more splits than cores and is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
