"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage, is scanned column by column by whoever reads it,
and outlives lost executors. The folder is the session's checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast side must have at most so many rows and bytes. Checked, not assumed.
BROADCAST_ROWS, BROADCAST_BYTES = 250_000, 64 << 20
# Of written tables: a quarter to a third fewer bytes than the default.
CODEC = "zstd"
# Shuffle files go when the query that wrote them ends, not when the driver happens to collect garbage. Who runs the same
# frame's plan again makes them anew.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory; a temporary one only on a local master."""
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="haatlake-"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/haatlake/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df once to the shared folder and return a scan of it. The application owns it: it is removed at its end."""
    path = new_path(df.sparkSession, name)
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    df.write.option("compression", CODEC).parquet(path)
    folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Of a staged table, bytes of files that one part of the work on it takes, and parts at most.
PART_BYTES, MAX_PARTS = 2 << 30, 32
PART = "_part"


def in_parts(staged: DataFrame, part_bytes: int | None = None) -> tuple[DataFrame, int]:
    """A staged table whose files are dealt to parts of about so many bytes, and the number of parts.

    With several parts the table has the column PART. A filter by it reads the files of that part alone, so that who writes part
    by part shuffles, and holds on disk, a part at a time. A table of one part is returned as it is.
    """
    files = sorted(map(unquote, staged.inputFiles()))
    size = int(str(staged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = min(-(-size // (part_bytes or PART_BYTES)), MAX_PARTS, len(files))
    if parts <= 1:
        return staged, 1
    # A literal for each part: the optimizer drops the scans that a filter rules out.
    scans = [staged.sparkSession.read.schema(staged.schema).parquet(*files[k::parts]).withColumn(PART, F.lit(k)) for k in range(parts)]
    out = scans[0]
    for scan in scans[1:]:
        out = out.unionByName(scan)
    return out, parts


class Scratch:
    """Stages for one piece of work, removed when the block ends.

        with Scratch(spark) as stage:
            result = stage(df) ...   # write the result inside the block
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, new_path(spark, "scratch")

    def __enter__(self) -> Scratch:
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{uuid.uuid4().hex[:12]}"
        df.write.option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *exc: object) -> None:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        root.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(root, True)


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether df has at most so many rows, and bytes as text. Reads at most max_rows + 1 rows."""
    size = F.octet_length(F.to_json(F.struct("*")))
    n, total = df.select(size.alias("b")).limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum("b")).first()
    return n <= max_rows and (total or 0) <= max_bytes


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if, and only if, df fits.

    Call it on a table that is cheap to read (a file scan or a staged table).
    Beyond the bound the plain frame is returned and the join shuffles.
    """
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
