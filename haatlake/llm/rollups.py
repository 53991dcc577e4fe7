"""Token counts as delta-maintained rollups.

A batch of changes is a table of signed rows: an insert counts +1, a delete -1, a revision
is a delete of the old count and an insert of the new one. A batch is summed by source,
language and tokenizer version and committed as one partition of the store, named by the
batch; totals are the sums over all partitions. Sums are additive, so batches may be
committed in any order; committing a batch again overwrites its partition with the same
sums, hence a repeated or retried commit counts once. compact() merges partitions into one
without changing totals, and keeps the names of the merged batches, which are then refused.

Edge cases: a null source, language or version is a group of its own; null counts add 0;
an empty batch commits nothing; groups whose documents and tokens are all gone drop out of
the totals; repeated rows count as often as they occur; other columns aren't read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haatlake.llm.common import stage
from haatlake.sources.staging import bounded

GROUP = ["source", "lang", "version"]
DELTAS = T.StructType([T.StructField(c, T.StringType()) for c in GROUP] + [
    T.StructField("docs", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("batch", T.StringType())])


def inserts(df: DataFrame, version: str, tokens: Column, source: str = "source", lang: str = "lang") -> DataFrame:
    """Signed rows that add each row of df with its count."""
    return df.select(df[source].cast("string").alias("source"), df[lang].cast("string").alias("lang"), F.lit(version).alias("version"),
                     F.lit(1).cast("long").alias("docs"), F.coalesce(tokens.cast("long"), F.lit(0).cast("long")).alias("tokens"))


def deletes(df: DataFrame, version: str, tokens: Column, source: str = "source", lang: str = "lang") -> DataFrame:
    """Signed rows that take each row of df, counted as before, away."""
    return inserts(df, version, tokens, source, lang).withColumns({"docs": -F.col("docs"), "tokens": -F.col("tokens")})


def revisions(df: DataFrame, old_version: str, old: Column, new_version: str, new: Column, source: str = "source", lang: str = "lang") -> DataFrame:
    """Signed rows that move each row of df from its old count to its new one, in one pass."""
    both = F.explode(F.array(
        F.struct(F.lit(old_version).alias("version"), F.lit(-1).cast("long").alias("docs"), (-F.coalesce(old.cast("long"), F.lit(0).cast("long"))).alias("tokens")),
        F.struct(F.lit(new_version).alias("version"), F.lit(1).cast("long").alias("docs"), F.coalesce(new.cast("long"), F.lit(0).cast("long")).alias("tokens"))))
    return df.select(df[source].cast("string").alias("source"), df[lang].cast("string").alias("lang"), both.alias("x")).select("source", "lang", "x.*")


class Rollup:
    """A store of committed batches at a path that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, batch: str, *changes: DataFrame) -> None:
        """Sum the signed rows and write them as this batch's partition; the same batch again counts once."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
            raise ValueError(f"a batch name of letters, digits, _ and - is needed: {batch!r}")
        base = self._base()
        if base is not None and base.where(F.array_contains("batches", batch)).limit(1).count():
            return
        rows = changes[0]
        for more in changes[1:]:
            rows = rows.unionByName(more)
        sums = rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        # The batch's folder is replaced as a whole, whatever its files.
        sums.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}")

    def _exists(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _deltas(self) -> DataFrame:
        if not self._exists("deltas"):
            return self.spark.createDataFrame([], DELTAS)
        return self.spark.read.schema(DELTAS).option("recursiveFileLookup", "true").parquet(f"{self.path}/deltas")

    def _base(self) -> DataFrame | None:
        """The last complete compaction: a batch name for every merged batch, beside the sums."""
        return self.spark.read.parquet(f"{self.path}/base") if self._exists("base/_SUCCESS") else None

    def _merged(self) -> set[str]:
        base = self._base()
        return set() if base is None else {r[0] for r in base.select(F.explode("batches")).distinct().collect()}

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer version."""
        rows, base = self._deltas(), self._base()
        if base is not None:
            merged = bounded(base.select(F.explode("batches").alias("batch")).distinct())
            rows = rows.join(merged, "batch", "left_anti").select(*GROUP, "docs", "tokens")
            rows = rows.unionByName(base.where("docs <> 0 or tokens <> 0").select(*GROUP, "docs", "tokens"))
        sums = rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Merge all committed batches into the base. Only the first compaction of a store is kept in place; later ones extend it."""
        names = sorted(self._merged() | {r[0] for r in self._deltas().select("batch").distinct().collect()})
        sums = stage(self.totals(), "totals")
        marker = self.spark.createDataFrame([(None, None, None, 0, 0, names)], "source string, lang string, version string, docs long, tokens long, batches array<string>")
        sums.withColumn("batches", F.array().cast("array<string>")).unionByName(marker).write.mode("overwrite").parquet(f"{self.path}/base")
