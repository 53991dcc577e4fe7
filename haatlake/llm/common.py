"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haatlake.sources.staging import FREED, materialise

# Characters handled at a time inside a task, so that memory doesn't follow the batch size.
BLOCK_CHARS = 700_000
# Bits of the filter by which tasks drop most of what isn't wanted.
FILTER = 1 << 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared checkpoint folder and read back; cuts lineage, survives lost executors. What it shuffled is freed."""
    for key, value in FREED.items():
        df.sparkSession.conf.set(key, value)
    return materialise(df, name)


def _release() -> None:
    """Return freed memory to the system: a worker stays after its task, beside others of its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def text_blocks(batches: Iterator[pa.RecordBatch], text: str, chars: int = BLOCK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Record batches cut to about so many characters, each with its texts (null: empty)."""
    for batch in batches:
        at, column = 0, batch.column(text)
        while at < batch.num_rows:
            texts, size = [], 0
            while at + len(texts) < batch.num_rows and size < chars:
                value = column[at + len(texts)].as_py() or ""
                texts.append(value)
                size += len(value)
            yield batch.slice(at, len(texts)), texts
            at += len(texts)
    _release()


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows of equal key as one table. The input is sorted by key; the caller bounds a key's rows."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        values = keys.to_pylist()
        start = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or values[i] != values[start]:
                if held and values[start] != last:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(start, i - start))
                last = values[start]
                start = i
    if held:
        yield pa.Table.from_batches(held)
        held = []
    _release()


def spare(df: DataFrame, name: str) -> str:
    """The name, or a longer one if df has a column of that name."""
    while name in df.columns:
        name = f"_{name}"
    return name


def small_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Arrow batches of fewer rows, as whole documents travel in them; a number set by the user stays."""
    name, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if spark.conf.get(name, default) == default:
        spark.conf.set(name, str(rows))


def with_text(df: DataFrame, kept: list[str], text: str) -> tuple[DataFrame, str]:
    """The kept columns and the text, which travels once, and the name it has."""
    if text in kept:
        return df.select(*kept), text
    hidden = spare(df, "_text")
    return df.select(*kept, df[text].alias(hidden)), hidden


def bit_filter(wanted: DataFrame, column: str) -> np.ndarray:
    """FILTER bits, made by Spark: a bit is set if the lowest bits of some wanted number name it. Its size is fixed."""
    at = F.col(column).bitwiseAND(F.lit(FILTER - 1))
    words = (wanted.select(F.shiftright(at, 6).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())  # at most FILTER / 64 rows
    bits = np.zeros(FILTER // 64, np.int64)
    bits[words["at"].to_numpy()] = words["bits"].to_numpy()
    return bits


def in_filter(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether the bit that each 64-bit number names is set."""
    at = (numbers & np.uint64(bits.size * 64 - 1)).astype(np.int64)
    return (bits[at >> 6] >> (at & 63)) & 1 != 0


def in_bucket(column: str, modulus: int, remainder: int) -> F.Column:
    """Whether crc32 of the id as text has the remainder; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus == remainder


def per_worker(cache: dict, key, build: Callable):
    """A value built once in each worker process."""
    if key not in cache:
        cache[key] = build()
    return cache[key]
