"""Raw CSV scans and the cleaned dataset's sink and scan."""

from __future__ import annotations

import fnmatch
import re
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocabulary as vocab
from ..plans.session import SCAN_BYTES, input_bytes
from .inventory import Source, header_of, inventory
from .staging import CODEC, PART

# Columns of the raw files that are numbers already; everything else stays text.
MEASURES = {
    "discount_percent": "double", "discounted_price_inr": "double", "subtotal_inr": "double",
    "delivery_charges": "double", "final_amount_inr": "double", "quantity": "bigint",
    "order_month": "bigint", "order_year": "bigint", "order_quarter": "bigint",
    "product_weight_kg": "double", "product_rating": "double", "base_price_2015": "double",
    "weight_kg": "double", "rating": "double", "launch_year": "int",
}
CATALOG_MARK = "products_catalog"
# A task writes a file of its own for a year of which it has about so many rows or more: several pages, whose statistics prune by day.
FILE_ROWS = 100_000


def list_paths(spark: SparkSession, directory: str, pattern: str) -> list[str]:
    """Entries of a directory matching a case-insensitive file name pattern, sorted."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    hit = [n for n in names if fnmatch.fnmatch(n.lower(), pattern.lower())]
    return [f"{directory.rstrip('/')}/{n}" for n in sorted(hit)]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _reader(spark: SparkSession, encoding: str, multi_line: bool = False) -> DataFrameReader:
    """Quotes inside quoted fields are doubled, as CSV files have them.

    Each file's header is held against the schema: files of one folder whose headers differ
    raise an error instead of swapping columns.
    """
    return (
        spark.read.option("header", True).option("enforceSchema", False).option("encoding", encoding).option("escape", '"')
        .option("multiLine", multi_line)
    )


def _scan(
    spark: SparkSession, paths: list[str], encoding: str, columns: list[str],
    multi_line: bool = False,
) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return _reader(spark, encoding, multi_line).schema(schema).csv(paths)


def _missing_as_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({
        c: F.when(~F.col(f"`{c}`").isin(vocab.MISSING_TOKENS), F.col(f"`{c}`")) for c in columns
    })


def typed(df: DataFrame) -> DataFrame:
    """Cast the measure columns explicitly; text that is no number becomes NULL."""
    present = {c: F.col(c).try_cast(t) for c, t in MEASURES.items() if c in df.columns}
    return df.withColumns(present)


def load_year_files(
    spark: SparkSession, raw_dir: str, prefix: str = "sales_", encoding: str = "auto",
    multi_line: bool = False,
) -> DataFrame:
    """All <prefix><year>.csv files (or folders), as one frame with `_source_year`.

    Columns absent from a file are NULL. Files with the same header form one
    scan, so the plan has as many branches as there are distinct headers.
    Headers and encodings of all files are found by two jobs. encoding="auto" falls back to latin-1
    for files that aren't valid UTF-8; a named encoding is taken as it is.
    multi_line=True admits line breaks inside quoted fields, at the price that
    a file can no longer be split between tasks.
    """
    paths = [p for p in list_paths(spark, raw_dir, f"{prefix}*.csv")
             if CATALOG_MARK not in p.rsplit("/", 1)[-1].lower()]
    if not paths:
        raise FileNotFoundError(f"no {prefix}*.csv in {raw_dir}")
    scans: dict[tuple[str, ...], list[str]] = {}
    for source in inventory(spark, paths, encoding):
        scans.setdefault((source.encoding, *source.header), []).append(source.path)
    if not scans:
        raise ValueError(f"all {prefix}*.csv in {raw_dir} are empty")
    year = F.regexp_extract(
        F.col("_metadata.file_path"), re.escape(prefix) + r"([^/]*)\.csv(?:/[^/]*)?$", 1
    )
    frames = [
        _missing_as_null(
            _scan(spark, group, enc, header, multi_line).withColumn("_source_year", year), header)
        for (enc, *header), group in scans.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _one(spark: SparkSession, path: str, encoding: str) -> Source:
    found = inventory(spark, [path], encoding)
    if not found:
        raise ValueError(f"{path} is empty")
    return found[0]


def load_catalog(
    spark: SparkSession, raw_dir: str, prefix: str = "sales_", encoding: str = "auto"
) -> DataFrame:
    """<prefix>products_catalog.csv, else the first file with such a name in any case."""
    exact = f"{raw_dir.rstrip('/')}/{prefix}{CATALOG_MARK}.csv"
    if not _exists(spark, exact):
        found = list_paths(spark, raw_dir, f"*{CATALOG_MARK}*.csv")
        if not found:
            raise FileNotFoundError(f"no product catalog in {raw_dir}")
        exact = found[0]
    source = _one(spark, exact, encoding)
    header = list(source.header)
    return typed(_missing_as_null(_scan(spark, [exact], source.encoding, header), header))


def load_raw_data(
    spark: SparkSession, raw_dir: str, prefix: str = "sales_", encoding: str = "auto",
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame, dict[str, Observation]]:
    """Transactions and catalog. The observations hold their row counts once an action ran."""
    seen = {"transactions": Observation(), "catalog": Observation()}  # without names, which two loads would share
    count = F.count(F.lit(1)).alias("row_count")
    tx = typed(load_year_files(spark, raw_dir, prefix, encoding, multi_line))
    tx = tx.observe(seen["transactions"], count)
    catalog = load_catalog(spark, raw_dir, prefix, encoding).observe(seen["catalog"], count)
    return tx, catalog, seen


def by_year(df: DataFrame, year: str, years: DataFrame, file_rows: int = FILE_ROWS, moved: bool = False) -> DataFrame:
    """df for a write by its column `year`, in few files for each year, without moving the bulk of it.

    A year is written from where its rows lie if its row's file would have enough rows on average, and a file a quarter
    of them: in yearly files a task reads one year. Only the others are gathered, by the rebalance hint; without it every
    task would write a small file for each of them. `years` has the year of each row, as its one column, as far as the choice
    needs it, and lies as df does; if df is `moved`, only years of enough rows for a file of every task stay.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, input_bytes(df) // SCAN_BYTES)
    pieces = years.toDF("y").withColumn("p", F.spark_partition_id()).groupBy("y", "p").agg(F.count(F.lit(1)).alias("n"))
    square = F.sum(F.col("n").cast("double") * F.col("n")).alias("square")
    counted = pieces.groupBy("y").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pieces"), square).collect()  # some hundreds at most
    lies = lambda r: r.square >= file_rows * r.n and 4 * r.n >= file_rows * r.pieces
    heavy = [r.y for r in counted if r.n >= file_rows * tasks or not moved and lies(r)]
    if not heavy:
        return df.hint("rebalance", year)
    known = [y for y in heavy if y is not None]
    stays = F.coalesce(F.col(year).isin(known), F.lit(None in heavy)) if known else F.col(year).isNull()
    if len(heavy) == len(counted):
        return df
    return df.where(stays).unionByName(df.where(~stays).hint("rebalance", year))


def write_clean(df: DataFrame, path: str, csv_path: str | None = None, counted: DataFrame | None = None, parts: int = 1) -> None:
    """Parquet by order year, optionally CSV too.

    Each year lies in few files, see `by_year`. Within a file rows go by day and
    customer, so that a month's or a customer's rows lie in few pages, which
    the statistics of row groups and pages find. `counted` is a frame that is cheap to read
    and has about as many rows of each year; without it years are counted in df. With several
    `parts`, see `in_parts`, they are written one after another, and the last one marks the dataset as complete.
    """
    dated = df if counted is None else counted
    for k in range(parts):
        of_part = lambda frame: frame.where(F.col(PART) == k).drop(PART) if parts > 1 else frame  # noqa: E731, B023
        out = by_year(of_part(df).withColumn("order_year_dt", F.year("order_date_dt")), "order_year_dt", of_part(dated).select(F.year("order_date_dt")))
        out = out.sortWithinPartitions(*[c for c in ("order_year_dt", "order_date_dt", "customer_id") if c in out.columns])
        out.write.mode("append" if k else "overwrite").option("compression", CODEC) \
            .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(k == parts - 1).lower()) \
            .partitionBy("order_year_dt").parquet(path)
    if csv_path:
        df.drop(PART).write.mode("overwrite").option("header", True).option("escape", '"').csv(csv_path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a written table is there as a whole."""
    return _exists(spark, f"{path}/_SUCCESS")


def read_clean(spark: SparkSession, path: str, csv_path: str | None = None) -> DataFrame:
    """The Parquet form if it exists, else the CSV form with its dates parsed, else an error."""
    if is_complete(spark, path):
        return spark.read.parquet(path)
    if csv_path and _exists(spark, csv_path):
        header = header_of(spark, csv_path, "UTF-8")
        if header is None:
            raise ValueError(f"{csv_path} is empty")
        flags = ("is_prime_member", "is_prime_eligible", "is_festival_sale", "is_bulk_order",
                 "price_was_corrected")
        numbers = {"original_price_inr": "double", "customer_rating": "double",
                   "delivery_days": "double", "bulk_qty": "bigint", "order_date_dt": "date"}
        df = typed(_scan(spark, [csv_path], "UTF-8", header))
        casts = numbers | {c: "boolean" for c in flags}
        return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items() if c in header})
    raise FileNotFoundError(f"no cleaned dataset at {path}")
