"""Data quality: null profiles, type comparison, value samples, key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import vocabulary as vocab
from ..functions.numbers import percent
from .cleaning import routed

# Values listed of a column.
SAMPLED = 15
FLAGS = ("is_bulk_order", "price_was_corrected")
PRIMARY_KEYS = {
    "dim_products": "product_id", "dim_customers": "customer_id",
    "dim_time": "date_id", "fact_transactions": "transaction_id",
}


def null_profile(df: DataFrame) -> DataFrame:
    """Missing count and percentage of every column, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), (F.col("_rows") - F.col(f"c{i}")).alias("missing"))
        for i, c in enumerate(df.columns)
    ]
    return (
        counted.select("_rows", F.explode(F.array(*entries)).alias("e"))
        .select("e.column", "e.missing",
                percent(F.col("e.missing"), F.col("_rows")).alias("missing_pct"))
    )


def shape_comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row and column counts before and after."""
    def shape(df: DataFrame, stage: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(stage).alias("stage"), "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        )
    return shape(before, "before").unionByName(shape(after, "after"))


def type_comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """Type of each input column before and after; NULL where it is gone."""
    types = dict(after.dtypes)
    rows = [(i, c, t, types.get(c)) for i, (c, t) in enumerate(before.dtypes)]
    schema = "position int, column string, before string, after string"
    return before.sparkSession.createDataFrame(rows, schema)


def value_samples(df: DataFrame, columns: list[str] | None = None, k: int = SAMPLED) -> DataFrame:
    """The k most frequent values, nulls included, of each profiled column."""
    present = [c for c in (columns or vocab.PROFILED_COLUMNS) if c in df.columns]
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in present
    ])
    counted = (
        df.select(F.explode(pairs).alias("p")).select("p.*")
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    best = W.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    return (
        counted.withColumn("position", F.row_number().over(best)).where(F.col("position") <= k)
    )


def flag_tallies(df: DataFrame, flags: tuple[str, ...] = FLAGS) -> DataFrame:
    present = [c for c in flags if c in df.columns]
    pairs = F.array(*[
        F.struct(F.lit(c).alias("flag"), F.col(c).cast("string").alias("value")) for c in present
    ])
    return (
        df.select(F.explode(pairs).alias("p")).select("p.*")
        .groupBy("flag", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once.

    Most occur once: hashes are counted, and only values whose hash occurs again are shuffled and compared themselves.
    """
    hashed = df.select(key, F.xxhash64(key).alias("_h"))
    again = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return (
        routed(hashed, again, "_h").where("_again").groupBy(key).agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact key values the dimension lacks, with the number of fact rows each affects.

    Distinct keys are counted before the anti join, so it sees one row per key.
    """
    used = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return used.join(dim.select(key), key, "left_anti")


def key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per declared constraint: how many key values break it."""
    def tally(df: DataFrame, kind: str, table: str, key: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(kind).alias("constraint_type"), F.lit(table).alias("table_name"),
            F.lit(key).alias("key_name"), "violations",
        )
    fact = tables["fact_transactions"]
    parts = [tally(duplicate_keys(tables[t], k), "primary_key", t, k)
             for t, k in PRIMARY_KEYS.items()]
    parts += [tally(orphans(fact, tables[t], k), "foreign_key", t, k)
              for t, k in PRIMARY_KEYS.items() if t != "fact_transactions"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _profile(df: DataFrame, stage: str) -> DataFrame:
    """Shape and missing values of one frame as report rows, from one aggregate."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    n = F.col("_rows")
    cells = [("shape", stage, "row_count", n), ("shape", stage, "column_count", F.lit(len(df.columns)))]
    for i, c in enumerate(df.columns):
        missing = n - F.col(f"c{i}")
        cells += [(f"missing_{stage}", c, "missing", missing), (f"missing_{stage}", c, "missing_pct", percent(missing, n))]
    rows = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(c).alias("column"), F.lit(m).alias("metric"), v.cast("string").alias("value"))
                     for s, c, m, v in cells])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def quality_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """The whole report in long form: section, column, metric, value (text).

    `before` is read once. `after` is read once for shape and missing values, and once for what values its columns have:
    samples and flags are counted together.
    """
    listed = [("values", c) for c in vocab.PROFILED_COLUMNS if c in after.columns] + [("flags", c) for c in FLAGS if c in after.columns]
    parts = [_profile(before, "before"), _profile(after, "after")]
    types = type_comparison(before, after)
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("before", "after")])
    parts.append(types.select(F.lit("types").alias("section"), "column", F.explode(cells).alias("m")).select("section", "column", "m.*"))
    if listed:
        pairs = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for s, c in listed])
        counted = after.select(F.explode(pairs).alias("p")).select("p.*").groupBy("section", "column", "value").agg(F.count(F.lit(1)).alias("n"))
        best = W.partitionBy("section", "column").orderBy(F.desc("n"), F.asc_nulls_first("value"))
        # A flag has three values at most, so the same limit serves both kinds and one pass counts them.
        listed_values = counted.withColumn("_at", F.row_number().over(best)).where(f"_at <= {SAMPLED}")
        parts.append(listed_values.select("section", "column", F.coalesce("value", F.lit("(null)")).alias("metric"), F.col("n").cast("string").alias("value")))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report


REPORT = "section string, column string, metric string, value string"


def write_report(before: DataFrame, after: DataFrame, path: str, more: DataFrame | None = None) -> None:
    """The report, and more rows of its kind, as JSON lines. It is small: a few rows for each column."""
    report = quality_report(before, after)
    (report if more is None else report.unionByName(more)).coalesce(1).write.mode("overwrite").json(path)
