"""What follows what in each key's sequence of rows, however long a sequence is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import Scratch, materialise
from .selection import ranges_for

# monotonically_increasing_id() has the partition above this bit and the row's place in it below.
_PLACE_BITS = 33


def numbered(df: DataFrame, order: list[str], ranges: int) -> DataFrame:
    """df by ranges of its order, with each row's place `_pos`: ascending, and the range in its upper bits. Write it before it is read."""
    return df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_pos", F.monotonically_increasing_id())


def range_of_place() -> F.Column:
    return F.shiftright("_pos", _PLACE_BITS)


def followers(df: DataFrame, key: str, order: list[str], value: str, ranges: int | None = None,
              stage: Callable[[DataFrame, str], DataFrame] = materialise) -> DataFrame:
    """value, next_value, n: how often the next row of a key has a value after another one.

    The whole frame is dealt by ranges of (key, order), so that a key, or any part of its rows, spreads over
    as many tasks as it needs. Each range is linked on its own. Its first and last row are all that is left:
    two rows for each range, which are then linked in one pass. `order` and value decide the order of a key's rows;
    rows equal in both are alike. Rows without key or value must have been left out.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(value).alias("_value"))
    places = ["_key", *[f"_o{i}" for i in range(len(order))], "_value"]
    n = ranges or ranges_for(df, df.count())
    with Scratch(spark) as scratch:
        laid = scratch(numbered(rows, places, n).select("_key", "_value", "_pos")).withColumn("_r", range_of_place())
        in_range = W.partitionBy("_r").orderBy("_pos")
        # By ranges of the number, not by its hash: no task gets several ranges by chance.
        linked = laid.repartitionByRange(n, "_r").select(
            "_key", "_value", "_pos", F.lead("_value").over(in_range).alias("_next"), F.lead("_key").over(in_range).alias("_next_key"),
            F.lag("_pos").over(in_range).isNull().alias("_first"))
        edge = F.col("_first") | F.col("_next").isNull()
        steps = linked.select(
            F.col("_value").alias("value"), F.when(F.col("_next_key") == F.col("_key"), F.col("_next")).alias("next_value"),
            *[F.when(edge, F.col(c)).alias(c) for c in ("_key", "_pos")], (edge & F.col("_next").isNull()).alias("_last"))
        counted = stage(steps.where("next_value IS NOT NULL OR _pos IS NOT NULL").groupBy(*steps.columns).agg(F.count(F.lit(1)).alias("n")), "steps")
    inside = counted.where("next_value IS NOT NULL").select("value", "next_value", "n")
    # A single window over at most two rows for each range.
    along = W.orderBy("_pos")
    between = counted.where("_pos IS NOT NULL").select(
        "value", "_key", "_last", F.lead("value").over(along).alias("next_value"), F.lead("_key").over(along).alias("_next_key"))
    across = between.where("_last AND _key = _next_key").select("value", "next_value", F.lit(1).cast("long").alias("n"))
    return inside.unionByName(across).groupBy("value", "next_value").agg(F.sum("n").alias("n"))
