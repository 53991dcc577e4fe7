"""The first or last row of each key, without ordering all rows.

Phase one aggregates a number, the day, by key: a hash aggregate that combines on the map
side. Phase two looks at the rows of each key's deciding day alone, with whatever attributes are wanted,
and settles ties by the full order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import fits, materialise

# A key with more rows meets its deciding day by a broadcast, where the rows stay in their tasks.
HOT_ROWS = 1_000_000


def met(rows: DataFrame, top: DataFrame, key: str, hot_rows: int = HOT_ROWS, whole: bool = True) -> DataFrame:
    """rows with the columns of top, which is staged and has one row for each key (null is one), and its number of rows as `_n`.

    A top that fits is broadcast, if it may be broadcast whole. Beyond, the join shuffles, but for keys of many rows: at most
    one in hot_rows of all rows is such a key.
    """
    def join(left: DataFrame, right: DataFrame) -> DataFrame:
        named = right.withColumnRenamed(key, "_met")
        return left.join(named, F.col(key).eqNullSafe(F.col("_met"))).drop("_met", "_n")

    if whole and fits(top):
        return join(rows, F.broadcast(top))
    hot = top.where(F.col("_n") > hot_rows)
    if hot.isEmpty() or not fits(hot):
        return join(rows, top)
    names = hot.select(F.col(key).alias("_met"))
    cold = rows.join(F.broadcast(names), F.col(key).eqNullSafe(F.col("_met")), "left_anti")
    return join(rows, F.broadcast(hot)).unionByName(join(cold, top.where(F.col("_n") <= hot_rows)))


def met_on(rows: DataFrame, top: DataFrame, key: str, day: Column, days: list[str]) -> DataFrame:
    """met() for rows of which only those count whose day is one of the key's `days` in top; most others are left out.

    If top is too large for a broadcast, a filter of its keys and days is one: what it doesn't name isn't shuffled.
    """
    from .cleaning import routed  # which needs first_of itself

    if not fits(top):
        wanted = top.select(F.explode(F.array(*[F.xxhash64(key, d) for d in days])).alias("_h"))
        rows = routed(rows.withColumn("_h", F.xxhash64(F.col(key), day)), wanted, "_h").where("_again").drop("_h", "_again")
    return met(rows, top, key)


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The least row of each key. `row_number <= 1` is applied by each task before the shuffle."""
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def deciding_rows(df: DataFrame, key: str, day: Column, order: list[Column], last: bool) -> DataFrame:
    """One row of each key: of its last (or first) day, and there the first in `order`. A missing day loses against any."""
    days = df.groupBy(key).agg((F.max if last else F.min)(day).alias("_day"), F.count(F.lit(1)).alias("_n"))
    candidates = met_on(df, materialise(days, "days"), key, day, ["_day"]).where(day.eqNullSafe(F.col("_day"))).drop("_day")
    return first_of(candidates, [key], order)


def last_known(df: DataFrame, key: str, day: Column, order: Column, values: list[str], others: dict[str, Column]) -> DataFrame:
    """key; for each of the text columns its last non-null value as struct (at (day, id), value), null without any; and other aggregates.

    The days of all values are found in one pass. Rows that decide some value then meet by (key, value's
    name), at most one a task and name; what a name has settled ties.
    """
    named = df.select(key, day.alias("_at"), order.alias("_id"), *values)
    found = [F.max(F.when(F.col(v).isNotNull(), day)).alias(f"_day{i}") for i, v in enumerate(values)]
    top = materialise(df.groupBy(key).agg(*found, F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in others.items()]), "days")
    decides = [F.col(v).isNotNull() & F.col("_at").eqNullSafe(F.col(f"_day{i}")) for i, v in enumerate(values)]
    facts = F.array(*[F.when(d, F.struct(F.lit(i).alias("i"), F.col(v).alias("value"))) for i, (v, d) in enumerate(zip(values, decides))])
    named_days = [f"_day{i}" for i in range(len(values))]
    spread = met_on(named, top.select(key, "_n", *named_days), key, F.col("_at"), named_days).select(
        key, F.struct(F.col("_at").alias("day"), F.col("_id").alias("id")).alias("at"), F.explode(F.filter(facts, lambda f: f.isNotNull())).alias("f"))
    best = first_of(spread.select(key, "at", "f.*"), [key, "i"], [F.desc("at"), F.desc("value")])
    # At most one entry for each name.
    gathered = best.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("i", F.struct("at", "value")))).alias("_known")).withColumnRenamed(key, "_met")
    joined = top.join(gathered, F.col(key).eqNullSafe(F.col("_met")), "left")
    return joined.select(key, *[F.col("_known")[i].alias(v) for i, v in enumerate(values)], *others)
