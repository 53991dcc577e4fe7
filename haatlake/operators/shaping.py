"""Shared relational building blocks: shares, top-k, quantiles, histograms, ranks.

Windows here run over *aggregated* frames or over keys whose group size is
bounded by construction; raw rows are always combined map-side first, so a key
holding a third of the input costs no more than any other key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import halfup, percent
from ..sources.staging import bounded, materialise
from .selection import RANGE_ROWS, dealt, ranges_for, select_ranks

# Logarithmic buckets per unit of ln(1+|v|). A double spans at most
# 2 * 710 * 256 of them, which bounds the histogram of any group.
_BUCKETS_PER_LOG = 256
# Equal parts of a bucket that holds a wanted rank; only the values of one part are ordered in a task.
_PARTS = 1024


def present(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that have all keys, as plain filters that reach the file scan."""
    return reduce(lambda d, k: d.where(F.col(k).isNotNull()), keys, df)


def share_of(df: DataFrame, parts: list[str], value: str, alias: str, digits: int = 2) -> DataFrame:
    """Each row's value as a percentage of its part's sum (an aggregated frame)."""
    whole = F.sum(value).over(W.partitionBy(*parts))
    return df.withColumn(alias, percent(F.col(value), whole, digits))


def top_k(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(by), *ties).limit(k)


def pct_change(df: DataFrame, order: str, value: str, alias: str, digits: int = 2) -> DataFrame:
    """Change against the previous row in percent, for frames of one row per period."""
    prev = F.lag(value).over(W.orderBy(order))
    return df.withColumn(alias, percent(F.col(value) - prev, prev, digits))


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Occurrences of each distinct non-null value per group."""
    v = F.col(value).cast("double")
    return (
        df.select(*groups, v.alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_n"))
    )


def exact_quantiles(
    df: DataFrame,
    groups: list[str],
    value: str,
    probs: list[float],
    counts: DataFrame | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group: groups + n + q (array).

    A built-in exact percentile keeps all distinct values of a group in one
    task. Here distinct values are counted first, a logarithmic histogram of
    bounded size finds the buckets that contain the wanted ranks, a second one
    between the least and the greatest value of such a bucket finds the parts,
    and only the values in those parts are ordered.
    """
    vc = value_counts(df, groups, value) if counts is None else counts
    v = F.col("_v")
    bucket = F.floor(F.signum(v) * F.log1p(F.abs(v)) * _BUCKETS_PER_LOG).alias("_b")
    vc = vc.select(*groups, "_v", "_n", bucket)

    in_group = W.partitionBy(*groups)
    hist = (
        vc.groupBy(*groups, "_b")
        .agg(F.sum("_n").alias("_bn"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        .withColumn("_total", F.sum("_bn").over(in_group))
        .withColumn("_before", F.sum("_bn").over(in_group.orderBy("_b")) - F.col("_bn"))
    )
    position = [(F.col("_total") - 1) * F.lit(float(p)) for p in probs]
    floors, ceils = [F.floor(h) for h in position], [F.ceil(h) for h in position]
    holds = lambda rank, start, n: (rank >= start) & (rank < start + n)
    wanted = hist.where(
        reduce(or_, [holds(r, F.col("_before"), F.col("_bn")) for r in floors + ceils])
    )

    # Null-safe keys: a null group is a group, and no inferred not-null filter
    # slips below the count, so all uses of vc share one shuffle.
    def within(left: DataFrame, right: DataFrame, keys: list[str], *more: str) -> DataFrame:
        named = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *more)
        on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        return left.join(named, reduce(and_, on)).drop(*[f"_k{i}" for i in range(len(keys))])

    width = F.col("_most") - F.col("_least")
    part = F.when(width > 0, F.floor((v - F.col("_least")) / width * _PARTS)).otherwise(F.lit(0))
    near = within(vc, wanted, [*groups, "_b"], "_total", "_before", "_least", "_most").withColumn("_p", part)
    in_bucket = W.partitionBy(*groups, "_b").orderBy("_p")
    parts = (
        near.groupBy(*groups, "_b", "_p")
        .agg(F.sum("_n").alias("_pn"), F.max("_total").alias("_total"), F.max("_before").alias("_before"))
        .withColumn("_from", F.col("_before") + F.sum("_pn").over(in_bucket) - F.col("_pn"))
        .where(reduce(or_, [holds(r, F.col("_from"), F.col("_pn")) for r in floors + ceils]))
    )
    running = F.sum("_n").over(W.partitionBy(*groups, "_b", "_p").orderBy("_v"))
    ordered = within(near, parts, [*groups, "_b", "_p"], "_from").withColumn(
        "_start", F.col("_from") + running - F.col("_n")
    )
    at = lambda rank: F.max(F.when(holds(rank, F.col("_start"), F.col("_n")), v))
    picks = [at(r).alias(f"_lo{i}") for i, r in enumerate(floors)]
    picks += [at(r).alias(f"_hi{i}") for i, r in enumerate(ceils)]
    picked = ordered.groupBy(*groups).agg(F.max("_total").alias("_total"), *picks)
    quantile = [
        F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (h - F.floor(h))
        for i, h in enumerate(position)
    ]
    return picked.select(*groups, F.col("_total").alias("n"), F.array(*quantile).alias("q"))


def median(df: DataFrame, value: str) -> DataFrame:
    return exact_quantiles(df, [], value, [0.5]).select(halfup(F.col("q")[0], 4).alias("median"))


def bucket_of(c: Column, cuts: Column, n: int) -> Column:
    """1..n by n-1 ascending cut points; intervals are closed on the right."""
    chain = F.when(c.isNull(), F.lit(None))
    for i in range(n - 1):
        chain = chain.when(c <= cuts[i], F.lit(i + 1))
    return chain.otherwise(F.lit(n)).cast("int")


def qcut(df: DataFrame, buckets: dict[str, str], n: int) -> DataFrame:
    """Quantile bucket 1..n per {value column: result column}.

    All columns share one quantile computation. Equal edges go to the first
    matching bucket.
    """
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(v).alias("_measure"), F.col(v).cast("double").alias("_value"))
        for v in buckets
    ])).alias("s")).select("s.*")
    q = exact_quantiles(stacked, ["_measure"], "_value", [i / n for i in range(1, n)])
    cuts = q.agg(F.struct(*[
        F.max(F.when(F.col("_measure") == v, F.col("q"))).alias(v) for v in buckets
    ])).scalar()
    return df.withColumns({b: bucket_of(F.col(v), cuts[v], n) for v, b in buckets.items()})


def rank_bucket(df: DataFrame, value: str, tie: str, n: int) -> Column:
    """Bucket 1..n of a row by its rank in (value, tie), by n-1 cut rows found beforehand. Without a value there is no bucket.

    df is staged by the caller and has next to no rows of equal value and tie. No row is ranked: each is
    compared with the rows at the n-1 cuts. A missing tie is the least one.
    """
    ranked = df.where(F.col(value).isNotNull())
    total = ranked.count()
    ranks = [(total - 1) * i // n + 1 for i in range(1, n)]  # the last rank of each bucket
    cuts = select_ranks(ranked, [value, tie], ranks, unique=True) if total else {}
    c, t = F.col(value), F.col(tie)
    chain = F.when(c.isNull(), F.lit(None))
    for i, rank in enumerate(ranks if cuts else [], 1):
        v, k = cuts[rank]
        chain = chain.when((c < v) | (c == v) & (t.isNull() if k is None else t.isNull() | (t <= k)), F.lit(i))
    return chain.otherwise(F.lit(n)).cast("int")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are listed."""
    values = df.select(F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    lo_hi = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("r")).scalar()
    flat = lo_hi["lo"] == lo_hi["hi"]
    lo = F.when(flat, lo_hi["lo"] - 0.5).otherwise(lo_hi["lo"])
    width = F.when(flat, F.lit(1.0)).otherwise(lo_hi["hi"] - lo_hi["lo"])
    slot = F.least(F.floor((F.col("v") - lo) / width * bins), F.lit(bins - 1)).cast("int")
    counted = values.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    labels = df.sparkSession.range(bins, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    return (
        labels.join(counted, "bin", "left")
        .select(
            "bin",
            halfup(lo + width * F.col("bin") / bins, 6).alias("lower"),
            halfup(lo + width * (F.col("bin") + 1) / bins, 6).alias("upper"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .where(F.col("lower").isNotNull())
    )


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles per group and the extreme data inside 1.5 IQR of the box."""
    vc = materialise(value_counts(df, [group], value), "values")
    q = exact_quantiles(df, [group], value, [0.25, 0.5, 0.75], counts=vc)
    fences = bounded(materialise(
        q.select(
            F.col(group).alias("_g"), "n", *[F.col("q")[i].alias(x) for i, x in
                                             enumerate(("q1", "median", "q3"))]
        ), "quartiles"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        vc.join(fences, F.col(group).eqNullSafe(F.col("_g")))
        .where(inside)
        .groupBy(group, "n", *[halfup(F.col(c), 4).alias(c) for c in ("q1", "median", "q3")])
        .agg(halfup(F.min("_v"), 4).alias("whisker_low"),
             halfup(F.max("_v"), 4).alias("whisker_high"))
    )


def global_rank(df: DataFrame, order_cols: list[str], alias: str = "rank", ranges: int | None = None) -> DataFrame:
    """Row number 1..n over the whole frame, without a single-task window.

    Rows are dealt by ranges of the order, one for about RANGE_ROWS rows (or `ranges`), and written once
    with the number of their range, so that it stays the same. Each range is numbered on its own and
    shifted by the sizes of the ranges below. order_cols must order df totally; it is read twice.
    """
    ranged = materialise(dealt(df, order_cols, "_r", ranges_for(df, ranges * RANGE_ROWS if ranges else df.count())), "ranges")
    below = (
        ranged.groupBy("_r").agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_below", F.sum("_size").over(W.orderBy("_r")) - F.col("_size"))
        .drop("_size")
    )
    local = F.row_number().over(W.partitionBy("_r").orderBy(*order_cols))
    # `below` has a row for each range.
    return (
        ranged.withColumn("_local", local)
        .join(bounded(materialise(below, "below")), "_r")
        .withColumn(alias, F.col("_local") + F.col("_below"))
        .drop("_r", "_local", "_below")
    )
