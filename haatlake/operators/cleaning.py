"""Cleaning operators, DataFrame -> DataFrame.

Each one leaves its input alone when its column is absent, and passes a column
through when it already has the target type. All but the duplicate and price
repairs are row-wise, so they fuse into the scan that feeds them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import parsing
from ..functions import text as words
from ..functions import vocabulary as vocab
from ..sources.staging import PART, bounded, fits, materialise
from .shaping import exact_quantiles
from .winners import first_of

DUPLICATE_KEY = ("customer_id", "product_id", "order_date", "final_amount_inr")
# Rows of a filter of keys, 64 bits each: 16 MB when full.
FILTER_WORDS = 1 << 20
FLAG_COLUMNS = ("is_prime_member", "is_prime_eligible", "is_festival_sale")


def _is(df: DataFrame, col: str, *types: str) -> bool:
    return dict(df.dtypes)[col].split("(")[0] in types


def _numeric(df: DataFrame, col: str) -> bool:
    return _is(df, col, "tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def fix_dates(df: DataFrame, col: str = "order_date") -> DataFrame:
    """Mixed date text to `col` as yyyy-MM-dd text and `col`_dt as a date."""
    if col not in df.columns:
        return df
    dated = _is(df, col, "date", "timestamp", "timestamp_ntz")
    parsed = F.col(col).cast("date") if dated else parsing.date_of(F.col(col))
    # A parsed date has a year of four digits, whose text a cast makes at a fraction of the time.
    text = F.date_format(f"{col}_dt", "yyyy-MM-dd") if dated else F.col(f"{col}_dt").cast("string")
    return df.withColumn(f"{col}_dt", parsed).withColumn(col, text)


def fix_prices(df: DataFrame, col: str = "original_price_inr") -> DataFrame:
    if col not in df.columns:
        return df
    c = F.col(col)
    return df.withColumn(col, c.cast("double") if _numeric(df, col) else parsing.price_of(c))


def fix_ratings(df: DataFrame, col: str = "customer_rating") -> DataFrame:
    if col not in df.columns:
        return df
    c = F.col(col)
    typed = parsing.within(c.cast("double"), 1, 5)
    return df.withColumn(col, typed if _numeric(df, col) else parsing.rating_of(c))


def fix_cities(df: DataFrame, col: str = "customer_city") -> DataFrame:
    return _canonical(df, col, vocab.CITY_ALIASES, split=True)


def fix_categories(df: DataFrame, col: str = "category") -> DataFrame:
    return _canonical(df, col, vocab.CATEGORY_ALIASES, split=False)


def fix_payment_methods(df: DataFrame, col: str = "payment_method") -> DataFrame:
    return _canonical(df, col, vocab.PAYMENT_ALIASES, split=True)


def _canonical(df: DataFrame, col: str, table: dict[str, str], split: bool) -> DataFrame:
    if col not in df.columns:
        return df
    key = words.folded(F.col(col))
    key = words.first_alternative(key) if split else key
    return df.withColumn(col, words.canonical(key, table))


def fix_booleans(df: DataFrame, cols: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    dirty = [c for c in cols if c in df.columns and not _is(df, c, "boolean")]
    return df.withColumns({c: parsing.flag_of(F.col(c)) for c in dirty})


def fix_delivery_days(df: DataFrame, col: str = "delivery_days") -> DataFrame:
    if col not in df.columns:
        return df
    c = F.col(col)
    typed = parsing.within(c.cast("double"), 0, 30)
    return df.withColumn(col, typed if _numeric(df, col) else parsing.delivery_days_of(c))


def row_order(df: DataFrame, tie_on: Sequence[str]) -> list[Column]:
    """The order that stands for "row order": date, id, then the row's own content.

    Nulls are least: whoever takes the last row by it prefers rows with date and id.
    """
    lead = [c for c in ("order_date_dt", "transaction_id") if c in df.columns]
    return [*[F.col(c) for c in lead], F.xxhash64(*tie_on)]


def first_order(df: DataFrame, tie_on: Sequence[str]) -> list[Column]:
    """The same for whoever takes the first row: nulls are greatest."""
    *lead, tie = row_order(df, tie_on)
    return [x for c in lead for x in (c.isNull(), c)] + [tie]


def handle_duplicates(
    df: DataFrame, key_cols: Sequence[str] | None = None, bulk_threshold: int = 5,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Tag repeated purchases as bulk; reduce groups above the threshold to their first row.

    Most rows have no second one. A first pass counts hashes of the keys, and hashes that occur again
    set bits of a filter: at most FILTER_WORDS rows, which are broadcast. Rows it doesn't name are done
    where they are; only the others are shuffled whole, and have their content hashed for ties.
    A false hit costs the shuffle of a row, no more.

    No group is ever gathered whole. Sizes are counted with map-side
    combination, and because a group keeps all of at most `bulk_threshold`
    rows or only its first one, `row_number <= bulk_threshold` lets each map
    task drop the rest before the shuffle. Both sides hash on the same key, so
    the join adds no exchange. Rows without a first key count as size zero:
    they are never grouped. df is read several times; stage it if it is dear. With `stage` the filter
    and the rows it names are written, so that the result is a scan of df and of these rows, whoever reads it.
    """
    have = [c for c in (key_cols or DUPLICATE_KEY) if c in df.columns]
    if not have:
        return df
    first = F.col(have[0])
    # A struct compares null fields as equal; the hash in front makes sorting
    # cheap. Fractions go in as text: Spark rewrites grouping keys that contain
    # floats, and the join would no longer find both sides partitioned alike.
    text = lambda c: (F.col(c) + F.lit(0.0)).cast("string").alias(c)
    parts = [text(c) if _is(df, c, "float", "double") else F.col(c) for c in have]
    keyed = df.withColumn("_h", F.when(first.isNotNull(), F.xxhash64(*parts)))
    hashes = keyed.where(first.isNotNull()).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    again = routed(keyed, hashes.where("_n > 1"), "_h", stage)
    alone = again.where(~F.col("_again"))
    several = again.where(F.col("_again")).drop("_again").withColumn("_k", F.struct(*parts))
    sizes = several.groupBy("_h", "_k").agg(F.count(F.lit(1)).alias("_size"))
    position = F.row_number().over(
        W.partitionBy("_h", "_k").orderBy(*first_order(df, [c for c in df.columns if c != PART]))
    )
    kept = several.withColumn("_pos", position).where(F.col("_pos") <= bulk_threshold)
    tagged = (
        kept.join(sizes, ["_h", "_k"])
        .where((F.col("_size") <= bulk_threshold) | (F.col("_pos") == 1))
        .select(
            *df.columns,
            (F.col("_size") > 1).alias("is_bulk_order"),
            F.col("_size").alias("bulk_qty"),
        )
    )
    ungrouped = alone.select(
        *df.columns,
        F.lit(False).alias("is_bulk_order"),
        F.lit(1).cast("bigint").alias("bulk_qty"),
    )
    return (stage(tagged) if stage else tagged).unionByName(ungrouped)


def routed(
    rows: DataFrame, wanted: DataFrame, key: str, stage: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """rows with `_again`: false only for rows whose 64-bit key isn't among the wanted ones, as a missing key never is.

    The wanted keys become bits, 64 in a row, of at most FILTER_WORDS rows; that bounds the broadcast.
    """
    bit = F.expr(f"cast({key} & 63 as int)")
    word = F.expr(f"shiftright({key}, 6) & {FILTER_WORDS - 1}").alias("_word")
    words = wanted.groupBy(word).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({key} & 63 as int))")).alias("_bits"))
    met = rows.withColumn("_word", word).join(F.broadcast(stage(words) if stage else words), "_word", "left")
    return met.withColumn("_again", F.coalesce(F.getbit(F.col("_bits"), bit) == 1, F.lit(False))).drop("_word", "_bits")


def fix_price_outliers(
    df: DataFrame,
    price_col: str = "original_price_inr",
    group_col: str = "category",
    min_prices: int = 10,
    factor: float = 50.0,
) -> DataFrame:
    """Undo decimal point slips: prices `factor` times off their group's median.

    The medians are a grouped aggregate joined back. As a window they would
    put a whole category, possibly the whole table, into one task.
    """
    if price_col not in df.columns:
        return df
    grouped = group_col in df.columns
    base = df if grouped else df.withColumn("_all", F.lit("all"))
    group = group_col if grouped else "_all"
    medians = bounded(materialise(
        exact_quantiles(base, [group], price_col, [0.5])
        .select(F.col(group).alias("_g"), "n", F.col("q")[0].alias("_median"))
        .where((F.col("n") >= min_prices) & (F.col("_median") > 0))
        .drop("n"), "medians"))
    price, mid = F.col(price_col), F.col("_median")
    high = price > mid * factor
    low = (price > 0) & (price < mid / factor)
    return (
        base.join(medians, F.col(group).eqNullSafe(F.col("_g")), "left")
        .withColumn("price_was_corrected", F.coalesce(high | low, F.lit(False)))
        .withColumn(price_col, F.when(high, price / 100).when(low, price * 100).otherwise(price))
        .drop("_g", "_median", "_all")
    )


def clean_rows(df: DataFrame) -> DataFrame:
    """The row-wise steps that precede duplicate handling."""
    steps = (fix_dates, fix_prices, fix_ratings, fix_cities, fix_booleans,
             fix_categories, fix_delivery_days)
    for step in steps:
        df = df.transform(step)
    return df


def clean_all(df: DataFrame, stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All ten steps in order.

    Duplicate handling and price repair each read their input more than once.
    `stage` (a `Scratch`, or `materialise`) takes the rows, so that raw files are
    parsed once, and what duplicate handling shuffles; rows that occur once aren't written again.
    """
    rows = clean_rows(df)
    return clean_groups(stage(rows) if stage else rows, stage)


def clean_groups(rows: DataFrame, stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The steps that follow the row-wise ones."""
    return fix_payment_methods(fix_price_outliers(handle_duplicates(rows, stage=stage)))


def enrich_from_catalog(
    df: DataFrame, catalog: DataFrame, key: str = "product_id", stage: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Left join of the catalog columns that df lacks; one catalog row per key. `stage` takes these, for who reads the result in parts."""
    if key not in df.columns or key not in catalog.columns:
        return df
    new = [c for c in catalog.columns if c not in df.columns]
    if not new:
        return df
    unique = first_of(catalog.where(F.col(key).isNotNull()).select(key, F.struct(*new).alias("_c")), [key], [F.col("_c")])
    if stage:
        unique = stage(unique)
    # Unique keys cannot outnumber catalog rows, so the file's rows and bytes bound the side.
    few = fits(catalog)
    return df.join(F.broadcast(unique) if few else unique, key, "left").select(
        *df.columns, *[F.col(f"_c.{c}").alias(c) for c in new]
    )
