"""Star schema builders: three dimensions and the transaction fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import vocabulary as vocab
from ..functions.parsing import stored_flag_of
from ..functions.text import tier_of
from .cleaning import routed
from .shaping import present
from .winners import deciding_rows, first_of, last_known

PRODUCT_COLUMNS = {
    "product_id": "string", "product_name": "string", "category": "string",
    "subcategory": "string", "brand": "string", "base_price_2015": "decimal(20,2)",
    "weight_kg": "decimal(8,3)", "product_rating": "decimal(3,2)",
    "is_prime_eligible": "boolean", "launch_year": "smallint", "model": "string",
}
FACT_COLUMNS = {
    "transaction_id": "string", "customer_id": "string", "product_id": "string",
    "date_id": "int", "order_date": "date", "payment_method": "string",
    "original_price_inr": "decimal(20,2)", "discount_percent": "decimal(5,2)",
    "final_amount_inr": "decimal(20,2)", "delivery_charges": "decimal(20,2)",
    "delivery_days": "decimal(4,1)", "return_status": "string",
    "customer_rating": "decimal(3,2)", "is_prime_member": "boolean",
    "is_festival_sale": "boolean", "festival_name": "string",
    "is_bulk_order": "boolean", "bulk_qty": "int",
}
# What a customer's dimension row tells of its last known value.
DESCRIBED = ("customer_city", "customer_state", "age_group", "customer_spending_tier")
# Warehouse name -> name in the cleaned data, used when the former is absent.
SYNONYMS = {
    "age_group": "customer_age_group",
    "product_rating": "rating",
    "weight_kg": "product_weight_kg",
}


def with_synonyms(df: DataFrame) -> DataFrame:
    missing = {n: F.col(s) for n, s in SYNONYMS.items()
               if n not in df.columns and s in df.columns}
    return df.withColumns(missing) if missing else df


def _dated(df: DataFrame) -> DataFrame:
    if "order_date_dt" in df.columns:
        return df.withColumn("order_date_dt", F.col("order_date_dt").cast("date"))
    return df.withColumn("order_date_dt", F.col("order_date").try_cast("date"))


def _typed(df: DataFrame, col: str, type_: str) -> Column:
    if type_ == "boolean" and dict(df.dtypes)[col] != "boolean":
        return stored_flag_of(F.col(col)).alias(col)
    return F.col(col).try_cast(type_).alias(col)


def build_dim_time(bounds: DataFrame) -> DataFrame:
    """Calendar from the first to the last day of a one-row frame (lo, hi)."""
    days = bounds.where("lo IS NOT NULL").select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
    d = F.col("full_date")
    return days.select(
        date_id(d).alias("date_id"), d,
        F.year(d).cast("smallint").alias("year"),
        F.quarter(d).cast("tinyint").alias("quarter"),
        F.month(d).cast("tinyint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).cast("tinyint").alias("week_of_year"),
        F.dayofmonth(d).cast("tinyint").alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def date_id(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def order_bounds(df: DataFrame) -> DataFrame:
    return _dated(df).agg(F.min("order_date_dt").alias("lo"), F.max("order_date_dt").alias("hi"))


def _rank(df: DataFrame) -> tuple[Column, Column]:
    """Order date and transaction id, in fixed types."""
    date, number = (F.col(c) if c in df.columns else F.lit(None) for c in ("order_date_dt", "transaction_id"))
    return date.cast("date"), number.cast("string")


def product_state(df: DataFrame) -> DataFrame:
    """product_id and the last row over the columns present, with what it was ordered by: `latest` (at, tie, row)."""
    df = _dated(with_synonyms(df))
    columns = [_typed(df, c, t) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in PRODUCT_COLUMNS.items()]
    day, number = _rank(df)
    tie = F.xxhash64(*[c for c in PRODUCT_COLUMNS if c in df.columns])
    rows = df.where(F.col("product_id").isNotNull()).select(
        "product_id", F.struct(F.struct(day.alias("day"), number.alias("id")).alias("at"), tie.alias("tie"), F.struct(*columns).alias("row")).alias("latest"))
    return deciding_rows(rows, "product_id", F.col("latest.at.day"), [F.desc("latest")], last=True)


def customer_state(df: DataFrame) -> DataFrame:
    """customer_id, each attribute's last known value with its order, membership and purchase span."""
    df = _dated(with_synonyms(df))
    day, number = _rank(df)
    member = _typed(df, "is_prime_member", "boolean") if "is_prime_member" in df.columns else F.lit(None).cast("boolean")
    rows = df.where(F.col("customer_id").isNotNull()).select(
        "customer_id", day.alias("order_date_dt"), number.alias("transaction_id"), member.alias("is_prime_member"),
        *[(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in DESCRIBED])
    return last_known(rows, "customer_id", F.col("order_date_dt"), F.col("transaction_id"), list(DESCRIBED), {
        "is_prime_member": F.bool_or("is_prime_member"), "first_purchase_date": F.min("order_date_dt"), "last_purchase_date": F.max("order_date_dt")})


def merged_products(states: DataFrame) -> DataFrame:
    return first_of(states, ["product_id"], [F.desc("latest")])


def merged_customers(states: DataFrame) -> DataFrame:
    """Of two states at most; their rows of a customer meet in a list."""
    each = states.groupBy("customer_id").agg(
        *[F.array_max(F.collect_list(c)).alias(c) for c in DESCRIBED], F.bool_or("is_prime_member").alias("is_prime_member"),
        F.min("first_purchase_date").alias("first_purchase_date"), F.max("last_purchase_date").alias("last_purchase_date"))
    return each


def dim_products_of(state: DataFrame) -> DataFrame:
    return state.select("latest.row.*")


def dim_customers_of(state: DataFrame) -> DataFrame:
    tiers = vocab.city_tiers(vocab.TIER1_CITIES)
    flat = state.select("customer_id", *[F.col(f"{c}.value").alias(c) for c in DESCRIBED], "is_prime_member",
                        "first_purchase_date", "last_purchase_date")
    return flat.select(
        "customer_id", "customer_city", "customer_state",
        tier_of(F.col("customer_city"), tiers, vocab.DEFAULT_TIER).alias("city_tier"),
        "age_group", "is_prime_member", "customer_spending_tier",
        "first_purchase_date", "last_purchase_date",
    )


def build_dim_products(df: DataFrame) -> DataFrame:
    """The last row per product over the columns present."""
    keep = [c for c in PRODUCT_COLUMNS if c in with_synonyms(df).columns]
    return dim_products_of(product_state(df)).select(*keep)


def build_dim_customers(df: DataFrame) -> DataFrame:
    """Last known attributes, membership and purchase span per customer."""
    return dim_customers_of(customer_state(df))


# Fact columns whose values may not fit; a bit of MISFITS for each says that a row's value didn't.
_BOUNDED = [c for c, t in FACT_COLUMNS.items() if t.startswith("decimal")]
MISFITS = "_misfits"


def misfits() -> dict[str, Column]:
    """For each bounded fact column, an aggregate that counts the rows of a marked fact whose value its type can't hold."""
    return {c: F.count_if(F.getbit(F.col(MISFITS), F.lit(i)) == 1) for i, c in enumerate(_BOUNDED)}


def _misfit_bits(df: DataFrame) -> Column:
    bits = F.lit(0)
    for i, c in enumerate(_BOUNDED):
        if c in df.columns:
            bits = bits + F.when(F.col(c).isNotNull() & _typed(df, c, FACT_COLUMNS[c]).isNull(), 1 << i).otherwise(0)
    return bits.alias(MISFITS)


def build_fact_transactions(
    df: DataFrame, marked: bool = False, stage: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Complete rows projected to the fact columns, first row per transaction_id; marked adds which values don't fit.

    Rows whose id occurs once stay where they are: a filter of repeated ids names the others (and some false hits).
    Of these `row_number = 1` is applied per map task before the shuffle, so an id that
    a third of all rows share arrives as one row per task. `stage` takes the filter. df is read several times.
    """
    df = _dated(df)
    keys = ["order_date_dt", "transaction_id", "customer_id", "product_id"]
    defaults = {"is_bulk_order": F.lit(False), "bulk_qty": F.lit(1)}
    source = {"order_date": F.col("order_date_dt"), "date_id": date_id(F.col("order_date_dt"))}

    def column(name: str, type_: str) -> Column:
        if name in source:
            return source[name].cast(type_).alias(name)
        if name in df.columns:
            return _typed(df, name, type_)
        return defaults.get(name, F.lit(None)).cast(type_).alias(name)

    mark = [_misfit_bits(df)] if marked else []
    fact = present(df, *keys).select(*[column(c, t) for c, t in FACT_COLUMNS.items()], *mark)
    order = W.partitionBy("transaction_id").orderBy("order_date", F.xxhash64(*FACT_COLUMNS))
    hashed = fact.withColumn("_h", F.xxhash64("transaction_id"))
    again = routed(hashed, hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "_h", stage)
    once = again.where(~F.col("_again")).drop("_h", "_again")
    several = again.where(F.col("_again")).drop("_h", "_again")
    return several.withColumn("_first", F.row_number().over(order)).where(F.col("_first") == 1).drop("_first").unionByName(once)


def order_years(df: DataFrame) -> DataFrame:
    """The year of each row's order date."""
    return _dated(df).select(F.year("order_date_dt").alias("order_year"))
