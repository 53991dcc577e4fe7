"""The fifteen reporting views as DataFrame builders over the star schema.

The fact is reduced to one row per key *before* it meets a dimension: a join
then sees at most one row per customer or product, whatever the size of the
fact and however skewed its keys, and counting customers turns into counting
rows. Sums stay exact decimals until the last step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as vocab
from ..functions.numbers import halfup, percent, ratio
from ..operators.shaping import top_k
from ..sources.staging import bounded
from ..sources.warehouse import Warehouse

def rows() -> Column:
    return F.count(F.lit(1))


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    products: DataFrame
    customers: DataFrame
    calendar: DataFrame

    @classmethod
    def of(cls, warehouse: Warehouse, years: tuple[int, int] | None = None) -> Star:
        """The tables, with the fact limited to a year range when given (partition pruning)."""
        fact = warehouse.table("fact_transactions")
        if years:
            fact = fact.where(F.col("order_year").between(*years))
        return cls(fact, warehouse.table("dim_products"), warehouse.table("dim_customers"),
                   warehouse.table("dim_time"))

    def dated(self, *calendar_columns: str) -> DataFrame:
        """Fact with calendar columns. The calendar is broadcast if its days fit, as plausible dates do."""
        return self.fact.join(
            bounded(self.calendar.select("date_id", *calendar_columns)), "date_id"
        )

    def per(self, key: str, **extra: Column) -> DataFrame:
        """Fact summed per key: orders, revenue, priced (rows with an amount), extras."""
        return self.fact.groupBy(key).agg(
            rows().alias("orders"),
            F.sum("final_amount_inr").alias("revenue"),
            F.count("final_amount_inr").alias("priced"),
            *[c.alias(n) for n, c in extra.items()],
        )


def is_returned(status: Column, words: list[str] = vocab.RETURNED_WORDS) -> Column:
    return F.coalesce(F.lower(status).isin(words), F.lit(False))


def money(c: Column) -> Column:
    return halfup(c, 2)


def _direct() -> dict[str, Column]:
    """Sums straight from fact rows, under the names `_rolled` gives re-summed ones."""
    return {
        "orders": rows(),
        "revenue_inr": money(F.sum("final_amount_inr")),
        "avg_order_value": money(ratio(F.sum("final_amount_inr"), F.count("final_amount_inr"))),
    }


def _rolled() -> dict[str, Column]:
    return {
        "orders": F.sum("orders"),
        "revenue_inr": money(F.sum("revenue")),
        "avg_order_value": money(ratio(F.sum("revenue"), F.sum("priced"))),
    }


def _named(cols: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in cols.items()]


def kpi_summary(s: Star) -> DataFrame:
    # Each distinct count is its own one-column scan. As count(DISTINCT) side
    # by side they would be planned as one aggregate that expands every fact row.
    distinct = lambda c: s.fact.where(F.col(c).isNotNull()).select(c).distinct().agg(rows()).scalar()
    amount, rating = F.col("final_amount_inr"), F.col("customer_rating")
    totals = s.fact.agg(
        rows().alias("total_orders"),
        money(F.sum(amount)).alias("total_revenue_inr"),
        money(ratio(F.sum(amount), F.count(amount))).alias("avg_order_value_inr"),
        money(ratio(F.sum(rating), F.count(rating))).alias("avg_customer_rating"),
        percent(F.count_if("is_festival_sale"), rows()).alias("festival_share_pct"),
        percent(F.count_if("is_prime_member"), rows()).alias("prime_share_pct"),
    )
    return totals.select(
        "total_orders",
        distinct("customer_id").alias("active_customers"),
        distinct("product_id").alias("active_products"),
        "total_revenue_inr", "avg_order_value_inr", "avg_customer_rating",
        "festival_share_pct", "prime_share_pct",
    )


def yearly_revenue(s: Star) -> DataFrame:
    return (
        s.dated("year").groupBy("year")
        .agg(*_named(_direct()), F.countDistinct("customer_id").alias("active_customers"))
        .select("year", "revenue_inr", "orders", "active_customers", "avg_order_value")
        .orderBy("year")
    )


def monthly_revenue(s: Star) -> DataFrame:
    return (
        s.dated("year", "month", "month_name").groupBy("year", "month", "month_name")
        .agg(money(F.sum("final_amount_inr")).alias("revenue_inr"), rows().alias("orders"))
        .orderBy("year", "month")
    )


def category_performance(s: Star) -> DataFrame:
    total = s.fact.agg(F.sum("final_amount_inr")).scalar()
    return (
        s.per("product_id").join(s.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(*_named(_rolled()), F.sum("revenue").alias("_revenue"))
        .withColumn("market_share_pct", percent(F.col("_revenue"), total))
        .drop("_revenue")
        .orderBy(F.desc("revenue_inr"), "category")
    )


def top_customers(s: Star, k: int = 1000) -> DataFrame:
    spent = (
        s.per("customer_id", last_order_date=F.max("order_date"))
        .join(s.customers.select("customer_id", "customer_city", "age_group"), "customer_id")
        .select(
            "customer_id", "customer_city", "age_group", "orders",
            money(F.col("revenue")).alias("lifetime_value_inr"),
            money(ratio(F.col("revenue"), F.col("priced"))).alias("avg_order_value"),
            "last_order_date",
        )
    )
    return top_k(spent, "lifetime_value_inr", k, "customer_id")


def payment_mix(s: Star) -> DataFrame:
    return (
        s.dated("year").groupBy("year", "payment_method")
        .agg(rows().alias("orders"), money(F.sum("final_amount_inr")).alias("revenue_inr"))
        .orderBy("year", F.desc("orders"), "payment_method")
    )


def geographic_revenue(s: Star) -> DataFrame:
    place = ["customer_state", "customer_city", "city_tier"]
    return (
        s.per("customer_id").join(s.customers.select("customer_id", *place), "customer_id")
        .groupBy(*place).agg(*_named(_rolled()), rows().alias("unique_customers"))
        .select(*place, "orders", "unique_customers", "revenue_inr", "avg_order_value")
        .orderBy(F.desc("revenue_inr"), *place)
    )


def festival_impact(s: Star) -> DataFrame:
    name = F.coalesce(F.nullif(F.col("festival_name"), F.lit("")), F.lit("Festival"))
    period = F.when(F.col("is_festival_sale"), name).otherwise("Normal")
    return (
        s.dated("year").groupBy("year", period.alias("period_type"))
        .agg(
            *_named(_direct()),
            money(ratio(F.sum("discount_percent"), F.count("discount_percent")))
            .alias("avg_discount_pct"),
        )
        .orderBy("year", F.desc("revenue_inr"), "period_type")
    )


def brand_performance(s: Star, k: int = 25) -> DataFrame:
    rating = F.col("product_rating").cast("double")
    rated = F.when(rating.isNotNull(), F.col("orders"))
    brands = (
        s.per("product_id")
        .join(s.products.select("product_id", "brand", "category", "product_rating"), "product_id")
        .groupBy("brand", "category")
        .agg(
            F.sum("orders").alias("orders"),
            money(F.sum("revenue")).alias("revenue_inr"),
            money(ratio(F.sum(rating * F.col("orders")), F.sum(rated))).alias("avg_product_rating"),
        )
    )
    return top_k(brands, "revenue_inr", k, "brand", "category")


def prime_vs_nonprime(s: Star) -> DataFrame:
    label = F.when(F.col("is_prime_member"), "Prime").otherwise("Non-Prime").alias("member_type")
    return s.fact.groupBy(label).agg(
        *_named(_direct()), F.countDistinct("customer_id").alias("active_customers")
    )


def returns_by_category(s: Star) -> DataFrame:
    returned = F.count_if(is_returned(F.col("return_status")))
    return (
        s.per("product_id", returned=returned)
        .join(s.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("orders").alias("total_orders"), F.sum("returned").alias("returned_orders"))
        .withColumn("return_rate_pct", percent(F.col("returned_orders"), F.col("total_orders")))
        .orderBy(F.desc("return_rate_pct"), "category")
    )


def delivery_performance(s: Star) -> DataFrame:
    place = ["customer_city", "city_tier"]
    days = F.col("delivery_days")
    return (
        s.fact.where(days.isNotNull()).groupBy("customer_id")
        .agg(rows().alias("orders"), F.sum(days).alias("days"), F.count_if(days <= 4).alias("prompt"))
        .join(s.customers.select("customer_id", *place), "customer_id")
        .groupBy(*place)
        .agg(
            F.sum("orders").alias("orders"),
            money(ratio(F.sum("days"), F.sum("orders"))).alias("avg_delivery_days"),
            percent(F.sum("prompt"), F.sum("orders")).alias("on_time_pct"),
        )
        .orderBy(F.desc("orders"), *place)
    )


def discount_bucket(d: Column) -> Column:
    """Whole-number bands. Values between two bands and NULL belong to the last label."""
    chain = F.when(F.lit(False), F.lit(""))
    for label, (lo, hi) in zip(vocab.DISCOUNT_LABELS, vocab.DISCOUNT_BANDS):
        chain = chain.when(d.between(lo, hi), label)
    return chain.otherwise(vocab.DISCOUNT_LABELS[-1])


def discount_effectiveness(s: Star) -> DataFrame:
    d = F.col("discount_percent")
    rank = F.array_position(F.array(*map(F.lit, vocab.DISCOUNT_LABELS)), F.col("discount_bucket"))
    return (
        s.fact.groupBy(discount_bucket(d).alias("discount_bucket"))
        .agg(*_named(_direct()), money(ratio(F.sum(d), F.count(d))).alias("avg_discount_pct"))
        .orderBy(rank)
    )


def age_group_behavior(s: Star) -> DataFrame:
    return (
        s.per("customer_id").join(s.customers.select("customer_id", "age_group"), "customer_id")
        .groupBy("age_group").agg(*_named(_rolled()), rows().alias("unique_customers"))
        .select("age_group", "orders", "unique_customers", "avg_order_value", "revenue_inr")
        .orderBy(F.desc("revenue_inr"), "age_group")
    )


def customer_cohorts(s: Star) -> DataFrame:
    first = s.customers.where("first_purchase_date IS NOT NULL").select(
        "customer_id", F.date_format("first_purchase_date", "yyyy-MM").alias("cohort_month")
    )
    return (
        s.per("customer_id").join(first, "customer_id").groupBy("cohort_month")
        .agg(
            rows().alias("customers"),
            F.sum("orders").alias("orders"),
            money(F.sum("revenue")).alias("revenue_inr"),
            money(ratio(F.sum("revenue"), rows())).alias("arpu"),
        )
        .orderBy("cohort_month")
    )


VIEWS: dict[str, Callable[[Star], DataFrame]] = {
    "vw_kpi_summary": kpi_summary,
    "vw_yearly_revenue": yearly_revenue,
    "vw_monthly_revenue": monthly_revenue,
    "vw_category_performance": category_performance,
    "vw_top_customers": top_customers,
    "vw_payment_mix": payment_mix,
    "vw_geographic_revenue": geographic_revenue,
    "vw_festival_impact": festival_impact,
    "vw_brand_performance": brand_performance,
    "vw_prime_vs_nonprime": prime_vs_nonprime,
    "vw_returns_by_category": returns_by_category,
    "vw_delivery_performance": delivery_performance,
    "vw_discount_effectiveness": discount_effectiveness,
    "vw_age_group_behavior": age_group_behavior,
    "vw_customer_cohorts": customer_cohorts,
}


def register_views(warehouse: Warehouse, years: tuple[int, int] | None = None) -> list[str]:
    """Register tables and all views as temporary views; returns their names."""
    warehouse.register()
    star = Star.of(warehouse, years)
    for name, build in VIEWS.items():
        build(star).createOrReplaceTempView(name)
    return list(VIEWS)


def load_view(spark: SparkSession, name: str) -> DataFrame:
    """A registered view by its catalogued name."""
    if name not in VIEWS:
        raise KeyError(f"unknown view {name}")
    return spark.table(name)
