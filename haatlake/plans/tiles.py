"""Dashboard tiles: what the pages derive on top of the views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import (
    CRORE, fixed_label, halfup, money_label, percent, ratio, short_label,
)
from ..operators.shaping import pct_change, share_of, top_k
from ..sources.staging import materialise
from . import views
from .views import Star, rows


def crores(c: Column, digits: int = 6) -> Column:
    return halfup(c / CRORE, digits)


def _season(period: Column) -> Column:
    return F.when(period != "Normal", "Festival").otherwise("Normal")


def yearly_growth(s: Star) -> DataFrame:
    yearly = views.yearly_revenue(s).withColumn("revenue_cr", crores(F.col("revenue_inr")))
    return pct_change(yearly, "year", "revenue_inr", "yoy_pct").select(
        "year", "revenue_inr", "revenue_cr", "yoy_pct"
    )


def latest_year(s: Star) -> DataFrame:
    """Latest revenue, its growth, and the compound annual growth since the first year."""
    ends = yearly_growth(s).agg(
        F.max("year").alias("latest_year"),
        F.max_by("revenue_inr", "year").alias("latest_revenue_inr"),
        F.max_by("yoy_pct", "year").alias("latest_yoy_pct"),
        F.min_by("revenue_inr", "year").alias("_first"),
        rows().alias("_years"),
    )
    span = F.when(F.col("_years") > 1, F.col("_years") - 1)
    growth = F.pow(ratio(F.col("latest_revenue_inr"), F.col("_first")), F.try_divide(F.lit(1.0), span))
    cagr = F.when(F.col("_first") > 0, halfup((growth - 1) * 100, 4))
    return ends.withColumn("cagr_pct", cagr).drop("_first", "_years")


def top_categories(s: Star, k: int = 5) -> DataFrame:
    top = top_k(views.category_performance(s), "revenue_inr", k, "category")
    return top.select("category", "revenue_inr", crores(F.col("revenue_inr")).alias("revenue_cr"))


def festival_split(s: Star) -> DataFrame:
    return (
        views.festival_impact(s).groupBy(_season(F.col("period_type")).alias("type"))
        .agg(halfup(F.sum("revenue_inr")).alias("revenue"))
    )


def festival_by_year(s: Star) -> DataFrame:
    return (
        views.festival_impact(s)
        .groupBy("year", _season(F.col("period_type")).alias("is_festival"))
        .agg(crores(F.sum("revenue_inr")).alias("revenue_cr"))
    )


def _quarterly(s: Star) -> DataFrame:
    return (
        s.dated("year", "quarter").groupBy("year", "quarter")
        .agg(
            halfup(F.sum("final_amount_inr")).alias("revenue"),
            rows().alias("orders"),
            F.countDistinct("customer_id").alias("customers"),
            halfup(ratio(F.sum("final_amount_inr"), F.count("final_amount_inr"))).alias("aov"),
        )
    )


def quarterly_revenue(s: Star) -> DataFrame:
    return (
        s.dated("year", "quarter").groupBy("year", "quarter")
        .agg(halfup(F.sum("final_amount_inr")).alias("revenue"))
        .select("year", F.concat(F.lit("Q"), "quarter").alias("quarter_label"), "revenue",
                crores(F.col("revenue")).alias("revenue_cr"))
    )


def top_cities(s: Star, k: int = 15) -> DataFrame:
    cities = (
        views.geographic_revenue(s).where("customer_city IS NOT NULL").groupBy("customer_city")
        .agg(halfup(F.sum("revenue_inr")).alias("revenue_inr"))
    )
    return top_k(cities, "revenue_inr", k, "customer_city").withColumn(
        "revenue_cr", crores(F.col("revenue_inr"))
    )


def tier_revenue(s: Star) -> DataFrame:
    return views.geographic_revenue(s).groupBy("city_tier").agg(
        halfup(F.sum("revenue_inr")).alias("revenue_inr")
    )


def best_customers(s: Star, k: int = 20) -> DataFrame:
    return views.top_customers(s, k)


def best_brands(s: Star, k: int = 10) -> DataFrame:
    return views.brand_performance(s, k).withColumn("revenue_cr", crores(F.col("revenue_inr")))


def launches(s: Star) -> DataFrame:
    return (
        s.products.where("launch_year IS NOT NULL").groupBy("launch_year")
        .agg(rows().alias("new_products")).orderBy("launch_year")
    )


def delivery_kpis(s: Star) -> DataFrame:
    """Unweighted means over city rows; of equally prompt cities the busiest is named."""
    best = F.max_by("customer_city", F.struct("on_time_pct", "orders"))
    return views.delivery_performance(s).agg(
        halfup(ratio(F.sum("avg_delivery_days"), F.count("avg_delivery_days")), 4)
        .alias("avg_delivery_days"),
        best.alias("best_city"),
        F.max("on_time_pct").alias("best_on_time_pct"),
        rows().alias("cities_tracked"),
    )


def busiest_cities(s: Star, k: int = 15) -> DataFrame:
    return top_k(views.delivery_performance(s), "orders", k, "customer_city", "city_tier").select(
        "customer_city", "city_tier", "orders", "on_time_pct"
    )


def payment_share(s: Star) -> DataFrame:
    """Share of each method within its year, zero where a method was not used."""
    mix = (
        s.dated("year").where("payment_method IS NOT NULL").groupBy("year", "payment_method")
        .agg(rows().alias("orders"))
    )
    return share_of(mix, ["year"], "orders", "share_pct")


def seasonality(s: Star) -> DataFrame:
    """Year x month revenue matrix in crores."""
    months = list(range(1, 13))
    cells = views.monthly_revenue(s).withColumn("cr", crores(F.col("revenue_inr")))
    wide = cells.groupBy("year").pivot("month", months).agg(F.first("cr")).fillna(0.0)
    return wide.select("year", *[F.col(str(m)).alias(f"m{m:02d}") for m in months])


def quarterly_scorecard(s: Star) -> DataFrame:
    q = _quarterly(s)
    period = F.concat_ws(" Q", F.col("year").cast("string"), F.col("quarter").cast("string"))
    return q.select(period.alias("period"), crores(F.col("revenue")).alias("revenue_cr"),
                    "orders", "customers", "aov")


def forecast(s: Star, horizon: int = 3) -> DataFrame:
    """Least-squares line through yearly revenue (three years or more), and its extension.

    One row per year: kind 'actual' with the observed value, or 'forecast'.
    """
    yearly = views.yearly_revenue(s).select(
        F.col("year").cast("int"), (F.col("revenue_inr") / CRORE).alias("actual_cr")
    )
    x, y = F.col("year").cast("double"), F.col("actual_cr")
    line = yearly.agg(
        rows().alias("years"), F.regr_slope(y, x).alias("slope"), F.avg(x).alias("mx"),
        F.avg(y).alias("my"), F.max("year").alias("last"),
        F.collect_list(F.struct("year", "actual_cr")).alias("seen"),
    ).where("years >= 3")
    ahead = F.transform(
        F.sequence(F.col("last") + 1, F.col("last") + horizon),
        lambda t: F.struct(t.alias("year"), F.lit(None).cast("double").alias("actual_cr")),
    )
    points = line.select("slope", "mx", "my", F.explode(F.concat("seen", ahead)).alias("p"))
    return points.select(
        F.col("p.year").alias("year"),
        halfup(F.col("p.actual_cr"), 4).alias("actual_cr"),
        halfup(F.col("my") + F.col("slope") * (F.col("p.year") - F.col("mx")), 4).alias("fitted_cr"),
        F.when(F.col("p.actual_cr").isNull(), "forecast").otherwise("actual").alias("kind"),
    )


def kpi_cards(s: Star) -> DataFrame:
    """The summary as display text."""
    k = views.kpi_summary(s)
    cards = {
        "total_revenue": money_label(F.col("total_revenue_inr")),
        "active_customers": short_label(F.col("active_customers")),
        "total_orders": short_label(F.col("total_orders")),
        "avg_order_value": money_label(F.col("avg_order_value_inr")),
        "active_products": short_label(F.col("active_products")),
        "avg_customer_rating": fixed_label(F.col("avg_customer_rating"), 2, " ⭐"),
        "festival_share": fixed_label(F.col("festival_share_pct"), 1, "%"),
        "prime_share": fixed_label(F.col("prime_share_pct"), 1, "%"),
    }
    return k.select(*[c.alias(n) for n, c in cards.items()])


TILES: dict[str, Callable[[Star], DataFrame]] = {
    "yearly_growth": yearly_growth,
    "latest_year": latest_year,
    "top_categories": top_categories,
    "festival_split": festival_split,
    "festival_by_year": festival_by_year,
    "quarterly_revenue": quarterly_revenue,
    "top_cities": top_cities,
    "tier_revenue": tier_revenue,
    "best_customers": best_customers,
    "best_brands": best_brands,
    "launches": launches,
    "delivery_kpis": delivery_kpis,
    "busiest_cities": busiest_cities,
    "payment_share": payment_share,
    "seasonality": seasonality,
    "quarterly_scorecard": quarterly_scorecard,
    "forecast": forecast,
    "kpi_cards": kpi_cards,
}

# The six dashboard pages and what each shows: a view name or a tile name.
PAGES: dict[str, list[str]] = {
    "executive": ["vw_kpi_summary", "kpi_cards", "yearly_growth", "top_categories",
                  "vw_monthly_revenue", "festival_split"],
    "revenue": ["yearly_growth", "latest_year", "quarterly_revenue", "top_cities",
                "tier_revenue", "festival_by_year", "vw_discount_effectiveness"],
    "customer": ["vw_prime_vs_nonprime", "vw_age_group_behavior", "vw_customer_cohorts",
                 "best_customers"],
    "product": ["best_brands", "vw_category_performance", "vw_returns_by_category", "launches"],
    "operations": ["delivery_kpis", "busiest_cities", "payment_share", "vw_returns_by_category"],
    "advanced": ["seasonality", "quarterly_scorecard", "forecast"],
}


def page(s: Star, name: str) -> dict[str, DataFrame]:
    """All frames of one dashboard page."""
    return {t: (views.VIEWS.get(t) or TILES[t])(s) for t in PAGES[name]}
