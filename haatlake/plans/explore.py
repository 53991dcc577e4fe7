"""The twenty exploratory analyses: each returns the frames behind its chart panels.

Input is the cleaned dataset. Columns are looked up by name, and an analysis
whose columns are absent returns no panels.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import vocabulary as vocab
from ..functions.numbers import CRORE, halfup, percent, ratio
from ..functions.text import tier_of
from ..operators import shaping as sh
from ..operators.cleaning import first_order
from ..operators.sequences import followers
from ..operators.star import with_synonyms
from ..operators.winners import deciding_rows, first_of
from ..sources.staging import materialise
from .views import is_returned, rows

log = logging.getLogger(__name__)


class Panels(Mapping):
    """Frames by name. One given as a function is built when it is first read, with the stages it needs."""

    def __init__(self, frames: dict[str, DataFrame | Callable[[], DataFrame]] | None = None):
        self._frames = dict(frames or {})

    def __getitem__(self, name: str) -> DataFrame:
        frame = self._frames[name]
        if not isinstance(frame, DataFrame):
            frame = self._frames[name] = frame()
        return frame

    def __setitem__(self, name: str, frame: DataFrame | Callable[[], DataFrame]) -> None:
        self._frames[name] = frame

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

AMOUNTS = ("final_amount_inr", "final_amount", "amount", "original_price_inr")


def first_present(df: DataFrame, *names: str) -> str | None:
    return next((n for n in names if n in df.columns), None)


def amount_column(df: DataFrame) -> str:
    name = first_present(df, *AMOUNTS)
    if name is None:
        raise KeyError(f"no amount column, expected one of {AMOUNTS}")
    return name


def dated(df: DataFrame) -> DataFrame:
    """Adds _dt, _year, _month, _quarter from the typed or the text order date."""
    types = dict(df.dtypes)
    if types.get("order_date_dt") in ("date", "timestamp", "timestamp_ntz"):
        day = F.col("order_date_dt").cast("date")
    elif "order_date" in types:
        day = F.col("order_date").try_cast("date")
    else:
        day = F.lit(None).cast("date")
    return df.withColumn("_dt", day).withColumns(
        {"_year": F.year("_dt"), "_month": F.month("_dt"), "_quarter": F.quarter("_dt")}
    )


def exact(c: str | Column) -> Column:
    """A double as a decimal, so that its sum neither rounds nor depends on the order of rows."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("decimal(28,6)")


def total(c: str | Column) -> Column:
    """Sum that is zero, not NULL, when every value is missing."""
    return F.coalesce(F.sum(exact(c)).cast("double"), F.lit(0.0))


def revenue(c: str) -> Column:
    return halfup(total(c)).alias("revenue")


def mean(c: str) -> Column:
    return halfup(ratio(F.sum(exact(c)).cast("double"), F.count(c)))


def revenue_trend(df: DataFrame) -> Panels:
    amt, df = amount_column(df), dated(df)
    yearly = sh.present(df, "_year").groupBy(F.col("_year").alias("year")).agg(revenue(amt))
    return Panels({"yearly": sh.pct_change(yearly, "year", "revenue", "growth_pct")})


def seasonal_heatmap(df: DataFrame) -> Panels:
    amt, df = amount_column(df), dated(df)
    months = list(range(1, 13))
    wide = (
        sh.present(df, "_year").groupBy(F.col("_year").alias("year")).pivot("_month", months)
        .agg(halfup(F.sum(exact(amt)).cast("double") / CRORE, 6)).fillna(0.0)
    )
    return Panels({"matrix": wide.select("year", *[F.col(str(m)).alias(f"m{m:02d}") for m in months])})


def customer_values(df: DataFrame) -> DataFrame:
    """Recency, frequency and monetary value per customer with a dated purchase."""
    amt, df = amount_column(df), dated(df)
    today = df.agg(F.max("_dt")).scalar()
    visits = F.count("transaction_id") if "transaction_id" in df.columns else rows()
    return (
        sh.present(df, "customer_id").groupBy("customer_id")
        .agg(F.max("_dt").alias("_last"), visits.alias("frequency"),
             halfup(total(amt)).alias("monetary"))
        .where(F.col("_last").isNotNull())
        .select("customer_id", F.datediff(today, "_last").alias("recency"), "frequency", "monetary")
    )


def segment_of(score: Column) -> Column:
    chain = F.when(F.lit(False), F.lit(""))
    for least, name in vocab.SEGMENTS:
        chain = chain.when(score >= least, name)
    return chain.otherwise(vocab.LOWEST_SEGMENT)


def rfm_segmentation(df: DataFrame) -> Panels:
    """Quintile scores. Frequency ranks its ties by customer id; four cut points decide, not a rank for each row."""
    @cache
    def scores() -> DataFrame:
        values = materialise(customer_values(df), "rfm")
        scored = sh.qcut(values, {"recency": "_r", "monetary": "m_score"}, 5)
        return (
            scored.withColumn("r_score", 6 - F.col("_r"))
            .withColumn("f_score", sh.rank_bucket(values, "frequency", "customer_id", 5))
            .withColumn("score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
            .withColumn("segment", segment_of(F.col("score")))
            .drop("_r")
        )

    return Panels({"scores": scores, "segments": lambda: scores().groupBy("segment").agg(rows().alias("customers"))})


def _share_grid(df: DataFrame, row: str, col: str, value: str = "orders") -> DataFrame:
    """Counts of the pairs that occur, with each row's percentages. A pair that is absent is zero."""
    counted = sh.present(df, row, col).groupBy(row, col).agg(rows().alias(value))
    return sh.share_of(counted, [row], value, "share_pct")


def payment_evolution(df: DataFrame) -> Panels:
    if "payment_method" not in df.columns:
        return Panels()
    yearly = dated(df).withColumnRenamed("_year", "year")
    return Panels({"share": _share_grid(yearly, "year", "payment_method")})


def category_performance(
    df: DataFrame, early: tuple[int, int] = (2015, 2017), late: tuple[int, int] = (2023, 2025)
) -> Panels:
    """Revenue, share and growth between two year windows; growth needs both windows."""
    if "category" not in df.columns:
        return Panels()
    amt, df = amount_column(df), dated(df)
    within = lambda span: F.col("_year").between(*span)
    window = lambda span: F.when(
        F.count_if(within(span)) > 0, total(F.when(within(span), F.col(amt)))
    )
    sums = sh.present(df, "category").groupBy("category").agg(
        total(amt).alias("_rev"), window(early).alias("_early"), window(late).alias("_late")
    )
    whole = df.where(F.col("category").isNotNull()).agg(total(amt)).scalar()
    panels = sums.select(
        "category", halfup(F.col("_rev")).alias("revenue"),
        percent(F.col("_rev"), whole).alias("share_pct"),
        percent(F.col("_late") - F.col("_early"), F.col("_early")).alias("growth_pct"),
    )
    return Panels({
        "revenue": panels.select("category", "revenue", "share_pct"),
        "growth": panels.select("category", "growth_pct").where("growth_pct IS NOT NULL"),
    })


def prime_impact(df: DataFrame) -> Panels:
    if "is_prime_member" not in df.columns:
        return Panels()
    amt = amount_column(df)
    flag = F.col("is_prime_member")
    label = F.when(flag, "Prime").when(~flag, "Non-Prime").otherwise("Unknown")
    df = df.withColumn("prime_label", label)
    panels = Panels({"orders": df.groupBy("prime_label").agg(mean(amt).alias("aov"), rows().alias("orders"))})
    if "category" in df.columns:
        panels["mix"] = _share_grid(df, "prime_label", "category")
    return panels


def geographic(df: DataFrame) -> Panels:
    amt, panels = amount_column(df), Panels()
    if "customer_city" in df.columns:
        cities = sh.present(df, "customer_city").groupBy("customer_city").agg(revenue(amt))
        panels["cities"] = sh.top_k(cities, "revenue", 15, "customer_city")
    tier = first_present(df, "customer_tier", "city_tier", "tier")
    if tier is None and "customer_city" in df.columns:
        tiers = vocab.city_tiers(vocab.TIER1_CITIES_EXPLORE)
        tier, df = "_tier", df.withColumn(
            "_tier", tier_of(F.col("customer_city"), tiers, vocab.DEFAULT_TIER))
    if tier:
        panels["tiers"] = sh.present(df, tier).groupBy(F.col(tier).alias("tier")).agg(revenue(amt))
    return panels


def festival_impact(df: DataFrame) -> Panels:
    if "is_festival_sale" not in df.columns:
        return Panels()
    amt, df = amount_column(df), dated(df)
    kind = F.when(F.col("is_festival_sale"), "Festival").otherwise("Normal")
    daily = sh.present(df, "_dt", "is_festival_sale")
    panels = Panels({"daily": daily.groupBy(F.col("_dt").alias("order_day"), kind.alias("period"))
              .agg(revenue(amt))})
    if "festival_name" in df.columns:
        named = sh.present(df.where("is_festival_sale"), "festival_name")
        panels["festivals"] = sh.top_k(
            named.groupBy("festival_name").agg(revenue(amt)), "revenue", 5, "festival_name")
    return panels


def age_groups(df: DataFrame) -> Panels:
    df = with_synonyms(df)
    if "age_group" not in df.columns:
        return Panels()
    amt = amount_column(df)
    spend = sh.present(df, "age_group").groupBy("age_group").agg(
        revenue(amt), mean(amt).alias("aov"), F.count(amt).alias("orders"))
    panels = Panels({"spend": spend})
    if "category" in df.columns:
        panels["mix"] = _share_grid(df, "age_group", "category")
    return panels


def deterministic_sample(df: DataFrame, columns: list[str], size: int, seed: int) -> DataFrame:
    """The `size` rows with the smallest seeded hash of ids and columns, or all if there are fewer.

    Rows are counted by the hash's first digits, at most 65,536 counts. The first digits that hold
    `size` rows bound what is ordered, so no task or merge sees many more, whatever the rows hold.
    """
    ids = [c for c in ("transaction_id", "customer_id", "product_id") if c in df.columns]
    types = dict(df.dtypes)
    plain = lambda c: exact(c).cast("string") if types[c] in ("double", "float") else F.col(c).cast("string")
    content = [plain(c) for c in (*ids, *[c for c in columns if c not in ids])]
    digest = F.md5(F.concat_ws("|", *content, F.lit(str(seed))))
    hashed = sh.present(df, *columns).select(*columns, *[c for c in ids if c not in columns]).withColumn("_h", digest)
    lead = F.substring("_h", 1, 4)
    below = (hashed.groupBy(lead.alias("lead")).agg(rows().alias("n"))
             .withColumn("before", F.sum("n").over(W.orderBy("lead")) - F.col("n")))
    last = below.where(F.col("before") < size).agg(F.max("lead")).scalar()
    return hashed.where(lead <= last).orderBy("_h", *ids, *columns).limit(size).drop("_h")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson coefficients of all pairs, pairwise complete, from sums of products in a single pass.

    Rows are summed by which of the columns they lack, at most one group for each set of missing columns; a pair's
    sums are those of the groups that have both. Values are taken as differences from a
    few rows' mean of each column, so that a large common offset doesn't drown what differs; differences from the
    column's mean follow from the sums. Sums are plain ones that combine on the map side.
    """
    k = len(columns)
    values = [F.col(c).cast("double") for c in columns]
    numbers = df.select(*[F.when(~F.isnan(v), v).alias(f"x{i}") for i, v in enumerate(values)])
    near = numbers.limit(100).agg(F.struct(*[F.coalesce(F.avg(f"x{i}"), F.lit(0.0)).alias(f"x{i}") for i in range(k)])).scalar()
    moved = numbers.select(*[(F.col(f"x{i}") - near[f"x{i}"]).alias(f"d{i}") for i in range(k)])
    lacks = sum((F.when(F.col(f"d{i}").isNull(), 1 << i).otherwise(0) for i in range(k)), F.lit(0)).alias("lacks")
    sums = moved.groupBy(lacks).agg(
        rows().alias("n"), *[F.sum(f"d{i}").alias(f"s{i}") for i in range(k)],
        *[F.sum(F.col(f"d{i}") * F.col(f"d{j}")).alias(f"p{i}_{j}") for i in range(k) for j in range(i, k)])
    # From here on there is a row for each set of missing columns.
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def coefficient(i: int, j: int) -> Column:
        both = F.expr(f"lacks & {1 << i | 1 << j} = 0")
        n, a, b, aa, bb, ab = (F.sum(F.when(both, F.col(c))) for c in ("n", f"s{i}", f"s{j}", f"p{i}_{i}", f"p{j}_{j}", f"p{i}_{j}"))
        spread = F.greatest(aa - a * a / n, F.lit(0.0)) * F.greatest(bb - b * b / n, F.lit(0.0))
        return F.when(spread > 0, (ab - a * b / n) / F.sqrt(spread))

    found = sums.agg(F.array(*[halfup(coefficient(i, j), 4) for i, j in pairs]).alias("r")).scalar()
    names = [(columns[x], columns[y], at) for at, (i, j) in enumerate(pairs) for x, y in dict.fromkeys([(i, j), (j, i)])]
    return df.sparkSession.createDataFrame(names, "var_x string, var_y string, at int").select("var_x", "var_y", found[F.col("at")].alias("r"))


def price_vs_demand(df: DataFrame, sample_size: int = 20_000, seed: int = 42) -> Panels:
    amt = amount_column(df)
    price = first_present(df, "original_price_inr", "price", "base_price_2015")
    if price is None or "category" not in df.columns:
        return Panels()
    numeric = [c for c in vocab.CORRELATED_COLUMNS if c in df.columns]
    columns = list(dict.fromkeys([price, amt, "category"]))
    return Panels({
        "sample": lambda: deterministic_sample(df, columns, sample_size, seed).select(*columns),
        "correlation": correlations(df, numeric),
    })


def delivery_performance(df: DataFrame) -> Panels:
    """Missing days count as late here, unlike in the warehouse view."""
    if "delivery_days" not in df.columns:
        return Panels()
    panels = Panels({
        "histogram": sh.histogram(df, "delivery_days", 20),
        "median": sh.median(df, "delivery_days"),
    })
    if "customer_city" in df.columns:
        prompt = F.coalesce(F.col("delivery_days") <= 4, F.lit(False))
        cities = sh.present(df, "customer_city").groupBy("customer_city").agg(
            rows().alias("orders"), percent(F.count_if(prompt), rows()).alias("on_time_pct"))
        panels["cities"] = sh.top_k(cities, "orders", 12, "customer_city").orderBy(
            "on_time_pct", "customer_city")
    return panels


def returns_satisfaction(df: DataFrame) -> Panels:
    status = first_present(df, "return_status", "is_returned")
    if status is None:
        return Panels()
    df = df.withColumn("returned", is_returned(F.col(status).cast("string")))
    panels = Panels()
    if "category" in df.columns:
        panels["by_category"] = sh.present(df, "category").groupBy("category").agg(
            percent(F.count_if("returned"), rows()).alias("return_pct"))
    if "customer_rating" in df.columns:
        panels["ratings"] = lambda: sh.box_stats(df, "returned", "customer_rating")
    return panels


def brand_performance(df: DataFrame) -> Panels:
    """Everything derives from one brand x year aggregate."""
    if "brand" not in df.columns:
        return Panels()
    amt = amount_column(df)
    yearly = (sh.present(dated(df), "brand").groupBy(F.col("_year").alias("year"), "brand")
              .agg(total(amt).alias("revenue")))
    top = sh.top_k(yearly.groupBy("brand").agg(revenue("revenue")), "revenue", 10, "brand")
    kept = sh.present(yearly.join(F.broadcast(top.select("brand")), "brand"), "year")
    share = sh.share_of(kept, ["year"], "revenue", "share_pct")
    return Panels({"top": top, "share": share.withColumn("revenue", halfup(F.col("revenue")))})


def clv_cohort(df: DataFrame, cohorts: int = 24, horizon: int = 13) -> Panels:
    """Retention by months since the first purchase, and lifetime value per customer.

    Purchases are reduced to distinct (customer, month) pairs first, so the
    per-customer window holds at most as many rows as there are months.
    """
    amt, df = amount_column(df), sh.present(dated(df), "_dt", "customer_id")
    month = F.col("_year") * 12 + F.col("_month") - 1
    active = df.select("customer_id", month.alias("month")).distinct()
    since = active.withColumn("cohort", F.min("month").over(W.partitionBy("customer_id"))).select(
        "cohort", (F.col("month") - F.col("cohort")).alias("age"))
    counts = since.groupBy("cohort").pivot("age", list(range(horizon))).agg(rows()).fillna(0)
    first = counts.orderBy("cohort").limit(cohorts)
    label = F.format_string("%04d-%02d", F.floor(F.col("cohort") / 12), F.col("cohort") % 12 + 1)
    retention = first.select(
        label.alias("cohort_month"),
        *[percent(F.col(str(i)), F.col("0")).alias(f"m{i:02d}") for i in range(horizon)],
    )
    clv = cache(lambda: materialise(df.groupBy("customer_id").agg(halfup(total(amt)).alias("clv")), "clv"))
    logs = lambda: clv().where("clv > 0").select(F.log10("clv").alias("log10_clv"))
    return Panels({
        "retention": retention,
        "clv_median": lambda: sh.median(clv(), "clv"),
        "clv_histogram": lambda: sh.histogram(logs(), "log10_clv", 50),
    })


def discount_effectiveness(df: DataFrame) -> Panels:
    """Right-closed bands (-0.1, 0], (0, 10] ... (50, 100]; every band is listed."""
    if "discount_percent" not in df.columns:
        return Panels()
    amt, d = amount_column(df), F.col("discount_percent").cast("double")
    edges = vocab.DISCOUNT_EDGES
    chain = F.when(F.lit(False), F.lit(""))
    for label, lo, hi in zip(vocab.DISCOUNT_LABELS, edges, edges[1:]):
        chain = chain.when((d > lo) & (d <= hi), label)
    sums = sh.present(df.withColumn("discount_bucket", chain), "discount_bucket") \
        .groupBy("discount_bucket").agg(rows().alias("orders"), revenue(amt), mean(amt).alias("aov"))
    labels = df.sparkSession.createDataFrame(
        list(enumerate(vocab.DISCOUNT_LABELS, 1)), "position int, discount_bucket string")
    return Panels({"buckets": labels.join(sums, "discount_bucket", "left")
                   .fillna(0, ["orders"]).fillna(0.0, ["revenue"])
                   .select("position", "discount_bucket", "orders", "revenue", "aov")})


def rating_patterns(df: DataFrame) -> Panels:
    rating = first_present(df, "customer_rating", "product_rating")
    if rating is None:
        return Panels()
    amt = amount_column(df)
    panels = Panels({"histogram": sh.histogram(df, rating, 20)})
    if "category" in df.columns:
        panels["categories"] = sh.present(df, "category").groupBy("category").agg(
            mean(rating).alias("avg_rating"), revenue(amt)).where("avg_rating IS NOT NULL")
    return panels


def customer_journey(df: DataFrame) -> Panels:
    """Share of each next category after a purchase in a category, in the order of day and transaction id."""
    if "category" not in df.columns:
        return Panels()
    df = sh.present(dated(df), "_dt", "category", "customer_id")
    order = ["_dt", *[c for c in ("transaction_id",) if c in df.columns]]

    def transitions() -> DataFrame:
        moves = followers(df, "customer_id", order, "category").withColumnsRenamed(
            {"value": "category", "next_value": "next_category", "n": "moves"})
        return sh.share_of(moves, ["category"], "moves", "share_pct")

    return Panels({"transitions": transitions})


def product_lifecycle(df: DataFrame) -> Panels:
    amt, df, panels = amount_column(df), dated(df), Panels()
    if "launch_year" in df.columns:
        def launches() -> DataFrame:
            """Of each product's first row."""
            order = first_order(df, ["launch_year"])
            day = [c for c in ("order_date_dt", "transaction_id") if c in df.columns]
            if "order_date_dt" in df.columns:
                products = deciding_rows(df.select("product_id", "launch_year", *day), "product_id", F.col("order_date_dt"), order, last=False)
            else:
                products = first_of(df.select("product_id", "launch_year", *day), ["product_id"], order)
            return sh.present(products, "launch_year").groupBy("launch_year").agg(rows().alias("products"))

        panels["launches"] = launches
    if "category" in df.columns:
        yearly = sh.present(df, "_year", "category").groupBy(F.col("_year").alias("year"), "category").agg(
            total(amt).alias("revenue"))
        panels["trend"] = yearly.select(
            "year", "category", halfup(F.col("revenue") / CRORE, 6).alias("revenue_cr"))
    return panels


def competitive_pricing(df: DataFrame) -> Panels:
    price, panels = first_present(df, "original_price_inr", "price"), Panels()
    if price is None:
        return Panels()
    if "category" in df.columns:
        panels["categories"] = lambda: sh.box_stats(sh.present(df, "category"), "category", price)
    if "brand" in df.columns:
        brands = sh.present(df, "brand").groupBy("brand").agg(rows().alias("n"))
        top = sh.top_k(brands, "n", 10, "brand").select("brand")
        panels["brands"] = lambda: sh.box_stats(df.join(F.broadcast(top), "brand"), "brand", price)
    return panels


def business_health(df: DataFrame) -> Panels:
    amt, df = amount_column(df), dated(df)
    by_year = sh.present(df, "_year").groupBy(F.col("_year").alias("year"))
    measures = [revenue(amt), mean(amt).alias("aov")]
    if "customer_id" in df.columns:
        measures.append(F.countDistinct("customer_id").alias("active_customers"))
    panels = Panels({"yearly": by_year.agg(*measures)})
    if "category" in df.columns:
        panels["categories"] = sh.top_k(
            sh.present(df, "category").groupBy("category").agg(revenue(amt)), "revenue", 5, "category")
    for name, col, keep in (("prime", "is_prime_member", None), ("payments", "payment_method", 6)):
        if col in df.columns:
            counted = sh.present(df, col).groupBy(col).agg(rows().alias("orders"))
            whole = df.agg(F.count(col)).scalar()
            share = counted.withColumn("share_pct", percent(F.col("orders"), whole))
            panels[name] = sh.top_k(share, "orders", keep, col) if keep else share
    if "return_status" in df.columns:
        returned = is_returned(F.col("return_status"), vocab.RETURNED_WORDS_HEALTH)
        rate = percent(F.count_if(returned), rows())
        panels["returns"] = df.agg(rate.alias("returned_pct"), (100 - rate).alias("kept_pct"))
    return panels


ANALYSES: dict[str, Callable[[DataFrame], Panels]] = {
    "e01_revenue_trend": revenue_trend,
    "e02_seasonal_heatmap": seasonal_heatmap,
    "e03_rfm_segmentation": rfm_segmentation,
    "e04_payment_evolution": payment_evolution,
    "e05_category_performance": category_performance,
    "e06_prime_impact": prime_impact,
    "e07_geographic": geographic,
    "e08_festival_impact": festival_impact,
    "e09_age_groups": age_groups,
    "e10_price_vs_demand": price_vs_demand,
    "e11_delivery_performance": delivery_performance,
    "e12_returns_satisfaction": returns_satisfaction,
    "e13_brand_performance": brand_performance,
    "e14_clv_cohort": clv_cohort,
    "e15_discount_effectiveness": discount_effectiveness,
    "e16_rating_patterns": rating_patterns,
    "e17_customer_journey": customer_journey,
    "e18_product_lifecycle": product_lifecycle,
    "e19_competitive_pricing": competitive_pricing,
    "e20_business_health": business_health,
}


def run_all(
    df: DataFrame, analyses: dict[str, Callable[[DataFrame], Panels]] | None = None,
    sink: Callable[[str, str, DataFrame], None] | None = None,
) -> tuple[dict[str, Panels], dict[str, Exception]]:
    """Panels of every analysis. One that fails is reported and does not stop the others.

    With a sink, each panel is handed to it at once (analysis, panel, frame), so that values
    which fail only when they are computed are caught as well. Without, reading them may fail.
    """
    done, failed = {}, {}
    for name, analyse in (analyses or ANALYSES).items():
        try:
            panels = analyse(df)
            for panel in panels if sink else ():
                sink(name, panel, panels[panel])
            done[name] = panels
        except Exception as e:  # noqa: BLE001 - isolation is the point
            log.warning("%s failed: %s", name, e)
            failed[name] = e
    return done, failed
