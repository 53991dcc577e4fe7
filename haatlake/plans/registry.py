"""Every operator as a named query over the tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions import vocabulary as vocab
from ..functions.parsing import stored_flag_of
from ..functions.text import tier_of
from ..operators import cleaning, quality, shaping, star
from ..sources import files
from ..sources.staging import materialise, new_path
from ..sources.warehouse import Warehouse
from . import explore, tiles, views
from .views import Star, rows
from .workspace import Workspace, workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types every SQL engine renders alike: dates as text, decimals as doubles."""
    def cast(name: str, type_: str):
        if type_ == "date":
            return F.date_format(name, "yyyy-MM-dd").alias(name)
        if type_.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if type_ in ("tinyint", "smallint"):
            return F.col(name).cast("int").alias(name)
        return F.col(name)
    return df.select(*[cast(n, t) for n, t in df.dtypes])


def query(name: str) -> Callable[[Callable[[Workspace], DataFrame]], Callable]:
    def register(build: Callable[[Workspace], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: portable(build(workspace(spark, sf_dir)))
        return build
    return register


# Of each table, the key and what two loads are compared by.
CONTENT = {
    "dim_time": ("date_id", ["full_date", "month_name"]),
    "dim_products": ("product_id", ["product_name", "category", "brand", "launch_year", "model"]),
    "dim_customers": ("customer_id", ["customer_city", "city_tier", "age_group", "is_prime_member", "customer_spending_tier",
                                      "first_purchase_date", "last_purchase_date"]),
    "fact_transactions": ("transaction_id", ["customer_id", "product_id", "date_id", "payment_method"]),
}


# --- sources and sinks -------------------------------------------------------

def write_year_files(ws: Workspace) -> str:
    """The raw sales as one CSV folder per year, its files compressed as text is large; later years have an extra column."""
    folder = new_path(ws.spark, "year-files")
    years = [r[0] for r in ws.raw.select("_source_year").distinct().orderBy(1).collect()]
    for y in years:
        part = ws.raw.where(F.col("_source_year") == y).drop("_source_year")
        part = part.drop("delivery_type") if y < "2018" else part.select(*sorted(part.columns))
        part.write.option("header", True).option("compression", "gzip").csv(f"{folder}/sales_{y}.csv")
    return folder


@query("s01_year_files")
def _(ws):
    tx = files.typed(files.load_year_files(ws.spark, write_year_files(ws)))
    return tx.groupBy("_source_year").agg(
        rows().alias("n"), F.count("transaction_id").alias("with_id"),
        F.count("delivery_type").alias("with_delivery_type"),
        F.countDistinct("customer_id").alias("customers"),
        F.sum("quantity").alias("quantity"),
        explore.revenue("final_amount_inr"),
    )


@query("s04_encoding_fallback")
def _(ws):
    """The early years as UTF-8, the later ones as latin-1; both keep their accents."""
    folder = new_path(ws.spark, "encodings")
    names = ws.raw.select("_source_year", F.concat("product_name", F.lit(" é")).alias("product_name"))
    for label, encoding, years in (("old", "UTF-8", "<= '2018'"), ("new", "ISO-8859-1", "> '2018'")):
        names.where(f"_source_year {years}").select("product_name").write \
            .option("header", True).option("encoding", encoding).csv(f"{folder}/sales_{label}.csv")
    read = files.load_year_files(ws.spark, folder, encoding="auto")
    return read.groupBy("_source_year").agg(
        rows().alias("n"), F.count_if(F.col("product_name").endswith("é")).alias("accented"))


@query("s05_catalog_file")
def _(ws):
    folder = new_path(ws.spark, "catalog")
    ws.catalog.write.option("header", True).csv(f"{folder}/Products_Catalog_2015.csv")
    return files.load_catalog(ws.spark, folder)


@query("s06_observed_counts")
def _(ws):
    """Row counts seen while both inputs pass through a write."""
    folder = write_year_files(ws)
    ws.catalog.write.option("header", True).csv(f"{folder}/sales_products_catalog.csv")
    tx, catalog, seen = files.load_raw_data(ws.spark, folder)
    for df in (tx, catalog):
        df.write.format("noop").mode("overwrite").save()
    counts = [(n, o.get["row_count"]) for n, o in seen.items()]
    return ws.spark.createDataFrame(counts, "source string, row_count bigint")


@query("s07_clean_dataset")
def _(ws):
    return ws.cleaned.groupBy("order_year_dt").agg(
        rows().alias("n"), F.count("original_price_inr").alias("priced"),
        F.count_if("is_bulk_order").alias("bulk"), explore.revenue("final_amount_inr"))


@query("s08_clean_csv_fallback")
def _(ws):
    path = new_path(ws.spark, "clean-csv")
    ws.cleaned.drop("order_year_dt").write.option("header", True).option("compression", "gzip").csv(path)
    return files.read_clean(ws.spark, f"{path}-absent", path).groupBy(F.year("order_date_dt").alias("y")).agg(
        rows().alias("n"), F.count("original_price_inr").alias("priced"),
        F.count_if("is_bulk_order").alias("bulk"), explore.revenue("final_amount_inr"))


@query("s09_warehouse_load")
def _(ws):
    return ws.warehouse.table("fact_transactions").groupBy("order_year").agg(
        rows().alias("n"), F.countDistinct("date_id").alias("days"),
        views.money(F.sum("final_amount_inr")).alias("revenue"))


@query("s12_row_counts")
def _(ws):
    return ws.warehouse.row_counts()


@query("s10_warehouse_append")
def _(ws):
    """Content of all tables: the early years loaded, then the whole dataset appended twice over."""
    w = Warehouse(ws.spark, new_path(ws.spark, "append"))
    w.load(ws.cleaned.where("order_year_dt <= 2018"))
    w.load(ws.cleaned, truncate=False)
    w.load(ws.cleaned, truncate=False)
    parts = [
        w.table(name).select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("key"),
                             F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]).alias("content"))
        for name, (key, columns) in CONTENT.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("s13_bound_sql")
def _(ws):
    return ws.warehouse.sql(
        "SELECT payment_method, count(*) AS orders, "
        "CAST(sum(final_amount_inr) AS DOUBLE) AS revenue FROM fact_transactions "
        "WHERE year(order_date) BETWEEN :lo AND :hi GROUP BY payment_method",
        {"lo": 2016, "hi": 2018})


@query("s14_view_scan")
def _(ws):
    views.register_views(ws.warehouse)
    return views.load_view(ws.spark, "vw_yearly_revenue")


@query("s15_years")
def _(ws):
    return ws.warehouse.years()


@query("s15_year_bounds")
def _(ws):
    return ws.warehouse.year_range()


@query("s15_year_filtered_view")
def _(ws):
    return views.yearly_revenue(ws.star(years=(2017, 2019)))


# --- cleaning ----------------------------------------------------------------

def _cleaned_column(name: str, clean: Callable[[DataFrame], DataFrame], *columns: str) -> None:
    query(name)(lambda ws: clean(ws.raw_once()).select("transaction_id", *columns))


_cleaned_column("c01_dates", cleaning.fix_dates, "order_date", "order_date_dt")
_cleaned_column("c02_prices", cleaning.fix_prices, "original_price_inr")
_cleaned_column("c03_ratings", cleaning.fix_ratings, "customer_rating")
_cleaned_column("c04_cities", cleaning.fix_cities, "customer_city")
_cleaned_column("c05_booleans", cleaning.fix_booleans, *cleaning.FLAG_COLUMNS)
_cleaned_column("c06_categories", cleaning.fix_categories, "category")
_cleaned_column("c07_delivery_days", cleaning.fix_delivery_days, "delivery_days")
_cleaned_column("c10_payment_methods", cleaning.fix_payment_methods, "payment_method")


@query("c08_duplicates")
def _(ws):
    return cleaning.handle_duplicates(materialise(cleaning.clean_rows(ws.raw_once()), "rows")).select(
        "transaction_id", *cleaning.DUPLICATE_KEY, "is_bulk_order", "bulk_qty")


@query("c09_price_repair")
def _(ws):
    rows_ = cleaning.handle_duplicates(materialise(cleaning.clean_rows(ws.raw_once()), "rows"), stage=materialise)
    return cleaning.fix_price_outliers(rows_).select(
        "transaction_id", "category", explore.halfup(F.col("original_price_inr"), 4)
        .alias("original_price_inr"), "price_was_corrected")


@query("c11_clean_all")
def _(ws):
    catalog_only = ["base_price_2015", "weight_kg", "rating", "launch_year", "model"]
    rounded = {c: explore.halfup(F.col(c), 4) for c in ("original_price_inr", "subtotal_inr")}
    return ws.cleaned.drop("order_year_dt", *catalog_only).withColumns(rounded)


@query("c12_catalog_enrich")
def _(ws):
    return ws.cleaned.select("transaction_id", "product_id", "base_price_2015", "weight_kg",
                             "rating", "launch_year", "model")


# --- quality -----------------------------------------------------------------

query("i01_null_profile_before")(lambda ws: quality.null_profile(ws.raw))
query("i01_null_profile_after")(lambda ws: quality.null_profile(ws.cleaned.drop("order_year_dt")))
query("i02_shape")(lambda ws: quality.shape_comparison(ws.raw, ws.cleaned.drop("order_year_dt")))
query("i03_value_samples")(lambda ws: quality.value_samples(ws.cleaned))
query("i04_flag_tallies")(lambda ws: quality.flag_tallies(ws.cleaned))
query("i05_key_violations")(lambda ws: quality.key_violations(ws.warehouse.tables()))
query("i06_quality_report")(
    lambda ws: quality.quality_report(ws.raw, ws.cleaned.drop("order_year_dt")))


# --- star schema -------------------------------------------------------------

query("w01_dim_time")(lambda ws: ws.warehouse.table("dim_time"))
query("w02_dim_products")(lambda ws: ws.warehouse.table("dim_products"))
query("w03_dim_customers")(lambda ws: ws.warehouse.table("dim_customers"))
query("w04_fact_transactions")(
    lambda ws: ws.warehouse.table("fact_transactions").select(*star.FACT_COLUMNS))


@query("w05_city_tiers")
def _(ws):
    tier = lambda t: tier_of(F.col("customer_city"), vocab.city_tiers(t), vocab.DEFAULT_TIER)
    return ws.cleaned.groupBy("customer_city").agg(rows().alias("n")).select(
        "customer_city", "n", tier(vocab.TIER1_CITIES).alias("warehouse_tier"),
        tier(vocab.TIER1_CITIES_EXPLORE).alias("explore_tier"))


@query("w06_stored_flags")
def _(ws):
    return ws.raw_once().groupBy("is_prime_member").agg(rows().alias("n")).withColumn(
        "stored", stored_flag_of(F.col("is_prime_member")))


# --- shared primitives on the given tables -----------------------------------

@query("x01_share_of")
def _(ws):
    counted = ws.raw_once().groupBy("brand", "subcategory").agg(rows().alias("n"))
    return shaping.share_of(counted, ["brand"], "n", "share_pct")


@query("x02_top_k")
def _(ws):
    spent = ws.raw_once().groupBy("product_id").agg(explore.revenue("final_amount_inr"))
    return shaping.top_k(spent, "revenue", 25, "product_id")


@query("x06_pct_change")
def _(ws):
    monthly = ws.raw_once().groupBy((F.col("order_year") * 12 + F.col("order_month")).alias("month_no")).agg(
        explore.revenue("final_amount_inr"))
    return shaping.pct_change(monthly, "month_no", "revenue", "change_pct")


@query("x07_alias_lookup")
def _(ws):
    key = text.first_alternative(text.folded(F.col("payment_method")))
    return ws.raw_once().groupBy("payment_method").agg(rows().alias("n")).withColumn(
        "method", text.lookup(key, vocab.PAYMENT_ALIASES))


@query("x03_histogram")
def _(ws):
    return shaping.histogram(ws.raw, "final_amount_inr", 10)


@query("x04_box_stats")
def _(ws):
    return shaping.box_stats(ws.raw_once(), "brand", "final_amount_inr")


@query("x05_qcut")
def _(ws):
    spent = ws.raw_once().dropna(subset=["customer_id"]).groupBy("customer_id").agg(
        explore.revenue("final_amount_inr"))
    return shaping.qcut(materialise(spent), {"revenue": "bucket"}, 5)


@query("x08_global_rank")
def _(ws):
    spent = ws.raw_once().dropna(subset=["customer_id"]).groupBy("customer_id").agg(
        F.count("transaction_id").alias("orders"))
    return shaping.global_rank(materialise(spent), ["orders", "customer_id"], "position")


# --- views, analyses, tiles --------------------------------------------------

for _i, (_name, _build) in enumerate(views.VIEWS.items(), 1):
    query(f"v{_i:02d}_{_name.removeprefix('vw_')}")(lambda ws, b=_build: b(ws.star()))

_TILE_NUMBERS = {
    "yearly_growth": 1, "latest_year": 2, "top_categories": 3, "festival_split": 4,
    "festival_by_year": 4, "quarterly_revenue": 5, "top_cities": 6, "tier_revenue": 6,
    "best_customers": 7, "best_brands": 8, "launches": 9, "delivery_kpis": 10,
    "busiest_cities": 11, "payment_share": 12, "seasonality": 13, "quarterly_scorecard": 14,
    "forecast": 15, "kpi_cards": 16,
}
for _name, _tile in tiles.TILES.items():
    query(f"p{_TILE_NUMBERS[_name]:02d}_{_name}")(lambda ws, b=_tile: b(ws.star()))

_PANELS = {
    "e01_revenue_trend": ["yearly"], "e02_seasonal_heatmap": ["matrix"],
    "e03_rfm_segmentation": ["scores", "segments"], "e04_payment_evolution": ["share"],
    "e05_category_performance": ["revenue"], "e06_prime_impact": ["orders", "mix"],
    "e07_geographic": ["cities", "tiers"], "e08_festival_impact": ["daily", "festivals"],
    "e09_age_groups": ["spend", "mix"], "e10_price_vs_demand": ["sample", "correlation"],
    "e11_delivery_performance": ["histogram", "median", "cities"],
    "e12_returns_satisfaction": ["by_category", "ratings"],
    "e13_brand_performance": ["top", "share"],
    "e14_clv_cohort": ["retention", "clv_median", "clv_histogram"],
    "e15_discount_effectiveness": ["buckets"],
    "e16_rating_patterns": ["histogram", "categories"], "e17_customer_journey": ["transitions"],
    "e18_product_lifecycle": ["launches", "trend"],
    "e19_competitive_pricing": ["categories", "brands"],
    "e20_business_health": ["yearly", "categories", "prime", "payments", "returns"],
}
for _name, _panels in _PANELS.items():
    for _panel in _panels:
        query(f"{_name}__{_panel}")(
            lambda ws, a=explore.ANALYSES[_name], p=_panel: a(ws.cleaned)[p])


@query("e05_category_performance__growth")
def _(ws):
    """The data ends in 2021, hence a later window than the default one."""
    return explore.category_performance(ws.cleaned, late=(2019, 2021))["growth"]


@query("e07_geographic__tiers_from_city")
def _(ws):
    return explore.geographic(ws.cleaned.drop("customer_tier"))["tiers"]


@query("e21_run_all")
def _(ws):
    """Row counts of every panel from one run over all analyses, and the name of one that fails when it is computed."""
    counts = []
    broken = lambda df: explore.Panels({"never": df.select(F.raise_error(F.lit("on purpose")).alias("x"))})
    analyses = {**explore.ANALYSES, "broken": broken}
    _, failed = explore.run_all(ws.cleaned, analyses, sink=lambda analysis, panel, frame: counts.append((analysis, panel, frame.agg(rows()).first()[0])) if analysis != "broken" else frame.collect())
    if set(failed) != {"broken"}:
        raise RuntimeError(f"failed analyses: {failed}")
    return ws.spark.createDataFrame(counts, "analysis string, panel string, n bigint")
