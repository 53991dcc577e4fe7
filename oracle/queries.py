"""One SQL statement per registered query, stated independently of the Spark plans."""

from __future__ import annotations

from haatlake.functions import vocabulary as vocab
from haatlake.operators.quality import FLAGS
from haatlake.operators.star import FACT_COLUMNS
from haatlake.sources.sample_sales import RAW_COLUMNS

from .ctes import items, pct, query, r, ratio

ORACLE: dict[str, str] = {}
RAW = list(RAW_COLUMNS)
CLEAN = [*RAW, "order_date_dt", "is_bulk_order", "bulk_qty", "price_was_corrected",
         "base_price_2015", "weight_kg", "rating", "launch_year", "model"]
CATALOG_ONLY = CLEAN[-5:]
RETURNED = f"lower(return_status) IN ({items(vocab.RETURNED_WORDS)})"


def add(name: str, needs: list[str], body: str) -> None:
    ORACLE[name] = query(needs, body)


def day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d') AS {c}"


# --- sources and sinks -------------------------------------------------------

add("s01_year_files", ["raw"], f"""
SELECT _source_year, count(*) AS n, count(transaction_id) AS with_id,
  count(CASE WHEN _source_year >= '2018' THEN delivery_type END) AS with_delivery_type,
  count(DISTINCT customer_id) AS customers, CAST(sum(quantity) AS BIGINT) AS quantity,
  {r('sum(final_amount_inr)')} AS revenue
FROM raw GROUP BY _source_year""")
add("s04_encoding_fallback", ["raw"], """
SELECT CASE WHEN _source_year <= '2018' THEN 'old' ELSE 'new' END AS _source_year,
  count(*) AS n, count(product_name) AS accented FROM raw GROUP BY 1""")
add("s06_observed_counts", ["raw", "catalog"], """
SELECT 'transactions' AS source, count(*) AS row_count FROM raw
UNION ALL SELECT 'catalog', count(*) FROM catalog""")
add("s05_catalog_file", ["catalog"], "SELECT * FROM catalog")
_SUMMARY = f"""count(*) AS n, count(original_price_inr) AS priced,
  count(*) FILTER (is_bulk_order) AS bulk, {r('sum(final_amount_inr)')} AS revenue"""
add("s07_clean_dataset", ["dated"], f"SELECT y AS order_year_dt, {_SUMMARY} FROM dated GROUP BY y")
add("s08_clean_csv_fallback", ["dated"], f"SELECT y, {_SUMMARY} FROM dated GROUP BY y")
_TABLES = {"dim_time": "dim_time", "dim_products": "dim_products",
           "dim_customers": "dim_customers", "fact": "fact_transactions"}
_COUNTS = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {c}" for c, n in _TABLES.items())
add("s09_warehouse_load", ["fact"], f"""
SELECT CAST(year(order_date) AS INTEGER) AS order_year, count(*) AS n,
  count(DISTINCT date_id) AS days, {r('sum(final_amount_inr)')} AS revenue
FROM fact GROUP BY 1""")
add("s12_row_counts", list(_TABLES), _COUNTS)
_CONTENT = {
    "dim_time": ("dim_time", "date_id", ["full_date", "month_name"]),
    "dim_products": ("dim_products", "product_id", ["product_name", "category", "brand", "launch_year", "model"]),
    "dim_customers": ("dim_customers", "customer_id", ["customer_city", "city_tier", "age_group", "is_prime_member",
                      "customer_spending_tier", "first_purchase_date", "last_purchase_date"]),
    "fact": ("fact_transactions", "transaction_id", ["customer_id", "product_id", "date_id", "payment_method"]),
}
add("s10_warehouse_append", list(_TABLES), " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS key,
      concat_ws('|', {', '.join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)}) AS content FROM {rel}"""
    for rel, (name, key, columns) in _CONTENT.items()))
add("s13_bound_sql", ["fact"], """
SELECT payment_method, count(*) AS orders, CAST(sum(final_amount_inr) AS DOUBLE) AS revenue
FROM fact WHERE year(order_date) BETWEEN 2016 AND 2018 GROUP BY payment_method""")
_MONEY = f"{r('sum(final_amount_inr)')} AS revenue_inr"
_AOV = f"{r(ratio('sum(final_amount_inr)', 'count(final_amount_inr)'))} AS avg_order_value"
_YEARLY = f"""SELECT year, {_MONEY}, count(*) AS orders,
  count(DISTINCT customer_id) AS active_customers, {_AOV} FROM sold {{where}} GROUP BY year"""
add("s14_view_scan", ["sold"], _YEARLY.format(where=""))
add("s15_years", ["dim_time"], "SELECT DISTINCT year FROM dim_time")
add("s15_year_bounds", ["dim_time"],
    "SELECT min(year) AS min_year, max(year) AS max_year FROM dim_time")
add("s15_year_filtered_view", ["sold"], _YEARLY.format(where="WHERE year BETWEEN 2017 AND 2019"))

# --- cleaning ----------------------------------------------------------------

for _q, _cols in {
    "c01_dates": f"order_date, {day('order_date_dt')}", "c02_prices": "original_price_inr",
    "c03_ratings": "customer_rating", "c04_cities": "customer_city",
    "c05_booleans": "is_prime_member, is_prime_eligible, is_festival_sale",
    "c06_categories": "category", "c07_delivery_days": "delivery_days",
}.items():
    add(_q, ["rowclean"], f"SELECT transaction_id, {_cols} FROM rowclean")
add("c10_payment_methods", ["raw", "payment_alias"], """
SELECT transaction_id, CASE lower(payment_method) WHEN 'bnpl' THEN 'Bnpl' ELSE name END
  AS payment_method
FROM raw LEFT JOIN payment_alias ON alias = split_part(lower(payment_method), '/', 1)""")
add("c08_duplicates", ["deduped"], """
SELECT transaction_id, customer_id, product_id, order_date, final_amount_inr, is_bulk_order,
  bulk_qty FROM deduped""")
add("c09_price_repair", ["repaired"], f"""
SELECT transaction_id, category, {r('original_price_inr', 4)} AS original_price_inr,
  price_was_corrected FROM repaired""")
add("c11_clean_all", ["clean"], f"""
SELECT * EXCLUDE ({', '.join(CATALOG_ONLY)}) REPLACE (
  {r('original_price_inr', 4)} AS original_price_inr, {r('subtotal_inr', 4)} AS subtotal_inr,
  {day('order_date_dt')}) FROM clean""")
add("c12_catalog_enrich", ["clean"],
    f"SELECT transaction_id, product_id, {', '.join(CATALOG_ONLY)} FROM clean")

# --- quality -----------------------------------------------------------------


def _nulls(rel: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
        {pct(f'count(*) - count({c})', 'count(*)')} AS missing_pct FROM {rel}""" for c in columns)


_SHAPE = f"""SELECT 'before' AS stage, count(*) AS row_count,
  CAST({len(RAW)} AS BIGINT) AS column_count FROM raw
UNION ALL SELECT 'after', count(*), CAST({len(CLEAN)} AS BIGINT) FROM clean"""
_TEXT = {c: f"CAST({c} AS VARCHAR)" for c in vocab.PROFILED_COLUMNS}
_SAMPLES = "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {t} AS value, count(*) AS n,
    CAST(row_number() OVER (ORDER BY count(*) DESC, {t} ASC NULLS FIRST) AS INTEGER) AS position
    FROM clean GROUP BY {t}""" for c, t in _TEXT.items()) + ") WHERE position <= 15"
_TALLIES = " UNION ALL ".join(
    f"SELECT '{c}' AS flag, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM clean GROUP BY {c}"
    for c in FLAGS)
add("i01_null_profile_before", ["raw"], _nulls("raw", RAW))
add("i01_null_profile_after", ["clean"], _nulls("clean", CLEAN))
add("i02_shape", ["raw", "clean"], _SHAPE)
add("i03_value_samples", ["clean"], _SAMPLES)
add("i04_flag_tallies", ["clean"], _TALLIES)
_KEYS = {"dim_products": "product_id", "dim_customers": "customer_id", "dim_time": "date_id",
         "fact": "transaction_id"}
add("i05_key_violations", list(_KEYS), " UNION ALL ".join(
    [f"""SELECT 'primary_key' AS constraint_type, '{_TABLES[t]}' AS table_name,
    '{k}' AS key_name, count(*) AS violations
    FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)""" for t, k in _KEYS.items()]
    + [f"""SELECT 'foreign_key', '{t}', '{k}', count(DISTINCT {k}) FROM fact f
    WHERE NOT EXISTS (SELECT 1 FROM {t} d WHERE d.{k} = f.{k})"""
       for t, k in _KEYS.items() if t != "fact"]))

# Types as Spark names them: every raw column is text except these.
_RAW_TYPES = {c: "double" for c in (
    "discount_percent", "discounted_price_inr", "subtotal_inr", "delivery_charges",
    "final_amount_inr", "product_weight_kg", "product_rating")} | {
    c: "int" for c in ("quantity", "order_month", "order_year", "order_quarter")}
_CLEAN_TYPES = _RAW_TYPES | {
    c: "double" for c in ("original_price_inr", "customer_rating", "delivery_days")} | {
    c: "boolean" for c in ("is_prime_member", "is_prime_eligible", "is_festival_sale")}
_TYPE_ROWS = ", ".join(
    f"('types', '{c}', 'before', '{_RAW_TYPES.get(c, 'string')}'), "
    f"('types', '{c}', 'after', '{_CLEAN_TYPES.get(c, 'string')}')" for c in RAW)


def _long(section: str, rel: str, column: str, metrics: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{section}' AS section, "{column}" AS "column", '{m}' AS metric,
        CAST({m} AS VARCHAR) AS value FROM ({rel})""" for m in metrics)


add("i06_quality_report", ["raw", "clean"], " UNION ALL ".join([
    _long("shape", _SHAPE, "stage", ["row_count", "column_count"]),
    _long("missing_before", _nulls("raw", RAW), "column", ["missing", "missing_pct"]),
    _long("missing_after", _nulls("clean", CLEAN), "column", ["missing", "missing_pct"]),
    f"SELECT * FROM (VALUES {_TYPE_ROWS})",
    f"""SELECT 'values', "column", coalesce(value, '(null)'), CAST(n AS VARCHAR) FROM ({_SAMPLES})""",
    f"SELECT 'flags', flag, coalesce(value, '(null)'), CAST(n AS VARCHAR) FROM ({_TALLIES})",
]))

# --- star schema -------------------------------------------------------------

add("w01_dim_time", ["dim_time"], f"SELECT * REPLACE ({day('full_date')}) FROM dim_time")
add("w02_dim_products", ["dim_products"], """
SELECT * REPLACE (CAST(base_price_2015 AS DOUBLE) AS base_price_2015,
  CAST(weight_kg AS DOUBLE) AS weight_kg, CAST(product_rating AS DOUBLE) AS product_rating)
FROM dim_products""")
add("w03_dim_customers", ["dim_customers"], f"""
SELECT * REPLACE ({day('first_purchase_date')}, {day('last_purchase_date')}) FROM dim_customers""")
_DECIMALS = [c for c, t in FACT_COLUMNS.items() if t.startswith("decimal")]
add("w04_fact_transactions", ["fact"], f"""
SELECT * REPLACE ({day('order_date')}, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _DECIMALS)})
FROM fact""")


def _tier(tier1: list[str]) -> str:
    return (f"CASE WHEN customer_city IN ({items(vocab.METRO_CITIES)}) THEN 'Metro' "
            f"WHEN customer_city IN ({items(tier1)}) THEN 'Tier 1' ELSE 'Tier 2/Rural' END")


add("w05_city_tiers", ["clean"], f"""
SELECT customer_city, count(*) AS n, {_tier(vocab.TIER1_CITIES)} AS warehouse_tier,
  {_tier(vocab.TIER1_CITIES_EXPLORE)} AS explore_tier FROM clean GROUP BY customer_city""")
add("w06_stored_flags", ["raw"], """
SELECT is_prime_member, count(*) AS n, CASE WHEN lower(is_prime_member) IN ('true', 'yes', '1')
  THEN true WHEN lower(is_prime_member) IN ('false', 'no', '0') THEN false END AS stored
FROM raw GROUP BY is_prime_member""")

# --- shared primitives -------------------------------------------------------


def _hist(rel: str, v: str, bins: int) -> str:
    return f"""
, v AS MATERIALIZED (SELECT CAST({v} AS DOUBLE) AS v FROM {rel} WHERE {v} IS NOT NULL),
b AS (SELECT min(v) AS lo, max(v) - min(v) AS width FROM v),
h AS (SELECT CAST(least(floor((v - lo) / width * {bins}), {bins - 1}) AS INTEGER) AS bin,
  count(*) AS n FROM v, b GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, {r(f'lo + width * i / {bins}', 6)} AS lower,
  {r(f'lo + width * (i + 1) / {bins}', 6)} AS upper, coalesce(n, 0) AS n
FROM range({bins}) t(i) CROSS JOIN b LEFT JOIN h ON h.bin = i"""


def _box(rel: str, g: str, v: str) -> str:
    return f"""
, s AS (SELECT {g}, count({v}) AS n, quantile_cont({v}, 0.25) AS q1,
  quantile_cont({v}, 0.5) AS median, quantile_cont({v}, 0.75) AS q3 FROM {rel}
  WHERE {v} IS NOT NULL GROUP BY {g})
SELECT s.{g}, n, {r('q1', 4)} AS q1, {r('median', 4)} AS median, {r('q3', 4)} AS q3,
  {r(f'min({v})', 4)} AS whisker_low, {r(f'max({v})', 4)} AS whisker_high
FROM s JOIN {rel} d ON d.{g} IS NOT DISTINCT FROM s.{g}
WHERE {v} BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5
GROUP BY ALL"""


add("x01_share_of", ["raw"], f"""
SELECT brand, subcategory, count(*) AS n,
  {pct('count(*)', 'sum(count(*)) OVER (PARTITION BY brand)')} AS share_pct
FROM raw GROUP BY brand, subcategory""")
add("x02_top_k", ["raw"], f"""
SELECT product_id, {r('sum(final_amount_inr)')} AS revenue FROM raw GROUP BY product_id
ORDER BY revenue DESC, product_id LIMIT 25""")
add("x06_pct_change", ["raw"], f"""
SELECT month_no, revenue, {pct('revenue - lag(revenue) OVER (ORDER BY month_no)',
                               'lag(revenue) OVER (ORDER BY month_no)')} AS change_pct
FROM (SELECT order_year * 12 + order_month AS month_no, {r('sum(final_amount_inr)')} AS revenue
  FROM raw GROUP BY 1)""")
add("x07_alias_lookup", ["raw", "payment_alias"], """
SELECT payment_method, count(*) AS n, any_value(name) AS method FROM raw
LEFT JOIN payment_alias ON alias = lower(split_part(payment_method, '/', 1)) GROUP BY 1""")
add("x03_histogram", ["raw"], _hist("raw", "final_amount_inr", 10))
add("x04_box_stats", ["raw"], _box("raw", "brand", "final_amount_inr"))
add("x05_qcut", ["raw"], f"""
, s AS (SELECT customer_id, {r('sum(final_amount_inr)')} AS revenue FROM raw
  WHERE customer_id IS NOT NULL GROUP BY customer_id),
c AS (SELECT quantile_cont(revenue, [0.2, 0.4, 0.6, 0.8]) AS q FROM s)
SELECT customer_id, revenue, CASE WHEN revenue <= q[1] THEN 1 WHEN revenue <= q[2] THEN 2
  WHEN revenue <= q[3] THEN 3 WHEN revenue <= q[4] THEN 4 ELSE 5 END AS bucket FROM s, c""")
add("x08_global_rank", ["raw"], """
SELECT *, row_number() OVER (ORDER BY orders, customer_id) AS position
FROM (SELECT customer_id, count(transaction_id) AS orders FROM raw
  WHERE customer_id IS NOT NULL GROUP BY customer_id)""")

# --- views -------------------------------------------------------------------

_N = "count(*) AS orders"
_UNIQUE = "count(DISTINCT customer_id)"
_FEST = """CASE WHEN is_festival_sale THEN
  CASE WHEN festival_name IS NULL OR festival_name = '' THEN 'Festival' ELSE festival_name END
  ELSE 'Normal' END"""
_DISC = r(ratio("sum(discount_percent)", "count(discount_percent)")) + " AS avg_discount_pct"
_V_CATEGORY = f"""SELECT category, {_N}, {_MONEY}, {_AOV},
  {pct('sum(final_amount_inr)', '(SELECT sum(final_amount_inr) FROM fact)')} AS market_share_pct
FROM sold GROUP BY category"""
_V_CUSTOMERS = f"""SELECT customer_id, customer_city, age_group, {_N},
  {r('sum(final_amount_inr)')} AS lifetime_value_inr, {_AOV},
  strftime(max(order_date), '%Y-%m-%d') AS last_order_date
FROM sold GROUP BY ALL ORDER BY lifetime_value_inr DESC, customer_id LIMIT """
_V_GEO = f"""SELECT customer_state, customer_city, city_tier, {_N}, {_UNIQUE} AS unique_customers,
  {_MONEY}, {_AOV} FROM sold GROUP BY ALL"""
_V_FESTIVAL = f"""SELECT year, {_FEST} AS period_type, {_N}, {_MONEY}, {_AOV}, {_DISC}
FROM sold GROUP BY ALL"""
_V_BRAND = f"""SELECT brand, category, {_N}, {_MONEY},
  {r(ratio('sum(CAST(product_rating AS DOUBLE))', 'count(product_rating)'))} AS avg_product_rating
FROM sold GROUP BY ALL ORDER BY revenue_inr DESC, brand, category LIMIT """
_V_DELIVERY = f"""SELECT customer_city, city_tier, {_N},
  {r(ratio('sum(delivery_days)', 'count(*)'))} AS avg_delivery_days,
  {pct('count(*) FILTER (delivery_days <= 4)', 'count(*)')} AS on_time_pct
FROM sold WHERE delivery_days IS NOT NULL GROUP BY ALL"""
_V_MONTHLY = f"SELECT year, month, month_name, {_MONEY}, {_N} FROM sold GROUP BY ALL"
_V_MIX = f"SELECT year, payment_method, {_N}, {_MONEY} FROM sold GROUP BY ALL"
_V_KPI = f"""SELECT count(*) AS total_orders, {_UNIQUE} AS active_customers,
  count(DISTINCT product_id) AS active_products,
  {r('sum(final_amount_inr)')} AS total_revenue_inr,
  {r(ratio('sum(final_amount_inr)', 'count(final_amount_inr)'))} AS avg_order_value_inr,
  {r(ratio('sum(customer_rating)', 'count(customer_rating)'))} AS avg_customer_rating,
  {pct('count(*) FILTER (is_festival_sale)', 'count(*)')} AS festival_share_pct,
  {pct('count(*) FILTER (is_prime_member)', 'count(*)')} AS prime_share_pct FROM fact"""

add("v01_kpi_summary", ["fact"], _V_KPI)
add("v02_yearly_revenue", ["sold"], _YEARLY.format(where=""))
add("v03_monthly_revenue", ["sold"], _V_MONTHLY)
add("v04_category_performance", ["sold"], _V_CATEGORY)
add("v05_top_customers", ["sold"], _V_CUSTOMERS + "1000")
add("v06_payment_mix", ["sold"], _V_MIX)
add("v07_geographic_revenue", ["sold"], _V_GEO)
add("v08_festival_impact", ["sold"], _V_FESTIVAL)
add("v09_brand_performance", ["sold"], _V_BRAND + "25")
add("v10_prime_vs_nonprime", ["sold"], f"""
SELECT CASE WHEN is_prime_member THEN 'Prime' ELSE 'Non-Prime' END AS member_type, {_N},
  {_UNIQUE} AS active_customers, {_MONEY}, {_AOV} FROM sold GROUP BY 1""")
add("v11_returns_by_category", ["sold"], f"""
SELECT category, count(*) AS total_orders, count(*) FILTER ({RETURNED}) AS returned_orders,
  {pct(f'count(*) FILTER ({RETURNED})', 'count(*)')} AS return_rate_pct
FROM sold GROUP BY category""")
add("v12_delivery_performance", ["sold"], _V_DELIVERY)
add("v13_discount_effectiveness", ["fact"], f"""
SELECT CASE WHEN discount_percent = 0 THEN '0%' WHEN discount_percent >= 1 AND
    discount_percent <= 10 THEN '1-10%' WHEN discount_percent >= 11 AND discount_percent <= 20
    THEN '11-20%' WHEN discount_percent >= 21 AND discount_percent <= 30 THEN '21-30%'
    WHEN discount_percent >= 31 AND discount_percent <= 50 THEN '31-50%' ELSE '50%+' END
  AS discount_bucket, {_N}, {_MONEY}, {_AOV}, {_DISC} FROM fact GROUP BY 1""")
add("v14_age_group_behavior", ["sold"], f"""
SELECT age_group, {_N}, {_UNIQUE} AS unique_customers, {_AOV}, {_MONEY}
FROM sold GROUP BY age_group""")
add("v15_customer_cohorts", ["sold"], f"""
SELECT strftime(first_purchase_date, '%Y-%m') AS cohort_month, {_UNIQUE} AS customers, {_N},
  {_MONEY}, {r(ratio('sum(final_amount_inr)', _UNIQUE))} AS arpu FROM sold
WHERE first_purchase_date IS NOT NULL GROUP BY 1""")

# --- tiles -------------------------------------------------------------------


def cr(x: str, digits: int = 6) -> str:
    return r(f"{x} / 1e7", digits)


_YOY = f"""SELECT year, revenue_inr, {cr('revenue_inr')} AS revenue_cr,
  {pct('revenue_inr - lag(revenue_inr) OVER (ORDER BY year)', 'lag(revenue_inr) OVER (ORDER BY year)')}
  AS yoy_pct FROM ({_YEARLY.format(where='')})"""
_SEASON = "CASE period_type WHEN 'Normal' THEN 'Normal' ELSE 'Festival' END"
_QUARTERS = f"""SELECT year, quarter, {r('sum(final_amount_inr)')} AS revenue, {_N},
  {_UNIQUE} AS customers,
  {r(ratio('sum(final_amount_inr)', 'count(final_amount_inr)'))} AS aov
FROM sold GROUP BY year, quarter"""
add("p01_yearly_growth", ["sold"], _YOY)
add("p02_latest_year", ["sold"], f"""
SELECT max(year) AS latest_year, arg_max(revenue_inr, year) AS latest_revenue_inr,
  arg_max(yoy_pct, year) AS latest_yoy_pct,
  CASE WHEN count(*) > 1 AND arg_min(revenue_inr, year) > 0 THEN
    {r('(pow(arg_max(revenue_inr, year) / arg_min(revenue_inr, year), 1.0 / nullif(count(*) - 1, 0)) - 1) * 100', 4)}
  END AS cagr_pct FROM ({_YOY})""")
add("p03_top_categories", ["sold"], f"""
SELECT category, revenue_inr, {cr('revenue_inr')} AS revenue_cr FROM ({_V_CATEGORY})
ORDER BY revenue_inr DESC, category LIMIT 5""")
add("p04_festival_split", ["sold"], f"""
SELECT {_SEASON} AS type, {r('sum(revenue_inr)')} AS revenue FROM ({_V_FESTIVAL}) GROUP BY 1""")
add("p04_festival_by_year", ["sold"], f"""
SELECT year, {_SEASON} AS is_festival, {cr('sum(revenue_inr)')} AS revenue_cr
FROM ({_V_FESTIVAL}) GROUP BY 1, 2""")
add("p05_quarterly_revenue", ["sold"], f"""
SELECT year, 'Q' || quarter AS quarter_label, revenue, {cr('revenue')} AS revenue_cr
FROM ({_QUARTERS})""")
add("p06_top_cities", ["sold"], f"""
SELECT customer_city, {r('sum(revenue_inr)')} AS revenue_inr, {cr(r('sum(revenue_inr)'))} AS revenue_cr
FROM ({_V_GEO}) WHERE customer_city IS NOT NULL GROUP BY 1
ORDER BY revenue_inr DESC, customer_city LIMIT 15""")
add("p06_tier_revenue", ["sold"], f"""
SELECT city_tier, {r('sum(revenue_inr)')} AS revenue_inr FROM ({_V_GEO}) GROUP BY 1""")
add("p07_best_customers", ["sold"], _V_CUSTOMERS + "20")
add("p08_best_brands", ["sold"], f"""
SELECT *, {cr('revenue_inr')} AS revenue_cr FROM ({_V_BRAND}10)""")
add("p09_launches", ["dim_products"], """
SELECT launch_year, count(*) AS new_products FROM dim_products WHERE launch_year IS NOT NULL
GROUP BY launch_year""")
add("p10_delivery_kpis", ["sold"], f"""
, d AS ({_V_DELIVERY})
SELECT {r('avg(avg_delivery_days)', 4)} AS avg_delivery_days,
  (SELECT customer_city FROM d ORDER BY on_time_pct DESC, orders DESC LIMIT 1) AS best_city,
  max(on_time_pct) AS best_on_time_pct, count(*) AS cities_tracked FROM d""")
add("p11_busiest_cities", ["sold"], f"""
SELECT customer_city, city_tier, orders, on_time_pct FROM ({_V_DELIVERY})
ORDER BY orders DESC, customer_city, city_tier LIMIT 15""")


def _grid(counts: str) -> str:
    """The cells of a matrix that occur."""
    return f"""
, f AS ({counts})"""


def _shares(counts: str, row: str, col: str, value: str = "orders") -> str:
    return _grid(counts) + f"""
SELECT *, {pct(value, f'sum({value}) OVER (PARTITION BY {row})')} AS share_pct FROM f"""


def _mix(rel: str, row: str, col: str) -> str:
    return _shares(f"""SELECT {row}, {col}, count(*) AS orders FROM {rel}
      WHERE {row} IS NOT NULL AND {col} IS NOT NULL GROUP BY ALL""", row, col)


add("p12_payment_share", ["sold"], _mix("sold", "year", "payment_method"))
_MONTHS = ", ".join(
    f"coalesce(max(CASE WHEN month = {m} THEN {cr('revenue_inr')} END), 0) AS m{m:02d}"
    for m in range(1, 13))
add("p13_seasonality", ["sold"], f"SELECT year, {_MONTHS} FROM ({_V_MONTHLY}) GROUP BY year")
add("p14_quarterly_scorecard", ["sold"], f"""
SELECT year || ' Q' || quarter AS period, {cr('revenue')} AS revenue_cr, orders, customers, aov
FROM ({_QUARTERS})""")
add("p15_forecast", ["sold"], f"""
, yr AS (SELECT CAST(year AS INTEGER) AS year, revenue_inr / 1e7 AS cr
  FROM ({_YEARLY.format(where='')})),
fit AS (SELECT regr_slope(cr, year) AS slope, avg(year) AS mx, avg(cr) AS my,
  max(year) AS last FROM yr HAVING count(*) >= 3),
pts AS (SELECT year, cr FROM yr UNION ALL SELECT last + i, NULL FROM fit, range(1, 4) t(i))
SELECT CAST(year AS INTEGER) AS year, {r('cr', 4)} AS actual_cr,
  {r('my + slope * (year - mx)', 4)} AS fitted_cr,
  CASE WHEN cr IS NULL THEN 'forecast' ELSE 'actual' END AS kind FROM pts, fit""")


def _money_text(x: str) -> str:
    return f"""CASE WHEN coalesce({x}, 0) = 0 THEN '₹0'
      WHEN abs({x}) >= 1e7 THEN '₹' || format('{{:,.2f}}', {x} / 1e7) || ' Cr'
      WHEN abs({x}) >= 1e5 THEN '₹' || format('{{:,.2f}}', {x} / 1e5) || ' L'
      WHEN abs({x}) >= 1e3 THEN '₹' || format('{{:,.1f}}', {x} / 1e3) || 'K'
      ELSE '₹' || format('{{:,.0f}}', CAST({x} AS DOUBLE)) END"""


def _short_text(x: str) -> str:
    return f"""CASE WHEN coalesce({x}, 0) = 0 THEN '0'
      WHEN abs({x}) >= 1e6 THEN format('{{:.1f}}', {x} / 1e6) || 'M'
      WHEN abs({x}) >= 1e3 THEN format('{{:.1f}}', {x} / 1e3) || 'K'
      ELSE format('{{:,.0f}}', CAST({x} AS DOUBLE)) END"""


add("p16_kpi_cards", ["fact"], f"""
SELECT {_money_text('total_revenue_inr')} AS total_revenue,
  {_short_text('active_customers')} AS active_customers,
  {_short_text('total_orders')} AS total_orders,
  {_money_text('avg_order_value_inr')} AS avg_order_value,
  {_short_text('active_products')} AS active_products,
  coalesce(format('{{:.2f}} ⭐', avg_customer_rating), 'N/A') AS avg_customer_rating,
  coalesce(format('{{:.1f}}%', festival_share_pct), 'N/A') AS festival_share,
  coalesce(format('{{:.1f}}%', prime_share_pct), 'N/A') AS prime_share FROM ({_V_KPI})""")

# --- exploratory analyses ----------------------------------------------------

_REV = f"{r('coalesce(sum(amt), 0)')} AS revenue"
_MEAN = f"{r(ratio('sum(amt)', 'count(amt)'))} AS aov"
add("e01_revenue_trend__yearly", ["dated"], f"""
SELECT year, revenue, {pct('revenue - lag(revenue) OVER (ORDER BY year)', 'lag(revenue) OVER (ORDER BY year)')}
  AS growth_pct
FROM (SELECT y AS year, {_REV} FROM dated WHERE y IS NOT NULL GROUP BY y)""")
_CELLS = ", ".join(
    f"coalesce({r(f'sum(amt) FILTER (m = {m}) / 1e7', 6)}, 0) AS m{m:02d}" for m in range(1, 13))
add("e02_seasonal_heatmap__matrix", ["dated"],
    f"SELECT y AS year, {_CELLS} FROM dated WHERE y IS NOT NULL GROUP BY y")
_RFM = f"""
, c AS (SELECT customer_id, max(order_date_dt) AS last, count(transaction_id) AS frequency,
    {r('coalesce(sum(amt), 0)')} AS monetary FROM dated WHERE customer_id IS NOT NULL
  GROUP BY customer_id HAVING max(order_date_dt) IS NOT NULL),
t AS (SELECT customer_id, CAST(date_diff('day', last, (SELECT max(order_date_dt) FROM dated))
    AS INTEGER) AS recency, frequency, monetary,
    row_number() OVER (ORDER BY frequency, customer_id) AS fr FROM c),
q AS (SELECT quantile_cont(CAST(recency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS qr,
    quantile_cont(CAST(fr AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS qf,
    quantile_cont(monetary, [0.2, 0.4, 0.6, 0.8]) AS qm FROM t),
s AS (SELECT t.*,
    5 - len(list_filter(qr, lambda e: e < recency)) AS r_score,
    1 + len(list_filter(qf, lambda e: e < fr)) AS f_score,
    1 + len(list_filter(qm, lambda e: e < monetary)) AS m_score FROM t, q),
scored AS (SELECT customer_id, recency, frequency, monetary,
    CAST(r_score AS INTEGER) AS r_score, CAST(f_score AS INTEGER) AS f_score,
    CAST(m_score AS INTEGER) AS m_score, CAST(r_score + f_score + m_score AS INTEGER) AS score,
    CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champions'
      WHEN r_score + f_score + m_score >= 10 THEN 'Loyal'
      WHEN r_score + f_score + m_score >= 7 THEN 'Potential'
      WHEN r_score + f_score + m_score >= 5 THEN 'At Risk' ELSE 'Lost' END AS segment FROM s)
"""
add("e03_rfm_segmentation__scores", ["dated"], _RFM + "SELECT * FROM scored")
add("e03_rfm_segmentation__segments", ["dated"],
    _RFM + "SELECT segment, count(*) AS customers FROM scored GROUP BY segment")
add("e04_payment_evolution__share", ["dated"],
    _mix("(SELECT y AS year, payment_method FROM dated)", "year", "payment_method"))
add("e05_category_performance__revenue", ["dated"], f"""
SELECT category, {_REV}, {pct('sum(amt)', '(SELECT sum(amt) FROM dated WHERE category IS NOT NULL)')}
  AS share_pct FROM dated WHERE category IS NOT NULL GROUP BY category""")
add("e05_category_performance__growth", ["dated"], f"""
SELECT a.category, {pct('late - early', 'early')} AS growth_pct
FROM (SELECT category, coalesce(sum(amt), 0) AS early FROM dated WHERE y BETWEEN 2015 AND 2017
  AND category IS NOT NULL GROUP BY category) a
JOIN (SELECT category, coalesce(sum(amt), 0) AS late FROM dated WHERE y BETWEEN 2019 AND 2021
  AND category IS NOT NULL GROUP BY category) b ON a.category = b.category WHERE early <> 0""")
_LABELLED = """(SELECT *, CASE is_prime_member WHEN true THEN 'Prime' WHEN false THEN 'Non-Prime'
  ELSE 'Unknown' END AS prime_label FROM dated)"""
add("e06_prime_impact__orders", ["dated"],
    f"SELECT prime_label, {_MEAN}, count(*) AS orders FROM {_LABELLED} GROUP BY prime_label")
add("e06_prime_impact__mix", ["dated"], _mix(_LABELLED, "prime_label", "category"))
add("e07_geographic__cities", ["dated"], f"""
SELECT customer_city, {_REV} FROM dated WHERE customer_city IS NOT NULL GROUP BY customer_city
ORDER BY revenue DESC, customer_city LIMIT 15""")
add("e07_geographic__tiers", ["dated"], f"""
SELECT customer_tier AS tier, {_REV} FROM dated WHERE customer_tier IS NOT NULL GROUP BY 1""")
add("e07_geographic__tiers_from_city", ["dated"], f"""
SELECT {_tier(vocab.TIER1_CITIES_EXPLORE)} AS tier, {_REV} FROM dated GROUP BY 1""")
add("e08_festival_impact__daily", ["dated"], f"""
SELECT strftime(order_date_dt, '%Y-%m-%d') AS order_day,
  CASE WHEN is_festival_sale THEN 'Festival' ELSE 'Normal' END AS period, {_REV}
FROM dated WHERE order_date_dt IS NOT NULL AND is_festival_sale IS NOT NULL GROUP BY 1, 2""")
add("e08_festival_impact__festivals", ["dated"], f"""
SELECT festival_name, {_REV} FROM dated WHERE is_festival_sale AND festival_name IS NOT NULL
GROUP BY 1 ORDER BY revenue DESC, festival_name LIMIT 5""")
_AGED = "(SELECT *, customer_age_group AS age_group FROM dated)"
add("e09_age_groups__spend", ["dated"], f"""
SELECT age_group, {_REV}, {_MEAN}, count(amt) AS orders FROM {_AGED}
WHERE age_group IS NOT NULL GROUP BY age_group""")
add("e09_age_groups__mix", ["dated"], _mix(_AGED, "age_group", "category"))
add("e10_price_vs_demand__sample", ["dated"], """
SELECT original_price_inr, final_amount_inr, category FROM (
  SELECT *, md5(concat_ws('|', transaction_id, customer_id, product_id,
    CAST(CAST(original_price_inr AS DECIMAL(28,6)) AS VARCHAR),
    CAST(CAST(final_amount_inr AS DECIMAL(28,6)) AS VARCHAR), category, '42')) AS h FROM dated
  WHERE original_price_inr IS NOT NULL AND final_amount_inr IS NOT NULL AND category IS NOT NULL)
ORDER BY h, transaction_id NULLS FIRST, customer_id NULLS FIRST, product_id NULLS FIRST,
  original_price_inr, final_amount_inr, category LIMIT 20000""")
add("e10_price_vs_demand__correlation", ["dated"], " UNION ALL ".join(
    f"SELECT '{a}' AS var_x, '{b}' AS var_y, {r(f'corr({a}, {b})', 4)} AS r FROM dated"
    for a in vocab.CORRELATED_COLUMNS for b in vocab.CORRELATED_COLUMNS))
add("e11_delivery_performance__histogram", ["dated"], _hist("dated", "delivery_days", 20))
add("e11_delivery_performance__median", ["dated"],
    f"SELECT {r('quantile_cont(delivery_days, 0.5)', 4)} AS median FROM dated")
add("e11_delivery_performance__cities", ["dated"], f"""
SELECT customer_city, count(*) AS orders,
  {pct('count(*) FILTER (delivery_days <= 4)', 'count(*)')} AS on_time_pct
FROM dated WHERE customer_city IS NOT NULL GROUP BY 1
ORDER BY orders DESC, customer_city LIMIT 12""")
_FLAGGED = f"(SELECT *, coalesce({RETURNED}, false) AS returned FROM dated)"
add("e12_returns_satisfaction__by_category", ["dated"], f"""
SELECT category, {pct('count(*) FILTER (returned)', 'count(*)')} AS return_pct
FROM {_FLAGGED} WHERE category IS NOT NULL GROUP BY category""")
add("e12_returns_satisfaction__ratings", ["dated"], _box(_FLAGGED, "returned", "customer_rating"))
_TOP_BRANDS = f"""SELECT brand, {_REV} FROM dated WHERE brand IS NOT NULL GROUP BY brand
ORDER BY revenue DESC, brand LIMIT 10"""
add("e13_brand_performance__top", ["dated"], _TOP_BRANDS)
add("e13_brand_performance__share", ["dated"], _grid(f"""
  SELECT y AS year, brand, coalesce(sum(amt), 0) AS revenue FROM dated
  WHERE y IS NOT NULL AND brand IN (SELECT brand FROM ({_TOP_BRANDS})) GROUP BY ALL""") + f"""
SELECT year, brand, {r('revenue')} AS revenue,
  {pct('revenue', 'sum(revenue) OVER (PARTITION BY year)')} AS share_pct FROM f""")
_RETENTION = ", ".join(
    f"{pct(f'count(DISTINCT customer_id) FILTER (age = {i})', 'count(DISTINCT customer_id) FILTER (age = 0)')} AS m{i:02d}"
    for i in range(13))
add("e14_clv_cohort__retention", ["dated"], f"""
SELECT strftime(start, '%Y-%m') AS cohort_month, {_RETENTION}
FROM (SELECT customer_id, date_trunc('month', start) AS start,
    date_diff('month', start, order_date_dt) AS age
  FROM (SELECT *, min(order_date_dt) OVER (PARTITION BY customer_id) AS start FROM dated
    WHERE order_date_dt IS NOT NULL AND customer_id IS NOT NULL))
GROUP BY 1 ORDER BY 1 LIMIT 24""")
_CLV = f"""(SELECT customer_id, {r('coalesce(sum(amt), 0)')} AS clv FROM dated
  WHERE order_date_dt IS NOT NULL AND customer_id IS NOT NULL GROUP BY customer_id)"""
add("e14_clv_cohort__clv_median", ["dated"],
    f"SELECT {r('quantile_cont(clv, 0.5)', 4)} AS median FROM {_CLV}")
add("e14_clv_cohort__clv_histogram", ["dated"],
    _hist(f"(SELECT log10(clv) AS x FROM {_CLV} WHERE clv > 0)", "x", 50))
_BANDS = [(-0.1, 0), (0, 10), (10, 20), (20, 30), (30, 50), (50, 100)]
add("e15_discount_effectiveness__buckets", ["dated"], " UNION ALL ".join(
    f"""SELECT {i} AS position, '{label}' AS discount_bucket, count(*) AS orders, {_REV}, {_MEAN}
    FROM dated WHERE discount_percent > {lo} AND discount_percent <= {hi}"""
    for i, (label, (lo, hi)) in enumerate(zip(vocab.DISCOUNT_LABELS, _BANDS), 1)))
add("e16_rating_patterns__histogram", ["dated"], _hist("dated", "customer_rating", 20))
add("e16_rating_patterns__categories", ["dated"], f"""
SELECT category, {r(ratio('sum(customer_rating)', 'count(customer_rating)'))} AS avg_rating, {_REV}
FROM dated WHERE category IS NOT NULL GROUP BY category HAVING count(customer_rating) > 0""")
add("e17_customer_journey__transitions", ["dated"], _shares("""
  SELECT category, next_category, count(*) AS moves FROM (
    SELECT category, lead(category) OVER (PARTITION BY customer_id
      ORDER BY order_date_dt, transaction_id NULLS FIRST, category) AS next_category
    FROM dated WHERE order_date_dt IS NOT NULL AND category IS NOT NULL
      AND customer_id IS NOT NULL)
  WHERE next_category IS NOT NULL GROUP BY ALL""", "category", "next_category", "moves"))
add("e18_product_lifecycle__launches", ["dated"], """
SELECT launch_year, count(*) AS products FROM (
  SELECT DISTINCT product_id, launch_year FROM dated WHERE launch_year IS NOT NULL)
GROUP BY launch_year""")
add("e18_product_lifecycle__trend", ["dated"], _grid("""
  SELECT y AS year, category, coalesce(sum(amt), 0) AS revenue FROM dated
  WHERE y IS NOT NULL AND category IS NOT NULL GROUP BY ALL""")
    + f"SELECT year, category, {cr('revenue')} AS revenue_cr FROM f")
add("e19_competitive_pricing__categories", ["dated"],
    _box("(SELECT * FROM dated WHERE category IS NOT NULL)", "category", "original_price_inr"))
add("e19_competitive_pricing__brands", ["dated"], _box("""(SELECT * FROM dated WHERE brand IN (
    SELECT brand FROM dated WHERE brand IS NOT NULL GROUP BY brand
    ORDER BY count(*) DESC, brand LIMIT 10))""", "brand", "original_price_inr"))
add("e20_business_health__yearly", ["dated"], f"""
SELECT y AS year, {_REV}, {_MEAN}, count(DISTINCT customer_id) AS active_customers
FROM dated WHERE y IS NOT NULL GROUP BY y""")
add("e20_business_health__categories", ["dated"], f"""
SELECT category, {_REV} FROM dated WHERE category IS NOT NULL GROUP BY category
ORDER BY revenue DESC, category LIMIT 5""")


def _label_share(c: str) -> str:
    return f"""SELECT {c}, count(*) AS orders, {pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct
FROM dated WHERE {c} IS NOT NULL GROUP BY {c}"""


add("e20_business_health__prime", ["dated"], _label_share("is_prime_member"))
add("e20_business_health__payments", ["dated"],
    _label_share("payment_method") + " ORDER BY orders DESC, payment_method LIMIT 6")
_HEALTH = f"lower(return_status) IN ({items(vocab.RETURNED_WORDS_HEALTH)})"
_RATE = pct(f"count(*) FILTER ({_HEALTH})", "count(*)")
add("e20_business_health__returns", ["dated"],
    f"SELECT {_RATE} AS returned_pct, 100 - {_RATE} AS kept_pct FROM dated")


def _run_all() -> str:
    """Row counts of the panels; the growth panel has the default windows here."""
    skip = ("tiers_from_city", "growth")
    bodies = {n: s for n, s in ORACLE.items() if n[0] == "e" and not n.endswith(skip)}
    counts = " UNION ALL ".join(
        f"SELECT '{n.split('__')[0]}' AS analysis, '{n.split('__')[1]}' AS panel, "
        f"count(*) AS n FROM ({s})" for n, s in bodies.items())
    growth = ("SELECT 'e05_category_performance' AS analysis, 'growth' AS panel, count(*) AS n FROM (SELECT category FROM "
              "dated WHERE category IS NOT NULL GROUP BY category HAVING count(*) FILTER "
              "(y BETWEEN 2015 AND 2017) > 0 AND count(*) FILTER (y BETWEEN 2023 AND 2025) > 0)")
    return query(["dated"], f"{growth} UNION ALL {counts}")


ORACLE["e21_run_all"] = _run_all()
