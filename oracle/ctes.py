"""Shared relations: raw sales, cleaned sales and the star schema, as SQL text."""

from __future__ import annotations

from haatlake.functions import vocabulary as vocab
from haatlake.sources.sample_sales import (
    CATEGORY_SPELLINGS, CITIES, CITY_SPELLINGS, PAYMENT_SPELLINGS,
)


def text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def items(values: list[str]) -> str:
    return ", ".join(map(text, values))


def pick(values: list[str], index: str) -> str:
    return f"([{items(values)}])[({index}) + 1]"


def pairs(table: dict[str, str]) -> str:
    return ", ".join(f"({text(k)}, {text(v)})" for k, v in table.items())


def r(x: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str, digits: int = 2) -> str:
    return r(f"{ratio(a, b)} * 100", digits)


def title(x: str) -> str:
    parts = f"list_transform(regexp_extract_all({x}, '[a-z]+|[^a-z]+'), lambda t: upper(t[1]) || t[2:])"
    return f"array_to_string({parts}, '')"


def folded(c: str) -> str:
    t = f"lower(trim({c}))"
    return f"CASE WHEN {t} NOT IN ('', 'nan', 'none') THEN {t} END"


def canonical(c: str, cte: str, split: bool) -> str:
    """Scalar expression; the alias table is a CTE of (alias, name)."""
    key = folded(c)
    if split:
        key = folded(f"regexp_split_to_array({key}, '[/|]')[1]")
    return f"coalesce((SELECT a.name FROM {cte} a WHERE a.alias = {key}), {title(key)})"


_TYPES = " ".join(f"WHEN '{t}' THEN {pick(v, 'k % 7')}" for t, v in CATEGORY_SPELLINGS.items())
_FIRST = " ".join(f"WHEN '{t}' THEN {text(v[0])}" for t, v in CATEGORY_SPELLINGS.items())
_SPELL = pick(CITY_SPELLINGS, "c_nationkey")
_TIERS = vocab.city_tiers(vocab.TIER1_CITIES)

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: list[str], sql: str) -> None:
    CTES[name] = (needs, sql)


cte("city_alias(alias, name)", [], f"VALUES {pairs(vocab.CITY_ALIASES)}")
cte("category_alias(alias, name)", [], f"VALUES {pairs(vocab.CATEGORY_ALIASES)}")
cte("payment_alias(alias, name)", [], f"VALUES {pairs(vocab.PAYMENT_ALIASES)}")
cte("city_tier(city, tier)", [], f"VALUES {pairs(_TIERS)}")

cte("line", [], f"""
SELECT *, l_orderkey + 7 * l_linenumber + l_partkey AS k,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 20 YEAR AS DATE) AS od,
  CAST(l_extendedprice AS DECIMAL(14,2)) AS price,
  {pick(CITIES, 'c_nationkey')} AS city
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN part ON p_partkey = l_partkey""")

cte("copied", ["line"], """
SELECT *, CASE WHEN k % 71 <> 0 THEN
    CAST(k % 61 + CASE WHEN k % 17 = 0 THEN 0.5 ELSE 0.0 END AS DECIMAL(5,1)) END AS disc,
  unnest(generate_series(1, CASE WHEN k % 97 = 0 THEN 7 WHEN k % 53 = 0 THEN 3 ELSE 1 END)) AS copy
FROM line""")

_DISCOUNTED = "CAST(round(price * (100 - disc) * 0.01, 2) AS DOUBLE)"
cte("raw", ["copied"], f"""
SELECT
  CASE WHEN k % 877 <> 0 THEN concat('T', l_orderkey, '-', l_linenumber, '-', l_partkey, '-',
    l_suppkey, '-', strftime(l_shipdate, '%Y%m%d'), '-', copy) END AS transaction_id,
  CASE WHEN k % 101 = 0 THEN '32/13/2020' WHEN k % 11 IN (0, 1) THEN strftime(od, '%d/%m/%Y')
    WHEN k % 11 = 2 THEN strftime(od, '%d-%m-%y') ELSE strftime(od, '%Y-%m-%d') END AS order_date,
  CASE WHEN k % 499 <> 0 THEN concat('C', o_custkey) END AS customer_id,
  CASE WHEN k % 1009 <> 0 THEN concat('P', l_partkey) END AS product_id,
  p_name AS product_name,
  CASE WHEN k % 997 = 0 THEN NULL WHEN k % 199 = 0 THEN 'pet care' WHEN k % 991 = 0 THEN 'nan'
    ELSE CASE p_type {_TYPES} END END AS category,
  p_type AS subcategory, p_brand AS brand,
  CASE WHEN k % 103 = 0 THEN 'Price on Request' WHEN k % 107 = 0 THEN CAST(price * 100 AS VARCHAR)
    WHEN k % 109 = 0 THEN CAST(price * 0.01 AS VARCHAR) WHEN k % 113 = 0 THEN concat('Rs. ', price)
    WHEN k % 127 = 0 THEN '' WHEN k % 13 = 0 THEN '₹' || format('{{:,.2f}}', CAST(price AS DOUBLE))
    ELSE CAST(price AS VARCHAR) END AS original_price_inr,
  CAST(disc AS DOUBLE) AS discount_percent,
  {_DISCOUNTED} AS discounted_price_inr,
  CAST(l_quantity AS INTEGER) AS quantity,
  {_DISCOUNTED} * CAST(l_quantity AS INTEGER) AS subtotal_inr,
  CASE WHEN k % 12 <> 0 THEN CAST(40 + k % 60 AS DOUBLE) END AS delivery_charges,
  CAST(round(price * CAST(1 - l_discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS final_amount_inr,
  CASE WHEN k % 211 = 0 THEN 'o''neil-x' WHEN k % 223 = 0 THEN 'nan' WHEN k % 5 = 0 THEN city
    WHEN k % 5 = 1 THEN upper(city) WHEN k % 5 = 2 THEN concat(' ', lower(city), ' ')
    WHEN k % 5 = 3 THEN {_SPELL} ELSE concat(city, '/', {_SPELL}) END AS customer_city,
  concat('State ', c_nationkey % 12) AS customer_state,
  {pick(["Metro", "Tier 1", "Tier 2", "Rural"], "c_nationkey % 4")} AS customer_tier,
  {pick(["Budget", "Standard", "Premium"], "o_custkey % 3")} AS customer_spending_tier,
  CASE WHEN o_custkey % 8 <> 0 THEN CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '18-25'
    WHEN 'BUILDING' THEN '26-35' WHEN 'FURNITURE' THEN '36-45' WHEN 'HOUSEHOLD' THEN '46-55'
    ELSE '55+' END END AS customer_age_group,
  {pick(PAYMENT_SPELLINGS, "k % 19")} AS payment_method,
  CASE k % 23 WHEN 0 THEN 'Same Day' WHEN 1 THEN '1-2 days' WHEN 2 THEN '-3' WHEN 3 THEN '45'
    WHEN 4 THEN '' ELSE concat(k % 9, CASE WHEN k % 2 = 0 THEN ' days' ELSE '' END) END
    AS delivery_days,
  {pick(["Standard", "Express", "Same Day"], "k % 3")} AS delivery_type,
  CASE WHEN o_custkey % 29 = 0 THEN 'unknown'
    ELSE {pick(["Y", "N", "True", "no", "1.0", "0"], "o_custkey % 6")} END AS is_prime_member,
  CASE WHEN k % 307 = 0 THEN NULL WHEN month(od) IN (10, 11)
    THEN {pick(["True", "1", "yes"], "k % 3")} ELSE {pick(["False", "0", "N"], "k % 3")} END
    AS is_festival_sale,
  CASE WHEN month(od) NOT IN (10, 11) THEN NULL WHEN k % 31 = 0 THEN ''
    WHEN month(od) = 11 THEN 'Year End' WHEN year(od) % 2 = 0 THEN 'Diwali' ELSE 'Dussehra' END
    AS festival_name,
  CASE WHEN k % 10 < 3 THEN NULL WHEN k % 6 = 0 THEN '5.0' WHEN k % 6 = 1 THEN '4 stars'
    WHEN k % 6 = 2 THEN '3/5' WHEN k % 6 = 3 THEN '8/10' WHEN k % 6 = 4 THEN '7/8'
    WHEN k % 5 = 0 THEN '6' WHEN k % 5 = 1 THEN '3/0' WHEN k % 5 = 2 THEN '2.5/5.0'
    WHEN k % 5 = 3 THEN '0.5' ELSE '1.2.3/5' END AS customer_rating,
  CASE WHEN k % 59 = 0 THEN NULL WHEN k % 61 = 0 THEN '1' WHEN k % 67 = 0 THEN 'TRUE'
    WHEN l_returnflag = 'R' THEN 'Returned' WHEN l_returnflag = 'A' AND k % 2 = 0 THEN 'yes'
    ELSE 'Delivered' END AS return_status,
  CAST(month(od) AS INTEGER) AS order_month, CAST(year(od) AS INTEGER) AS order_year,
  CAST(quarter(od) AS INTEGER) AS order_quarter,
  p_size / CAST(10 AS DOUBLE) AS product_weight_kg,
  {pick(["yes", "No", "1", "FALSE"], "l_partkey % 4")} AS is_prime_eligible,
  CASE WHEN l_partkey % 37 <> 0 THEN 3 + (l_partkey % 21) / CAST(10 AS DOUBLE) END AS product_rating,
  CAST(year(od) AS VARCHAR) AS _source_year
FROM copied""")

cte("catalog", [], f"""
SELECT product_id, p_name AS product_name, CASE p_type {_FIRST} END AS category,
  p_type AS subcategory, p_brand AS brand, p_retailprice AS base_price_2015,
  p_size / CAST(10 AS DOUBLE) AS weight_kg, 3 + (p_partkey % 21) / CAST(10 AS DOUBLE) AS rating,
  'Yes' AS is_prime_eligible, CAST(2008 + p_partkey % 16 AS INTEGER) AS launch_year,
  concat('M', p_partkey % 50) AS model
FROM (SELECT *, unnest(CASE WHEN p_partkey = 0 THEN ['P0', 'PX'] WHEN p_partkey % 500 = 1
  THEN [concat('P', p_partkey), concat('P', p_partkey)] ELSE [concat('P', p_partkey)] END)
  AS product_id FROM part)""")

_DATE = """CASE
  WHEN regexp_full_match(trim(order_date), '\\d{4}-\\d{1,2}-\\d{1,2}')
    THEN CAST(try_strptime(trim(order_date), '%Y-%m-%d') AS DATE)
  WHEN regexp_full_match(trim(order_date), '\\d{1,2}/\\d{1,2}/\\d{4}')
    THEN CAST(try_strptime(trim(order_date), '%d/%m/%Y') AS DATE)
  WHEN regexp_full_match(trim(order_date), '\\d{1,2}-\\d{1,2}-\\d{2}')
    THEN CAST(try_strptime(trim(order_date), '%d-%m-%y') AS DATE) END"""
_PRICE = """CASE WHEN NOT regexp_matches(original_price_inr, '[A-Za-z]') THEN
  TRY_CAST(trim(regexp_replace(trim(original_price_inr), '[₹,]', '', 'g')) AS DOUBLE) END"""
_R = folded("customer_rating")
_NUM = f"TRY_CAST(regexp_extract({_R}, '^([\\d.]+)\\s*/\\s*([\\d.]+)$', 1) AS DOUBLE)"
_DEN = f"TRY_CAST(regexp_extract({_R}, '^([\\d.]+)\\s*/\\s*([\\d.]+)$', 2) AS DOUBLE)"
_RATING = f"""CASE WHEN regexp_matches({_R}, '^[\\d.]+\\s*/\\s*[\\d.]+$')
  THEN {r(f"CASE WHEN {_DEN} = 5 THEN {_NUM} WHEN {_DEN} = 10 THEN {_NUM} / 2 ELSE {_NUM} / nullif({_DEN}, 0) * 5 END")}
  ELSE TRY_CAST(regexp_extract({_R}, '^([\\d.]+)', 1) AS DOUBLE) END"""
_D = folded("delivery_days")
_DAYS = f"""CASE WHEN contains({_D}, 'same day') THEN 0.0
  WHEN regexp_matches({_D}, '^\\d+\\s*-\\s*\\d+')
    THEN (CAST(regexp_extract({_D}, '^(\\d+)', 1) AS DOUBLE)
      + CAST(regexp_extract({_D}, '^\\d+\\s*-\\s*(\\d+)', 1) AS DOUBLE)) / 2
  ELSE TRY_CAST(regexp_extract({_D}, '^-?\\d+(\\.\\d+)?') AS DOUBLE) END"""


def flag(c: str) -> str:
    t = f"lower(trim({c}))"
    return (f"CASE WHEN {t} IN ({items(vocab.TRUE_WORDS)}) THEN true "
            f"WHEN {t} IN ({items(vocab.FALSE_WORDS)}) THEN false END")


cte("rowclean MATERIALIZED", ["raw", "city_alias", "category_alias"], f"""
SELECT * REPLACE (
    strftime(order_date_dt, '%Y-%m-%d') AS order_date,
    CASE WHEN customer_rating BETWEEN 1 AND 5 THEN customer_rating END AS customer_rating,
    CASE WHEN delivery_days BETWEEN 0 AND 30 THEN delivery_days END AS delivery_days)
FROM (SELECT * REPLACE (
    {_PRICE} AS original_price_inr, {_RATING} AS customer_rating, {_DAYS} AS delivery_days,
    {canonical("customer_city", "city_alias", True)} AS customer_city,
    {canonical("category", "category_alias", False)} AS category,
    {flag("is_prime_member")} AS is_prime_member, {flag("is_prime_eligible")} AS is_prime_eligible,
    {flag("is_festival_sale")} AS is_festival_sale), {_DATE} AS order_date_dt
  FROM raw)""")

cte("deduped MATERIALIZED", ["rowclean"], """
SELECT * EXCLUDE (n, rn), n > 1 AS is_bulk_order, CASE WHEN n > 1 THEN n ELSE 1 END AS bulk_qty
FROM (SELECT *,
    count(customer_id) OVER (PARTITION BY customer_id, product_id, order_date, final_amount_inr) AS n,
    row_number() OVER (PARTITION BY customer_id, product_id, order_date, final_amount_inr
      ORDER BY order_date_dt NULLS LAST, transaction_id NULLS LAST) AS rn
  FROM rowclean)
WHERE n <= 5 OR rn = 1""")

cte("repaired", ["deduped"], """
SELECT d.* REPLACE (CASE WHEN original_price_inr > mid * 50 THEN original_price_inr / 100
      WHEN original_price_inr > 0 AND original_price_inr < mid / 50 THEN original_price_inr * 100
      ELSE original_price_inr END AS original_price_inr),
  coalesce(original_price_inr > mid * 50
    OR (original_price_inr > 0 AND original_price_inr < mid / 50), false) AS price_was_corrected
FROM deduped d LEFT JOIN (
    SELECT category AS g, quantile_cont(original_price_inr, 0.5) AS mid FROM deduped
    GROUP BY category HAVING count(original_price_inr) >= 10 AND mid > 0) m
  ON d.category IS NOT DISTINCT FROM m.g""")

cte("clean MATERIALIZED", ["repaired", "payment_alias", "catalog"], f"""
SELECT p.* REPLACE ({canonical("payment_method", "payment_alias", True)} AS payment_method),
  c.base_price_2015, c.weight_kg, c.rating, c.launch_year, c.model
FROM repaired p LEFT JOIN (SELECT DISTINCT product_id, base_price_2015, weight_kg, rating,
    launch_year, model FROM catalog) c ON c.product_id = p.product_id""")

cte("dim_time", ["clean"], """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day,
  dayname(d) AS day_of_week, isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min(order_date_dt), max(order_date_dt),
    INTERVAL 1 DAY)) AS DATE) AS d FROM clean)""")

cte("dim_products", ["clean"], """
SELECT product_id, product_name, category, subcategory, brand,
  CAST(base_price_2015 AS DECIMAL(12,2)) AS base_price_2015,
  CAST(weight_kg AS DECIMAL(8,3)) AS weight_kg,
  CAST(product_rating AS DECIMAL(3,2)) AS product_rating, is_prime_eligible, launch_year, model
FROM (SELECT *, row_number() OVER (PARTITION BY product_id
    ORDER BY order_date_dt DESC NULLS LAST, transaction_id DESC NULLS LAST) AS rn
  FROM clean WHERE product_id IS NOT NULL)
WHERE rn = 1""")


def _last(c: str) -> str:
    order = (f"coalesce(strftime(order_date_dt, '%Y%m%d'), '') || chr(1) || "
             f"coalesce(transaction_id, '') || chr(1) || {c}")
    return f"arg_max({c}, {order})"


cte("dim_customers", ["clean", "city_tier"], f"""
SELECT x.*, coalesce(t.tier, 'Tier 2/Rural') AS city_tier
FROM (SELECT customer_id, {_last("customer_city")} AS customer_city,
    {_last("customer_state")} AS customer_state, {_last("customer_age_group")} AS age_group,
    bool_or(is_prime_member) AS is_prime_member,
    {_last("customer_spending_tier")} AS customer_spending_tier,
    min(order_date_dt) AS first_purchase_date, max(order_date_dt) AS last_purchase_date
  FROM clean WHERE customer_id IS NOT NULL GROUP BY customer_id) x
LEFT JOIN city_tier t ON t.city = x.customer_city""")

cte("fact MATERIALIZED", ["clean"], """
SELECT transaction_id, customer_id, product_id,
  CAST(strftime(order_date_dt, '%Y%m%d') AS INTEGER) AS date_id, order_date_dt AS order_date,
  payment_method, TRY_CAST(original_price_inr AS DECIMAL(12,2)) AS original_price_inr,
  TRY_CAST(discount_percent AS DECIMAL(5,2)) AS discount_percent,
  TRY_CAST(final_amount_inr AS DECIMAL(12,2)) AS final_amount_inr,
  TRY_CAST(delivery_charges AS DECIMAL(8,2)) AS delivery_charges,
  TRY_CAST(delivery_days AS DECIMAL(4,1)) AS delivery_days, return_status,
  TRY_CAST(customer_rating AS DECIMAL(3,2)) AS customer_rating, is_prime_member,
  is_festival_sale, festival_name, is_bulk_order, CAST(bulk_qty AS INTEGER) AS bulk_qty
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY order_date_dt) AS rn
  FROM clean WHERE order_date_dt IS NOT NULL AND transaction_id IS NOT NULL
    AND customer_id IS NOT NULL AND product_id IS NOT NULL)
WHERE rn = 1""")

# Fact rows with their dates and dimension attributes, as the views see them.
cte("sold", ["fact", "dim_time", "dim_products", "dim_customers"], """
SELECT f.*, t.year, t.quarter, t.month, t.month_name, p.category, p.brand, p.product_rating,
  c.customer_city, c.customer_state, c.city_tier, c.age_group, c.first_purchase_date
FROM fact f JOIN dim_time t USING (date_id) JOIN dim_products p USING (product_id)
JOIN dim_customers c USING (customer_id)""")

# Cleaned rows with the date parts the exploratory analyses use.
cte("dated", ["clean"], """
SELECT *, CAST(year(order_date_dt) AS INTEGER) AS y, CAST(month(order_date_dt) AS INTEGER) AS m,
  final_amount_inr AS amt FROM clean""")


def _find(name: str) -> str:
    return next(k for k in CTES if k.replace("(", " ").split()[0] == name)


def query(needs: list[str], body: str) -> str:
    """WITH clause of the needed relations, in dependency order, then the body."""
    order: list[str] = []

    def visit(name: str) -> None:
        full = _find(name)
        for n in CTES[full][0]:
            visit(n)
        if full not in order:
            order.append(full)

    for n in needs:
        visit(n)
    heads = []
    for full in order:
        name, _, flag_ = full.partition(" MATERIALIZED")
        kind = "AS MATERIALIZED" if full.endswith("MATERIALIZED") else "AS"
        heads.append(f"{name} {kind} ({CTES[full][1]})")
    return ("WITH " + ",\n".join(heads) + "\n" if heads else "") + body
