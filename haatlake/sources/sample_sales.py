"""Sales-shaped input derived from the order tables (lineitem, orders, customer, part).

Every column is integer arithmetic on the row's keys, so that the same rows can
be stated in plain SQL. Different primes per column keep the defects from
coinciding. The lists are fixed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import spread

CITIES = [
    "Mumbai", "Delhi", "Bengaluru", "Chennai", "Kolkata", "Hyderabad", "Pune", "Ahmedabad",
    "Jaipur", "Surat", "Lucknow", "Kanpur", "Nagpur", "Indore", "Bhopal", "Gurugram", "Noida",
    "Visakhapatnam", "Coimbatore", "Kochi", "Vadodara", "Prayagraj", "Thiruvananthapuram",
    "Patna", "Agra",
]
CITY_SPELLINGS = [
    "bombay", "new delhi", "bangalore", "madras", "calcutta", "hydrabad", "PUNE", "ahemdabad",
    "jaipur", "SURAT", "lucknow", "KANPUR", "nagpur", "INDORE", "bhopal", "gurgaon", "NOIDA",
    "vizag", "coimbatore", "cochin", "baroda", "allahabad", "trivandrum", "PATNA", "agra",
]
CATEGORY_SPELLINGS = {
    "ECONOMY": ["Electronics", "ELECTRONICS", "electronicss", " Electronics & Accessories ",
                "electronnics", "Electronic", "electronics"],
    "LARGE": ["Fashion", "FASHION", "clothing", " apparel ", "Apparels", "Clothes", "fashions"],
    "MEDIUM": ["Home & Kitchen", "home and kitchen", "HOME", " kitchen ", "HomeKitchen",
               "Home & kitchen", "home"],
    "PROMO": ["Books", "BOOKS", "book", " bookss ", "Book", "books", "BOOKSS"],
    "SMALL": ["Grocery", "GROCERY", "groceries", " food ", "Food & Beverages", "grocery", "FOOD"],
    "STANDARD": ["Automotive", "AUTO", "automobile", " auto ", "Automobile", "automotive",
                 "AUTOMOTIVE"],
}
PAYMENT_SPELLINGS = [
    "UPI", "PhonePe", "GooglePay", "PhonePe/GooglePay", "paytm", "Credit Card", "credit_card",
    "CC", "CreditCard", "Debit Card", "DC", "cash on delivery", "COD", "c.o.d.", "Net Banking",
    "netbanking", "EMI", "wallet", "bnpl",
]


def _pick(values: list[str], index: str) -> str:
    quoted = ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)
    return f"element_at(array({quoted}), cast({index} as int) + 1)"


def _by_type() -> str:
    whens = " ".join(f"WHEN '{t}' THEN {_pick(v, 'k % 7')}" for t, v in CATEGORY_SPELLINGS.items())
    return f"CASE p_type {whens} END"


RAW_COLUMNS = {
    "transaction_id": """CASE WHEN k % 877 <> 0 THEN concat('T', l_orderkey, '-', l_linenumber, '-',
        l_partkey, '-', l_suppkey, '-', date_format(l_shipdate, 'yyyyMMdd'), '-', copy) END""",
    "order_date": """CASE WHEN k % 101 = 0 THEN '32/13/2020'
        WHEN k % 11 IN (0, 1) THEN date_format(od, 'dd/MM/yyyy')
        WHEN k % 11 = 2 THEN date_format(od, 'dd-MM-yy')
        ELSE date_format(od, 'yyyy-MM-dd') END""",
    "customer_id": "CASE WHEN k % 499 <> 0 THEN concat('C', o_custkey) END",
    "product_id": "CASE WHEN k % 1009 <> 0 THEN concat('P', l_partkey) END",
    "product_name": "p_name",
    "category": f"""CASE WHEN k % 997 = 0 THEN NULL WHEN k % 199 = 0 THEN 'pet care'
        WHEN k % 991 = 0 THEN 'nan' ELSE {_by_type()} END""",
    "subcategory": "p_type",
    "brand": "p_brand",
    "original_price_inr": """CASE WHEN k % 103 = 0 THEN 'Price on Request'
        WHEN k % 107 = 0 THEN cast(price * 100 AS string)
        WHEN k % 109 = 0 THEN cast(price * 0.01 AS string)
        WHEN k % 113 = 0 THEN concat('Rs. ', price)
        WHEN k % 127 = 0 THEN ''
        WHEN k % 13 = 0 THEN concat('₹', format_number(price, 2))
        ELSE cast(price AS string) END""",
    "discount_percent": "cast(disc AS double)",
    "discounted_price_inr": "cast(round(price * (100 - disc) * 0.01, 2) AS double)",
    "quantity": "cast(l_quantity AS int)",
    "subtotal_inr": """cast(round(price * (100 - disc) * 0.01, 2) AS double)
        * cast(l_quantity AS int)""",
    "delivery_charges": "CASE WHEN k % 12 <> 0 THEN cast(40 + k % 60 AS double) END",
    "final_amount_inr": "cast(round(price * cast(1 - l_discount AS decimal(4,2)), 2) AS double)",
    "customer_city": f"""CASE WHEN k % 211 = 0 THEN "o'neil-x" WHEN k % 223 = 0 THEN 'nan'
        WHEN k % 5 = 0 THEN city WHEN k % 5 = 1 THEN upper(city)
        WHEN k % 5 = 2 THEN concat(' ', lower(city), ' ')
        WHEN k % 5 = 3 THEN {_pick(CITY_SPELLINGS, 'c_nationkey')}
        ELSE concat(city, '/', {_pick(CITY_SPELLINGS, 'c_nationkey')}) END""",
    "customer_state": "concat('State ', c_nationkey % 12)",
    "customer_tier": _pick(["Metro", "Tier 1", "Tier 2", "Rural"], "c_nationkey % 4"),
    "customer_spending_tier": _pick(["Budget", "Standard", "Premium"], "o_custkey % 3"),
    "customer_age_group": """CASE WHEN o_custkey % 8 <> 0 THEN
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '18-25' WHEN 'BUILDING' THEN '26-35'
        WHEN 'FURNITURE' THEN '36-45' WHEN 'HOUSEHOLD' THEN '46-55' ELSE '55+' END END""",
    "payment_method": _pick(PAYMENT_SPELLINGS, "k % 19"),
    "delivery_days": """CASE k % 23 WHEN 0 THEN 'Same Day' WHEN 1 THEN '1-2 days' WHEN 2 THEN '-3'
        WHEN 3 THEN '45' WHEN 4 THEN ''
        ELSE concat(k % 9, CASE WHEN k % 2 = 0 THEN ' days' ELSE '' END) END""",
    "delivery_type": _pick(["Standard", "Express", "Same Day"], "k % 3"),
    "is_prime_member": f"""CASE WHEN o_custkey % 29 = 0 THEN 'unknown'
        ELSE {_pick(["Y", "N", "True", "no", "1.0", "0"], "o_custkey % 6")} END""",
    "is_festival_sale": f"""CASE WHEN k % 307 = 0 THEN NULL
        WHEN month(od) IN (10, 11) THEN {_pick(["True", "1", "yes"], "k % 3")}
        ELSE {_pick(["False", "0", "N"], "k % 3")} END""",
    "festival_name": """CASE WHEN month(od) NOT IN (10, 11) THEN NULL WHEN k % 31 = 0 THEN ''
        WHEN month(od) = 11 THEN 'Year End' WHEN year(od) % 2 = 0 THEN 'Diwali'
        ELSE 'Dussehra' END""",
    "customer_rating": """CASE WHEN k % 10 < 3 THEN NULL WHEN k % 6 = 0 THEN '5.0'
        WHEN k % 6 = 1 THEN '4 stars' WHEN k % 6 = 2 THEN '3/5' WHEN k % 6 = 3 THEN '8/10'
        WHEN k % 6 = 4 THEN '7/8' WHEN k % 5 = 0 THEN '6' WHEN k % 5 = 1 THEN '3/0'
        WHEN k % 5 = 2 THEN '2.5/5.0' WHEN k % 5 = 3 THEN '0.5' ELSE '1.2.3/5' END""",
    "return_status": """CASE WHEN k % 59 = 0 THEN NULL WHEN k % 61 = 0 THEN '1'
        WHEN k % 67 = 0 THEN 'TRUE' WHEN l_returnflag = 'R' THEN 'Returned'
        WHEN l_returnflag = 'A' AND k % 2 = 0 THEN 'yes' ELSE 'Delivered' END""",
    "order_month": "month(od)",
    "order_year": "year(od)",
    "order_quarter": "quarter(od)",
    "product_weight_kg": "p_size / 10.0D",
    "is_prime_eligible": _pick(["yes", "No", "1", "FALSE"], "l_partkey % 4"),
    "product_rating": "CASE WHEN l_partkey % 37 <> 0 THEN 3 + (l_partkey % 21) / 10.0D END",
    "_source_year": "cast(year(od) AS string)",
}


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty transaction lines, 35 columns; about 3 % of lines occur as 3 or 7 copies."""
    table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    # Orders meet their customers first, so that the many lines move for an order and a part only.
    buyers = table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "c_nationkey", "c_mktsegment")
    lines = (
        spread(table("lineitem")).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    based = lines.selectExpr(
        "*",
        "l_orderkey + 7 * l_linenumber + l_partkey AS k",
        "add_months(o_orderdate, 240) AS od",
        "cast(l_extendedprice AS decimal(14,2)) AS price",
        f"{_pick(CITIES, 'c_nationkey')} AS city",
    ).selectExpr(
        "*",
        "CASE WHEN k % 71 <> 0 THEN cast(k % 61 + CASE WHEN k % 17 = 0 THEN 0.5 ELSE 0.0 END "
        "AS decimal(5,1)) END AS disc",
        "explode(sequence(1, CASE WHEN k % 97 = 0 THEN 7 WHEN k % 53 = 0 THEN 3 ELSE 1 END)) AS copy",
    )
    return based.selectExpr(*[f"{e} AS {c}" for c, e in RAW_COLUMNS.items()])


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalog, with some repeated rows and one product nobody buys."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.selectExpr(
        "*", "explode(CASE WHEN p_partkey = 0 THEN array('P0', 'PX') WHEN p_partkey % 500 = 1 "
        "THEN array(concat('P', p_partkey), concat('P', p_partkey)) "
        "ELSE array(concat('P', p_partkey)) END) AS product_id",
    ).selectExpr(
        "product_id",
        "p_name AS product_name",
        f"CASE p_type {' '.join(f'''WHEN '{t}' THEN '{v[0]}' ''' for t, v in CATEGORY_SPELLINGS.items())} END AS category",
        "p_type AS subcategory",
        "p_brand AS brand",
        "p_retailprice AS base_price_2015",
        "p_size / 10.0D AS weight_kg",
        "3 + (p_partkey % 21) / 10.0D AS rating",
        "'Yes' AS is_prime_eligible",
        "cast(2008 + p_partkey % 16 AS int) AS launch_year",
        "concat('M', p_partkey % 50) AS model",
    )
