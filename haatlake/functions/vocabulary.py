"""Fixed values.

The tables in this module are data, not logic: spellings found in raw sales
files and the canonical value each one stands for, plus the label sets the
reports use. Results depend on them being exactly these values.
"""

# Raw city spelling (lower case) -> canonical city name.
CITY_ALIASES = {
    "bangalore": "Bengaluru",
    "bengaluru": "Bengaluru",
    "bombay": "Mumbai",
    "mumbai": "Mumbai",
    "new delhi": "Delhi",
    "delhi": "Delhi",
    "calcutta": "Kolkata",
    "kolkata": "Kolkata",
    "madras": "Chennai",
    "chennai": "Chennai",
    "gurgaon": "Gurugram",
    "gurugram": "Gurugram",
    "hyderabad": "Hyderabad",
    "hydrabad": "Hyderabad",
    "pune": "Pune",
    "ahmedabad": "Ahmedabad",
    "ahemdabad": "Ahmedabad",
    "noida": "Noida",
    "jaipur": "Jaipur",
    "lucknow": "Lucknow",
    "kanpur": "Kanpur",
    "nagpur": "Nagpur",
    "indore": "Indore",
    "bhopal": "Bhopal",
    "patna": "Patna",
    "vadodara": "Vadodara",
    "baroda": "Vadodara",
    "ludhiana": "Ludhiana",
    "agra": "Agra",
    "nashik": "Nashik",
    "faridabad": "Faridabad",
    "meerut": "Meerut",
    "rajkot": "Rajkot",
    "varanasi": "Varanasi",
    "amritsar": "Amritsar",
    "allahabad": "Prayagraj",
    "prayagraj": "Prayagraj",
    "kochi": "Kochi",
    "cochin": "Kochi",
    "trivandrum": "Thiruvananthapuram",
    "thiruvananthapuram": "Thiruvananthapuram",
    "visakhapatnam": "Visakhapatnam",
    "vizag": "Visakhapatnam",
    "coimbatore": "Coimbatore",
    "thane": "Thane",
    "surat": "Surat",
    "guwahati": "Guwahati",
    "chandigarh": "Chandigarh",
}

# Raw category spelling (lower case) -> canonical category.
CATEGORY_ALIASES = {
    "electronics": "Electronics",
    "electronic": "Electronics",
    "electronicss": "Electronics",
    "electronnics": "Electronics",
    "electronicz": "Electronics",
    "electronics & accessories": "Electronics",
    "electronics and accessories": "Electronics",
    "fashion": "Fashion",
    "fashions": "Fashion",
    "clothing": "Fashion",
    "clothes": "Fashion",
    "apparel": "Fashion",
    "apparels": "Fashion",
    "home & kitchen": "Home & Kitchen",
    "home and kitchen": "Home & Kitchen",
    "home": "Home & Kitchen",
    "kitchen": "Home & Kitchen",
    "homekitchen": "Home & Kitchen",
    "books": "Books",
    "book": "Books",
    "bookss": "Books",
    "beauty": "Beauty & Personal Care",
    "beauty & personal care": "Beauty & Personal Care",
    "beauty and personal care": "Beauty & Personal Care",
    "personal care": "Beauty & Personal Care",
    "sports": "Sports & Fitness",
    "sports & fitness": "Sports & Fitness",
    "sports and fitness": "Sports & Fitness",
    "fitness": "Sports & Fitness",
    "sport": "Sports & Fitness",
    "toys": "Toys & Games",
    "toys & games": "Toys & Games",
    "toys and games": "Toys & Games",
    "games": "Toys & Games",
    "toy": "Toys & Games",
    "grocery": "Grocery",
    "groceries": "Grocery",
    "food": "Grocery",
    "food & beverages": "Grocery",
    "automotive": "Automotive",
    "auto": "Automotive",
    "automobile": "Automotive",
}

# Raw payment method spelling (lower case) -> canonical method.
PAYMENT_ALIASES = {
    "upi": "UPI",
    "phonepe": "UPI",
    "googlepay": "UPI",
    "google pay": "UPI",
    "gpay": "UPI",
    "paytm": "UPI",
    "bhim": "UPI",
    "credit card": "Credit Card",
    "credit_card": "Credit Card",
    "cc": "Credit Card",
    "creditcard": "Credit Card",
    "debit card": "Debit Card",
    "debit_card": "Debit Card",
    "dc": "Debit Card",
    "debitcard": "Debit Card",
    "cash on delivery": "Cash on Delivery",
    "cod": "Cash on Delivery",
    "c.o.d": "Cash on Delivery",
    "c.o.d.": "Cash on Delivery",
    "net banking": "Net Banking",
    "netbanking": "Net Banking",
    "internet banking": "Net Banking",
    "nb": "Net Banking",
    "emi": "EMI",
    "wallet": "Wallet",
    "amazon pay": "Wallet",
    "amazonpay": "Wallet",
}

# City tiers. Any city outside both lists is DEFAULT_TIER.
METRO_CITIES = ["Mumbai", "Delhi", "Bengaluru", "Chennai", "Kolkata", "Hyderabad"]
# Tier 1 as the warehouse customer dimension defines it.
TIER1_CITIES = [
    "Pune", "Ahmedabad", "Jaipur", "Surat", "Lucknow", "Kanpur", "Nagpur", "Indore",
    "Bhopal", "Gurugram", "Noida", "Faridabad", "Visakhapatnam", "Coimbatore", "Kochi",
    "Thane", "Vadodara", "Ludhiana", "Chandigarh",
]
# Tier 1 as the exploratory geography analysis defines it (shorter on purpose).
TIER1_CITIES_EXPLORE = [
    "Pune", "Ahmedabad", "Jaipur", "Surat", "Lucknow", "Kanpur", "Nagpur", "Indore",
    "Bhopal", "Gurugram", "Noida", "Faridabad", "Visakhapatnam",
]
DEFAULT_TIER = "Tier 2/Rural"

# Spellings of flags.
TRUE_WORDS = ["true", "t", "yes", "y", "1", "1.0"]
FALSE_WORDS = ["false", "f", "no", "n", "0", "0.0"]
# Spellings of a returned order: most reports, and the health panel (no '1').
RETURNED_WORDS = ["yes", "true", "returned", "1"]
RETURNED_WORDS_HEALTH = ["yes", "true", "returned"]
# Tokens that stand for "no value" in text columns.
NULL_WORDS = ["", "nan", "none"]

# Tokens of a raw file that are read as missing in every column.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

DISCOUNT_LABELS = ["0%", "1-10%", "11-20%", "21-30%", "31-50%", "50%+"]

# Columns whose null/value profile the quality report samples.
PROFILED_COLUMNS = [
    "order_date", "original_price_inr", "customer_rating", "customer_city",
    "is_prime_member", "is_festival_sale", "category", "delivery_days", "payment_method",
]

# Numeric columns of the correlation matrix.
CORRELATED_COLUMNS = [
    "original_price_inr", "discount_percent", "final_amount_inr", "delivery_charges",
    "delivery_days", "customer_rating", "product_rating",
]


def city_tiers(tier1: list[str]) -> dict[str, str]:
    return {c: "Metro" for c in METRO_CITIES} | {c: "Tier 1" for c in tier1}

# Dates outside are typing errors: the days that 64-bit nanoseconds hold. A calendar thus has at most 213,503 days.
FIRST_DATE, LAST_DATE = "1677-09-22", "2262-04-10"

# The text forms that are accepted, as regular expressions.
DAY_FIRST_SLASH, DAY_FIRST_DASH, ISO_DATE = r"^(\d{1,2})/(\d{1,2})/(\d{4})$", r"^(\d{1,2})-(\d{1,2})-(\d{2})$", r"^\d{4}-\d{1,2}-\d{1,2}$"
PRICE_MARKS, LETTERS = "[₹,]", "[A-Za-z]"
FRACTION, LEADING_NUMBER = r"^([\d.]+)\s*/\s*([\d.]+)$", r"^([\d.]+)"
DAY_SPAN, SIGNED_NUMBER = r"^(\d+)\s*-\s*(\d+)", r"^(-?\d+(?:\.\d+)?)"

# Least score of each customer segment, best first, and the segment below them all.
SEGMENTS, LOWEST_SEGMENT = [(13, "Champions"), (10, "Loyal"), (7, "Potential"), (5, "At Risk")], "Lost"
# Ends of the discount bands, of the warehouse view (both included) and of the analysis (the upper one included).
DISCOUNT_BANDS = [(0, 0), (1, 10), (11, 20), (21, 30), (31, 50)]
DISCOUNT_EDGES = [-0.1, 0, 10, 20, 30, 50, 100]
