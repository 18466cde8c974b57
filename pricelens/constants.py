"""Fixed values that must stay equal to the behaviour being reproduced.

Everything in the block below is a fixed value (lookup table, list, pattern,
threshold or text format). They are kept together, in their natural order,
so that a change to any of them is a visible, deliberate change.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES
# ---------------------------------------------------------------------------

# Category synonyms -> unified category. Exact, case-sensitive keys; a
# category that is not a key is kept as it is.
CATEGORY_MAP = {
    "TVs": "TVs",
    "Laptops": "Laptops",
    "Headphones": "Headphones",
    "Smartwatches": "Smartwatches",
    "Tablets": "Tablets",
    "Televisions": "TVs",
    "TV": "TVs",
    "Laptop": "Laptops",
    "Laptops & Netbooks": "Laptops",
    "Notebook": "Laptops",
    "Headphone": "Headphones",
    "Earbuds": "Headphones",
    "Smartwatch": "Smartwatches",
    "Smart Watches": "Smartwatches",
    "Tablet": "Tablets",
    "Tablets & eBook Readers": "Tablets",
    "iPad": "Tablets",
}

# Price buckets on the effective price: < BUDGET_MAX budget, <= MID_MAX mid.
BUDGET_MAX = 100.0
MID_MAX = 500.0

# Brand clean-up: NULL brand becomes this value; one trailing corporate
# suffix is removed with this pattern (note: \s*, so word tails are eaten).
UNKNOWN_BRAND = "unknown"
BRAND_SUFFIX_PATTERN = r"\s*(inc\.?|corp\.?|ltd\.?|co\.?|electronics|corporation)\s*$"

# Brands recognised in marketplace titles, in priority order (first hit wins,
# case-insensitive substring test).
KNOWN_BRANDS = [
    "Samsung", "LG", "Sony", "Apple", "Dell", "HP", "Lenovo", "ASUS",
    "Acer", "Microsoft", "Bose", "JBL", "Beats", "Sennheiser",
    "TCL", "Hisense", "Vizio", "Google", "Garmin", "Fitbit",
    "Amazon", "Panasonic", "Toshiba", "Philips",
]
UNKNOWN_TITLE_BRAND = "Unknown"

# Marketplace source names.
SOURCE_MARKETPLACE = "ebay"
SOURCE_RETAILER = "bestbuy"

# Matching: candidates kept per retailer listing, minimum name similarity,
# acceptance threshold on a verdict, pairs scored per run.
MAX_CANDIDATES = 5
MIN_SIMILARITY = 0.25
CONFIDENCE_THRESHOLD = 0.6
MAX_PAIRS_PER_RUN = 50

# Verdict defaults for a missing or empty name / brand.
UNKNOWN_VERDICT_TEXT = "Unknown"

# Surrogate-key NULL marker and field separator (dbt_utils convention).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"

# Pair prompt text. {price_line} is "  Price: $<2 decimals>\n" or empty when
# the price is missing or zero.
PROMPT_TEMPLATE = (
    "Compare these two product listings and determine if they are the same product:\n\n"
    "**eBay Listing:**\n"
    "  Title: {ebay_title}\n"
    "{ebay_price_line}"
    "  Category: {category}\n\n"
    "**Best Buy Listing:**\n"
    "  Title: {bestbuy_title}\n"
    "{bestbuy_price_line}"
    "  Category: {category}\n\n"
    "Determine if these are the same physical product. "
    "Respond with JSON only."
)

# ---------------------------------------------------------------------------
# Our own defaults (not fixed by the reproduced behaviour)
# ---------------------------------------------------------------------------

# Salt buckets used to spread one hot join key over many tasks.
DEFAULT_SALT_BUCKETS = 16
# Name-pair band join: a category's block is split into g x g cells with
# g = ceil(sqrt(retailer names * marketplace names / PAIRS_PER_CELL));
# each side is replicated g times.
PAIRS_PER_CELL = 500_000
# Similarity scoring: name pairs per scoring task (CPU-bound Python; the
# partition count is set from the pair estimate, not from bytes).
PAIRS_PER_SCORE_TASK = 20_000
# More tasks than this in one stage are a load for the driver; beyond it, tasks get more pairs.
MAX_SCORE_TASKS = 1_000
# Plain pairs scored in the time that the letters and the close names of one name take.
PLAIN_PAIRS_PER_NAME = 200
# Anomaly detection: look-back days, minimum observations, |z| threshold.
ANOMALY_LOOKBACK_DAYS = 28
ANOMALY_MIN_OBS = 8
ANOMALY_Z = 3.0
