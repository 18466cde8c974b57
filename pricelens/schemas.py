"""Declared schemas. Nothing in the library infers a schema from data."""

from pyspark.sql import types as T

# Landing table of listings (one row per scraped listing snapshot).
RAW_LISTING = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("sale_price", T.DoubleType(), True),
    T.StructField("on_sale", T.BooleanType(), True),
    T.StructField("source", T.StringType(), False),
    T.StructField("url", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("sku", T.StringType(), True),
    T.StructField("scraped_at", T.TimestampNTZType(), True),
    T.StructField("raw_payload", T.StringType(), True),
])

# Match verdicts stored per scored pair.
MATCHED_PRODUCT = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("ebay_listing_id", T.LongType(), True),
    T.StructField("bestbuy_listing_id", T.LongType(), True),
    T.StructField("canonical_name", T.StringType(), False),
    T.StructField("brand", T.StringType(), True),
    T.StructField("model_number", T.StringType(), True),
    T.StructField("confidence_score", T.DoubleType(), False),
    T.StructField("is_match", T.BooleanType(), False),
    T.StructField("matched_at", T.TimestampNTZType(), True),
])

# Clean hand-off contract (11 columns, this order).
CLEAN_LISTING = T.StructType([
    T.StructField("product_name", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("sale_price", T.DoubleType(), True),
    T.StructField("on_sale", T.BooleanType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("sku", T.StringType(), True),
    T.StructField("scraped_at", T.TimestampNTZType(), True),
    T.StructField("price_bucket", T.StringType(), True),
])

# Listing JSON file record (fixture / landing files). raw_payload is any JSON
# object, kept as text.
LISTING_JSON = T.StructType([
    T.StructField("product_name", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("sale_price", T.DoubleType(), True),
    T.StructField("on_sale", T.BooleanType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("sku", T.StringType(), True),
    T.StructField("scraped_at", T.StringType(), True),
    T.StructField("raw_payload", T.StringType(), True),
])

# Marketplace search item (only the fields that are read).
MARKETPLACE_ITEM = T.StructType([
    T.StructField("itemId", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("itemWebUrl", T.StringType(), True),
    T.StructField("price", T.StructType([
        T.StructField("value", T.StringType(), True),
        T.StructField("currency", T.StringType(), True),
    ]), True),
    T.StructField("marketingPrice", T.StructType([
        T.StructField("originalPrice", T.StructType([
            T.StructField("value", T.StringType(), True),
        ]), True),
    ]), True),
])

# Pair verdict JSON (strict JSON types; nothing is coerced).
VERDICT = T.StructType([
    T.StructField("is_match", T.BooleanType(), True),
    T.StructField("confidence", T.DoubleType(), True),
    T.StructField("canonical_name", T.StringType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("model_number", T.StringType(), True),
    T.StructField("reasoning", T.StringType(), True),
])
