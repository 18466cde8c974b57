"""Listing clean-up: dedup, prices, categories, brands, buckets, contract.

Each step is a DataFrame -> DataFrame function; `clean_listings` chains them.
Only `dedup_listings` shuffles (once, on its three keys); every other step is
a projection or filter fused into the same whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions import columns as X

DEDUP_KEYS = ("product_name", "source", "price")
CONTRACT_COLUMNS = (
    ("product_name", "string"), ("price", "double"), ("sale_price", "double"),
    ("on_sale", "boolean"), ("source", "string"), ("url", "string"),
    ("category", "string"), ("brand", "string"), ("sku", "string"),
    ("scraped_at", "timestamp_ntz"), ("price_bucket", "string"),
)


def dedup_listings(df: DataFrame, keys=DEDUP_KEYS, order: str = "scraped_at",
                   tie: str | None = "id") -> DataFrame:
    """Keep the latest snapshot per (product_name, source, price).

    Runs on the raw name and raw price, before any cleaning; NULL times sort
    last; ties on time are broken by `tie` descending so the result is
    deterministic. `row_number() == 1` lets Catalyst insert a partial
    WindowGroupLimit before the shuffle, so a hot key is cut to one row per
    map task before it is exchanged.
    """
    ordering = [F.col(order).desc_nulls_last()]
    if tie:
        ordering.append(F.col(tie).desc_nulls_last())
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def normalize_prices(df: DataFrame) -> DataFrame:
    """Non-positive / NULL price -> row dropped; non-positive sale -> NULL;
    on_sale recomputed as sale_price < price."""
    price = F.when(F.col("price") > 0, F.col("price").cast("double"))
    sale = F.when(F.col("sale_price") > 0, F.col("sale_price").cast("double"))
    return (df.withColumn("price", price)
              .withColumn("sale_price", sale)
              .withColumn("on_sale", F.coalesce(F.col("sale_price") < F.col("price"), F.lit(False)))
              .filter(F.col("price").isNotNull()))


def standardize_categories(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    return df.withColumn("category", X.category_standard("category", mapping))


def normalize_brands(df: DataFrame) -> DataFrame:
    return df.withColumn("brand", X.normalized_brand("brand"))


def add_price_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("price_bucket", X.price_bucket(X.effective_price()))


def to_contract(df: DataFrame, timestamp_type: str = "timestamp_ntz") -> DataFrame:
    """The 11-column hand-off contract, cast and ordered.

    `scraped_at` stays a zone-less UTC wall clock by default; pass
    `timestamp_type="timestamp"` for an instant typed column.
    """
    cols = []
    for name, typ in CONTRACT_COLUMNS:
        t = timestamp_type if name == "scraped_at" else typ
        cols.append(F.col(name).cast(t).alias(name))
    return df.select(*cols)


def clean_listings(df: DataFrame, mapping: dict | None = None, tie: str | None = "id",
                   timestamp_type: str = "timestamp_ntz") -> DataFrame:
    """dedup -> prices -> categories -> brands -> bucket -> contract."""
    out = dedup_listings(df, tie=tie)
    out = normalize_prices(out)
    out = standardize_categories(out, mapping)
    out = normalize_brands(out)
    out = add_price_bucket(out)
    return to_contract(out, timestamp_type)


def clean_listings_observed(df: DataFrame, name: str = "clean_counts", **kw):
    """`clean_listings` plus an Observation of the job's counters.

    The counters (input, after dedup, output) are collected by the single
    write action instead of re-reading the table once per counter.
    Returns (clean_df, observation).
    """
    from pyspark.sql import Observation

    raw_obs = Observation(f"{name}_raw")
    raw = df.observe(raw_obs, F.count(F.lit(1)).alias("input_rows"))
    deduped = dedup_listings(raw, tie=kw.get("tie", "id"))
    dd_obs = Observation(f"{name}_dedup")
    deduped = deduped.observe(dd_obs, F.count(F.lit(1)).alias("dedup_rows"))
    out = normalize_prices(deduped)
    out = standardize_categories(out, kw.get("mapping"))
    out = normalize_brands(out)
    out = add_price_bucket(out)
    out = to_contract(out, kw.get("timestamp_type", "timestamp_ntz"))
    out_obs = Observation(f"{name}_out")
    out = out.observe(out_obs, F.count(F.lit(1)).alias("output_rows"))
    return out, (raw_obs, dd_obs, out_obs)
