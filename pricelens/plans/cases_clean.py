"""Clean-job queries (dedup, prices, categories, brands, buckets, contract)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens.fixture import view
from pricelens.functions import columns as X
from pricelens.operators import clean
from pricelens.plans import oracle as O
from pricelens.plans.registry import register

RAW = O.with_views("raw_listings")


def raw(spark, sf_dir):
    return view(spark, sf_dir, "raw_listings")


@register("dedup_listings", RAW + f", {O.DEDUP_CTE}\nselect * from deduped")
def q_dedup(spark, sf_dir):
    return clean.dedup_listings(raw(spark, sf_dir))


@register("normalize_prices", RAW + f", {O.DEDUP_CTE},\n {O.PRICED_CTE}\n"
          "select id, product_name, price, sale_price, on_sale, source from priced")
def q_prices(spark, sf_dir):
    df = clean.normalize_prices(clean.dedup_listings(raw(spark, sf_dir)))
    return df.select("id", "product_name", "price", "sale_price", "on_sale", "source")


@register("standardize_categories", RAW +
          f"select id, category as raw_category, {O.category_case()} as category from raw_listings")
def q_categories(spark, sf_dir):
    df = raw(spark, sf_dir).select("id", F.col("category").alias("raw_category"), "category")
    return clean.standardize_categories(df)


@register("normalize_brands", RAW +
          f"select id, brand as raw_brand, {O.brand_sql()} as brand from raw_listings")
def q_brands(spark, sf_dir):
    df = raw(spark, sf_dir).select("id", F.col("brand").alias("raw_brand"), "brand")
    return clean.normalize_brands(df)


@register("price_buckets", RAW +
          "select id, eff as effective_price, " + O.bucket_sql("eff") + " as price_bucket from ("
          "select id, " + O.eff_sql() + " as eff from (select id, "
          "case when price > 0 then price end as price, "
          "case when sale_price > 0 then sale_price end as sale_price, "
          "coalesce((case when sale_price > 0 then sale_price end) < (case when price > 0 then price end), false) as on_sale "
          "from raw_listings) p where price is not null) e")
def q_buckets(spark, sf_dir):
    df = clean.normalize_prices(raw(spark, sf_dir))
    return df.select("id", X.effective_price().alias("effective_price"),
                     X.price_bucket(X.effective_price()).alias("price_bucket"))


@register("clean_contract", RAW + f", {O.clean_ctes()}\nselect * from clean")
def q_clean_contract(spark, sf_dir):
    return clean.clean_listings(raw(spark, sf_dir))
