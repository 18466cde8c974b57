"""Marketplace item parsing, brand extraction and feed union."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens import constants as C
from pricelens.fixture import view
from pricelens.operators import parse
from pricelens.operators import summaries as A
from pricelens.plans import oracle as O
from pricelens.plans.registry import register

BATCH_TS = "2024-01-01 06:00:00"


def brand_case_sql(title: str) -> str:
    hits = " ".join(f"when contains(upper({title}), {O._q(b.upper())}) then {O._q(b)}" for b in C.KNOWN_BRANDS)
    token = f"nullif(regexp_extract({title}, '^\\s*(\\S+)', 1), '')"
    return f"coalesce(case {hits} end, {token}, {O._q(C.UNKNOWN_TITLE_BRAND)})"


ITEMS_SQL = f"""items as (select id, item, category,
   coalesce(try_cast(json_extract_string(item, '$.price.value') as double), 0.0) as cur,
   case when json_extract_string(item, '$.marketingPrice.originalPrice.value') <> ''
        then try_cast(json_extract_string(item, '$.marketingPrice.originalPrice.value') as double) end as orig,
   coalesce(json_extract_string(item, '$.title'), '') as title,
   coalesce(json_extract_string(item, '$.itemWebUrl'), '') as url,
   coalesce(json_extract_string(item, '$.itemId'), '') as sku from item_json),
 parsed as (select id, title as product_name,
   case when orig is not null and orig <> 0 then orig else cur end as price,
   case when coalesce(cur < orig, false) then cur end as sale_price,
   coalesce(cur < orig, false) as on_sale, 'ebay' as source, url, category,
   {brand_case_sql('title')} as brand, sku, timestamp '{BATCH_TS}' as scraped_at, item as raw_payload
   from items)"""


def items(spark, sf_dir):
    return view(spark, sf_dir, "item_json")


@register("parse_marketplace_items", O.with_views("item_json") + ", " + ITEMS_SQL + "\nselect * from parsed")
def q_parse(spark, sf_dir):
    return parse.parse_items(items(spark, sf_dir), scraped_at=BATCH_TS)


@register("extract_brand", O.with_views("item_json") +
          ", t as (select id, json_extract_string(item, '$.title') as title from item_json)\n"
          "select id, title, " + brand_case_sql("coalesce(title, '')") + " as brand from t")
def q_extract_brand(spark, sf_dir):
    from pricelens import schemas as S
    df = items(spark, sf_dir).select("id", F.from_json("item", S.MARKETPLACE_ITEM)["title"].alias("title"))
    return df.select("id", "title", parse.extract_brand(F.coalesce(F.col("title"), F.lit(""))).alias("brand"))


@register("union_feeds", O.with_views("item_json", "raw_listings") + ", " + ITEMS_SQL + """
select id, product_name, price, sale_price, on_sale, source, url, category, brand, sku, scraped_at, raw_payload from parsed
union all
select id, product_name, price, sale_price, on_sale, source, url, category, brand, sku, scraped_at,
  cast(null as varchar) as raw_payload from raw_listings where source = 'bestbuy'""")
def q_union_feeds(spark, sf_dir):
    """Both feeds whole: all parsed marketplace items, and the retailer's feed, which by definition
    is the listings of source 'bestbuy' (the fixture's listing view also holds marketplace listings)."""
    marketplace = parse.parse_items(items(spark, sf_dir), scraped_at=BATCH_TS)
    retailer = view(spark, sf_dir, "raw_listings").filter(F.col("source") == C.SOURCE_RETAILER)
    retailer = retailer.withColumn("raw_payload", F.lit(None).cast("string"))
    return A.union_feeds(marketplace, retailer.select(*marketplace.columns))
