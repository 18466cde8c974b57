"""Listing views derived from the driver's TPC-H-style tables.

The driver tables carry no listings, so these views derive listings, matches,
verdict texts and marketplace items from `lineitem`, `part` and `events`.
The SQL text is the same in Spark and in the DuckDB oracle (where each view is
inlined as a CTE), so both engines see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_LISTING_ID = ("((((l_orderkey*100000+l_partkey)*10000+l_suppkey)*10+l_linenumber)*100"
               "+cast(l_quantity as bigint))")

VIEW_SQL: dict[str, str] = {
    "raw_listings": f"""
select {_LISTING_ID} as id, p_name as product_name,
 cast(floor(l_extendedprice/1000)*10 as double) as price,
 case when l_discount>0 then cast(floor(floor(l_extendedprice/1000)*1000*(1-l_discount)) as double)/100 end as sale_price,
 l_discount>0.05 as on_sale,
 case when l_suppkey%2=0 then 'ebay' else 'bestbuy' end as source,
 concat('https://example.com/itm/',cast(l_partkey as varchar(20))) as url,
 case when l_suppkey%11=0 then null
      when p_type='ECONOMY' then case when l_suppkey%3=0 then 'Televisions' else 'TVs' end
      when p_type='LARGE' then case when l_suppkey%3=0 then 'Laptops & Netbooks' else 'Notebook' end
      when p_type='MEDIUM' then case when l_suppkey%3=0 then 'Earbuds' else 'Headphones' end
      when p_type='PROMO' then 'Smart Watches'
      when p_type='SMALL' then case when l_suppkey%3=0 then 'iPad' else 'Tablet' end
      else 'Cameras' end as category,
 case when l_suppkey%7=0 then null when l_suppkey%5=0 then concat('  ',upper(p_brand),' Electronics')
      when l_suppkey%5=1 then concat(p_brand,' Inc.') else p_brand end as brand,
 cast(l_partkey as varchar(20)) as sku, l_shipdate as scraped_at
from lineitem join part on l_partkey=p_partkey""",
    "star_listings": f"""
select {_LISTING_ID} as id, concat(p_name,' ',cast(p_partkey as varchar(20))) as product_name,
 cast(floor(l_extendedprice*100/l_quantity) as double)/100 as price,
 case when l_discount>0 then cast(floor(floor(l_extendedprice*100/l_quantity)*(1-l_discount)) as double)/100 end as sale_price,
 l_discount>0 as on_sale, case when l_suppkey%2=0 then 'ebay' else 'bestbuy' end as source,
 cast(null as varchar(20)) as url, case when l_suppkey%11=0 then null else p_type end as category, p_brand as brand,
 cast(l_partkey as varchar(20)) as sku, l_shipdate as scraped_at
from lineitem join part on l_partkey=p_partkey""",
    "matched_products": """
select ebay_listing_id+bestbuy_listing_id as id, ebay_listing_id, bestbuy_listing_id, product_name as canonical_name,
 cast(null as varchar(20)) as brand, case when bestbuy_listing_id%3=0 then 'M1' end as model_number,
 cast(bestbuy_listing_id%101 as double)/100 as confidence_score, ebay_listing_id%2=0 as is_match, matched_at
from (select category, product_name, min(id) filter (where source='ebay') as ebay_listing_id,
  min(id) filter (where source='bestbuy') as bestbuy_listing_id, max(scraped_at) as matched_at
 from raw_listings group by category, product_name) x where ebay_listing_id is not null and bestbuy_listing_id is not null""",
    "verdict_json": """
select event_id as pair_id, case
 when event_id%10=0 then 'not json'
 when event_id%10=1 then concat('{"is_match":true,"confidence":1.5,"canonical_name":"X","brand":"Y","reasoning":"', event_type,'"}')
 when event_id%10=2 then concat('{"confidence":0.5,"reasoning":"', event_type,'"}')
 when event_id%10=3 then concat('{"is_match":true,"confidence":0.7,"canonical_name":"","brand":null,"reasoning":"', event_type,'"}')
 else concat('{"is_match":', case when user_id%2=0 then 'true' else 'false' end, ',"confidence":0.', cast(event_id%100 as varchar(20)), ',"canonical_name":"N","brand":"B","model_number":"M1","reasoning":"', event_type,'"}') end as verdict
from events""",
    "item_json": f"""
select {_LISTING_ID} as id, concat('{{"itemId":"v1|',cast(l_orderkey as varchar(20)),'|0"',
 case when l_linenumber=7 then '' else concat(',"title":"', case l_suppkey%4 when 0 then 'Samsung ' when 1 then 'new lg ' when 2 then 'Algorithm ' else '' end, p_name,'"') end,
 case when l_linenumber=6 then '' else concat(',"price":{{"value":"',cast(cast(floor(l_extendedprice) as bigint) as varchar(20)),'.50","currency":"USD"}}') end,
 case when l_linenumber%3=0 then '' else concat(',"marketingPrice":{{"originalPrice":{{"value":"',cast(cast(floor(l_extendedprice*(1+l_discount)) as bigint) as varchar(20)),'.00"}}}}') end,
 '}}') as item, p_type as category
from lineitem join part on l_partkey=p_partkey""",
}

# Which views each view reads (besides base tables).
VIEW_DEPS = {"matched_products": ("raw_listings",)}
VIEW_BASES = {
    "raw_listings": ("lineitem", "part"),
    "star_listings": ("lineitem", "part"),
    "matched_products": ("lineitem", "part"),
    "verdict_json": ("events",),
    "item_json": ("lineitem", "part"),
}


def register_base_tables(spark: SparkSession, sf_dir: str, names=("lineitem", "part", "events")) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Return the named fixture view as a DataFrame over the tables in `sf_dir`."""
    bases = set(VIEW_BASES[name])
    register_base_tables(spark, sf_dir, sorted(bases))
    for dep in VIEW_DEPS.get(name, ()):
        spark.sql(VIEW_SQL[dep]).createOrReplaceTempView(dep)
    return spark.sql(VIEW_SQL[name])


def cte(*names: str) -> str:
    """`with a as (...), b as (...)` prefix for the DuckDB oracle (deps first)."""
    ordered: list[str] = []
    for n in names:
        for dep in VIEW_DEPS.get(n, ()):
            if dep not in ordered:
                ordered.append(dep)
        if n not in ordered:
            ordered.append(n)
    return "with " + ",\n".join(f"{n} as ({VIEW_SQL[n]})" for n in ordered) + "\n"
