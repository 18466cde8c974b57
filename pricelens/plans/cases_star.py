"""Staging, star-schema and data-quality queries."""

from __future__ import annotations

from pricelens.fixture import view
from pricelens.operators import quality as Q
from pricelens.operators import warehouse as W
from pricelens.plans import oracle as O
from pricelens.plans.registry import register

STG_SQL = """stg as (select id as listing_id, product_name, cast(price as double) as price,
 cast(sale_price as double) as sale_price, on_sale, cast(source as varchar) as marketplace_source,
 url, category, brand, sku, scraped_at, cast(null as varchar) as raw_payload from {src})"""

DIMS_SQL = f"""dim_product as (select {O.sk_sql('product_name')} as product_key, product_name as canonical_name, brand,
   cast(null as varchar) as model_number, cast(null as double) as matched_confidence_score
   from (select distinct product_name, brand from stg) x),
 dim_source as (select {O.sk_sql('marketplace_source')} as source_key, marketplace_source as marketplace_name,
   cast(null as varchar) as listing_url, cast(null as double) as seller_rating
   from (select distinct marketplace_source from stg) x),
 dim_time as (select {O.sk_ts_sql('scraped_at')} as time_key, scraped_at,
   cast(hour(scraped_at) as bigint) as hour, cast(dayofweek(scraped_at) + 1 as bigint) as day_of_week,
   case when dayofweek(scraped_at) + 1 in (1, 7) then true else false end as is_weekend,
   cast(strftime(scraped_at, '%U') as bigint) as week_number, cast(month(scraped_at) as bigint) as month
   from (select distinct scraped_at from stg) x),
 dim_category as (select {O.sk_sql('category')} as category_key, category as category_name,
   cast(null as varchar) as subcategory
   from (select distinct category from stg where category is not null) x)"""

FACT_SQL = f"""fact as (select md5(concat_ws('-', coalesce(cast(l.listing_id as varchar), '_dbt_utils_surrogate_key_null_'),
   coalesce({O.ts_text_sql('l.scraped_at')}, '_dbt_utils_surrogate_key_null_'))) as snapshot_id,
   p.product_key, s.source_key, t.time_key, c.category_key, l.price, l.on_sale as was_on_sale,
   case when l.sale_price is not null and l.price > 0 then round((l.price - l.sale_price) / l.price * 100, 2)
        else 0.0 end as discount_pct, true as in_stock
 from stg l
 left join dim_product p on l.product_name = p.canonical_name
 left join dim_source s on l.marketplace_source = s.marketplace_name
 left join dim_time t on l.scraped_at = t.scraped_at
 left join dim_category c on l.category = c.category_name)"""


def _star_sql(view_name: str, tail: str) -> str:
    return (O.with_views(view_name) + ", " + STG_SQL.format(src=view_name) + ",\n " + DIMS_SQL
            + ",\n " + FACT_SQL + "\n" + tail)


def stg_of(spark, sf_dir, name="star_listings"):
    return W.stg_listings(view(spark, sf_dir, name))


@register("stg_listings", _star_sql("raw_listings", "select * from stg"))
def q_stg_listings(spark, sf_dir):
    return stg_of(spark, sf_dir, "raw_listings")


@register("stg_matched", O.with_views("matched_products") +
          "select id as match_id, ebay_listing_id, bestbuy_listing_id, canonical_name, brand, model_number, "
          "confidence_score, is_match, matched_at from matched_products")
def q_stg_matched(spark, sf_dir):
    return W.stg_matched(view(spark, sf_dir, "matched_products"))


@register("dim_product", _star_sql("star_listings", "select * from dim_product"))
def q_dim_product(spark, sf_dir):
    return W.dim_product(stg_of(spark, sf_dir))


@register("dim_source", _star_sql("star_listings", "select * from dim_source"))
def q_dim_source(spark, sf_dir):
    return W.dim_source(stg_of(spark, sf_dir))


@register("dim_time", _star_sql("star_listings", "select * from dim_time"))
def q_dim_time(spark, sf_dir):
    return W.dim_time(stg_of(spark, sf_dir))


@register("dim_category", _star_sql("star_listings", "select * from dim_category"))
def q_dim_category(spark, sf_dir):
    return W.dim_category(stg_of(spark, sf_dir))


@register("fact_price_snapshot", _star_sql("star_listings", "select * from fact"))
def q_fact(spark, sf_dir):
    return W.build_star(view(spark, sf_dir, "star_listings"))["fact_price_snapshot"]


@register("fact_star_joins", _star_sql("star_listings", "select * from fact"))
def q_fact_joins(spark, sf_dir):
    """The fact through the explicit four left joins (J1-J4) against dims
    built from the same staging; same rows as `fact_price_snapshot`."""
    stg = stg_of(spark, sf_dir)
    return W.fact_price_snapshot(stg, W.dim_product(stg), W.dim_source(stg), W.dim_time(stg), W.dim_category(stg))


@register("fact_fanout", _star_sql("raw_listings", """select l.product_name, d.dim_rows,
 count(distinct l.listing_id) as listings, count(*) as fact_rows
 from stg l join dim_product p on l.product_name = p.canonical_name
 join (select canonical_name, count(*) as dim_rows from dim_product group by canonical_name) d
   on d.canonical_name = l.product_name
 group by l.product_name, d.dim_rows having count(*) > count(distinct l.listing_id)"""))
def q_fanout(spark, sf_dir):
    return W.product_fanout(stg_of(spark, sf_dir, "raw_listings"))


@register("dim_product_enriched", O.with_views("star_listings", "matched_products") + ", "
          + STG_SQL.format(src="star_listings") + f""",
 best as (select canonical_name, arg_max(model_number, struct_pack(c := confidence_score, i := id)) as model_number,
   max(confidence_score) as matched_confidence_score
   from matched_products where is_match and confidence_score >= 0.6 group by canonical_name)
 select {O.sk_sql('d.product_name')} as product_key, d.product_name as canonical_name, d.brand,
   b.model_number, b.matched_confidence_score
 from (select distinct product_name, brand from stg) d left join best b on d.product_name = b.canonical_name""")
def q_dim_product_enriched(spark, sf_dir):
    stg = stg_of(spark, sf_dir)
    return W.dim_product(stg, W.stg_matched(view(spark, sf_dir, "matched_products")))


# Quality checks: `unique` on the marts built from the raw (dirty) listings,
# where a name with two brands breaks dim_product's key; `not_null` on the
# clean star; referential and DDL NOT NULL checks on the matches.

@register("dq_unique", _star_sql("raw_listings", """
select 'unique' as check_name, t as table_name, c as column_name, cast(f as bigint) as failures from (
 select 'dim_product' as t, 'product_key' as c, (select count(*) from (select product_key from dim_product where product_key is not null group by 1 having count(*) > 1) x) as f
 union all select 'dim_source', 'source_key', (select count(*) from (select source_key from dim_source where source_key is not null group by 1 having count(*) > 1) x)
 union all select 'dim_time', 'time_key', (select count(*) from (select time_key from dim_time where time_key is not null group by 1 having count(*) > 1) x)
 union all select 'dim_category', 'category_key', (select count(*) from (select category_key from dim_category where category_key is not null group by 1 having count(*) > 1) x)
) u"""))
def q_dq_unique(spark, sf_dir):
    stg = stg_of(spark, sf_dir, "raw_listings")
    return Q.union_checks(
        Q.check_unique(W.dim_product(stg), "product_key", "dim_product"),
        Q.check_unique(W.dim_source(stg), "source_key", "dim_source"),
        Q.check_unique(W.dim_time(stg), "time_key", "dim_time"),
        Q.check_unique(W.dim_category(stg), "category_key", "dim_category"),
    )


@register("dq_not_null", _star_sql("star_listings", """
select 'not_null' as check_name, t as table_name, c as column_name, cast(f as bigint) as failures from (
 select 'dim_product' as t, 'product_key' as c, (select count(*) from dim_product where product_key is null) as f
 union all select 'dim_source', 'source_key', (select count(*) from dim_source where source_key is null)
 union all select 'dim_time', 'time_key', (select count(*) from dim_time where time_key is null)
 union all select 'dim_category', 'category_key', (select count(*) from dim_category where category_key is null)
 union all select 'fact_price_snapshot', 'snapshot_id', (select count(*) from fact where snapshot_id is null)
 union all select 'fact_price_snapshot', 'product_key', (select count(*) from fact where product_key is null)
) u"""))
def q_dq_not_null(spark, sf_dir):
    star = W.build_star(view(spark, sf_dir, "star_listings"))
    return Q.union_checks(
        Q.check_not_null(star["dim_product"], ["product_key"], "dim_product"),
        Q.check_not_null(star["dim_source"], ["source_key"], "dim_source"),
        Q.check_not_null(star["dim_time"], ["time_key"], "dim_time"),
        Q.check_not_null(star["dim_category"], ["category_key"], "dim_category"),
        Q.check_not_null(star["fact_price_snapshot"], ["snapshot_id", "product_key"], "fact_price_snapshot"),
    )


@register("dq_referential", O.with_views("matched_products") + """
select check_name, table_name, column_name, cast(f as bigint) as failures from (
 select 'relationships' as check_name, 'matched_products' as table_name, 'ebay_listing_id' as column_name,
   (select count(*) from matched_products m where ebay_listing_id is not null
     and not exists (select 1 from raw_listings r where r.id = m.ebay_listing_id)) as f
 union all select 'relationships', 'matched_products', 'bestbuy_listing_id',
   (select count(*) from matched_products m where bestbuy_listing_id is not null
     and not exists (select 1 from raw_listings r where r.id = m.bestbuy_listing_id))
 union all select 'not_null', 'raw_listings', 'product_name', (select count(*) from raw_listings where product_name is null)
 union all select 'not_null', 'raw_listings', 'source', (select count(*) from raw_listings where source is null)
 union all select 'not_null', 'matched_products', 'canonical_name', (select count(*) from matched_products where canonical_name is null)
 union all select 'not_null', 'matched_products', 'confidence_score', (select count(*) from matched_products where confidence_score is null)
 union all select 'not_null', 'matched_products', 'is_match', (select count(*) from matched_products where is_match is null)
) u""")
def q_dq_referential(spark, sf_dir):
    raw = view(spark, sf_dir, "raw_listings")
    m = view(spark, sf_dir, "matched_products")
    return Q.union_checks(
        Q.check_references(m, ["ebay_listing_id", "bestbuy_listing_id"], raw, "id", "matched_products"),
        Q.check_not_null(raw, ["product_name", "source"], "raw_listings"),
        Q.check_not_null(m, ["canonical_name", "confidence_score", "is_match"], "matched_products"),
    )
