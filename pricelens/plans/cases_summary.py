"""Counts, summaries, unions and extracts."""

from __future__ import annotations


from pricelens.fixture import view
from pricelens.operators import clean
from pricelens.operators import summaries as A
from pricelens.plans import oracle as O
from pricelens.plans.registry import register

RAW = O.with_views("raw_listings")
CLEAN = RAW + ", " + O.clean_ctes() + "\n"


def raw(spark, sf_dir):
    return view(spark, sf_dir, "raw_listings")


@register("count_source_category", CLEAN +
          "select source, category, count(*) as listings from clean group by source, category")
def q_count_source_category(spark, sf_dir):
    return A.count_by(clean.clean_listings(raw(spark, sf_dir)), "source", "category")


@register("raw_summary", RAW + "select source, category, count(*) as listings from raw_listings "
          "group by source, category order by source, category")
def q_raw_summary(spark, sf_dir):
    return A.count_by(raw(spark, sf_dir), "source", "category").orderBy("source", "category")


@register("count_price_bucket", CLEAN +
          "select price_bucket, count(*) as listings from clean group by price_bucket")
def q_count_price_bucket(spark, sf_dir):
    return A.count_by(clean.clean_listings(raw(spark, sf_dir)), "price_bucket")


@register("pipeline_counts", RAW + """, ranked as (select price, row_number() over (
   partition by product_name, source, price order by scraped_at desc nulls last, id desc nulls last) = 1 as kept
   from raw_listings)
select count(*) as input_rows, count(*) filter (where kept) as dedup_rows,
 count(*) filter (where not kept) as removed_duplicates,
 count(*) filter (where kept and price > 0) as output_rows from ranked""")
def q_pipeline_counts(spark, sf_dir):
    return A.clean_counts(raw(spark, sf_dir))


@register("distinct_sources_categories", CLEAN +
          "select distinct 'source' as column_name, source as value from clean "
          "union all select distinct 'category' as column_name, category as value from clean")
def q_distinct_values(spark, sf_dir):
    return A.distinct_values(clean.clean_listings(raw(spark, sf_dir)), "source", "category")


@register("category_source_pivot", RAW + """select category,
 count(*) filter (where source = 'ebay') as ebay_listings,
 count(*) filter (where source = 'bestbuy') as bestbuy_listings
from raw_listings group by category""")
def q_pivot(spark, sf_dir):
    return A.category_source_pivot(raw(spark, sf_dir))


@register("source_counts", RAW + """select count(*) as total_listings,
 count(*) filter (where source = 'ebay') as ebay_listings,
 count(*) filter (where source = 'bestbuy') as bestbuy_listings from raw_listings""")
def q_source_counts(spark, sf_dir):
    return A.source_counts(raw(spark, sf_dir))


@register("sample_extract", RAW + "select * from raw_listings order by id limit 10")
def q_sample_extract(spark, sf_dir):
    return A.sample_extract(raw(spark, sf_dir), 10)


@register("random_subset", RAW + "select * from raw_listings "
          "order by md5(concat(cast(id as varchar), ':42')), id limit 4000")
def q_random_subset(spark, sf_dir):
    return A.random_subset(raw(spark, sf_dir), 4000, seed=42)
