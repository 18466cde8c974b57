"""Source / sink round trips through the shared scratch folder."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricelens import schemas as S
from pricelens.fixture import view
from pricelens.operators import clean
from pricelens.plans import oracle as O
from pricelens.plans.registry import register
from pricelens.session import scratch_path
from pricelens.sources import listings as IO
from pricelens.sources.json_arrays import read_json_arrays
from pricelens.sources.versions import publish, read_published
from pricelens.streaming.landing import write_landing_batch

RUN_DATE = "2024-01-02"


@register("scan_listings", O.with_views("raw_listings") +
          "select *, cast(null as varchar) as raw_payload from raw_listings")
def q_scan(spark, sf_dir):
    path = scratch_path(spark, "raw_listings")
    IO.replace_table(view(spark, sf_dir, "raw_listings"), path, S.RAW_LISTING)
    return IO.read_listings(spark, path=path)


@register("write_clean_roundtrip", O.with_views("raw_listings") + ", " + O.clean_ctes() +
          f"\nselect *, '{RUN_DATE}' as date from clean")
def q_clean_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "clean")
    IO.write_clean(clean.clean_listings(view(spark, sf_dir, "raw_listings")), root, RUN_DATE)
    return IO.read_clean(spark, root, RUN_DATE)


@register("stage_listings", O.with_views("raw_listings") + """
select id, product_name, cast(price as double) as price, cast(sale_price as double) as sale_price,
 coalesce(on_sale, false) as on_sale, source, url, category, brand, sku, scraped_at,
 cast(null as varchar) as raw_payload from raw_listings""")
def q_stage_listings(spark, sf_dir):
    return IO.stage_listings(view(spark, sf_dir, "raw_listings"))


@register("stage_matched", O.with_views("matched_products") + """
select id, ebay_listing_id, bestbuy_listing_id, canonical_name, brand, model_number,
 cast(confidence_score as double) as confidence_score, coalesce(is_match, false) as is_match, matched_at
from matched_products""")
def q_stage_matched(spark, sf_dir):
    return IO.stage_matched(view(spark, sf_dir, "matched_products"))


LISTING_COLUMNS = [f.name for f in S.RAW_LISTING if f.name not in ("id", "raw_payload")]
INGEST_TS = "2024-01-02 06:00:00"


@register("append_listing_batches", O.with_views("raw_listings") + f"""
select {", ".join(LISTING_COLUMNS)}, cast(1 as bigint) as rows_with_id from raw_listings""")
def q_append_batches(spark, sf_dir):
    """All listings as batches: the marketplace's landed, the retailer's appended, both replayed."""
    target = scratch_path(spark, "listing_table")
    raw = view(spark, sf_dir, "raw_listings").drop("id")
    market, retail = raw.where("source = 'ebay'"), raw.where("source <> 'ebay'")
    for _ in range(2):  # the second round is a replay and adds nothing
        write_landing_batch(market, target, 0, stream="market")
        IO.append_listings(retail, target, batch_key="retail:1")
    back = IO.read_listings(spark, path=target)
    return back.select(*LISTING_COLUMNS, F.count(F.lit(1)).over(Window.partitionBy("id")).alias("rows_with_id"))


@register("archive_raw_items", O.with_views("item_json") + "select item, category from item_json")
def q_archive(spark, sf_dir):
    """The raw items as archived, read back."""
    items = view(spark, sf_dir, "item_json").select("item", "category")
    path = IO.archive_raw(items, scratch_path(spark, "lake"), "ebay", INGEST_TS.replace(" ", "T"))
    return spark.read.schema("item string, category string").json(path)


@register("append_matches_roundtrip", O.with_views("matched_products") + f"""
select ebay_listing_id, bestbuy_listing_id, canonical_name, brand, model_number, confidence_score, is_match,
 timestamp '{INGEST_TS}' as matched_at, cast(1 as bigint) as rows_with_id from matched_products""")
def q_append_matches(spark, sf_dir):
    """Stored verdicts, appended in two parts and read back."""
    target = scratch_path(spark, "matches")
    valid = view(spark, sf_dir, "matched_products").withColumnRenamed("confidence_score", "confidence")
    IO.append_matches(valid.where("is_match"), target, INGEST_TS)
    IO.append_matches(valid.where("not is_match"), target, INGEST_TS)
    back = spark.read.schema(S.MATCHED_PRODUCT).parquet(target)
    return back.withColumn("rows_with_id", F.count(F.lit(1)).over(Window.partitionBy("id"))).drop("id")


@register("reload_published", O.with_views("raw_listings") + """
select id, product_name, price, cast(null as bigint) as ebay_listing_id from raw_listings""")
def q_reload(spark, sf_dir):
    """Listings and the emptied verdicts after a reload of a root that held both."""
    root = scratch_path(spark, "published")
    raw = view(spark, sf_dir, "raw_listings")
    publish(spark, root, {"raw_listings": raw.where("source = 'ebay'"), "matched_products": view(spark, sf_dir, "matched_products")})
    IO.reload_published(view(spark, sf_dir, "raw_listings"), root)
    verdicts = read_published(spark, root, "matched_products").select(F.col("bestbuy_listing_id").alias("id"), "ebay_listing_id")
    return read_published(spark, root, "raw_listings").select("id", "product_name", "price").join(verdicts, "id", "left")


@register("warehouse_views", O.with_views("matched_products") + """
select m.canonical_name, l.source, count(*) as snapshots from matched_products m
join raw_listings l on l.id = m.ebay_listing_id or l.id = m.bestbuy_listing_id
where m.is_match group by m.canonical_name, l.source""")
def q_warehouse_views(spark, sf_dir):
    """Plain SQL over the published staging tables."""
    root = scratch_path(spark, "warehouse")
    publish(spark, root, {"stg_listings": IO.stage_listings(view(spark, sf_dir, "raw_listings")),
                          "stg_matched": IO.stage_matched(view(spark, sf_dir, "matched_products"))})
    IO.register_warehouse_views(spark, root)
    return spark.sql("""
with ids as (select canonical_name, explode(array(ebay_listing_id, bestbuy_listing_id)) as id from stg_matched where is_match)
select canonical_name, source, count(*) as snapshots from ids join stg_listings using (id) group by canonical_name, source""")


def _array_file(batches):
    """The records of a partition as the text of one JSON array."""
    sep = "["
    for pdf in batches:
        if len(pdf):
            lines = "," + pdf["record"]
            lines.iloc[0] = sep + pdf["record"].iloc[0]
            sep = ","
            yield pd.DataFrame({"line": lines})
    yield pd.DataFrame({"line": ["[]" if sep == "[" else "]"]})


@register("listing_json_files", O.with_views("raw_listings") + """
select product_name, price, sale_price, coalesce(on_sale, false) as on_sale, source, url, category, brand, sku, scraped_at,
 '{}' as raw_payload from raw_listings""")
def q_listing_json(spark, sf_dir):
    """Listing array files, read back by splits and with the reader's defaults."""
    path = scratch_path(spark, "listing_json")
    at = F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    raw = view(spark, sf_dir, "raw_listings").drop("id").withColumn("scraped_at", at)
    records = raw.select(F.to_json(F.struct("*")).alias("record"))
    records.mapInPandas(_array_file, "line string").write.text(path)
    return IO.listing_records(spark, read_json_arrays(spark, [path], S.LISTING_JSON))
