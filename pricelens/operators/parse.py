"""Marketplace item JSON -> listing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens import constants as C
from pricelens import schemas as S
from pricelens.functions.columns import brand_from_title

LISTING_COLUMNS = ("product_name", "price", "sale_price", "on_sale", "source", "url",
                   "category", "brand", "sku", "scraped_at", "raw_payload")


def extract_brand(title, upper_title=None) -> Column:
    return brand_from_title(title, upper_title)


def parse_items(df: DataFrame, item_col: str = "item", category_col: str = "category",
                scraped_at=None, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """Parse marketplace items (JSON text) into listing rows.

    current = price.value (0 when missing); original = marketingPrice.
    originalPrice.value when non-empty; on_sale = current < original;
    price = original when non-zero else current; sale_price = current when
    on sale. Missing title / url / item id become ''. Unparsable numbers are
    treated as missing. The item text is kept whole as raw_payload.
    """
    # Parse once into its own column: reading fields straight off from_json
    # lets the optimizer split it into one pruned parse per field.
    keep = [k for k in keep if k in df.columns]
    parsed = df.select(*keep, F.col(item_col).alias("_item"), F.col(category_col).alias("_cat"),
                       F.from_json(F.col(item_col), S.MARKETPLACE_ITEM).alias("_j"))
    it = F.col("_j")
    cur = F.coalesce(it["price"]["value"].try_cast("double"), F.lit(0.0))
    orig_txt = it["marketingPrice"]["originalPrice"]["value"]
    orig = F.when(orig_txt != "", orig_txt.try_cast("double"))
    title = F.coalesce(it["title"], F.lit(""))
    ts = F.lit(None).cast("timestamp_ntz") if scraped_at is None else (
        scraped_at if isinstance(scraped_at, Column) else F.lit(scraped_at).cast("timestamp_ntz"))
    staged = parsed.select(*keep, "_item", "_cat", cur.alias("_cur"), orig.alias("_orig"), title.alias("_title"),
                           F.coalesce(it["itemWebUrl"], F.lit("")).alias("_url"),
                           F.coalesce(it["itemId"], F.lit("")).alias("_sku"))
    staged = staged.withColumn("_up", F.upper(F.col("_title")))
    on_sale = F.coalesce(F.col("_cur") < F.col("_orig"), F.lit(False))
    return staged.select(
        *keep,
        F.col("_title").alias("product_name"),
        F.when(F.col("_orig").isNotNull() & (F.col("_orig") != 0), F.col("_orig"))
         .otherwise(F.col("_cur")).alias("price"),
        F.when(on_sale, F.col("_cur")).alias("sale_price"),
        on_sale.alias("on_sale"),
        F.lit(C.SOURCE_MARKETPLACE).alias("source"),
        F.col("_url").alias("url"),
        F.col("_cat").alias("category"),
        extract_brand(F.col("_title"), F.col("_up")).alias("brand"),
        F.col("_sku").alias("sku"),
        ts.alias("scraped_at"),
        F.col("_item").alias("raw_payload"),
    )
