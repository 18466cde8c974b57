"""Staging copies, the four dimensions and the price-snapshot fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens import constants as C
from pricelens.functions import columns as X
from pricelens.session import materialize


def _opt(df: DataFrame, name: str, typ: str):
    return F.col(name) if name in df.columns else F.lit(None).cast(typ).alias(name)


def stg_listings(raw: DataFrame) -> DataFrame:
    """Rename id -> listing_id, source -> marketplace_source; float prices."""
    return raw.select(
        F.col("id").alias("listing_id"), "product_name",
        F.col("price").cast("double").alias("price"),
        F.col("sale_price").cast("double").alias("sale_price"),
        "on_sale", F.col("source").cast("string").alias("marketplace_source"),
        "url", "category", "brand", "sku", "scraped_at",
        _opt(raw, "raw_payload", "string"),
    )


def stg_matched(matched: DataFrame) -> DataFrame:
    return matched.select(
        F.col("id").alias("match_id"), "ebay_listing_id", "bestbuy_listing_id", "canonical_name",
        "brand", "model_number", "confidence_score", "is_match", "matched_at",
    )


def dim_product(stg: DataFrame, matches: DataFrame | None = None) -> DataFrame:
    """DISTINCT (product_name, brand), keyed on the name only.

    A name sold under two brands gives two rows with one key: the fan-out the
    `unique` check reports. With `matches` (staged verdicts) the model number
    and confidence of the best accepted match per name are filled in;
    otherwise both stay typed NULLs.
    """
    d = stg.select("product_name", "brand").distinct()
    out = d.select(
        X.surrogate_key("product_name").alias("product_key"),
        F.col("product_name").alias("canonical_name"), "brand",
    )
    if matches is None:
        return out.select("*", F.lit(None).cast("string").alias("model_number"),
                          F.lit(None).cast("double").alias("matched_confidence_score"))
    best = best_accepted_match(matches)
    return out.join(best, on="canonical_name", how="left").select(
        "product_key", "canonical_name", "brand", "model_number", "matched_confidence_score")


def best_accepted_match(matches: DataFrame) -> DataFrame:
    """Per canonical name, the accepted verdict with the highest confidence
    (ties: higher match id). A partial aggregate: no group is collected."""
    acc = matches.filter(F.col("is_match") & (F.col("confidence_score") >= C.CONFIDENCE_THRESHOLD))
    ordk = F.struct(F.col("confidence_score"), F.col("match_id" if "match_id" in matches.columns else "id"))
    return acc.groupBy("canonical_name").agg(
        F.max_by(F.col("model_number"), ordk).alias("model_number"),
        F.max(F.col("confidence_score")).alias("matched_confidence_score"),
    )


def dim_source(stg: DataFrame) -> DataFrame:
    d = stg.select("marketplace_source").distinct()
    return d.select(
        X.surrogate_key("marketplace_source").alias("source_key"),
        F.col("marketplace_source").alias("marketplace_name"),
        F.lit(None).cast("string").alias("listing_url"),
        F.lit(None).cast("double").alias("seller_rating"),
    )


def dim_time(stg: DataFrame) -> DataFrame:
    """DISTINCT scraped_at (a NULL time is a row too) with calendar parts.

    day_of_week is 1 = Sunday .. 7 = Saturday; week_number counts weeks that
    start on Sunday, 0-53.
    """
    t = F.col("scraped_at")
    dow = F.dayofweek(t)
    return stg.select("scraped_at").distinct().select(
        X.surrogate_key_ts("scraped_at").alias("time_key"),
        "scraped_at",
        F.hour(t).cast("bigint").alias("hour"),
        dow.cast("bigint").alias("day_of_week"),
        F.when(dow.isin(1, 7), F.lit(True)).otherwise(F.lit(False)).alias("is_weekend"),
        X.sunday_week(t).alias("week_number"),
        F.month(t).cast("bigint").alias("month"),
    )


def dim_category(stg: DataFrame) -> DataFrame:
    d = stg.filter(F.col("category").isNotNull()).select("category").distinct()
    return d.select(
        X.surrogate_key("category").alias("category_key"),
        F.col("category").alias("category_name"),
        F.lit(None).cast("string").alias("subcategory"),
    )


def fact_price_snapshot(stg: DataFrame, p: DataFrame, s: DataFrame, t: DataFrame,
                        c: DataFrame) -> DataFrame:
    """Listings left-joined to the four dimensions.

    No hints: a small written dim is broadcast by its file size, any other by
    AQE from its measured bytes. dim_product / dim_time grow with the data
    and go to shuffle joins, which AQE may convert to broadcasts or split
    when a hot product skews a partition.
    """
    l = stg.alias("l")
    s_, c_ = s.alias("s"), c.alias("c")
    j = (l.join(p.alias("p"), F.col("l.product_name") == F.col("p.canonical_name"), "left")
          .join(s_, F.col("l.marketplace_source") == F.col("s.marketplace_name"), "left")
          .join(t.alias("t"), F.col("l.scraped_at") == F.col("t.scraped_at"), "left")
          .join(c_, F.col("l.category") == F.col("c.category_name"), "left"))
    return j.select(*_fact_columns(
        F.col("p.product_key"), F.col("s.source_key"), F.col("t.time_key"), F.col("c.category_key"),
        F.col("l.price"), F.col("l.on_sale"), F.col("l.sale_price"), F.col("l.listing_id"), F.col("l.scraped_at")))


def _fact_columns(product_key, source_key, time_key, category_key, price, on_sale, sale_price,
                  listing_id, scraped_at) -> list:
    return [
        F.md5(F.concat_ws(C.SURROGATE_SEP,
                          F.coalesce(listing_id.cast("string"), F.lit(C.SURROGATE_NULL)),
                          F.coalesce(X.ts_text(scraped_at), F.lit(C.SURROGATE_NULL)))).alias("snapshot_id"),
        product_key.alias("product_key"), source_key.alias("source_key"), time_key.alias("time_key"),
        category_key.alias("category_key"), price.alias("price"), on_sale.alias("was_on_sale"),
        X.discount_pct(price, sale_price).alias("discount_pct"), F.lit(True).alias("in_stock"),
    ]


def fact_from_staging(stg: DataFrame) -> DataFrame:
    """The fact when the four dims are built from this same `stg`, without
    shuffling the listings.

    Equivalent row for row to `fact_price_snapshot(stg, dim_*(stg))`:
    every dim key is a pure function of its natural key, and a listing finds
    its dim row exactly when that key is not NULL (the joins use `=`). The
    only multiplication is dim_product's: a name listed under n distinct
    brands matches n rows (the fan-out the `unique` check reports), so each
    listing is repeated n times. The per-name n table (one row per distinct
    name) is written once to the checkpoint folder; it is broadcast when its
    bytes are within Spark's threshold, and joined by shuffle with a hot
    product split otherwise.
    """
    copies = (stg.select("product_name", "brand").distinct()
                 .filter(F.col("product_name").isNotNull())
                 .groupBy("product_name").agg(F.count(F.lit(1)).alias("_copies")))
    copies, _ = materialize(copies, "fact_name_copies")
    j = stg.join(copies, "product_name", "left")
    j = j.withColumn("_rep", F.explode(F.array_repeat(F.lit(0), F.coalesce(F.col("_copies"), F.lit(1)).cast("int"))))
    name, src, ts, cat = (F.col("product_name"), F.col("marketplace_source"), F.col("scraped_at"), F.col("category"))
    return j.select(*_fact_columns(
        F.when(F.col("_copies").isNotNull(), X.surrogate_key(name)),
        F.when(src.isNotNull(), X.surrogate_key(src)),
        F.when(ts.isNotNull(), X.surrogate_key_ts(ts)),
        F.when(cat.isNotNull(), X.surrogate_key(cat)),
        F.col("price"), F.col("on_sale"), F.col("sale_price"), F.col("listing_id"), ts))


def build_star(raw: DataFrame, matches: DataFrame | None = None) -> dict[str, DataFrame]:
    """All marts from one staged listing frame (fact via `fact_from_staging`)."""
    stg = stg_listings(raw)
    p, s, t, c = dim_product(stg, matches), dim_source(stg), dim_time(stg), dim_category(stg)
    return {"stg_listings": stg, "dim_product": p, "dim_source": s, "dim_time": t,
            "dim_category": c, "fact_price_snapshot": fact_from_staging(stg)}


def product_fanout(stg: DataFrame) -> DataFrame:
    """Names whose dim_product rows are not unique and the fact rows they make.

    Computed from per-name counts on both sides (pre-aggregated, then a
    name-level join) instead of materialising the fanned-out fact.
    """
    dims = dim_product(stg).groupBy("canonical_name").agg(F.count(F.lit(1)).alias("dim_rows"))
    lst = stg.groupBy("product_name").agg(F.count(F.lit(1)).alias("listings"))
    return (lst.join(dims.filter(F.col("dim_rows") > 1),
                     lst.product_name == dims.canonical_name, "inner")
               .select("product_name", "dim_rows", "listings",
                       (F.col("listings") * F.col("dim_rows")).alias("fact_rows")))
