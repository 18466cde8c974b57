"""Expose the staging and mart models as temp views for ad-hoc Spark SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelens.operators import warehouse as W


def register_models(spark: SparkSession, raw: DataFrame, matched: DataFrame | None = None) -> list[str]:
    """Create temp views stg_listings, dim_product, dim_source, dim_time,
    dim_category, fact_price_snapshot (and stg_matched when `matched` is
    given) over `raw`. Views are lazy: each SQL query plans through
    them; only the fact's table of brands per name is written at once."""
    star = W.build_star(raw)
    views = dict(star)
    if matched is not None:
        views["stg_matched"] = W.stg_matched(matched)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
