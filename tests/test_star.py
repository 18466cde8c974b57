"""The shuffle-free fact equals the four-join fact, fan-out and NULLs included."""

import datetime as dt
from collections import Counter

from tests.conftest import SF_SMALL

from pricelens.fixture import view
from pricelens.operators import warehouse as W


def _bag(df):
    return Counter(tuple(r) for r in df.collect())


def _both(stg):
    joined = W.fact_price_snapshot(stg, W.dim_product(stg), W.dim_source(stg), W.dim_time(stg), W.dim_category(stg))
    return _bag(joined), _bag(W.fact_from_staging(stg))


def test_fact_plans_agree_with_fanout(spark):
    stg = W.stg_listings(view(spark, SF_SMALL, "raw_listings"))
    a, b = _both(stg)
    assert a == b
    assert sum(a.values()) > stg.count()      # dirty names fan out


def test_fact_plans_agree_on_nulls(spark):
    rows = [(1, None, 5.0, None, True, "ebay", "TVs", "x", dt.datetime(2024, 1, 1)),
            (2, "p", 5.0, 4.0, True, None, None, None, None),
            (3, "p", 0.0, 4.0, False, "bestbuy", "TVs", "y", dt.datetime(2024, 1, 2)),
            (4, "q", 5.0, None, None, "ebay", "TVs", None, dt.datetime(2024, 1, 2))]
    stg = spark.createDataFrame(rows, "listing_id long, product_name string, price double, sale_price double, "
                                      "on_sale boolean, marketplace_source string, category string, brand string, "
                                      "scraped_at timestamp_ntz")
    a, b = _both(stg)
    assert a == b and sum(a.values()) == 1 + 2 * 2 + 1   # two 'p' rows x brands {None, 'y'}


def test_fact_shuffle_path_equals_broadcast_path(spark):
    stg = W.stg_listings(view(spark, SF_SMALL, "raw_listings"))
    small = _bag(W.fact_from_staging(stg))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _bag(W.fact_from_staging(stg)) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_models_as_sql_views(spark):
    from pricelens.plans.models import register_models

    names = register_models(spark, view(spark, SF_SMALL, "star_listings"), view(spark, SF_SMALL, "matched_products"))
    assert "fact_price_snapshot" in names and "stg_matched" in names
    n = spark.sql("""select count(*) from fact_price_snapshot f join dim_product p on f.product_key = p.product_key
                     join dim_source s on f.source_key = s.source_key""").first()[0]
    assert n == view(spark, SF_SMALL, "star_listings").count()
