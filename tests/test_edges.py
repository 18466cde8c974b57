"""Empty and one-sided inputs."""

import datetime as dt

from pricelens.operators import match as M
from pricelens.operators import warehouse as W
from pricelens.operators import insights as I

LISTING = ("id long, product_name string, source string, category string, price double, sale_price double, "
           "on_sale boolean, brand string, scraped_at timestamp_ntz")


def test_candidates_one_sided_and_empty(spark):
    only_ebay = spark.createDataFrame([(1, "tv", "ebay", "TVs", 1.0, None, False, "b", None)], LISTING)
    assert M.candidates(only_ebay, None).count() == 0
    empty = spark.createDataFrame([], LISTING)
    ex = spark.createDataFrame([], "ebay_listing_id long, bestbuy_listing_id long")
    assert M.candidates(empty, ex).count() == 0
    assert M.max_exclusions(ex) == 0


def test_star_and_insights_on_empty(spark):
    empty = spark.createDataFrame([], LISTING).withColumnRenamed("id", "listing_id") \
        .withColumnRenamed("source", "marketplace_source")
    assert W.fact_from_staging(empty).count() == 0
    raw = spark.createDataFrame([], LISTING)
    assert I.price_trends(raw).count() == 0
    assert I.price_anomalies(raw, flagged_only=False).count() == 0


def test_other_sources_are_ignored_by_matching(spark):
    rows = [(1, "tv", "bestbuy", "TVs", 1.0, None, False, "b", dt.datetime(2024, 1, 1)),
            (2, "tv", "walmart", "TVs", 1.0, None, False, "b", dt.datetime(2024, 1, 1)),
            (3, "tv", "ebay", "TVs", 1.0, None, False, "b", dt.datetime(2024, 1, 1))]
    got = [(r.bestbuy_listing_id, r.ebay_listing_id) for r in M.candidates(spark.createDataFrame(rows, LISTING)).collect()]
    assert got == [(1, 3)]
