"""Plan-shape assertions: the properties the scale design relies on."""

import __spark_entry__ as E

from tests.conftest import SF_SMALL

Q = E.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dedup_limits_before_shuffle(spark):
    p = plan(Q["dedup_listings"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_clean_chain_has_no_python(spark):
    p = plan(Q["clean_contract"](spark, SF_SMALL))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_scan_prunes_columns(spark):
    df = Q["source_counts"](spark, SF_SMALL)
    p = plan(df)
    assert "ReadSchema: struct<l_suppkey:bigint>" in p or "l_extendedprice" not in p


def test_history_filter_reaches_scan(spark):
    p = plan(Q["price_history_30d"](spark, SF_SMALL))
    assert "PushedFilters" in p and "l_shipdate" in p.split("PushedFilters")[1][:300]


def test_not_null_checks_are_one_scan(spark):
    from pricelens.fixture import view
    from pricelens.operators import quality

    raw = view(spark, SF_SMALL, "raw_listings")
    p = plan(quality.check_not_null(raw, ["id", "price", "source"], "raw"))
    assert sum("FileScan parquet" in line and "lineitem" in line for line in p.split("\n")) == 1


def test_json_parsed_once(spark):
    o = optimized(Q["parse_marketplace_items"](spark, SF_SMALL))
    assert o.count("from_json") == 1


def test_clean_job_scans_each_input_once(spark):
    p = plan(Q["clean_contract"](spark, SF_SMALL))
    scans = [l for l in p.split("\n") if "FileScan parquet" in l]
    assert sum("lineitem.parquet" in l for l in scans) == 1
    assert sum("part.parquet" in l for l in scans) == 1


def test_fact_does_not_shuffle_listings(spark):
    p = plan(Q["fact_price_snapshot"](spark, SF_SMALL))
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p
