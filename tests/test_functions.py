"""Edge-case tables for the scalar rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.functions import columns as X
from pricelens.functions.similarity import ratio
from pricelens.operators import clean, parse
from pricelens.operators import warehouse as W


def test_brand_suffix(spark):
    rows = [("Samsung Electronics",), ("Apple Inc.",), ("Cisco",), ("Zinc",), ("Electronics",),
            ("A Co. Inc.",), (None,), ("  SONY  ",), ("Foo Electronics Co., Ltd.",)]
    df = spark.createDataFrame(rows, "brand string")
    got = [r[0] for r in clean.normalize_brands(df).collect()]
    assert got == ["samsung", "apple", "cis", "z", "", "a co.", "unknown", "sony", "foo electronics co.,"]


def test_price_buckets(spark):
    df = spark.createDataFrame([(99.99,), (100.0,), (500.0,), (500.01,)], "price double")
    df = df.withColumn("sale_price", F.lit(None).cast("double")).withColumn("on_sale", F.lit(False))
    got = [r.price_bucket for r in clean.add_price_bucket(df).collect()]
    assert got == ["budget", "mid", "mid", "premium"]


def test_bucket_uses_sale_price(spark):
    df = spark.createDataFrame([(150.0, 90.0, True), (150.0, 90.0, False)],
                               "price double, sale_price double, on_sale boolean")
    assert [r.price_bucket for r in clean.add_price_bucket(df).collect()] == ["budget", "mid"]


def test_prices_and_on_sale(spark):
    df = spark.createDataFrame(
        [(1, None, None, True), (2, 0.0, None, False), (3, -1.0, None, False),
         (4, 10.0, 10.0, True), (5, 10.0, 8.0, False), (6, 10.0, 0.0, True), (7, 10.0, 12.0, True)],
        "id int, price double, sale_price double, on_sale boolean")
    got = {r.id: (r.price, r.sale_price, r.on_sale) for r in clean.normalize_prices(df).collect()}
    assert set(got) == {4, 5, 6, 7}
    assert got[4] == (10.0, 10.0, False)       # equal sale price is not a sale in the clean job
    assert got[5] == (10.0, 8.0, True)
    assert got[6] == (10.0, None, False)
    assert got[7] == (10.0, 12.0, False)


def test_discount_pct(spark):
    df = spark.createDataFrame([(100.0, 120.0), (10.0, 10.0), (10.0, None), (0.0, 5.0), (3.0, 1.0)],
                               "price double, sale_price double")
    got = [r[0] for r in df.select(X.discount_pct()).collect()]
    assert got == [-20.0, 0.0, 0.0, 0.0, 66.67]


def test_fact_keeps_raw_on_sale(spark):
    rows = [(1, "p", 10.0, 10.0, True, "ebay", None, "TVs", "b", "s", dt.datetime(2024, 1, 1))]
    raw = spark.createDataFrame(rows, "id long, product_name string, price double, sale_price double, "
                                      "on_sale boolean, source string, url string, category string, brand string, "
                                      "sku string, scraped_at timestamp_ntz")
    fact = W.build_star(raw)["fact_price_snapshot"].first()
    assert fact.was_on_sale is True and fact.discount_pct == 0.0 and fact.in_stock is True


@pytest.mark.parametrize("day,week,dow", [
    (dt.datetime(2023, 1, 1), 1, 1), (dt.datetime(2024, 1, 1), 0, 2), (dt.datetime(2026, 3, 18), 11, 4),
    (dt.datetime(2022, 12, 31, 23, 59), 52, 7)])
def test_dim_time_parts(spark, day, week, dow):
    df = spark.createDataFrame([(day,)], "scraped_at timestamp_ntz")
    r = W.dim_time(df).first()
    assert (r.week_number, r.day_of_week) == (week, dow)
    assert r.is_weekend == (dow in (1, 7))


def test_week_matches_python_U(spark):
    days = [dt.datetime(1990, 1, 1) + dt.timedelta(days=i) for i in range(0, 15000, 7)]
    days += [dt.datetime(2000 + y, 1, d) for y in range(20) for d in range(1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "scraped_at timestamp_ntz")
    got = {r.scraped_at: r.week_number for r in W.dim_time(df).collect()}
    for d in days:
        assert got[d] == int(d.strftime("%U")), d


def test_dim_time_null(spark):
    df = spark.createDataFrame([(None,)], "scraped_at timestamp_ntz")
    r = W.dim_time(df).first()
    assert r.time_key is not None and r.is_weekend is False and r.hour is None


def test_surrogate_key_matches_dbt_convention(spark):
    import hashlib

    df = spark.createDataFrame([("TVs", 5), (None, 7)], "c string, n long")
    got = [r[0] for r in df.select(X.surrogate_key("c", "n")).collect()]
    assert got[0] == hashlib.md5(b"TVs-5").hexdigest()
    assert got[1] == hashlib.md5(b"_dbt_utils_surrogate_key_null_-7").hexdigest()


def test_similarity_goldens():
    assert ratio("tide", "diet") == 0.25
    assert ratio("diet", "tide") == 0.5
    assert ratio("", "") == 1.0
    assert ratio("ABC", "abc") == 1.0


def test_similarity_udf_equals_python(spark):
    from pricelens.functions.similarity import difflib_similarity, length_bound

    pairs = [("tide", "diet"), ("diet", "tide"), ("", ""), ("Samsung QN65", "samsung qn65q80c"),
             ("a" * 250, "ab" * 130), (None, "x")]
    df = spark.createDataFrame(pairs, "a string, b string")
    out = df.select("a", "b", difflib_similarity(F.col("a"), F.col("b")).alias("s"),
                    length_bound(F.char_length("a"), F.char_length("b")).alias("ub")).collect()
    for r in out:
        if r.a is None:
            assert r.s is None
            continue
        assert r.s == ratio(r.a, r.b)
        assert r.s <= r.ub + 1e-12


@pytest.mark.parametrize("item,expected", [
    ('{"price":{"value":"80"},"marketingPrice":{"originalPrice":{"value":"100"}}}', (100.0, 80.0, True)),
    ('{"price":{"value":"80"},"marketingPrice":{"originalPrice":{"value":"0"}}}', (80.0, None, False)),
    ('{"price":{"value":"80"}}', (80.0, None, False)),
    ('{"price":{"value":"80"},"marketingPrice":{}}', (80.0, None, False)),
    ('{"title":"x"}', (0.0, None, False)),
    ('{"marketingPrice":{"originalPrice":{"value":"100"}}}', (100.0, 0.0, True)),
    ('{"price":{"value":"120"},"marketingPrice":{"originalPrice":{"value":"100"}}}', (100.0, None, False)),
])
def test_item_prices(spark, item, expected):
    df = spark.createDataFrame([(1, item, "TVs")], "id long, item string, category string")
    r = parse.parse_items(df).first()
    assert (r.price, r.sale_price, r.on_sale) == expected
    assert r.source == "ebay" and r.raw_payload == item


def test_item_missing_fields(spark):
    df = spark.createDataFrame([(1, "{}", "TVs")], "id long, item string, category string")
    r = parse.parse_items(df).first()
    assert (r.product_name, r.url, r.sku, r.brand) == ("", "", "", "Unknown")


@pytest.mark.parametrize("title,brand", [
    ("Algorithm book", "LG"), ("iPad case", "iPad"), ("", "Unknown"), ("   ", "Unknown"),
    ("new samsung tv", "Samsung"), ("Sony and LG bundle", "LG"), ("  zed thing", "zed")])
def test_brand_from_title(spark, title, brand):
    df = spark.createDataFrame([(title,)], "title string")
    assert df.select(parse.extract_brand(F.col("title"))).first()[0] == brand


def test_category_map(spark):
    df = spark.createDataFrame([("Televisions",), ("iPad",), ("Cameras",), (None,), ("tvs",)], "category string")
    got = [r[0] for r in clean.standardize_categories(df).collect()]
    assert got == ["TVs", "Tablets", "Cameras", None, "tvs"]


def test_dedup_tie_break_and_null_times(spark):
    rows = [(1, "p", 10.0, "ebay", dt.datetime(2024, 1, 1)), (2, "p", 10.0, "ebay", dt.datetime(2024, 1, 1)),
            (3, "q", 5.0, "ebay", None), (4, "q", 5.0, "ebay", dt.datetime(2020, 1, 1)),
            (5, "r", None, "ebay", None), (6, "r", None, "ebay", dt.datetime(2021, 1, 1))]
    df = spark.createDataFrame(rows, "id long, product_name string, price double, source string, "
                                     "scraped_at timestamp_ntz")
    got = sorted(r.id for r in clean.dedup_listings(df).collect())
    assert got == [2, 4, 6]
    again = sorted(r.id for r in clean.dedup_listings(clean.dedup_listings(df)).collect())
    assert again == got


def test_two_decimals_round_the_exact_value(spark):
    import random
    import struct

    from pricelens.functions.columns import price_line, two_decimals

    rnd = random.Random(9)
    values = [0.125, 0.375, 0.625, 0.875, 2.675, 1.005, 1.115, 1.015, 0.0, 0.004, 0.005, 0.995, 0.999, 9.995, 1e-9, -0.001, -0.125, -12.345, 499.99,
              float(2 ** 43) + 0.25, 123456789012.125, 1e15, 5e-324]
    values += [round(rnd.uniform(0, 5000), rnd.randrange(1, 6)) for _ in range(3000)] + [k / 8 for k in range(400)] + [k / 1000 for k in range(5, 9000, 10)]
    values += [abs(struct.unpack("<d", struct.pack("<q", rnd.getrandbits(62)))[0]) for _ in range(300)]
    values = [v for v in values if v < 1e300]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", two_decimals("x").alias("t"), price_line("x").alias("p")).collect()
    small = [r for r in rows if abs(r.x) < 2 ** 43]
    assert [r.t for r in small] == ["%.2f" % r.x for r in small] and len(small) > 4000
    assert {r.p for r in rows if r.x == 0.125} == {"  Price: $0.12\n"} and {r.p for r in rows if r.x == 0} == {""}
