"""Candidate matching equals a plain-Python nested loop (the reference
behaviour: per retailer listing, every marketplace listing of the same
category, difflib ratio >= 0.25, skip stored pairs, stable top 5)."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

from pricelens.fixture import view
from pricelens.functions import similarity as SIM
from pricelens.operators import match as M
from pricelens.operators import simjoin as SJ


def brute(listings, existing, k=5, min_sim=0.25):
    by_cat = {}
    for r in sorted(listings, key=lambda r: r["id"]):
        if r["source"] in ("ebay", "bestbuy"):
            by_cat.setdefault(r["category"], {"ebay": [], "bestbuy": []})[r["source"]].append(r)
    out = {}
    for cat, src in by_cat.items():
        for b in src["bestbuy"]:
            scored = []
            for e in src["ebay"]:
                if (e["id"], b["id"]) in existing:
                    continue
                s = SequenceMatcher(None, b["product_name"].lower(), e["product_name"].lower()).ratio()
                if s >= min_sim:
                    scored.append((s, e["id"]))
            scored.sort(key=lambda x: -x[0])          # stable: id order on ties
            for rank, (s, eid) in enumerate(scored[:k], 1):
                out[(b["id"], eid)] = (rank, s)
    return out


@pytest.fixture(scope="module")
def small(spark):
    raw = view(spark, SF_SMALL, "raw_listings")
    # Shorter names and a NULL category group to exercise ties and T14.
    raw = raw.withColumn("product_name", F.when(F.col("id") % 13 == 0, F.lit("")).otherwise(F.col("product_name")))
    rows = [r.asDict() for r in raw.select("id", "product_name", "source", "category", "price").collect()]
    return raw, rows


def _spark_result(df):
    return {(r.bestbuy_listing_id, r.ebay_listing_id): (r.rank, r.similarity) for r in df.collect()}


def _check(got, want):
    assert set(got) == set(want)
    for key, (rank, s) in want.items():
        assert got[key][0] == rank
        assert abs(got[key][1] - s) < 1e-12


def test_candidates_no_exclusions(spark, small):
    raw, rows = small
    _check(_spark_result(M.candidates(raw, None)), brute(rows, set()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_candidates_random_exclusions(spark, small, seed):
    raw, rows = small
    full = brute(rows, set(), k=12)
    rnd = random.Random(seed)
    excluded = {(e, b) for (b, e) in full if rnd.random() < 0.35}
    ex = spark.createDataFrame(sorted(excluded), "ebay_listing_id long, bestbuy_listing_id long")
    _check(_spark_result(M.candidates(raw, ex)), brute(rows, excluded))


def test_null_categories_match_each_other(spark):
    rows = [(1, "tv a", "bestbuy", None, 10.0), (2, "tv a", "ebay", None, 0.0), (3, "tv a", "ebay", "TVs", 5.0)]
    df = spark.createDataFrame(rows, "id long, product_name string, source string, category string, price double")
    got = M.candidates(df, None).collect()
    assert [(r.bestbuy_listing_id, r.ebay_listing_id, r.category) for r in got] == [(1, 2, None)]
    assert got[0].ebay_price is None   # zero price -> NULL


def test_cap_order(spark, small):
    raw, rows = small
    capped = M.cap_pairs(M.candidates(raw, None), 7).collect()
    assert len(capped) == 7
    keys = [((r.category is None, r.category or ""), r.bestbuy_listing_id, r.rank) for r in capped]
    assert keys == sorted(keys)


def test_name_pairs_cover_all_qualifying(spark, small):
    raw, rows = small
    got = {(r.category, r.bestbuy_name, r.ebay_name) for r in M.name_pairs(raw, grid=3).collect()}
    bn = {(r["category"], r["product_name"]) for r in rows if r["source"] == "bestbuy"}
    en = {(r["category"], r["product_name"]) for r in rows if r["source"] == "ebay"}
    for c, b in bn:
        for c2, e in en:
            if c != c2:
                continue
            la, lb = len(b.lower()), len(e.lower())
            bound = 1.0 if la + lb == 0 else 2 * min(la, lb) / (la + lb)
            assert ((c, b, e) in got) == (bound >= 0.25)


def test_shuffle_expansion_equals_broadcast(spark, small):
    raw, rows = small
    ex = spark.createDataFrame([(0, 0)], "ebay_listing_id long, bestbuy_listing_id long")
    a = _spark_result(M.candidates(raw, ex))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = _spark_result(M.candidates(raw, ex))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert a == b


def test_adaptive_grid_equals_single_cell(spark, small):
    raw, rows = small
    one = {tuple(r) for r in M.name_pairs(raw, grid=1).collect()}
    many = {tuple(r) for r in M.name_pairs(raw, pairs_per_cell=7).collect()}   # forces g > 1
    assert one == many and len(one) > 0


def _names(rows, source):
    return {(r["category"], r["product_name"]) for r in rows if r["source"] == source}


def test_letter_bound_is_never_below_either_score(spark):
    rnd = random.Random(4)
    names = ["", "a", "İstanbul", "ΑΣ", "日本 tv", "aab" * 80] + ["".join(rnd.choice("abcd é1 ") for _ in range(rnd.randrange(1, 25))) for _ in range(60)]
    df = SJ.with_letters(spark.createDataFrame([(n,) for n in names], "name string"))
    side = lambda s: df.select(*[F.col(c).alias(f"{s}_{c}") for c in df.columns])
    pairs = side("l").join(side("r"), F.lit(True)).select(
        "l_name", "r_name", SJ.letter_bound("l", "r").alias("exact"), SJ.sketch_bound("l", "r").alias("sketch"),
        SIM.difflib_similarity(F.col("l_name"), F.col("r_name")).alias("difflib"), SIM.edit_similarity(F.col("l_name"), F.col("r_name")).alias("edit"))
    for r in pairs.collect():
        sm = SequenceMatcher(None, r.l_name.lower(), r.r_name.lower(), autojunk=False)
        assert r.exact == pytest.approx(sm.quick_ratio()) and r.sketch >= r.exact >= r.difflib - 1e-12 and r.exact >= r.edit - 1e-12


def test_pruned_search_scores_few_pairs_and_loses_none(spark):
    rnd = random.Random(6)
    words = ["small", "red", "old", "ring", "bolt", "gear", "widget", "gizmo"]
    rows = [(i, f"{rnd.choice(words)} {rnd.choice(words)} {rnd.randrange(400)}", "bestbuy" if i % 2 else "ebay", rnd.choice(["x", "x", None]), 1.0)
            for i in range(900)]
    rows += [(1000 + i, rows[i][1], rows[i][2], rows[i][3], 2.0) for i in range(0, 400, 3)]
    df = spark.createDataFrame(rows, "id long, product_name string, source string, category string, price double")
    dicts = [r.asDict() for r in df.collect()]
    _check(_spark_result(M.candidates(df, None)), brute(dicts, set()))
    _check(_spark_result(M.candidates(df, None, grid=3)), brute(dicts, set()))
    found = M.search_names(df, 5)
    assert found.pairs_scored < 0.6 * found.pairs_formed


def test_ten_runs_read_the_same_depth(spark, monkeypatch):
    """Every run stores its pairs; the next reads behind them, K stays 5."""
    rnd = random.Random(8)
    rows = [(i, rnd.choice(["tv a", "tv b", "radio"]), "bestbuy" if i % 9 == 0 else "ebay", "c", 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, product_name string, source string, category string, price double")
    dicts = [r.asDict() for r in df.collect()]
    depths, real = [], M.search_names
    monkeypatch.setattr(M, "search_names", lambda listings, k, *a: (depths.append(k), real(listings, k, *a))[1])
    excluded = set()
    for _ in range(10):
        ex = spark.createDataFrame(sorted(excluded), "ebay_listing_id long, bestbuy_listing_id long")
        got = _spark_result(M.candidates(df, ex))
        _check(got, brute(dicts, excluded))
        excluded |= {(e, b) for b, e in got}
    assert depths == [5] * 10


def test_frontier_with_gaps(spark):
    rows = [(i, "tv", "bestbuy" if i < 3 else "ebay", None, 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, product_name string, source string, category string, price double")
    dicts = [r.asDict() for r in df.collect()]
    everyone = {(e, b) for b in range(3) for e in (3, 4, 6, 9, 10, 30)}
    for excluded in (everyone, everyone | {(5, 0), (7, 1), (8, 1), (11, 2), (999, 0)}):
        ex = spark.createDataFrame(sorted(excluded), "ebay_listing_id long, bestbuy_listing_id long")
        _check(_spark_result(M.candidates(df, ex)), brute(dicts, excluded))


@pytest.mark.parametrize("cap", [1, 7, 60, 100_000])
def test_capped_search_equals_the_cap_of_all(spark, cap):
    """Listings without candidates first: the search must go on until the cap is full."""
    rows = [(i, "zzzz", "bestbuy", "a", 1.0) for i in range(20)] + [(100 + i, f"tv {i % 5}", "bestbuy" if i % 2 else "ebay", "b" if i % 3 else None, 1.0)
                                                                    for i in range(60)] + [(500, "q", "ebay", "a", 1.0)]
    df = spark.createDataFrame(rows, "id long, product_name string, source string, category string, price double")
    ex = spark.createDataFrame([(100, 103)], "ebay_listing_id long, bestbuy_listing_id long")
    want = M.cap_pairs(M.candidates(df, ex), cap).collect()
    assert M.candidates(df, ex, max_pairs=cap).collect() == want and len(want) > 0


def test_pairs_are_scored_by_few_tasks_and_only_the_best_go_on(spark):
    """Tasks by the number of pairs alone outgrow the driver, and all pairs outgrow the disk."""
    assert M._score_tasks(spark, 10**9) <= 1000
    words = ["small ring", "red bolt", "old gear"]
    rows = [(i, f"{words[i % 3]} {1000 + i // 2}", "bestbuy" if i % 2 else "ebay", None, 1.0) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, product_name string, source string, category string, price double")
    found = M.search_names(df, 5, scorer=SIM.edit_similarity)
    assert found.scored.groupBy("block", "l_name").count().agg(F.max("count")).first()[0] <= 5
    assert found.pairs_scored < 0.6 * found.pairs_formed


def test_equal_names_are_close_and_best_entries_stay(spark):
    """More equal names and ties than are kept; ids that are null or repeat across names."""
    rows = [(i, f"tv {i % 40}", "bestbuy" if i % 7 == 0 else "ebay", None, 1.0) for i in range(400)]
    rows += [(1000 + i % 3, f"radio {i}", "ebay", "c", 1.0) for i in range(30)] + [(None, "radio 77", "ebay", "c", 1.0), (2000, "radio 7", "bestbuy", "c", 1.0)]
    df = spark.createDataFrame(rows, "id long, product_name string, source string, category string, price double")
    left, right, _ = M._search_sides(df, None)
    pairs = {(r.l_name, r.r_name) for r in SJ.close_pairs(left, right, seeds=2).where("block = ''").collect()}
    assert {n for n in (f"tv {i}" for i in range(40))} <= {a for a, b in pairs if a == b}
    got = M.candidates(df.where("category is null"), None)
    _check(_spark_result(got), brute([r.asDict() for r in df.where("category is null").collect()], set()))
    top = M.candidates(df.where("category = 'c'"), None).orderBy("rank").collect()
    assert [(r.rank, r.ebay_name) for r in top][0] == (1, "radio 7") and len(top) == 5
    assert top[1].ebay_listing_id is None
