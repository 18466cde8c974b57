"""Pair scoring on executors and verdict validation."""

import json

from pricelens.operators import verdicts as V


def _pairs(spark):
    rows = [(1, 2, "Samsung QN65Q80C 65\" TV", "Samsung 65\" QN65Q80C", 900.0, None, "TVs"),
            (3, 4, "Sony WH1000XM5", "Bose QC45", 0.0, 300.0, None)]
    return spark.createDataFrame(rows, "ebay_listing_id long, bestbuy_listing_id long, ebay_title string, "
                                       "bestbuy_title string, ebay_price double, bestbuy_price double, category string")


def test_score_pairs_retries_then_null(spark):
    def flaky(pair):
        if pair["bestbuy_title"].startswith("Bose"):
            raise RuntimeError("always fails")
        return json.dumps({"is_match": True, "confidence": 0.9, "reasoning": "ok"})

    out = {r.ebay_listing_id: r.verdict for r in V.score_pairs(_pairs(spark), flaky).collect()}
    assert out[3] is None and json.loads(out[1])["is_match"] is True
    stats = V.run_stats(V.verdict_outcomes(V.score_pairs(_pairs(spark), flaky))).first()
    assert (stats.pairs_processed, stats.matches_found, stats.non_matches, stats.failed) == (2, 1, 0, 1)


def test_rule_scorer(spark):
    got = {r.ebay_listing_id: r for r in V.rule_verdicts(_pairs(spark)).collect()}
    assert got[1].confidence == 0.95 and got[1].model_number == "QN65Q80C" and got[1].is_match
    assert got[3].confidence == 0.3 and not got[3].is_match


def test_validate_strict_types(spark):
    texts = [(1, '{"is_match": true, "confidence": 0.7, "reasoning": "r", "canonical_name": ""}'),
             (2, '{"is_match": "yes", "confidence": 0.7, "reasoning": "r"}'),
             (3, '{"is_match": true, "confidence": 1.2, "reasoning": "r"}'),
             (4, '{"is_match": false, "confidence": 0, "reasoning": "r", "brand": null}'),
             (5, 'not json'), (6, '{"is_match": true, "confidence": 0.5}')]
    df = spark.createDataFrame(texts, "pair_id long, verdict string")
    valid, rejected = V.validate_verdicts(df)
    v = {r.pair_id: r for r in valid.collect()}
    assert set(v) == {1, 4}
    assert v[1].canonical_name == "Unknown" and v[1].brand == "Unknown" and v[4].confidence == 0.0
    assert sorted(r.pair_id for r in rejected.collect()) == [2, 3, 5, 6]


def test_prompt_text(spark):
    r = V.pair_prompts(_pairs(spark)).orderBy("ebay_listing_id").collect()
    assert "  Price: $900.00\n" in r[0].prompt and r[0].prompt.count("Price:") == 1
    assert "  Category: None\n" in r[1].prompt and r[1].prompt.count("Price:") == 1
    assert r[0].prompt.endswith("Respond with JSON only.")


def test_strict_types_and_trailing_text(spark):
    base = '{"is_match":true,"confidence":0.9,"canonical_name":"N","brand":"B","model_number":"M","reasoning":"r"}'
    shapes = [(base, True), (base + "  ", True), (base.replace('"M"', "null"), True), (base.replace("0.9", "1"), True),
              (base.replace('"r"', "5"), False), (base.replace('"M"', "123"), False), (base.replace('"N"', '{"a":1}'), False),
              (base.replace("true", '"yes"'), False), (base.replace("0.9", '"0.9"'), False), (base + " x", False),
              (base + " " + base, False), (base + "," + base, False), (base + "] [" + base, False), ("[" + base + "]", False), (None, False)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(shapes)], "pair_id long, verdict string")
    valid, rejected = V.validate_verdicts(df)
    assert sorted(r["pair_id"] for r in valid.collect()) == [i for i, (_, ok) in enumerate(shapes) if ok]
    assert valid.count() + rejected.count() == len(shapes)


def test_unparsable_verdict_is_retried(spark):
    def scorer(rec):
        scorer.calls = getattr(scorer, "calls", 0) + 1
        return "not json" if scorer.calls < 3 else '{"is_match":true}'

    pairs = spark.createDataFrame([("a", "b", 1.0, 2.0, "c")], "ebay_title string, bestbuy_title string, ebay_price double, bestbuy_price double, category string")
    assert V.score_pairs(pairs, scorer).first()["verdict"] == '{"is_match":true}'


def test_rounds_retry_by_class_and_keep_dead_letters(spark):
    from pricelens.plans.cases_verdicts import trial_scorer

    titles = ["fives", "sixsix", "sevenns", "eighteig", "nineninen"]  # lengths 5..9: kinds 0..4
    pairs = spark.createDataFrame([(i, 10 + i, t, t, None, 1.0, None) for i, t in enumerate(titles)],
                                  "ebay_listing_id long, bestbuy_listing_id long, ebay_title string, bestbuy_title string, "
                                  "ebay_price double, bestbuy_price double, category string")
    waited = []
    out = V.score_rounds(pairs, trial_scorer, sleep=waited.append)
    got = {r.ebay_listing_id: (r.attempts, r.outcome, r.message) for r in out.collect()}
    assert got == {0: (1, "valid", None), 1: (2, "valid", None), 2: (3, "valid", None), 3: (1, "error", "unknown model"), 4: (3, "invalid", None)}
    assert waited == [15, 30]
    assert sorted(r.ebay_listing_id for r in V.dead_letters(out).collect()) == [3, 4]
    limited = V.score_rounds(pairs, trial_scorer, attempts=2, waits=())
    assert {r.ebay_listing_id: r.outcome for r in limited.collect()}[2] == "rate_limited"


def test_every_round_calls_each_open_pair_once(spark, tmp_path):
    def counted(pair):
        with open(f"{tmp_path}/calls", "a") as f:
            f.write(f"{pair['ebay_title']} {pair['attempt']}\n")
        return "none"

    pairs = spark.createDataFrame([(f"t{i}", "b", None, None, None) for i in range(6)],
                                  "ebay_title string, bestbuy_title string, ebay_price double, bestbuy_price double, category string").repartition(3)
    out = V.score_rounds(pairs, counted)
    assert out.count() == 6 and out.filter("outcome = 'invalid' and attempts = 3").count() == 6
    calls = open(f"{tmp_path}/calls").read().splitlines()
    assert sorted(calls) == sorted(f"t{i} {a}" for i in range(6) for a in (1, 2, 3))
    assert V.score_rounds(pairs.limit(0), counted).count() == 0


def test_token_bucket_spaces_its_calls():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    bucket = V.TokenBucket(2.0, clock=lambda: now[0], sleep=sleep)
    for _ in range(4):
        bucket.take()
    assert slept == [0.5, 0.5, 0.5]
    now[0] += 10
    bucket.take()
    assert len(slept) == 3
    free = V.TokenBucket(None, clock=lambda: now[0], sleep=sleep)
    free.take(), free.take()
    assert len(slept) == 3
