"""The edit-score search equals a plain-Python nested loop, and its work follows the close names."""

import random

import pytest
from pyspark.sql import functions as F

from pricelens.functions.similarity import edit_similarity
from pricelens.operators import editjoin as E
from pricelens.operators import match as M
from pricelens.session import materialize, shuffles_dropped

SCHEMA = "id long, product_name string, source string, category string, price double"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def score(a, b):
    a, b = a.lower(), b.lower()
    return 1.0 - edits(a, b) / max(len(a), len(b)) if a or b else 1.0


def brute(rows, k=5, min_sim=0.25):
    out, known = set(), {}
    for b in rows:
        if b[2] != "bestbuy" or b[1] is None:
            continue
        if (b[1], b[3]) not in known:
            found = [(score(b[1], e[1]), e) for e in rows if e[2] == "ebay" and e[1] is not None and e[3] == b[3]]
            known[b[1], b[3]] = sorted((-s, e[0]) for s, e in found if s >= min_sim)[:k]
        out |= {(b[0], eid, -s, rank) for rank, (s, eid) in enumerate(known[b[1], b[3]], 1)}
    return out


def found(df):
    rows = [(r.bestbuy_listing_id, r.ebay_listing_id, r.similarity, r.rank) for r in M.candidates(df, None, scorer=edit_similarity).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def listings(n, seed):
    """Numbered names, several listings of some, names in two cases, short, long, empty and null ones."""
    rnd = random.Random(seed)
    words = ["red bolt", "Red Bolt", "old gear", "cold gear", "tv", "é", "a very long product name of many words"]
    names = [f"{rnd.choice(words)} {rnd.randrange(900)}" for _ in range(n)] + ["", "a", "b", "ab", "A", "x" * 29, "x" * 30, "x" * 31, "x" * 33, "y" * 60, None]
    return [(10 * i + j, name, rnd.choice(["ebay", "bestbuy"]), rnd.choice(["c", None, None]), 1.0)
            for i, name in enumerate(names) for j in range(rnd.choice([1, 1, 2, 9]))]


@pytest.mark.parametrize(("most", "per_pass"), [(1, 10**9), (2, 2_000)])
def test_near_pairs_are_all_pairs_that_near(spark, monkeypatch, most, per_pass):
    monkeypatch.setattr(E, "KEYS_PER_PASS", per_pass)
    rnd = random.Random(3)
    names = sorted({"".join(rnd.choice("ab1é日") for _ in range(rnd.randrange(0, 8))) for _ in range(150)})
    rows = [(i * 1000, i % 2, n, i % 3 > 0, i % 3 != 1, len(n)) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "nid long, seed long, name string, is_left boolean, is_right boolean, len int")
    keys = int(df.agg(F.sum(E.key_count(F.col("len"), most))).first()[0])
    got = {(r.l, r.r): r.similarity for r in E.near_pairs(df, most, keys, 0.0, 1000, 3, materialize).collect()}
    want = {(a[0], b[0]): score(a[2], b[2]) for a in rows for b in rows if a[3] and b[4] and a[1] == b[1] and edits(a[2], b[2]) <= most}
    assert got == want and len(want) > 50


def test_search_by_edits_equals_brute_force(spark):
    rows = listings(150, 1)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_names_left_open_go_to_the_search_by_letters(spark, monkeypatch):
    """Few open names against many: cells in rows and columns of other numbers."""
    monkeypatch.setattr(M.C, "PLAIN_PAIRS_PER_NAME", 0)
    monkeypatch.setattr(M.C, "PAIRS_PER_CELL", 50)
    rows = listings(120, 5)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_keys_that_met_by_chance_change_nothing(spark, monkeypatch):
    rows = listings(80, 7)
    df = spark.createDataFrame(rows, SCHEMA)
    real = E.near_pairs

    def with_false_ones(names, edits, keys, min_sim, best, *rest):
        pairs = real(names, edits, keys, min_sim, best, *rest)
        false = names.filter("is_left").selectExpr("nid as l").crossJoin(names.filter("is_right").orderBy("nid").limit(4).selectExpr("nid as r"))
        by_l = M.Window.partitionBy("l").orderBy(F.col("similarity").desc(), "r")
        both = pairs.unionByName(false.withColumn("similarity", F.lit(0.99))).groupBy("l", "r").agg(F.max("similarity").alias("similarity"))
        return both.withColumn("_r", F.row_number().over(by_l)).filter(F.col("_r") <= best).drop("_r")

    monkeypatch.setattr(E, "near_pairs", with_false_ones)
    assert found(df) == brute(rows)


def test_pairs_scored_follow_the_names_not_their_pairs(spark):
    """All pairs of a block formed, and copied once per row and column of cells, outgrow the disk."""
    words = ["small ring", "red bolt", "old gear"]
    rows = [(i, f"{words[i % 3]} {1000 + i // 2}", "bestbuy" if i % 2 else "ebay", None, 1.0) for i in range(3000)]
    done = M.search_names(spark.createDataFrame(rows, SCHEMA), 5, scorer=edit_similarity)
    assert done.pairs_formed == 1500 * 1500
    assert done.pairs_scored < 20 * 1500


def test_shuffle_files_go_with_the_write(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with pytest.raises(ValueError, match="stop"), shuffles_dropped(spark):
        assert spark.conf.get(key) == "true"
        raise ValueError("stop")
    assert spark.conf.get(key) == before
