"""Isolation forest: planted drops, and a plain scorer over the same trees."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

from pricelens.fixture import view
from pricelens.operators import isolation as IF


def plain_score(forest: IF.Forest, x) -> float:
    total = 0.0
    for node in forest.roots:
        while forest.feature[node] >= 0:
            node = forest.left[node] if x[forest.feature[node]] < forest.threshold[node] else forest.right[node]
        total += forest.path[node]
    return 2.0 ** (-total / (len(forest.roots) * forest.unit))


def test_native_scores_equal_a_plain_walk(spark):
    rng = np.random.default_rng(5)
    rows = [tuple(map(float, r)) for r in rng.normal(size=(300, 2))] + [(9.0, 9.0), (0.0, 0.0), (float("inf"), -3.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    forest = IF.grow([np.array(rows[i * 30:(i + 1) * 30]) for i in range(10)], ("a", "b"))
    for r in df.withColumn("s", IF.isolation_score(forest)).collect():
        assert r.s == pytest.approx(plain_score(forest, (r.a, r.b)))


def test_splits_leave_no_side_empty():
    rows = np.array([[1.0, 2.0], [1.0, 2.0], [1.0, np.nextafter(2.0, 3.0)], [1.0, 2.0]])
    forest = IF.grow([rows] * 20, ("a", "b"))
    assert all(forest.feature[r] == 1 for r in forest.roots)
    assert len(forest.feature) == 60  # one split and two leaves each; equal rows are not split again


def test_planted_price_drops_score_highest(spark):
    rnd = random.Random(2)
    rows, planted = [], set()
    for p in range(12):
        for day in range(60):
            for k in range(2):
                i = len(rows)
                price = 100.0 * (p + 1) * rnd.uniform(0.97, 1.03)
                if day > 30 and rnd.random() < 0.004:
                    price, planted = price * 0.35, planted | {i}
                rows.append((i, f"item {p}", "ebay", round(price, 2), None, False, dt.datetime(2024, 1, 1, k) + dt.timedelta(days=day)))
    df = spark.createDataFrame(rows, "id long, product_name string, source string, price double, sale_price double, on_sale boolean, scraped_at timestamp_ntz")
    got = IF.price_isolation(df).collect()
    assert len(got) == len(rows) and len(planted) >= 3
    top = sorted(got, key=lambda r: -r.isolation_score)[:3 * len(planted)]
    assert planted <= {r.id for r in top}
    assert IF.price_isolation(df.limit(0)).count() == 0


def test_plan_is_native(spark):
    rows = view(spark, SF_SMALL, "raw_listings")
    out = IF.price_isolation(rows, trees=8, sample=64)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    s = out.agg(F.min("isolation_score"), F.max("isolation_score"), F.count("isolation_score")).first()
    assert 0 < s[0] < s[1] <= 1 and s[2] == rows.count()


def test_score_walks_compiled_conditions(spark):
    """One comparison per level and tree, compiled; a walk over constant arrays by nested lambdas took 14 times as long."""
    rng = np.random.default_rng(9)
    rows = [tuple(map(float, r)) for r in rng.normal(size=(400, 2))] + [(None, 1.0), (float("nan"), 0.0), (1e-320, -1e300)]
    df = spark.createDataFrame(rows, "a double, b double")
    forest = IF.grow([np.array(rows[i * 40:(i + 1) * 40]) for i in range(10)], ("a", "b"))
    out = df.withColumn("s", IF.isolation_score(forest))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" not in plan
    for r in out.collect():
        if r.a is None:
            assert r.s is None
        elif r.a == r.a:
            assert r.s == pytest.approx(plain_score(forest, (r.a, r.b)))
        else:  # NaN is above all numbers
            assert r.s == pytest.approx(plain_score(forest, (float("inf"), r.b)))
