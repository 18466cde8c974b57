"""Isolation forest over price features (our model: the behaviour being reproduced only announces one).

Trees are grown on the driver from a bounded sample (TREES * SAMPLE rows of
a few numbers, drawn by a hash), so the fit does not grow with the table.
Every row is scored by column expressions: each tree is a nest of
conditions, no Python in the plan. The score is the usual
2 ** (-mean path length / c(SAMPLE)): near 1 for rows that few cuts single out,
about 0.5 and less for ordinary ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.operators.insights import daily_prices, with_baseline
from pricelens.session import materialize

TREES = 48
SAMPLE = 256
FEATURES = ("price_ratio", "discount_share", "step_ratio")


@dataclass(frozen=True)
class Forest:
    """All trees in one node list: a split (feature, threshold, left, right) or a leaf (feature -1, path length)."""

    columns: tuple[str, ...]
    roots: tuple[int, ...]
    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    path: tuple[float, ...]
    depth: int
    unit: float


def average_path(n: int) -> float:
    """Mean path of an unsuccessful search among n rows: what a leaf of n rows still hides."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow(samples: list[np.ndarray], columns: tuple[str, ...], seed: int = 42) -> Forest:
    """One tree per sample (rows x features)."""
    rng = np.random.default_rng(seed)
    size = max((len(s) for s in samples), default=0)
    limit = int(np.ceil(np.log2(max(2, size))))
    roots, nodes = [], []

    def add(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append((-1, 0.0, -1, -1, float(depth + average_path(len(rows)))))
        spread = np.flatnonzero(np.ptp(rows, axis=0) > 0) if len(rows) > 1 and depth < limit else []
        if len(spread):
            f = int(rng.choice(spread))
            low, high = rows[:, f].min(), rows[:, f].max()
            cut = float(min(max(rng.uniform(low, high), np.nextafter(low, high)), high))
            below = rows[:, f] < cut
            left, right = add(rows[below], depth + 1), add(rows[~below], depth + 1)
            nodes[at] = (f, cut, left, right, 0.0)
        return at

    for rows in samples:
        roots.append(add(rows, 0))
    parts = list(zip(*nodes, strict=True)) if nodes else [()] * 5
    return Forest(columns, tuple(roots), *parts, depth=limit, unit=float(average_path(size)))


def fit(df: DataFrame, columns: tuple[str, ...] = FEATURES, trees: int = TREES, sample: int = SAMPLE, seed: int = 42) -> Forest:
    """A forest for the rows of `df` (a written table) without NULL in `columns`."""
    draw = F.xxhash64(*columns, F.monotonically_increasing_id(), F.lit(seed))
    some = df.select(*columns).dropna().withColumn("_draw", draw).orderBy("_draw").limit(trees * sample)
    rows = np.array([r[:-1] for r in some.toLocalIterator()], dtype=np.float64).reshape(-1, len(columns))  # trees * sample rows at most
    each = max(1, min(sample, len(rows) // trees)) if len(rows) else 0
    return grow([rows[i * each:(i + 1) * each] for i in range(trees)] if each else [], columns, seed)


def _tree_sql(forest: Forest, node: int) -> str:
    """Path length of a row in the tree below `node`, as nested conditions."""
    if forest.feature[node] < 0:
        return f"{forest.path[node]!r}D"
    x = f"`{forest.columns[forest.feature[node]].replace('`', '``')}`"
    return (f"if(double({x}) < double('{forest.threshold[node]!r}'), {_tree_sql(forest, forest.left[node])}, "
            f"{_tree_sql(forest, forest.right[node])})")


def isolation_score(forest: Forest) -> Column:
    """Score of a row, 0 to 1; NULL where a feature is NULL or the forest is empty.

    A walk takes one comparison per level. The test for NULLs is a higher-order function, which
    keeps the projection out of whole-stage code: there Spark compiles every subtree as a method of its own."""
    if not forest.roots or forest.unit == 0:
        return F.lit(None).cast("double")
    total = F.expr(" + ".join(_tree_sql(forest, root) for root in forest.roots))
    known = ~F.exists(F.array(*[F.col(c).cast("double") for c in forest.columns]), lambda v: v.isNull())
    return F.when(known, F.pow(F.lit(2.0), -total / (len(forest.roots) * forest.unit)))


def price_features(df: DataFrame) -> DataFrame:
    """Every snapshot with its price against the trailing mean of its product and
    source, its discount, and its price against the daily average before it;
    1 and 0 where there is nothing to compare with."""
    base = with_baseline(df)
    before = daily_prices(df).select("product_name", "source", "day", "avg_price")
    w = Window.partitionBy("product_name", "source").orderBy("day")
    before = before.select("product_name", "source", "day", F.lag("avg_price").over(w).alias("prev_price"))
    ratio = lambda a, b: F.coalesce(F.when(b > 0, a / b), F.lit(1.0))
    eff = F.col("effective_price")
    return (base.join(before, ["product_name", "source", "day"], "left")
            .select("id", "product_name", "source", "scraped_at", "effective_price",
                    ratio(eff, F.col("baseline_mean")).alias("price_ratio"),
                    F.coalesce(F.when(F.col("price") > 0, 1.0 - eff / F.col("price")), F.lit(0.0)).alias("discount_share"),
                    ratio(eff, F.col("prev_price")).alias("step_ratio")))


def price_isolation(df: DataFrame, trees: int = TREES, sample: int = SAMPLE, seed: int = 42) -> DataFrame:
    """Every snapshot with its features and `isolation_score`."""
    rows, _ = materialize(price_features(df), "price_features")
    return rows.withColumn("isolation_score", isolation_score(fit(rows, FEATURES, trees, sample, seed)))
