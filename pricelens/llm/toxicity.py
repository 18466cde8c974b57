"""Toxicity scores by non-negative positive-unlabelled learning.

Only confirmed toxic examples carry a label; the rest of the training text is
unlabelled. A linear classifier on word features is fitted in numpy to the
class-prior-corrected risk

    prior * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - prior * E_pos[loss(-f)])

with the logistic loss, so that f estimates the log-odds of being toxic. When
the bracket, the risk on negatives, turns negative in a step, that step goes
back along its gradient instead (the non-negative correction), which keeps the
classifier from explaining unlabelled examples one by one.

Features are whole words and word beginnings of 4 to 6 letters. Which ones are
used is found in the training sample: beginnings and words that are clearly
more frequent in the positives than in the unlabelled text. The sample is
bounded: POSITIVES confirmed examples and UNLABELLED texts, drawn by a hash.
Scoring finds the features with one automaton over each whole text.

Defined results: a null or empty text has no features and gets the score of the
intercept; without positive examples the score is 0 everywhere; where no
feature tells positives from the rest, it is the prior; occurrences
of a feature beyond the third add nothing; result columns replace columns
of the same names; labels, languages and sources are never read by `score`.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm.common import map_arrow, written

# The bound of the training sample.
POSITIVES = 3000
UNLABELLED = 6000
# Features at most, and how much more frequent they are in positives: LIFT times, or half-way to 1 / prior, the most
# that a feature can reach against unlabelled texts that hold their share of positives.
FEATURES = 2048
LIFT = 3.0
# The prior is kept this far from 0 and 1, where its log-odds end.
PRIOR_EDGE = 1e-4
PREFIXES = (4, 5, 6)
# Occurrences that are told apart: one, two, three or more.
LEVELS = 3
STEPS = 400


@dataclass(frozen=True)
class Toxicity:
    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float


def words(text: Column) -> Column:
    """Lower-case letter runs, one blank around each; a blank for null."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " "), F.lit(" "))


def _draw(rows: DataFrame, most: int, id_col: str, text_col: str) -> DataFrame:
    """About `most` rows at most, chosen by a hash of the id and text."""
    n = rows.count()
    share = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col), F.lit("draw")), F.lit(1 << 30)) / (1 << 30)
    return rows.where(share < (most / n if n else 1.0)) if n > most else rows


def _candidate_features(sample: DataFrame) -> DataFrame:
    """Document counts of every word and word beginning: feature, p, u."""
    word = F.explode(F.array_distinct(F.split(F.col("words"), " +")))
    each = sample.select("positive", "row", word.alias("w")).where(F.length("w") >= 2)
    forms = F.array(F.concat(F.lit(" "), F.col("w"), F.lit(" ")),
                    *[F.when(F.length("w") > n, F.concat(F.lit(" "), F.substring("w", 1, n))) for n in PREFIXES])
    found = each.select("positive", "row", F.explode(forms).alias("feature")).where("feature is not null").distinct()
    return found.groupBy("feature").agg(F.sum("positive").alias("p"), F.sum(1 - F.col("positive")).alias("u"))


def choose_features(sample: DataFrame, n_pos: int, n_unl: int, most: int = FEATURES, prior: float = 0.0) -> list[str]:
    lift = min(LIFT, (1 + 1 / max(prior, PRIOR_EDGE)) / 2)
    counts = _candidate_features(sample)
    rate_p, rate_u = (F.col("p") + 0.5) / (n_pos + 1), (F.col("u") + 0.5) / (n_unl + 1)
    least = max(2, round(0.004 * n_pos))
    top = (counts.where((F.col("p") >= least) & (rate_p >= lift * rate_u))
           .withColumn("gain", F.col("p") * F.log(rate_p / rate_u)).orderBy(F.col("gain").desc(), "feature").limit(most))
    return sorted(r["feature"] for r in top.select("feature").collect())


@functools.lru_cache(maxsize=2)
def automaton(features: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, f in enumerate(features):
        found.add_word(f, i)
    found.make_automaton()
    return found


def hits(features: tuple[str, ...], text: str) -> list[int]:
    """Numbers of a text's features: feature k, then k + F where it occurs twice
    and k + 2F where it occurs three times or more (F features)."""
    n = len(features)
    count: dict[int, int] = {}
    for _, k in automaton(features).iter(text):
        count[k] = count.get(k, 0) + 1
    return [k + level * n for k, c in count.items() for level in range(min(c, LEVELS))]


def _features_of(features: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [hits(features, t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"positive": b.column(0), "hits": pa.array(found, pa.list_(pa.int32()))})
    return run


def fit_pu(pos: list[np.ndarray], unl: list[np.ndarray], n_features: int, prior: float, steps: int = STEPS,
           rate: float = 0.1, decay: float = 1e-4, slack: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the non-negative risk (full-batch Adam)."""
    def flat(rows):
        lens = np.array([len(r) for r in rows], dtype=np.int64)
        return np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(rows)), lens), len(rows)

    (pi, pr, np_), (ui, ur, nu) = flat(pos), flat(unl)
    w = np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)

    def score(index, row, n):
        return np.bincount(row, weights=w[index], minlength=n) + w[-1]

    def slope(index, row, coef):
        out = np.zeros_like(w)
        out[:-1] = np.bincount(index, weights=coef[row], minlength=n_features)
        out[-1] = coef.sum()
        return out

    sigma = lambda x: 0.5 * np.tanh(0.5 * x) + 0.5
    loss = lambda x: np.logaddexp(0, -x)
    for step in range(1, steps + 1):
        fp, fu = score(pi, pr, np_), score(ui, ur, nu)
        negative = loss(-fu).mean() - prior * loss(-fp).mean()
        g_neg = slope(ui, ur, sigma(fu) / nu) - prior * slope(pi, pr, sigma(fp) / np_)
        if negative >= -slack:
            grad = g_neg - prior * slope(pi, pr, sigma(-fp) / np_)
        else:
            grad = -g_neg
        grad[:-1] += decay * w[:-1]
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        w -= rate * min(1.0, 2 * (1 - step / (steps + 1))) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-10)
    return w[:-1], float(w[-1])


def fit(positives: DataFrame, unlabelled: DataFrame, prior: float, id_col: str = "doc_id", text_col: str = "text") -> Toxicity | None:
    """`positives`: confirmed toxic rows; `unlabelled`: any rows; `prior`: share of
    toxic texts among them. None without positives."""
    pick = lambda d, most, flag: _draw(d.select(id_col, text_col), most, id_col, text_col).select(
        F.lit(flag).alias("positive"), F.xxhash64(F.col(id_col).cast("string"), text_col).alias("row"), words(F.col(text_col)).alias("words"))
    sample = written(pick(positives, POSITIVES, 1).unionByName(pick(unlabelled, UNLABELLED, 0)), "pu_sample")
    sizes = {r[0]: r[1] for r in sample.groupBy("positive").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return None
    prior = min(max(prior, PRIOR_EDGE), 1 - PRIOR_EDGE)
    features = tuple(choose_features(sample, sizes[1], sizes[0], prior=prior))
    if not features:
        return Toxicity((), (), float(np.log(prior / (1 - prior))))
    rows = sample.select("positive", "words").mapInArrow(_features_of(features), "positive int, hits array<int>").collect()
    split = [[np.array(r["hits"], dtype=np.int64) for r in rows if r["positive"] == k] for k in (1, 0)]
    weights, intercept = fit_pu(*split, LEVELS * len(features), prior)
    return Toxicity(features, tuple(weights.tolist()), intercept)


def _score(model: Toxicity, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.array(model.weights)
        for b in batches:
            texts = b.column(b.schema.get_field_index("_words"))
            scores = []
            for i in range(len(texts)):
                found = hits(model.features, texts[i].as_py())
                scores.append(weights[found].sum() + model.intercept if found else model.intercept)
            z = np.array(scores, dtype=np.float64)
            rest = {n: b.column(b.schema.get_field_index(n)) for n in names}
            yield pa.RecordBatch.from_pydict(rest | {"score": 0.5 * np.tanh(0.5 * z) + 0.5})
    return run


def score(df: DataFrame, model: Toxicity | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df` (its columns `keep`, all by default) with `score`, 0 to 1."""
    names = [c for c in (df.columns if keep is None else keep) if c != "score"]
    if model is None:
        return df.select(*names, F.lit(0.0).alias("score"))
    if not model.features:
        return df.select(*names, F.lit(float(0.5 * np.tanh(0.5 * model.intercept) + 0.5)).alias("score"))
    fields = [df.schema[c] for c in names] + [T.StructField("score", T.DoubleType())]
    return map_arrow(df.select(*names, words(F.col(text_col)).alias("_words")), _score(model, names), T.StructType(fields))
