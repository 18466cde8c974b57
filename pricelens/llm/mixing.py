"""Mixing to target weights by soft domain membership (DataFrame operations only).

A table of labelled documents names a domain for some of them. A naive Bayes
classifier on counts of every character, fitted with one aggregate per domain, predicts
for every document the posterior of each domain. Then nonnegative rates r are
sought, one per document, so that the expected tokens of the mixture,
sum(r * tokens * posterior), match a target per domain:

    minimise  sum_k (total_k(r) - target_k)^2 / total_k(1)   subject to r >= 0

by projected gradient steps: one aggregate gives the totals of all domains, a
step changes every document's rate by its posteriors times the residuals and
cuts at zero. With this weighting (and rates weighted by their tokens) the
curvature is at most 1, so full steps converge. A rate depends on a document's posteriors and on the residuals of
the steps so far alone, so the fitted steps are a small table of numbers and
apply to any row without a join.

`copies` realises a rate: its whole part, and one more with the probability of
its fraction, decided by a hash of id and text.

Defined results: a null text counts as empty; an empty text has no tokens and
the prior as posterior; rows of the labelled table with null id or domain are
left out, and an id labelled twice counts once per label; a domain without
tokens in any text cannot be reached and keeps its residual; without labels or
rows every rate is 1; repeated rows get equal rates and copies; columns of `df`
are kept, those of the result's names are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import written

# What a classifier counts, naming no alphabet: the bytes of the case-folded text in
# UTF-8, where ASCII has a feature per character and every other character leaves its
# lead byte and its continuation bytes; and the characters of each Unicode class.
# The order (frequent bytes first) is for speed alone: what is counted is taken out.
_COMMON = b" etaonisrhldcumfpgwybvkxjqz\n"
ASCII = [bytes([c]) for c in _COMMON] + [bytes([c]) for c in (9, 13, *range(33, 127)) if c not in _COMMON and not 65 <= c <= 90]
BEYOND = [bytes([c]) for c in (*range(0xC2, 0xF5), *range(0x80, 0xC0))]
CLASSES = [rf"\p{{{c}}}+" for c in ("Lu", "L", "M", "N", "P", "S")]
# How many characters' evidence a document counts for, whatever its length: the
# characters of a text depend on each other, so full evidence would be too sure.
EVIDENCE = 60.0
# Targets default to the domains' shares of the tokens raised to this power.
TEMPER = 0.7
STEPS = 60
TOLERANCE = 1e-4
# Steps that one written table carries.
STEPS_PER_TABLE = 10


@dataclass(frozen=True)
class Classifier:
    domains: tuple[str, ...]
    prior: tuple[float, ...]  # logarithms
    weights: tuple[tuple[float, ...], ...]  # log likelihood per domain and feature


@dataclass(frozen=True)
class Mixing:
    classifier: Classifier
    residuals: tuple[tuple[float, ...], ...]  # per step and domain, with the step's rate
    targets: dict[str, float]
    reached: dict[str, float]


def tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


# Each of the three counts has one feature more, for what is left at its end.
N_FEATURES = len(ASCII) + len(BEYOND) + len(CLASSES) + 3


def _taken_out(text: Column, parts: list, out, size) -> Column:
    """What `size` loses when `out(text, part)` takes the parts out one after the other; at the end the rest's size."""
    each = F.array(*[F.lit(p).cast("string") for p in parts])
    start = F.struct(text.alias("rest"), F.array().cast("array<int>").alias("sizes"))
    step = lambda acc, p: F.struct(out(acc["rest"], p).alias("rest"), F.array_append(acc["sizes"], size(acc["rest"])).alias("sizes"))
    after = lambda acc: F.array_append(F.slice(acc["sizes"], 2, len(parts)), size(acc["rest"]))
    return F.aggregate(each, start, step, lambda acc: F.array_append(
        F.zip_with(acc["sizes"], after(acc), lambda a, b: (a - b).cast("double")), size(acc["rest"]).cast("double")))


def features(text: Column) -> Column:
    """Counts of the case-folded text's bytes, and of its characters by Unicode class."""
    whole = F.coalesce(text, F.lit(""))
    plain = F.octet_length(whole) == F.char_length(whole)
    lower = F.lower(whole)
    without = lambda t, p: F.replace(t, p, F.lit(""))
    ascii_ = F.when(plain, lower).otherwise(F.regexp_replace(lower, r"[^\x00-\x7F]+", ""))
    beyond = F.regexp_replace(lower, r"[\x00-\x7F]+", "")
    return F.concat(
        _taken_out(ascii_, ASCII, without, F.octet_length),
        F.when(plain, F.array_repeat(F.lit(0.0), len(BEYOND) + 1)).otherwise(_taken_out(beyond, BEYOND, without, F.octet_length)),
        _taken_out(whole, CLASSES, lambda t, p: F.regexp_replace(t, p, F.lit("")), F.char_length))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def _literal(values) -> Column:
    return F.array(*map(F.lit, values))


def fit_classifier(counted: DataFrame, labelled: DataFrame, id_col: str) -> Classifier | None:
    """`counted` has the feature array `_f`; `labelled` has id and `domain`. One row per domain reaches the driver."""
    labels = labelled.where(F.col(id_col).isNotNull() & F.col("domain").isNotNull()).select(id_col, F.col("domain").cast("string").alias("domain"))
    sums = (counted.select(id_col, "_f").join(labels, id_col).groupBy("domain")
            .agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("_f")[i]) for i in range(N_FEATURES)]).alias("f")).orderBy("domain").collect())
    if not sums:
        return None
    rows = sum(r["n"] for r in sums)
    weights = [tuple(math.log((x + 1.0) / (sum(r["f"]) + N_FEATURES)) for x in r["f"]) for r in sums]
    return Classifier(tuple(r["domain"] for r in sums), tuple(math.log(r["n"] / rows) for r in sums), tuple(weights))


def with_posteriors(counted: DataFrame, model: Classifier) -> DataFrame:
    """`counted` with the array `_p` of the domains' posteriors in place of `_f`."""
    seen = F.aggregate("_f", F.lit(0.0), lambda acc, x: acc + x)
    scale = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest(seen, F.lit(1.0)))
    logs = F.array(*[F.lit(p) + scale * _dot(F.col("_f"), _literal(w)) for p, w in zip(model.prior, model.weights, strict=True)])
    out = counted.withColumn("_l", logs).drop("_f")
    out = out.withColumn("_e", F.transform("_l", lambda x: F.exp(x - F.array_max("_l")))).drop("_l")
    return out.withColumn("_s", F.aggregate("_e", F.lit(0.0), lambda acc, x: acc + x)).withColumn(
        "_p", F.transform("_e", lambda x: x / F.col("_s"))).drop("_e", "_s")


def _step(rate: Column, post: list[Column], residual: tuple[float, ...]) -> Column:
    return F.greatest(F.lit(0.0), rate - reduce(add, [p * e for p, e in zip(post, residual, strict=True)]))


def fit(df: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id",
        text_col: str = "text", total: float | None = None, temper: float = TEMPER) -> tuple[Mixing | None, DataFrame]:
    """The fitted mixing, and per row (id, tokens, p0, p1, ..) as a written table.

    `targets` gives weights per domain (by default tempered shares); `total`
    is the number of tokens of the mixture (by default those of `df`).
    """
    text = F.col(text_col)
    counted = written(df.select(id_col, tokens(text).alias("tokens"), features(text).alias("_f")), "mix_features")
    model = fit_classifier(counted, labelled, id_col)
    if model is None:
        return None, counted.select(id_col, "tokens")
    k = len(model.domains)
    names = [f"p{i}" for i in range(k)]
    post = written(with_posteriors(counted, model).select(id_col, "tokens", *[F.col("_p")[i].alias(n) for i, n in enumerate(names)]), "mix_posteriors")

    def totals(frame: DataFrame, rate: Column) -> list[float]:
        row = frame.agg(*[F.sum(rate * F.col("tokens") * F.col(n)).alias(n) for n in names]).first()
        return [float(x or 0.0) for x in row]

    have = totals(post, F.lit(1.0))
    everything = total if total is not None else sum(have)
    if not sum(have):
        return None, post.select(id_col, "tokens")
    if targets is None:
        weight = [h ** temper for h in have]
    else:
        weight = [float(targets.get(d, 0.0)) for d in model.domains]
    want = [everything * w / sum(weight) for w in weight]
    scale = [max(h, 1e-9 * everything) for h in have]
    residuals: list[tuple[float, ...]] = []
    rates, rate = post, F.lit(1.0)
    reached = have
    while len(residuals) < STEPS:
        if max(abs(a - b) / max(b, 1e-6 * everything) for a, b in zip(reached, want, strict=True)) <= TOLERANCE:
            break
        step = tuple((a - b) / s for a, b, s in zip(reached, want, scale, strict=True))
        residuals.append(step)
        rate = _step(rate, [F.col(n) for n in names], step)
        if len(residuals) % STEPS_PER_TABLE == 0:
            rates = written(rates.withColumn("rate", rate), "mix_rates")
            rate = F.col("rate")
        reached = totals(rates, rate)
    by = lambda v: dict(zip(model.domains, v, strict=True))
    return Mixing(model, tuple(residuals), by(want), by(reached)), rates.withColumn("rate", rate)


def copies(rate: Column, id_col: str, text_col: str) -> Column:
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col), F.lit("mix")), F.lit(1 << 40)) / float(1 << 40)
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def apply(df: DataFrame, mixing: Mixing | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`df` with `rate` and `copies`, computed where each row is read."""
    if mixing is None:
        return df.withColumn("rate", F.lit(1.0)).withColumn("copies", F.lit(1))
    own = [c for c in df.columns if c not in ("rate", "copies")]
    rows = with_posteriors(df.select(*own, features(F.col(text_col)).alias("_f")), mixing.classifier)
    rate = F.lit(1.0)
    if mixing.residuals:
        steps = F.array(*map(_literal, mixing.residuals))
        rate = F.aggregate(steps, rate, lambda r, step: F.greatest(F.lit(0.0), r - _dot(F.col("_p"), step)))
    return (rows.withColumn("rate", rate).withColumn("copies", copies(F.col("rate"), id_col, text_col))
            .select(*own, "rate", "copies"))


def mixture(df: DataFrame, mixing: Mixing | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df`, each as often as its `copies` say, with the columns of `df`."""
    out = apply(df, mixing, id_col, text_col)
    # Not `copies > 0`: that filter would be pushed below, and repeat there all that `copies` is made of.
    copy = F.explode_outer(F.array_repeat(F.lit(True), F.col("copies")))
    return out.withColumn("_copy", copy).where("_copy").select(*df.columns)
