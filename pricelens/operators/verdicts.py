"""Pair verdicts: prompts, scoring on executors, validation, counters."""

from __future__ import annotations

import functools
import json
import string
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens import constants as C
from pricelens import schemas as S
from pricelens.functions.columns import brand_from_title, price_line, unknown_if_blank
from pricelens.session import materialize

# What a scorer gets of a pair.
PAIR_FIELDS = ("ebay_title", "bestbuy_title", "ebay_price", "bestbuy_price", "category")
VERDICT_COLUMNS = ("is_match", "confidence", "canonical_name", "brand", "model_number", "reasoning")


def pair_prompts(pairs: DataFrame) -> DataFrame:
    """Add the prompt text for each pair (ebay_title, bestbuy_title,
    ebay_price, bestbuy_price, category). Price lines are omitted when the
    price is missing or zero; a missing category prints as None."""
    fields = {
        "ebay_title": F.col("ebay_title"), "bestbuy_title": F.col("bestbuy_title"),
        "ebay_price_line": price_line("ebay_price"), "bestbuy_price_line": price_line("bestbuy_price"),
        "category": F.coalesce(F.col("category"), F.lit("None")),
    }
    parts = []
    for literal, field, _, _ in string.Formatter().parse(C.PROMPT_TEMPLATE):
        if literal:
            parts.append(F.lit(literal))
        if field:
            parts.append(fields[field])
    return pairs.withColumn("prompt", F.concat(*parts))


def _tokens(title):
    return F.split(F.upper(F.trim(F.col(title))), r"\s+")


def _model_tokens(title):
    return F.filter(_tokens(title), lambda x: (F.length(x) >= 4) & x.rlike("[A-Z]") & x.rlike("[0-9]"))


def _size_tokens(title):
    return F.filter(_tokens(title), lambda x: x.rlike(r'^[0-9]+([.][0-9]+)?("|IN|INCH|GB|TB|MM)$'))


def rule_verdicts(pairs: DataFrame) -> DataFrame:
    """Offline default scorer, native columns only (our own rules, modelled on
    the published confidence rubric; not equivalent to a language model):

    shared model token (letters+digits, >= 4 chars) -> 0.95;
    same brand and a shared size/storage token -> 0.8;
    same brand -> 0.6; otherwise 0.3. is_match = confidence >= 0.8.
    """
    me, mb = _model_tokens("ebay_title"), _model_tokens("bestbuy_title")
    se, sb = _size_tokens("ebay_title"), _size_tokens("bestbuy_title")
    be, bb = F.upper(brand_from_title("ebay_title")), F.upper(brand_from_title("bestbuy_title"))
    model_hit = F.arrays_overlap(me, mb)
    same_brand = be == bb
    size_hit = F.arrays_overlap(se, sb)
    conf = (F.when(model_hit, F.lit(0.95)).when(same_brand & size_hit, F.lit(0.8))
             .when(same_brand, F.lit(0.6)).otherwise(F.lit(0.3)))
    reason = (F.when(model_hit, F.lit("model number matches"))
               .when(same_brand & size_hit, F.lit("brand and size match"))
               .when(same_brand, F.lit("brand matches only"))
               .otherwise(F.lit("no shared identifiers")))
    return pairs.select(
        "*",
        (conf >= 0.8).alias("is_match"), conf.alias("confidence"),
        F.col("bestbuy_title").alias("canonical_name"),
        brand_from_title("bestbuy_title").alias("brand"),
        F.when(model_hit, F.array_min(F.array_intersect(me, mb))).alias("model_number"),
        reason.alias("reasoning"),
    )


rule_scorer = rule_verdicts


def verdict_json(df: DataFrame) -> DataFrame:
    """Pack verdict columns into one JSON text column `verdict`."""
    return df.withColumn("verdict", F.to_json(F.struct(*[F.col(c) for c in VERDICT_COLUMNS])))


def score_pairs(pairs: DataFrame, scorer: Callable[[dict], str], attempts: int = 3,
                text_cols: tuple[str, ...] = PAIR_FIELDS) -> DataFrame:
    """Call `scorer(pair_dict) -> verdict JSON text` for each pair on the
    executors (Arrow batches through mapInPandas). A call that raises or whose text is no JSON object is retried,
    up to `attempts` calls; after that the verdict is NULL or the last text, so
    the pair counts as failed and is not saved.
    """
    out_schema = T.StructType(pairs.schema.fields + [T.StructField("verdict", T.StringType(), True)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            verdicts = []
            for rec in pdf[list(text_cols)].to_dict("records"):
                rec = {k: (None if isinstance(v, float) and v != v else v) for k, v in rec.items()}
                out = None
                for _ in range(max(1, attempts)):
                    try:
                        out = scorer(rec)
                        if out is not None and not isinstance(out, str):
                            out = json.dumps(out)
                        if isinstance(json.loads(out or "null"), dict):
                            break
                    except Exception:  # noqa: BLE001 - a failed call is retried, then NULL
                        out = None
                verdicts.append(out)
            yield pdf.assign(verdict=verdicts)

    return pairs.mapInPandas(run, out_schema)


class RateLimited(Exception):
    """A scorer raises this when the service asks it to slow down."""


def _failure_of(error: Exception) -> str:
    text = str(error)
    return "rate_limited" if isinstance(error, RateLimited) or "429" in text or "rate_limit" in text.lower() else "error"


class TokenBucket:
    """At most `rate` calls a second, one at a time, by the given clock."""

    def __init__(self, rate: float | None, clock=time.monotonic, sleep=time.sleep):
        self.gap, self.clock, self.sleep, self.next = (1.0 / rate if rate else 0.0), clock, sleep, None

    def take(self) -> None:
        now = self.clock()
        if self.next is not None and now < self.next:
            self.sleep(self.next - now)
            now = self.next
        self.next = now + self.gap


def call_round(pairs: DataFrame, scorer: Callable[[dict], str], attempt: int, text_cols: tuple[str, ...] = PAIR_FIELDS,
               calls_per_second: float | None = None, tasks: int | None = None) -> DataFrame:
    """One call per pair: `text` (the answer), or `failure` (rate_limited, error) and its `message`.

    The scorer gets the pair's fields and `attempt`, counted from 1. With
    `calls_per_second`, each of `tasks` tasks has a token bucket with its share.
    """
    fields = [f for f in pairs.schema.fields if f.name not in ("text", "failure", "message")]
    names = [f.name for f in fields]
    extra = [T.StructField(c, T.StringType(), True) for c in ("text", "failure", "message")]
    if calls_per_second:
        tasks = tasks or int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pairs = pairs.repartition(tasks)
    rate = calls_per_second / tasks if calls_per_second else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket = TokenBucket(rate)
        for pdf in batches:
            rows = []
            for rec in pdf[list(text_cols)].to_dict("records"):
                rec = {k: (None if isinstance(v, float) and v != v else v) for k, v in rec.items()} | {"attempt": attempt}
                bucket.take()
                try:
                    answer = scorer(rec)
                    rows.append((answer if answer is None or isinstance(answer, str) else json.dumps(answer), None, None))
                except Exception as e:  # noqa: BLE001 - the class decides about a retry
                    rows.append((None, _failure_of(e), str(e)[:500]))
            yield pdf.assign(**{c: pd.Series([r[i] for r in rows], index=pdf.index, dtype=object) for i, c in enumerate(("text", "failure", "message"))})

    return pairs.select(*names).mapInPandas(run, T.StructType(fields + extra))


def score_rounds(pairs: DataFrame, scorer: Callable[[dict], str], attempts: int = 3, text_cols: tuple[str, ...] = PAIR_FIELDS,
                 calls_per_second: float | None = None, tasks: int | None = None, waits: tuple[float, ...] = (15, 30, 45),
                 sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Verdicts of all pairs, by rounds of calls.

    A round calls the scorer once for every open pair and is written, so no
    answer is asked for twice. An answer that is no valid verdict and a
    rate-limited call stay open for the next round; any other error closes the pair.
    After a round with a rate-limited call the next one waits. Pairs that
    are open after `attempts` rounds are closed as they stand.

    Returns the pairs with `verdict` (the last answer), `attempts`, `outcome`
    (valid, invalid, rate_limited, error) and `message`.
    """
    columns, closed, pending = pairs.columns, [], pairs
    for attempt in range(1, max(1, attempts) + 1):
        called, _ = materialize(call_round(pending, scorer, attempt, text_cols, calls_per_second, tasks), f"score_round_{attempt}")
        outcome = F.when(F.col("failure").isNotNull(), F.col("failure")).when(_strictly_valid("text"), F.lit("valid")).otherwise(F.lit("invalid"))
        judged, _ = materialize(called.withColumn("outcome", outcome), f"score_outcomes_{attempt}")
        again = F.col("outcome").isin("invalid", "rate_limited") if attempt < attempts else F.lit(False)
        closed.append(judged.filter(~again).select(*columns, F.col("text").alias("verdict"), F.lit(attempt).alias("attempts"), "outcome", "message"))
        pending = judged.filter(again).select(*columns)
        left = judged.filter(again).agg(F.count(F.lit(1)), F.count_if(F.col("outcome") == "rate_limited")).first()
        if not left[0]:
            break
        if left[1] and waits:
            sleep(waits[min(attempt, len(waits)) - 1])
    return functools.reduce(DataFrame.unionByName, closed)


def dead_letters(outcomes: DataFrame) -> DataFrame:
    """The pairs of `score_rounds` without a valid verdict, and why."""
    return outcomes.filter(F.col("outcome") != "valid")


def _strictly_valid(col: str):
    """True for one whole JSON object whose fields have the declared JSON types.

    `from_json` converts types and ignores text after the object, so the types
    are read from the parsed variant, and the text must also be valid as the
    one value of an array and of an object.
    """
    text = F.col(col)
    v = F.try_variant_get(F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))), "$.v", "variant")
    alone = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull()

    def kind(field: str):
        return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))

    number = kind("confidence").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
    ok = alone & F.schema_of_variant(v).startswith("OBJECT") & (kind("is_match") == "BOOLEAN") & number & (kind("reasoning") == "STRING")
    for field in ("canonical_name", "brand", "model_number"):
        ok = ok & F.coalesce(kind(field), F.lit("VOID")).isin("STRING", "VOID")
    return F.coalesce(ok & F.from_json(text, S.VERDICT)["confidence"].between(0.0, 1.0), F.lit(False))


def validate_verdicts(df: DataFrame, col: str = "verdict") -> tuple[DataFrame, DataFrame]:
    """Split verdict texts into (valid, rejected).

    Valid: a JSON object with boolean is_match, numeric confidence in [0, 1]
    and a string reasoning; names, brand and model number are strings, null or
    missing. JSON types are strict (no "yes" -> true, no 5 -> "5"), and nothing
    but blanks may follow the object.
    Empty / missing canonical_name and brand become "Unknown".
    """
    v = F.from_json(F.col(col), S.VERDICT)
    parsed = df.withColumn("_v", v)
    parsed = parsed.withColumn("_ok", _strictly_valid(col))
    keep = [c for c in df.columns if c != col]
    valid = parsed.filter("_ok").select(
        *keep, F.col("_v.is_match").alias("is_match"), F.col("_v.confidence").alias("confidence"),
        unknown_if_blank(F.col("_v.canonical_name")).alias("canonical_name"),
        unknown_if_blank(F.col("_v.brand")).alias("brand"),
        F.col("_v.model_number").alias("model_number"), F.col("_v.reasoning").alias("reasoning"))
    rejected = parsed.filter(~F.col("_ok")).select(*keep, F.col(col))
    return valid, rejected


def verdict_outcomes(df: DataFrame, col: str = "verdict") -> DataFrame:
    """Per pair: valid flag and accepted flag (is_match and confidence >= 0.6)."""
    v = F.from_json(F.col(col), S.VERDICT)
    ok = _strictly_valid(col)
    acc = ok & F.coalesce(v["is_match"] & (v["confidence"] >= C.CONFIDENCE_THRESHOLD), F.lit(False))
    return df.select("*", ok.alias("valid"), acc.alias("accepted"))


def run_stats(outcomes: DataFrame) -> DataFrame:
    """Run counters: pairs tried, accepted matches, valid non-matches,
    failures (no valid verdict; counted in pairs only)."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("pairs_processed"),
        F.count_if("accepted").alias("matches_found"),
        F.count_if(F.col("valid") & ~F.col("accepted")).alias("non_matches"),
        F.count_if(~F.col("valid")).alias("failed"),
    )
