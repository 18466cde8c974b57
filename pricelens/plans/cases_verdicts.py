"""Verdict validation, run counters, pair prompts and the rule scorer."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens import constants as C
from pricelens.fixture import view
from pricelens.operators import verdicts as V
from pricelens.plans import oracle as O
from pricelens.plans.cases_parse import brand_case_sql
from pricelens.plans.registry import register

VERDICT_SQL = """vj as (select pair_id, case when json_valid(verdict) then verdict else '[]' end as j from verdict_json),
 vt as (select pair_id, j, json_type(j) = 'OBJECT' as is_obj,
   json_type(j, '$.is_match') as t_m, json_type(j, '$.confidence') as t_c, json_type(j, '$.reasoning') as t_r from vj),
 vv as (select pair_id, j, coalesce(is_obj and t_m = 'BOOLEAN' and t_c in ('DOUBLE', 'BIGINT', 'UBIGINT')
     and cast(json_extract_string(j, '$.confidence') as double) between 0.0 and 1.0 and t_r = 'VARCHAR', false) as valid
   from vt)"""


@register("validate_verdicts", O.with_views("verdict_json") + ", " + VERDICT_SQL + """
select pair_id, cast(json_extract_string(j, '$.is_match') as boolean) as is_match,
 cast(json_extract_string(j, '$.confidence') as double) as confidence,
 coalesce(nullif(json_extract_string(j, '$.canonical_name'), ''), 'Unknown') as canonical_name,
 coalesce(nullif(json_extract_string(j, '$.brand'), ''), 'Unknown') as brand,
 json_extract_string(j, '$.model_number') as model_number,
 json_extract_string(j, '$.reasoning') as reasoning
from vv where valid""")
def q_validate(spark, sf_dir):
    valid, _ = V.validate_verdicts(view(spark, sf_dir, "verdict_json"))
    return valid


@register("rejected_verdicts", O.with_views("verdict_json") + ", " + VERDICT_SQL + """
select v.pair_id, v.verdict from verdict_json v join vv on v.pair_id = vv.pair_id where not vv.valid""")
def q_rejected(spark, sf_dir):
    _, rejected = V.validate_verdicts(view(spark, sf_dir, "verdict_json"))
    return rejected


@register("match_run_stats", O.with_views("verdict_json") + ", " + VERDICT_SQL + f""",
 acc as (select valid, valid and coalesce(cast(json_extract_string(j, '$.is_match') as boolean)
   and cast(json_extract_string(j, '$.confidence') as double) >= {C.CONFIDENCE_THRESHOLD}, false) as accepted from vv)
select count(*) as pairs_processed, count(*) filter (where accepted) as matches_found,
 count(*) filter (where valid and not accepted) as non_matches, count(*) filter (where not valid) as failed from acc""")
def q_run_stats(spark, sf_dir):
    return V.run_stats(V.verdict_outcomes(view(spark, sf_dir, "verdict_json")))


PAIRS_SQL = """pairs as (select m.ebay_listing_id, m.bestbuy_listing_id, e.product_name as ebay_title,
   b.product_name as bestbuy_title, case when e.price <> 0 then e.price end as ebay_price,
   case when b.price <> 0 then b.price end as bestbuy_price, b.category
   from matched_products m join raw_listings e on e.id = m.ebay_listing_id
   join raw_listings b on b.id = m.bestbuy_listing_id)"""


def scored_pairs(spark, sf_dir):
    """Stored pairs with both listings' titles, prices (0 -> NULL) and the
    retailer listing's category."""
    m = view(spark, sf_dir, "matched_products")
    raw = view(spark, sf_dir, "raw_listings")
    e = raw.select(F.col("id").alias("ebay_listing_id"), F.col("product_name").alias("ebay_title"),
                   F.nullif(F.col("price"), F.lit(0.0)).alias("ebay_price"))
    b = raw.select(F.col("id").alias("bestbuy_listing_id"), F.col("product_name").alias("bestbuy_title"),
                   F.nullif(F.col("price"), F.lit(0.0)).alias("bestbuy_price"), "category")
    return (m.select("ebay_listing_id", "bestbuy_listing_id")
             .join(e, "ebay_listing_id").join(b, "bestbuy_listing_id"))


def _price_line_sql(p: str) -> str:
    return f"case when {p} is not null and {p} <> 0 then printf('  Price: $%.2f', {p}) || chr(10) else '' end"


def prompt_sql() -> str:
    t = C.PROMPT_TEMPLATE
    pieces = {"ebay_title": "ebay_title", "bestbuy_title": "bestbuy_title",
              "ebay_price_line": _price_line_sql("ebay_price"),
              "bestbuy_price_line": _price_line_sql("bestbuy_price"),
              "category": "coalesce(category, 'None')"}
    import string
    parts = []
    for literal, field, _, _ in string.Formatter().parse(t):
        if literal:
            parts.append("'" + literal.replace("'", "''").replace("\n", "' || chr(10) || '") + "'")
        if field:
            parts.append(f"({pieces[field]})")
    return " || ".join(parts)


@register("match_prompts", O.with_views("matched_products") + ", " + PAIRS_SQL +
          f"\nselect ebay_listing_id, bestbuy_listing_id, {prompt_sql()} as prompt from pairs")
def q_prompts(spark, sf_dir):
    return V.pair_prompts(scored_pairs(spark, sf_dir)).select("ebay_listing_id", "bestbuy_listing_id", "prompt")


def _tok(t: str) -> str:
    return f"string_split_regex(upper(trim({t})), '\\s+')"


def _model(t: str) -> str:
    return (f"list_filter({_tok(t)}, lambda x: length(x) >= 4 and regexp_matches(x, '[A-Z]') "
            f"and regexp_matches(x, '[0-9]'))")


def _size(t: str) -> str:
    return f"""list_filter({_tok(t)}, lambda x: regexp_matches(x, '^[0-9]+([.][0-9]+)?("|IN|INCH|GB|TB|MM)$'))"""


@register("score_pairs_rules", O.with_views("matched_products") + ", " + PAIRS_SQL + f""",
 f as (select *, list_has_any({_model('ebay_title')}, {_model('bestbuy_title')}) as model_hit,
   upper({brand_case_sql('ebay_title')}) = upper({brand_case_sql('bestbuy_title')}) as same_brand,
   list_has_any({_size('ebay_title')}, {_size('bestbuy_title')}) as size_hit,
   list_intersect({_model('ebay_title')}, {_model('bestbuy_title')}) as common from pairs),
 s as (select *, cast(case when model_hit then 0.95 when same_brand and size_hit then 0.8
   when same_brand then 0.6 else 0.3 end as double) as confidence from f)
select ebay_listing_id, bestbuy_listing_id, confidence >= 0.8 as is_match, confidence,
 bestbuy_title as canonical_name, {brand_case_sql('bestbuy_title')} as brand,
 case when model_hit then list_min(common) end as model_number,
 case when model_hit then 'model number matches' when same_brand and size_hit then 'brand and size match'
      when same_brand then 'brand matches only' else 'no shared identifiers' end as reasoning
from s""")
def q_rules(spark, sf_dir):
    out = V.rule_verdicts(scored_pairs(spark, sf_dir))
    return out.select("ebay_listing_id", "bestbuy_listing_id", *V.VERDICT_COLUMNS)


def trial_scorer(pair: dict) -> str:
    """A scorer with every kind of answer, for the query and the tests: which one
    follows from the length of the retailer's title and the attempt."""
    kind = len(pair["bestbuy_title"]) % 5
    if kind == 1 and pair["attempt"] < 2:
        return "no verdict yet"
    if kind == 2 and pair["attempt"] < 3:
        raise V.RateLimited("slow down")
    if kind == 3:
        raise ValueError("unknown model")
    if kind == 4:
        return '{"is_match": true, "confidence": 1.5, "reasoning": "too sure"}'
    same = pair["ebay_title"] == pair["bestbuy_title"]
    return '{"is_match": %s, "confidence": %s, "reasoning": "titles compared"}' % (("true", "0.9") if same else ("false", "0.4"))


@register("score_rounds", O.with_views("matched_products") + ", " + PAIRS_SQL + """,
 k as (select *, length(bestbuy_title) % 5 as kind from pairs)
select ebay_listing_id, bestbuy_listing_id,
 case when kind = 3 then null when kind = 4 then '{"is_match": true, "confidence": 1.5, "reasoning": "too sure"}'
  when ebay_title = bestbuy_title then '{"is_match": true, "confidence": 0.9, "reasoning": "titles compared"}'
  else '{"is_match": false, "confidence": 0.4, "reasoning": "titles compared"}' end as verdict,
 cast([1, 2, 3, 1, 3][kind + 1] as integer) as attempts, ['valid', 'valid', 'valid', 'error', 'invalid'][kind + 1] as outcome,
 case when kind = 3 then 'unknown model' end as message from k""")
def q_score_rounds(spark, sf_dir):
    """Verdicts of a caller's scorer, with attempts and error classes."""
    out = V.score_rounds(scored_pairs(spark, sf_dir), trial_scorer, waits=())
    return out.select("ebay_listing_id", "bestbuy_listing_id", "verdict", "attempts", "outcome", "message")
