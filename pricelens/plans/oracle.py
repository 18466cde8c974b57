"""Independent SQL formulations (DuckDB dialect) of the registered queries.

They re-state each operator in plain SQL over the same fixture views so the
Spark result can be checked value by value. Shared fragments live here.
"""

from __future__ import annotations

from pricelens import constants as C
from pricelens.fixture import cte


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def category_case(col: str = "category") -> str:
    whens = " ".join(f"when {_q(k)} then {_q(v)}" for k, v in C.CATEGORY_MAP.items())
    return f"coalesce(case {col} {whens} end, {col})"


def brand_sql(col: str = "brand") -> str:
    base = f"case when {col} is not null then lower(trim({col})) else {_q(C.UNKNOWN_BRAND)} end"
    return f"trim(regexp_replace({base}, {_q(C.BRAND_SUFFIX_PATTERN)}, ''))"


def eff_sql(p="price", s="sale_price", on="on_sale") -> str:
    return f"(case when {on} and {s} is not null then {s} else {p} end)"


def bucket_sql(eff: str) -> str:
    return (f"case when {eff} < {C.BUDGET_MAX} then 'budget' when {eff} <= {C.MID_MAX} then 'mid' "
            f"else 'premium' end")


def sk_sql(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(cast({e} as varchar), {_q(C.SURROGATE_NULL)})" for e in exprs)
    return f"md5(concat_ws({_q(C.SURROGATE_SEP)}, {parts}))"


def ts_text_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def sk_ts_sql(ts: str) -> str:
    return f"md5(coalesce({ts_text_sql(ts)}, {_q(C.SURROGATE_NULL)}))"


DEDUP_CTE = """deduped as (select * from raw_listings
 qualify row_number() over (partition by product_name, source, price
   order by scraped_at desc nulls last, id desc nulls last) = 1)"""

PRICED_CTE = """priced0 as (select id, product_name,
   case when price > 0 then cast(price as double) end as price,
   case when sale_price > 0 then cast(sale_price as double) end as sale_price,
   source, url, category, brand, sku, scraped_at from deduped),
 priced as (select id, product_name, price, sale_price, coalesce(sale_price < price, false) as on_sale,
   source, url, category, brand, sku, scraped_at from priced0 where price is not null)"""


def clean_ctes() -> str:
    """CTEs ending in `clean` (the 11-column contract) over raw_listings."""
    return f"""{DEDUP_CTE},
 {PRICED_CTE},
 clean as (select product_name, price, sale_price, on_sale, source, url,
   {category_case()} as category, {brand_sql()} as brand, sku, scraped_at,
   {bucket_sql(eff_sql())} as price_bucket from priced)"""


def with_views(*views: str) -> str:
    return cte(*views)
