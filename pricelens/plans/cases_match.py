"""Candidate matching queries.

`match_candidates` and `match_name_similarity` use the difflib ratio, which
SQL states as a recursive query over matching blocks. The other queries
run the same plan with a native edit-distance score so an SQL brute force
can check ranking, exclusions and the cap row for row.
"""

from __future__ import annotations


from pyspark.sql import functions as F

from pricelens import constants as C
from pricelens.fixture import view
from pricelens.functions.similarity import difflib_similarity, edit_similarity
from pricelens.operators import match as M
from pricelens.plans import oracle as O
from pricelens.plans.registry import register

L_SQL = """l as (select id, product_name, category, source,
   case when price <> 0 then cast(price as double) end as price
   from raw_listings where source in ('ebay', 'bestbuy')),
 bn as (select distinct category, product_name from l where source = 'bestbuy'),
 en as (select distinct category, product_name from l where source = 'ebay')"""

BOUND = ("case when length(lower(b.product_name)) + length(lower(e.product_name)) = 0 then 1.0 "
         "else cast(2 * least(length(lower(b.product_name)), length(lower(e.product_name))) as double) "
         "/ cast(length(lower(b.product_name)) + length(lower(e.product_name)) as double) end")

EDIT = ("case when greatest(length(lower(b.product_name)), length(lower(e.product_name))) = 0 then 1.0 "
        "else 1.0 - cast(levenshtein(lower(b.product_name), lower(e.product_name)) as double) "
        "/ cast(greatest(length(lower(b.product_name)), length(lower(e.product_name))) as double) end")


# The difflib ratio of every pair of lower-cased names: the longest matching block of a segment (the first in a, then in
# b, on ties), then the segments before and behind it. `k` holds, per pair and start, how far two names agree.
RATIO = """pr as materialized (
  select row_number() over () as pid, a, b, length(a) as na, length(b) as nb
  from (select distinct lower(b.product_name) as a, lower(e.product_name) as b from bn b join en e on b.category is not distinct from e.category)),
 ca as (select pid, i, substr(a, i, 1) as ch from (select pid, a, unnest(range(1, na + 1)) as i from pr)),
 cb as (select pid, j, substr(b, j, 1) as ch from (select pid, b, unnest(range(1, nb + 1)) as j from pr)),
 g as (select pid, i, j, i - j as d, i - row_number() over (partition by pid, i - j order by i) as run from ca join cb using (pid, ch)),
 k as materialized (select pid, i, j, count(*) over (partition by pid, d, run order by i desc) as n from g),
 seg(pid, a0, a1, b0, b1, n) as (
  select pid, 1, na + 1, 1, nb + 1, 0 from pr
  union all
  select pid, unnest([a0, i + m]), unnest([i, a1]), unnest([b0, j + m]), unnest([j, b1]), unnest([m, 0])
  from (select pid, a0, a1, b0, b1, arg_min(i, o) as i, arg_min(j, o) as j, arg_min(m, o) as m from (
    select s.pid, s.a0, s.a1, s.b0, s.b1, k.i, k.j, least(k.n, s.a1 - k.i, s.b1 - k.j) as m,
     least(k.n, s.a1 - k.i, s.b1 - k.j) * -1000000000 + k.i * 10000 + k.j as o
    from seg s join k on s.pid = k.pid and k.i >= s.a0 and k.i < s.a1 and k.j >= s.b0 and k.j < s.b1) x
   group by pid, a0, a1, b0, b1) y),
 ratio as materialized (
  select a, b, case when any_value(na + nb) = 0 then 1.0::double else 2.0::double * sum(n) / any_value(na + nb) end as similarity
  from seg join pr using (pid) group by pid, a, b)"""
RATIO_NP = """np as (select b.category, b.product_name as bestbuy_name, e.product_name as ebay_name, r.similarity
   from bn b join en e on b.category is not distinct from e.category
   join ratio r on r.a = lower(b.product_name) and r.b = lower(e.product_name))"""


def _recursive(sql: str) -> str:
    return sql.replace("with ", "with recursive ", 1)


def _brute(exclude: bool, cap: int | None, np: str | None = None) -> str:
    """Listing-level brute force: every retailer x marketplace listing of the
    same category, scored, filtered, ranked."""
    np = np or f"""np as (select b.category, b.product_name as bestbuy_name, e.product_name as ebay_name, {EDIT} as similarity
   from bn b join en e on b.category is not distinct from e.category)"""
    excl = ("and not exists (select 1 from matched_products m where m.ebay_listing_id = e.id "
            "and m.bestbuy_listing_id = b.id)") if exclude else ""
    sql = (O.with_views("matched_products") + ", " + L_SQL + f""",
 {np},
 c as (select b.category, b.id as bestbuy_listing_id, b.product_name as bestbuy_name, b.price as bestbuy_price,
   e.id as ebay_listing_id, e.product_name as ebay_name, e.price as ebay_price, np.similarity
   from l b join np on b.category is not distinct from np.category and b.product_name = np.bestbuy_name
   join l e on e.category is not distinct from np.category and e.product_name = np.ebay_name
   where b.source = 'bestbuy' and e.source = 'ebay' and np.similarity >= {C.MIN_SIMILARITY} {excl}),
 r as (select *, row_number() over (partition by bestbuy_listing_id order by similarity desc, ebay_listing_id) as rank
   from c qualify rank <= {C.MAX_CANDIDATES})
select * from r""")
    if cap is not None:
        sql += f" order by category asc nulls last, bestbuy_listing_id, rank limit {cap}"
    return sql


def listings(spark, sf_dir):
    return view(spark, sf_dir, "raw_listings")


def existing(spark, sf_dir):
    return view(spark, sf_dir, "matched_products")


@register("match_name_pairs", O.with_views("raw_listings") + ", " + L_SQL + f"""
select b.category, b.product_name as bestbuy_name, e.product_name as ebay_name, {BOUND} as length_bound
from bn b join en e on b.category is not distinct from e.category where {BOUND} >= {C.MIN_SIMILARITY}""")
def q_name_pairs(spark, sf_dir):
    return M.name_pairs(listings(spark, sf_dir))


@register("match_name_similarity", _recursive(O.with_views("raw_listings") + ", " + L_SQL + ", " + RATIO + ", " + RATIO_NP + f"""
select np.* from np where 2.0 * least(length(bestbuy_name), length(ebay_name)) >= 0.01 * (length(bestbuy_name) + length(ebay_name))"""))
def q_name_similarity(spark, sf_dir):
    """The difflib ratio of all distinct name pairs of a category whose lengths are within 199 times of each other."""
    pairs = M.name_pairs(listings(spark, sf_dir), min_sim=0.01)
    return pairs.select("category", "bestbuy_name", "ebay_name", difflib_similarity(F.col("bestbuy_name"), F.col("ebay_name")).alias("similarity"))


@register("match_candidates", _recursive(_brute(exclude=True, cap=None, np=RATIO + ",\n " + RATIO_NP)))
def q_candidates(spark, sf_dir):
    return M.candidates(listings(spark, sf_dir), existing(spark, sf_dir))


@register("topk_per_group", _brute(exclude=False, cap=None))
def q_topk(spark, sf_dir):
    return M.candidates(listings(spark, sf_dir), None, scorer=edit_similarity)


# Without stored pairs all listings of a name have one list, so the brute force ranks by name.
STAR_SQL = O.with_views("star_listings") + f""", l as (select id, product_name, category, source,
   case when price <> 0 then cast(price as double) end as price from star_listings where source in ('ebay', 'bestbuy')),
 bn as (select distinct category, product_name from l where source = 'bestbuy'),
 en as (select distinct category, product_name from l where source = 'ebay'),
 np as (select b.category, b.product_name as bestbuy_name, e.product_name as ebay_name, {EDIT} as similarity
   from bn b join en e on b.category is not distinct from e.category where {EDIT} >= {C.MIN_SIMILARITY}),
 e as (select * from l where source = 'ebay' qualify row_number() over (partition by category, product_name order by id) <= {C.MAX_CANDIDATES}),
 r as (select np.category, bestbuy_name, e.id as ebay_listing_id, ebay_name, e.price as ebay_price, similarity,
   row_number() over (partition by np.category, bestbuy_name order by similarity desc, e.id) as rank
   from np join e on e.category is not distinct from np.category and e.product_name = np.ebay_name qualify rank <= {C.MAX_CANDIDATES})
select r.category, l.id as bestbuy_listing_id, bestbuy_name, l.price as bestbuy_price, ebay_listing_id, ebay_name, ebay_price, similarity, rank
from l join r on l.category is not distinct from r.category and l.product_name = r.bestbuy_name where l.source = 'bestbuy'"""


@register("match_star_candidates", STAR_SQL)
def q_star(spark, sf_dir):
    """Candidates over a large vocabulary: one name per product."""
    return M.candidates(view(spark, sf_dir, "star_listings"), None, scorer=edit_similarity)


@register("match_exclude_existing", _brute(exclude=True, cap=None))
def q_exclude(spark, sf_dir):
    return M.candidates(listings(spark, sf_dir), existing(spark, sf_dir), scorer=edit_similarity)


@register("match_pair_cap", _brute(exclude=True, cap=C.MAX_PAIRS_PER_RUN))
def q_cap(spark, sf_dir):
    return M.candidates(listings(spark, sf_dir), existing(spark, sf_dir), scorer=edit_similarity, max_pairs=C.MAX_PAIRS_PER_RUN)
