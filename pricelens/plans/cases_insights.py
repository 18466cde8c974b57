"""Insight queries over the clean star listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelens import constants as C
from pricelens.fixture import view
from pricelens.operators import insights as I
from pricelens.operators.isolation import price_features, price_isolation
from pricelens.plans import oracle as O
from pricelens.plans.registry import register
from pricelens.session import scratch_path
from pricelens.sources.clustered import read_clustered, write_clustered

STAR = O.with_views("star_listings")
EFF = f"""e as (select *, {O.eff_sql()} as effective_price from star_listings)"""

AS_OF = "1998-06-01 00:00:00"
CUTOFF = "1997-01-01"


def star(spark, sf_dir):
    return view(spark, sf_dir, "star_listings")


@register("price_trends", STAR + ", " + EFF + """,
 d as (select product_name, source, cast(scraped_at as date) as day, count(*) as listings,
   sum(cast(effective_price as decimal(18,2))) as price_sum, min(effective_price) as min_price,
   max(effective_price) as max_price from e group by all)
select product_name, source, day, listings, cast(price_sum as double) / cast(listings as double) as avg_price,
 min_price, max_price,
 cast(sum(price_sum) over w as double) / cast(sum(listings) over w as double) as moving_avg_price
from d window w as (partition by product_name, source order by day rows between 6 preceding and current row)""")
def q_trends(spark, sf_dir):
    return I.price_trends(star(spark, sf_dir))


@register("cheapest_source", STAR + ", " + EFF + """,
 lp as (select product_name, source, effective_price as latest_price from e
   qualify row_number() over (partition by product_name, source order by scraped_at desc, id desc) = 1)
select product_name,
 arg_min(source, struct_pack(p := latest_price, s := source)) as cheapest_source,
 min(latest_price) as cheapest_price, max(latest_price) as highest_price, count(*) as sources,
 max(latest_price) - min(latest_price) as price_gap
from lp group by product_name""")
def q_cheapest(spark, sf_dir):
    return I.cheapest_source(star(spark, sf_dir))


@register("discount_frequency", STAR + """,
 d as (select category, source, on_sale, case when sale_price is not null and price > 0
   then round((price - sale_price) / price * 100, 2) else 0.0 end as discount_pct from star_listings)
select category, source, count(*) as listings, count(*) filter (where coalesce(on_sale, false)) as on_sale_listings,
 count(*) filter (where discount_pct > 0) as discounted_listings,
 cast(count(*) filter (where coalesce(on_sale, false)) as double) / cast(count(*) as double) as on_sale_share,
 cast(sum(cast(discount_pct as decimal(12,2))) filter (where discount_pct > 0) as double)
   / cast(count(*) filter (where discount_pct > 0) as double) as avg_discount_pct
from d group by category, source""")
def q_discount(spark, sf_dir):
    return I.discount_frequency(star(spark, sf_dir))


@register("price_history_30d", STAR + ", " + EFF + f"""
select id, product_name, source, scraped_at, price, sale_price, on_sale, effective_price from e
where scraped_at >= timestamp '{AS_OF}' - interval 30 day and scraped_at <= timestamp '{AS_OF}'""")
def q_history(spark, sf_dir):
    return I.price_history(star(spark, sf_dir), AS_OF, 30)


@register("price_history_by_name", STAR + ", " + EFF + f"""
select id, product_name, source, scraped_at, price, sale_price, on_sale, effective_price from e
where product_name = (select min(product_name) from e where scraped_at >= timestamp '{AS_OF}' - interval 400 day and scraped_at <= timestamp '{AS_OF}')
 and scraped_at >= timestamp '{AS_OF}' - interval 400 day and scraped_at <= timestamp '{AS_OF}'""")
def q_history_by_name(spark, sf_dir):
    """One product's snapshots, from the files of the clustered table that may hold them."""
    root = scratch_path(spark, "clustered")
    write_clustered(star(spark, sf_dir), root)
    first, last = "1997-04-27", AS_OF[:10]
    name = I.price_history(read_clustered(spark, root, first, last), AS_OF, 400).agg(F.min("product_name")).first()[0]
    return I.price_history(read_clustered(spark, root, first, last, name), AS_OF, 400, name=name)


RAW_EFF = O.with_views("raw_listings") + f""", e as (select *, {O.eff_sql()} as effective_price from raw_listings)"""


# Scored on the raw listings (dense per product and source); every snapshot
# with a baseline is returned with its flag.
@register("price_anomalies", RAW_EFF + f""",
 d as (select product_name, source, cast(scraped_at as date) as day, count(*) as n,
   sum(cast(effective_price as decimal(18,2))) as s1,
   sum(cast(effective_price as decimal(18,2)) * cast(effective_price as decimal(18,2))) as s2
   from e group by all),
 b as (select product_name, source, day,
   sum(n) over w as bn, sum(s1) over w as bs1, sum(s2) over w as bs2 from d
   window w as (partition by product_name, source order by datediff('day', date '1970-01-01', day)
     range between {C.ANOMALY_LOOKBACK_DAYS} preceding and 1 preceding)),
 b2 as (select product_name, source, day, cast(bn as bigint) as baseline_n, cast(bs1 as double) / cast(bn as double) as baseline_mean,
   sqrt(cast(cast(bn as decimal(38,0)) * bs2 - bs1 * bs1 as double) / cast(bn * (bn - 1) as double)) as baseline_std
   from b where bn >= {C.ANOMALY_MIN_OBS}),
 z as (select e.id, e.product_name, e.source, e.scraped_at, e.effective_price, b2.baseline_n, b2.baseline_mean,
   b2.baseline_std, case when b2.baseline_std > 0 then (e.effective_price - b2.baseline_mean) / b2.baseline_std end as z_score
   from e left join b2 on e.product_name = b2.product_name and e.source = b2.source and cast(e.scraped_at as date) = b2.day)
select *, coalesce(abs(z_score) > {C.ANOMALY_Z}, false) as is_anomaly from z""")
def q_anomalies(spark, sf_dir):
    return I.price_anomalies(view(spark, sf_dir, "raw_listings"), flagged_only=False)


@register("watchlist_listings", O.with_views("raw_listings", "matched_products") + f"""
select * from raw_listings where product_name in (select canonical_name from matched_products
  where is_match and confidence_score >= {C.CONFIDENCE_THRESHOLD})""")
def q_watchlist(spark, sf_dir):
    names = I.accepted_names(view(spark, sf_dir, "matched_products"))
    return I.watchlist(view(spark, sf_dir, "raw_listings"), names)


@register("price_isolation")
def q_isolation(spark, sf_dir):
    """Isolation scores of all snapshots (our model; held against a plain scorer in the tests)."""
    return price_isolation(view(spark, sf_dir, "raw_listings"))


@register("price_features", RAW_EFF + f""",
 d as (select product_name, source, cast(scraped_at as date) as day, count(*) as n,
   sum(cast(effective_price as decimal(18,2))) as s1 from e group by all),
 b as (select product_name, source, day, sum(n) over w as bn, sum(s1) over w as bs1,
   lag(cast(s1 as double) / cast(n as double)) over (partition by product_name, source order by day) as prev from d
   window w as (partition by product_name, source order by datediff('day', date '1970-01-01', day)
     range between {C.ANOMALY_LOOKBACK_DAYS} preceding and 1 preceding)),
 m as (select *, case when bn >= {C.ANOMALY_MIN_OBS} then cast(bs1 as double) / cast(bn as double) end as mean from b)
select e.id, e.product_name, e.source, e.scraped_at, effective_price,
 coalesce(case when mean > 0 then effective_price / mean end, 1.0) as price_ratio,
 coalesce(case when price > 0 then 1.0 - effective_price / price end, 0.0) as discount_share,
 coalesce(case when prev > 0 then effective_price / prev end, 1.0) as step_ratio
from e left join m on e.product_name = m.product_name and e.source = m.source and cast(e.scraped_at as date) = m.day""")
def q_price_features(spark, sf_dir):
    return price_features(view(spark, sf_dir, "raw_listings"))


@register("price_model_frame", STAR + ", " + EFF + """,
 d as (select product_name, source, cast(scraped_at as date) as day, count(*) as n, sum(cast(effective_price as decimal(18,2))) as s
   from e group by all),
 f as (select product_name, source, day, cast(s as double) / cast(n as double) as avg_price,
   lag(cast(s as double) / cast(n as double)) over w as prev_price,
   cast(sum(s) over (w rows between 7 preceding and 1 preceding) as double)
    / cast(sum(n) over (w rows between 7 preceding and 1 preceding) as double) as prev7_price,
   cast(dayofweek(day) + 1 as double) as dow, cast(month(day) as double) as month,
   case when source = 'ebay' then 1.0::double else 0.0::double end as is_marketplace
   from d window w as (partition by product_name, source order by day))
select * from f where prev_price is not null and prev7_price is not null""")
def q_model_frame(spark, sf_dir):
    """The lag features that the price model learns from."""
    return I.price_model_frame(star(spark, sf_dir))


@register("price_prediction")
def q_prediction(spark, sf_dir):
    _, pred = I.fit_price_model(star(spark, sf_dir), CUTOFF)
    return pred
