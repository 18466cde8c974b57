"""Pricing questions over listing snapshots (our semantics; the behaviour
being reproduced only declares these features).

Money sums are exact decimals (prices are cents), so every average is one
division of exact totals and does not depend on summation order. Per-group
windows run over daily aggregates, so a product holding a large share of all
rows still yields at most one row per day to its window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens import constants as C
from pricelens.functions import columns as X
from pricelens.session import materialize

MONEY = "decimal(18,2)"


def _eff(df: DataFrame) -> DataFrame:
    return df.withColumn("effective_price", X.effective_price())


def daily_prices(df: DataFrame) -> DataFrame:
    """Per (product, source, day): listings, exact sum, min, max, average."""
    e = _eff(df).withColumn("day", F.to_date("scraped_at"))
    d = e.groupBy("product_name", "source", "day").agg(
        F.count(F.lit(1)).alias("listings"),
        F.sum(F.col("effective_price").cast(MONEY)).alias("price_sum"),
        F.min("effective_price").alias("min_price"),
        F.max("effective_price").alias("max_price"),
    )
    return d.withColumn("avg_price", F.col("price_sum").cast("double") / F.col("listings").cast("double"))


def price_trends(df: DataFrame, window_days: int = 7) -> DataFrame:
    """Daily avg / min / max effective price per (product, source) and a
    listing-weighted moving average over the last `window_days` daily rows."""
    d = daily_prices(df)
    w = Window.partitionBy("product_name", "source").orderBy("day").rowsBetween(-(window_days - 1), 0)
    return d.select(
        "product_name", "source", "day", "listings", "avg_price", "min_price", "max_price",
        (F.sum("price_sum").over(w).cast("double") / F.sum("listings").over(w).cast("double"))
        .alias("moving_avg_price"),
    )


def latest_prices(df: DataFrame) -> DataFrame:
    """Latest effective price per (product, source); ties on time -> higher id."""
    e = _eff(df)
    return e.groupBy("product_name", "source").agg(
        F.max_by("effective_price", F.struct(F.col("scraped_at"), F.col("id"))).alias("latest_price"))


def cheapest_source(df: DataFrame) -> DataFrame:
    """Per product: the source with the lowest latest price (ties -> source
    name), that price, the highest latest price and the gap."""
    lp = latest_prices(df)
    return lp.groupBy("product_name").agg(
        F.min_by("source", F.struct(F.col("latest_price"), F.col("source"))).alias("cheapest_source"),
        F.min("latest_price").alias("cheapest_price"),
        F.max("latest_price").alias("highest_price"),
        F.count(F.lit(1)).alias("sources"),
    ).withColumn("price_gap", F.col("highest_price") - F.col("cheapest_price"))


def discount_frequency(df: DataFrame) -> DataFrame:
    """Per (category, source): share of listings on sale and the average
    positive discount percentage."""
    d = df.withColumn("discount_pct", X.discount_pct())
    pos = F.col("discount_pct") > 0
    g = d.groupBy("category", "source").agg(
        F.count(F.lit(1)).alias("listings"),
        F.count_if(F.coalesce(F.col("on_sale"), F.lit(False))).alias("on_sale_listings"),
        F.sum(F.when(pos, F.col("discount_pct").cast("decimal(12,2)"))).alias("_dsum"),
        F.count_if(pos).alias("discounted_listings"),
    )
    return g.select(
        "category", "source", "listings", "on_sale_listings", "discounted_listings",
        (F.col("on_sale_listings").cast("double") / F.col("listings").cast("double")).alias("on_sale_share"),
        (F.col("_dsum").cast("double") / F.col("discounted_listings").cast("double")).alias("avg_discount_pct"),
    )


def price_history(df: DataFrame, as_of: str, days: int = 30, names: DataFrame | None = None,
                  name: str | None = None) -> DataFrame:
    """Snapshots in [as_of - days, as_of], optionally for one product `name`
    or the names of a watchlist DataFrame. `as_of` is a parameter; nothing
    here reads the clock."""
    hi = F.lit(as_of).cast("timestamp_ntz")
    lo = hi - F.make_dt_interval(F.lit(days))
    out = df.filter((F.col("scraped_at") >= lo) & (F.col("scraped_at") <= hi))
    if name is not None:
        out = out.filter(F.col("product_name") == name)
    if names is not None:
        out = watchlist(out, names)
    return _eff(out).select("id", "product_name", "source", "scraped_at", "price", "sale_price",
                            "on_sale", "effective_price")


def with_baseline(df: DataFrame, lookback_days: int = C.ANOMALY_LOOKBACK_DAYS, min_obs: int = C.ANOMALY_MIN_OBS) -> DataFrame:
    """Every snapshot with day, effective_price, and the number, mean and sample std
    of the effective prices of its product and source over the `lookback_days`
    days before its day (NULL with fewer than `min_obs`).

    Baseline = exact count / sum / sum of squares per day, summed over a
    day-range window."""
    e = _eff(df).withColumn("day", F.to_date("scraped_at"))
    p = F.col("effective_price").cast(MONEY)
    daily = e.groupBy("product_name", "source", "day").agg(
        F.count(F.lit(1)).alias("n"), F.sum(p).alias("s1"), F.sum(p * p).alias("s2"))
    daily = daily.withColumn("dn", F.datediff("day", F.lit("1970-01-01").cast("date")))
    w = Window.partitionBy("product_name", "source").orderBy("dn").rangeBetween(-lookback_days, -1)
    base = daily.select(
        "product_name", "source", "day",
        F.sum("n").over(w).alias("bn"), F.sum("s1").over(w).alias("bs1"), F.sum("s2").over(w).alias("bs2"))
    base = base.filter(F.col("bn") >= min_obs)
    mean = F.col("bs1").cast("double") / F.col("bn").cast("double")
    var = ((F.col("bn").cast("decimal(38,0)") * F.col("bs2") - F.col("bs1") * F.col("bs1")).cast("double")
           / (F.col("bn") * (F.col("bn") - 1)).cast("double"))
    base = base.select("product_name", "source", "day", F.col("bn").alias("baseline_n"),
                       mean.alias("baseline_mean"), F.sqrt(var).alias("baseline_std"))
    # One row per (product, source, day) with a baseline, all from aggregates;
    # AQE broadcasts it when its measured bytes allow and splits a hot day otherwise.
    return e.join(base, ["product_name", "source", "day"], "left")


def price_anomalies(df: DataFrame, lookback_days: int = C.ANOMALY_LOOKBACK_DAYS,
                    min_obs: int = C.ANOMALY_MIN_OBS, z: float = C.ANOMALY_Z,
                    flagged_only: bool = True) -> DataFrame:
    """z-score of each snapshot's effective price against the same product
    and source over the `lookback_days` days before its day (`with_baseline`).

    A statistical baseline; the isolation forest that the feature was announced
    with is `operators.isolation`, our own too. z is NULL with fewer than `min_obs`
    observations or zero spread. Every snapshot is returned; without enough
    observations its baseline columns are NULL too.
    """
    j = with_baseline(df, lookback_days, min_obs)
    zs = F.when(F.col("baseline_std") > 0,
                (F.col("effective_price") - F.col("baseline_mean")) / F.col("baseline_std"))
    out = j.select("id", "product_name", "source", "scraped_at", "effective_price", "baseline_n",
                   "baseline_mean", "baseline_std", zs.alias("z_score"))
    out = out.withColumn("is_anomaly", F.coalesce(F.abs(F.col("z_score")) > z, F.lit(False)))
    return out.filter("is_anomaly") if flagged_only else out


def watchlist(df: DataFrame, names: DataFrame, name_col: str = "product_name") -> DataFrame:
    """Listings whose product name is on the watchlist (semi join; AQE
    broadcasts the distinct list by its measured bytes or splits a hot name)."""
    wl = names.select(F.col(name_col).alias("product_name")).distinct()
    return df.join(wl, "product_name", "left_semi")


def accepted_names(matches: DataFrame) -> DataFrame:
    """Canonical names of accepted matches (a derived watchlist)."""
    return (matches.filter(F.col("is_match") & (F.col("confidence_score") >= C.CONFIDENCE_THRESHOLD))
                   .select(F.col("canonical_name").alias("product_name")).distinct())


def price_model_frame(df: DataFrame) -> DataFrame:
    """Daily rows with lag features for the price model."""
    d = daily_prices(df)
    w = Window.partitionBy("product_name", "source").orderBy("day")
    w7 = w.rowsBetween(-7, -1)
    return d.select(
        "product_name", "source", "day", "avg_price",
        F.lag("avg_price", 1).over(w).alias("prev_price"),
        (F.sum("price_sum").over(w7).cast("double") / F.sum("listings").over(w7).cast("double")).alias("prev7_price"),
        F.dayofweek("day").cast("double").alias("dow"),
        F.month("day").cast("double").alias("month"),
        (F.col("source") == C.SOURCE_MARKETPLACE).cast("double").alias("is_marketplace"),
    ).dropna(subset=["prev_price", "prev7_price"])


def fit_price_model(df: DataFrame, cutoff: str, max_iter: int = 10, max_depth: int = 4, seed: int = 42):
    """Gradient-boosted trees on lag features; train on days before `cutoff`,
    predict the rest. Re-aimed: our model, not one the reference ships.
    Returns (model, predictions DataFrame)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    frame, _ = materialize(price_model_frame(df), "price_frame")  # read by the fit's passes and by the prediction
    feats = ["prev_price", "prev7_price", "dow", "month", "is_marketplace"]
    asm = VectorAssembler(inputCols=feats, outputCol="features")
    gbt = GBTRegressor(featuresCol="features", labelCol="avg_price", maxIter=max_iter,
                       maxDepth=max_depth, seed=seed)
    cut = F.lit(cutoff).cast("date")
    model = Pipeline(stages=[asm, gbt]).fit(frame.filter(F.col("day") < cut))
    pred = model.transform(frame.filter(F.col("day") >= cut))
    return model, pred.select("product_name", "source", "day", "avg_price", "prediction")
