"""Counts, distinct values, unions and head / sampled extracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens import constants as C
from pricelens.operators.clean import DEDUP_KEYS


def count_by(df: DataFrame, *cols: str, name: str = "listings") -> DataFrame:
    """Row count per group (partial aggregation before the shuffle)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def clean_counts(raw: DataFrame) -> DataFrame:
    """Input / after-dedup / removed / output counts of the clean job.

    Dedup keeps one row per (name, source, price) group and the price filter
    is on a group key, so every counter follows from one partial-aggregated
    group count: no window, no hot task for a heavy key.
    """
    g = raw.groupBy(*DEDUP_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(
        F.sum("n").cast("bigint").alias("input_rows"),
        F.count(F.lit(1)).alias("dedup_rows"),
        (F.sum("n") - F.count(F.lit(1))).cast("bigint").alias("removed_duplicates"),
        F.count_if(F.col("price") > 0).alias("output_rows"),
    )


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """(column, value) rows: the distinct values of each column, in one pass over `df`."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.inline(cells)).distinct()


def category_source_pivot(df: DataFrame) -> DataFrame:
    """Per category, listings from each source (NULL category is a group)."""
    return df.groupBy("category").agg(
        F.count_if(F.col("source") == C.SOURCE_MARKETPLACE).alias("ebay_listings"),
        F.count_if(F.col("source") == C.SOURCE_RETAILER).alias("bestbuy_listings"),
    )


def source_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.count_if(F.col("source") == C.SOURCE_MARKETPLACE).alias("ebay_listings"),
        F.count_if(F.col("source") == C.SOURCE_RETAILER).alias("bestbuy_listings"),
    )


def union_feeds(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name; duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def sample_extract(df: DataFrame, n: int = 10, order: str = "id") -> DataFrame:
    """First `n` rows by `order` (a top-n: partial limits per task, then one merge)."""
    return df.orderBy(F.col(order).asc_nulls_last()).limit(n)


def random_subset(df: DataFrame, n: int, seed: int = 42, key: str = "id") -> DataFrame:
    """A reproducible pseudo-random `n`-row subset: the `n` smallest
    md5(key:seed) values. Same rows on every run and every engine."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
