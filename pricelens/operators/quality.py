"""Column-level data-quality checks; each returns one row per checked column
with the number of failing rows (0 = pass)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _result(df: DataFrame, check: str, table: str, column: str, failures) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                     F.lit(column).alias("column_name"), failures.cast("bigint").alias("failures"))


def check_unique(df: DataFrame, col: str, table: str = "") -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    dup = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.count_if(F.col("n") > 1).alias("f")))
    return _result(dup, "unique", table, col, F.col("f"))


def check_not_null(df: DataFrame, cols: list[str], table: str = "") -> DataFrame:
    """NULL counts for all `cols` in one pass over `df`."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit("not_null").alias("check_name"), F.lit(table).alias("table_name"),
                              F.lit(c).alias("column_name"), F.col(f"n{i}").cast("bigint").alias("failures"))
                     for i, c in enumerate(cols)])
    return agg.select(F.inline(rows))


def check_reference(child: DataFrame, col: str, parent: DataFrame, key: str,
                    table: str = "") -> DataFrame:
    """Child rows whose non-NULL `col` has no `key` in `parent` (orphans)."""
    keys = parent.select(F.col(key).alias("_k")).distinct()
    orphans = (child.filter(F.col(col).isNotNull()).select(F.col(col).alias("_k"))
                    .join(keys, "_k", "left_anti").agg(F.count(F.lit(1)).alias("f")))
    return _result(orphans, "relationships", table, col, F.col("f"))


def check_references(child: DataFrame, cols: list[str], parent: DataFrame, key: str, table: str = "") -> DataFrame:
    """`check_reference` for several columns that point at one parent key, in one scan
    of each table and one shuffle: keys of both sides are grouped together, and
    a key's child rows are orphans where no parent row has it. Both sides are
    combined before the shuffle, so a hot key costs one row per task."""
    n = len(cols)
    entries = F.array(*[F.struct(F.col(c).alias("_k"), F.lit(i).alias("_i")) for i, c in enumerate(cols)])
    rows = (child.select(F.explode(entries).alias("e")).select("e._k", "e._i", F.lit(False).alias("_p"))
            .unionByName(parent.select(F.col(key).alias("_k"), F.lit(-1).alias("_i"), F.lit(True).alias("_p"))).filter(F.col("_k").isNotNull()))
    keys = rows.groupBy("_k").agg(F.max("_p").alias("_p"), *[F.count_if(F.col("_i") == i).alias(f"n{i}") for i in range(n)])
    sums = keys.filter(~F.col("_p")).agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(n)])
    out = F.array(*[F.struct(F.lit("relationships").alias("check_name"), F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                             F.col(f"n{i}").cast("bigint").alias("failures")) for i, c in enumerate(cols)])
    return sums.select(F.inline(out))


def check_uniques(df: DataFrame, cols: list[str], table: str = "") -> DataFrame:
    """`check_unique` for several columns in one scan and one shuffle."""
    entries = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("string").alias("_k")) for i, c in enumerate(cols)])
    counts = (df.select(F.explode(entries).alias("e")).select("e._i", "e._k").filter(F.col("_k").isNotNull())
              .groupBy("_i", "_k").agg(F.count(F.lit(1)).alias("n")))
    sums = counts.agg(*[F.count_if((F.col("_i") == i) & (F.col("n") > 1)).alias(f"n{i}") for i in range(len(cols))])
    out = F.array(*[F.struct(F.lit("unique").alias("check_name"), F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                             F.col(f"n{i}").cast("bigint").alias("failures")) for i, c in enumerate(cols)])
    return sums.select(F.inline(out))


def union_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
