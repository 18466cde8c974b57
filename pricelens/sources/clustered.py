"""Listing table clustered by day and name, with a file index that scans are cut by.

The rows are range-partitioned and sorted by (day, product name), so a file
holds a narrow range of both. Beside the files lies an index of a row per file:
its rows and the least and greatest day and name. A scan for days or a name first
picks the files whose ranges meet it and opens no others; the filters are still
applied to the rows. A product or day that holds a third of all rows is cut over
several files by time and id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.sources.versions import publish, read_published, resolve

def _day() -> Column:
    return F.to_date("scraped_at")


def write_clustered(df: DataFrame, root: str, files: int | None = None) -> int:
    """Publish `df` as the clustered table of `root`, with its index; the rows written.

    `files`: files to write; by default as many as the shuffle gives."""
    spark = df.sparkSession
    keys = [F.col("_day").asc_nulls_first(), "product_name", F.col("scraped_at").asc_nulls_first(), "id"]
    rows = df.withColumn("_day", _day())
    rows = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    written = publish(spark, root, {"listings": rows.sortWithinPartitions(*keys).drop("_day")})["listings"]
    table = read_published(spark, root, "listings")
    index = table.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(_day()).alias("first_day"), F.max(_day()).alias("last_day"),
        F.count_if(_day().isNull()).alias("dayless"), F.min("product_name").alias("first_name"), F.max("product_name").alias("last_name"))
    publish(spark, root, {"listing_files": index})
    return written


def files_for(spark: SparkSession, root: str, first_day=None, last_day=None, name: str | None = None) -> list[str]:
    """Files that may hold rows of the days (both included) and the name."""
    index = read_published(spark, root, "listing_files")
    keep: Column = F.lit(True)
    if first_day is not None:
        keep = keep & (F.col("last_day") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        keep = keep & (F.col("first_day") <= F.lit(last_day).cast("date"))
    if name is not None:
        keep = keep & F.lit(name).between(F.col("first_name"), F.col("last_name"))
    folder = resolve(spark, root, "listings")
    # As many rows as files that are going to be read.
    return sorted(f"{folder}/{r['file']}" for r in index.where(keep).select("file").toLocalIterator())


def read_clustered(spark: SparkSession, root: str, first_day=None, last_day=None, name: str | None = None) -> DataFrame:
    """Rows of the days and the name, from the files that may hold them."""
    files = files_for(spark, root, first_day, last_day, name)
    schema = read_published(spark, root, "listings").schema
    out = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    if first_day is not None:
        out = out.where(_day() >= F.lit(first_day).cast("date"))
    if last_day is not None:
        out = out.where(_day() <= F.lit(last_day).cast("date"))
    return out if name is None else out.where(F.col("product_name") == name)
