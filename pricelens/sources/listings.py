"""Listing sources and sinks (Parquet, JSON files, JDBC).

Every write is a distributed DataFrame write; nothing is collected to the
driver. Schemas are declared (`pricelens.schemas`), never inferred.
"""

from __future__ import annotations

import logging
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens import schemas as S
from pricelens.sources.batches import write_batch
from pricelens.sources.json_arrays import read_json_arrays
from pricelens.sources.versions import path_exists, publish, published, read_published

log = logging.getLogger(__name__)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project `df` onto `schema`: cast present columns, add missing ones as
    typed NULLs, drop the rest, keep the declared order."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetchsize: int = 10_000) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


def partitioned_jdbc_options(base: dict[str, str], column: str, lower: int, upper: int,
                             num_partitions: int) -> dict[str, str]:
    """Options for a parallel JDBC scan: `num_partitions` range queries on
    `column` instead of one single-partition whole-table query."""
    return {**base, "partitionColumn": column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(num_partitions)}


def read_listings(spark: SparkSession, path: str | None = None, jdbc: dict | None = None,
                  num_partitions: int = 8, id_bounds: tuple[int, int] | None = None) -> DataFrame:
    """Scan the listing table from Parquet (`path`) or JDBC (`jdbc` options).

    JDBC reads are split on `id` into `num_partitions` ranges; the bounds are
    taken from `id_bounds` or from one min/max query.
    """
    if path is not None:
        # Rows with ids of their own lie at the root, batches in folders
        # batch=<number>: the recursive look-up reads both.
        files = spark.read.schema(S.RAW_LISTING).option("recursiveFileLookup", True)
        return conform(files.parquet(path), S.RAW_LISTING)
    if jdbc is None:
        raise ValueError("read_listings needs a path or jdbc options")
    if id_bounds is None:
        b = (spark.read.format("jdbc")
             .options(**{**jdbc, "dbtable": f"(select min(id) as lo, max(id) as hi from {jdbc['dbtable']}) b"})
             .load().first())
        id_bounds = (int(b[0] or 0), int(b[1] or 0))
    opts = partitioned_jdbc_options(jdbc, "id", id_bounds[0], id_bounds[1] + 1, num_partitions)
    return conform(spark.read.format("jdbc").options(**opts).load(), S.RAW_LISTING)


def _bytes(size: str) -> int:
    """A size setting ("134217728b", "128m", "3000") in bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", size.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit[:1]]


def read_listing_json(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Listing records from JSON-array files; missing files are skipped with
    a warning. on_sale defaults to false, a missing payload to '{}', times
    with an offset are normalised to UTC."""
    present = []
    for p in paths:
        if path_exists(spark, p):
            present.append(p)
        else:
            log.warning("listing file not found, skipped: %s", p)
    if not present:
        return spark.createDataFrame([], S.LISTING_JSON)
    # Spark's reader takes a whole file in one task; a file beyond one split is cut.
    largest = spark.read.format("binaryFile").load(present).agg(F.max("length")).first()[0]
    if (largest or 0) > _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")):
        df = read_json_arrays(spark, present, S.LISTING_JSON)
    else:
        df = spark.read.schema(S.LISTING_JSON).option("multiLine", True).json(present)
    return listing_records(spark, df)


def listing_records(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Listing records as read from JSON, with defaults and times in UTC."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    ts = F.convert_timezone(F.lit(tz), F.lit("UTC"), F.to_timestamp("scraped_at").cast("timestamp_ntz"))
    return df.select(
        "product_name", "price", "sale_price",
        F.coalesce(F.col("on_sale"), F.lit(False)).alias("on_sale"),
        "source", "url", "category", "brand", "sku", ts.alias("scraped_at"),
        F.coalesce(F.col("raw_payload"), F.lit("{}")).alias("raw_payload"),
    )


def append_listings(df: DataFrame, target: str, batch_ts=None, id_offset: int | None = None,
                    fmt: str = "parquet", batch_key: str | None = None) -> int | None:
    """Append a batch to the listing table in one job (the commit protocol
    publishes all task files together or none).

    `batch_ts` stamps every row (the ingest time); when None the rows keep
    their own scraped_at. Rows without an id get one from the batch ledger
    (`sources.batches`): unique in the table, and the same again when the batch
    named `batch_key` is replayed, which adds nothing. Without a key the
    batch is new at every call. With `id_offset` the caller numbers the rows himself,
    from there on. Returns the rows added where the ledger was asked.
    """
    out = df
    if batch_ts is not None:
        out = out.withColumn("scraped_at", F.lit(batch_ts).cast("timestamp_ntz"))
    if "id" not in out.columns and id_offset is None:
        rows = conform(out.withColumn("id", F.lit(0)), S.RAW_LISTING)
        return write_batch(rows, target, batch_key or f"call:{uuid.uuid4().hex}", fmt)
    if "id" not in out.columns:
        out = out.withColumn("id", F.monotonically_increasing_id() + F.lit(id_offset))
    conform(out, S.RAW_LISTING).write.mode("append").format(fmt).save(target)


def archive_raw(df: DataFrame, root: str | None, source: str, ingest_ts: str) -> str | None:
    """Keep the raw records as JSON under root/raw/source=<s>/ingest_ts=<t>.

    Skipped (None) when no root is configured; a failed archive is logged and
    does not fail the ingest.
    """
    if not root:
        log.warning("no archive root configured, raw archive skipped")
        return None
    path = f"{root.rstrip('/')}/raw/source={source}/ingest_ts={ingest_ts}"
    try:
        df.write.mode("errorifexists").json(path)
        return path
    except Exception:  # noqa: BLE001 - archive is best effort
        log.exception("raw archive failed: %s", path)
        return None


def write_clean(df: DataFrame, root: str, run_date: str, fallback: str | None = None) -> str:
    """Write the clean contract as Parquet under root/date=<run_date>.

    Dynamic partition overwrite: a re-run on the same date replaces only that
    date. If the primary write fails and `fallback` is given, write there.
    """
    out = df.withColumn("date", F.lit(run_date))

    def _write(path: str) -> str:
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("date").parquet(path))
        return f"{path.rstrip('/')}/date={run_date}"

    try:
        return _write(root)
    except Exception:
        if fallback is None:
            raise
        log.exception("clean write to %s failed, writing to fallback %s", root, fallback)
        return _write(fallback)


CLEAN_WITH_DATE = T.StructType(S.CLEAN_LISTING.fields + [T.StructField("date", T.StringType(), True)])


def read_clean(spark: SparkSession, root: str, run_date: str | None = None) -> DataFrame:
    df = spark.read.schema(CLEAN_WITH_DATE).parquet(root)
    return df if run_date is None else df.filter(F.col("date") == run_date)


def stage_listings(raw: DataFrame) -> DataFrame:
    """Warehouse load copy of the listing table: 12 columns, float prices,
    on_sale NULL -> false, payload as JSON text, clustered by time within
    each output file."""
    payload = F.col("raw_payload") if "raw_payload" in raw.columns else F.lit(None)
    return raw.select(
        F.col("id").cast("bigint").alias("id"), "product_name",
        F.col("price").cast("double").alias("price"), F.col("sale_price").cast("double").alias("sale_price"),
        F.coalesce(F.col("on_sale"), F.lit(False)).alias("on_sale"), "source", "url", "category",
        "brand", "sku", F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"),
        payload.cast("string").alias("raw_payload"),
    ).sortWithinPartitions("scraped_at")


def stage_matched(matched: DataFrame) -> DataFrame:
    """Warehouse load copy of the verdict table (9 columns)."""
    return matched.select(
        F.col("id").cast("bigint").alias("id"), "ebay_listing_id", "bestbuy_listing_id", "canonical_name",
        "brand", "model_number", F.col("confidence_score").cast("double").alias("confidence_score"),
        F.coalesce(F.col("is_match"), F.lit(False)).alias("is_match"),
        F.col("matched_at").cast("timestamp_ntz").alias("matched_at"),
    )


def replace_table(df: DataFrame, target: str, schema: T.StructType | None = None,
                  skip_if_empty: bool = True, fmt: str = "parquet") -> int:
    """Truncate-and-load `target` with `df` (conformed to `schema`).

    An empty input leaves the target untouched (returns 0). The row count
    comes from an observation of the write itself, not a second scan.
    """
    from pyspark.sql import Observation

    if skip_if_empty and df.isEmpty():
        log.warning("empty input, %s left unchanged", target)
        return 0
    out = conform(df, schema) if schema is not None else df
    obs = Observation("replace_table")
    out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(target)
    return int(obs.get["rows"])


def write_sample_json(df: DataFrame, path: str, n: int = 10, order: str = "id") -> None:
    """First `n` rows (by `order`) as JSON, for hand inspection."""
    df.orderBy(order).limit(n).coalesce(1).write.mode("overwrite").json(path)


def reload_tables(listings: DataFrame, listings_target: str, matches_target: str | None = None,
                  fmt: str = "parquet") -> int:
    """Clear-and-reload: empty the verdict table first (its rows point at
    listing ids that are about to change), then replace the listings."""
    spark = listings.sparkSession
    if matches_target is not None:
        spark.createDataFrame([], S.MATCHED_PRODUCT).write.mode("overwrite").format(fmt).save(matches_target)
    return replace_table(listings, listings_target, S.RAW_LISTING, skip_if_empty=False, fmt=fmt)


WAREHOUSE_TABLES = ("raw_listings", "raw_matched_products", "stg_listings", "stg_matched", "dim_product", "dim_source",
                    "dim_time", "dim_category", "fact_price_snapshot")


def reload_published(listings: DataFrame, root: str) -> dict[str, int]:
    """`reload_tables` for a root of published versions: the emptied verdict
    table and the new listings become current in one step, or neither does."""
    spark = listings.sparkSession
    return publish(spark, root, {"matched_products": spark.createDataFrame([], S.MATCHED_PRODUCT),
                                 "raw_listings": conform(listings, S.RAW_LISTING)})


def register_warehouse_views(spark: SparkSession, root: str) -> list[str]:
    """Temp views over the warehouse tables so they can be queried with SQL by
    name: the published ones, and those written as plain folders; tables not
    written yet are skipped."""
    names = []
    current = set(published(spark, root))
    for name in WAREHOUSE_TABLES:
        if name in current:
            read_published(spark, root, name).createOrReplaceTempView(name)
            names.append(name)
            continue
        path = f"{root.rstrip('/')}/{name}"
        if path_exists(spark, path):
            spark.read.parquet(path).createOrReplaceTempView(name)
            names.append(name)
    return names


def append_matches(valid: DataFrame, target: str, matched_at, fmt: str = "parquet") -> None:
    """Append validated verdicts (one row per scored pair) to the verdict
    table, stamped with the run time. Ids are a deterministic hash of the
    pair and the stamp, so a retried write produces the same rows."""
    stamp = F.lit(matched_at).cast("timestamp_ntz")
    rows = valid.select(
        F.xxhash64("ebay_listing_id", "bestbuy_listing_id", stamp).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF)).alias("id"),
        "ebay_listing_id", "bestbuy_listing_id", "canonical_name", "brand", "model_number",
        F.col("confidence").alias("confidence_score"), "is_match", stamp.alias("matched_at"))
    conform(rows, S.MATCHED_PRODUCT).write.mode("append").format(fmt).save(target)
