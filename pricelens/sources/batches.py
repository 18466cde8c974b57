"""Batches of the listing table: unique ids, and replays that add nothing.

A batch has a key (its ingest time, its files, or its stream and micro-batch). A
ledger beside the table gives every key a number of its own, and a row's id is

    batch number << 36 | place of the row in its batch, ordered by content

so ids of batches never meet, however they were landed, and the same batch gets the
same ids again. A batch is written into a folder that its number names, and the
ledger records it as done afterwards: a replay of a done batch is skipped,
one of a batch that failed half-way rewrites its folder with the same rows.

The ledger is a folder of small files,

    <table>/_ledger/batch=<number>/   claim: the key that holds the number
    <table>/_done/batch=<number>/     the batch is written: key and rows

A number is claimed by writing its folder, which fails if it is there; the
claim is then read back, and a batch that finds another key in it tries the next
number. Spark's readers leave out folders that begin with an underscore.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import schemas as S
from pricelens.operators.numbering import number_rows
from pricelens.session import materialize
from pricelens.sources.versions import path_exists

ROW_BITS = 36
BATCH_BITS = 63 - ROW_BITS
CLAIM = "key string"
DONE = "key string, rows long"


def _holder(spark: SparkSession, path: str) -> str | None:
    """The key that a claim names; the least where two were written at once."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(CLAIM).json(path).agg(F.min("key")).first()[0]


def claim_number(spark: SparkSession, target: str, key: str, bits: int = BATCH_BITS) -> int:
    """The number of the batch `key`: its hash, or the next free number behind it."""
    size = 1 << bits
    first = int.from_bytes(hashlib.sha256(key.encode()).digest()[:8], "big") % size
    for step in range(size):
        number = (first + step) % size
        path = f"{target.rstrip('/')}/_ledger/batch={number}"
        holder = _holder(spark, path)
        if holder is None:
            try:
                spark.createDataFrame([(key,)], CLAIM).coalesce(1).write.mode("errorifexists").json(path)
            except AnalysisException as e:  # someone else was first
                if e.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
            holder = _holder(spark, path)
        if holder == key:
            return number
    raise RuntimeError("the listing table has no free batch number")


def is_done(spark: SparkSession, target: str, number: int) -> bool:
    path = f"{target.rstrip('/')}/_done/batch={number}"
    # A write that was cut short leaves a folder without a row.
    return path_exists(spark, path) and not spark.read.schema(DONE).json(path).isEmpty()


def fingerprint(df: DataFrame) -> str:
    """Rows and hashes of a batch's content, whatever its order: part of the key of
    batches that bring no key, so that only the same rows are a replay."""
    h = F.xxhash64(*[F.col(c).cast("string") for c in sorted(df.columns)])
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)), F.coalesce(F.bit_xor(h), F.lit(0))).first()
    return ":".join(str(v) for v in row)


def numbered_batch(df: DataFrame, number: int) -> tuple[DataFrame, int]:
    """`df` (the listing columns without id) with its ids, and its rows."""
    columns = [f.name for f in S.RAW_LISTING if f.name != "id"]
    staged, _ = materialize(df.select(*columns), "listing_batch")
    rows, n = number_rows(staged, columns, "_place")
    if n >= 1 << ROW_BITS:
        raise ValueError(f"a batch takes at most {1 << ROW_BITS} rows")
    return rows.withColumn("id", F.lit(number << ROW_BITS) + F.col("_place")).drop("_place"), n


def write_batch(df: DataFrame, target: str, key: str, fmt: str = "parquet") -> int:
    """Add `df` (listing columns; an `id` is replaced) to the table as batch `key`.

    Returns the rows added: 0 where the batch was there already.
    """
    spark, root = df.sparkSession, target.rstrip("/")
    number = claim_number(spark, root, key)
    if is_done(spark, root, number):
        return 0
    rows, n = numbered_batch(df, number)
    rows.select(*[f.name for f in S.RAW_LISTING]).write.mode("overwrite").format(fmt).save(f"{root}/batch={number}")
    spark.createDataFrame([(key, n)], DONE).coalesce(1).write.mode("overwrite").json(f"{root}/_done/batch={number}")
    return n
