"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.session import scratch_path

# The columns of the documents table, in order.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once below the shared checkpoint folder and read it back.

    The lineage ends at the files, so a lost executor costs a re-read and not a
    recomputation, and every later pass sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc32_text(col: str | Column) -> Column:
    """Unsigned crc32 of a value's text form; null for null."""
    return F.crc32(F.col(col).cast("string") if isinstance(col, str) else col.cast("string"))


def fold_of(id_col: str, folds: int) -> Column:
    """Deterministic fold of a row: crc32 of the id as text, modulo `folds`; 0 for a null id."""
    return F.coalesce(F.pmod(crc32_text(id_col), F.lit(folds)), F.lit(0)).cast("int")


# Rows of an Arrow batch: whole texts are long, and a worker holds a batch at a time.
ARROW_ROWS = 1000


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """`mapInArrow` over batches of at most ARROW_ROWS rows (fewer if the session says so)."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= ARROW_ROWS:
        conf.set(name, str(ARROW_ROWS))
    return df.mapInArrow(run, schema)
