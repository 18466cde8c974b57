"""Incremental listing landing.

The batch loader reads a fixed list of JSON listing files. Here the same
records are picked up incrementally from a landing folder: each new file is
read once (file-source offsets in the checkpoint), converted exactly like
`read_listing_json`, and written to the listing table inside one
`foreachBatch` write per micro-batch (idempotent on replay). With `availableNow` the query drains what has landed
and stops, which fits a scheduled run; without it the query keeps running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricelens import schemas as S
from pricelens.sources.batches import write_batch
from pricelens.sources.listings import conform


def _to_listing(df: DataFrame, tz: str) -> DataFrame:
    ts = F.convert_timezone(F.lit(tz), F.lit("UTC"), F.to_timestamp("scraped_at").cast("timestamp_ntz"))
    return df.select(
        "product_name", "price", "sale_price", F.coalesce(F.col("on_sale"), F.lit(False)).alias("on_sale"),
        "source", "url", "category", "brand", "sku", ts.alias("scraped_at"),
        F.coalesce(F.col("raw_payload"), F.lit("{}")).alias("raw_payload"))


def write_landing_batch(batch: DataFrame, target: str, batch_id: int, stream: str = "") -> int:
    """Write one micro-batch of the stream named `stream`: foreachBatch may
    replay a batch after a failure, and the replay adds nothing
    (`sources.batches`). Returns the rows added."""
    rows = conform(batch.withColumn("id", F.lit(0)), S.RAW_LISTING)
    return write_batch(rows, target, f"landing:{stream}:{batch_id}")


def landing_stream(spark: SparkSession, landing_dir: str, target: str, checkpoint: str,
                   available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the landing query. A micro-batch is a batch of the table's ledger,
    keyed by the checkpoint folder and the micro-batch number: its ids meet
    those of no other batch, landed or appended, and a replay adds nothing."""
    reader = spark.readStream.schema(S.LISTING_JSON).option("multiLine", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    tz = spark.conf.get("spark.sql.session.timeZone")
    stream = _to_listing(reader.json(landing_dir), tz)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_landing_batch(batch, target, batch_id, stream=checkpoint)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
