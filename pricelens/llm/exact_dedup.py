"""Exact de-duplication with a heavy-hitter split.

1. Every text gets a digest: SHA-256 of the text without blanks.
2. A Misra-Gries summary of every partition names the digests that may be
   frequent; the summaries are added up and cut at a support share, which
   bounds the candidates by a number that does not depend on the input.
3. One exact pass verifies the candidates: their true row counts and winners,
   combined on the map side, so a digest held by a third of all rows reaches
   the shuffle as one row per task.
4. The verified winners are broadcast; heavy rows are settled where they are
   read. All other digests take the ordinary shuffle, where no group is large.

Defined results: a null text counts as empty; texts that are empty after
normalising are equal to each other; a null id sorts after every id; rows that
repeat both id and text share one decision in `decisions` and leave exactly one
row in `deduplicated`; an empty table gives an empty result; further columns
are carried by `deduplicated` and ignored by `decisions`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import written

BLANKS = " \t\n\x0b\x0c\r"
# A digest is heavy when it holds at least this share of the rows.
SUPPORT = 1 / 1000
# Counters of one Misra-Gries summary; the error is at most rows / (COUNTERS + 1).
COUNTERS = 2000
_BATCH_DISTINCT = 200_000


def normalised(text: Column) -> Column:
    """The text without blanks; null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def misra_gries(counts: dict[str, int], more: dict[str, int], k: int) -> dict[str, int]:
    """Add two summaries and keep at most `k` counters (the mergeable form:
    subtract the (k+1)-th largest count from all and keep what is positive)."""
    for key, n in more.items():
        counts[key] = counts.get(key, 0) + n
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return {key: n - cut for key, n in counts.items() if n > cut}


def _summaries(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for at in range(0, batch.num_rows, _BATCH_DISTINCT):
                found = batch.column(0).slice(at, _BATCH_DISTINCT).value_counts()
                more = dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True))
                counts = misra_gries(counts, more, k)
        if rows:
            yield pa.RecordBatch.from_pydict(
                {"digest": [*counts, None], "n": [*counts.values(), rows]},
                schema=pa.schema([("digest", pa.string()), ("n", pa.int64())]))
    return run


def heavy_candidates(digests: DataFrame, support: float = SUPPORT, counters: int = COUNTERS) -> DataFrame:
    """Digests that may hold `support` of the rows; every one that does is among them.

    The summed counters are at most the true counts and fall short of them by
    at most rows / (counters + 1). Keeping sums of at least
    rows * (support - 1 / (counters + 1)) loses no heavy digest, and the kept
    sums add up to at most the rows, so at most
    1 / (support - 1 / (counters + 1)) digests remain at any input size.
    """
    parts = digests.select("digest").mapInArrow(_summaries(counters), "digest string, n long")
    sums = written(parts.groupBy("digest").agg(F.sum("n").alias("n")), "mg_sums")
    rows = sums.where("digest is null").agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    least = max(2, int(rows * (support - 1 / (counters + 1))))
    return sums.where(F.col("digest").isNotNull() & (F.col("n") >= least)).select("digest")


def _order(id_col: str) -> list[Column]:
    return [F.col("len").desc(), F.col(id_col).asc_nulls_last()]


def heavy_winners(digests: DataFrame, id_col: str) -> DataFrame:
    """Verified row count and winning row of every heavy candidate, one row each."""
    candidates = F.broadcast(heavy_candidates(digests))
    return written(
        digests.join(candidates, "digest").groupBy("digest").agg(
            F.count(F.lit(1)).alias("heavy_size"),
            F.min(F.struct((-F.col("len")).alias("neg_len"), F.col(id_col).isNull().alias("no_id"),
                           F.col(id_col).alias("id"))).alias("best"))
        .select("digest", "heavy_size", (-F.col("best.neg_len")).alias("heavy_len"), F.col("best.id").alias("heavy_id")),
        "mg_winners")


def digest_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, len, digest) of every row, written once; no text is moved."""
    text = F.col(text_col)
    return written(df.select(F.col(id_col), F.coalesce(F.char_length(text), F.lit(0)).alias("len"),
                             digest(text).alias("digest")), "digests")


def decisions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, `keep_id`, `group_size`, `kept`, `digest`.

    Of equal texts the row with the most code points, then the smallest id, stays.
    """
    digests = digest_table(df, id_col, text_col)
    marked = digests.join(F.broadcast(heavy_winners(digests, id_col)), "digest", "left")
    heavy = marked.where(F.col("heavy_size").isNotNull()).select(
        id_col, F.col("heavy_id").alias("keep_id"), F.col("heavy_size").alias("group_size"), "digest")
    group = Window.partitionBy("digest")
    first = group.orderBy(*_order(id_col)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    light = marked.where(F.col("heavy_size").isNull()).select(
        id_col, F.first(id_col).over(first).alias("keep_id"), F.count(F.lit(1)).over(first).alias("group_size"), "digest")
    return heavy.unionByName(light).withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that stay, with all columns of `df`.

    Losers of heavy digests are dropped on the map side against the broadcast
    winners. The rest is grouped by digest; the group limit planned below the
    shuffle leaves at most one row per digest and task.
    """
    text = F.col(text_col)
    winners = heavy_winners(digest_table(df, id_col, text_col), id_col)
    cols = [F.col(c) for c in df.columns]
    rows = df.select(F.struct(*cols).alias("row"), F.col(id_col).alias("id"),
                     F.coalesce(F.char_length(text), F.lit(0)).alias("len"), digest(text).alias("digest"))
    left = rows.join(F.broadcast(winners), "digest", "left").where(
        F.col("heavy_size").isNull()
        | (F.col("id").eqNullSafe(F.col("heavy_id")) & (F.col("len") == F.col("heavy_len"))))
    rank = F.row_number().over(Window.partitionBy("digest").orderBy(*_order("id")))
    return left.withColumn("rank", rank).where("rank = 1").select("row.*")
