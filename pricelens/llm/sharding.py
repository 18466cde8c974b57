"""Sharding by histogram sort: shards of near-equal bytes, equal texts together.

Rows are ordered by a 192-bit key: a hash of the text, a hash of the id, and a
hash of the row's place in the table, which tells repeated rows apart.
The cut points between shards are found by counting, not by sampling: each
round counts the exact bytes below a few candidate keys per cut, over all
partitions, and narrows every cut's interval to the two candidates around its
target, until the bytes below a candidate are within tolerance. Equal texts are
neighbours in this order, so a cut falls inside a group of them only when the
group alone is larger than the tolerance; such a cut is refined on the second
key, and inside repeated rows on the third. Then the rows move once, to bins
within their shard, where they get their slots. A bin is a range of the text hash; a text
with more rows than a bin is spread over several bins by the id hash, and an id
and text with more rows than a bin by the place, so no task depends on one group.

Defined results: a null text has 0 bytes, is equal to the empty text and gets
crc32 0; a null id hashes as a value of its own; rows that repeat both id and
text get different slots, and are cut between shards like other rows; an empty
table gives no rows; further columns are kept by `shard_rows` and written by
`write_shards`. Where rows repeat, `df` is written once with its places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import written

# A cut may miss its target by this share of a shard's bytes.
TOLERANCE = 1e-3
# Candidate keys per open cut and round.
PROBES = 64
# Rows that one bin should hold.
BIN_ROWS = 4096

_LOW, _HIGH = -(2 ** 63), 2 ** 63 - 1


KEY = ("_h1", "_h2", "_h3")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (df.withColumn("_size", F.octet_length(text).cast("long") + 1)
            .withColumn("_crc", F.crc32(text))
            .withColumn("_h1", F.xxhash64(text, F.lit("text")))
            .withColumn("_h2", F.xxhash64(F.col(id_col).cast("string"), F.lit("id"))).withColumn("_h3", F.lit(0).cast("long")))


def _places(probes: list[np.ndarray], keys: list[np.ndarray]) -> np.ndarray:
    """How many of the sorted probes are at or below each key, compared part by part."""
    first, own = probes[0], keys[0]
    at = np.searchsorted(first, own, side="left")
    end = np.searchsorted(first, own, side="right")
    shared = np.flatnonzero(end > at)
    if len(probes) == 1:
        return end
    for low in np.unique(at[shared]):  # rows on a probe's part: the next part decides
        rows = shared[at[shared] == low]
        high = end[rows[0]]
        at[rows] = low + _places([p[low:high] for p in probes[1:]], [k[rows] for k in keys[1:]])
    return at


def _bytes_below(probes: list[tuple[int, ...]]):
    """Per partition: bytes and rows between neighbouring candidate keys."""
    parts = [np.array(p, dtype=np.int64) for p in zip(*probes, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.zeros(len(probes) + 1, dtype=np.int64)
        rows = np.zeros(len(probes) + 1, dtype=np.int64)
        for b in batches:
            *keys, n = (b.column(i).to_numpy(zero_copy_only=False) for i in range(len(KEY) + 1))
            at = _places(parts, keys)
            np.add.at(size, at, n)
            np.add.at(rows, at, 1)
        hit = np.flatnonzero(rows)
        yield pa.RecordBatch.from_pydict({"bin": hit, "bytes": size[hit], "rows": rows[hit]})
    return run


def histogram_splitters(keys: DataFrame, targets: list[float], tolerance: float) -> list[tuple[int, ...]]:
    """For each target, a key (h1, h2, h3) so that the bytes of the rows below it
    are within `tolerance` of the target, or as near as any key comes.

    `keys` has the columns _h1, _h2, _h3, _size. Every round is one pass that
    returns at most (candidates + 1) sums, whatever the number of rows.
    """
    # Per cut: [low key, bytes below it, high key, bytes below it, answer]
    total = keys.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    cuts = [{"t": t, "lo": (_LOW,) * 3, "lo_b": 0, "hi": (_HIGH,) * 3, "hi_b": total, "key": None} for t in targets]

    def value(k: tuple[int, ...]) -> int:
        return ((k[0] - _LOW) << 128) + ((k[1] - _LOW) << 64) + (k[2] - _LOW)

    def key(v: int) -> tuple[int, ...]:
        return tuple((v >> shift & (2 ** 64 - 1)) + _LOW for shift in (128, 64, 0))

    while open_cuts := [c for c in cuts if c["key"] is None]:
        probes: set[int] = set()
        for c in open_cuts:
            lo, hi = value(c["lo"]), value(c["hi"])
            # Between two text hashes only whole groups are cut; within one hash the id hash decides, then the place.
            unit = next((2 ** s for s in (128, 64) if (hi >> s) - (lo >> s) > 1), 1)
            a, z = lo // unit, -(-hi // unit)
            c["probes"] = sorted({v for i in range(1, PROBES + 1) if lo < (v := (a + (z - a) * i // (PROBES + 1)) * unit) < hi})
            probes.update(c["probes"])
            for end, size in (("lo", "lo_b"), ("hi", "hi_b")):
                if abs(c[size] - c["t"]) <= tolerance:
                    c["key"] = c[end]
            if c["key"] is None and not c["probes"]:
                c["key"] = c["lo"] if c["t"] - c["lo_b"] <= c["hi_b"] - c["t"] else c["hi"]
        open_cuts = [c for c in cuts if c["key"] is None]
        if not open_cuts:
            break
        ordered = sorted({v for c in open_cuts for v in c["probes"]})
        counted = (keys.select(*KEY, "_size")
                   .mapInArrow(_bytes_below([key(v) for v in ordered]), "bin long, bytes long, rows long")
                   .groupBy("bin").agg(F.sum("bytes").alias("bytes")).collect())
        bins = np.zeros(len(ordered) + 1, dtype=np.int64)
        for r in counted:
            bins[r["bin"]] = r["bytes"]
        below = dict(zip(ordered, np.cumsum(bins)[:-1].tolist(), strict=True))
        for c in open_cuts:
            for v in c["probes"]:
                if below[v] <= c["t"]:
                    c["lo"], c["lo_b"] = key(v), below[v]
                else:
                    c["hi"], c["hi_b"] = key(v), below[v]
                    break
            best = min((("lo", "lo_b"), ("hi", "hi_b")), key=lambda e: abs(c[e[1]] - c["t"]))
            if abs(c[best[1]] - c["t"]) <= tolerance:
                c["key"] = c[best[0]]
    return [c["key"] for c in cuts]


def shard_rows(df: DataFrame, n_shards: int = 8, tolerance: float = TOLERANCE, id_col: str = "doc_id",
               text_col: str = "text", bin_rows: int = BIN_ROWS) -> DataFrame:
    """`df` with `shard` (int), `slot` (long, gapless from 0 in its shard) and the
    helper columns `_size` (UTF-8 bytes + 1) and `_crc` (crc32 of the text)."""
    keyed = _keyed(df, id_col, text_col)
    keys = written(keyed.select(*KEY, "_size"), "shard_keys")
    if not keys.groupBy("_h1", "_h2").count().where("count > 1").isEmpty():
        # Every pass must see a repeated row at the same place.
        keyed = written(keyed.withColumn("_h3", F.xxhash64(F.monotonically_increasing_id())), "shard_rows")
        keys = written(keyed.select(*KEY, "_size"), "shard_keys")
    stats = keys.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_size"), F.lit(0)).alias("b")).first()
    share = stats["b"] / n_shards
    splitters = histogram_splitters(keys, [share * i for i in range(1, n_shards)], share * tolerance) if stats["n"] else []

    shard = F.lit(0)
    for h1, h2, h3 in splitters:
        above = (F.col("_h2") > h2) | ((F.col("_h2") == h2) & (F.col("_h3") >= h3))
        shard = shard + F.when((F.col("_h1") > h1) | ((F.col("_h1") == h1) & above), 1).otherwise(0)
    # Bins: the top bits of the text hash; a text larger than a bin also uses the top bits of the next hashes.
    bits = max(0, int(np.ceil(np.log2(max(1.0, stats["n"] / bin_rows)))))
    top = lambda c: F.shiftrightunsigned(F.col(c), 64 - bits) if bits else F.lit(0).cast("long")
    # Groups with more rows than a bin: at most rows / bin_rows of them, counted with map-side combining.
    hot = written(keys.groupBy("_h1").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bin_rows)
                  .select("_h1", F.lit(True).alias("_hot")), "shard_hot")
    repeated = written(keys.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bin_rows)
                       .select("_h1", "_h2", F.lit(True).alias("_again")), "shard_repeated")
    cell = ["shard", "_b1", "_b2", "_b3"]

    def binned(frame: DataFrame) -> DataFrame:
        spread = lambda flag, c: F.when(F.col(flag), top(c) + 1).otherwise(F.lit(0).cast("long"))
        return (frame.join(hot, "_h1", "left").join(repeated, ["_h1", "_h2"], "left").withColumn("shard", shard.cast("int"))
                .withColumn("_b1", top("_h1")).withColumn("_b2", spread("_hot", "_h2")).withColumn("_b3", spread("_again", "_h3")))

    counts = written(binned(keys).groupBy(*cell).agg(F.count(F.lit(1)).alias("n")), "shard_bins")
    before = Window.partitionBy("shard").orderBy(*cell[1:]).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy(*cell).orderBy(*KEY)
    return (binned(keyed).withColumn("_row", F.row_number().over(inside).cast("long") - 1)
            .join(starts, cell)
            .withColumn("slot", F.col("_start") + F.col("_row"))
            .drop(*KEY, "_hot", "_again", *cell[1:], "_row", "_start"))


def write_shards(df: DataFrame, path: str, n_shards: int = 8, **options) -> None:
    """Write whole rows as Parquet, one folder per shard, with their slots."""
    (shard_rows(df, n_shards, **options).drop("_size", "_crc")
     .write.partitionBy("shard").mode("overwrite").parquet(path))
