"""Importance resampling towards a target corpus, with n-gram CRCs from prefix CRCs.

A text's features are its runs of 1 to 3 words, each hashed to a bucket by the
CRC-32 of its bytes. `fit` counts the buckets of the whole raw corpus and of the
whole target; a bucket's gain is the scaled log ratio of its two smoothed
shares, a document's weight the sum of its features' gains. `draw` adds Gumbel
noise that is a hash of the id and keeps the highest scores, which is sampling
without replacement in proportion to the exponential of the weights.

The CRCs need one scan: separators are normalised to one blank, and the running
CRC is stored behind every word. CRC is linear over GF(2), so the CRC of the
bytes from a to b is the running CRC at b, less (xor) the running CRC at a moved
on by b - a bytes; the move is a product with a power of x modulo the CRC's
polynomial, taken from tables for short distances and by squaring for long ones.
No n-gram is ever built as a string.

The rank is a position in a range-partitioned sort of small rows (no text), so
no task holds the whole corpus; what reaches the driver is one sum per bucket
and one count per sort partition.

Defined results: a null or wordless text has no features and weight 0; a null
id draws the noise of the empty id and loses ties; rows that repeat an id and a
text are rows of their own, each with its own rank; empty tables give neutral
gains or no rows; further columns are kept by `weigh` if named.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.bpe import slices
from pricelens.llm.common import map_arrow, written

BUCKETS = 10_000
MAX_WORDS = 3
SCALE = 1000
# Bytes of text whose features are held at a time (one longer text is held alone).
SLICE_BYTES = 1 << 20

# Word bytes stay, A-Z are lower-cased, every other byte is a separator.
_NORMAL = bytes(b if b >= 0x80 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_SHORT = 64


# -- CRC arithmetic ----------------------------------------------------------
@functools.cache
def _byte_table() -> np.ndarray:
    """What one more zero byte makes of each low byte of a CRC."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (t & np.uint32(1)))
    return t


def _zero_byte(c: np.ndarray) -> np.ndarray:
    return _byte_table()[c & np.uint32(255)] ^ (c >> np.uint32(8))


def _apply(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map given by its values on the four bytes, applied to `c`."""
    out = table[0][c & np.uint32(255)]
    for j in (1, 2, 3):
        out ^= table[j][(c >> np.uint32(8 * j)) & np.uint32(255)]
    return out


@functools.cache
def _short_moves() -> np.ndarray:
    """Maps that move a CRC on by 0..63 zero bytes: [byte of the CRC][64 * 256 values]."""
    one = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])
    out = [one]
    for _ in range(_SHORT - 1):
        out.append(_zero_byte(out[-1]))
    return np.ascontiguousarray(np.stack(out, axis=1).reshape(4, _SHORT * 256))


@functools.cache
def _long_move(bit: int) -> np.ndarray:
    """The map that moves a CRC on by 2 ** bit bytes, from squaring the one before."""
    if bit < 6:
        return np.stack([_short_moves()[j].reshape(_SHORT, 256)[1 << bit] for j in range(4)])
    half = _long_move(bit - 1)
    return np.stack([_apply(half, half[j]) for j in range(4)])


def move(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each CRC of `c` moved on by its number of bytes `n`."""
    row = (n & (_SHORT - 1)) * 256
    tables = _short_moves()
    out = tables[0][row + (c & np.uint32(255))]
    for j in (1, 2, 3):
        out ^= tables[j][row + ((c >> np.uint32(8 * j)) & np.uint32(255))]
    rest, bit = n >> 6, 6
    while rest.any():
        far = np.flatnonzero(rest & 1)
        out[far] = _apply(_long_move(bit), out[far])
        rest, bit = rest >> 1, bit + 1
    return out


def ngram_crcs(texts: list[bytes | None], max_words: int = MAX_WORDS) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words per text, and for each length of run the CRC-32 of every run of
    words of one text and the number of the text it is from."""
    split = [t.translate(_NORMAL).split() if t else [] for t in texts]
    counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    words = [w for ws in split for w in ws]
    owner = np.repeat(np.arange(len(texts)), counts)
    if not words:
        return counts, [np.zeros(0, np.uint32)] * max_words, [owner] * max_words
    # Every piece but the first is a blank and a word: one scan, a running CRC behind each.
    pieces = b" ".join(words).replace(b" ", b"\0 ").split(b"\0")
    behind = np.fromiter(accumulate(pieces, lambda c, p: crc32(p, c), initial=0), dtype=np.uint32, count=len(words) + 1)[1:]
    end = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))
    begin = np.concatenate([[0], end[:-1] + 1])
    state = ~behind[:-1]  # the running CRC after the blank that follows
    before = np.concatenate([np.zeros(1, np.uint32), ~(_byte_table()[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8)))])
    crcs, owners = [], []
    for n in range(max_words):
        whole = np.flatnonzero(owner[n:] == owner[:len(owner) - n])  # runs that do not cross into the next text
        crcs.append(behind[whole + n] ^ move(before[whole], end[whole + n] - begin[whole]))
        owners.append(owner[whole])
    return counts, crcs, owners


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    lengths = np.array(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
    return slices(lengths, SLICE_BYTES)


# -- counts and gains ----------------------------------------------------------
def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Features per bucket over all rows of `df`; every task sends one sum per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            texts = b.column(0)
            for at, to in _slices(texts):
                for crcs in ngram_crcs(texts.slice(at, to - at).to_pylist())[1]:
                    n += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bucket": hit, "n": n[hit]})

    return (map_arrow(df.select(F.col(text_col).cast("binary")), run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def fit(raw: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, as an integer, from all of `raw` and `target`."""
    counts = []
    for df in (raw, target):
        n = [0] * buckets
        for r in bucket_counts(df, text_col, buckets).collect():  # at most one row per bucket
            n[r["bucket"]] = r["n"]
        counts.append(n)
    (s, t), (big_s, big_t) = counts, map(sum, counts)
    return np.array([math.floor(SCALE * math.log((float(t[i] + 1) * float(big_s + buckets)) / (float(s[i] + 1) * float(big_t + buckets))))
                     for i in range(buckets)], dtype=np.int64)


def weigh(df: DataFrame, gains: np.ndarray, keep: list[str], text_col: str = "text") -> DataFrame:
    """`keep` columns and `n_words`, `n_features`, `weight` of every row's whole text."""
    buckets = np.uint32(len(gains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1)
            n_words, n_features, weight = (np.zeros(b.num_rows, dtype=np.int64) for _ in range(3))
            for at, to in _slices(texts):
                n_words[at:to], crcs, owners = ngram_crcs(texts.slice(at, to - at).to_pylist())
                for c, o in zip(crcs, owners, strict=True):
                    n_features[at:to] += np.bincount(o, minlength=to - at)
                    total = np.concatenate([[0], np.cumsum(gains[c % buckets])])
                    first = np.searchsorted(o, np.arange(to - at + 1))
                    weight[at:to] += total[first[1:]] - total[first[:-1]]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *map(pa.array, (n_words, n_features, weight))],
                                             names=[*keep, "n_words", "n_features", "weight"])

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(df.select(*keep, F.col(text_col).cast("binary")), run, f"{kinds}, n_words long, n_features long, weight long")


# -- drawing -------------------------------------------------------------------
def gumbel(id_col: str, seed: int = 42):
    """Scaled Gumbel noise of a row, from the first 32 bits of sha256("<seed>:<id>")."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(weighed: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """`weighed` with `score` and `rank`: the highest scores of the rows with at
    least `min_words` words, floor(percent * rows / 100) of them, counted from 1."""
    rows = written(weighed.withColumn("score", F.col("weight") + gumbel(id_col, seed)), "importance")
    out = F.col("n_words") < min_words
    # The row's place in the written table tells repeated rows apart, so no key grows beyond a sort partition.
    order = [out.asc(), F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("_row").asc()]
    ordered = written(rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
                      .withColumn("_at", F.monotonically_increasing_id()), "importance_order")
    # Partition number in the upper bits, place within the partition in the lower 33.
    part = F.shiftright("_at", 33)
    sizes = sorted((r["part"], r["n"]) for r in ordered.where(~out).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    firsts = [0, *accumulate(n for _, n in sizes)]
    drawn = percent * firsts[-1] // 100
    spark = weighed.sparkSession
    base = spark.createDataFrame([(p, f) for (p, _), f in zip(sizes, firsts, strict=False)], "_part long, _base long")
    rank = F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return (ordered.withColumn("_part", part).join(F.broadcast(base), "_part", "left")
            .withColumn("rank", F.when(~out & (rank <= drawn), rank)).drop("_part", "_base", "_at", "_row"))
