"""Exact top-k search by term-at-a-time accumulation over blocks.

Queries and candidates are sparse integer vectors: a term is a component
number, a posting is (candidate, weight). Both sides are cut into blocks of
bounded size by a hash, and every (query block, candidate block) cell is one
unit of work: the cell builds the postings of its candidates per term, every
term of a query scatters its weighted postings into a dense array of scores
(one per candidate of the block), the k best are selected by partition, and the
cells' lists are merged per query. All candidates are scored; nothing is
approximated, and no cell holds more than one block of each side (rows equal
in id and vector share a block).

Defined results: vectors that are null or hold null, NaN or infinite components
take no part; missing trailing components count as 0; query rows with one id have one
list, the best over all of them; rows with the query's own
id are not its candidates; repeated candidate rows each keep their place;
scores beyond a 64-bit integer are clipped to it; ties go to the smaller id;
fewer than k candidates give fewer rows; no queries or no rows give no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 256
CANDIDATE_BLOCK = 8192
_SCALE = 1024
_I64 = np.iinfo(np.int64)


def usable(vec: Column) -> Column:
    """True for a vector that is whole and finite."""
    return F.coalesce(vec.isNotNull() & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Components as floor(1024 * x), exact in float64; missing trailing ones are 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = np.asarray(column.offsets)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    flat = flat[ends[0]:ends[-1]]
    lens = np.diff(ends)
    out = np.zeros((len(column), int(lens.max(initial=0))))
    out[np.repeat(np.arange(len(lens)), lens), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lens)] = flat
    return np.floor(out * _SCALE)


def _scores(queries: np.ndarray, cands: np.ndarray) -> np.ndarray:
    """Dense (queries x candidates) scores, accumulated one term at a time."""
    terms = min(queries.shape[1], cands.shape[1])
    bound = (np.abs(queries).max(initial=0) * np.abs(cands).max(initial=0)) * max(1, terms)
    kind = np.int64 if bound < 2.0 ** 62 else object  # beyond 64 bits: exact Python integers
    to = (lambda m: m.astype(np.int64)) if kind is np.int64 else np.vectorize(int, otypes=[object])
    q, c = to(queries) if queries.size else queries, to(cands) if cands.size else cands
    acc = np.zeros((len(queries), len(cands)), dtype=kind)
    for term in range(terms):
        rows = np.flatnonzero(q[:, term])
        posting = np.flatnonzero(c[:, term])
        if not len(rows) or not len(posting):
            continue
        weights = c[posting, term]
        if len(posting) == len(cands):
            for r in rows:
                acc[r] += q[r, term] * weights
        else:
            for r in rows:
                acc[r, posting] += q[r, term] * weights
    return acc if kind is np.int64 else np.clip(acc, _I64.min, _I64.max).astype(np.int64)


def best_k(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        tied = np.flatnonzero(scores == least)
        need = k - len(above)
        if len(tied) > need:
            tied = tied[np.argpartition(ids[tied], need - 1)[:need]]
        at = np.concatenate([above, tied])
    else:
        at = np.arange(len(scores))
    return np.array(sorted(at, key=lambda i: (-int(scores[i]), int(ids[i]))), dtype=np.int64)


_OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _cell(k: int, chunk: int = 64):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _OUT.empty_table()
        q_ids, c_ids = (t.column("id").to_numpy() for t in (left, right))
        q, c = _matrix(left.column("vec")), _matrix(right.column("vec"))
        found: list[np.ndarray] = []
        for at in range(0, len(q), chunk):
            acc = _scores(q[at:at + chunk], c)
            for r in range(len(acc)):
                other = np.flatnonzero(c_ids != q_ids[at + r])
                pick = other[best_k(acc[r][other], c_ids[other], k)]
                found.append(np.stack([np.full(len(pick), q_ids[at + r]), c_ids[pick], acc[r][pick]]))
        cols = np.concatenate(found, axis=1)
        return pa.table(list(cols), schema=_OUT)
    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, query_block: int = QUERY_BLOCK,
          candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """Both inputs: (id long, vec array). Returns query_id, rank (from 1), vec_id, score."""
    queries, candidates = (
        d.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"))
        .where(usable(F.col("vec")) & F.col("id").isNotNull()) for d in (queries, candidates))
    n_q, n_c = (max(1, d.select("id").count()) for d in (queries, candidates))
    q_blocks, c_blocks = -(-n_q // query_block), -(-n_c // candidate_block)

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("id", "vec"), F.lit(n))

    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = queries.withColumn("qb", block(q_blocks)).withColumn("cb", every(c_blocks))
    right = candidates.withColumn("cb", block(c_blocks)).withColumn("qb", every(q_blocks))
    cells = (left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb"))
             .applyInArrow(lambda a, b: _cell(k)(a, b), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (cells.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
