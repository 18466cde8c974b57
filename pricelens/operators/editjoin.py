"""Exact search of names one or two edits apart, by the strings that deletions leave.

Two names `e` edits apart leave the same string when up to `e` letters are
deleted from each. So every name is dealt out by the hashes of what that many
deletions leave of it, and names meet only where such a string is
equal: the work follows the names and their close pairs, not all pairs of a block.

What was deleted where tells the edits of a meeting pair without its letters:
the same place on both sides is a changed letter, one side more an added one.
That is an upper bound, and the edits themselves in one of the pair's meetings.
Hashes may meet by chance, so a caller checks the names of the pairs it keeps.

Keys go to the shuffle as sorted, byte-wise packed blocks, a share of the
hashes at a time, so the disk they take does not grow with the names beyond `MAX_PASSES`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_EDITS = 2
# Places of letters are held in five bits; a name's partners may be `MAX_EDITS` longer.
MAX_LEN = 32
# Names of a block, their place in it held in 16 bits.
BLOCK = 1 << 16
MAX_GROUPS = 1_000
KEYS_PER_GROUP = 500_000
KEYS_PER_PASS = 120_000_000
MAX_PASSES = 4
# Pairs formed at once, for memory only.
PAIRS_AT_ONCE = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_LEFT, _RIGHT = 1 << 12, 1 << 13
_KEYS = pa.schema([("grp", pa.int32()), ("base", pa.int64()), ("len", pa.int32()), ("keys", pa.binary())])
_PAIRS = pa.schema([("l", pa.int64()), ("r", pa.int64()), ("similarity", pa.float64())])


def _u64(x: int) -> np.uint64:
    return np.uint64(x & (1 << 64) - 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _u64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * _u64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _left_over(letters: np.ndarray, seed: np.ndarray, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of what up to `edits` deletions leave of names of one length (a row each), and
    which: two bits for their number, five for each place."""
    n, length = letters.shape
    powers = np.array([pow(_BASE, k, 1 << 64) for k in range(length)], dtype=np.uint64)
    before = np.zeros((n, length + 1), dtype=np.uint64)
    np.cumsum(_mix(letters.astype(np.uint64) + _u64(_BASE)) * powers, axis=1, out=before[:, 1:])
    inverse = pow(_BASE, -1, 1 << 64)
    once, twice = _u64(inverse), _u64(inverse * inverse)
    whole = before[:, length:]
    start = lambda left: (seed + _u64(left * 0xD6E8FEB86659FD93))[:, None]
    yield _mix(whole + start(length)), np.zeros(1, dtype=np.uint64)
    if length > 0:
        at = np.arange(length, dtype=np.uint64)
        yield _mix(before[:, :-1] + (whole - before[:, 1:]) * once + start(length - 1)), _u64(1 << 10) | at << np.uint64(5)
    for i in range(length - 1 if edits > 1 else 0):
        j = np.arange(i + 1, length, dtype=np.uint64)
        left = before[:, i:i + 1] + (before[:, i + 1:length] - before[:, i + 1:i + 2]) * once + (whole - before[:, i + 2:]) * twice
        yield _mix(left + start(length - 2)), _u64(2 << 10 | i << 5) | j


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences of their hashes and the rest, byte by byte: like bytes side by side compress."""
    hashes = (keys >> np.uint64(30) & np.uint64((1 << 24) - 1)).astype("<u4")
    rest = (keys & np.uint64((1 << 30) - 1)).astype("<u4")
    return np.concatenate([np.diff(hashes, prepend=np.uint32(0)), rest]).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(keys: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(keys, dtype=np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    half = len(both) // 2
    return np.cumsum(both[:half], dtype=np.uint32), both[half:]


def _block_keys(rows: list, edits: int, groups: int, part: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Packed keys of the names `rows` (nid, seed, name, is_left, is_right), the share `part` of `parts`."""
    base, by_len = rows[0][0], {}
    for row in rows:
        by_len.setdefault(len(row[2]), []).append(row)
    for length, some in by_len.items():
        nid, seed, names, lefts, rights = zip(*some, strict=True)
        letters = np.frombuffer("".join(names).encode("utf-32-le"), dtype="<u4").reshape(len(some), length)
        flags = np.where(lefts, _LEFT, 0) | np.where(rights, _RIGHT, 0)
        own = ((np.array(nid, dtype=np.int64) - base) << 14 | flags).astype(np.uint64)[:, None]
        found = []
        for h, code in _left_over(letters, np.array(seed, dtype=np.int64).view(np.uint64), edits):
            key = ((h >> np.uint64(24) & np.uint64((1 << 28) - 1)) % _u64(groups)) << np.uint64(54) | (
                h & np.uint64((1 << 24) - 1)) << np.uint64(30) | own | code
            found.append(key[(h >> np.uint64(54)) % _u64(parts) == part] if parts > 1 else key.ravel())
        keys = np.concatenate(found)
        keys.sort()
        grp = (keys >> np.uint64(54)).astype(np.int32)
        starts = np.flatnonzero(np.diff(grp, prepend=np.int32(-1)))
        ends = np.append(starts, len(keys))[1:]
        blobs = [_pack(keys[a:b]) for a, b in zip(starts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(grp[starts]), pa.array([base] * len(blobs), pa.int64()),
                                          pa.array([length] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())], schema=_KEYS)


def _keyed(edits: int, groups: int, part: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if rows and not rows[0][0] <= row[0] < rows[0][0] + BLOCK:
                    yield from _block_keys(rows, edits, groups, part, parts)
                    rows = []
                rows.append(row)
        if rows:
            yield from _block_keys(rows, edits, groups, part, parts)
    return run


def _edits(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edits by which two names that left the same string differ at most, and whether that can be told to be at most two."""
    (nl, il, jl), (nr, ir, jr) = ((c >> 10 & 3, c >> 5 & 31, c & 31) for c in (left, right))
    edits = np.maximum(nl, nr) + ((nl == 1) & (nr == 1) & (il != ir))
    known = ((nl != 2) | (nr != 2) | ((il == ir) & (jl == jr)))  # two changed letters; one added, one gone: told by one deletion each
    known &= (nl != 1) | (nr != 2) | (il == ir) | (il == jr - 1)  # one of the two is the changed letter
    known &= (nl != 2) | (nr != 1) | (ir == il) | (ir == jl - 1)
    return edits, known


def _meet(most: int, min_sim: float):
    def run(table: pa.Table) -> pa.Table:
        hashes, nids, codes, lens = [], [], [], []
        for base, length, keys in zip(*(table.column(c).to_pylist() for c in ("base", "len", "keys")), strict=True):
            h, rest = _unpack(keys)
            hashes.append(h)
            nids.append((rest >> np.uint32(14)).astype(np.int64) + base)
            codes.append((rest & np.uint32((1 << 14) - 1)).astype(np.int16))
            lens.append(np.full(len(h), length, dtype=np.int16))
        del table
        h, nid, code, length = (np.concatenate(x) for x in (hashes, nids, codes, lens))
        del hashes, nids, codes, lens
        order = np.argsort(h, kind="stable")
        lefts, rights = (order[(code[order] & flag) > 0] for flag in (_LEFT, _RIGHT))
        first, end = (np.searchsorted(h[rights], h[lefts], side) for side in ("left", "right"))
        upto = np.cumsum(end - first)
        out, a = [], 0
        while a < len(lefts):
            done = upto[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, "right")))
            count = (end - first)[a:b]
            l = np.repeat(lefts[a:b], count)  # noqa: E741
            r = rights[np.arange(len(l)) - np.repeat(upto[a:b] - count - done, count) + np.repeat(first[a:b], count)]
            a = b
            dl, dr = code[l] >> 10 & 3, code[r] >> 10 & 3
            meant = (length[l] - dl == length[r] - dr) & ((nid[l] != nid[r]) | (dl + dr == 0))
            l, r = l[meant], r[meant]  # noqa: E741
            edits, known = _edits(code[l], code[r])
            longest = np.maximum(length[l], length[r])
            similarity = np.where(longest == 0, 1.0, 1.0 - edits / np.maximum(longest, 1).astype(np.float64))
            known &= (edits <= most) & (similarity >= min_sim)
            out.append((nid[l[known]], nid[r[known]], similarity[known]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[], [], []]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PAIRS, strict=True)], schema=_PAIRS)
    return run


def key_count(length: Column, edits: int) -> Column:
    return length * (length - 1) / 2 * (edits - 1) + length + 1


def near_pairs(names: DataFrame, edits: int, keys: int, min_sim: float, best: int, tasks: int, write) -> DataFrame:
    """(l, r, similarity): the `best` right names of every left one that are at most `edits` (1 or 2)
    away, by 1 - edits / longer length (`min_sim` at least), then by `nid`.

    `names`: nid (long, ascending in what settles ties), seed (long, equal for names that may
    meet), name (lower case, `MAX_LEN` letters at most, left ones `edits` fewer), is_left,
    is_right. `keys` is the sum of `key_count`. `write(df, name)` writes a table, returns it and its rows.
    """
    parts = min(MAX_PASSES, max(1, -(-keys // KEYS_PER_PASS)))
    groups = min(MAX_GROUPS, max(1, -(-keys // (parts * KEYS_PER_GROUP))))
    by_l = Window.partitionBy("l").orderBy(F.col("similarity").desc(), "r")

    def top(pairs: DataFrame) -> DataFrame:
        met = pairs.repartition(max(tasks, groups), "l").groupBy("l", "r").agg(F.max("similarity").alias("similarity"))
        return met.withColumn("_r", F.row_number().over(by_l)).where(F.col("_r") <= best).drop("_r")

    found = []
    for part in range(parts):
        # Neighbours in nid stay together: a block of them is told apart by 16 bits.
        dealt = (names.select("nid", "seed", "name", "is_left", "is_right").repartitionByRange(tasks, "nid").sortWithinPartitions("nid")
                 .mapInArrow(_keyed(edits, groups, part, parts), "grp int, base long, len int, keys binary"))
        met = dealt.repartition(groups, "grp").groupBy("grp").applyInArrow(_meet(edits, min_sim), "l long, r long, similarity double")
        found.append(write(top(met), "match_near")[0])
    return found[0] if parts == 1 else write(top(reduce(DataFrame.unionByName, found)), "match_near")[0]
