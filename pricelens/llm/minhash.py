"""Near-duplicate documents with b-bit MinHash.

1. Every text becomes the set of its distinct five-word shingles (64-bit hashes)
   and HASHES minima over it. Texts with equal sets form one node from here on.
2. BANDS bands of ROWS minima give band keys; nodes that share a band key are
   candidates. Two nodes at the similarity bound share none of the bands with
   probability (1 - bound ** ROWS) ** BANDS: 6e-11 at 0.85, 5e-8 at 0.8.
3. The BITS low bits of all minima are kept, packed in bit planes. Equal
   positions are counted by bit operations, and the count corrected for chance
   agreement estimates the similarity; candidates more than five standard
   deviations below the bound are dropped.
4. What remains is confirmed on the full shingle sets.

Groups of copies are not expanded into pairs. First every node of a bucket is
compared with one node of the bucket (its least), then every node of a large
bucket with the one of another component that the estimate puts nearest, which
joins most of a group; then all nodes of one bucket that are still in different
components are compared, large buckets in blocks that spread over tasks, each
pair in the first band that it shares. So no link between different components is lost,
and pairs inside a component are not formed.

Defined results: only A-Z are lower-cased, words end at blanks of ASCII; a
text of fewer words than a shingle has its whole word sequence as its one
element; null and blank texts have an empty set and are linked with nothing;
rows with equal sets are linked however often they repeat; a null id never
names a component unless the component has no other; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import map_arrow, written

SHINGLE = 5
HASHES = 512
BANDS, ROWS = 32, 4
BITS = 4
# Standard deviations of the estimate below the bound that still count as candidates.
MARGIN = 5.0
# Rounds in which nodes of large buckets are first compared with their nearest.
NEAREST_ROUNDS = 2
# Buckets up to this size are paired by a plain join, larger ones in blocks.
SMALL_BUCKET = 16
BLOCK = 512
_TEXT_BLOCK = 1 << 20
_PLANE = HASHES // 64

_rng = np.random.default_rng(20240917)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDER = _rng.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _blocks(raw: bytes) -> Iterator[bytes]:
    """The text in blocks that end at blanks."""
    at = 0
    while at < len(raw):
        to = at + _TEXT_BLOCK
        if to < len(raw):
            ends = np.flatnonzero(_BLANK[np.frombuffer(raw, np.uint8, len(raw) - to, to)][:_TEXT_BLOCK])
            while not len(ends) and to < len(raw):  # a word longer than a block
                to = min(len(raw), to + _TEXT_BLOCK)
                ends = np.flatnonzero(_BLANK[np.frombuffer(raw, np.uint8, len(raw) - to, to)][:_TEXT_BLOCK])
            to += int(ends[0]) if len(ends) else 0
        yield raw[at:to]
        at = to


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of every word of the lower-cased text."""
    out = [np.zeros(0, np.uint64)]
    for block in _blocks(raw.lower()):
        data = np.frombuffer(block, dtype=np.uint8)
        inside = ~_BLANK[data]
        starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
        if not len(starts):
            continue
        place = np.arange(len(data))  # of a byte in its word
        place[starts[0]:] -= np.repeat(starts, np.diff(np.append(starts, len(data))))
        part = _BYTE[data] * (_PLACE[place & 4095] + (place >> 12).astype(np.uint64) * np.uint64(2))
        part[~inside] = 0
        out.append(_mix(np.add.reduceat(part, starts)))
    return np.concatenate(out)


def shingles(raw: bytes) -> np.ndarray:
    """The sorted distinct shingles of a text as 64-bit hashes."""
    w = word_hashes(raw)
    n = len(w)
    if n == 0:
        return w
    if n < SHINGLE:
        return _mix((w * _ORDER[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    s = w[:n - SHINGLE + 1] * _ORDER[0]
    for k in range(1, SHINGLE):
        s += w[k:n - SHINGLE + 1 + k] * _ORDER[k]
    return np.unique(_mix(s))


def minima(found: np.ndarray) -> np.ndarray:
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(out, (x[at:at + 1024, None] * _MUL + _ADD).min(axis=0), out=out)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    return _mix((rows * _ORDER[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _PLACE[0]).view(np.int64)


def packed(low: np.ndarray) -> np.ndarray:
    """BITS planes of HASHES bits each, as 64-bit words."""
    bits = (low[None, :] >> np.arange(BITS, dtype=np.uint32)[:, None]) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<i8").ravel()


def node_hash(found: np.ndarray) -> int:
    """Identity of a shingle set."""
    at = np.arange(len(found), dtype=np.uint64)
    return int(_mix((_mix(found + at * _PLACE[1])).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(found))).view(np.int64)[0])


def _texts(column: pa.Array) -> Iterator[bytes]:
    raw = column.cast(pa.large_binary())
    for i in range(len(raw)):
        yield raw[i].as_py() or b""


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 2000):
            part = b.slice(at, 2000)
            n, node, bands, sig = [], [], [], []
            for raw in _texts(part.column(1)):
                found = shingles(raw)
                n.append(len(found))
                node.append(node_hash(found))
                low = minima(found) if len(found) else None
                bands.append(band_keys(low) if len(found) else None)
                sig.append(packed(low) if len(found) else None)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                                              pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.list_(pa.int64()))],
                                             names=["id", "n", "node", "bands", "sig"])


def signatures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n (set size), node (identity of the set), bands, sig; the last two null for an empty set."""
    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(
        df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
        _signatures, f"id {kind}, n long, node long, bands array<long>, sig array<long>")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 500):
            found = [shingles(raw) for raw in _texts(b.column(0).slice(at, 500))]
            yield pa.RecordBatch.from_pydict({"node": pa.array([node_hash(f) for f in found], pa.int64()),
                                              "shingles": pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))})


# -- estimate --------------------------------------------------------------
def least_equal(percent: int) -> int:
    """Equal positions that a candidate at `percent` similarity must show."""
    chance = 2.0 ** -BITS
    p = chance + (1 - chance) * percent / 100
    return int(np.floor(HASHES * p - MARGIN * np.sqrt(HASHES * p * (1 - p))))


def equal_positions(a: Column, b: Column) -> Column:
    """Positions whose kept bits agree, by bit operations on the planes."""
    out = F.lit(HASHES)
    for w in range(_PLANE):
        differ = a[w].bitwiseXOR(b[w])
        for plane in range(1, BITS):
            differ = differ.bitwiseOR(a[plane * _PLANE + w].bitwiseXOR(b[plane * _PLANE + w]))
        out = out - F.bit_count(differ)
    return out


def _equal_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full((len(a), len(b)), HASHES, dtype=np.int32)
    for w in range(_PLANE):
        differ = a[:, None, w] ^ b[None, :, w]
        for plane in range(1, BITS):
            differ |= a[:, None, plane * _PLANE + w] ^ b[None, :, plane * _PLANE + w]
        out -= np.bitwise_count(differ)
    return out


def estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimate reaches the bound less the margin."""
    sig = nodes.select("node", "sig")
    both = (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b"))
    return both.where(equal_positions(F.col("sa"), F.col("sb")) >= least_equal(percent)).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that reach `percent` on the full sets."""
    of = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b")


# -- components ------------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """node, comp (least node of its component) for the nodes of `edges` (a, b).

    Every round takes the least label of the neighbours, then the label's label;
    each round is a written table, and the loop ends when nothing changes.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc_edges")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp")).select(F.col("a").alias("node"), "comp"), "cc")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("comp").alias("near")))
        step = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        roots = labels.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        new = written(step.join(roots, "comp").select("node", "old", F.least("comp", "root").alias("comp")), "cc")
        labels = new.select("node", "comp")
        if not new.where("old <> comp").limit(1).count():
            return labels


# -- candidates ------------------------------------------------------------
def _cells(cut: int, nearest: bool):
    """Pairs of one cell of a large bucket: blocks i and j of its nodes. All that
    reach `cut`, or with `nearest` only the best partner of each node."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        band, i, j = key[1].as_py(), key[2].as_py(), key[3].as_py()
        node, comp, block = (rows.column(c).to_numpy() for c in ("node", "comp", "block"))
        sig, bands = (rows.column(c).combine_chunks().flatten().to_numpy().reshape(len(node), -1) for c in ("sig", "bands"))
        sig = sig.view(np.uint64)  # bits of a signed number would be counted in its absolute value
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        found = []
        best = np.full((2, len(node)), -1)  # of each right node: estimate, left node
        for at in range(0, len(left), 128):
            part = left[at:at + 128]
            equal = _equal_matrix(sig[part], sig[right])
            equal[comp[part][:, None] == comp[right][None, :]] = -1
            if nearest and len(right):
                x = np.arange(len(part))
                y = equal.argmax(axis=1)
                up = equal.argmax(axis=0)
                top = equal[up, np.arange(len(right))]
                better = top > best[0, right]
                best[:, right[better]] = np.stack([top[better], part[up[better]]])
                ok = equal[x, y] >= cut
                x, y = x[ok], y[ok]
            else:
                x, y = np.nonzero(equal >= cut)
            found.append(np.stack([part[x], right[y]]))
        if nearest:
            ok = np.flatnonzero(best[0] >= cut)
            found.append(np.stack([best[1, ok], ok]))
        x, y = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
        once = (bands[x] == bands[y]).argmax(axis=1) == band  # each pair in the first band that it shares
        if i == j and not nearest:
            once &= node[x] < node[y]
        pairs = np.sort(np.stack([node[x[once]], node[y[once]]]), axis=0)
        if nearest:
            pairs = np.unique(pairs, axis=1)
        return pa.table([pairs[0], pairs[1]], schema=schema)
    return run


def _mixed(members: DataFrame, comps: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with the bucket's size."""
    placed = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return written(placed.join(sizes.where("lo <> hi").select("key", "size"), "key").select("key", "band", "node", "comp", "size"), "nd_mixed")


def _large(mixed: DataFrame, nodes: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Candidate pairs across components in buckets of more than SMALL_BUCKET nodes."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = (mixed.where(F.col("size") > SMALL_BUCKET).join(nodes.select("node", "sig", "bands"), "node")
            .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))
    return rows.select("key", "band", "i", "j", "node", "comp", "block", "sig", "bands").groupBy("key", "band", "i", "j").applyInArrow(
        _cells(least_equal(percent), nearest), "a long, b long")


def _small(mixed: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The same in buckets of at most SMALL_BUCKET nodes."""
    small = mixed.where(F.col("size") <= SMALL_BUCKET)
    pairs = (small.select("key", F.col("node").alias("a"), F.col("comp").alias("ca"))
             .join(small.select("key", F.col("node").alias("b"), F.col("comp").alias("cb")), "key")
             .where("a < b and ca <> cb").select("a", "b").distinct())
    return estimated(pairs, nodes, percent)


def near_duplicates(df: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (least id of its component), kept."""
    signed = written(signatures(df, id_col, text_col), "nd_signatures")
    nodes = written(signed.where("n > 0").groupBy("node").agg(
        F.min("id").alias("label"), F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig")), "nd_nodes")
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    crowded = banded.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader <> last")
    members = written(banded.join(crowded.select("key", "leader"), "key"), "nd_members")

    # The full sets of all nodes that share a bucket.
    wanted = members.select("node").distinct()
    firsts = nodes.join(wanted, "node", "left_semi").select(F.col("label").alias("first")).distinct()
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(firsts, F.col("id").eqNullSafe(F.col("first")), "left_semi")
    sets = written(map_arrow(texts.select("text"), _sets, "node long, shingles array<long>")
                   .groupBy("node").agg(F.any_value("shingles").alias("shingles")), "nd_sets")

    stars = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    tried = written(estimated(stars, nodes, percent), "nd_stars")
    links = written(confirmed(tried, sets, percent), "nd_links")

    def confirm(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        fresh = written(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "nd_pairs")
        return tried.unionByName(fresh), links.unionByName(written(confirmed(fresh, sets, percent), "nd_links"))

    mixed = _mixed(members, components(links))
    for _ in range(NEAREST_ROUNDS):
        if not mixed.where(F.col("size") > SMALL_BUCKET).limit(1).count():
            break
        tried, links = confirm(_large(mixed, nodes, percent, nearest=True))
        mixed = _mixed(members, components(links))
    tried, links = confirm(_small(mixed, nodes, percent).unionByName(_large(mixed, nodes, percent, nearest=False)))
    comps = components(links)

    named = nodes.select("node", "label").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    names = written(named.join(named.groupBy("comp").agg(F.min("label").alias("component")), "comp").select("node", "component"), "nd_components")
    out = signed.select("id", "n", "node").join(names, "node", "left")
    component = F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
