"""Token-id shards with a minimal perfect hash index: constant-time keyed access.

`write` sorts the documents by key over range partitions, encodes them with the
tokenizers library and writes raw ids, `read` finds documents by key again.

Layout of a store (a folder on a file system that all executors reach):

  shard-<number>.ids   header (magic, bytes per id, documents, ids), the ids of
                       its documents one after another, then the end position
                       of every document in the shard (int64)
  index-<part>.mph     header (magic, keys, buckets, runs, seed), displacement
                       per bucket, then per slot: fingerprint (int64), first run
                       and number of runs, then the runs: shard (int64), number of
                       the first document in the shard (int64), number of
                       documents (int64), ids of all documents before (int64)

A key belongs to the part hash(key) mod parts. Within a part, hash-and-displace
maps n keys to n slots without gaps: a key's bucket names a displacement, the
displaced hash is its slot, and the stored fingerprint, a second 64-bit hash,
rejects keys that are not in the store (one in 2^64 of them gets through). So
a look-up reads one displacement and one slot. Keys of one part with equal first
hashes are told apart by the second: such a part is built with the next seed.

A key's documents are a run of neighbours in one shard, or several runs: range
partitions are cut by key, text hash and row, and shards by size, so a key that a
third of all documents carry is written and read by many tasks.

Files are written under a name of their own task attempt and then renamed, so
a repeated or speculative task leaves one whole file with the same content.

Defined results: a null text counts as empty and has the end id alone; a key
that several documents carry leads to all of them, in the order of the text
hash; null is a key like any other and sorts first; keys that the store lacks
give no row; an empty table gives a store without shards; further columns are
ignored. Rows equal in key and text are dealt by their place in `df`, which
should therefore be a table or another plan that repeats its rows in order.
"""

from __future__ import annotations

import functools
import json
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelens.llm.bpe import slices
from pricelens.llm.common import map_arrow, written

END_ID = 0
SHARD_BYTES = 16 << 20
KEYS_PER_PART = 1 << 16
CACHE_PARTS = 500_000
SLICE_BYTES = 4 << 20
READ_BYTES = 8 << 20
RUNS_AT_ONCE = 10_000
_SHARD_MAGIC, _INDEX_MAGIC = b"PLTOKENS", b"PLMPHIDX"
_SLOT = np.dtype([("mark", "<i8"), ("run", "<i8"), ("runs", "<i8")])
_RUN = np.dtype([("shard", "<i8"), ("first", "<i8"), ("docs", "<i8"), ("start", "<i8")])


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    path: str
    parts: int


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    for name in ("s3a://", "s3n://"):  # Hadoop's names of the scheme
        if uri.startswith(name):
            uri = "s3://" + uri[len(name):]
    return pafs.FileSystem.from_uri(uri)


def _put(uri: str, name: str, chunks: list[bytes]) -> None:
    fs, root = filesystem(uri)
    fs.create_dir(root, recursive=True)
    part = f"{root}/.{name}-{TaskContext.get().taskAttemptId()}-{os.getpid()}"
    with fs.open_output_stream(part) as out:
        for c in chunks:
            out.write(c)
    fs.move(part, f"{root}/{name}")


# -- encoding ------------------------------------------------------------
class LibraryEncoder:
    """Ids from the tokenizers library, for many texts at a time.

    Texts are cut before blanks and line ends that follow something other than
    white space, where the file's pre-tokenizer always begins a new piece, so the ids of the parts in a
    row are the ids of the text. The distinct parts of all texts together are
    looked up, those not met lately are encoded in one call, and every text's ids are
    gathered from theirs.
    Files with other settings than plain byte-level BPE are used text by text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2" if max(vocabulary.values(), default=0) < 1 << 16 else "<u4")
        config = json.loads(self.library.to_str())
        added = [t["content"] for t in config["added_tokens"]]
        split = config["pre_tokenizer"] or {}
        self.plain = (config["normalizer"] is None and config["model"]["type"] == "BPE" and not config["truncation"] and not config["padding"]
                      and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
                      and not any(c.isspace() for t in added for c in t) and not any(t["lstrip"] or t["rstrip"] for t in config["added_tokens"]))
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        # Bytes of every id: a symbol of the vocabulary stands for one byte.
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token.encode()) if token in added else len(token)

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.kind)

    def _encode_each(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [self._library(p) for p in parts]
        return np.concatenate([*each, np.zeros(0, self.kind)]), np.array([len(e) for e in each], dtype=np.int64)

    def _encode_row(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts that may stand in a row (each begins with a blank or line
        end and ends otherwise), from one call, and their numbers."""
        ids = self._library("".join(parts))
        ends = np.cumsum(np.fromiter((len(p.encode()) for p in parts), dtype=np.int64, count=len(parts)))
        covered = np.cumsum(self.bytes[ids])
        last = np.searchsorted(covered, ends)
        if len(parts) and (not len(covered) or last[-1] >= len(covered) or (covered[last] != ends).any()):
            return self._encode_each(parts)  # bytes that the vocabulary lacks
        return ids, np.diff(last + 1, prepend=0)

    def _learn(self, parts: list[bytes]) -> None:
        """Encode parts that are not at hand."""
        texts = [p.decode() for p in parts]
        in_row = [p[0] in " \n" and not p[-1].isspace() for p in texts]
        for flag, encode in ((True, self._encode_row), (False, self._encode_each)):
            chosen = [k for k, row in enumerate(in_row) if row == flag]
            if chosen:
                ids, n = encode([texts[k] for k in chosen])
                ends = np.cumsum(n * self.kind.itemsize).tolist()
                raw = ids.tobytes()
                self.known.update(zip([parts[k] for k in chosen], [raw[a:z] for a, z in zip([0, *ends[:-1]], ends, strict=True)], strict=True))

    def _encode_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts one after another, and their numbers. Parts met
        lately are at hand, in two generations of at most about CACHE_PARTS each."""
        if len(self.known) > CACHE_PARTS:
            self.older, self.known = self.known, {}
        missing = [p for p in parts if p not in self.known]
        if self.older:
            self.known.update({p: self.older[p] for p in missing if p in self.older})
            missing = [p for p in missing if p not in self.older]
        if missing:
            self._learn(missing)
        ids = list(map(self.known.__getitem__, parts))
        return np.frombuffer(b"".join(ids), self.kind), np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // self.kind.itemsize

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the ends of each text's."""
        if not self.plain:
            ids, n = self._encode_each([t or "" for t in texts.to_pylist()])
            return ids, np.cumsum(n)
        texts = pa.compute.fill_null(texts.cast(pa.large_binary()), b"")
        offsets = np.frombuffer(texts.buffers()[1], "<i8", len(texts) + 1, texts.offset * 8)
        if offsets[-1] == offsets[0]:
            return np.zeros(0, self.kind), np.zeros(len(texts), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        at = np.append(np.flatnonzero(_cuts(data, offsets[:-1])), len(data))
        parts = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        ids, count = self._encode_parts(parts.dictionary.to_pylist())
        which = parts.indices.to_numpy()
        n = count[which]
        ends = np.cumsum(n)
        out = ids[np.repeat((np.cumsum(count) - count)[which] - (ends - n), n) + np.arange(ends[-1])]
        return out, np.concatenate([[0], ends])[np.searchsorted(at, offsets[1:])]

    def encode(self, text: str) -> bytes:
        return self.encode_texts(pa.array([text], pa.string()))[0].tobytes()


def _cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Marks the bytes at which a part begins: a text's first, and a blank or line
    end behind a byte that surely ends no white space (of any alphabet)."""
    cut = np.zeros(len(data), dtype=bool)
    before = data[:-1]
    sure = before > 0x20
    # White space beyond ASCII: C2 85, C2 A0, and three bytes with 80, 81 or 9A in the middle.
    wide = np.flatnonzero((before >= 0x80) & ((data[1:] == 0x20) | (data[1:] == 0x0A)))
    middle = data[np.maximum(wide - 1, 0)]
    sure[wide[np.isin(middle, (0x80, 0x81, 0x9A)) | ((middle == 0xC2) & np.isin(before[wide], (0x85, 0xA0)))]] = False
    cut[1:] = sure & ((data[1:] == 0x20) | (data[1:] == 0x0A))
    cut[starts[starts < len(data)]] = True
    return cut


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


_META = pa.schema([("key", pa.string()), ("id", pa.int64()), ("partition", pa.int32()), ("shard", pa.int64()),
                   ("first", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64())])


class _ShardWriter:
    """Collects the documents of one range partition and writes shards of SHARD_BYTES."""

    def __init__(self, path: str, width: int, shard_bytes: int):
        self.path, self.width, self.shard_bytes, self.partition = path, width, shard_bytes, TaskContext.get().partitionId()
        self.number, self.rows = 0, []
        self._clear()

    def _clear(self):
        self.payload, self.ends, self.size, self.last = [], [], 0, object()

    def add(self, key, ids: bytes) -> None:
        if self.size * self.width >= self.shard_bytes:
            self.flush()
        shard = (self.partition << 32) + self.number
        if key == self.last:
            self.rows[-1][5] += 1
            self.rows[-1][6] += len(ids) // self.width
        else:  # a new run: another key, or another shard
            self.rows.append([None if key is None else str(key), key, self.partition, shard, len(self.ends), 1, len(ids) // self.width])
            self.last = key
        self.payload.append(ids)
        self.size += len(ids) // self.width
        self.ends.append(self.size)

    def flush(self) -> None:
        if self.ends:
            head = _SHARD_MAGIC + struct.pack("<qqq", self.width, len(self.ends), self.size)
            _put(self.path, f"shard-{(self.partition << 32) + self.number:016x}.ids",
                 [head, *self.payload, np.array(self.ends, dtype="<i8").tobytes()])
            self.number += 1
        self._clear()

    def take(self) -> pa.RecordBatch:
        """The finished rows; the last stays while its run may go on."""
        done, self.rows = self.rows[:-1], self.rows[-1:]
        return self._batch(done)

    def finish(self) -> pa.RecordBatch:
        self.flush()
        return self._batch(self.rows)

    @staticmethod
    def _batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_META)], schema=_META)


def _write_shards(vocabulary: str, path: str, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        end = np.array([END_ID], dtype=encoder.kind).tobytes()
        out = _ShardWriter(path, encoder.kind.itemsize, shard_bytes)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            lengths = np.array(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64)
            for at, to in slices(lengths, SLICE_BYTES):
                ids, ends = encoder.encode_texts(texts.slice(at, to - at))
                for key, a, b in zip(keys.slice(at, to - at).to_pylist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    out.add(key, ids[a:b].tobytes() + end)
            yield out.take()
        yield out.finish()
    return run


# -- index ---------------------------------------------------------------
def key_hash(key: str | Column) -> Column:
    return F.xxhash64(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"))


def key_mark(key: str) -> Column:
    """A hash that is independent of the first."""
    return F.xxhash64(F.lit("mark"), F.col(key).cast("string"))


def _mix(h: np.ndarray, d: np.ndarray | int) -> np.ndarray:
    """A well-mixed 64-bit hash of the key hash and a displacement."""
    z = h + (np.atleast_1d(d).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def build_mph(h: np.ndarray) -> np.ndarray:
    """Displacements that map the distinct hashes `h` to 0..n-1 without gaps.

    Buckets (four keys on average) are placed from the largest to the smallest;
    a bucket tries displacements until its keys fall into free, distinct slots.
    A bucket of one key takes any free slot: -(slot + 1) names it directly.
    """
    n = len(h)
    n_buckets = max(1, -(-n // 4))
    bucket = (_mix(h, 0) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=n_buckets)
    begin = np.cumsum(size) - size
    taken = np.zeros(n, dtype=bool)
    out = np.zeros(n_buckets, dtype=np.int64)
    tries = np.arange(1, 33)
    for b in np.argsort(-size, kind="stable"):
        if size[b] < 2:
            break
        keys = h[order[begin[b]:begin[b] + size[b]]]
        base = 0
        while True:
            slots = (_mix(keys[None, :], (base + tries)[:, None]) % np.uint64(n)).astype(np.int64)
            ordered = np.sort(slots, axis=1)
            fits = ~taken[slots].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if fits.any():
                at = int(np.argmax(fits))
                taken[slots[at]] = True
                out[b] = base + tries[at]
                break
            base += len(tries)
    single = np.flatnonzero(size == 1)
    out[single] = -1 - np.flatnonzero(~taken)[:len(single)]
    return out


def slots_of(h: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    d = displacement[(_mix(h, 0) % np.uint64(len(displacement))).astype(np.int64)]
    return np.where(d < 0, -1 - d, (_mix(h, np.maximum(d, 0)) % np.uint64(n)).astype(np.int64))


def _seeded(h: np.ndarray, mark: np.ndarray, seed: int) -> np.ndarray:
    """The hashes that a part is built on: the first ones, or mixtures of both."""
    return h if seed == 0 else _mix(h ^ _mix(mark, seed), seed)


def _write_index(path: str):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        h, mark = (rows.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("h", "mark"))
        order = np.lexsort((rows.column("start").to_numpy(), mark, h))
        h, mark = h[order], mark[order]
        fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (mark[1:] != mark[:-1])])
        first = np.flatnonzero(fresh)
        seed = 0
        while len(np.unique(own := _seeded(h[first], mark[first], seed))) < len(first):
            seed += 1
        displacement = build_mph(own)
        at = slots_of(own, displacement, len(own))
        slots, runs = np.zeros(len(own), dtype=_SLOT), np.zeros(len(h), dtype=_RUN)
        slots["mark"][at], slots["run"][at] = mark[first].view(np.int64), first
        slots["runs"][at] = np.diff(np.append(first, len(h)))
        for name in _RUN.names:
            runs[name] = rows.column(name).to_numpy()[order]
        part = key[0].as_py()
        _put(path, f"index-{part:08x}.mph", [_INDEX_MAGIC, struct.pack("<qqqq", len(own), len(displacement), len(runs), seed),
                                             displacement.astype("<i8").tobytes(), slots.tobytes(), runs.tobytes()])
        return pa.table({"part": [part], "keys": [len(own)]})
    return run


def write(df: DataFrame, vocabulary: str, path: str, id_col: str = "doc_id", text_col: str = "text",
          keys_per_part: int = KEYS_PER_PART, shard_bytes: int = SHARD_BYTES) -> Store:
    """Encode and write all documents of `df` below `path`, then the index."""
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text"), "row"]
    docs = (df.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
            .repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text"))
    entries = written(map_arrow(docs, _write_shards(vocabulary, path, shard_bytes),
                                "key string, id long, partition int, shard long, first long, docs long, ids long"), "token_entries")
    # The first id of every range partition: as many rows as there are write tasks.
    totals = sorted((r["partition"], r["n"]) for r in entries.groupBy("partition").agg(F.sum("ids").alias("n")).collect())
    base, bases = 0, []
    for partition, n in totals:
        bases.append((partition, base))
        base += n
    spark = df.sparkSession
    before = F.broadcast(spark.createDataFrame(bases, "partition int, base long"))
    earlier = Window.partitionBy("partition").orderBy("shard", "first").rowsBetween(Window.unboundedPreceding, -1)
    placed = entries.withColumn("start", F.coalesce(F.sum("ids").over(earlier), F.lit(0))).join(before, "partition")
    parts = max(1, -(-entries.count() // keys_per_part))
    rows = placed.select(key_hash("key").alias("h"), key_mark("key").alias("mark"), "shard", "first", "docs",
                         (F.col("start") + F.col("base")).alias("start"))
    written(rows.withColumn("part", F.pmod("h", F.lit(parts))).groupBy("part")
            .applyInArrow(_write_index(path), "part long, keys long"), "token_index")
    return Store(spark, path, parts)


# -- reading -------------------------------------------------------------
class Index:
    """One part of the index."""

    def __init__(self, path: str, part: int):
        fs, root = filesystem(path)
        info = fs.get_file_info(f"{root}/index-{part:08x}.mph")
        if info.type == pafs.FileType.NotFound:
            self.n = 0
            return
        with fs.open_input_file(info.path) as f:
            raw = f.read()
        if raw[:8] != _INDEX_MAGIC:
            raise ValueError(f"{info.path}: not an index")
        self.n, buckets, runs, self.seed = struct.unpack_from("<qqqq", raw, 8)
        self.displacement = np.frombuffer(raw, "<i8", buckets, 40)
        self.table = np.frombuffer(raw, _SLOT, self.n, 40 + 8 * buckets)
        self.runs = np.frombuffer(raw, _RUN, runs, 40 + 8 * buckets + _SLOT.itemsize * self.n)

    def look_up(self, h: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the keys that are in the store, once per run, and the runs."""
        if not self.n:
            return np.zeros(0, np.int64), np.zeros(0, _RUN)
        own = _seeded(h.view(np.uint64), mark.view(np.uint64), self.seed)
        rows = self.table[slots_of(own, self.displacement, self.n)]
        found = np.flatnonzero(rows["mark"] == mark)
        rows = rows[found]
        behind = np.cumsum(rows["runs"])
        number = np.repeat(rows["run"] - (behind - rows["runs"]), rows["runs"]) + np.arange(behind[-1] if len(behind) else 0)
        return np.repeat(found, rows["runs"]), self.runs[number]


def _look_up(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, index = None, None
        for b in batches:
            numbers, h, mark = (b.column(i).to_numpy() for i in (1, 2, 3))
            for p in np.unique(numbers):
                if p != part:
                    part, index = p, Index(path, int(p))
                at = np.flatnonzero(numbers == p)
                found, runs = index.look_up(h[at], mark[at])
                for a in range(0, len(found), RUNS_AT_ONCE):
                    some = runs[a:a + RUNS_AT_ONCE]
                    yield pa.RecordBatch.from_pydict({"key": b.column(0).take(pa.array(at[found[a:a + RUNS_AT_ONCE]])), **{
                        n: np.ascontiguousarray(some[n]) for n in _RUN.names}})
    return run


def shard_documents(path: str, shard: int, first: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each wanted run of documents: (its number, ids) per document, reading only its bytes."""
    fs, root = filesystem(path)
    with fs.open_input_file(f"{root}/shard-{shard:016x}.ids") as f:
        head = f.read_at(32, 0)
        if head[:8] != _SHARD_MAGIC:
            raise ValueError(f"{root}: shard {shard:016x} is not a shard")
        width, n_docs, n_ids = struct.unpack("<qqq", head[8:])
        ends = np.concatenate([[0], np.frombuffer(f.read_at(8 * n_docs, 32 + width * n_ids), "<i8")])
        kind = "<u2" if width == 2 else "<u4"
        for run, (a, n) in enumerate(zip(first.tolist(), docs.tolist(), strict=True)):
            ids = np.frombuffer(f.read_at(int(width * (ends[a + n] - ends[a])), int(32 + width * ends[a])), kind)
            for d in range(a, a + n):
                yield run, ids[ends[d] - ends[a]:ends[d + 1] - ends[a]]


def _read_shards(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shards, first, docs, start = (b.column(i).to_numpy() for i in (1, 2, 3, 4))
            for shard in np.unique(shards):
                at = np.flatnonzero(shards == shard)
                rows, starts, counts, payload, size = [], [], [], [], 0
                before, last = 0, -1
                for r, ids in shard_documents(path, int(shard), first[at], docs[at]):
                    before, last = (before if r == last else int(start[at[r]])), r
                    rows.append(at[r])
                    starts.append(before)
                    counts.append(len(ids))
                    payload.append(ids.astype("<u4").tobytes())
                    before += len(ids)
                    size += len(ids) * 4
                    if size >= READ_BYTES:
                        yield _documents(b.column(0), rows, starts, counts, payload)
                        rows, starts, counts, payload, size = [], [], [], [], 0
                if rows:
                    yield _documents(b.column(0), rows, starts, counts, payload)
    return run


def _documents(keys: pa.Array, rows: list, starts: list, counts: list, payload: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(payload, pa.binary())],
        names=["key", "start", "n_tokens", "ids"])


def read(store: Store, keys: DataFrame) -> DataFrame:
    """The documents of the given keys (first column; each key once): `key`,
    `start` (ids of all documents before it), `n_tokens` and `ids` (32-bit
    little-endian). Keys meet the index part by part, then the shards one by one."""
    name, kind = keys.columns[0], keys.schema[0].dataType.simpleString()
    wanted = (keys.select(F.col(name).alias("key"), F.pmod(key_hash(name), F.lit(store.parts)).alias("part"),
                          key_hash(name).alias("h"), key_mark(name).alias("mark"))
              .repartition("part").sortWithinPartitions("part"))
    found = wanted.mapInArrow(_look_up(store.path), f"key {kind}, shard long, first long, docs long, start long")
    by_shard = found.repartition("shard").sortWithinPartitions("shard", "first")
    return by_shard.mapInArrow(_read_shards(store.path), f"key {kind}, start long, n_tokens long, ids binary")
