"""Array files of JSON objects, read by many tasks.

A multi-line JSON file is one task to Spark's own reader. Here the file is read as
text with "}" for the line end, which Spark splits by byte ranges. Whether a piece
lies inside a string, and how deep, depends on all that comes before it, but
only through a small state, so

1. every split tells, for both ways to begin (outside or inside a string), how it ends,
   its change of depth and the least depth on the way;
2. the splits of a file are chained (one small row per split): now every
   split's true beginning is known, and in which split the object began that is open there;
3. the splits are read again and cut into objects; an object that crosses a
   split's border gives a fragment per split, put together by its first split.

Defined results: objects come in no order; an empty array or file gives no row;
an object that does not parse gives a row of NULLs, as with Spark's reader; a
file holds objects only at its top level; an object that the schema keeps as
text is written without blanks. Compressed files are one split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
_REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*"', re.S)


def walk(piece: str, inside: bool) -> tuple[bool, int]:
    """State after a piece (text between two "}"), and the objects it opens."""
    if inside:
        end = _REST_OF_STRING.match(piece)
        if end is None:
            return True, 0
        piece = piece[end.end():]
    bare = _STRING.sub("", piece)
    quote = bare.find('"')
    return quote >= 0, bare.count("{", 0, quote if quote >= 0 else len(bare))


class _Scan:
    """What `walk` finds, for all pieces of an Arrow array at once: quotes and braces are looked up in the array's bytes.

    A backslash outside of strings escapes nothing, and is no JSON: the few pieces that have one are walked."""

    def __init__(self, values: pa.Array):
        self.values, n = values, len(values)
        joined = pc.binary_join_element_wise(values.cast(pa.large_string()), pa.scalar("}", pa.large_string()), pa.scalar("", pa.large_string()))
        self.off = np.frombuffer(joined.buffers()[1], np.int64, n + 1, 8 * joined.offset)
        self.data = data = np.frombuffer(joined.buffers()[2], np.uint8)
        quote, slash = data == 34, np.flatnonzero(data == 92)
        if len(slash):  # a quote behind an odd number of backslashes is text
            first = np.flatnonzero(np.concatenate([[True], np.diff(slash) > 1]))
            count = np.diff(np.append(first, len(slash)))
            quote[(slash[first] + count)[count % 2 == 1]] = False
        self.quotes, self.braces = np.flatnonzero(quote), np.flatnonzero(data == 123)
        self.before = np.searchsorted(self.quotes, self.off)  # quotes before each piece
        self.odd = (np.diff(self.before) & 1).astype(bool)
        at, side = self._sides(self.braces)
        self.opens = [np.bincount(at[side == i], minlength=n) for i in (0, 1)]
        at, side = self._sides(slash)
        self.bare = [set(at[side == i].tolist()) for i in (0, 1)]  # by the state in which the piece begins

    def _sides(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece of each place, and the beginning for which it lies outside of strings."""
        at = np.searchsorted(self.off, places, side="right") - 1
        return at, (np.searchsorted(self.quotes, places) - self.before[at]) & 1

    def run(self, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For a beginning inside or outside of a string: state before and after each piece, and the objects it opens."""
        states = np.concatenate([[False], np.logical_xor.accumulate(self.odd)]) ^ bool(inside)
        opened = np.where(states[:-1], self.opens[1], self.opens[0])
        for i in sorted(self.bare[0] | self.bare[1]):
            if i in self.bare[int(states[i])]:
                end, opened[i] = walk(self.values[i].as_py(), bool(states[i]))
                if end != states[i + 1]:
                    states[i + 1:] ^= True
                    opened[i + 1:] = np.where(states[i + 1:-1], self.opens[1][i + 1:], self.opens[0][i + 1:])
        return states[:-1], states[1:], opened

    def text(self, start: int, end: int) -> str:
        return self.data[start:end].tobytes().decode()

    def texts(self, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts between `starts` and `ends`, which do not overlap."""
        edge = np.zeros(len(self.data) + 1, dtype=np.int8)
        edge[starts] += 1
        edge[ends] -= 1  # one object may begin where another ends
        kept = self.data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
        off = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(off), pa.py_buffer(kept)).cast(pa.string())


def _splits(batch: pa.RecordBatch, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, cut where the split changes."""
    n = batch.num_rows
    new = np.zeros(max(0, n - 1), dtype=bool)
    for k in keys:
        column = batch.column(batch.schema.get_field_index(k))
        new |= pc.not_equal(column.slice(1), column.slice(0, max(0, n - 1))).to_numpy(zero_copy_only=False)
    ends = [*(np.flatnonzero(new) + 1).tolist(), n] if n else []
    for at, to in zip([0, *ends], ends):
        yield batch.slice(at, to - at)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: for both beginnings, the end state, the change of depth, the least depth."""
    state: dict[tuple, list] = {}
    for batch in batches:
        for part in _splits(batch, ["path", "block"]):
            path, block, values = part.columns
            runs = state.setdefault((path[0].as_py(), block[0].as_py()), [[False, 0, 0], [True, 0, 0]])
            scan = _Scan(values)
            for run in runs:
                _, end, opened = scan.run(run[0])
                depth = run[1] + np.cumsum(opened - ~end)  # the "}" behind the piece, unless it is text
                run[:] = [bool(end[-1]), int(depth[-1]), min(run[2], int(depth.min()))]
    rows = [(*key, *runs[0], *runs[1]) for key, runs in state.items()]
    names = ["path", "block", "end0", "change0", "least0", "end1", "change1", "least1"]
    types = [pa.string(), pa.int64()] + [pa.bool_(), pa.int64(), pa.int64()] * 2
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """The true beginning of every split of one file, and the split where its open object began."""
    inside, depth, owner, out = False, 0, -1, []
    for r in pdf.sort_values("block").itertuples(index=False):
        out.append((r.path, r.block, inside, depth, owner))
        end, change, least = (r.end1, r.change1, r.least1) if inside else (r.end0, r.change0, r.least0)
        if depth == 0 or depth + least <= 0:
            owner = r.block
        inside, depth = bool(end), max(0, depth + change)
    return pd.DataFrame(out, columns=["path", "block", "inside", "depth", "owner"])


class _Cutter:
    """Cuts one split's pieces into objects and fragments."""

    def __init__(self, path: str, block: int, inside: bool, depth: int, owner: int):
        self.path, self.block, self.inside, self.depth, self.owner = path, block, inside, depth, owner
        self.text: list[str] = []
        self.own = depth == 0  # the open object began here

    def take(self, piece: str) -> tuple | None:
        if self.depth == 0:  # between objects: what comes before the next one is dropped
            self.own, self.text = True, []
            at = _STRING.sub(lambda m: " " * len(m[0]), piece).find("{")
            if at < 0:
                return None
            piece = piece[at:]
        self.inside, opened = walk(piece, self.inside)
        self.text.append(piece + "}")
        self.depth += opened - (not self.inside)
        return self._row() if self.depth <= 0 else None

    def _row(self) -> tuple:
        self.depth = max(0, self.depth)
        whole = self.own and self.depth == 0
        row = (self.path, self.block if self.own else self.owner, self.block, "".join(self.text), whole)
        self.text = []
        return row

    def take_all(self, values: pa.Array) -> Iterator[tuple | pa.Array]:
        """Rows of fragments and of carried objects, and arrays of objects that lie in `values`."""
        slow = 0  # pieces out of order, as behind the last object
        while len(values):
            if slow > 3:
                yield from filter(None, map(self.take, values.to_pylist()))
                return
            done, found = self._regular(_Scan(values))
            yield from found
            if done == len(values):
                return
            slow += 1
            if (row := self.take(values[done].as_py())) is not None:
                yield row
            values = values.slice(done + 1)

    def _regular(self, scan: _Scan) -> tuple[int, list]:
        """Cuts the first pieces, as far as objects follow one another, and tells how many that were."""
        before, end, opened = scan.run(self.inside)
        after = self.depth + np.cumsum(opened - ~end)
        top = np.concatenate([[self.depth], after[:-1]]) == 0
        brace = np.searchsorted(scan.braces, scan.off[:-1])  # the first one of each piece
        at = np.append(scan.braces, len(scan.data))[brace]
        bare = np.zeros(len(top), dtype=bool)
        bare[list(scan.bare[0])] = True
        strange = (after < 0) | (top & (before | bare | (opened == 0) | (np.searchsorted(scan.quotes, at) > scan.before[:-1])))
        n = int(np.argmax(strange)) if strange.any() else len(strange)
        if n == 0:
            return 0, []
        out, starts, ends = [], at[:n][top[:n]], scan.off[1:n + 1][after[:n] == 0]
        if self.depth > 0:  # the object that was open
            stop = int(ends[0]) if len(ends) else int(scan.off[n])
            self.text.append(scan.text(0, stop))
            if len(ends):
                self.depth = 0
                out.append(self._row())
                ends = ends[1:]
        if len(ends):
            out.append(scan.texts(starts[:len(ends)], ends))
        if len(starts) > len(ends):
            self.own, self.text = True, [scan.text(int(starts[-1]), int(scan.off[n]))]
        self.inside, self.depth = bool(end[n - 1]), int(after[n - 1])
        return n, out

    def finish(self) -> tuple | None:
        """What is left belongs to an object that goes on in the next split."""
        return self._row() if self.depth > 0 and self.text else None


def _objects(whole: bool):
    """The texts of the objects that lie in one split, or the fragments of the others."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple | pa.Array | None]:
        cutter = None
        for batch in batches:
            for part in _splits(batch, ["path", "block"]):
                path, block, inside, depth, owner = (c[0].as_py() for c in part.columns[:-1])
                if cutter is None or (cutter.path, cutter.block) != (path, block):
                    if cutter is not None:
                        yield cutter.finish()
                    cutter = _Cutter(path, block, inside, depth, owner)
                yield from cutter.take_all(part.column(part.num_columns - 1))
        if cutter is not None:
            yield cutter.finish()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            if isinstance(row, pa.Array):
                if whole:
                    yield pa.RecordBatch.from_arrays([row], names=["text"])
            elif row is not None and row[-1] == whole:
                path, owner, block, text, _ = row
                yield pa.RecordBatch.from_pydict({"text": [text]} if whole else {
                    "path": [path], "owner": pa.array([owner], pa.int64()), "block": pa.array([block], pa.int64()), "text": [text]})
    return run


def read_json_arrays(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The objects of all array files, with the columns of `schema`."""
    pieces = (spark.read.option("lineSep", "}").text(paths)
              .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value"))
    splits = pieces.mapInArrow(_summaries, "path string, block long, end0 boolean, change0 long, least0 long, end1 boolean, change1 long, least1 long")
    begins = splits.groupBy("path").applyInPandas(_chain, "path string, block long, inside boolean, depth long, owner long")
    # One row per split. A broadcast join keeps the order of the pieces within their split.
    placed = pieces.join(F.broadcast(begins), ["path", "block"]).select("path", "block", "inside", "depth", "owner", "value")
    cut = placed.mapInArrow(_objects(whole=True), "text string")
    crossing = (placed.mapInArrow(_objects(whole=False), "path string, owner long, block long, text string")
                .groupBy("path", "owner").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"))
                .select(F.array_join("parts.text", "").alias("text")))
    objects = cut.unionByName(crossing)
    return objects.select(F.from_json("text", schema).alias("r")).select("r.*")
