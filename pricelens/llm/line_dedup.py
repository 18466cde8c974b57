"""Line de-duplication with a deletion-neighbourhood join.

A line is dropped when an earlier line (smaller document id, then earlier in
its document) equals it or is within one edit (a character inserted, deleted or
replaced). Equal lines are collapsed first. Every distinct line that may have a
neighbour then emits hashed keys of its deletion variants,

    (variant, place)  for every place: the line without the character there
    (line)            the line itself, met by the variants of longer lines

and lines that share a key are joined: two lines with the same (variant, place)
differ in that one character; a line that equals another's variant is that line
with a character less. Only the earliest line of a key is needed to decide
about the others, so a key gives as many pairs as it has lines. The pairs'
edit distances are then verified on the texts.

Which lines may have a neighbour is found first, without loss. Of two lines
within one edit, the first or the last half(n) characters agree, where n is the
smaller length; only the texts of lines that share a half are read again, behind
a bit filter of fixed size on their hashes. Then n is cut into WINDOWS windows:
two lines whose edit lies in a window agree before and behind it, so a line
emits the variants of a window only where another line agrees around it.

The result is carried as kept places (at most one per distinct line), so a line
that a third of all documents hold gives one place and no hot group; texts meet
their places once, by document.

Defined results: lines end at line feeds; a null text has no lines and stays
null, an empty text is one blank line; blank lines are kept; lines of fewer
than `min_chars` characters only count as duplicates when equal; the earliest
of equal rows is fixed by id, then text hash, null ids last; of rows with equal
ids and texts one keeps lines (such tables are written once more); further
columns are ignored by `decisions`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import map_arrow, written

MIN_CHARS = 20
# Windows of a line in which the one edit may lie.
WINDOWS = 8
# Size of the bit filter: 262,144 words of 64 bits. More candidates make it let more lines through, never fewer.
FILTER_BITS = 1 << 24


def _first() -> Column:
    """Order of a line's occurrences."""
    return F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"), F.col("pos").alias("pos"))


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _row(id_col: str, text_col: str) -> Column:
    """Identity of a document."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def line_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row (identity of the document), id, pos, line, h (64-bit identity of the line)."""
    rows = df.select(F.col(id_col).alias("id"), _row(id_col, text_col).alias("row"),
                     F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line"))
    return rows.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn("h", F.xxhash64("line"))


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, _MULTIPLIER, dtype=np.uint64), dtype=np.uint64)])
    return _POWERS[:n]


def variant_keys(line: str) -> tuple[np.ndarray, int]:
    """Hashes of (line without character i, i) for every i; hash of (line).

    The line's polynomial hash is a sum over places, so leaving a character out
    shifts the places after it: prefix sums give every variant in one pass.
    """
    codes = _mix(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1))
    n = len(codes)
    power = _powers(n + 1)
    here = np.concatenate([[np.uint64(0)], np.cumsum(codes * power[:n], dtype=np.uint64)])
    moved = np.concatenate([[np.uint64(0)], np.cumsum(codes[1:] * power[:n - 1], dtype=np.uint64)]) if n else here
    without = here[:n] + (moved[-1] - moved)  # characters before i, and those after it one place earlier
    return without, int(here[n])


def _neighbourhood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per line and shared windows: the keys of the windows' variants.

    A window is d * WINDOWS + g: window g of the line's length less d. `kind`
    tells variants met at a place (0), variants of a longer line met as lines (1)
    and whole lines (2).
    """
    for b in batches:
        for at in range(0, b.num_rows, 200):
            h, key, whole = [], [], []
            for i in range(at, min(at + 200, b.num_rows)):
                without, own = variant_keys(b.column(1)[i].as_py())
                m = len(without)
                places: list[list[np.ndarray]] = [[], []]
                for window in b.column(2)[i].as_py():
                    d, g = divmod(window, WINDOWS)
                    n = m - d
                    # The last window of a longer line also has the place behind the shorter one.
                    places[d].append(np.arange(n * g // WINDOWS, n * (g + 1) // WINDOWS + (d and g == WINDOWS - 1)))
                same, longer = (np.concatenate([np.zeros(0, np.int64), *p]) for p in places)
                # A character that equals its left neighbour gives the same variant as that one.
                keys = [_mix(without[same] + (same + 1).astype(np.uint64) * _MULTIPLIER + np.uint64(m)),
                        np.unique(_mix(without[longer] + np.uint64(m - 1))),
                        _mix(np.full(int(bool(places[0])), np.uint64(own) + np.uint64(m), dtype=np.uint64))]
                key += [k.view(np.int64) for k in keys]
                whole += [np.full(len(k), kind, np.int8) for kind, k in enumerate(keys)]
                h.append(np.full(sum(map(len, keys)), b.column(0)[i].as_py(), dtype=np.int64))
            yield pa.RecordBatch.from_pydict({"h": np.concatenate(h), "key": np.concatenate(key), "kind": np.concatenate(whole)})


def _within_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1:] or (len(a) == len(b) and a[i + 1:] == b[i + 1:])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = [_within_one(x, y) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pydict({"h": b.column(0).filter(pa.array(keep, pa.bool_()))})


def _half_ends(line: Column) -> Column:
    """Hashes of the first and last halves under which a line meets those within one edit."""
    n = F.char_length(line)
    halves = F.array_distinct(F.array(F.floor(n / 2), F.floor((n - 1) / 2))).cast("array<int>")
    return F.flatten(F.transform(halves, lambda half: F.array(F.xxhash64(F.lit("first"), half, F.left(line, half)),
                                                              F.xxhash64(F.lit("last"), half, F.right(line, half)))))


def _window_ends(line: Column) -> Column:
    """Per window: its number, and the hash of what lies before and behind it."""
    out = []
    for d in (0, 1):
        n = F.char_length(line) - d
        for g in range(WINDOWS):
            start, stop = ((F.floor(n * k / WINDOWS)).cast("int") for k in (g, g + 1))
            out.append(F.struct(F.lit(d * WINDOWS + g).alias("window"),
                                F.xxhash64(n, F.lit(g), F.left(line, start), F.right(line, n - stop)).alias("end")))
    return F.array(*out)


def _shared(ends: DataFrame) -> DataFrame:
    """The rows of `ends` (h, end, ..) whose end several lines have."""
    several = ends.groupBy("end").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("end")
    return ends.join(several, "end", "left_semi")


def near_lines(lines: DataFrame, distinct: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """h of every distinct line that is within one edit of an earlier one.

    `lines` has all of them (h, line, id, row, pos), `distinct` one row per h with its `ends`.
    """
    halved = written(_shared(distinct.where("ends is not null").select("h", F.explode("ends").alias("end"))).select("h").distinct(), "ld_halved")
    # At most FILTER_BITS / 64 rows of two numbers: a bit filter that spares most texts the shuffle.
    slot = F.pmod(F.col("h"), F.lit(FILTER_BITS))
    word, bit = F.shiftright(slot, 6), "cast(pmod(h, 64) as int)"
    marks = halved.groupBy(word.alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("bits"))
    maybe = (lines.where(F.char_length("line") >= min_chars).withColumn("word", word).join(F.broadcast(marks), "word")
             .where(F.expr(f"(shiftrightunsigned(bits, {bit}) & 1L) = 1L")))
    candidates = written(maybe.groupBy("h").agg(F.any_value("line").alias("line"), F.min(_first()).alias("first")).join(halved, "h"), "ld_candidates")

    windows = (_shared(candidates.select("h", F.explode(_window_ends(F.col("line"))).alias("w")).select("h", "w.window", "w.end"))
               .groupBy("h").agg(F.collect_set("window").alias("windows")))
    keys = (candidates.join(windows, "h").select("h", "line", "windows").mapInArrow(_neighbourhood, "h long, key long, kind byte")
            .join(candidates.select("h", "first"), "h"))
    keys = written(keys, "ld_keys")
    # Variants of one place: everyone against the earliest. Whole lines: against the earliest variant that equals them.
    # Variants that equal a whole line: against that line (there is one, as equal lines are collapsed).
    least = keys.groupBy("key", "kind").agg(F.min(F.struct("first", "h")).alias("best"))
    met = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 1, 2).otherwise(1).cast("byte")
    pairs = (keys.select("key", "h", "first", met.alias("kind")).join(least, ["key", "kind"])
             .where(F.col("best.first") < F.col("first")).select("h", F.col("best.h").alias("other")).distinct())
    texts = candidates.select("h", "line")
    both = (pairs.join(texts, "h").join(texts.select(F.col("h").alias("other"), F.col("line").alias("other_line")), "other")
            .select("h", "line", "other_line"))
    return both.mapInArrow(_verified, "h long").distinct()


def kept_places(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document with any: row, kept (places of the lines that stay and are not blank)."""
    lines = line_table(df, id_col, text_col)
    line = F.col("line")
    # Earliest occurrence of every distinct line, combined on the map side.
    distinct = written(lines.withColumn("ends", F.when(F.char_length(line) >= min_chars, _half_ends(line)))
                       .groupBy("h").agg(F.min(_first()).alias("first"), F.any_value("ends").alias("ends")), "ld_distinct")
    near = written(near_lines(lines, distinct, min_chars), "ld_near")
    stay = distinct.join(near, "h", "left_anti").select("first.row", "first.pos")
    return stay.groupBy("row").agg(F.collect_list("pos").alias("kept"))


def _placed(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """`df` with `_ld_row` and `_ld_kept`."""
    places = written(kept_places(df, id_col, text_col, min_chars), "ld_places")
    rows = df.withColumn("_ld_row", _row(id_col, text_col))
    places = places.select(F.col("row").alias("_ld_row"), F.col("kept").alias("_ld_kept"))
    repeated = written(rows.groupBy("_ld_row").count().where("count > 1").select("_ld_row"), "ld_repeated")
    if repeated.isEmpty():
        return rows.join(places, "_ld_row", "left")
    # Rows that cannot be told apart have one identity: its first row alone keeps lines.
    rows = written(rows.withColumn("_ld_at", F.monotonically_increasing_id()), "ld_rows")
    first = rows.select("_ld_row", "_ld_at").join(repeated, "_ld_row", "left_semi").groupBy("_ld_row").agg(F.min("_ld_at").alias("_ld_first"))
    kept = F.when(F.col("_ld_first").isNull() | (F.col("_ld_first") == F.col("_ld_at")), F.col("_ld_kept"))
    return (rows.join(places, "_ld_row", "left").join(first, "_ld_row", "left")
            .withColumn("_ld_kept", kept).drop("_ld_at", "_ld_first"))


def _is_blank(line: str) -> bool:
    return not line.strip(" \t\n\x0b\x0c\r")


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 100):
            part = b.slice(at, 100)
            source, pos, line, stays = [], [], [], []
            for i, (text, kept) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                places = set(kept or ())
                for k, x in enumerate(text.split("\n")):
                    if not _is_blank(x):
                        source.append(i)
                        pos.append(k)
                        line.append(x)
                        stays.append(k in places)
            index = pa.array(source, pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0).take(index), part.column(1).take(index), pa.array(pos, pa.int32()),
                                              pa.array(line, pa.string()), pa.array(stays, pa.bool_())], names=["id", "row", "pos", "line", "kept"])


def decisions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line that is not blank: id, row, pos, line, kept."""
    placed = _placed(df, id_col, text_col, min_chars).where(F.col(text_col).isNotNull())
    kind = df.schema[id_col].dataType.simpleString()
    out = map_arrow(placed.select(F.col(id_col).alias("id"), F.col("_ld_row").alias("row"), F.col(text_col).alias("text"), F.col("_ld_kept").alias("kept")),
                    _decided, f"id {kind}, row long, pos int, line string, kept boolean")
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out


def _selected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 100):
            part = b.slice(at, 100)
            n, kept = [], []
            for text, places in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                found = text.split("\n") if text is not None else []
                n.append(sum(not _is_blank(x) for x in found))
                kept.append([found[k] for k in sorted(places or ())])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(kept, pa.list_(pa.string()))],
                                             names=["id", "n_lines", "kept"])


def kept_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document: id, n_lines (not blank), kept (the lines that stay, in order)."""
    placed = _placed(df, id_col, text_col, min_chars)
    kind = df.schema[id_col].dataType.simpleString()
    out = map_arrow(placed.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col("_ld_kept").alias("kept")),
                    _selected, f"id {kind}, n_lines long, kept array<string>")
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out


def _without_dropped(text: pd.Series, kept: pd.Series) -> pd.Series:
    def one(x: str | None, places) -> str | None:
        if x is None:
            return None
        stay = set(places) if places is not None else ()
        return "\n".join(line for k, line in enumerate(x.split("\n")) if k in stay or _is_blank(line))

    return pd.Series([one(x, p) for x, p in zip(text, kept, strict=True)], dtype=object)


def cleaned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """`df` with the dropped lines taken out of the texts; rows and other columns stay."""
    placed = _placed(df, id_col, text_col, min_chars)
    return placed.withColumn(text_col, F.pandas_udf(_without_dropped, "string")(F.col(text_col), F.col("_ld_kept"))).select(*df.columns)
