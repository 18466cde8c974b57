"""Spelling variants: words one edit apart, found with bidirectional FM-indexes.

`vocabulary` counts the words of a corpus, `near_words` lists all pairs of words
that differ by exactly one inserted, deleted or replaced code point, and
`variant_forms` names for every word its most frequent near word, if that is
enough more frequent, and the last word of the chain of forms.

Search scheme. Of two words one edit apart, either the left or the right half
of the first stands unchanged in the second, at its begin or its end. Two searches
cover both cases: one matches the left half exactly, walking from the middle to
the begin delimiter, then turns and extends across the right half to the end
delimiter with one error allowed; the other is its mirror image. The index is a
pair of FM-indexes, of the delimited words "$w$x$...$" and of the same text
reversed. A step reads symbol counts at the two ends of a suffix-rank interval
and keeps the interval of the other direction in step, so the search can turn.

Distribution. A word is indexed under the halves that a word of its own length or
one more or one less would look for (two prefixes and two suffixes), and asks
under its own two halves. Halves are hashed to cells, every cell is one index of
about CELL_WORDS entries in one task. A half with more words than that is dealt
to several cells, all of which its queries visit. Rows between stages are pairs and words, never
groups.

Defined results: null and wordless texts have no words; a null id acts as the
empty id in the planted deletions; words are told apart by code points, not by
canonical equivalence; an index cell takes at most 253 different letters;
ties between forms go to the smaller word; an empty
vocabulary gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import written

CELL_WORDS = 1 << 15
CHUNK = 2048          # queries searched at a time
_BLOCK = 64           # symbols between two stored counts

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUNS = r"([a-zÀ-ÿ]+)"


# -- the vocabulary ------------------------------------------------------------
def vocabulary(docs: DataFrame, min_length: int = 7, min_count: int = 2, drop_one_in: int = 31,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`word` and `n` of the runs of letters of all texts, A-Z in lower case; where
    `drop_one_in` divides the crc32 h of "<id>:<run>", without code point h mod length."""
    run = F.explode(F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(_RUNS), F.lit(1)))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = (docs.select(name.alias("id"), run.alias("run")).withColumn("n", F.length("run")).where(F.col("n") >= min_length)
            .withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run"))))
    at = F.pmod("h", F.col("n").cast("long")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.col("n")))
    word = F.when(F.pmod("h", F.lit(drop_one_in)) == 0, cut).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


# -- FM-index --------------------------------------------------------------------
class Ranks:
    """One direction: symbol counts over the Burrows-Wheeler transform of a
    delimited text (symbol 0 is the delimiter), and the word behind each row
    that a delimiter precedes."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        n = len(text)
        order = _suffix_order(text)
        bwt = text[order - 1]
        blocks = n // _BLOCK + 1
        self.symbols = np.full(blocks * _BLOCK, 255, dtype=np.uint8)
        self.symbols[:n] = bwt
        per_block = np.bincount(np.arange(n) // _BLOCK * n_symbols + bwt, minlength=blocks * n_symbols).reshape(blocks, n_symbols)
        before = np.zeros((blocks, n_symbols), dtype=np.int64)
        np.cumsum(per_block[:-1], axis=0, out=before[1:])
        # Column c: symbols smaller than c in the blocks before.
        self.smaller = np.concatenate([np.zeros((blocks, 1), np.int64), np.cumsum(before, axis=1)], axis=1).astype(np.int32)
        self.symbols = self.symbols.reshape(blocks, _BLOCK)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))[:-1]])  # first row of each symbol
        self.n, self.n_symbols = n, n_symbols
        self.ends = order[np.flatnonzero(bwt == 0)]  # text places behind a delimiter, in row order

    def counts(self, c: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols smaller than and equal to `c` in the rows before `row`."""
        block = row >> 6
        part = self.symbols[block]
        inside = np.arange(_BLOCK, dtype=np.uint8) < (row & (_BLOCK - 1)).astype(np.uint8)[:, None]
        c8 = c.astype(np.uint8)[:, None]
        less = self.smaller[block, c]
        return (less + np.count_nonzero((part < c8) & inside, axis=1),
                self.smaller[block, c + 1] - less + np.count_nonzero((part == c8) & inside, axis=1))

    def step(self, c: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals after one more symbol, and how many rows of the old one have a smaller symbol."""
        less_low, same_low = self.counts(c, low)
        less_high, same_high = self.counts(c, high)
        return self.first[c] + same_low, self.first[c] + same_high, less_high - less_low

    def all_counts(self, row: np.ndarray) -> np.ndarray:
        """Occurrences of every symbol in the rows before each `row`."""
        block = row >> 6
        part = self.symbols[block].astype(np.int64)
        part[np.arange(_BLOCK) >= (row & (_BLOCK - 1))[:, None]] = self.n_symbols
        inside = np.bincount((np.arange(len(row))[:, None] * (self.n_symbols + 1) + part).ravel(), minlength=len(row) * (self.n_symbols + 1))
        return np.diff(self.smaller[block], axis=1) + inside.reshape(len(row), -1)[:, :self.n_symbols]


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order; delimiters are told apart by their place, so no
    comparison goes beyond a word and the doubling ends at the longest one."""
    n = len(text)
    delimiters = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(delimiters)
    rank[delimiters] = np.arange(len(delimiters))
    width = 1
    while True:
        key = rank * (n + 256)
        key[:n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if fresh[-1] == n - 1:
            return order
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        width *= 2


@dataclass
class Coded:
    """Words as one flat array of symbols."""

    symbols: np.ndarray
    start: np.ndarray
    length: np.ndarray


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64),
            np.fromiter(map(len, words), dtype=np.int64, count=len(words)))


class BidirectionalIndex:
    """The delimited words, forwards and reversed."""

    def __init__(self, words: list[str]):
        points, length = code_points(words)
        self.alphabet = np.unique(points)
        if len(self.alphabet) > 253:
            raise ValueError("an index cell takes at most 253 different code points")
        self.n_symbols = len(self.alphabet) + 2  # the delimiter, the letters, and one for letters that no word has
        text = np.zeros(len(points) + len(words) + 1, dtype=np.int64)
        self.start = np.cumsum(length + 1) - length
        text[np.arange(len(points)) + np.repeat(np.arange(len(words)) + 1, length)] = np.searchsorted(self.alphabet, points) + 1
        self.forward, self.backward = Ranks(text, self.n_symbols), Ranks(text[::-1], self.n_symbols)
        # The word of each row that follows a delimiter: at its first symbol, or reversed at its last.
        self.word_forward = np.searchsorted(self.start, self.forward.ends, side="right") - 1
        self.word_backward = np.searchsorted(self.start, len(text) - 1 - self.backward.ends, side="right") - 1

    def code(self, words: list[str]) -> Coded:
        points, length = code_points(words)
        at = np.searchsorted(self.alphabet, points)
        known = (at < len(self.alphabet)) & (self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points) if len(self.alphabet) else np.zeros(len(points), bool)
        return Coded(np.where(known, at + 1, self.n_symbols - 1), np.cumsum(length) - length, length)

    def near(self, queries: list[str], left_exact: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query number, word number) of the words one edit away whose left
        (or right) half is that of the query."""
        q = self.code(queries)
        found = [self._near(q, np.arange(a, min(a + CHUNK, len(queries))), left_exact) for a in range(0, len(queries), CHUNK)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _near(self, q: Coded, who: np.ndarray, left_exact: bool):
        half = q.length[who] // 2
        split = q.start[who] + half
        if left_exact:
            exact, far, word_of = self.forward, self.backward, self.word_backward
            n_exact, n_far, first_exact, first_far, way = half, q.length[who] - half, split - 1, split, 1
        else:
            exact, far, word_of = self.backward, self.forward, self.word_forward
            n_exact, n_far, first_exact, first_far, way = q.length[who] - half, half, split, split - 1, -1
        # One half exactly, from the middle outwards, with the other direction's interval kept in step.
        low = np.zeros(len(who), np.int64)
        size, other = np.full(len(who), exact.n), np.zeros(len(who), np.int64)
        live = np.arange(len(who))
        for j in range(int(n_exact.max(initial=0)) + 1):
            live = live[(size[live] > 0) & (j <= n_exact[live])]
            if not len(live):
                break
            at_end = j == n_exact[live]
            c = np.where(at_end, 0, q.symbols[np.where(at_end, 0, first_exact[live] - way * j)])
            a, z, smaller = exact.step(c, low[live], low[live] + size[live])
            other[live] += smaller
            low[live], size[live] = a, z - a
        alive = np.flatnonzero(size > 0)
        return self._one_error(q, far, word_of, who[alive], first_far[alive], way, n_far[alive], other[alive], other[alive] + size[alive])

    def _one_error(self, q: Coded, far: Ranks, word_of: np.ndarray, who, first, way, n_far, low, high):
        """Extend across the far half, leaving the exact path once at every place."""
        done = []
        for p in range(int(n_far.max(initial=-1)) + 1):
            live = np.flatnonzero((n_far >= p) & (high > low))
            if not len(live):
                break
            last = n_far[live] == p  # only an insertion before the delimiter is left
            here = np.where(last, 0, q.symbols[np.where(last, 0, first[live] + way * p)])
            low_c, high_c = far.all_counts(low[live]), far.all_counts(high[live])
            child = high_c > low_c
            child[:, 0] = False
            child[np.arange(len(live)), here] = False
            k, c = np.nonzero(child)
            a, z = far.first[c] + low_c[k, c], far.first[c] + high_c[k, c]
            replaced = ~last[k]
            # Deleting one of a run of equal symbols: the last stands for all.
            beyond = n_far[live] > p + 1
            following = np.where(beyond, q.symbols[np.where(beyond, first[live] + way * (p + 1), 0)], 0)
            dropped = np.flatnonzero(~last & (following != here))
            entry = np.concatenate([live[k], live[k[replaced]], live[dropped]])
            done.append(self._exactly(q, far, word_of, who[entry], first[entry], way, n_far[entry],
                                      np.concatenate([np.full(len(k), p), np.full(int(replaced.sum()) + len(dropped), p + 1)]),
                                      np.concatenate([a, a[replaced], low[live[dropped]]]), np.concatenate([z, z[replaced], high[live[dropped]]])))
            rest = np.arange(len(live))
            low[live], high[live] = far.first[here] + low_c[rest, here], far.first[here] + high_c[rest, here]
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])

    @staticmethod
    def _exactly(q: Coded, far: Ranks, word_of, who, first, way, n_far, p, low, high):
        """Match what is left of the far half and the delimiter."""
        out = []
        while len(who):
            end = p == n_far
            if end.any():
                _, before = far.counts(np.zeros(int(end.sum()), np.int64), low[end])
                _, upto = far.counts(np.zeros(int(end.sum()), np.int64), high[end])
                hit = upto > before
                out.append((who[end][hit], word_of[before[hit]]))
            go = np.flatnonzero(~end)
            who, first, n_far, p = who[go], first[go], n_far[go], p[go]
            low, high, _ = far.step(q.symbols[first + way * p], low[go], high[go])
            go = np.flatnonzero(high > low)
            who, first, n_far, p, low, high = who[go], first[go], n_far[go], p[go] + 1, low[go], high[go]
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


# -- pairs -----------------------------------------------------------------------
def _search_cell(key: tuple, rows: pa.Table) -> pa.Table:
    left = key[0].as_py() == "left"
    asks = rows.column("asks").to_numpy(zero_copy_only=False).astype(bool)
    words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
    known = {w: c for w, c, a in zip(words, n.tolist(), asks.tolist(), strict=True) if not a}
    queries = sorted({w for w, a in zip(words, asks.tolist(), strict=True) if a})
    held = sorted(known)
    if not held or not queries:
        q = w = np.zeros(0, np.int64)
    else:
        q, w = BidirectionalIndex(held).near(queries, left)
    if not left and len(q):  # pairs with equal left halves are the other search's
        keep = np.fromiter((not held[b].startswith(queries[a][:len(queries[a]) // 2]) for a, b in zip(q.tolist(), w.tolist(), strict=True)),
                           dtype=bool, count=len(q))
        q, w = q[keep], w[keep]
    return pa.table({"word": pa.array([queries[i] for i in q.tolist()], pa.string()), "near": pa.array([held[i] for i in w.tolist()], pa.string()),
                     "near_n": pa.array([known[held[i]] for i in w.tolist()], pa.int64())})


def _halves(words: DataFrame) -> DataFrame:
    """(side, half, word, n, asks) of every word: the halves under which it is held, and those under which it asks."""
    n = F.length("word")
    floor, ceil = lambda c: F.floor(c / 2).cast("int"), lambda c: F.floor((c + 1) / 2).cast("int")
    parts = []
    for side, size, cut in (("left", floor, lambda k: F.col("word").substr(F.lit(1), k)),
                            ("right", ceil, lambda k: F.col("word").substr(F.length("word") - k + 1, k))):
        sizes = F.array_distinct(F.array(*[size(n + d) for d in (-1, 0, 1)]))
        entries = F.concat(F.transform(sizes, lambda k: F.struct(k.alias("k"), F.lit(False).alias("asks"))),
                           F.array(F.struct(size(n).alias("k"), F.lit(True).alias("asks"))))
        rows = words.select("word", "n", F.explode(entries).alias("e")).select("word", "n", "e.k", "e.asks")
        parts.append(rows.select(F.lit(side).alias("side"), cut(F.col("k")).alias("half"), "word", "n", "asks"))
    return parts[0].unionByName(parts[1])


def near_words(vocab: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """All ordered pairs (`word`, `near`, `near_n`) of words exactly one edit apart.

    `vocab` has `word` (distinct) and `n`, and is best a written table."""
    halves = _halves(vocab.select("word", "n"))
    held = halves.where(~F.col("asks"))
    n_cells = max(1, -(-2 * vocab.count() // cell_words))
    # Halves that more words share than a cell takes: at most 4 * words / cell_words of them.
    hot = written(held.groupBy("side", "half").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > cell_words)
                  .select("side", "half", F.ceil(F.col("m") / cell_words).cast("int").alias("cells")), "variant_hot")
    cell = F.pmod(F.xxhash64("half"), F.lit(n_cells))
    several = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("cells") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("word"), F.col("cells")).cast("int")))
    one = F.array(F.lit(-1))
    dealt = (halves.join(hot, ["side", "half"], "left")
             .select("side", F.when(F.col("cells").isNull(), cell).otherwise(F.xxhash64("half")).alias("cell"),
                     F.explode(F.when(F.col("cells").isNull(), one).otherwise(several)).alias("part"), "word", "n", "asks"))
    return dealt.groupBy("side", "cell", "part").applyInArrow(_search_cell, "word string, near string, near_n long")


def _follow(forms: DataFrame, n_max: int, ratio: int) -> DataFrame:
    """(word, root): the last word of each chain of forms, by doubling.

    Counts grow at least by `ratio` a step, so a chain has at most log(n_max) / log(ratio) steps."""
    steps, most = 0, n_max
    while most >= ratio:
        steps, most = steps + 1, most // ratio
    links, covered = forms.select("word", F.col("form").alias("root")), 1
    while covered < steps:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = written(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "variant_roots")
        covered *= 2
    return links


def variant_forms(vocab: DataFrame, ratio: int = 10, cell_words: int = CELL_WORDS) -> DataFrame:
    """Every word of `vocab` with `form`, `root`, `n`, `n_near` and `form_n`."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or chains of forms may be circular")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    near = near_words(vocab, cell_words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = vocab.select("word", "n").join(near, "word", "left")
    form_n = -F.col("best.minus")
    enough: Column = form_n >= F.col("n") * ratio
    rows = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(enough, F.col("best.near")).alias("form"), F.when(enough, form_n).alias("form_n")), "variant_forms")
    most = rows.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    roots = _follow(rows.where("form is not null"), most, ratio)
    return (rows.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
