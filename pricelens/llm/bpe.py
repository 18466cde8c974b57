"""BPE encoding and decoding by batched numpy merge rounds.

Texts are cut at white space into units, units into pieces by the vocabulary
file's own rules, and the pieces that a worker has not met lately are encoded
together: the symbols of all of them lie in one flat array, the rank of every
neighbouring pair is found by binary search over the sorted pair keys, and in
each round every piece merges its lowest-ranked pair wherever it occurs, from
the left. Pieces without a known pair leave the array, so a round costs what is
still open. A piece of more than LONG_PIECE bytes would need very many rounds
over a long array; it is merged with a heap instead, with the same result.

The rules are those of the vocabulary file with word ends: special tokens are
found in the raw text, then NFC, one blank per white space, lower case by code
point, pieces by pattern with white space removed, bytes as symbols. Another
kind of file is refused. Decoding joins the tokens' strings with blanks, as the
file names no decoder.

Defined results: a null text counts as empty; an empty text has no ids and
decodes to the empty text; result columns replace columns of the same names;
an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pricelens.llm.common import map_arrow

LONG_PIECE = 4096
# Units kept per worker in each of two generations (some 200 bytes each).
CACHE_UNITS = 200_000
# Characters of text that are handled at a time.
SLICE_CHARS = 500_000

# The library's white space and split rule.
_SPACE = "\t-\r \x85\xa0  -     　"
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space for str.split, not for the library


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {}, 0x100
    for b in range(256):
        out[b] = chr(b) if b in plain else chr(extra)
        extra += b not in plain
    return [out[b] for b in range(256)]


class _NewCharacters:
    """Characters that Python's Unicode tables lack: the tokenizers library
    itself says how it lowers them (`lower`) and whether they are letters,
    numbers or neither (`kind`: a stand-in of that class). For str.translate."""

    def __init__(self, spec: dict):
        from tokenizers import Tokenizer

        # The rules alone: the library would hold the vocabulary a second time in every worker.
        library = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}}))
        self.vocabulary_size = library.get_vocab_size
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.lower, self.kind = _Lazy(self._lower), _Lazy(self._kind)

    def _lower(self, c: str) -> str:
        return self.normalize(c) if unicodedata.category(c) == "Cn" else c

    def _kind(self, c: str) -> str:
        if unicodedata.category(c) != "Cn":
            return c
        return "\xaa" if len(self.split("a" + c)) == 1 else "\xb2" if len(self.split(c + c)) == 2 else "\ue000"


class _Lazy(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, code: int) -> str:
        self[code] = self.make(chr(code))
        return self[code]


class WordBpe:
    """The vocabulary, its merges as sorted pair keys, and the encoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [p["type"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if (model["type"], model["end_of_word_suffix"], model["continuing_subword_prefix"]) != ("BPE", "</w>", None) \
                or model.get("dropout") or model.get("unk_token") or spec["decoder"] or spec["post_processor"] \
                or (spec["normalizer"] or {}).get("normalizers") != _NORMALIZERS or kinds != ["Split", "ByteLevel"] \
                or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"] != {"Regex": _PIECE}:
            raise ValueError(f"{path}: not a BPE file with word ends of the supported kind")
        vocab = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: list[str] = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.size = len(self.tokens)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right, made = (np.array(x, dtype=np.int64) for x in (
            [vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], [vocab[a + b] for a, b in pairs]))
        key = left * self.size + right
        order = np.argsort(key)
        self.keys, self.ranks, self.made = key[order], order, made[order]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.final = np.array([vocab[s + "</w>"] for s in symbols], dtype=np.int64)
        pattern = regex.compile(_PIECE.replace(r"\s", _SPACE))
        self.find, self.match = pattern.findall, pattern.finditer
        self.new = _NewCharacters(spec)
        self.cut_space = regex.compile(f"[{_SPACE}]+").split
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        raw = [(t + " ").encode() for t in self.tokens]
        self.token_len = np.array(list(map(len, raw)), dtype=np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.token_bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # -- merging ---------------------------------------------------------
    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of every piece, as little-endian 32-bit payloads."""
        out: list[bytes] = [b""] * len(pieces)
        short = [i for i, p in enumerate(pieces) if 0 < len(p) <= LONG_PIECE]
        for i, p in enumerate(pieces):
            if len(p) > LONG_PIECE:
                out[i] = np.array(self._merge_long(p), dtype="<u4").tobytes()
        if short:
            ids, ends = self._merge_flat([pieces[i] for i in short])
            payload, at = ids.astype("<u4").tobytes(), 0
            for i, end in zip(short, (ends * 4).tolist(), strict=True):
                out[i], at = payload[at:end], end
        return out

    def _merge_flat(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        lens = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        last = np.cumsum(lens) - 1
        sym = self.inner[data]
        sym[last] = self.final[data[last]]
        word = np.repeat(np.arange(len(pieces)), lens)
        none = len(self.keys)
        rank = np.full(len(sym), none, dtype=np.int64)  # of the pair that begins here
        made = np.zeros(len(sym), dtype=np.int64)
        fresh = np.arange(len(sym))  # where the pair is not looked up yet
        done_sym, done_word = [], []
        while len(sym):
            fresh = fresh[fresh < len(sym) - 1]
            key = sym[fresh] * self.size + sym[fresh + 1]
            at = np.minimum(np.searchsorted(self.keys, key), none - 1)
            hit = (self.keys[at] == key) & (word[fresh + 1] == word[fresh])
            rank[fresh] = np.where(hit, self.ranks[at], none)
            made[fresh] = self.made[at]
            rank[-1] = none
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(sym))))
            over = best == none
            if over.any():
                done_sym.append(sym[over])
                done_word.append(word[over])
            merge = np.flatnonzero((rank == best) & ~over)
            if len(merge) > 1:  # of overlapping equal pairs, every second one from the left
                at_run = np.arange(len(merge))
                first = np.concatenate([[True], np.diff(merge) > 1])
                merge = merge[(at_run - np.maximum.accumulate(np.where(first, at_run, 0))) % 2 == 0]
            sym[merge] = made[merge]
            keep = ~over
            keep[merge + 1] = False
            now = np.cumsum(keep)[merge] - 1
            sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
            changed = np.zeros(len(sym), dtype=bool)
            changed[now] = changed[now[now > 0] - 1] = True
            fresh = np.flatnonzero(changed)
        ids, owner = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.cumsum(np.bincount(owner, minlength=len(pieces)))

    def _merge_long(self, piece: bytes) -> list[int]:
        data = np.frombuffer(piece, dtype=np.uint8)
        sym = self.inner[data].tolist()
        sym[-1] = int(self.final[data[-1]])
        n = len(sym)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]

        def pair(i: int) -> tuple[int, int] | None:
            j = after[i]
            if j < 0:
                return None
            key = sym[i] * self.size + sym[j]
            at = int(np.searchsorted(self.keys, key))
            return (int(self.ranks[at]), int(self.made[at])) if at < len(self.keys) and self.keys[at] == key else None

        heap = [(p[0], i) for i in range(n) if (p := pair(i))]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if sym[i] < 0 or not (p := pair(i)) or p[0] != rank:
                continue
            j = after[i]
            sym[i], sym[j], after[i] = p[1], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (q := pair(k)):
                    heapq.heappush(heap, (q[0], k))
        return [s for s in sym if s >= 0]

    # -- texts -----------------------------------------------------------
    def _units(self, text: str) -> list[str]:
        if any(c in text for c in _SEPARATORS):
            return [u for u in self.cut_space(text) if u]
        return text.split()

    def _pieces(self, unit: str) -> list[str | int]:
        """Pieces of a unit in the order of the text; special tokens as ids."""
        if "<|" in unit:
            parts = self.cut_special(unit)
            if len(parts) > 1:
                return [x for p in parts for x in ([self.special[p]] if p in self.special else self._pieces(p))]
        if unit.isascii():
            unit = unit.lower()
            return [unit] if unit.isalpha() and len(unit) else self.find(unit)
        # Lower case by code point: a final sigma is a sigma like any other.
        unit = unicodedata.normalize("NFC", unit).replace("Σ", "σ").lower().translate(self.new.lower)
        known = unit.translate(self.new.kind)
        return self.find(unit) if known == unit else [unit[m.start():m.end()] for m in self.match(known)]

    def _learn(self, units: set[str]) -> None:
        split = {u: self._pieces(u) for u in units}
        fresh = list({p for ps in split.values() for p in ps if isinstance(p, str)})
        ids = dict(zip(fresh, self.merge([p.encode("utf-8", "surrogatepass") for p in fresh]), strict=True))
        for unit, pieces in split.items():
            self.units[unit] = b"".join([ids[p] if isinstance(p, str) else p.to_bytes(4, "little") for p in pieces])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Payload of little-endian 32-bit ids per text."""
        split = [self._units(t) for t in texts]
        missing = set().union(*split).difference(self.units)
        if missing:
            if len(self.units) > CACHE_UNITS:
                kept = {u: self.units[u] for us in split for u in us if u in self.units}
                self.older, self.units = self.units, kept
            known = missing.intersection(self.older)
            for u in known:
                self.units[u] = self.older[u]
            self._learn(missing.difference(known))
        get = self.units.__getitem__
        return [b"".join(map(get, us)) for us in split]

    def decode(self, payloads: list[bytes]) -> pa.StringArray:
        """The text of every payload: its tokens' strings, joined with blanks."""
        ids = np.frombuffer(b"".join(payloads), dtype="<u4")
        count = np.fromiter(map(len, payloads), dtype=np.int64, count=len(payloads)) // 4
        width = self.token_len[ids]  # with the blank that follows
        last = np.cumsum(count)[count > 0] - 1
        width[last] -= 1
        ends = np.cumsum(width)
        total = int(ends[-1]) if len(ends) else 0
        text = self.token_bytes[np.arange(total) + np.repeat(self.token_at[ids] - (ends - width), width)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])]
        return pa.LargeStringArray.from_buffers(len(payloads), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(text)).cast(pa.string())


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` characters (one row at least)."""
    at, n = 0, len(lengths)
    ends = np.cumsum(lengths)
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield at, min(to, n)
        at = to


def _run(path: str, text_col: str, names: list[str], decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            lengths = np.diff(np.frombuffer(column.buffers()[1], dtype=np.int64 if pa.types.is_large_string(column.type) else np.int32,
                                            count=len(column) + 1 + column.offset)[column.offset:])
            for at, to in slices(lengths, SLICE_CHARS):
                ids = bpe.encode([t or "" for t in column.slice(at, to - at).to_pylist()])
                made = {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
                if decode:
                    made["decoded"] = bpe.decode(ids)
                rest = {n: batch.column(batch.schema.get_field_index(n)).slice(at, to - at) for n in names}
                yield pa.RecordBatch.from_pydict(rest | made)
    return run


def encode(df: DataFrame, path: str, text_col: str = "text", decode: bool = False, keep: list[str] | None = None) -> DataFrame:
    """`df` (its columns `keep`, all by default) with `n_tokens` and `ids`
    (little-endian 32-bit payload), and with `decode` the text `decoded` from
    those ids."""
    made = ["n_tokens", "ids", *["decoded"] * decode]
    names = [c for c in (df.columns if keep is None else keep) if c not in made]
    fields = [df.schema[c] for c in names] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    fields += [T.StructField("decoded", T.StringType())] * decode
    return map_arrow(df.select(*dict.fromkeys([*names, text_col])), _run(path, text_col, names, decode), T.StructType(fields))
