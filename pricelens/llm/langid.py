"""Language identification with a bidirectional gated recurrent network over bytes.

A text is cut into segments of SEGMENT bytes; two gated recurrent layers read
each segment, one forwards and one backwards, and every byte position gets a
probability for every language from both states. A document's probabilities are
the mean over all its positions, so whole texts count, at a cost in proportion
to their bytes. The network is trained in numpy by backpropagation through time
on a bounded sample of labelled segments (SAMPLE_DOCS documents per language,
SEGMENTS_PER_DOC segments spread over each), and is some kilobytes large.

Defined results: a text that is null or has no letter gets `und` with score 0;
ties go to the first language in alphabetical order; with one learned language
every other text gets it; with no labelled text at all every text gets `und`;
invalid or mixed scripts are read as their UTF-8 bytes; result columns replace
columns of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm.bpe import slices
from pricelens.llm.common import map_arrow

SEGMENT = 128
HIDDEN = 8
# The bound of the training sample.
SAMPLE_DOCS = 400
SEGMENTS_PER_DOC = 4
STEPS = 240
BATCH = 128
# Segments that run through the network together.
LANES = 2048
UNDETERMINED = "und"


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


@dataclass(frozen=True)
class ByteGru:
    """Weights: per direction d and gate g in (update, reset, candidate).

    table (2, 3H, 256): what a byte adds to the gates, bias included
    hidden (2, 3H, H): recurrent weights;  out (C, 2H), bias (C, 1)
    """

    languages: tuple[str, ...]
    table: np.ndarray
    hidden: np.ndarray
    out: np.ndarray
    bias: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _read(net: dict, data: np.ndarray, mask: np.ndarray, keep: bool):
    """States (L, 2, H, B) of both directions at every position of `data` (L, B).

    The backward direction reads reversed; masked positions (after the end of a
    segment) leave the state as it is. With `keep` also what training needs.
    """
    length, lanes = data.shape
    h_size = net["hidden"].shape[2]
    states = np.empty((length, 2, h_size, lanes), dtype=np.float32)
    h = np.zeros((2, h_size, lanes), dtype=np.float32)
    saved = []
    both = np.empty((2, 3 * h_size, lanes), dtype=np.float32)
    for t in range(length):
        r = length - 1 - t
        np.take(net["table"][0], data[t], axis=1, out=both[0], mode="clip")
        np.take(net["table"][1], data[r], axis=1, out=both[1], mode="clip")
        rec = np.matmul(net["hidden"], h)
        gates = _sigmoid(both[:, :2 * h_size] + rec[:, :2 * h_size])
        z, reset = gates[:, :h_size], gates[:, h_size:]
        cand = np.tanh(both[:, 2 * h_size:] + reset * rec[:, 2 * h_size:])
        new = cand + z * (h - cand)
        m = np.stack([mask[t], mask[r]])[:, None, :]
        if not m.all():
            new = np.where(m, new, h)
        if keep:
            saved.append((h, z, reset, cand, rec[:, 2 * h_size:], m))
        h = new
        states[t, 0], states[r, 1] = h[0], h[1]
    return states, saved


def _position_probabilities(net: dict, states: np.ndarray) -> np.ndarray:
    """(L, C, B) probabilities from both states of every position."""
    length, _, h_size, lanes = states.shape
    logits = np.matmul(net["out"], states.reshape(length, 2 * h_size, lanes)) + net["bias"]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _gradients(net: dict, data: np.ndarray, mask: np.ndarray, target: np.ndarray):
    """Loss (mean over positions) and its gradients, by backpropagation through time."""
    length, lanes = data.shape
    h_size = net["hidden"].shape[2]
    states, saved = _read(net, data, mask, keep=True)
    probs = _position_probabilities(net, states)
    n = mask.sum()
    at = (np.arange(length)[:, None], target[None, :], np.arange(lanes)[None, :])
    loss = -(np.log(probs[at] + 1e-9) * mask).sum() / n
    delta = probs
    delta[at] -= 1
    delta *= mask[:, None, :] / n
    flat = states.reshape(length, 2 * h_size, lanes)
    grad = {"out": np.einsum("tcb,thb->ch", delta, flat, optimize=True), "bias": delta.sum(axis=(0, 2))[:, None],
            "hidden": np.zeros_like(net["hidden"]), "table": np.zeros_like(net["table"])}
    d_states = np.matmul(net["out"].T, delta).reshape(length, 2, h_size, lanes)
    carry = np.zeros((2, h_size, lanes), dtype=np.float32)
    for t in range(length - 1, -1, -1):
        r = length - 1 - t
        h, z, reset, cand, rec_c, m = saved[t]
        d = carry + np.stack([d_states[t, 0], d_states[r, 1]])
        d_new = np.where(m, d, 0)
        d_cand = d_new * (1 - z) * (1 - cand * cand)
        d_z = d_new * (h - cand) * z * (1 - z)
        d_rec_c = d_cand * reset
        d_reset = d_cand * rec_c * reset * (1 - reset)
        d_in = np.concatenate([d_z, d_reset, d_cand], axis=1)
        d_rec = np.concatenate([d_z, d_reset, d_rec_c], axis=1)
        grad["hidden"] += np.matmul(d_rec, h.transpose(0, 2, 1))
        for k, pos in ((0, t), (1, r)):
            np.add.at(grad["table"][k].T, data[pos], d_in[k].T)
        carry = np.where(m, d_new * z, d) + np.matmul(net["hidden"].transpose(0, 2, 1), d_rec)
    return loss, grad


def pack(segments: list[bytes], length: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (L, B) and the mask of positions within their segments."""
    lens = np.array([len(s) for s in segments])
    data = np.zeros((len(segments), length), dtype=np.uint8)
    mask = np.arange(length)[None, :] < lens[:, None]
    data[mask] = np.frombuffer(b"".join(segments), dtype=np.uint8)
    return np.ascontiguousarray(data.T), np.ascontiguousarray(mask.T)


def train(segments: list[bytes], languages: list[str], labels: np.ndarray, hidden: int = HIDDEN,
          steps: int = STEPS, batch: int = BATCH, rate: float = 0.02, seed: int = 7) -> ByteGru:
    """Adam on random batches with as many segments of each language."""
    rng = np.random.default_rng(seed)
    c = len(languages)
    net = {"table": rng.normal(0, 0.3, (2, 3 * hidden, 256)), "hidden": rng.normal(0, hidden ** -0.5, (2, 3 * hidden, hidden)),
           "out": rng.normal(0, 0.3, (c, 2 * hidden)), "bias": np.zeros((c, 1))}
    net = {k: v.astype(np.float32) for k, v in net.items()}
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.items()}
    data, mask = pack(segments)
    by_language = [np.flatnonzero(labels == i) for i in range(c)]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(own, -(-batch // c)) for own in by_language])
        _, grad = _gradients(net, data[:, pick], mask[:, pick], labels[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        now = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m, v = moment[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            net[k] -= (now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return ByteGru(tuple(languages), net["table"], net["hidden"], net["out"], net["bias"])


def training_sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str,
                    docs: int = SAMPLE_DOCS, per_doc: int = SEGMENTS_PER_DOC) -> list:
    """At most `docs` labelled documents per language, chosen by a hash of the id
    and text, each as `per_doc` short pieces spread over its whole length."""
    text = F.col(text_col)
    usable = labelled.where(F.col(lang_col).isNotNull() & has_letter(text))
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), text), F.lit(1 << 30)) / (1 << 30)
    counts = {r[0]: r[1] for r in usable.groupBy(lang_col).count().collect()}
    keep = F.lit(False)
    for lang, n in sorted(counts.items()):
        keep = keep | ((F.col(lang_col) == lang) & (draw < 1.5 * docs / n))
    step = F.greatest(F.lit(1), F.char_length(text) / per_doc).cast("int")
    pieces = F.array(*[F.substring(text, step * i + 1, F.lit(SEGMENT)) for i in range(per_doc)])
    rows = usable.where(keep).select(F.col(lang_col).alias("lang"), draw.alias("draw"), pieces.alias("pieces")).collect()
    taken: dict[str, int] = {}
    out = []
    for r in sorted(rows, key=lambda r: (r["draw"], r["lang"], r["pieces"])):
        if taken.setdefault(r["lang"], 0) < docs:
            taken[r["lang"]] += 1
            out += [(r["lang"], s.encode()[:SEGMENT]) for s in r["pieces"] if s]
    return out


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> ByteGru | None:
    """A network for the languages of `labelled`; None without any."""
    sample = training_sample(labelled, id_col, text_col, lang_col)
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    labels = np.array([languages.index(lang) for lang, _ in sample])
    return train([s for _, s in sample], languages, labels, **options)


def document_probabilities(net: ByteGru, texts: list[bytes]) -> np.ndarray:
    """(documents, languages): mean of the position probabilities of each text."""
    weights = {"table": net.table, "hidden": net.hidden, "out": net.out, "bias": net.bias}
    total = np.zeros((len(texts), len(net.languages)))
    where = [(i, at) for i, t in enumerate(texts) for at in range(0, len(t), SEGMENT)]
    # Segments of like length run together, so that short ones are not padded far.
    where.sort(key=lambda x: -min(SEGMENT, len(texts[x[0]]) - x[1]))
    for lane in range(0, len(where), LANES):
        part = where[lane:lane + LANES]
        segments = [texts[i][at:at + SEGMENT] for i, at in part]
        data, mask = pack(segments, max(map(len, segments)))
        probs = _position_probabilities(weights, _read(weights, data, mask, keep=False)[0])
        np.add.at(total, np.array([i for i, _ in part]), np.einsum("tcb,tb->bc", probs, mask.astype(np.float32)))
    return total / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def _predict(net: ByteGru, text_col: str, letter_col: str, names: list[str], slice_bytes: int = 1_000_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.large_binary())
            letters = batch.column(batch.schema.get_field_index(letter_col))
            lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset))
            for at, to in slices(lengths, slice_bytes):
                ok = letters.slice(at, to - at).to_pylist()
                probs = document_probabilities(net, [t if o else b"" for t, o in zip(texts.slice(at, to - at).to_pylist(), ok, strict=True)])
                best = probs.argmax(axis=1)
                rest = {n: batch.column(batch.schema.get_field_index(n)).slice(at, to - at) for n in names}
                yield pa.RecordBatch.from_pydict(rest | {
                    "lang_pred": [net.languages[b] if o else UNDETERMINED for b, o in zip(best, ok, strict=True)],
                    "score": [min(1.0, float(p[b])) if o else 0.0 for p, b, o in zip(probs, best, ok, strict=True)]})
    return run


def predict(df: DataFrame, net: ByteGru | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df` (its columns `keep`, all by default) with `lang_pred` and `score`."""
    names = [c for c in (df.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    if net is None:
        return df.select(*names, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    fields = [df.schema[c] for c in names] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    rows = df.select(*dict.fromkeys([*names, text_col]), has_letter(F.col(text_col)).alias("_letter"))
    return map_arrow(rows, _predict(net, text_col, "_letter", names), T.StructType(fields))


# -- texts of no learned language ------------------------------------------------
# A classifier that has learned some languages gives one of them to any text. Whether a text is in one of them at all is
# asked of its byte triples: those of a learned language have mostly been met in the training sample. Only letters and blanks
# count, so numbers, keys and marks within a text are no evidence against it.
# Triples that count as met before the first is read, so that short texts are not judged on a few.
HEAD_START = 20


@dataclass(frozen=True)
class Familiar:
    """Byte triples of the training sample (a bit each), and the least share of them that a text must have."""

    bits: bytes
    bound: float


_LOWER = np.array([b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 if b == 32 or 9 <= b <= 13 else 0 for b in range(256)],
                  dtype=np.uint8)


def _triples(text: bytes) -> np.ndarray:
    b = _LOWER[np.frombuffer(text, np.uint8)].astype(np.int32)
    whole = (b[:-2] != 0) & (b[1:-1] != 0) & (b[2:] != 0)
    return ((b[:-2] << 16) | (b[1:-1] << 8) | b[2:])[whole]


def _shares(bits: bytes, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            out = []
            for i in range(len(texts)):
                triples = _triples(texts[i].as_py() or b"")
                out.append((np.count_nonzero(met[triples]) + HEAD_START) / (len(triples) + HEAD_START))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())], names=[*names, "familiar"])
    return run


def familiarity(df: DataFrame, bits: bytes, text_col: str = "text") -> DataFrame:
    """`df` with `familiar`: the share of the whole text's triples of letters and blanks that the sample has."""
    names = [c for c in df.columns if c != "familiar"]
    fields = [df.schema[c] for c in names] + [T.StructField("familiar", T.DoubleType())]
    return map_arrow(df.select(*names, F.col(text_col).cast("binary").alias("_bytes")), _shares(bits, names), T.StructType(fields))


def fit_familiar(labelled: DataFrame, held_out: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 lost: float = 0.001, slack: float = 0.85) -> Familiar | None:
    """Triples of the training sample of `labelled`, and the bound from all labelled texts of
    `held_out`: `slack` times the share that all but `lost` of them have. None without either."""
    met = np.zeros(1 << 24, dtype=bool)
    for _, piece in training_sample(labelled, id_col, text_col, lang_col):
        met[_triples(piece)] = True
    bits = np.packbits(met).tobytes()
    known = familiarity(held_out.where(F.col(lang_col).isNotNull() & has_letter(F.col(text_col))).select(text_col), bits, text_col)
    least = known.agg(F.percentile_approx("familiar", lost, 10_000)).first()[0]
    return None if least is None or not met.any() else Familiar(bits, slack * least)
