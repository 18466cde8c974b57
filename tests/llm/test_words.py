"""Spelling variants, importance resampling and license scan against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import importance, licenses, variants
from pricelens.llm.common import written

# Columns beside id and text, with names that the operators use themselves.
SCHEMA = ("doc_id long, text string, n long, word string, words array<string>, score double, rank long, weight long, _row long, _at long, "
          "label string, digest string, block int, id string, run string, h long")
REST = (1, "w", ["a"], 0.5, 7, 8, 9, 10, "x", "y", 3, "i", "r", 4)
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *REST) for r in rows], SCHEMA).repartition(5)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


# -- 11 -----------------------------------------------------------------------
def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute_vocabulary(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(ASCII_LOWER)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute_forms(vocab, ratio=10):
    near = {w: [x for x in vocab if one_edit(w, x)] for w in vocab}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best and vocab[best] >= ratio * vocab[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), vocab[w], len(near[w]), vocab.get(form[w])) for w in vocab}


def text_rows():
    rng = random.Random(11)
    base = ["".join(rng.choice(["ba", "lo", "ré", "ÿn", "st", "ö", "Å", "×", "um"]) for _ in range(rng.randrange(4, 7))) for _ in range(60)]
    rows = []
    for i in range(400):
        ws = [rng.choice(base[:6] if rng.random() < 0.6 else base) for _ in range(30)]
        ws = [w[:-2] + w[-1] if rng.random() < 0.03 else w + "a" if rng.random() < 0.03 else w for w in ws]
        rows.append((i, " ".join(ws)))
    rows += [(None, None), (None, "Balobalo, BALOBALO"), (7, ""), (8, "1 2 3 -"), (9, "a" * 40_000 + " " + "a" * 40_000), rows[3], rows[3]]
    return rows


def test_vocabulary_equals_brute_force(spark):
    rows = text_rows()
    got = {r["word"]: r["n"] for r in variants.vocabulary(frame(spark, rows)).collect()}
    assert got == brute_vocabulary(rows)
    assert variants.vocabulary(frame(spark, rows).where("false")).count() == 0


@pytest.mark.parametrize("cell_words", [40, 1 << 15])  # small cells: most halves are dealt to several
def test_variant_forms_equal_brute_force(spark, cell_words):
    vocab = {w: n for w, n in brute_vocabulary(text_rows()).items() if len(w) < 1000}
    vocab |= {"chainab": 2, "chainabc": 20, "chainabcd": 200, "chainabcde": 2000, "chainabcdef": 20000, "tietiea": 3, "tietieb": 50, "tietiec": 50}
    df = written(spark.createDataFrame(list(vocab.items()), "word string, n long").repartition(3), "vocab_test")
    pairs = [(r["word"], r["near"], r["near_n"]) for r in variants.near_words(df, cell_words).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b, vocab[b]) for a in vocab for b in vocab if one_edit(a, b)}
    got = variants.variant_forms(df, cell_words=cell_words).collect()
    assert {tuple(r) for r in got} == brute_forms(vocab) and len(got) == len(vocab)
    assert next(r for r in got if r["word"] == "chainab")["root"] == "chainabcdef"
    assert next(r for r in got if r["word"] == "tietiea")["form"] == "tietieb"


def test_index_over_few_letters_finds_every_edit(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("aab") for _ in range(rng.randrange(2, 9))) for _ in range(250)})
    index = variants.BidirectionalIndex(words)
    asked = words + ["zzzz", "abz", "aaaaaaaaaaaa"]
    found = set()
    for left in (True, False):
        q, w = index.near(asked, left)
        assert len(set(zip(q.tolist(), w.tolist(), strict=True))) == len(q)
        found |= {(asked[a], words[b]) for a, b in zip(q, w, strict=True)}
    assert found == {(a, b) for a in asked for b in words if one_edit(a, b)}


def test_an_empty_vocabulary_has_no_forms(spark):
    assert variants.variant_forms(spark.createDataFrame([], "word string, n long")).count() == 0


# -- 12 -----------------------------------------------------------------------
def features(text):
    w = words_of(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def importance_rows():
    rng = random.Random(12)
    names = ["Alpha", "beta", "GAMMA", "dé", "x", "Ünï", "7", "a" * 90, "日本"]
    rows = [(i, rng.choice([" ", "\n--", "\0"]).join(rng.choice(names) for _ in range(rng.randrange(1, 60)))) for i in range(200)]
    rows += [(None, None), (None, rows[0][1]), (None, rows[0][1]), (500, ""), (501, " \n-"), (502, "b" * 70_000 + " c"), (503, "w " * 30_000)]
    return rows + [rows[5], rows[5], (5, None)]


def test_ngram_crcs_equal_those_of_the_strings():
    texts = [None if t is None else t.encode() for _, t in importance_rows()]
    counts, crcs, owners = importance.ngram_crcs(texts)
    for k, t in enumerate(texts):
        t = t.decode() if t else t
        got = [c for n in range(3) for c in crcs[n][owners[n] == k].tolist()]
        assert got == [crc32(f.encode()) for f in features(t)] and counts[k] == len(words_of(t))


def test_importance_equals_brute_force(spark):
    rows = importance_rows()
    target = [(1, "alpha beta gamma alpha beta"), (2, None), (3, "alpha beta")]
    s, t = (Counter(crc32(f.encode()) % 10_000 for _, x in part for f in features(x)) for part in (rows, target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10_000) / ((s[b] + 1.0) * (big_t + 10_000))))
    want = []
    for i, x in rows:
        f = features(x)
        weight = sum(gain(crc32(y.encode()) % 10_000) for y in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        want.append((i, len(words_of(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    docs = frame(spark, rows)
    gains = importance.fit(docs, frame(spark, target))
    assert gains.tolist() == [gain(b) for b in range(10_000)]
    got = importance.draw(importance.weigh(docs, gains, keep=["doc_id"]), percent=30).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]) for r in got), key=key) == sorted(want, key=key)
    fit = sorted((w for w in want if w[1] >= 20), key=lambda w: (-w[4], w[0] is None, w[0]))
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 30 * len(fit) // 100 + 1))
    assert [(r["doc_id"], r["score"]) for r in drawn] == [(w[0], w[4]) for w in fit[:len(drawn)]]


def test_importance_where_one_row_is_a_third_of_all(spark):
    rows = [(None, "word " * 25)] * 100 + [(i, f"other{i} " * 25) for i in range(200)]
    docs = frame(spark, rows)
    got = importance.draw(importance.weigh(docs, importance.fit(docs, docs), keep=["doc_id"]), percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, 151)) and len(got) == 300


def test_importance_of_empty_tables(spark):
    none = frame(spark, [(1, "x")]).where("false")
    assert importance.fit(none, none).tolist() == [0] * 10_000
    assert importance.draw(importance.weigh(none, np.zeros(10_000, np.int64), keep=["doc_id"])).count() == 0


# -- 13 -----------------------------------------------------------------------
def brute_blocks(rows, templates, threshold):
    out = Counter()
    for i, t in rows:
        w = words_of(t)
        for k, (label, text) in enumerate(templates):
            own = set(words_of(text))
            if not own:
                continue
            need, scale = math.ceil(threshold * len(own) - 1e-9), 4
            while scale < len(words_of(text)):
                scale *= 2
            for at in range(0, max(1, len(w) - scale), scale):
                n = len(own & set(w[at:at + 2 * scale]))
                if n >= need:
                    out[i, label, k, at, n] += 1
    return out


def license_rows():
    rng = random.Random(13)
    pool = [w for _, t in licenses.TEMPLATES for w in words_of(t)] + ["ouon", "éau"] * 40
    rows = []
    for i in range(150):
        ws = [rng.choice(pool) for _ in range(rng.randrange(1, 120))]
        if i % 3 == 0:
            own = words_of(rng.choice(licenses.TEMPLATES)[1])
            at = rng.randrange(len(ws))
            ws[at:at] = [w.upper() for w in own if rng.random() < 0.9]
        if i % 4 == 0:
            ws[0:0] = ["CC", "by", "cc", "BY"]
        rows.append((i, rng.choice([" ", "\n", " - "]).join(ws)))
    rows += [(None, None), (None, "All rights reserved"), (300, ""), (301, "\n\n"), (302, "x " * 20_000 + "released under the MIT license"), (303, "cc\0by"),
             (304, "ccby all rights  reserveds"), rows[0], rows[0], (0, "other text")]
    return rows


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_matching_blocks_equal_brute_force(spark, threshold):
    rows = license_rows()
    templates = [*licenses.TEMPLATES, ("none", " -- "), ("one", "éau")]
    words = frame(spark, rows).select("doc_id", licenses.words_of(F.col("text")).alias("words"))
    ordered, order = licenses.order_templates(words.select("words"), templates, threshold)
    got = Counter((r["doc_id"], r["label"], r["template"], r["first"], r["n_common"])
                  for r in licenses.matching_blocks(words, ordered, order).collect())
    assert got == brute_blocks(rows, templates, threshold)


def test_license_scan_equals_brute_force(spark):
    rows = license_rows()
    blocks = {}
    for (i, label, k, _, n), _ in brute_blocks([(j, t) for j, (_, t) in enumerate(rows)], licenses.TEMPLATES, 0.8).items():
        blocks.setdefault(i, []).append((label, n / len(set(words_of(licenses.TEMPLATES[k][1])))))
    want = []
    for j, (i, t) in enumerate(rows):
        w = words_of(t)
        places = [(a, label) for p, label in licenses.PHRASES.items() for a in range(len(w)) if w[a:a + len(p.split())] == p.split()]
        starts, base = [a for a, _ in places], {label for _, label in places}
        more = blocks.get(j, [])
        want.append((i, len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                     ",".join(sorted(base | {x for x, _ in more})), 1.0 if places else max((c for _, c in more), default=0.0)))
    got = [tuple(r) for r in licenses.scan(frame(spark, rows)).collect()]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_license_scan_of_empty_tables_and_no_templates(spark):
    assert licenses.scan(frame(spark, license_rows()).where("false")).count() == 0
    got = licenses.scan(frame(spark, [(1, "all rights reserved mit license")]), templates=[], phrases={}).collect()
    assert [tuple(r) for r in got] == [(1, 5, 0, None, None, "", "", 0.0)]


def test_license_scan_runs_no_python(spark):
    plan = licenses.scan(frame(spark, license_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
