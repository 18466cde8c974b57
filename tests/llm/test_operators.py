"""Small fixtures against brute force: nulls, blanks, ties, repeats, empty tables, clashing columns."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricelens.llm import bpe, exact_dedup, langid, line_dedup, minhash, mixing, sharding, token_store, topk, toxicity
from pricelens.session import scratch_path

WORDS = "amber basalt cedar delta ember fjord gravel harbor iris jetty kelp lagoon".split()
# Columns beside id and text, with names that the operators use themselves.
SCHEMA = "doc_id long, text string, score double, ids string, size long, shard int, kept boolean, row string, copies int, key string"


def texts(seed=1, n=60):
    rng = random.Random(seed)
    out = [None, "", "  \n\t ", "one", "One", "a b c d", "a b c d e", "A  b\nc d e", "é ́ Σ İ <|endoftext|> 日本", "x" * 30_000]
    out += [" ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(rng.randrange(1, 90))) for _ in range(n)]
    for t in out[10:30]:  # near and exact copies, and copies that differ in blanks
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        out += [" ".join(w), t, t.replace(" ", "\n")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 0.5, "x", 1, 2, False, "r", 3, "k") for i, t in enumerate(texts())]
    rows += [rows[12], rows[12], (None, rows[13][1], *rows[0][2:]), (None, None, *rows[0][2:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def order(i):
    return (i is None, i)


# -- 1 ------------------------------------------------------------------------
def brute_components(rows, percent):
    sets = []
    for _, t in rows:
        w = [x for x in re.split(rb"[\x20\x09-\x0D]+", (t or "").encode().lower()) if x]
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    names = {}
    for i, (k, _) in enumerate(rows):
        names[find(i)] = min(names.get(find(i), k), k, key=order)
    return sorted(((k, len(sets[i]), names[find(i)] if sets[i] else k) for i, (k, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_brute_force(docs, percent):
    got = minhash.near_duplicates(docs, percent).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute_components(pairs_of(docs), percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_of_a_large_group(spark):
    """Copies that drift apart: large buckets, blocks of several cells, chains of links."""
    rng = random.Random(4)
    base, rows = [rng.choice(WORDS) + str(rng.randrange(99)) for _ in range(60)], []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(60)] = f"n{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    old, minhash.BLOCK = minhash.BLOCK, 64
    try:
        got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    finally:
        minhash.BLOCK = old
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute_components(rows, 85)


def test_estimate_follows_the_similarity():
    rng = np.random.default_rng(5)
    for similarity in (0.5, 0.85):
        got = []
        for _ in range(40):
            shared = rng.integers(0, 1 << 63, int(2000 * similarity), dtype=np.uint64)
            rest = rng.integers(0, 1 << 63, (2, (2000 - len(shared)) // 2), dtype=np.uint64)
            a, b = (minhash.packed(minhash.minima(np.concatenate([shared, r]))).view(np.uint64)[None, :] for r in rest)
            equal = minhash._equal_matrix(a, b)[0, 0] / minhash.HASHES
            got.append((equal - 2.0 ** -minhash.BITS) / (1 - 2.0 ** -minhash.BITS))
        assert abs(np.mean(got) - similarity) < 0.02 and np.std(got) < 0.04


# -- 2 ------------------------------------------------------------------------
def test_toxicity_finds_planted_words(spark, docs, empty):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        w = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(40)]
        toxic = i % 8 == 0
        if toxic:
            w[rng.randrange(40)] = rng.choice(["zounds", "vexing", "grumbler"])
        rows.append((i, " ".join(w), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    seen = F.col("doc_id") % 3 != 1
    model = toxicity.fit(df.where(seen & (F.col("toxic") == 1)), df.where(seen), 0.125)
    out = toxicity.score(df.where(~seen), model).collect()
    hit = [(r["score"] >= 0.7) == (r["toxic"] == 1) for r in out]
    assert np.mean(hit) > 0.97
    edge = toxicity.score(docs, model)
    assert edge.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert all(0 <= r["score"] <= 1 for r in edge.collect()) and edge.count() == docs.count()
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.fit(df.where("false"), df, 0.1) is None and toxicity.score(docs, None).first()["score"] == 0.0


def test_toxicity_without_features_or_with_a_high_prior(spark):
    rng = random.Random(21)
    plain = ["stone", "river", "field", "cloud"]
    rows = [(i, " ".join(rng.choice(plain) for _ in range(20)) + (f" vileword{i % 7}" if i % 5 < 3 else ""), int(i % 5 < 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.where("toxic = 1 and doc_id < 250").select("doc_id", "text"), df.select("doc_id", "text"), 0.6)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    assert all((got[i] >= 0.7) == bool(y) for i, _, y in rows)
    same = spark.createDataFrame([(i, "one and the same") for i in range(30)], "doc_id long, text string")
    model = toxicity.fit(same, same, 0.6)
    assert model.features == () and toxicity.score(same, model).agg(F.min("score"), F.max("score")).first() == pytest.approx((0.6, 0.6))


# -- 3 ------------------------------------------------------------------------
def brute_exact(rows):
    groups = {}
    for k, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((k, len(t or "")))
    out = []
    for k, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[norm], key=lambda x: (-x[1], order(x[0])))[0]
        out.append((k, best, len(groups[norm]), k == best, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("support", [1 / 1000, 0.02])
def test_exact_dedup_equals_brute_force(docs, support, monkeypatch):
    monkeypatch.setattr(exact_dedup.heavy_candidates, "__defaults__", (support, exact_dedup.COUNTERS))
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["digest"]) for r in exact_dedup.decisions(docs).collect()]
    assert sorted(got, key=str) == brute_exact(pairs_of(docs))
    left = exact_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    want = {re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in pairs_of(docs)}
    assert sorted(re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in left.collect()) == sorted(want)


def test_misra_gries_keeps_every_heavy_key():
    rng, k, counts, rows = random.Random(3), 9, {}, []
    for _ in range(30):
        part = [rng.choice("ab") if rng.random() < 0.4 else str(rng.random()) for _ in range(200)]
        rows += part
        more = {}
        for x in part:
            more[x] = more.get(x, 0) + 1
        counts = exact_dedup.misra_gries(counts, more, k)
    assert len(counts) <= k
    for x in "ab":
        assert rows.count(x) - len(rows) / (k + 1) <= counts[x] <= rows.count(x)


# -- 4 ------------------------------------------------------------------------
def test_language_id_learns_and_handles_edges(spark, docs, empty):
    rng = random.Random(6)
    alphabet = {"aa": "abcde", "bb": "vwxyzß"}
    rows = [(i, " ".join("".join(rng.choice(alphabet[lang]) for _ in range(rng.randrange(2, 9))) for _ in range(30)), lang)
            for i in range(120) for lang in alphabet]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = langid.fit(df.where("doc_id % 4 <> 2"), steps=60)
    out = langid.predict(df.where("doc_id % 4 = 2"), net).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in out]) > 0.95
    edge = {(r["text"] or ""): r for r in langid.predict(docs, net).collect()}
    for t in ("", "  \n\t "):
        assert edge[t]["lang_pred"] == "und" and edge[t]["score"] == 0.0
    assert edge["x" * 30_000]["lang_pred"] == "bb"
    assert langid.predict(empty, net).count() == 0 and langid.fit(df.where("false")) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}


def test_byte_network_gradients():
    rng = np.random.default_rng(0)
    net = {"table": rng.normal(0, .3, (2, 12, 256)), "hidden": rng.normal(0, .3, (2, 12, 4)), "out": rng.normal(0, .3, (3, 8)), "bias": np.zeros((3, 1))}
    net = {k: v.astype(np.float32) for k, v in net.items()}
    data, mask = langid.pack([b"abcabcab", b"xyz", b"aazzbbcc"], 8)
    target = np.array([0, 1, 2])
    _, grad = langid._gradients(net, data, mask, target)
    for name, at in (("out", (1, 3)), ("hidden", (0, 3, 2)), ("hidden", (1, 9, 1)), ("table", (0, 5, ord("b"))), ("table", (1, 10, ord("z")))):
        side = []
        for e in (1e-2, -1e-2):
            moved = {k: v.copy() for k, v in net.items()}
            moved[name][at] += e
            side.append(langid._gradients(moved, data, mask, target)[0])
        assert grad[name][at] == pytest.approx((side[0] - side[1]) / 2e-2, rel=0.05, abs=2e-4)


# -- 5 ------------------------------------------------------------------------
def test_token_store_round_trip(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = sorted(pairs_of(docs), key=lambda r: (r[0] is not None, r[0] or 0))
    store = token_store.write(docs, path, scratch_path(spark, "store-test"), keys_per_part=16)
    got = token_store.read(store, docs.select("doc_id").distinct()).collect()
    want = {}
    for k, t in rows:
        want.setdefault(k, []).append(np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes())
    found = {}
    for r in sorted(got, key=lambda r: r["start"]):
        found.setdefault(r["key"], []).append(bytes(r["ids"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    base = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == base and r["n_tokens"] * 4 == len(r["ids"])
        base += r["n_tokens"]
    starts = [r["key"] for r in sorted(got, key=lambda r: r["start"])]
    assert starts == [k for k, _ in rows]
    assert token_store.read(store, spark.createDataFrame([(10 ** 9,), (-5,)], "doc_id long")).count() == 0
    none = token_store.write(empty, path, scratch_path(spark, "store-test"))
    assert token_store.read(none, docs.select("doc_id").distinct()).count() == 0


def test_token_store_where_one_key_holds_a_third(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [(None, f"hot row {i % 50} of the null key") for i in range(150)] + [(i, f"row {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    store = token_store.write(df, path, scratch_path(spark, "store-test"), shard_bytes=300)
    got = sorted(token_store.read(store, df.select("doc_id").distinct()).collect(), key=lambda r: r["start"])
    ids = lambda t: np.array([*library.encode(t, add_special_tokens=False).ids, 0], dtype="<u4").tobytes()
    assert sorted(((r["key"] is None, r["key"]), bytes(r["ids"])) for r in got) == sorted(((k is None, k), ids(t)) for k, t in rows)
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got[:-1])]).tolist()
    entries = [f for f in os.listdir(store.path.removeprefix("file:")) if f.startswith("shard-")]
    assert len(entries) > 8  # the null key alone fills several shards
    runs = sum(token_store.Index(store.path, p).runs["docs"].sum() for p in range(store.parts))
    assert runs == 450


def test_index_part_with_equal_first_hashes(tmp_path, monkeypatch):
    monkeypatch.setattr(token_store.TaskContext, "get", staticmethod(lambda: type("T", (), {"taskAttemptId": lambda self: 0})()))
    rows = pa.table({"h": [7, 7, 7, 9, 7], "mark": [1, 2, 3, 1, 2], "shard": [0, 1, 2, 3, 4], "first": [0] * 5, "docs": [1] * 5,
                     "start": [0, 10, 20, 30, 40]})
    token_store._write_index(f"file://{tmp_path}")((pa.scalar(0),), rows)
    index = token_store.Index(f"file://{tmp_path}", 0)
    found, runs = index.look_up(np.array([7, 7, 9, 7, 7]), np.array([2, 3, 1, 1, 8]))
    assert index.seed > 0 and found.tolist() == [0, 0, 1, 2, 3] and runs["shard"].tolist() == [1, 4, 2, 3, 0]


def test_store_paths_name_file_systems():
    fs, root = token_store.filesystem("file:/a/b")
    assert root == "/a/b"
    try:
        assert token_store.filesystem("s3a://bucket/x")[1] == "bucket/x"
    except OSError as e:  # no region can be asked for without a network
        assert "Unrecognized" not in str(e)


def test_library_encoder_equals_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, mine = Tokenizer.from_file(path), token_store.LibraryEncoder(path)
    rng = random.Random(7)
    for _ in range(3000):
        t = "".join(rng.choice(["a", "b", " ", " ", "\n", "T", "'", "s", ".", "1", "é", "\t", "\0", "<|endoftext|>"]) for _ in range(rng.randrange(40)))
        assert np.frombuffer(mine.encode(t), "<u2").tolist() == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_perfect_hash_is_minimal(n):
    h = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
    assert sorted(token_store.slots_of(h, token_store.build_mph(h), n).tolist()) == list(range(n))


# -- 6 ------------------------------------------------------------------------
def brute_lines(rows, least):
    first, seen = {}, []
    for k, t in rows:
        for p, line in enumerate((t or "").split("\n") if t is not None else []):
            if re.search(r"[^\x20\x09-\x0D]", line):
                seen.append((k, p, line))
                first[line] = min(first.get(line, (k, p)), (k, p))

    def close(a, b):
        return any(a[:i] + a[i + 1:] in (b, b[:i] + b[i + 1:]) for i in range(len(a))) or any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    gone = {a for a in first for b in first if a != b and len(a) >= least and len(b) >= least and abs(len(a) - len(b)) <= 1
            and first[b] < first[a] and close(a, b)}
    return sorted((k, p, first[line] == (k, p) and line not in gone) for k, p, line in seen)


def test_line_dedup_keeps_lines_of_one_of_repeated_rows(spark):
    third = (None, "a line that is repeated\nanother line that is repeated\n\nshort")
    rows = [third] * 40 + [(i, f"a line of document {i} alone\nanother line that is repeated") for i in range(1000, 80_000, 1000)] + [(5000, rows_text)] * 3
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, kept string, n_lines int").repartition(5)
    got = Counter((r["doc_id"], r["line"]) for r in line_dedup.decisions(df).collect() if r["kept"])
    assert got[None, "a line that is repeated"] == 1 and got[None, "short"] == 1
    assert sum(n for (_, line), n in got.items() if line == "another line that is repeated") == 1
    assert got[5000, rows_text] == 1
    kept = [r for r in line_dedup.kept_lines(df).collect() if r["doc_id"] is None]
    assert len(kept) == 40 and sorted(len(r["kept"]) for r in kept) == [0] * 39 + [2]
    assert line_dedup.cleaned(df).columns == df.columns


rows_text = "a line that only three rows of one id have"


def test_line_dedup_equals_brute_force(spark, empty):
    rng = random.Random(8)
    base = ["".join(rng.choice("abé ") for _ in range(rng.randrange(1, 12))) for _ in range(25)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(5):
            x = list(rng.choice(base))
            if rng.random() < 0.6:
                at = rng.randrange(len(x))
                x[at:at + rng.randrange(2)] = [rng.choice("abcdé")] if rng.random() < 0.7 else []
            lines.append("".join(x))
        rows.append((i, "\n".join(lines)))
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "z" * 9000 + "\n" + "z" * 9001)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["pos"], r["kept"]) for r in line_dedup.decisions(df, min_chars=4).collect())
    assert got == brute_lines(rows, 4)
    kept = {r["doc_id"]: r["text"] for r in line_dedup.cleaned(df, min_chars=4).collect()}
    keep = {(k, p) for k, p, y in got if y}
    for k, t in rows:
        want = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if not x.strip(" \t\n\x0b\x0c\r") or (k, p) in keep)
        assert kept[k] == want
    assert line_dedup.decisions(empty).count() == 0


# -- 7 ------------------------------------------------------------------------
def test_top_k_equals_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, rng.uniform(-2, 2)]) for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(300, 340)] + [(340, None), (341, [1.0, None]), (342, [float("nan")]), (343, [float("inf")]),
                                                        (344, []), (345, [1.0]), (345, [1.0]), (None, [1.0]), (400, [3e38] * 6)]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    q = df.where("id % 20 = 0")
    got = sorted(tuple(r) for r in topk.top_k(q, df, 5, query_block=4, candidate_block=64).collect())
    ok = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for qi, qv in ok:
        if qi % 20 == 0:
            s = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(qv, v)))), i) for i, v in ok if i != qi)[:5]
            want += [(qi, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    assert got == sorted(want)
    assert topk.top_k(q.where("false"), df).count() == 0 and topk.top_k(q, df.where("false")).count() == 0


# -- 8 ------------------------------------------------------------------------
def test_mixing_reaches_its_targets(spark, docs, empty):
    rng = random.Random(10)
    rows = [(i, " ".join("".join(rng.choice("abc" if i % 3 else "xyz") for _ in range(5)) for _ in range(rng.randrange(5, 60))), "p" if i % 3 else "q")
            for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    labels = df.where("doc_id % 2 = 0").select("doc_id", "domain")
    mix, rates = mixing.fit(df, labels, {"p": 0.25, "q": 0.75})
    got = rates.agg(*[F.sum(F.col("rate") * F.col("tokens") * F.col(f"p{i}")) for i in range(2)]).first()
    total = sum(len(t.split()) for _, t, _ in rows)
    assert got[0] == pytest.approx(0.25 * total, rel=1e-3) and got[1] == pytest.approx(0.75 * total, rel=1e-3)
    assert rates.agg(F.min("rate")).first()[0] >= 0
    own = {r["doc_id"]: r["rate"] for r in rates.collect()}
    assert all(own[r["doc_id"]] == pytest.approx(r["rate"]) and r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in mixing.apply(df, mix).collect())
    assert mixing.mixture(docs, mix).columns == docs.columns and mixing.mixture(empty, mix).count() == 0
    assert mixing.fit(docs, labels.where("false"))[0] is None and mixing.mixture(docs, None).count() == docs.count()
    assert mixing.fit(empty, labels)[0] is None
    plan = mixing.apply(df, mix)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_mixing_tells_any_alphabets_and_symbols_apart(spark):
    rng = random.Random(13)
    words = {"uk": "їжак єдність місто ґрунт вулиця", "ru": "ёлка объезд мышь город улица", "ja": "東京の ひらがな です カタカナ", "zh": "北京的 中文 汉字 我们",
             "junk": "river ***!! $$$ %%% &&& ###", "plain": "river stone harbor field"}
    rows = [(i, " ".join(rng.choice(words[d].split()) for _ in range(30)), d) for i, d in enumerate(sorted(words) * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    mix, rates = mixing.fit(df, df.where("doc_id < 60").select("doc_id", "domain"))
    domains = mix.classifier.domains
    for r in rates.join(df.select("doc_id", "domain"), "doc_id").collect():
        assert r[f"p{domains.index(r['domain'])}"] > 0.9


def test_mixing_counts_every_character(spark):
    texts = ["", "Aé ÄЖ 日本\t*\x01٣", "x" * 300, "😀 é́|^\\_"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.features(F.col("text"))).collect()
    for t, (f,) in zip(texts, got, strict=True):
        assert len(f) == mixing.N_FEATURES
        assert sum(f[:-len(mixing.CLASSES) - 1]) == len(t.lower().encode()) and sum(f[-len(mixing.CLASSES) - 1:]) == len(t)


# -- 9 ------------------------------------------------------------------------
@pytest.mark.parametrize("bin_rows", [8, 4096])
def test_shards_are_near_equal_and_gapless(spark, docs, empty, bin_rows):
    rng = random.Random(11)
    rows = [(i, "copy " * 20 if i % 3 == 0 else "w" * rng.randrange(200)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.shard_rows(df, 8, bin_rows=bin_rows).toPandas()
    sizes = out.groupby("shard")["_size"].sum()
    assert len(out) == 900 and sizes.max() - sizes.min() <= 4 * out["_size"].max()
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    split = out.groupby("text")["shard"].nunique()
    assert (split.drop("copy " * 20) <= 2).all() and (split > 1).sum() <= 8
    edge = sharding.shard_rows(docs, 8, bin_rows=bin_rows)
    rows = edge.collect()
    assert len(rows) == docs.count()
    assert all(r["_size"] == len((r["text"] or "").encode()) + 1 and r["_crc"] == zlib.crc32((r["text"] or "").encode()) for r in rows)
    assert sharding.shard_rows(empty, 8).count() == 0


def test_shards_of_repeated_rows_are_near_equal(spark):
    rows = [(None, "one text for a third of all rows")] * 300 + [(i, f"text {i} " * 3) for i in range(600)]
    for bin_rows in (16, 4096):
        out = sharding.shard_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 8, bin_rows=bin_rows).toPandas()
        sizes = out.groupby("shard")["_size"].sum()
        assert len(out) == 900 and len(sizes) == 8 and sizes.max() - sizes.min() <= 2 * out["_size"].max()
        assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in out.groupby("shard"))
        assert out[out["doc_id"].notna()].groupby("text")["shard"].nunique().max() == 1


# -- 10 -----------------------------------------------------------------------
def test_bpe_equals_the_library(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    out = bpe.encode(docs, path, decode=True)
    assert [c for c in out.columns if c not in ("n_tokens", "ids", "decoded")] == [c for c in docs.columns if c != "ids"]
    for r in out.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(empty, path).count() == 0


def test_bpe_pieces_of_every_shape():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, mine = Tokenizer.from_file(path), bpe.WordBpe(path)
    rng = random.Random(12)
    cases = ["a" * 300, "aab" * 999, "the" * 3000, "\x1c \x1d", "don't I'LL", "<|startoftext|>x<|endoftext|>", "ΑΣ", "ﬁ", "ꟊ ᲊ 𞤀", "1٣²"]
    cases += ["".join(rng.choice("abehtionsr'.é") for _ in range(rng.randrange(5000))) for _ in range(60)]
    for t in cases:
        assert np.frombuffer(mine.encode([t])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_bpe_worker_holds_the_vocabulary_once():
    """The library gives the rules for new characters without a vocabulary of its own, and caches stay bounded."""
    from pricelens.llm.queries import WORD_VOCABULARY

    path = public_tokenizers.path(WORD_VOCABULARY)
    words, library = bpe.WordBpe(path), Tokenizer.from_file(path)
    assert Tokenizer.from_str(library.to_str()).get_vocab_size() > 40_000 and words.new.vocabulary_size() == 0
    texts = ["plain Text, 12's", "a\U0001fae9b Ƛ xᲉy \U00010d50\U00010d70", "<|endoftext|> é ΑΣ"]
    for payload, text in zip(words.encode(texts), texts):
        assert np.frombuffer(payload, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert 2 * bpe.CACHE_UNITS * 200 < 100e6 and bpe.SLICE_CHARS <= 500_000
