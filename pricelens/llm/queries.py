"""The registered queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import (bpe, exact_dedup, importance, langid, licenses, line_dedup, minhash, mixing, sharding, token_store, topk, toxicity,
                           variants)
from pricelens.llm.common import fold_of, table, written
from pricelens.session import scratch_path

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets reach a similarity of 0.85."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of held-out documents are not read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    seen = fold_of("doc_id", 3) != 1
    labels = table(spark, sf_dir, "labels").where(seen & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    prior = labels.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0]
    positives = docs.join(labels.where("toxic = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    model = toxicity.fit(positives, docs.where(seen), prior)
    out = toxicity.score(docs.withColumn("held_out", fold_of("doc_id", 3) == 1), model, keep=["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each group of equal texts stays."""
    out = exact_dedup.decisions(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLE["op3_exact_dedup"] = r"""
with d as (
 select doc_id, length(coalesce(text, '')) as len, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
 from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
 doc_id is not distinct from first_value(doc_id) over w as kept, text_sha256
from d window w as (partition by text_sha256 order by len desc, doc_id nulls last)
"""


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that are not blank, how many stay, and a digest of the places that stay."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.kept_lines(docs).select(
        "doc_id", "n_lines", F.size("kept").cast("long").alias("kept_lines"), F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"))


ORACLE["op6_line_dedup"] = r"""
with s as (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null),
l as (
 select * from (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos from s)
 where regexp_matches(line, '[^\x20\x09-\x0D]')),
f as (select line, min(row(doc_id, pos)) as first, length(line) as n from l group by line),
e as (
 select distinct line, first, n, h, side, case side when 'f' then left(line, h) else right(line, h) end as part
 from (select line, first, n, unnest([n // 2, (n - 1) // 2]) as h from f where n >= 20), (values ('f'), ('l')) v(side)),
p as (
 select distinct a.line, a.first as af, b.first as bf, case when a.n <= b.n then a.line else b.line end as x,
  case when a.n <= b.n then b.line else a.line end as y
 from e a join e b on a.h = b.h and a.side = b.side and a.part = b.part where a.line <> b.line and a.first > b.first and abs(a.n - b.n) <= 1),
near as (
 select distinct line from p where len(list_filter(range(0, length(x) + 1), lambda i: left(x, i) = left(y, i)
  and (substr(x, i + 1) = substr(y, i + 2) and length(x) < length(y) or substr(x, i + 2) = substr(y, i + 2) and length(x) = length(y)))) > 0),
k as (
 select l.doc_id, l.pos, l.line, row(l.doc_id, l.pos) = f.first and near.line is null as kept
 from l join f using (line) left join near using (line)),
c as (
 select doc_id, count(*) as n_lines, count(*) filter (kept) as kept_lines,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (kept), '')) as kept_sha256 from k group by doc_id)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(kept_lines, 0) as kept_lines, coalesce(kept_sha256, sha256('')) as kept_sha256
from (select distinct doc_id from documents) d left join c using (doc_id)
"""


@query
def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best candidates of every query vector (ids divisible by 100) by integer inner product."""
    vecs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return topk.top_k(vecs.where("id % 100 = 0"), vecs, k=10)


ORACLE["op7_topk_search"] = """
with v as (
 select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q
 from embeddings where vec_id is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
 select a.vec_id as query_id, b.vec_id,
  cast(coalesce(list_sum(list_transform(list_zip(a.q, b.q, true), lambda z: z[1] * z[2])), 0) as bigint) as score
 from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10
"""


def quality_domains(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """The labelled table of the mixing: a document's language and quality label name its domain."""
    labels = table(spark, sf_dir, "labels").where("quality is not null").select("doc_id", "quality")
    named = docs.where("lang is not null").select("doc_id", "lang").join(labels, "doc_id")
    return named.select("doc_id", F.concat("lang", F.lit("/q"), F.col("quality").cast("string")).alias("domain"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents whose expected tokens per domain match tempered targets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    mix, rates = mixing.fit(docs, quality_domains(spark, sf_dir, docs))
    if mix is None:
        return rates.select("doc_id", F.col("tokens").alias("n_tokens"), F.lit(1.0).alias("rate"))
    domains = mix.classifier.domains
    return rates.select("doc_id", F.col("tokens").alias("n_tokens"),
                        F.map_from_arrays(F.array(*map(F.lit, domains)), F.array(*[f"p{i}" for i in range(len(domains))])).alias("posterior"),
                        "rate")


@query
def op9_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near-equal bytes, with their slots."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_rows(docs, n_shards=8).select(
        "doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; held-out documents are not learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = langid.fit(docs.where(fold_of("doc_id", 4) != 2))
    return langid.predict(docs.withColumn("held_out", fold_of("doc_id", 4) == 2), net, keep=["doc_id", "held_out"])


@query
def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as shards with a perfect hash index and read back by key."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    store = token_store.write(docs, public_tokenizers.path(BYTE_VOCABULARY), scratch_path(spark, "tokens"))
    return token_store.read(store, docs.select("doc_id").distinct()).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text decoded from them, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode(docs, public_tokenizers.path(WORD_VOCABULARY), decode=True, keep=["doc_id"])
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


# DuckDB has no crc32: the table `tab` of its 256 byte steps, and a text's value from them.
CRC_TABLE = """bits(b, k, c) as (
 select b, 0, b from range(256) r(b)
 union all select b, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from bits where k < 8),
tab as (select list(c order by b) as t from bits where k = 8)"""


def crc32_sql(s: str) -> str:
    byte = f"('0x' || substr(hex(encode({s})), 2 * i + 1, 2))::bigint"
    return (f"xor(list_reduce(list_transform(range(octet_length(encode({s}))), lambda i: {byte}), "
            "lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]), 4294967295::bigint), 4294967295)")


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = rf"regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word, and its near words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.variant_forms(written(variants.vocabulary(docs), "vocabulary"))


ORACLE["op11_spelling_variants"] = f"""
with recursive {CRC_TABLE},
r as (
 select doc_id, run, count(*) as k from (
  select doc_id, unnest(regexp_extract_all({LOWER_SQL}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents)
 where length(run) >= 7 group by doc_id, run),
h as (select run, k, {crc32_sql("concat(doc_id, ':', run)")} as h from r, tab),
w as (
 select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, k from h),
v as materialized (select word, cast(sum(k) as bigint) as n from w where length(word) >= 7 group by word having sum(k) >= 2),
d as materialized (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as cut from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
p as (
 select a.word, b.word as near, b.n as near_n from d a join d b on a.cut = b.cut and a.i = b.i and a.word <> b.word
 union select d.word, v.word, v.n from d join v on d.cut = v.word
 union select v.word, d.word, d.n from d join v on d.cut = v.word),
g as (
 select word, count(*) as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n from p group by word),
f as materialized (
 select v.word, v.n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * v.n then near end as form, case when near_n >= 10 * v.n then near_n end as form_n
 from v left join g using (word)),
c(word, root, steps) as (
 select word, word, 0 from f union all select c.word, f.form, steps + 1 from c join f on f.word = c.root where f.form is not null),
z as (select word, max_by(root, steps) as root from c group by word)
select word, form, root, n, n_near, form_n from f join z using (word)
"""


@query
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, noisy score and rank of every document towards the benchmark's texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gains = importance.fit(docs, table(spark, sf_dir, "benchmark"))
    drawn = importance.draw(importance.weigh(docs, gains, keep=["doc_id"]), percent=5, min_words=20, seed=42)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE["op12_importance"] = f"""
with recursive {CRC_TABLE},
a as (
 select row_number() over () as r, true as raw, doc_id, {WORDS_SQL} as ws from documents
 union all select row_number() over (), false, null, {WORDS_SQL} from benchmark),
x as materialized (
 select r, raw, unnest(flatten([list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' ')) for n in [1, 2, 3]])) as f
 from a),
h as (select f, {crc32_sql("f")} % 10000 as bucket from (select distinct f from x), tab),
y as materialized (select r, raw, bucket from x join h using (f)),
s as (select bucket, count(*) filter (raw) as s, count(*) filter (not raw) as t from y group by bucket),
z as (select cast(coalesce(sum(s), 0) as double) as s, cast(coalesce(sum(t), 0) as double) as t from s),
g as (
 select bucket, cast(floor(1000 * ln((cast(s.t as double) + 1) * (z.s + 10000) / ((cast(s.s as double) + 1) * (z.t + 10000)))) as bigint) as gain from s, z),
w as (select r, count(*) as n, cast(sum(gain) as bigint) as weight from y join g using (bucket) where raw group by r),
o as (
 select doc_id, len(ws) >= 20 as fit, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight,
  cast(('0x' || substr(sha256(concat('42:', doc_id)), 1, 8)) as bigint) as h
 from a left join w using (r) where raw),
q as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score from o),
k as (select *, row_number() over (partition by fit order by score desc, doc_id) as place, count(*) filter (fit) over () as fits from q)
select doc_id, n_features, weight, score, case when fit and place <= 5 * fits // 100 then place end as rank from k
"""


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases of every document, and the labels of templates that a block holds."""
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _license_oracle() -> str:
    """Every block against every template of its scale."""
    rows = ", ".join(
        f"('{label}', {sorted(set(licenses.template_words(text)))}, {licenses.needed(text, licenses.THRESHOLD)}, {licenses.scale_of(text)})"
        for label, text in licenses.TEMPLATES)
    here = " + ".join(f"len({p})" for p in ("cc", "gpl", "res"))
    start = lambda phrase: "list_filter(range(1, len(ws) + 1), lambda i: " + " and ".join(
        f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase.split())) + ")"
    cc, gpl, res = map(start, licenses.PHRASES)
    return f"""
with a as (select row_number() over () as r, doc_id, {WORDS_SQL} as ws from documents),
d as (select *, {cc} as cc, {gpl} as gpl, {res} as res from a),
t(label, t, need, scale) as (values {rows}),
b as (
 select r, scale, ws[k * scale + 1:(k + 2) * scale] as b
 from (select r, ws, scale, unnest(range(0, greatest(1, cast(ceil(len(ws) / scale) as bigint) - 1))) as k from d, (select distinct scale from t))),
m as (select r, label, len(list_filter(t.t, lambda x: list_contains(b.b, x))) as c, need, len(t.t) as n from b join t using (scale)),
f as (select r, list(distinct label) as more, max(c / n) as best from m where c >= need group by r),
e as (
 select *, list_filter([case when len(cc) > 0 then 'cc-by' end, case when len(gpl) > 0 then 'gpl' end, case when len(res) > 0 then 'reserved' end],
  lambda x: x is not null) as base, list_concat(list_concat(cc, gpl), res) as places from d left join f using (r))
select doc_id, len(ws) as n_words, {here} as n_base, list_min(places) - 1 as first_word, list_max(places) - 1 as last_word,
 array_to_string(list_sort(base), ',') as base_labels, array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') as labels,
 case when {here} > 0 then 1.0::double else coalesce(best, 0.0::double) end as score
from e
"""


ORACLE["op13_license_scan"] = _license_oracle()


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
