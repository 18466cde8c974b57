"""The registered queries and the pipeline over the smallest tables."""

import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from pricelens.fixture import BASE_TABLES
from pricelens.llm import queries
from tests.conftest import SF_SMALL

EXPECTED = {"op1": ["doc_id", "n_shingles", "component_id", "kept"], "op2": ["doc_id", "held_out", "score", "predicted"],
            "op4": ["doc_id", "held_out", "lang_pred", "score"], "op5": ["doc_id", "start", "n_tokens", "ids_crc32"],
            "op8": ["doc_id", "n_tokens", "posterior", "rate"],
            "op9": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
            "op10": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            "op12": ["doc_id", "n_features", "weight", "score", "rank"],
            "op13": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]}


def test_every_operator_has_one_query():
    assert sorted(int(m[1]) for q in queries.QUERIES if (m := re.match(r"op(\d+)_", q))) == list(range(1, 14))
    assert "pipeline" in queries.QUERIES


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    cur = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == Counter(cur.fetchall())


@pytest.mark.parametrize("op", sorted(EXPECTED))
def test_query_returns_every_document(spark, op):
    name = next(q for q in queries.QUERIES if q.startswith(op + "_"))
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert df.columns == EXPECTED[op]
    ids = [r["doc_id"] for r in df.select("doc_id").collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = queries_written(stage(spark, docs, SF_SMALL), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        sizes.append(docs.count())
        if name == "exact_dedup":
            norm = [re.sub(r"[\x20\x09-\x0D]", "", r["text"]) for r in docs.select("text").collect()]
            assert len(norm) == len(set(norm))
        if name == "near_dedup":
            from tests.llm.test_operators import brute_components

            rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
            assert all(k == c for k, _, c in brute_components(rows, 80))
    assert sizes[1] == sizes[0] >= sizes[2] >= sizes[3]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert out.count() == sizes[-1] and "ids" in out.columns


def test_language_stage_rejects_unlearned_languages_only(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    foreign = ["Все люди рождаются свободными и равными в своем достоинстве и правах. " * 3,
               "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
               "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
               "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
               "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
               "123 ... !!!", "", None]
    own = [r["text"] for r in docs.where("lang is not null").limit(20).collect()]
    rows = [(10 ** 6 + i, t, None, "s", 0) for i, t in enumerate(foreign)] + [(10 ** 7 + i, " ".join(t.split()[:3]), None, "s", 0) for i, t in enumerate(own)]
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), SF_SMALL).collect()}
    assert not kept & set(range(10 ** 6, 10 ** 6 + len(foreign)))
    assert {r["doc_id"] for r in docs.collect()} <= kept and set(range(10 ** 7, 10 ** 7 + 20)) <= kept


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = queries_written(stage(spark, docs, SF_SMALL), name)
        assert docs.count() == 0


def test_near_dedup_leaves_one_row_of_a_group_whatever_the_ids(spark):
    group = lambda w: [" ".join([f"{w}{i}" for i in range(80)] + [f"end{w}{k}"]) for k in range(3)]
    rows = [(None, t) for t in group("a")] + [(7, t) for t in group("b")] + [(7, "alone " * 9), (None, "single " * 9), (None, ""), (None, None)]
    rows += [(None, group("c")[0]), (9, group("c")[1]), (9, group("c")[1]), (3, group("d")[0]), (3, group("d")[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.dedup_near(spark, docs, SF_SMALL).collect()]
    of = lambda w: [i for i, t in left if (t or "").startswith(f"{w}0 ")]
    assert [of("a"), of("b"), of("c"), of("d")] == [[None], [7], [9], [3]]
    assert len(left) == 8 and {(7, "alone " * 9), (None, "single " * 9), (None, ""), (None, None)} <= set(left)


def queries_written(df, name):
    from pricelens.llm.common import written

    return written(df, name)
