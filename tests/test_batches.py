"""Batch ids, replays, and tables that are replaced together."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

from pricelens import schemas as S
from pricelens.fixture import view
from pricelens.operators.numbering import number_rows
from pricelens.session import materialize
from pricelens.sources import batches as B
from pricelens.sources import listings as IO
from pricelens.sources import versions as V
from pricelens.streaming.landing import write_landing_batch


@pytest.fixture()
def rows(spark):
    return view(spark, SF_SMALL, "raw_listings").drop("id").limit(40)


def ids_of(spark, target):
    return [r[0] for r in IO.read_listings(spark, path=target).select("id").collect()]


def test_landed_and_appended_rows_have_distinct_ids(spark, tmp_root, rows):
    target = os.path.join(tmp_root, "raw")
    assert IO.append_listings(rows, target) == 40
    assert write_landing_batch(rows, target, 0, "a") == 40
    assert write_landing_batch(rows, target, 0, "b") == 40
    assert IO.append_listings(rows, target) == 40       # no key: a batch of its own
    got = ids_of(spark, target)
    assert len(got) == 160 == len(set(got)) and min(got) >= 0


def test_a_replay_adds_nothing_and_repeats_ids(spark, tmp_root, rows):
    one, two = os.path.join(tmp_root, "one"), os.path.join(tmp_root, "two")
    assert IO.append_listings(rows, one, batch_key="k") == 40
    before = {tuple(r) for r in IO.read_listings(spark, path=one).collect()}
    assert IO.append_listings(rows.repartition(3), one, batch_key="k") == 0
    # A batch that failed after its rows were written, before it was recorded as done.
    number = B.claim_number(spark, one, "k")
    os.rename(os.path.join(one, "_done"), os.path.join(one, "_lost"))
    assert not B.is_done(spark, one, number)
    assert IO.append_listings(rows.repartition(5), one, batch_key="k") == 40
    assert {tuple(r) for r in IO.read_listings(spark, path=one).collect()} == before
    assert IO.append_listings(rows, two, batch_key="k") == 40
    assert sorted(ids_of(spark, two)) == sorted(r[0] for r in before)


def test_batches_with_one_number_move_on(spark, tmp_root):
    target = os.path.join(tmp_root, "raw")
    numbers = [B.claim_number(spark, target, f"key {i}", bits=2) for i in range(4)]
    assert sorted(numbers) == [0, 1, 2, 3]
    assert [B.claim_number(spark, target, f"key {i}", bits=2) for i in range(4)] == numbers
    with pytest.raises(RuntimeError):
        B.claim_number(spark, target, "one too many", bits=2)


def test_repeated_rows_of_a_batch_have_ids_of_their_own(spark, tmp_root, rows):
    target = os.path.join(tmp_root, "raw")
    third = rows.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n")
    assert IO.append_listings(rows.unionByName(third), target, batch_key="k") == 540
    assert len(set(ids_of(spark, target))) == 540


def test_same_time_other_content_is_another_batch(spark, tmp_root):
    from pricelens.plans.pipeline import run_ingest_items

    items, target = view(spark, SF_SMALL, "item_json").orderBy("id"), os.path.join(tmp_root, "raw")
    first, second = items.limit(20), items.orderBy(F.col("id").desc()).limit(20)
    added = [run_ingest_items(spark, x, target, "2024-01-01 06:00:00")["added"] for x in (first, second, first)]
    assert added == [20, 20, 0] and len(set(ids_of(spark, target))) == 40


def test_empty_batch(spark, tmp_root, rows):
    target = os.path.join(tmp_root, "raw")
    assert IO.append_listings(rows.limit(0), target, batch_key="none") == 0
    assert IO.append_listings(rows, target, batch_key="some") == 40 and len(ids_of(spark, target)) == 40


def test_row_numbers_follow_the_order(spark):
    data = [(i * 7 % 100 if i % 3 else None, i % 2) for i in range(1000)]
    df, _ = materialize(spark.createDataFrame(data, "a int, b int").repartition(7), "number_test")
    out, n = number_rows(df, ["a", "b"], "at")
    got = sorted(out.collect(), key=lambda r: r["at"])
    assert n == 1000 and [r["at"] for r in got] == list(range(1000))
    assert [(r["a"], r["b"]) for r in got] == sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert number_rows(df.limit(0), ["a"])[1] == 0


# -- published versions -----------------------------------------------------------
def test_a_failed_load_changes_nothing(spark, tmp_root):
    a, b = spark.range(5).toDF("x"), spark.range(7).toDF("x")
    V.publish(spark, tmp_root, {"a": a, "b": b})
    broken = b.withColumn("x", F.when(F.col("x") == 6, F.raise_error(F.lit("broken"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken"):
        V.publish(spark, tmp_root, {"a": a.limit(1), "b": broken})
    assert V.read_published(spark, tmp_root, "a").count() == 5 and V.read_published(spark, tmp_root, "b").count() == 7
    V.publish(spark, tmp_root, {"b": b.limit(2)})
    assert V.read_published(spark, tmp_root, "a").count() == 5 and V.read_published(spark, tmp_root, "b").count() == 2
    assert V.published(spark, tmp_root) == ["a", "b"]


def test_readers_keep_the_version_they_opened(spark, tmp_root):
    V.publish(spark, tmp_root, {"a": spark.range(5)})
    old = V.read_published(spark, tmp_root, "a")
    V.publish(spark, tmp_root, {"a": spark.range(3)})
    assert old.count() == 5 and V.read_published(spark, tmp_root, "a").count() == 3


def test_empty_tables_are_kept_where_asked(spark, tmp_root):
    V.publish(spark, tmp_root, {"a": spark.range(5), "b": spark.range(5)})
    assert V.publish(spark, tmp_root, {"a": spark.range(0), "b": spark.range(0)}, keep_if_empty=("a",)) == {"a": 0, "b": 0}
    assert V.read_published(spark, tmp_root, "a").count() == 5 and V.read_published(spark, tmp_root, "b").count() == 0


def test_two_loads_at_once_cannot_both_win(spark, tmp_root, monkeypatch):
    V.publish(spark, tmp_root, {"a": spark.range(5)})
    stale = V._entries(spark, tmp_root)
    V.publish(spark, tmp_root, {"a": spark.range(6)})
    monkeypatch.setattr(V, "_entries", lambda *_: stale)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        V.publish(spark, tmp_root, {"a": spark.range(7)})
    monkeypatch.undo()
    assert V.read_published(spark, tmp_root, "a").count() == 6


def test_reload_swaps_both_tables(spark, tmp_root):
    raw, matched = view(spark, SF_SMALL, "raw_listings"), view(spark, SF_SMALL, "matched_products")
    V.publish(spark, tmp_root, {"raw_listings": raw.limit(3), "matched_products": matched})
    bad = raw.withColumn("price", F.raise_error(F.lit("cut off")).cast("double"))
    with pytest.raises(Exception, match="cut off"):
        IO.reload_published(bad, tmp_root)
    assert V.read_published(spark, tmp_root, "matched_products").count() == matched.count()
    assert IO.reload_published(raw, tmp_root) == {"matched_products": 0, "raw_listings": raw.count()}
    assert V.read_published(spark, tmp_root, "matched_products").count() == 0
    assert IO.register_warehouse_views(spark, tmp_root) == ["raw_listings"]
    assert [f.name for f in V.read_published(spark, tmp_root, "raw_listings").schema] == [f.name for f in S.RAW_LISTING]
