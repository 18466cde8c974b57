"""End-to-end batch run and the incremental landing stream."""

import json
import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

from pricelens import schemas as S
from pricelens.fixture import view
from pricelens.plans.pipeline import PipelineConfig, run_pipeline
from pricelens.sources import listings as IO
from pricelens.streaming.landing import landing_stream


def test_run_pipeline_twice(spark, tmp_root):
    src = os.path.join(tmp_root, "raw")
    IO.replace_table(view(spark, SF_SMALL, "raw_listings"), src, S.RAW_LISTING)
    cfg = PipelineConfig(listings_path=src, out_root=os.path.join(tmp_root, "out"),
                         run_date="2024-01-02", run_ts="2024-01-02 06:00:00", max_pairs=20)
    s1 = run_pipeline(spark, cfg)
    assert s1["clean"]["output_rows"] > 0
    assert s1["clean"]["removed_duplicates"] == s1["clean"]["input_rows"] - s1["clean"]["dedup_rows"]
    assert s1["match"]["pairs_processed"] == 20
    assert s1["warehouse"]["fact_price_snapshot"] >= s1["warehouse"]["raw_listings"]
    checks = {(c["check_name"], c["table_name"]): c["failures"] for c in s1["checks"]}
    assert checks[("unique", "dim_source")] == 0
    first = spark.read.parquet(s1["match"]["matches_path"]).select("ebay_listing_id", "bestbuy_listing_id")
    first_pairs = {tuple(r) for r in first.collect()}
    assert len(first_pairs) == 20

    cfg2 = PipelineConfig(**{**cfg.__dict__, "run_ts": "2024-01-02 12:00:00"})
    s2 = run_pipeline(spark, cfg2)
    allp = spark.read.parquet(s2["match"]["matches_path"]).select("ebay_listing_id", "bestbuy_listing_id")
    pairs = [tuple(r) for r in allp.collect()]
    assert len(pairs) == 40 and len(set(pairs)) == 40   # stored verdicts are never re-scored


def test_landing_stream(spark, tmp_root):
    landing = os.path.join(tmp_root, "landing")
    os.makedirs(landing)
    rec = {"product_name": "TV", "price": 10.0, "source": "ebay", "scraped_at": "2024-01-01T00:00:00+00:00",
           "raw_payload": {"a": 1}}
    for i in range(3):
        with open(os.path.join(landing, f"f{i}.json"), "w") as f:
            json.dump([{**rec, "sku": str(i)}, {**rec, "sku": f"{i}b"}], f)
    target = os.path.join(tmp_root, "raw")
    ckpt = os.path.join(tmp_root, "ckpt")
    q = landing_stream(spark, landing, target, ckpt)
    q.awaitTermination(120)
    df = IO.read_listings(spark, path=target)
    assert df.count() == 6 and df.select("id").distinct().count() == 6
    assert df.filter(F.col("on_sale")).count() == 0
    # A second run with no new files adds nothing.
    landing_stream(spark, landing, target, ckpt).awaitTermination(120)
    assert IO.read_listings(spark, path=target).count() == 6
    # A replayed micro-batch rewrites its own folder instead of appending.
    from pricelens.streaming.landing import write_landing_batch
    batch = spark.read.schema(S.LISTING_JSON).option("multiLine", True).json(os.path.join(landing, "f0.json"))
    write_landing_batch(batch, target, 7)
    write_landing_batch(batch, target, 7)
    assert IO.read_listings(spark, path=target).count() == 8
    # Rows of a batch append lie beside the landed ones; all are read back.
    IO.append_listings(IO.read_listings(spark, path=target).drop("id").limit(3), target, id_offset=1)
    assert IO.read_listings(spark, path=target).count() == 11


def test_ingest_items_and_files(spark, tmp_root):
    from pricelens.plans.pipeline import run_ingest_files, run_ingest_items

    items = view(spark, SF_SMALL, "item_json").limit(50)
    target = os.path.join(tmp_root, "raw")
    out = run_ingest_items(spark, items, target, "2024-01-01 06:00:00", archive_root=os.path.join(tmp_root, "lake"),
                           sample_path=os.path.join(tmp_root, "sample"))
    assert spark.read.json(out["archived"]).count() == 50
    assert spark.read.json(os.path.join(tmp_root, "sample")).count() == 10
    p = os.path.join(tmp_root, "bb.json")
    with open(p, "w") as f:
        json.dump([{"product_name": "TV", "price": 10.0, "source": "bestbuy", "scraped_at": "2024-01-01T00:00:00+00:00"}], f)
    run_ingest_files(spark, [p, os.path.join(tmp_root, "missing.json")], target)
    df = IO.read_listings(spark, path=target)
    assert df.count() == 51 and df.select("id").distinct().count() == 51
    assert df.filter(F.col("source") == "ebay").select("scraped_at").distinct().count() == 1


def test_fallback_counters_are_those_of_the_committed_write(spark, tmp_root):
    from pricelens.plans.pipeline import PipelineConfig, run_clean

    blocked = os.path.join(tmp_root, "blocked")
    os.makedirs(blocked)
    with open(os.path.join(blocked, "processed"), "w") as f:  # a file where the folder should go
        f.write("x")
    raw = view(spark, SF_SMALL, "raw_listings")
    good = run_clean(spark, raw, PipelineConfig("", os.path.join(tmp_root, "good"), "2024-01-02", "2024-01-02 06:00:00"))
    fell = run_clean(spark, raw, PipelineConfig("", blocked, "2024-01-02", "2024-01-02 06:00:00", clean_fallback=os.path.join(tmp_root, "fb")))
    assert {k: v for k, v in fell.items() if k != "path"} == {k: v for k, v in good.items() if k != "path"} and fell["path"].startswith(os.path.join(tmp_root, "fb"))
