"""End-to-end batch jobs: clean, match, stage, star, checks.

Each stage reads tables and writes tables (shared storage), so a lost
executor only re-runs tasks of the current stage and no stage depends on the
lineage of another. Counters come from observations of the writes.
"""

from __future__ import annotations

import argparse
import json
import logging
from datetime import datetime, timezone
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import constants as C
from pricelens import schemas as S
from pricelens.operators import clean as CL
from pricelens.operators import match as M
from pricelens.operators import quality as Q
from pricelens.operators import verdicts as V
from pricelens.operators import warehouse as W
from pricelens.sources import listings as IO
from pricelens.sources.batches import fingerprint
from pricelens.sources.versions import path_exists, publish, read_published

log = logging.getLogger(__name__)


def utc_run_date(now: datetime | None = None) -> str:
    """The run's UTC date as YYYY-MM-DD (the clean output partition)."""
    return (now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%d")


@dataclass
class PipelineConfig:
    listings_path: str                 # raw listing table (Parquet)
    out_root: str                      # shared storage root for every output
    run_date: str                      # UTC date of the run, e.g. "2024-01-02"
    run_ts: str                        # stamp for verdicts, e.g. "2024-01-02 06:00:00"
    matches_path: str | None = None    # stored verdicts (Parquet); created on first run
    max_pairs: int | None = None       # scoring budget of one run; None scores every candidate
    scorer: Callable[[dict], str] | None = None   # pair -> verdict JSON; None = rule scorer
    clean_fallback: str | None = None
    calls_per_second: float | None = None         # budget of a caller's scorer, over all tasks
    rate_limit_waits: tuple[float, ...] = (15, 30, 45)   # seconds before the round after a rate-limited one


def run_ingest_items(spark: SparkSession, items: DataFrame, listings_target: str, ingest_ts: str,
                     archive_root: str | None = None, sample_path: str | None = None,
                     item_col: str = "item", category_col: str = "category") -> dict:
    """Marketplace ingest: keep the raw items, parse them into listings,
    append them stamped with the batch time (all or nothing; the same items
    of the same time again add nothing), and optionally write the first 10 parsed
    rows as a JSON sample."""
    from pricelens.operators.parse import parse_items

    archived = IO.archive_raw(items.select(item_col, category_col), archive_root, C.SOURCE_MARKETPLACE,
                              ingest_ts.replace(" ", "T"))
    parsed = parse_items(items, item_col=item_col, category_col=category_col, scraped_at=ingest_ts, keep=())
    added = IO.append_listings(parsed, listings_target, batch_key=f"items:{ingest_ts}:{fingerprint(parsed)}")
    if sample_path:
        IO.write_sample_json(parsed, sample_path, 10, order="sku")
    return {"archived": archived, "listings_target": listings_target, "added": added}


def run_ingest_files(spark: SparkSession, paths: list[str], listings_target: str,
                     batch_ts: str | None = None) -> dict:
    """Listing JSON files (missing ones skipped) appended to the table."""
    df = IO.read_listing_json(spark, paths)
    added = IO.append_listings(df, listings_target, batch_ts=batch_ts, batch_key=f"files:{batch_ts}:{fingerprint(df)}")
    return {"listings_target": listings_target, "added": added}


def run_clean(spark: SparkSession, raw: DataFrame, cfg: PipelineConfig) -> dict:
    """Clean job: one write action; counters observed on the way. The fallback
    write gets observations of its own: those of a failed attempt are partial."""
    def attempt(root: str):
        out, observed = CL.clean_listings_observed(raw)
        return IO.write_clean(out, root, cfg.run_date), observed

    try:
        path, (o_in, o_dd, o_out) = attempt(f"{cfg.out_root}/processed/clean")
    except Exception:
        if cfg.clean_fallback is None:
            raise
        log.exception("clean write failed, writing to fallback %s", cfg.clean_fallback)
        path, (o_in, o_dd, o_out) = attempt(cfg.clean_fallback)
    return {"path": path, "input_rows": o_in.get["input_rows"], "dedup_rows": o_dd.get["dedup_rows"],
            "removed_duplicates": o_in.get["input_rows"] - o_dd.get["dedup_rows"],
            "output_rows": o_out.get["output_rows"]}


def match_verdicts(pairs: DataFrame, scorer: Callable[[dict], str] | None, calls_per_second: float | None = None,
                   waits: tuple[float, ...] = (15, 30, 45)) -> DataFrame:
    """Verdict JSON per pair, with attempts and outcome: caller's scorer on the
    executors in rounds of calls, else the native rule scorer."""
    if scorer is None:
        ruled = V.verdict_json(V.rule_verdicts(pairs)).select(*pairs.columns, "verdict")
        return ruled.select("*", F.lit(1).alias("attempts"), F.lit("valid").alias("outcome"), F.lit(None).cast("string").alias("message"))
    return V.score_rounds(pairs, scorer, calls_per_second=calls_per_second, waits=waits)


def run_matcher(spark: SparkSession, raw: DataFrame, cfg: PipelineConfig) -> dict:
    """Candidates -> pairs (capped only by `max_pairs`) -> verdicts -> validated rows appended.

    Both verdicts (match / no match) are stored and block re-scoring; pairs
    without a valid verdict count as processed but are not stored, so they
    are tried again next run.
    """
    target = cfg.matches_path or f"{cfg.out_root}/matched_products"
    existing = spark.read.schema(S.MATCHED_PRODUCT).parquet(target) if path_exists(spark, target) else None
    pairs = M.to_pairs(M.candidates(raw, existing, max_pairs=cfg.max_pairs))
    # The scorer may be costly: write the pairs once so retries never re-run
    # the candidate search.
    pairs_path = f"{cfg.out_root}/match_runs/run_ts={cfg.run_ts.replace(' ', 'T')}/pairs"
    pairs.write.mode("overwrite").parquet(pairs_path)
    pairs = spark.read.parquet(pairs_path)
    scored = match_verdicts(pairs, cfg.scorer, cfg.calls_per_second, cfg.rate_limit_waits)
    verdict_path = pairs_path.rsplit("/", 1)[0] + "/verdicts"
    scored.write.mode("overwrite").parquet(verdict_path)
    scored = spark.read.parquet(verdict_path)
    # Pairs without a verdict are kept with the reason; they are tried again next run.
    V.dead_letters(scored).write.mode("overwrite").parquet(pairs_path.rsplit("/", 1)[0] + "/dead_letters")

    valid, _ = V.validate_verdicts(scored)
    IO.append_matches(valid, target, cfg.run_ts)
    stats = V.run_stats(V.verdict_outcomes(scored)).first().asDict()
    return {"matches_path": target, **stats}


def run_warehouse(spark: SparkSession, raw: DataFrame, matches: DataFrame | None, cfg: PipelineConfig) -> dict:
    """Staging copies, their views, then the star, each published as one version."""
    root = f"{cfg.out_root}/warehouse"
    staged = {"raw_listings": IO.stage_listings(raw)}
    if matches is not None:
        staged["raw_matched_products"] = IO.stage_matched(matches)
    # Staging copies first: an empty feed leaves its last version in place.
    counts = publish(spark, root, staged, keep_if_empty=tuple(staged))
    current = lambda name: read_published(spark, root, name)
    loads = {"stg_listings": W.stg_listings(current("raw_listings"))}
    if matches is not None:
        loads["stg_matched"] = W.stg_matched(current("raw_matched_products"))
    counts |= publish(spark, root, loads, keep_if_empty=tuple(loads))
    stg = current("stg_listings")
    # The dims come from this stg, so the fact needs no join against them
    # (see `fact_from_staging`): the listings are not shuffled. Dims and fact swap
    # in one step: no reader sees a fact beside dims of another load.
    return counts | publish(spark, root, {
        "dim_product": W.dim_product(stg), "dim_source": W.dim_source(stg), "dim_time": W.dim_time(stg),
        "dim_category": W.dim_category(stg), "fact_price_snapshot": W.fact_from_staging(stg)})


def run_checks(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    root = f"{cfg.out_root}/warehouse"
    t = {n: read_published(spark, root, n) for n in
         ("dim_product", "dim_source", "dim_time", "dim_category", "fact_price_snapshot")}
    return Q.union_checks(
        Q.check_unique(t["dim_product"], "product_key", "dim_product"),
        Q.check_unique(t["dim_source"], "source_key", "dim_source"),
        Q.check_unique(t["dim_time"], "time_key", "dim_time"),
        Q.check_unique(t["dim_category"], "category_key", "dim_category"),
        Q.check_not_null(t["dim_product"], ["product_key"], "dim_product"),
        Q.check_not_null(t["dim_source"], ["source_key"], "dim_source"),
        Q.check_not_null(t["dim_time"], ["time_key"], "dim_time"),
        Q.check_not_null(t["dim_category"], ["category_key"], "dim_category"),
        Q.check_not_null(t["fact_price_snapshot"], ["snapshot_id", "product_key"], "fact_price_snapshot"),
    )


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """clean -> match -> stage + star -> checks (stage order of the batch)."""
    raw = IO.read_listings(spark, path=cfg.listings_path)
    if raw.isEmpty():
        log.warning("no listings, nothing to process")
        return {"skipped": True}
    summary = {"clean": run_clean(spark, raw, cfg)}
    summary["match"] = run_matcher(spark, raw, cfg)
    matches = spark.read.schema(S.MATCHED_PRODUCT).parquet(summary["match"]["matches_path"])
    summary["warehouse"] = run_warehouse(spark, raw, matches, cfg)
    checks = run_checks(spark, cfg)
    checks.write.mode("overwrite").parquet(f"{cfg.out_root}/quality/run_date={cfg.run_date}")
    summary["checks"] = [r.asDict() for r in spark.read.parquet(
        f"{cfg.out_root}/quality/run_date={cfg.run_date}").collect()]  # a dozen rows
    return summary


def main(argv: list[str] | None = None) -> None:
    """Command line: run the batch against a listing table."""
    ap = argparse.ArgumentParser(description="Run clean -> match -> star -> checks.")
    ap.add_argument("--listings", required=True, help="listing table (Parquet)")
    ap.add_argument("--out", required=True, help="shared output root")
    ap.add_argument("--run-date", default=None)
    ap.add_argument("--run-ts", default=None)
    ap.add_argument("--max-pairs", type=int, default=None)
    a = ap.parse_args(argv)
    now = datetime.now(timezone.utc)
    spark = SparkSession.builder.appName("pricelens").getOrCreate()
    cfg = PipelineConfig(listings_path=a.listings, out_root=a.out, run_date=a.run_date or utc_run_date(now),
                         run_ts=a.run_ts or now.strftime("%Y-%m-%d %H:%M:%S"), max_pairs=a.max_pairs)
    print(json.dumps(run_pipeline(spark, cfg), default=str))


if __name__ == "__main__":
    main()
