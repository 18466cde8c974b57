"""Session helpers: sane defaults for local runs and a shared scratch location.

Library functions never create a session or hard-code a master; they take the
caller's session. `local_session()` is for tests, the bench and the CLI only.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators rely on for correct and scalable plans.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pricelens", extra: dict | None = None) -> SparkSession:
    """Build a local session (tests / bench). The UI stays off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PRICELENS_DRIVER_MEMORY", "16g"))
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster `spark.checkpoint.dir` points to shared storage and is used
    as it is. Only a local master (tests, one machine) gets a folder of our
    own when nothing is set; any other master without the setting is an error,
    because executors could not read each other's files.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: only the session conf is reachable
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = f"/tmp/checkpoints/pricelens-{uuid.uuid4().hex[:12]}"
    if sc is not None:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    spark.conf.set("spark.checkpoint.dir", conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/pricelens/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it, shuffle files of a written table go with its write, instead of when the
    driver next collects its garbage. For long chains of written tables."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df, name: str):
    """Write `df` once as a table under the shared checkpoint folder and read
    it back: cuts the lineage (a lost executor re-reads the files instead of
    recomputing) and returns the row count observed during the write, so a
    size check costs no extra job. Returns (DataFrame, rows)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"materialize_{name}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), int(obs.get["rows"])
