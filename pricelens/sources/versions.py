"""Tables that are replaced together, or not at all.

Every load writes its tables into folders of their own,

    <root>/_versions/<table>/v=<load>         whole tables, never changed afterwards
    <root>/_manifest/version=<n>/             one small file: which folder each table is in

and the manifest last. Readers resolve a table through the manifest with the
largest number, so they see the tables of one finished load: a load that
fails half-way has no manifest and changes nothing, and several tables swap in
one step. A manifest names every table of the root, those of earlier loads
included. Two loads at the same time take the same number; the second to
write its manifest fails.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version int, name string, path string, rows long"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path can be read: asked of the reader, not of a file system."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows (version, name, path, rows) of the last finished load; None before the first."""
    folder = f"{root.rstrip('/')}/_manifest"
    if not path_exists(spark, folder):
        return None
    # One file of a few rows per load.
    every = spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(folder)
    last = every.agg(F.max("version")).first()[0]
    return None if last is None else every.where(F.col("version") == last)


def _entries(spark: SparkSession, root: str) -> dict[str, tuple[int, str, int]]:
    rows = manifest(spark, root)
    return {} if rows is None else {r["name"]: (r["version"], r["path"], r["rows"]) for r in rows.toLocalIterator()}  # one row per table


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], keep_if_empty: tuple[str, ...] = ()) -> dict[str, int]:
    """Write all `tables`, then make them the tables of `root` in one step.

    Tables named in `keep_if_empty` keep their last version where the new one
    has no row. Returns the rows written per table (0 for a kept one).
    """
    root, load = root.rstrip("/"), uuid.uuid4().hex
    entries = _entries(spark, root)
    version = max((v for v, _, _ in entries.values()), default=0) + 1
    now = {name: (path, rows) for name, (_, path, rows) in entries.items()}
    written = {}
    for name, df in tables.items():
        path, obs = f"_versions/{name}/v={load}", Observation(f"publish_{name}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(f"{root}/{path}")
        written[name] = int(obs.get["rows"])
        if written[name] or name not in keep_if_empty:
            now[name] = (path, written[name])
    rows = [(version, name, path, n) for name, (path, n) in sorted(now.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{root}/_manifest/version={version}")
    return written


def resolve(spark: SparkSession, root: str, name: str) -> str | None:
    """The folder that holds the table now."""
    entry = _entries(spark, root).get(name)
    return None if entry is None else f"{root.rstrip('/')}/{entry[1]}"


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    path = resolve(spark, root, name)
    if path is None:
        raise ValueError(f"{root} has no table {name}")
    return spark.read.parquet(path)


def published(spark: SparkSession, root: str) -> list[str]:
    return sorted(_entries(spark, root))
