"""Published versions of tables and models.

A run writes aside, below ``versions/<run>``; nothing reads there until one
small manifest file names it. Manifests are written by Spark, so a reader sees
a whole one or none, on any file system; a run that dies before leaves the last
published version in place and is never read.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packflow.sources.sinks import write_results

MANIFEST = "run string, published timestamp, item string, path string, rows long"


def new_run(root: str) -> tuple[str, str]:
    """A run's name and the folder it writes to."""
    run = uuid.uuid4().hex
    return run, f"{root.rstrip('/')}/versions/{run}"


def publish(spark: SparkSession, root: str, run: str, items: list[tuple[str, str, int]]) -> None:
    """Make a run's (item, path, rows) the current version: one manifest file."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(run, now, item, path, n) for item, path, n in items]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/manifests")


def published(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows of all manifests under ``root``; null where there is none."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifests")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current(spark: SparkSession, root: str) -> dict[str, str]:
    """Item -> path of the version that was published last; empty without one.
    Only one version's items are collected."""
    rows = published(spark, root)
    if rows is None:
        return {}
    last = rows.agg(F.max(F.struct("published", "run")).alias("m")).select("m.run")
    return {r["item"]: r["path"] for r in rows.join(F.broadcast(last), "run").select("item", "path").collect()}


def export_results(spark: SparkSession, root: str, tables: dict[str, DataFrame | None]) -> DataFrame:
    """Write all tables aside, then publish them together. Returns (table,
    rows, path). An error before the last step leaves the old version current."""
    run, folder = new_run(root)
    done = write_results(spark, folder, tables)
    publish(spark, root, run, [(r["table"], r["path"], r["rows"]) for r in done.collect()])
    return done


def read_current(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """Tables of the current version by name; a name it lacks is an error."""
    paths = current(spark, root)
    missing = [n for n in names if n not in paths]
    if missing:
        raise ValueError(f"not in the current version of {root}: {', '.join(missing)}")
    return {n: spark.read.parquet(paths[n]) for n in names}


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the run folders below ``root`` that are not among the last
    ``keep`` published ones (unfinished runs too); returns their names. Call it
    when no other run is writing."""
    rows = published(spark, root)
    last = set() if rows is None else {r["run"] for r in rows.groupBy("run").agg(
        F.max("published").alias("at")).orderBy(F.desc("at")).limit(keep).collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/versions")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    gone = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in last]
    for p in gone:
        fs.delete(p, True)
    return sorted(p.getName() for p in gone)
