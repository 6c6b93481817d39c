"""Commits: a set of written folders becomes visible at once, and a run written again counts once.

Data goes to a folder of its own attempt. One small file (a manifest of one row for each folder) then names the folders of
a run; it appears whole or not at all, on file systems and object stores alike. Readers follow the manifests, so the folders of
an attempt that was killed are never read, and a run that is committed is not written again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "run_id string, at timestamp, name string, path string"


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """``(run_id, at, name, path)`` of every committed folder; no rows where nothing was committed."""
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{root}/manifests")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def folders(spark: SparkSession, root: str, run_id: str | None = None) -> dict[str, str]:
    """The folders of a run by name, or of the latest run (time, then id); none if there is no such run."""
    found = manifests(spark, root)
    if run_id is None:
        last = found.agg(F.max(F.struct("at", "run_id")).alias("m")).first()["m"]
        run_id = last and last["run_id"]
    rows = found.filter(F.col("run_id") == run_id).select("name", "path", "at").collect() if run_id is not None else []
    return {r["name"]: r["path"] for r in sorted(rows, key=lambda r: r["at"], reverse=True)}


def commit(spark: SparkSession, root: str, run_id: str, paths: Mapping[str, str]) -> None:
    """Make the folders of a run visible: one file, put in place when it is whole."""
    rows = spark.createDataFrame([(run_id, name, path) for name, path in paths.items()], "run_id string, name string, path string")
    named = rows.select("run_id", F.current_timestamp().alias("at"), "name", "path").coalesce(1)
    named.write.mode("overwrite").json(f"{root}/manifests/{run_id}")


def write_run(spark: SparkSession, root: str, run_id: str, tables: Mapping[str, Callable[[str], None]]) -> dict[str, str]:
    """Write the tables of a run and commit them together; ``tables`` writes each to the path it is given.

    A run that is already committed is left as it is, so a job may be repeated after any failure.
    """
    if found := folders(spark, root, run_id):
        return found
    attempt = f"{root}/data/{run_id}/{uuid.uuid4().hex}"
    paths = {name: f"{attempt}/{name}" for name in tables}
    for name, write in tables.items():
        write(paths[name])
    commit(spark, root, run_id, paths)
    return paths
