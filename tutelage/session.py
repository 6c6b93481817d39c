"""Session defaults and the shared folder that written tables and stream state go to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "tutelage", memory: str = "12g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    n = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="tutelage-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing there is ever overwritten."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives executor loss."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
