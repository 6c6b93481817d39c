"""Writers: training sets and results as JSON lines (UTF-8), run metrics as a partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.sources import commits
from tutelage.sources.readers import READERS

RUN_METRICS = "kind string, key string, value string, run_id string"


def write_distill_sets(sets: dict[str, DataFrame], outdir: str, name: str = "", mode: str = "errorifexists",
                       keep_id: bool = False) -> dict[str, str]:
    """Write ``build_sets``'s sft, kd and dpo rows to ``outdir/[name_]{sft,kd,dpo}.jsonl`` folders."""
    paths = {}
    for method, df in sets.items():
        paths[method] = f"{outdir}/{name + '_' if name else ''}{method}.jsonl"
        (df if keep_id else df.drop("id")).write.mode(mode).json(paths[method])
    return paths


def commit_distill_sets(sets: dict[str, DataFrame], root: str, run_id: str, keep_id: bool = False) -> dict[str, str]:
    """``write_distill_sets`` as one commit: all sets of a run are visible together, and a repeated run is written once."""
    spark = next(iter(sets.values())).sparkSession
    writers = {method: (df if keep_id else df.drop("id")).write.json for method, df in sets.items()}
    return commits.write_run(spark, root, run_id, writers)


def read_distill_sets(spark: SparkSession, root: str, run_id: str | None = None) -> dict[str, DataFrame]:
    """The committed sets of a run, or of the latest one."""
    found = commits.folders(spark, root, run_id)
    if not found:
        raise FileNotFoundError(f"no committed run {run_id or ''} in {root}")
    return {method: READERS[method](spark, path) for method, path in found.items()}


def results_path(model_dir: str, training_type: str) -> str:
    return f"{model_dir}/{training_type}_eval_results.jsonl"


def write_results(df: DataFrame, model_dir: str, training_type: str, mode: str = "errorifexists", compression: str | None = None) -> str:
    """Per-example evaluation results, next to the model unless told otherwise; ``compression`` (say, ``gzip``) is that of the files, which readers know by their names."""
    path = results_path(model_dir, training_type)
    df.write.mode(mode).json(path, compression=compression)
    return path


def log_run(rows: DataFrame, run_id: str, table: str, kind: str = "metric", part: str = "all") -> None:
    """Put ``(key, value)`` rows of a run into the ``run_metrics`` table, partitioned by run, kind and part.

    The rows of a part replace themselves, so logging a run again, after a failure or by mistake, counts once; a run that
    logs the same kind at several times gives each time its ``part``.
    """
    out = rows.select(F.col("key").cast("string"), F.col("value").cast("string"), F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"), F.lit(part).alias("part"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "kind", "part").parquet(table)


def read_runs(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(f"{RUN_METRICS}, part string").parquet(table).drop("part")
