"""Windowed indicators of served requests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tutelage.sources import commits

#: Size of a latency sketch: exact up to so many values, then with a rank error of ``rank_error(SKETCH_K)``.
SKETCH_K = 4096


def kpis(scored: DataFrame, window: str = "1 hour", keys: Sequence[str] = ("prediction",), ts_col: str = "ts",
         margin_col: str = "top2_margin", latency_col: str = "latency_ms", accuracy: int = 10_000) -> DataFrame:
    """Count, mean margin and latency percentiles per tumbling window and key, for batch or stream.

    Latencies go through a mergeable sketch: its rank error is 1 / ``accuracy`` and its size fixed.
    """
    agg = scored.groupBy(F.window(ts_col, window).alias("w"), *keys).agg(
        F.count("*").alias("n"), F.avg(margin_col).alias("mean_margin"),
        F.percentile_approx(latency_col, F.lit(0.5), F.lit(accuracy)).alias("latency_p50"),
        F.percentile_approx(latency_col, F.lit(0.95), F.lit(accuracy)).alias("latency_p95"))
    return agg.select(F.col("w.start").alias("window_start"), *keys, "n", "mean_margin", "latency_p50", "latency_p95")


def kpi_stream(scored: DataFrame, watermark: str = "10 minutes", ts_col: str = "ts", **kw) -> DataFrame:
    """``kpis`` as streaming state: closed windows leave it, and rows later than the watermark are let go.

    Only for sources that keep to the watermark; ``late_rows`` says how many rows did not. ``write_partials`` loses none.
    """
    return kpis(scored.withWatermark(ts_col, watermark), ts_col=ts_col, **kw)


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query's state has let go, over the progress it still remembers."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def write_kpis(kpi: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write what each micro-batch changed to its own ``batch_id`` partition; a batch run again replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (kpi.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def latest_kpis(spark: SparkSession, out: str, keys: Sequence[str] = ("prediction",)) -> DataFrame:
    """The latest state of every window and key that ``write_kpis`` wrote."""
    rows = spark.read.parquet(out)
    values = [c for c in rows.columns if c not in ("window_start", "batch_id", *keys)]
    latest = rows.groupBy("window_start", *keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
    return latest.select("window_start", *keys, "v.*")


def partials(scored: DataFrame, window: str = "1 hour", keys: Sequence[str] = ("prediction",), ts_col: str = "ts", margin_col: str = "top2_margin",
             latency_col: str = "latency_ms", k: int = SKETCH_K) -> DataFrame:
    """What can be merged over micro-batches: per window and key the rows, the margins and their sum, and a quantile sketch of the latencies.

    One row for each window and key, whatever the batch holds. Up to ``k`` latencies the sketch is exact; beyond, its rank
    error is about ``rank_error(k)`` and its size a few times ``k``.
    """
    rows = scored.select(F.window(ts_col, window)["start"].alias("window_start"), *keys, F.col(latency_col).cast("double").alias("latency"), F.col(margin_col).cast("double").alias("margin"))
    return rows.groupBy("window_start", *keys).agg(F.count("*").alias("n"), F.count("margin").alias("margins"), F.sum("margin").alias("margin"),
                                                   F.count("latency").alias("latencies"), F.kll_sketch_agg_double("latency", k).alias("sketch"))


def rank_error(k: int = SKETCH_K) -> float:
    """The normalised rank error that a sketch of ``k`` keeps with a probability of 99 %."""
    return 2.296 / k ** 0.9021


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``partials`` of the same window and key as one row."""
    sums = [F.sum(c).alias(c) for c in ("n", "margins", "margin", "latencies")]
    return parts.groupBy("window_start", *keys).agg(*sums, F.kll_merge_agg_double("sketch").alias("sketch"))


def write_partials(scored: DataFrame, out: str, checkpoint: str, trigger: dict | None = None, **kw) -> StreamingQuery:
    """Write each micro-batch's ``partials`` to its own ``batch_id`` partition; a batch run again replaces itself.

    There is neither state nor watermark, so a row counts in its window however late it comes.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        partials(batch, **kw).write.mode("overwrite").parquet(f"{out}/open/batch_id={batch_id}")

    return (scored.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _batches(spark: SparkSession, out: str) -> list[int]:
    """The micro-batches that lie open: as many as came since the last compactions."""
    fs, path = _store(spark, f"{out}/open")
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def _store(spark: SparkSession, path: str):
    """The Hadoop file system of a path, whatever its scheme, and the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _compacted(spark: SparkSession, out: str) -> list[tuple[int, str]]:
    """The last batch and the folder of every committed compaction that still lies there, the latest last."""
    rows = commits.manifests(spark, f"{out}/compacted").collect()
    return sorted((int(r["run_id"]), r["path"]) for r in rows)


def compact_partials(spark: SparkSession, out: str, keys: Sequence[str] = ("prediction",), upto: int | None = None) -> int | None:
    """Merge the partials of all micro-batches up to ``upto`` (all but the last, which a restart may write again) into one row per window and key.

    The new table is committed before anything is removed, and what the compaction before it had merged is removed only
    now, so that a reader that has started keeps its files. Gives the last batch merged, None if there was nothing to do.
    """
    past, batches = _compacted(spark, out), _batches(spark, out)
    done = past[-1][0] if past else -1
    upto = (batches[-1] - 1 if batches else -1) if upto is None else upto
    new = [b for b in batches if done < b <= upto]
    if not new:
        return None
    parts = spark.read.parquet(*[f"{out}/open/batch_id={b}" for b in new])
    if past:
        parts = parts.unionByName(spark.read.parquet(past[-1][1]))
    commits.write_run(spark, f"{out}/compacted", f"{new[-1]:012d}", {"merged": lambda path: merged(parts, keys).write.parquet(path)})
    for b in batches:
        if b <= done:
            _remove(spark, f"{out}/open/batch_id={b}")
    for last, path in past[:-1]:
        _remove(spark, path)
        _remove(spark, f"{out}/compacted/manifests/{last:012d}")
    return new[-1]


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _store(spark, path)
    fs.delete(p, True)


def open_partials(spark: SparkSession, out: str) -> DataFrame:
    """The last compaction and the micro-batches since: all that a read opens."""
    past = _compacted(spark, out)[-1:]
    since = [b for b in _batches(spark, out) if not past or b > past[0][0]]
    return spark.read.parquet(*[path for _, path in past], *[f"{out}/open/batch_id={b}" for b in since])


def current_from(parts: DataFrame, keys: Sequence[str] = ("prediction",)) -> DataFrame:
    """The indicators over ``partials``; percentiles are those of the merged sketches."""
    at = lambda share: F.when(F.col("latencies") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share)))
    return merged(parts, keys).select("window_start", *keys, "n", F.try_divide("margin", "margins").alias("mean_margin"), at(0.5).alias("latency_p50"), at(0.95).alias("latency_p95"))


def current_kpis(spark: SparkSession, out: str, keys: Sequence[str] = ("prediction",), since: datetime | None = None) -> DataFrame:
    """The indicators over all ``partials`` written so far, of windows from ``since`` on."""
    parts = open_partials(spark, out)
    return current_from(parts if since is None else parts.filter(F.col("window_start") >= F.lit(since)), keys)
