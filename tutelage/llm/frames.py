"""What the operators of this folder share: reading, batches, written tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.session import materialise

__all__ = ["batched", "free", "lean", "materialise", "slices", "table", "utf8"]

#: Bytes of a batch that become Python objects, and results, at a time.
SLICE_BYTES = 1 << 21
#: For sessions over long texts: by default a batch may have 64 MB on its way to Python and 4,096 rows from Parquet, for each task.
LEAN = {"spark.sql.execution.arrow.maxBytesPerBatch": str(SLICE_BYTES), "spark.sql.parquet.columnarReaderBatchSize": "512"}


def lean(spark: SparkSession) -> None:
    """Bounds the batches that the session's tasks hold, unless the session sets them itself. Results do not depend on batches."""
    for name in LEAN.keys() - spark.conf.getAll.keys():
        spark.conf.set(name, LEAN[name])


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def free(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores behind it until no column is called so in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(name: str) -> Column:
    """A text as its UTF-8 bytes, null as none: Python tasks then need no decoding."""
    return F.coalesce(F.col(name).cast("string").cast("binary"), F.lit(b""))


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``SLICE_BYTES``: Spark's batches of 10,000 texts take tens of MB, and as much again as objects and as results."""
    step = max(1, math.ceil(batch.num_rows / max(1, math.ceil(batch.nbytes / SLICE_BYTES))))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def batched(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``fn``, which must treat each row by itself, over slices of each Arrow batch: they bound what a task holds besides the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = fn(part)
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out

    return df.mapInArrow(run, schema)
