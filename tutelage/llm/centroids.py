"""Exact Lloyd clustering with ns-bounds: bounds loosened by the norm of a centroid's total displacement.

Every vector keeps the distance to its own centroid (upper bound) and to each other one (lower bounds) as they were
when last evaluated, with the round of that evaluation. The history of all centroids is retained, so a bound of round t is loosened
in round r by the distance between the centroid of round t and that of round r: the norm of the sum of its moves, which is never more than the
sum of their norms. Only pairs whose bounds then fail are evaluated again, on integers and so exactly; a bound decides nothing
that it does not prove. The result is that of a full search.

Each round is one pass over the written state without a shuffle; only sums by cluster (one row of each task and cluster) are
aggregated, and ``k`` rows reach the driver. What is broadcast is the history: rounds x k x dimension numbers, whatever the input.

Defined cases: vectors that are null, of another length, or hold null or non-finite components are left out; repeated rows are vectors each;
ties go to the smaller cluster number, ties in the choice of the first centroids to the smaller components; with fewer than ``k``
vectors there are as many clusters; an empty table gives an empty result; a null id keeps its row and reads as the empty text in the first choice; other columns are left out. A component
over 2**21 in size raises, as its distances would not fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutelage.llm.frames import batched, materialise

#: Components are multiples of 1 / ``SCALE``, rounded down.
SCALE, DIM = 64, 64
#: Largest size of a component: twice 2**27, squared and summed over 64 components, is below 2**62.
MOST = 1 << 21
#: Relative slack of a bound, well over the rounding of a square root and a sum.
SLACK = 1e-9
STATE = "vec_id bigint, x array<int>, cluster int, upper double, upper_at int, lower binary, lower_at binary, distance bigint"


def lattice(df: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``(vec_id, x)``: the usable vectors with their components as integers floor(``scale`` * component)."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    known = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("v")).filter(
        (F.size("v") == dim) & F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    whole = F.transform("v", lambda v: F.when(F.abs(v) <= MOST, F.floor(v * scale).cast("int")).otherwise(F.raise_error(F.lit("component too large: distances do not fit 64 bits")).cast("int")))
    return known.select("vec_id", whole.alias("x"))


def first_centroids(vectors: DataFrame, k: int = 16) -> np.ndarray:
    """The ``k`` vectors of smallest SHA-256 of ``1:<vec_id>``."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(key, "x").limit(k).select("x").collect()
    return np.array([r["x"] for r in rows], np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to rows, in whole numbers."""
    return ((x - c) ** 2).sum(axis=-1)


def rounded_down(x: np.ndarray) -> np.ndarray:
    """As 32-bit floats that are not larger: what a lower bound may be stored as."""
    out = x.astype(np.float32)
    return np.where(out > x, np.nextafter(out, np.float32(-np.inf)), out).astype(np.float32)


def full_search(x: np.ndarray, c: np.ndarray, now: int) -> tuple[np.ndarray, ...]:
    """Cluster, bounds and their rounds from all distances."""
    d = np.stack([squared(x, row) for row in c], axis=1)
    cluster = d.argmin(axis=1)
    own = d[np.arange(len(x)), cluster]
    at = np.full(d.shape, now, np.int16)
    return cluster, np.sqrt(own), np.full(len(x), now), rounded_down(np.sqrt(d)), at, own


def search(x: np.ndarray, history: np.ndarray, cluster: np.ndarray, upper: np.ndarray, upper_at: np.ndarray, lower: np.ndarray, lower_at: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same for the last of ``history``, evaluating only what the loosened bounds leave open; with how many distances that were."""
    now, k = len(history) - 1, history.shape[1]
    moved = np.sqrt(squared(history, history[-1]))  # by round and cluster: the norm of the whole move since
    rows, lower, lower_at = np.arange(len(x)), lower.copy(), lower_at.copy()
    high = upper + moved[upper_at, cluster]
    low = lower - moved[lower_at, np.arange(k)]
    low[rows, cluster] = np.inf
    open_rows = np.flatnonzero((low <= (high * (1 + SLACK) + SLACK)[:, None]).any(axis=1))
    d = squared(x[open_rows], history[-1][cluster[open_rows]])  # first tighten the upper bound
    upper, upper_at, best = upper.copy(), upper_at.copy(), cluster.copy()
    upper[open_rows], upper_at[open_rows] = np.sqrt(d), now
    lower[open_rows, cluster[open_rows]], lower_at[open_rows, cluster[open_rows]] = rounded_down(np.sqrt(d)), now
    failed = low[open_rows] <= (upper[open_rows] * (1 + SLACK) + SLACK)[:, None]
    r, j = np.nonzero(failed)
    least = d.copy()
    whole = np.full(failed.shape, np.iinfo(np.int64).max)
    evaluated = len(open_rows) + len(r)
    for at in range(0, len(r), 1 << 16):
        part = slice(at, at + (1 << 16))
        whole[r[part], j[part]] = squared(x[open_rows[r[part]]], history[-1][j[part]])
    lower[open_rows[r], j], lower_at[open_rows[r], j] = rounded_down(np.sqrt(whole[r, j])), now
    whole[np.arange(len(open_rows)), cluster[open_rows]] = d
    if len(open_rows):
        best[open_rows] = whole.argmin(axis=1)  # the first of equals
        least = whole.min(axis=1)
    upper[open_rows] = np.sqrt(least)
    return best, upper, upper_at, lower, lower_at, evaluated


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _state(batch: pa.RecordBatch, cluster, upper, upper_at, lower, lower_at, distance) -> pa.RecordBatch:
    blob = lambda m: pa.array([row.tobytes() for row in m], pa.binary())
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("x"), pa.array(cluster.astype(np.int32)), pa.array(upper), pa.array(upper_at.astype(np.int32)), blob(lower), blob(lower_at.astype(np.int16)),
         pa.array(distance, pa.int64())], names=["vec_id", "x", "cluster", "upper", "upper_at", "lower", "lower_at", "distance"])


def assign(state: DataFrame, history: np.ndarray, dim: int, last: bool = False) -> DataFrame:
    """The state of a round: ``state`` is ``(vec_id, x)`` in the first round, else that of the round before. ``distance`` (squared) is exact, and set in the last round only."""
    k, first = history.shape[1], "cluster" not in state.columns

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            x = _rows(part, dim)
            if first:
                cluster, upper, upper_at, lower, lower_at, _ = full_search(x, history[-1], len(history) - 1)
            else:
                old = [part.column(c).to_numpy() for c in ("cluster", "upper", "upper_at")]
                cluster, upper, upper_at, lower, lower_at, _ = search(x, history, *old, _matrix(part.column("lower"), np.float32, k), _matrix(part.column("lower_at"), np.int16, k))
            distance = squared(x, history[-1][cluster]) if last else [None] * len(x)
            yield _state(part, cluster, upper, upper_at, lower, lower_at, distance)

    return batched(state, run, STATE)


def moved_centroids(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """The componentwise floor of each cluster's mean; an empty cluster's centroid stays."""
    dim = before.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(before), np.int64), np.zeros(before.shape, np.int64)
        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            n += np.bincount(cluster, minlength=len(before))
            np.add.at(sums, cluster, _rows(batch, dim))
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(n[own]), pa.array(list(sums[own]), pa.list_(pa.int64()))], names=["cluster", "n", "s"])

    partial = state.select("cluster", "x").mapInArrow(run, "cluster int, n bigint, s array<bigint>")
    out = before.copy()
    for r in partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(dim)]).alias("s")).collect():
        out[r["cluster"]] = [s // r["n"] for s in r["s"]]  # rounds down for negative sums too
    return out


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every usable vector of ``df`` (``vec_id``, ``embedding``) after ``rounds`` rounds of Lloyd's algorithm and a last assignment."""
    spark = df.sparkSession
    vectors = materialise(lattice(df, dim, scale), "lattice")
    history = first_centroids(vectors, k)[None]
    state = vectors
    if not history.size:
        history = np.zeros((1, 0, dim), np.int64)
    else:
        for _ in range(rounds):
            state = materialise(assign(state, history, dim), "assigned")
            history = np.concatenate([history, moved_centroids(state, history[-1])[None]])
        state = materialise(assign(state, history, dim, last=True), "assigned")
    if "cluster" not in state.columns:
        state = state.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
    sums = {r["cluster"]: r["s"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digest = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    rows = [(c, s, sum(sums.values()), digest(history[-1][c])) for c, s in sums.items()]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
