"""All pairs of vectors at a cosine of a threshold or more, by tiles and by leading principal components first.

Vectors are rotated so that the first coordinates hold most of their length. In a tile (two blocks of vectors) the
products of the leading coordinates are accumulated first; what the others can add is at most the product of the two suffix norms
(Cauchy-Schwarz). Pairs whose sum cannot reach the threshold stop there, the rest go on to the next coordinates, and what is
left is computed on the given components in double precision, which alone decides. The suffix norm rides along as one
more coordinate, so a step is one matrix product and one comparison.

Copies are compared once: equal vectors are one node with their number. A tile gives, for each node with a link, the number of vectors
linked to it and its connection to a set's first node, never the pairs, so that a large group of near copies costs a row for each member and tile.
There are enough blocks for twice as many tiles as the cluster has cores, and as many as keep one at ``BLOCK_BYTES``; a vector is
sent once for each block. Comparing all with all is quadratic: what is sent grows with the number of blocks, which doubles with four times the cores.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of different
lengths; every row is a vector, so repeated rows link with each other; ties do not arise; an empty table gives an empty result; other
columns are left out. A row with a null id counts as a vector; a component's id is its least id that is not null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.llm.components import components
from tutelage.llm.frames import materialise

#: Bytes of one block's vectors (as 32-bit floats) in a tile.
BLOCK_BYTES = 16 << 20
#: Vectors the rotation is fitted on (those of least hash), and for how many lengths of vectors; it changes the speed alone, never the result.
PCA_SAMPLE, PCA_LENGTHS = 4096, 8
#: Coordinates per step, rows and columns compared at once, and pairs gathered at once.
STEP, ROWS, COLUMNS, PAIRS = 16, 1024, 8192, 1 << 15
#: More than the rounding of the 32-bit products.
SLACK = 1e-4


def usable() -> Column:
    """Is the embedding a vector with a direction?"""
    v = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def rotation(sample: np.ndarray) -> np.ndarray:
    """The principal directions of unit vectors, the one of most variance first, as columns."""
    return np.linalg.eigh(sample.T @ sample)[1][:, ::-1]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that neither squares of huge components overflow nor those of tiny ones vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def steps(dim: int) -> list[tuple[int, int]]:
    return [(a, min(a + STEP, dim)) for a in range(0, dim, STEP)]


def prepared(x: np.ndarray, turn: np.ndarray | None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Unit vectors, and for each step their rotated coordinates with the norm of all later ones behind them."""
    own = unit(x)
    turned = own if turn is None else own @ turn
    rest = np.sqrt(np.maximum(np.cumsum((turned * turned)[:, ::-1], axis=1)[:, ::-1], 0))
    parts = []
    for a, b in steps(x.shape[1]):
        after = rest[:, b] if b < x.shape[1] else np.zeros(len(x))
        parts.append(np.ascontiguousarray(np.c_[turned[:, a:b], after], dtype=np.float32))
    return own, parts


def tile_links(left: tuple[np.ndarray, list[np.ndarray]], right: tuple[np.ndarray, list[np.ndarray]] | None, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked rows of two blocks, or of one block and itself (each pair once)."""
    other = left if right is None else right
    a, b = left[0], other[0]
    for r in range(0, len(a), ROWS):
        for c in range(0 if right is not None else r // COLUMNS * COLUMNS, len(b), COLUMNS):
            found = np.flatnonzero((left[1][0][r:r + ROWS] @ other[1][0][c:c + COLUMNS].T).ravel() >= least - SLACK)
            if not len(found):
                continue
            width = min(COLUMNS, len(b) - c)
            for at in range(0, len(found), PAIRS):
                i, j = np.divmod(found[at:at + PAIRS], width)
                i, j = i + r, j + c
                if right is None:
                    i, j = i[i < j], j[i < j]
                i, j = _survivors(i, j, left[1], other[1], least)
                ok = np.einsum("ij,ij->i", a[i], b[j]) >= least
                if ok.any():
                    yield i[ok], j[ok]


def _survivors(i: np.ndarray, j: np.ndarray, a: list[np.ndarray], b: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that can still reach ``least`` when the coordinates of the second and every further step are added."""
    so_far = np.einsum("ij,ij->i", a[0][i, :-1], b[0][j, :-1])
    for x, y in zip(a[1:], b[1:], strict=True):
        p, q = x[i], y[j]
        so_far = so_far + np.einsum("ij,ij->i", p[:, :-1], q[:, :-1])
        ok = so_far + p[:, -1] * q[:, -1] >= least - SLACK
        i, j, so_far = i[ok], j[ok], so_far[ok]
    return i, j


def unite(first: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of ``i`` and ``j`` in place; ``first`` gives each place its set's first place."""
    while len(i):
        a, b = first[i], first[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if not len(i):
            return
        np.minimum.at(first, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = first[first]
            if (further == first).all():
                break
            first[:] = further


def _vectors(table: pa.Table, dim: int) -> np.ndarray:
    return table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def compare(tile: pa.Table, low: int, high: int, dim: int, turn: np.ndarray | None, least: float) -> pa.Table:
    """``(node, links, first)`` of the nodes with links in the tile of the blocks ``low`` and ``high``: linked vectors there, and the first node of the set they connect."""
    blocks = [tile.filter(pc.equal(tile.column("block"), b)) for b in dict.fromkeys((low, high))]
    blocks = [b for b in blocks if b.num_rows]
    sides = [prepared(_vectors(b, dim), turn) for b in blocks]
    node = np.concatenate([b.column("node").to_numpy() for b in blocks])
    copies = np.concatenate([b.column("copies").to_numpy() for b in blocks])
    found, first = np.zeros(len(node), np.int64), np.arange(len(node))
    if low == high or len(sides) == 2:
        shift, other = (0, None) if low == high else (len(sides[0][0]), sides[1])
        for i, j in tile_links(sides[0], other, least):
            j = j + shift
            np.add.at(found, i, copies[j])
            np.add.at(found, j, copies[i])
            unite(first, i, j)
    own = np.flatnonzero(found)
    return pa.table({"node": node[own], "links": found[own], "first": node[first[own]]})


def rotations(nodes: DataFrame) -> dict[int, np.ndarray]:
    """By length of vectors, for the commonest lengths: the rotation fitted on a bounded sample."""
    sizes = [r["dim"] for r in nodes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(PCA_LENGTHS).collect()]
    out = {}
    for dim in sizes:
        rows = nodes.filter(F.col("dim") == dim).orderBy(F.xxhash64("embedding"), "node").limit(max(1, min(PCA_SAMPLE, (1 << 24) // dim))).select("embedding").toArrow()
        out[dim] = rotation(unit(_vectors(rows, dim)))
    return out


def _blocks(nodes: DataFrame) -> int:
    size = nodes.agg(F.sum(F.col("dim").cast("bigint") * 4)).first()[0] or 0
    cores = nodes.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(size / BLOCK_BYTES), math.ceil(math.sqrt(2 * cores)))


def links(nodes: DataFrame, least: float = 0.9) -> DataFrame:
    """``(node, links, first)`` by tile, from ``nodes`` (``node``, ``embedding``, ``copies``, ``dim``; different vectors)."""
    turns, many = rotations(nodes), _blocks(nodes)
    sent = nodes.sparkSession.sparkContext.broadcast(turns)
    block = F.pmod(F.xxhash64("node"), F.lit(many)).cast("int")
    dealt = nodes.select("dim", "node", "copies", "embedding", block.alias("block")).select("*", F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("with"))
    tile = ["dim", "low", "high"]
    dealt = dealt.select("dim", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "node", "copies", "embedding")
    spread = dealt.repartition(many * (many + 1) // 2, *tile)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim, low, high = [k.as_py() for k in key]
        return compare(table, low, high, dim, sent.value.get(dim), least)

    return spread.groupBy(*tile).applyInArrow(run, T.StructType([T.StructField(c, T.LongType()) for c in ("node", "links", "first")]))


def near(df: DataFrame, least: float = 0.9) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``df`` (``vec_id``, ``embedding``): vectors at a cosine of ``least`` or more link."""
    key = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]  # 128 bits tell vectors apart
    rows = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", usable().alias("usable"))
    distinct = rows.filter("usable").select("vec_id", "embedding", *key).groupBy("h1", "h2").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    nodes = materialise(distinct.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")), "vectors")
    found = materialise(links(nodes, least), "tile-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("first").alias("b")))
    linked = nodes.select("h1", "h2", "node", "least", "copies").join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(roots, "node", "left")
    linked = linked.withColumn("root", F.coalesce("root", "node"))
    named = linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    known = named.select("h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("vec_id", *[F.when(F.col("usable"), k).alias(n) for k, n in zip(key, ("h1", "h2"), strict=True)]).join(known, ["h1", "h2"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
