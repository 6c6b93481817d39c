"""SimHash near-duplicates through an inverted index over the byte positions of the fingerprints.

Two fingerprints that differ in at most k bits agree in at least 8 - k of their 8 positional bytes. The index has a
posting list for three positions and their bytes; the position triples are chosen so that every pair that agrees
in the guaranteed number of positions meets in at least one list (for four of eight, 20 triples cover all). A list
of one positional byte alone would hold every 256th fingerprint. In a list the shared positional bytes of a pair are
tallied, pairs below the guaranteed count are left out, and the rest are verified by their differing bits.

Only distinct fingerprints are indexed, so copies cost nothing. A list longer than ``HEAVY`` is cut into blocks
whose pairs are compared in separate tasks. A list yields the links of a tree over each connected set, never all pairs.

Defined cases: null and empty texts, and texts without words, have fingerprint zero and link like any other;
repeated rows keep their own rows; a component's id is its least id (null only where all ids are null); an empty
table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.llm.components import components
from tutelage.llm.frames import batched, materialise, utf8

SEED = 42
#: A posting list longer than this is compared block by block; a block has half as many fingerprints.
HEAVY = 1024
#: Heavy lists known by broadcast up to so many (16 bytes each); beyond, they are joined.
HEAVY_BROADCAST = 50_000
#: Shingles of one text hashed at a time.
CHUNK = 1 << 13
#: Of a list of at most so many fingerprints all pairs are verified at once; of a longer one, those of 1, 2, 4, ... members a round.
SMALL = 8
#: Counters of shingle frequencies, and how many of them travel in a row.
COUNTERS, SLICE = 1 << 20, 1 << 10
#: Texts to verify are looked up by broadcast up to so many (some 40 bytes each); beyond, they are joined.
TEXTS_BROADCAST = 200_000


def _mix(h: np.ndarray, lane: int) -> np.ndarray:
    """Another hash from a hash: the finaliser of splitmix64 over a stepped state."""
    z = h + np.uint64((0x9E3779B97F4A7C15 * lane) % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _spans(text: bytes, width: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The words of a text joined by one space, and where its shingles are in them."""
    words = text.lower().split()
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    if len(words) <= width:
        return joined, [(0, len(joined))] if words else []
    return joined, list(zip([0, *[e + 1 for e in ends[:len(words) - width]]], ends[width - 1:], strict=True))


def hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of each shingle."""
    joined, spans = _spans(text, width)
    return np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)


def majority(own: np.ndarray, lanes: int) -> np.ndarray:
    """``lanes`` words of 64 bits: a bit is set where over half of the hashes have it; further lanes are mixed from the first."""
    total = np.zeros(64 * lanes, np.int64)
    for at in range(0, len(own), CHUNK):
        h = own[at:at + CHUNK]
        mixed = np.stack([_mix(h, lane) if lane else h for lane in range(lanes)], axis=1)
        total += np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits((total * 2 > len(own)).reshape(lanes, 64), axis=1, bitorder="little").view(np.uint64).reshape(lanes)


def fingerprint(text: bytes, width: int = 4, lanes: int = 1) -> np.ndarray:
    """``majority`` of the hashes of all shingles, repeated ones by count."""
    return majority(hashes(text, width), lanes)


def shingles(text: bytes, width: int) -> set[bytes]:
    joined, spans = _spans(text, width)
    return {joined[a:b] for a, b in spans}


def similarity(a: set[bytes], b: set[bytes]) -> float:
    """Shingles of both among those of either; of two empty sets one."""
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def fingerprints(docs: DataFrame, width: int = 4, lanes: int = 1, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``_l0``, ``_l1``, ...: the lanes of each text's fingerprint as signed 64-bit numbers."""
    names = [f"_l{i}" for i in range(lanes)]
    keep = [c for c in keep if c not in names]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, T.LongType()) for n in names])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = np.array([fingerprint(t, width, lanes) for t in batch.column("_text").to_pylist()], dtype=np.uint64).reshape(-1, lanes).view(np.int64)
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(np.ascontiguousarray(marks[:, i])) for i in range(lanes)]], names=schema.fieldNames())

    return batched(docs.select(*[F.col(f"`{c}`") for c in keep], utf8("text").alias("_text")), run, schema)


def covering(shared: int) -> list[tuple[int, ...]]:
    """Position sets of which every choice of ``shared`` of the 8 positions contains at least one."""
    if shared >= 4:
        groups = [(0, 1, 2), (3, 4, 5), (6, 7)]
        of = {p: g for g, members in enumerate(groups) for p in members}
        def kept(t: tuple[int, ...]) -> bool:
            g = [of[p] for p in t]
            return len(set(g)) == 1 or any(g.count(k) == 2 and g.count((k + 1) % 3) == 1 for k in range(3))
        return [t for t in combinations(range(8), 3) if kept(t)]
    return list(combinations(range(8), max(1, shared)))


def postings(nodes: DataFrame, lists: Sequence[tuple[int, ...]]) -> DataFrame:
    """``nodes`` once for each of ``lists`` of so many positions each (0 to 7 in the first lane, 8 to 15 in the second, ...)."""
    lanes = [c for c in nodes.columns if c != "node"]
    parts = F.array(*[F.shiftrightunsigned(lane, 8 * i).bitwiseAND(255) for lane in lanes for i in range(8)])
    dealt = nodes.select("*", parts.alias("bytes")).select("*", F.posexplode(F.array(*[F.lit(list(p)) for p in lists])).alias("key", "at"))
    key = F.col("key").cast("long")
    for i in range(len(lists[0])):
        key = F.shiftleft(key, 8).bitwiseOR(F.col("bytes")[F.col("at")[i]])
    return dealt.select("node", *lanes, key.alias("key"))


def _deal(lists: DataFrame, counts: DataFrame) -> DataFrame:
    """Heavy lists (by ``counts``: ``key``, ``count``) dealt into block pairs: a member of block b goes to the pair of b with every block."""
    heavy = materialise(counts.filter(F.col("count") > HEAVY), "heavy")
    heavy = heavy.select("key", F.ceil(F.col("count") / (HEAVY // 2)).cast("bigint").alias("blocks"))
    heavy = F.broadcast(heavy) if heavy.count() <= HEAVY_BROADCAST else heavy
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    pair = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda x: F.least(x, own) * (1 << 31) + F.greatest(x, own))
    dealt = lists.join(heavy, "key", "left").withColumn("pair", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(pair)))
    return dealt.drop("blocks")


def near_links(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """``(a, b)``: links that connect all pairs of ``nodes`` (``node``, ``l0``) with at most ``max_bits`` differing bits.

    Whole for every pair: all choices of the guaranteed 8 - ``max_bits`` positional bytes are covered.
    """
    lanes = [c for c in nodes.columns if c != "node"]
    shared = max(1, 8 - max_bits)
    lists = covering(shared)
    dealt = _deal(postings(nodes, lists), postings(nodes, lists).groupBy("key").count())
    spread = dealt.select("key", "pair", "node", *lanes).repartition("key", "pair").sortWithinPartitions("key", "pair", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            key = np.stack([batch.column("key").to_numpy(), batch.column("pair").to_numpy()], axis=1)
            node = batch.column("node").to_numpy()
            marks = np.stack([batch.column(c).to_numpy() for c in lanes], axis=1).view(np.uint64)
            if kept is not None:
                key, node, marks = np.concatenate([kept[0], key]), np.concatenate([kept[1], node]), np.concatenate([kept[2], marks])
            cut = int(_starts(key)[-1]) if len(key) else 0
            kept = key[cut:], node[cut:], marks[cut:]
            yield from _links(key[:cut], node[:cut], marks[:cut], max_bits, shared)
        if kept is not None:
            yield from _links(*kept, max_bits, shared)

    return spread.mapInArrow(run, "a bigint, b bigint")


def _near(x: np.ndarray, max_bits: int, shared: int) -> np.ndarray:
    """Of differences by row: those with enough equal positional bytes, then with few enough differing bits."""
    ok = (np.ascontiguousarray(x).view(np.uint8).reshape(len(x), 8 * x.shape[1]) == 0).sum(axis=1) >= shared
    ok[ok] = np.bitwise_count(x[ok]).sum(axis=1) <= max_bits
    return ok


def _starts(key: np.ndarray) -> np.ndarray:
    """Where in sorted keys another one begins."""
    return np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])


def _links(key: np.ndarray, node: np.ndarray, marks: np.ndarray, max_bits: int, shared: int) -> Iterator[pa.RecordBatch]:
    if not len(key):
        return
    starts = _starts(key)
    sizes = np.diff(np.r_[starts, len(key)])
    two = starts[sizes == 2]
    two = two[_near(marks[two] ^ marks[two + 1], max_bits, shared)]
    a, b = [node[two]], [node[two + 1]]
    for s, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
        own, ids = marks[s:s + n], node[s:s + n]
        left = np.arange(n)
        while len(left) > 1:
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                at = queue.pop()
                ok = _near(own[left] ^ own[at], max_bits, shared)
                found, left = left[ok], left[~ok]
                queue.extend(found)
                a.append(np.full(len(found), ids[at])), b.append(ids[found])  # each link is a pair that is near itself
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row; fingerprints of 64 bits link at ``max_bits`` or fewer differing ones."""
    marks = materialise(fingerprints(docs, width).withColumnRenamed("_l0", "node"), "fingerprints")
    nodes = materialise(marks.groupBy("node").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(near_links(nodes.select("node", F.col("node").alias("l0")), max_bits))
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
    return marks.join(named, "node").select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


# --- near copies by shingles -------------------------------------------------------------------

def frequencies(docs: DataFrame, width: int, counters: int = COUNTERS) -> np.ndarray:
    """How many texts have a shingle of each hash modulo ``counters``: a sketch of fixed size, never less than the true number.

    Every task counts its own texts; the counts are summed in slices, so that no task sees them all, and ``counters`` numbers reach the driver.
    """
    slices = counters // SLICE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, np.int64)
        for batch in batches:
            for text in batch.column(0):
                np.add.at(total, (np.unique(hashes(text.as_py(), width)) & np.uint64(counters - 1)).astype(np.int64), 1)
        own = np.flatnonzero(total.reshape(slices, SLICE).any(axis=1))
        yield _sliced(own, total.reshape(slices, SLICE)[own])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(blob.as_py(), np.int64)
                held[at] = held[at] + own if at in held else own.copy()
        keys = sorted(held)
        yield _sliced(np.array(keys, np.int64), np.array([held[k] for k in keys], np.int64).reshape(-1, SLICE))

    kind = "at bigint, counts binary"
    summed = docs.select(utf8("text").alias("text")).mapInArrow(count, kind).repartition("at").mapInArrow(add, kind)
    out = np.zeros((slices, SLICE), np.int64)
    for r in summed.collect():  # counters / SLICE rows
        out[r["at"]] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(out.reshape(-1), np.iinfo(np.int32).max).astype(np.int32)


def _sliced(at: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array([c.tobytes() for c in counts], pa.binary())], names=["at", "counts"])


def prefix(own: np.ndarray, sketch: np.ndarray, least: float) -> np.ndarray:
    """Of the distinct hashes of a text the rarest (by ``sketch``, then by hash), as many as any set at a similarity of ``least`` must share one of."""
    many = len(own) - math.ceil(least * len(own) - 1e-9) + 1
    order = np.lexsort((own, sketch[(own & np.uint64(len(sketch) - 1)).astype(np.int64)]))
    return own[order[:many]] if len(own) else own


def distinct_marks(docs: DataFrame, width: int, lanes: int, keep: Sequence[str], sketch: np.ndarray, least: float) -> DataFrame:
    """``keep``, ``_node`` (a hash of the set of distinct shingles), ``_size`` (their number), ``_l0``, ``_l1``, ... (the fingerprint, to which each counts once), ``_prefix`` and how much of it is surely in no heavy list (``_light``)."""
    names = ["_node", "_size", "_light", *[f"_l{i}" for i in range(lanes)]]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, T.LongType()) for n in names] + [T.StructField("_prefix", T.ArrayType(T.LongType()))])
    sent, heavy = docs.sparkSession.sparkContext.broadcast(sketch), HEAVY

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, keys = [], []
        for t in batch.column("_text").to_pylist():
            own = np.unique(hashes(t, width))
            first = prefix(own, sent.value, least)
            light = np.count_nonzero(sent.value[(first & np.uint64(len(sent.value) - 1)).astype(np.int64)] <= heavy)
            rows.append(np.r_[np.uint64(xxhash.xxh64_intdigest(own.tobytes(), SEED)), np.uint64(len(own)), np.uint64(light), majority(own, lanes)])
            keys.append(first.view(np.int64))
        marks = np.array(rows, dtype=np.uint64).reshape(-1, len(names)).view(np.int64)
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *[pa.array(np.ascontiguousarray(marks[:, i])) for i in range(len(names))], pa.array(keys, pa.list_(pa.int64()))], names=schema.fieldNames())

    return batched(docs.select(*[F.col(f"`{c}`") for c in keep], utf8("text").alias("_text")), run, schema)


def _possible(size: np.ndarray, place: np.ndarray, i: int | np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Can the sets that first meet at these places of their orders reach ``least``? By their sizes, and by what is left behind the places."""
    a, b = size[i], size[j]
    left = 1 + np.minimum(a - place[i], b - place[j]) - 1
    need = np.ceil(least / (1 + least) * (a + b) - 1e-9)
    return (np.minimum(a, b) >= least * np.maximum(a, b) - 1e-9) & (left >= need)


def _pairs(key: np.ndarray, node: np.ndarray, root: np.ndarray, size: np.ndarray, place: np.ndarray, least: float, done: int, upto: int) -> pa.RecordBatch:
    """Possible pairs of different roots: of small lists all, of others those of the members from ``done`` to ``upto``; and the keys of lists with pairs beyond."""
    starts = _starts(key) if len(key) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(key)])
    two = starts[sizes == 2]
    two = two[_possible(size, place, two, two + 1, least) & (root[two] != root[two + 1])]
    a, b, left = [node[two]], [node[two + 1]], []
    for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        rest = np.arange(s, s + n)
        for i in range(0 if n <= SMALL else done, n - 1):
            others = rest[i + 1:]
            near = others[(root[others] != root[s + i]) & _possible(size, place, s + i, others, least)]
            if len(near) and n > SMALL and i >= upto:
                left.append(key[s])
                break
            a.append(np.full(len(near), node[s + i])), b.append(node[near])
    pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)  # a pair meets in most of its tokens
    left = np.array(left, np.int64).reshape(-1, 2)
    none = [None] * len(left)
    return pa.RecordBatch.from_arrays([pa.array([*[None] * len(pairs), *left[:, 0].tolist()], pa.int64()), pa.array([*[None] * len(pairs), *left[:, 1].tolist()], pa.int64()),
                                       pa.array([*pairs[:, 0].tolist(), *none], pa.int64()), pa.array([*pairs[:, 1].tolist(), *none], pa.int64())], names=["key", "pair", "a", "b"])


def near_pairs(lists: DataFrame, least: float, done: int, upto: int) -> DataFrame:
    """``(a, b)`` as ``_pairs`` finds them in ``lists`` (``key``, ``pair``, ``node``, ``root``, ``size``, ``place``), or ``(key, pair)`` of a list with more of them."""
    spread = lists.select("key", "pair", "node", "root", "size", "place").repartition("key", "pair").sortWithinPartitions("key", "pair", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            columns = [np.stack([batch.column(c).to_numpy() for c in ("key", "pair")], axis=1), *[batch.column(c).to_numpy() for c in ("node", "root", "size", "place")]]
            columns = columns if kept is None else [np.concatenate(x) for x in zip(kept, columns, strict=True)]
            cut = int(_starts(columns[0])[-1]) if len(columns[0]) else 0
            kept = [x[cut:] for x in columns]
            yield _pairs(*[x[:cut] for x in columns], least, done, upto)
        if kept is not None:
            yield _pairs(*kept, least, done, upto)

    return spread.mapInArrow(run, "key bigint, pair bigint, a bigint, b bigint")


def shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """``(node, own)``: the hashes of the distinct shingles of each of ``texts`` (``node``, ``text``)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [np.unique(hashes(t, width)).view(np.int64) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int64()))], names=["node", "own"])

    return batched(texts.select("node", "text"), run, "node bigint, own array<bigint>")


def similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Of ``pairs`` (``a``, ``b``) those whose ``sets`` (``node``, ``own``) have a similarity of ``least`` or more; a row at a time, so that no batch of long sets is held."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("own").alias(f"own_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("own_a", "own_b"))
    counted = both.select("a", "b", shared.alias("shared"), (F.size("own_a") + F.size("own_b")).alias("total"))
    return counted.filter(F.col("shared") >= F.lit(least) * (F.col("total") - F.col("shared")) - 1e-9).select("a", "b")


def within(pairs: DataFrame, nodes: DataFrame, lanes: Sequence[str], max_bits: int) -> DataFrame:
    """Of ``pairs`` those whose fingerprints differ in at most ``max_bits`` bits."""
    side = lambda c: nodes.select(F.col("node").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in lanes])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    bits = sum((F.bit_count(F.col(f"a_{x}").bitwiseXOR(F.col(f"b_{x}"))) for x in lanes[1:]), F.bit_count(F.col(f"a_{lanes[0]}").bitwiseXOR(F.col(f"b_{lanes[0]}"))))
    return both.filter(bits <= max_bits).select("a", "b")


def verified_links(lists: DataFrame, verify: Callable[[DataFrame], DataFrame], least: float, indexed: DataFrame) -> DataFrame:
    """``(a, b)``: links that connect all pairs of a similarity of ``least`` or more which share one of ``lists``; ``verify`` keeps the similar ones of pairs.

    First come the pairs of the fingerprint index (``indexed``); the lists are then for pairs that its links leave apart.

    A long list is taken in rounds: a few members against all others, and then only pairs that the links so far leave apart, so that a large group
    of near copies costs about one link for each of them. No pair is verified twice, whether it was linked or refuted.
    """
    checked, done, step = materialise(indexed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "indexed"), 0, 1
    links = materialise(verify(checked), "similar")
    state = lists.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    while True:
        found = materialise(near_pairs(state, least, done, done + step), "near-pairs")
        pairs = found.filter(F.col("a").isNotNull()).select("a", "b").distinct()
        pairs = materialise(pairs.join(checked, ["a", "b"], "left_anti"), "pairs")
        new = materialise(verify(pairs), "similar")
        links, checked = links.union(new), checked.union(pairs)
        left = found.filter(F.col("a").isNull()).select("key", "pair").distinct()
        if left.isEmpty():
            return links
        lists = materialise(lists.join(left, ["key", "pair"], "left_semi"), "lists")
        state = lists.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
        done, step = done + step, 2 * step


def representatives(docs: DataFrame, width: int = 5, lanes: int = 4, max_bits: int = 90, least: float = 0.8, index_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the least id (null last), once if the row is repeated.

    Near copies have a similarity of ``least`` or more between their sets of shingles of ``width`` words; a group is what such pairs connect.
    The fingerprints' first lane goes through the index over positional bytes (``near_links``): all pairs within ``index_bits`` are candidates, and those that are similar
    are joined before anything else. At ``least`` some 10 bits of a lane differ, which no index of guaranteed equal bytes covers, so for the pairs it leaves apart
    an exact way follows. Two sets at ``least`` share one of the rarest shingles of each (``prefix``), whatever order of rarity is taken, so candidates meet in a list of
    such a shingle and none is missed; lines and passages that many texts share are at the far end of the order and make no list. Candidates
    that sizes, places and at most ``max_bits`` of 256 bits of the fingerprints over distinct shingles do not rule out (at 0.8 some 39 bits differ with a deviation
    of 6) are counted on the hashes of all shingles of both texts. All columns pass.

    Only ids, hashes and fingerprints are written and shuffled, but for the one join that brings the rows that stay;
    ``docs`` is read several times and must give the same rows each time.
    """
    row = "_row"
    while any(c.lower().startswith(row) for c in docs.columns):
        row += "_"
    own = {row: F.xxhash64("doc_id", "text"), f"{row}2": F.xxhash64("text", "doc_id")}  # 128 bits tell rows apart
    names = [f"l{i}" for i in range(lanes)]
    known = docs.select("doc_id", "text", own[row].alias("_own"), own[f"{row}2"].alias("_own2"))
    marks = materialise(distinct_marks(known, width, lanes, ("doc_id", "_own", "_own2"), frequencies(docs.select("text"), width), least), "marked")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_own", "_own2")).alias("least")
    nodes = marks.groupBy("_node").agg(first, *[F.first(c).alias(c.removeprefix("_")) for c in ("_size", "_light", *[f"_{x}" for x in names], "_prefix")])
    nodes = materialise(nodes.withColumnRenamed("_node", "node"), "nodes")

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = materialise(within(pairs, nodes, names, max_bits), "close-pairs")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        rows = materialise(nodes.select("node", F.col("least._own").alias("_own"), F.col("least._own2").alias("_own2")).join(wanted, "node", "left_semi"), "wanted")
        rows = F.broadcast(rows) if rows.count() <= TEXTS_BROADCAST else rows
        texts = known.select("_own", "_own2", utf8("text").alias("text")).join(rows, ["_own", "_own2"]).select("node", "text")
        return similar(pairs, materialise(shingle_sets(texts, width).dropDuplicates(["node"]), "sets"), least)

    listed = nodes.select("node", "size", "light", F.posexplode("prefix").alias("place", "key"))
    counts = listed.filter(F.col("place") >= F.col("light")).groupBy("key").count()
    lists = _deal(listed.select("node", "size", F.col("place").cast("bigint").alias("place"), "key"), counts)
    indexed = near_links(nodes.select("node", "l0"), index_bits)
    roots = components(verified_links(lists, verify, least, indexed))
    rooted = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = rooted.groupBy("root").agg(F.min("least").alias("w")).select(F.col("w._own").alias(row), F.col("w._own2").alias(f"{row}2"))
    kept = docs.withColumns(own).join(first, list(own))
    once, number = Window.partitionBy(*own).orderBy(row), f"{row}_number"
    return kept.withColumn(number, F.row_number().over(once)).filter(F.col(number) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
