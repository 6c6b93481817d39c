"""Benchmark decontamination by a prefix-filtered set join.

Each benchmark item gives windows of ``window`` consecutive words (one shorter window if it has fewer). A window is the
set of its word shingles with their places. A document contains it only if it has every one of them, so one
necessary shingle is enough as prefix: the one that is rarest over all documents. Documents are
joined on that shingle alone; its place in the window fixes where the window must start, the document's length
bounds that start, and the words from there are compared one by one.

The benchmark is the small side. It is dealt by hash into blocks of about ``BLOCK_WORDS`` words, which are written and then sent to all tasks one after the
other; the driver holds one of them. A larger benchmark means more blocks and no other limit.

Defined cases: a null or empty text has no words; items without words or without id match nothing; repeated items
count once by id; repeated documents are each reported; an empty table on either side works; a column named as the
result is replaced, all other columns that are asked for pass.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.llm.frames import batched, free, materialise, utf8
from tutelage.session import fresh_path

#: Words of one block of the benchmark: about 200 MB as an index in a task; a longer item is cut into parts of so many words.
BLOCK_WORDS, PART_WORDS = 500_000, 100_000

_TABLE = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_STEP = 0x9E3779B97F4A7C15 | 1

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))), T.StructField("items", T.ArrayType(T.StringType()))])


def words(text: bytes) -> list[bytes]:
    """Lower-case words: digits, letters a-z and everything outside ASCII."""
    return text.translate(_TABLE).split()


class Windows:
    """The windows of a block of items, as numbers of a vocabulary of their own."""

    def __init__(self, items: Sequence[tuple[str, list[bytes]]], window: int, shingle: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in text]
            for at in range(max(1, len(ids) - window + 1)):
                owners[tuple(ids[at:at + window])].add(item)
        self.owners = [sorted(s) for s in owners.values()]
        self.length = np.array([len(w) for w in owners], dtype=np.int64)
        self.ids = np.zeros((len(owners), window), np.int32)
        for i, w in enumerate(owners):
            self.ids[i, :len(w)] = w
        self.width = np.minimum(self.length, shingle)
        #: By shingle width: the distinct shingles of all windows of that width, sorted.
        self.shingles = {int(s): np.unique(np.concatenate([_rolled(w[:n], s) for w, n in zip(self.ids[self.width == s], self.length[self.width == s], strict=True)]))
                         for s in np.unique(self.width)}
        self.prefix: dict[int, tuple[np.ndarray, ...]] = {}

    def numbers(self, text: bytes) -> np.ndarray:
        known = self.vocabulary
        return np.array([known.get(w, 0) for w in words(text)], dtype=np.int32)

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Take each window's rarest shingle as its prefix."""
        rows = defaultdict(list)
        for i, (w, n, s) in enumerate(zip(self.ids, self.length, self.width, strict=True)):
            marks = _rolled(w[:n], s)
            at = min(range(len(marks)), key=lambda k: (counts.get((int(s), int(marks[k])), 0), k))
            rows[int(s)].append((marks[at], at, i))
        for s, found in rows.items():
            found.sort()
            keys, first, many = np.unique(np.array([r[0] for r in found], np.int64), return_index=True, return_counts=True)
            self.prefix[s] = keys, first, many, np.array([r[1] for r in found]), np.array([r[2] for r in found])

    def found(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(start, window)`` of all occurrences in a document."""
        starts, which = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s, (keys, first, many, offset, window) in self.prefix.items():
            at, key = _matches(ids, s, keys)
            entry = np.repeat(first[key], many[key]) + _ramp(many[key])
            start, w = np.repeat(at, many[key]) - offset[entry], window[entry]
            fits = (start >= 0) & (start + self.length[w] <= len(ids))
            start, w = start[fits], w[fits]
            span = np.arange(self.ids.shape[1])
            inside = span < self.length[w][:, None]
            same = (ids[np.minimum(start[:, None] + span, max(len(ids) - 1, 0))] == self.ids[w]) | ~inside
            ok = same.all(axis=1)
            starts.append(start[ok]), which.append(w[ok])
        return np.concatenate(starts), np.concatenate(which)


def _rolled(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit mark of every ``width`` consecutive numbers."""
    n = len(ids) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        out = out * np.uint64(_STEP) + ids[k:k + n].astype(np.uint64) + np.uint64(1)
    return out.view(np.int64)


def _ramp(counts: np.ndarray) -> np.ndarray:
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _matches(ids: np.ndarray, width: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose shingle is one of the sorted ``keys``, and which one."""
    if len(ids) < width:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    known = np.cumsum(np.r_[0, ids == 0])
    at = np.flatnonzero(known[width:] == known[:-width])
    if not len(at):
        return at, at
    marks = _rolled(ids, width)[at]
    key = np.minimum(np.searchsorted(keys, marks), len(keys) - 1)
    ok = keys[key] == marks
    return at[ok], key[ok]


def _parts(items: DataFrame, window: int) -> DataFrame:
    """``(item, n, text)``: the words of each item, a long one in parts of ``PART_WORDS`` that overlap so that each window is whole in one of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = words(text.as_py())
                own = [found[at:at + PART_WORDS + window - 1] for at in range(0, max(1, len(found) - window + 1), PART_WORDS)] if found else []
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(own), pa.string()), pa.array([len(w) for w in own], pa.int64()), pa.array([b" ".join(w) for w in own], pa.binary())],
                                                 names=["item", "n", "text"])

    rows = items.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item"), utf8("text").alias("text"))
    return rows.mapInArrow(run, "item string, n bigint, text binary")


def _blocks(items: DataFrame, window: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The benchmark in blocks of about ``BLOCK_WORDS`` words, dealt and written by Spark; the driver fetches one at a time."""
    spark, parts = items.sparkSession, materialise(_parts(items, window), "items")
    many = max(1, math.ceil((parts.agg(F.sum("n")).first()[0] or 0) / BLOCK_WORDS))
    path = fresh_path(spark, "item-blocks")
    parts.select("item", "text", F.pmod(F.xxhash64("item", "text"), F.lit(many)).cast("int").alias("block")).write.partitionBy("block").parquet(path)
    dealt = spark.read.schema("item string, text binary, block int").parquet(path)
    for k in range(many):
        yield [(r["item"], bytes(r["text"]).split(b" ")) for r in dealt.filter(F.col("block") == k).select("item", "text").collect()]


def _count(docs: DataFrame, sent) -> dict[tuple[int, int], int]:
    """How often each shingle of the benchmark occurs in all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, totals = sent.value, {}
        for batch in batches:
            for text in batch.column(0):
                ids = index.numbers(text.as_py())
                for s, keys in index.shingles.items():
                    _, key = _matches(ids, s, keys)
                    if len(key):
                        totals[s] = totals.get(s, 0) + np.bincount(key, minlength=len(keys))
        for s, n in totals.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), s, np.int32)), pa.array(index.shingles[s][some]), pa.array(n[some])], names=["width", "mark", "n"])

    parts = docs.select(utf8("text").alias("text")).mapInArrow(run, "width int, mark bigint, n bigint")
    return {(r["width"], r["mark"]): r["n"] for r in parts.groupBy("width", "mark").agg(F.sum("n").alias("n")).collect()}


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, keep: Sequence[str] | None = None, out: str = "contamination") -> DataFrame:
    """``docs`` (columns ``keep``, by default all) with a struct: ``n_words``, ``n_hit`` words inside an occurring window, their ``spans``, and the ``items``."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]
    empty = F.struct(F.lit(None).cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_hit"), F.array().cast("array<array<int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    text, found = free(keep, "_text"), free(keep, "_found")
    state = docs.select(*[F.col(f"`{c}`") for c in keep], utf8("text").alias(text), empty.cast(RESULT).alias(found))
    for k, block in enumerate(_blocks(items, window)):
        if k:
            state = materialise(state, "hits")
        index = Windows(block, window, shingle)
        spark = docs.sparkSession
        if block:
            index.order(_count(docs, spark.sparkContext.broadcast(index)))
        state = _mark(state, spark.sparkContext.broadcast(index), [*keep, text], found)
    return state.select(*[F.col(f"`{c}`") for c in keep], F.col(found).alias(out))


def _mark(state: DataFrame, sent, keep: list[str], out: str) -> DataFrame:
    """``state``, of the columns ``keep`` (the text last) and ``out``, with the hits of one block added to ``out``."""
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.string()))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        index, rows = sent.value, []
        for text, before in zip(batch.column(keep[-1]).to_pylist(), batch.column(out).to_pylist(), strict=True):
            ids = index.numbers(text)
            hit, owners = np.zeros(len(ids) + 1, np.int64), set(before["items"])
            for a, b in before["spans"]:
                hit[a] += 1
                hit[b] -= 1
            start, which = index.found(ids)
            np.add.at(hit, start, 1)
            np.add.at(hit, start + index.length[which], -1)
            for w in set(which.tolist()):
                owners.update(index.owners[w])
            inside = np.r_[0, (np.cumsum(hit[:-1]) > 0).astype(np.int8), 0]
            edges = np.flatnonzero(np.diff(inside))
            spans = edges.reshape(-1, 2).tolist()
            rows.append({"n_words": len(ids), "n_hit": sum(b - a for a, b in spans), "spans": spans, "items": sorted(owners)})
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(rows, kind)], names=[*keep, out])

    return batched(state, run, state.schema)
