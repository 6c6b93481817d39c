"""A count-based scorer, so that the whole ranking runs on Spark without a model server.

``ln((count + 1) / (N + V))`` with add-one smoothing: class-conditional counts for labels, one
corpus-wide class for perplexity. It scores the prompt given the label, where a causal model
scores the label given the prompt; length normalisation, null prior and argmax are the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.functions import scores as S
from tutelage.functions.constants import LABELS, MAX_LEN
from tutelage.functions.text import tokens
from tutelage.session import fresh_path

# A broadcast row is the token, one long per label, and some 100 bytes of row and hash table.
BROADCAST_BYTES = 32 << 20
ROW_BYTES = 100
# Of counts too large to broadcast, so many of the most frequent tokens are.
FREQUENT = 20_000
# A file of bucketed counts holds up to so many bytes (as ``CountLM.size``).
BUCKET_BYTES = 16 << 20
# The filter of known tokens: bits a token, hashes at most, bits in a slice, slices at most (64 MB in all; beyond, it lets more unknown tokens through).
FILTER_BITS, FILTER_HASHES, SLICE_BITS, SLICES = 16, 8, 1 << 17, 1 << 12
# Texts cut into tokens at a time, and unknown tokens a task remembers.
TEXTS, REMEMBERED = 256, 100_000
_TOKEN = re.compile(r"[^ \t\n\r\f]+")


@dataclass
class CountLM:
    """``counts(token, c)``: ``c`` has one count per label. ``n`` tokens per label, ``v`` distinct tokens
    of ``token_bytes`` bytes altogether."""

    counts: DataFrame
    labels: tuple[str, ...]
    n: tuple[int, ...]
    v: int
    token_bytes: int
    known: dict[tuple[bool, str], Broadcast] = field(default_factory=dict, repr=False, compare=False)

    @property
    def size(self) -> int:
        """Bytes of the counts as a broadcast table, known from the fit."""
        return self.token_bytes + self.v * (ROW_BYTES + 8 * len(self.labels))

    def logprobs(self, c: Column) -> Column:
        """Log-probability per label from a counts array; null (unknown token) counts as zeros."""
        cell = lambda i: F.coalesce(F.element_at(c, i + 1), F.lit(0))
        return F.array(*[F.log((cell(i) + 1) / F.lit(float(self.n[i] + self.v))) for i in range(len(self.labels))])

    def save(self, path: str) -> None:
        """Write the counts for other jobs, with the labels they belong to."""
        self.counts.select("token", "c", F.array(*[F.lit(lab) for lab in self.labels]).alias("labels")).write.parquet(path)

    def unpersist(self) -> None:
        self.counts.unpersist()


def load_count_lm(spark: SparkSession, path: str, labels: Sequence[str] = LABELS) -> CountLM:
    """Counts that were saved for exactly these labels in this order; any others raise, as classes would be swapped."""
    stored = spark.read.schema("token string, c array<bigint>, labels array<string>").parquet(path)
    other = stored.filter(~F.col("labels").eqNullSafe(F.array(*[F.lit(lab) for lab in labels]))).select("labels").first()
    if other is not None:
        raise ValueError(f"counts were stored for the labels {other['labels']}, asked for {list(labels)}")
    return _measured(stored.drop("labels"), tuple(labels))


def fit_count_lm(df: DataFrame, text_col: str = "question", label_col: str | None = "answer",
                 labels: Sequence[str] = LABELS, max_len: int | None = None) -> CountLM:
    """Count tokens per label. The counts are kept (spilling to disk) because scoring reads them again."""
    labels = tuple(labels) if label_col is not None else ("all",)
    label = F.col(label_col) if label_col is not None else F.lit("all")
    toks = tokens(text_col) if max_len is None else F.slice(tokens(text_col), 1, max_len)
    known = df.filter(label.isin(*labels)) if label_col is not None else df
    rows = known.select(label.alias("label"), F.explode(toks).alias("token"))
    counts = rows.groupBy("token").agg(F.array(*[F.count_if(F.col("label") == lab) for lab in labels]).alias("c"))
    return _measured(counts.persist(StorageLevel.MEMORY_AND_DISK), labels)


def _measured(counts: DataFrame, labels: tuple[str, ...]) -> CountLM:
    sums = [F.sum(F.element_at("c", i + 1)).alias(f"n{i}") for i in range(len(labels))]
    total = counts.agg(F.count("*").alias("v"), F.sum(F.octet_length("token")).alias("bytes"), *sums).first()
    return CountLM(counts, labels, tuple(int(total[f"n{i}"] or 0) for i in range(len(labels))), int(total["v"]), int(total["bytes"] or 0))


def bucketed(lm: CountLM, name: str, buckets: int) -> CountLM:
    """The same with its counts written as a table in ``buckets`` files by token (more of counts beyond ``BUCKET_BYTES`` a file), under ``name`` in the session's catalog.

    Rows that meet it are shuffled by token into as many parts; the counts themselves are not moved again, however many corpora are scored.
    """
    spark, buckets = lm.counts.sparkSession, max(buckets, -(-lm.size // BUCKET_BYTES))
    lm.counts.repartition(buckets, "token").write.bucketBy(buckets, "token").sortBy("token").option("path", fresh_path(spark, name)).saveAsTable(name)
    return replace(lm, counts=spark.table(name))


def frequent(lm: CountLM, n: int = FREQUENT) -> DataFrame:
    """The counts of the most frequent tokens, at most ``n``: known from the fit, without a look at the rows to score.

    Those from a power of two on that leaves no more than ``n``, so that no task ranks them all; where the first power leaves more, ``n`` of these.
    """
    total = F.aggregate("c", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    level = F.floor(F.log2(F.greatest(total, F.lit(1))))
    levels = sorted(((r["level"], r["count"]) for r in lm.counts.groupBy(level.alias("level")).count().collect()), reverse=True)  # a row for each power of two
    least, many = None, 0
    for at, count in levels:
        many += count
        if many > n:
            break
        least = at
    return lm.counts.filter(level >= least) if least is not None else lm.counts.orderBy(F.desc(total), "token").limit(n)


def _places(h: np.ndarray, slices: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """The slice of each hash, and the bits it has there."""
    a, b = h & np.uint64(SLICE_BITS - 1), ((h >> np.uint64(17)) & np.uint64(SLICE_BITS - 1)) | np.uint64(1)
    bits = (a[:, None] + b[:, None] * np.arange(hashes, dtype=np.uint64)) & np.uint64(SLICE_BITS - 1)
    return ((h >> np.uint64(40)) % np.uint64(slices)).astype(np.int64), bits.astype(np.int64)


def _filter(lm: CountLM) -> tuple[np.ndarray, int]:
    """A Bloom filter of all tokens in slices, and its hashes: each slice is filled in one task, so that no task sees them all.

    Where the slices are too few for the tokens, fewer hashes let less unknown tokens through.
    """
    slices = min(SLICES, max(1, -(-lm.v * FILTER_BITS // SLICE_BITS)))
    hashes = max(1, min(FILTER_HASHES, round(np.log(2) * slices * SLICE_BITS / max(1, lm.v))))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at, bits = _places(batch.column("h").to_numpy().view(np.uint64), slices, hashes)
            for s in np.unique(at).tolist():
                held.setdefault(s, np.zeros(SLICE_BITS, bool))[bits[at == s].reshape(-1)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([np.packbits(b, bitorder="little").tobytes() for b in held.values()], pa.binary())], names=["at", "bits"])

    hashes_of = lm.counts.select(F.xxhash64("token").alias("h"))
    dealt = hashes_of.repartition((F.shiftrightunsigned("h", 40) % slices).alias("at"))
    out = np.zeros((slices, SLICE_BITS // 8), np.uint8)
    for r in dealt.mapInArrow(fill, "at bigint, bits binary").collect():  # ``slices`` rows
        out[r["at"]] |= np.frombuffer(r["bits"], np.uint8)
    return out, hashes


def _possible(words: Sequence[str], known: tuple[np.ndarray, int]) -> np.ndarray:
    """Which of ``words`` the filter may hold; those it has not are unknown for certain."""
    bits, hashes = known
    at, places = _places(np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words)), len(bits), hashes)
    return ((bits[at[:, None], places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=1)


def _known(lm: CountLM, whole: bool, common: str) -> Broadcast:
    """What every task holds: tokens with their places, log-probabilities by place (the last: of an unknown token), and the filter unless these are all tokens."""
    if (whole, common) not in lm.known:
        words = sorted(set(_TOKEN.findall(common)))
        kept = lm.counts if whole else frequent(lm)
        if words and not whole:
            kept = kept.union(lm.counts.filter(F.col("token").isin(words)))
        rows = kept.select("token", lm.logprobs(F.col("c")).alias("lp")).toArrow()
        unknown = lm.counts.sparkSession.range(1).select(lm.logprobs(F.lit(None).cast("array<bigint>")).alias("lp")).first()["lp"]
        lp = np.array([*rows["lp"].to_pylist(), unknown], np.float64).reshape(-1, len(lm.labels))
        place = {w: len(lp) - 1 for w in words} | {w: i for i, w in enumerate(rows["token"].to_pylist())}
        lm.known[whole, common] = lm.counts.sparkSession.sparkContext.broadcast((place, lp, None if whole else _filter(lm)))
    return lm.known[whole, common]


def _settle(batch: pa.RecordBatch, place: dict[str, int], lp: np.ndarray, bits: tuple[np.ndarray, int] | None, absent: set[str], window: slice) -> pa.RecordBatch:
    """Texts (the last column) as rows of one unsettled token each, null for a text without any; the first of a text has its number of tokens and the sums of the settled ones."""
    cut = [_TOKEN.findall(t)[window] if t else [] for t in batch.column(batch.num_columns - 1).to_pylist()]
    lens, flat = np.array([len(t) for t in cut], np.int64), [w for t in cut for w in t]
    unknown = len(lp) - 1
    at = np.fromiter((place.get(w, -1) for w in flat), np.int64, len(flat))
    if bits is None:
        at[at < 0] = unknown
    else:
        new = list({flat[i] for i in np.flatnonzero(at < 0).tolist()} - absent)
        if len(absent) > REMEMBERED:
            absent.clear()
            new = list({flat[i] for i in np.flatnonzero(at < 0).tolist()})
        absent.update(w for w, kept in zip(new, _possible(new, bits).tolist(), strict=True) if not kept)
        for i in np.flatnonzero(at < 0).tolist():
            if flat[i] in absent:
                at[i] = unknown
    row, settled = np.repeat(np.arange(len(cut)), lens), at >= 0
    open_ = np.flatnonzero(~settled)
    own = row[open_]
    take = np.r_[own, np.setdiff1d(np.arange(len(cut)), own)]
    first = np.ones(len(take), bool)
    first[1:len(own)] = own[1:] != own[:-1]
    words = pa.array([*(flat[i] for i in open_.tolist()), *[None] * (len(take) - len(own))], pa.string())
    sums = [np.bincount(row[settled], lp[at[settled], i], len(cut)) for i in range(lp.shape[1])]
    keys = [batch.column(i).take(pa.array(take)) for i in range(batch.num_columns - 1)]
    return pa.RecordBatch.from_arrays([*keys, words, pa.array(np.where(first, lens[take], 0)), *[pa.array(np.where(first, s[take], 0.0)) for s in sums]],
                                      names=[*batch.schema.names[:-1], "__w", "__n", *[f"__s{i}" for i in range(len(sums))]])


def _settled(df: DataFrame, lm: CountLM, text_col: str, keys: Sequence[str], window: slice, whole: bool, common: str = "") -> DataFrame:
    """``keys`` and what ``_settle`` gives of each text: frequent tokens and surely unknown ones are summed where the text is, the others leave it alone."""
    texts = df.select(*keys, F.col(text_col).cast("string").alias("__t"))
    schema = T.StructType([*texts.schema.fields[:-1], T.StructField("__w", T.StringType()), T.StructField("__n", T.LongType()),
                           *[T.StructField(f"__s{i}", T.DoubleType()) for i in range(len(lm.labels))]])
    sent = _known(lm, whole, common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, lp, bits = sent.value
        absent: set[str] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                yield _settle(batch.slice(at, TEXTS), place, lp, bits, absent, window)

    return texts.mapInArrow(run, schema)


def _with_logprobs(rows: DataFrame, lm: CountLM, broadcast_bytes: int) -> DataFrame:
    """``rows`` (with ``token``) and the log-probabilities ``lp`` of their tokens. Of counts too large to broadcast the frequent ones are; only rows of other tokens are shuffled."""
    known = lm.counts.select("token", lm.logprobs(F.col("c")).alias("lp"))
    if lm.size <= broadcast_bytes:
        met = rows.join(F.broadcast(known), "token", "left")
    else:
        hot = F.broadcast(frequent(lm).select("token", lm.logprobs(F.col("c")).alias("lp")))
        rest = rows.join(hot.select("token"), "token", "left_anti").join(known.hint("merge"), "token", "left")
        met = rows.join(hot, "token").unionByName(rest)
    return met.withColumn("lp", F.coalesce("lp", lm.logprobs(F.lit(None).cast("array<bigint>"))))


def token_scores(df: DataFrame, lm: CountLM, text_col: str = "prompt", id_col: str = "example_id",
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The long form ``token_scores(example_id, label, variant, pos, logprob)``."""
    rows = df.select(F.col(id_col).alias("example_id"), F.posexplode(tokens(text_col)).alias("pos", "token"))
    scored = _with_logprobs(rows, lm, broadcast_bytes)
    cells = [F.struct(F.lit(lab).alias("label"), F.element_at("lp", i + 1).alias("logprob")) for i, lab in enumerate(lm.labels)]
    return scored.select("example_id", F.lit(0).alias("variant"), "pos", F.inline(F.array(*cells)))


def count_lm_scores(df: DataFrame, lm: CountLM, text_col: str = "prompt", keys: Sequence[str] = ("example_id",),
                    skip: int = 0, max_len: int | None = None, broadcast_bytes: int = BROADCAST_BYTES, common: str = "") -> DataFrame:
    """``raw`` (mean log-probability per label, in label order) and ``n_tokens`` per row of ``df``.

    Counts of up to ``broadcast_bytes`` are sent to every task, and a text is summed where it is. Of larger ones the frequent tokens and a filter of
    all are: only tokens that are neither frequent nor surely unknown meet the counts by shuffle, in one pass. The words of ``common``, which a template puts into
    every text, are looked up beforehand, however rare they were in the fit. A text without tokens scores null.
    """
    whole = lm.size <= broadcast_bytes
    window = slice(skip, None if max_len is None else max(skip, max_len))
    rows = _settled(df, lm, text_col, keys, window, whole, common)
    sums = [F.col(f"__s{i}") for i in range(len(lm.labels))]
    if not whole:  # a text without open tokens takes a key that no token has, as tokens hold no space
        rows = rows.withColumn("key", F.coalesce("__w", F.concat(F.lit("  "), F.xxhash64(*keys).cast("string"))))
        rows = rows.join(lm.counts.select(F.col("token").alias("key"), "c").hint("merge"), "key", "left").withColumn("lp", F.when(F.col("__w").isNotNull(), lm.logprobs(F.col("c"))))
        sums = [s + F.coalesce(F.element_at("lp", i + 1), F.lit(0.0)) for i, s in enumerate(sums)]
    agg = rows.groupBy(*keys).agg(F.sum("__n").alias("n_tokens"), *[F.sum(s).alias(f"s{i}") for i, s in enumerate(sums)])
    raw = F.array(*[F.col(f"s{i}") / F.col("n_tokens") for i in range(len(lm.labels))])
    return agg.select(*keys, "n_tokens", F.when(F.col("n_tokens") > 0, raw).alias("raw"))


def perplexity(token_lp: DataFrame, id_col: str = "example_id", pos_col: str = "pos") -> DataFrame:
    """exp of the mean token loss per text, from stored token scores; the first token is not predicted."""
    predicted = F.col(pos_col) > 0
    return (token_lp.groupBy(id_col)
            .agg(F.sum(F.when(predicted, F.col("logprob"))).alias("s"), F.count_if(predicted).alias("n"))
            .select(id_col, S.perplexity_of(F.col("s"), F.col("n")).alias("perplexity")))


def count_perplexity(df: DataFrame, lm: CountLM, text_col: str = "text", id_col: str = "id", max_len: int = MAX_LEN,
                     broadcast_bytes: int = BROADCAST_BYTES, common: str = "") -> DataFrame:
    """Perplexity under a one-class count model of the first ``max_len`` tokens, the length limit of the evaluator.

    Texts of fewer than two tokens have none and come back null.
    """
    scored = count_lm_scores(df, lm, text_col, (id_col,), 1, max_len, broadcast_bytes, common)
    n = F.col("n_tokens")
    return scored.select(id_col, n.alias("n_predicted"), S.perplexity_of(F.element_at("raw", 1) * n, n).alias("perplexity"))
