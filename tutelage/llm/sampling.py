"""Document fingerprints by improved consistent weighted sampling.

A text is a set of weighted terms: its shingles of five words, by count (the whole sequence if it has fewer words), and
each of its words once at the small weight ``WORD``, so that a short text keeps some likeness when edited.

A sample of a term with weight w draws r and c of Gamma(2, 1) and b uniform from the term's hash alone; with
t = floor(ln w / r + b) its value is ln a = ln c - r (t - b) - r. The term of the least value is the sample, named by term
and t. Two texts agree in a sample with a probability equal to the generalised Jaccard similarity of their weights,
so the share of equal samples estimates it.

The draws start from three independent exponentials, which give the same joint distribution: the value x that the term has at
weight one, with c = x + y and r (1 - b) = ln(1 + y / x), and r b = z. A term of weight one, as nearly all are, needs
x alone, and x keeps the order of the hash it is made from; so does a single word, which never has another weight than ``WORD``: its value is x / ``WORD``.

Defined cases: null and empty texts have no terms and share one fingerprint, as do all texts of white space alone; equal texts
have equal fingerprints; repeated rows are kept, in the order of their texts; null ids come last; one
document is its own successor; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.llm.frames import materialise, utf8

SAMPLES, WIDTH, SEED = 64, 5, 42
#: Weight of a single word beside the shingles, in texts of any length.
WORD = 0.125
#: Terms drawn at a time; bytes hashed at a time.
CHUNK, BYTES = 512, 1 << 18

_rng = np.random.default_rng(SEED)
_KEYS = (_rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1))[:, None]
_SPACE = bytes(b in (9, 10, 11, 12, 13, 32) for b in range(256))
#: Powers of an odd base, and of its inverse, modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.full(BYTES + 1, _BASE, np.uint64))
_INVERSE = np.cumprod(np.full(BYTES + 1, pow(_BASE, -1, 1 << 64), np.uint64))
_PLACES = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(32))) * _PLACES[2]
    z ^= z >> np.uint64(29)
    z *= _PLACES[1]
    z ^= z >> np.uint64(32)
    return z


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word between ASCII white space, letters A-Z in lower case."""
    raw = np.frombuffer(text.lower(), np.uint8)
    space = np.frombuffer(b"\1" + text.translate(_SPACE) + b"\1", np.bool_)
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        last = max(at + 1, int(np.searchsorted(ends, starts[at] + BYTES, side="right")))
        a, b = int(starts[at]), int(ends[last - 1])
        if b - a > BYTES:  # one word longer than a piece
            out[at] = xxhash.xxh64_intdigest(text[a:b].lower(), SEED)
        else:
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum((raw[a:b] + np.uint64(1)) * _POWERS[:b - a], out=sums[1:])
            s, e = starts[at:last] - a, ends[at:last] - a
            out[at:last] = (sums[e] - sums[s]) * _INVERSE[s]
        at = last
    return _mixed(out)


def terms(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and weights of a text's terms, each hash once, in order."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.float32)
    width = min(n, WIDTH)
    marks = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        marks = (marks ^ (marks >> np.uint64(31))) * _PLACES[k] + words[k:n - width + 1 + k]
    marks = _mixed(marks)
    marks.sort()
    first = np.flatnonzero(np.r_[True, marks[1:] != marks[:-1]])
    single = np.unique(words)
    both = np.concatenate([marks[first], single])
    order = np.argsort(both, kind="stable")
    return both[order], np.concatenate([np.diff(np.r_[first, len(marks)]), np.full(len(single), WORD)]).astype(np.float32)[order]


def _exponential(z: np.ndarray) -> np.ndarray:
    return -np.log1p(-((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)


def signature(marks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``SAMPLES`` names of 16 bits: by sample, the term of the least value and its number t."""
    row = np.arange(SAMPLES)
    value, term, t = np.full(SAMPLES, np.inf), np.zeros(SAMPLES, np.uint64), np.zeros(SAMPLES, np.int64)

    def take(a: np.ndarray, some: np.ndarray, number: np.ndarray | int) -> None:
        less = a < value
        value[less], term[less] = a[less], some[less]
        t[less] = number[less] if isinstance(number, np.ndarray) else number

    other = np.flatnonzero((weights != 1) & (weights != WORD))
    for weight in (1, WORD):
        plain = marks[weights == weight]
        for at in range(0, len(plain), CHUNK):
            some = plain[at:at + CHUNK]
            z = _drawn(some)
            first = z.argmin(axis=1)
            take(_exponential(z[row, first]) / weight, some[first], 0)
    for at in range(0, len(other), CHUNK):
        some, log_w = marks[other[at:at + CHUNK]], np.log(weights[other[at:at + CHUNK]])
        h = _drawn(some)
        x, y, z = _exponential(h), _exponential(_mixed(h + _PLACES[3])), _exponential(_mixed(h + _PLACES[4]))
        r = np.log1p(y / x) + z
        step = np.floor(log_w / r + z / r)
        a = (x + y) * np.exp(z - r * step - r)
        first = a.argmin(axis=1)
        take(a[row, first], some[first], step[row, first].astype(np.int64))
    return (_mixed(term + t.astype(np.uint64) * _PLACES[3]) >> np.uint64(48)).astype(np.uint16)


def _drawn(marks: np.ndarray) -> np.ndarray:
    """A hash for each sample and term."""
    z = marks * _KEYS
    z ^= z >> np.uint64(32)
    z *= _PLACES[2]
    return z


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)``: the signature of each text, in hexadecimal."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [signature(*terms(t)).tobytes().hex() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", utf8("text").alias("text")).mapInArrow(run, schema)


def edited(text: str, successor: str) -> str:
    """The text with its last half replaced by as much of the successor's beginning, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + successor[:half]


def _ranges(docs: DataFrame) -> tuple[DataFrame, dict[int, int], int]:
    """Rows dealt into ranges of descending ids; the first row of each range goes to the range before it as well.

    Returns the rows with ``_range`` and ``_extra``, and for each range the one whose first row follows its last.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = 4 * parts  # several ranges to a task, so that two that meet in one weigh less
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull())
    cuts = ids.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n)) if n > 1 else []
    edges = F.array(*[F.lit(int(c)).cast("bigint") for c in sorted(set(cuts), reverse=True)]).cast("array<bigint>")
    at = F.when(F.col("doc_id").isNull(), F.lit(len(set(cuts)) + 1)).otherwise(F.size(F.filter(edges, lambda c: F.col("doc_id") < c)))
    placed = docs.select("doc_id", utf8("text").alias("text"), at.cast("int").alias("_range"))
    tops = {r["_range"]: r["top"] for r in placed.groupBy("_range").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(tops)
    before = {r: order[i - 1] for i, r in enumerate(order)}
    known = F.create_map(*[F.lit(x) for r in order for x in (r, before[r])]) if order else F.create_map().cast("map<int,int>")
    top = F.create_map(*[x for r in order for x in (F.lit(r), F.lit(tops[r]).cast("bigint"))]) if order else F.create_map().cast("map<int,bigint>")
    leads = F.col("doc_id").eqNullSafe(top[F.col("_range")])
    copies = F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("extra")))
    both = F.concat(copies, F.array(F.struct(known[F.col("_range")].alias("r"), F.lit(True).alias("extra"))))
    rows = placed.withColumn("_to", F.explode(F.when(leads, both).otherwise(copies)))
    return rows.select("doc_id", "text", F.col("_to.r").alias("_range"), F.col("_to.extra").alias("_extra")), before, parts


def edits(docs: DataFrame) -> DataFrame:
    """Each text and its edited form, fingerprinted, with the likeness of the first to the second and to the next document's.

    The next document is the next smaller id's, after the last the first. One shuffle brings each range of ids, in order, to a
    task, with the row that follows its last; a task holds two texts at a time.
    """
    docs = docs.select("doc_id", "text")
    rows, _, n = _ranges(docs)
    key = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", key), T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                           *[T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")]])
    dealt = rows.repartition(n, "_range").sortWithinPartitions("_range", F.col("_extra").asc(), F.col("doc_id").desc_nulls_last(), "text")

    types = [*docs.select("doc_id").limit(0).toArrow().schema.types, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # of the row whose successor comes next: range, id, text, signature
        for batch in batches:
            out: list[tuple] = []
            for where, extra, key, text in zip(*[batch.column(c).to_pylist() for c in ("_range", "_extra", "doc_id", "text")], strict=True):
                if before and before[0] == where:
                    own = signature(*terms(text))
                    out.append(_row(*before[1:], text, own))
                elif before:
                    raise RuntimeError("a range of ids has no row after its last")
                elif not extra:
                    own = signature(*terms(text))
                before = None if extra else (where, key, text, own)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=schema.fieldNames())
        if before:
            raise RuntimeError("a range of ids has no row after its last")

    return dealt.mapInArrow(run, schema)


def _row(key, raw: bytes, own: np.ndarray, following: bytes, nearby: np.ndarray) -> tuple:
    text = raw.decode("utf-8", "replace")
    changed = edited(text, following.decode("utf-8", "replace")).encode("utf-8", "replace")
    new = signature(*terms(changed))
    return (key, len(text), hashlib.sha256(changed).hexdigest(), own.tobytes().hex(), new.tobytes().hex(), likeness(own, new), likeness(own, nearby))
