"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly.

A word is the bag of its character n-grams and itself, each hashed to a row of one embedding table; a document is the
mean of its words' vectors, and a softmax over it gives the classes. Table and softmax are trained together by
gradient descent in numpy on a bounded, balanced sample of labelled documents. An unseen misspelling shares most
n-grams with the word it hides, and so its vector. Since all of it is a mean before a linear layer, scoring
needs one number per word; workers remember those.

Defined cases: null and empty texts, and texts without words, score by the bias alone; repeated rows are each
scored; with labels of one class or none, every score is one half; other columns are left out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.llm.frames import batched, free, materialise, utf8

BUCKETS, DIM = 1 << 22, 8
#: Standard errors by which a row's share of documents must differ between the classes to be trained: the first, or what does best over ``FOLDS`` of the sample.
CONTRASTS = (5.0, 4.0, 3.5, 3.0)
FOLDS = 3
#: Documents of a class needed to choose between contrasts.
LEAST_TO_CHOOSE = 150
#: The sample trained on has at most so many documents of each class.
TRAIN_PER_CLASS = 2500
#: Words that a worker takes up before it lets go those not met since as many before.
CACHE_WORDS = 1 << 17
#: Documents that must have a row before it is trained.
LEAST_HELD = 3
#: Rows of the embedding table trained at most.
MOST_ROWS = 4096
_TABLE = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def subwords(word: bytes) -> list[int]:
    """Rows of the word itself and of its n-grams of 3 to 5 characters, with marks at its ends."""
    marked = f"<{word.decode('utf-8', 'replace')}>"
    grams = [marked] + [marked[i:i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode()) & (BUCKETS - 1) for g in grams]


@dataclass
class Model:
    """Log-odds of a document: ``bias`` and the mean over its words of the mean of ``weight`` (zero for rows not in it) over their subwords."""
    weight: dict[int, float]
    bias: float
    known: dict[bytes, float] = field(default_factory=dict, repr=False)
    before: dict[bytes, float] = field(default_factory=dict, repr=False)

    def score(self, text: bytes) -> float:
        found = words(text)
        if len(self.known) >= CACHE_WORDS:
            self.before, self.known = self.known, {}
        known, total = self.known, 0.0
        for w in found:
            s = known.get(w)
            if s is None:
                s = self.before.get(w)
                if s is None:
                    rows = subwords(w)
                    s = sum(self.weight.get(r, 0.0) for r in rows) / len(rows)
                known[w] = s
            total += s
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + total / max(1, len(found)), -30.0, 30.0)))

    def __getstate__(self):
        return {"weight": self.weight, "bias": self.bias, "known": {}, "before": {}}


def bag(text: bytes) -> dict[int, float]:
    """The rows of a text with their shares: the mean over its words of the mean over their subwords."""
    out: dict[int, float] = {}
    count = Counter(words(text))
    total = sum(count.values())
    for w, n in count.items():
        rows = subwords(w)
        share = n / (total * len(rows))
        for row in rows:
            out[row] = out.get(row, 0.0) + share
    return out


def fold(text: bytes) -> int:
    return zlib.crc32(text) % FOLDS


def held(texts: list[bytes], labels: np.ndarray) -> Counter:
    """By fold, class and row: how many texts have it."""
    out: Counter = Counter()
    for text, y in zip(texts, labels, strict=True):
        f = fold(text)
        out.update((f, int(y), row) for row in bag(text))
    return out


def table_of(fold: np.ndarray, y: np.ndarray, row: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The occupied rows, and their counts by fold and class."""
    rows, at = np.unique(row, return_inverse=True)
    counts = np.zeros((FOLDS, 2, len(rows)), np.int64)
    counts[fold, y, at] = n
    return rows, counts


def contrasting(counts: np.ndarray, many: np.ndarray, least: float = CONTRASTS[0], most: int = MOST_ROWS) -> np.ndarray:
    """Rows that occur in one class's documents more often than in the other's by ``least`` standard errors, the ``most`` clearest."""
    if not many.all():
        return np.empty(0, np.int64)
    share = counts.sum(axis=0) / many.sum()
    error = np.sqrt(share * (1 - share) * (1 / many).sum()) + 1e-12
    clear = np.abs(counts[1] / many[1] - counts[0] / many[0]) / error
    clear[counts.sum(axis=0) < LEAST_HELD] = 0
    chosen = np.argsort(-clear, kind="stable")[:most]
    return np.sort(chosen[clear[chosen] >= least])


def candidates(rows: np.ndarray, counts: np.ndarray, many: np.ndarray) -> dict[tuple[int, float], np.ndarray]:
    """The contrasting rows by contrast, of the whole sample (fold -1) and without each fold; ``many``: documents by fold and class."""
    some = CONTRASTS if many.sum(axis=0).min() >= LEAST_TO_CHOOSE else CONTRASTS[:1]
    whole, sizes = counts.sum(axis=0), many.sum(axis=0)
    out = {(-1, c): rows[contrasting(whole, sizes, c)] for c in some}
    return out | {(f, c): rows[contrasting(whole - counts[f], sizes - many[f], c)] for f in range(FOLDS) for c in some if len(some) > 1}


def _part(x: np.ndarray, inside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The columns ``at`` of the rows ``inside``, without a copy of whole rows."""
    return x.T[np.ix_(at, np.flatnonzero(inside))].T


def chosen_model(x: np.ndarray, labels: np.ndarray, folds: np.ndarray, rows: np.ndarray, sets: dict[tuple[int, float], np.ndarray]) -> Model:
    """Trained on the whole sample under the contrast of the least loss, classes weighing the same, on folds not trained on. ``x``: the shares of ``rows``."""
    losses = {}
    for c in {c for _, c in sets} if len(sets) > 1 else ():
        loss = np.zeros(len(labels))
        for f in range(FOLDS):
            inside, own = folds != f, sets[f, c]
            at = np.searchsorted(rows, own)
            model = train(_part(x, inside, at), labels[inside], own)
            odds = _part(x, ~inside, at) @ np.array([model.weight[r] for r in own.tolist()], np.float32) + model.bias if len(own) else np.full((~inside).sum(), model.bias)
            loss[~inside] = np.logaddexp(0, np.where(labels[~inside] == 1, -odds, odds))
        losses[c] = loss[labels == 1].mean() + loss[labels == 0].mean()
    best = min(losses, key=lambda c: (losses[c], -c)) if losses else CONTRASTS[0]
    own = sets[-1, best]
    return train(x[:, np.searchsorted(rows, own)], labels, own)


def shares(texts: list[bytes], chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text the places in ``chosen`` of the rows that it has, and their shares."""
    place = {row: k for k, row in enumerate(chosen.tolist())}
    for text in texts:
        own = bag(text)
        some = list(own.keys() & place.keys())
        yield np.array([place[row] for row in some], np.int32), np.array([own[row] for row in some], np.float32)


def vectors(found: Iterable[tuple[np.ndarray, np.ndarray]], many: int, wide: int) -> np.ndarray:
    """``shares`` of ``many`` texts as rows of ``wide`` numbers."""
    out = np.zeros((many, wide), np.float32)
    for row, (at, share) in zip(out, found, strict=True):
        row[at] = share
    return out


def train(x: np.ndarray, labels: np.ndarray, chosen: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.01, decay: float = 0.01, seed: int = 1) -> Model:
    """Embeddings of the chosen rows and softmax fitted jointly by Adam; classes weigh the same.

    The other rows stay at zero: with more n-grams than documents, they would only be learnt by heart. ``x`` is changed.
    """
    if not len(chosen):
        return Model({}, 0.0)
    unit = np.float32(500.0 / np.sqrt(len(chosen)))  # brings the shares of a document to about one
    x *= unit
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.1, (len(chosen), DIM)).astype(np.float32), rng.normal(0, 0.5, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)]
    table, soft, bias = params
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weigh = (len(labels) / (2.0 * np.bincount(labels, minlength=2)))[labels].astype(np.float32)
    step = 0
    for _ in range(max(epochs, 2000 * batch // len(labels) // 10)):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            mean = x[rows] @ table
            logits = mean @ soft + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1.0
            p *= (weigh[rows] / len(rows))[:, None]
            step += 1
            size = rate * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for q, g, m, v in zip(params, [x[rows].T @ (p @ soft.T), mean.T @ p, p.sum(axis=0)], first, second, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                q -= (size * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
            table *= 1 - decay
    weight = unit * (table @ (soft[:, 1] - soft[:, 0]))
    return Model(dict(zip(chosen.tolist(), weight.tolist(), strict=True)), float(bias[1] - bias[0]))


def learnable(labels: DataFrame, label: str) -> DataFrame:
    """``(doc_id, y)``: one label of each document outside the fold that is held out (crc32 of the id, modulo 3, is 1)."""
    kept = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    return kept.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_texts(texts: list[bytes], labels: np.ndarray) -> Model:
    """``fit`` for a handful of texts at hand."""
    labels, folds = np.asarray(labels, dtype=np.int64), np.array([fold(t) for t in texts])
    found = held(texts, labels)
    keys = np.array(list(found), np.int64).reshape(-1, 3)
    many = np.zeros((FOLDS, 2), np.int64)
    np.add.at(many, (folds, labels), 1)
    sets = candidates(*table_of(*keys.T, np.fromiter(found.values(), np.int64)), many)
    rows = np.unique(np.concatenate(list(sets.values())))
    return chosen_model(vectors(shares(texts, rows), len(texts), len(rows)), labels, folds, rows, sets)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = TRAIN_PER_CLASS) -> Model:
    """Train on the ``per_class`` documents of each class whose hashed ids are lowest.

    Their bags are made in tasks; the driver gets the counts of each row that enough documents have, then the shares of the chosen rows for each document.
    """
    known = learnable(labels, label)
    def lowest(y: int) -> DataFrame:
        return known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    picked = F.broadcast(materialise(lowest(0).union(lowest(1)), "picked"))
    sample = materialise(docs.select("doc_id", utf8("text").alias("text")).join(picked, "doc_id").select("text", "y"), "sample")
    sample = sample.repartition(max(1, min(64, sample.count() // 100)), F.xxhash64("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            total.update(held(b.column(0).to_pylist(), b.column(1).to_numpy()))
        keys = np.array(list(total), np.int32).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([*[pa.array(np.ascontiguousarray(k)) for k in keys.T], pa.array(np.fromiter(total.values(), np.int64))], names=["fold", "y", "row", "n"])

    many = np.zeros((FOLDS, 2), np.int64)
    for r in sample.groupBy((F.crc32("text") % FOLDS).cast("int").alias("fold"), "y").count().collect():
        many[r["fold"], r["y"]] = r["count"]
    if not many.sum(axis=0).all():
        return Model({}, 0.0)
    cells = [(f, y) for f in range(FOLDS) for y in (0, 1)]
    sums = [F.sum(F.when((F.col("fold") == f) & (F.col("y") == y), F.col("n")).otherwise(0)).cast("int").alias(f"n{f}{y}") for f, y in cells]
    counted = sample.mapInArrow(count, "fold int, y int, row int, n bigint").groupBy("row").agg(*sums, F.sum("n").alias("n"))
    found = counted.filter(F.col("n") >= LEAST_HELD).drop("n").toArrow().sort_by("row")
    counts = np.stack([found.column(f"n{f}{y}").to_numpy() for f, y in cells]).astype(np.int64).reshape(FOLDS, 2, -1)
    sets = candidates(found.column("row").to_numpy(), counts, many)
    del found, counts  # the driver holds either the counts or the vectors
    rows = np.unique(np.concatenate(list(sets.values())))
    if not len(rows):
        return Model({}, 0.0)

    def vector(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(0).to_pylist()
        at, share = zip(*shares(texts, rows), strict=True) if texts else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32())), batch.column(1), pa.array([fold(t) for t in texts], pa.int32())],
                                          names=["at", "share", "y", "fold"])

    got = batched(sample, vector, "at array<int>, share array<float>, y int, fold int").toArrow()
    y, folds = got.column("y").to_numpy().astype(np.int64), got.column("fold").to_numpy()
    at, share = got.column("at").combine_chunks(), got.column("share").combine_chunks()
    ends, at, share = at.offsets.to_numpy(), at.values.to_numpy(), share.values.to_numpy()
    found = [(at[a:b], share[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    marks = [hashlib.blake2b(vectors([v], 1, len(rows))).digest() for v in found]
    order = sorted(range(len(y)), key=lambda i: (y[i], folds[i], marks[i]))  # the same order however the rows came: what ties is equal
    x = vectors([found[i] for i in order], len(order), len(rows))
    del got, at, share, found
    return chosen_model(x, y[order], folds[order], rows, sets)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), out: str = "score") -> DataFrame:
    """``keep`` of every row and its toxicity from 0 to 1."""
    keep = tuple(c for c in keep if c != out)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(out, T.DoubleType())])
    sent, read = docs.sparkSession.sparkContext.broadcast(model), free(keep, "_text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [sent.value.score(t) for t in batch.column(read).to_pylist()]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(scores, pa.float64())], names=[*keep, out])

    return batched(docs.select(*[F.col(f"`{c}`") for c in keep], utf8("text").alias(read)), run, schema)
