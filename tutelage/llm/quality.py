"""Quality by a regularised quadratic discriminant over document statistics.

Each text gives a dozen and a half statistics (lengths, shares of kinds of characters, repetition), transformed towards normal
shape. Each class has a mean and a covariance, shrunk towards the pooled one and that towards its diagonal; a score is
the difference of two Gaussian log-densities, by Mahalanobis distances from Cholesky factors computed once. Means and
covariances come from sums that tasks add up over all labelled documents, so there is no sample.

Defined cases: null and empty texts have the statistics of an empty text; repeated rows are each scored; with one class
only, or none, every score is one half; other columns are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.llm.frames import batched, materialise, utf8
from tutelage.llm.toxicity import learnable

#: Shrinkage of a class covariance towards the pooled one, and of both towards the diagonal.
TOWARDS_POOLED, TOWARDS_DIAGONAL = 0.1, 0.1

NAMES = ("chars", "words", "word_length", "word_spread", "upper", "digits", "space", "stops", "marks", "bars", "beyond_ascii",
         "distinct", "repeats", "commonest", "cycles", "lines", "repeated_lines", "shouted")


def _share(n: float, of: float) -> float:
    return float(np.sqrt(n / of)) if of else 0.0


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of a text, in the order of ``NAMES``."""
    n = len(text)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    found = text.split()
    sizes = np.fromiter(map(len, found), np.float64, len(found))
    kinds = Counter(found)
    lines = [x for x in text.split(b"\n") if x]
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    stops = int(count[[44, 46]].sum())
    marks = int(count[33:48].sum()) + int(count[58:65].sum()) + int(count[91:97].sum()) + int(count[123:127].sum()) - stops - int(count[124])
    again = sum(a == b for a, b in zip(found, found[1:], strict=False))
    triples = list(zip(found, found[1:], found[2:], strict=False))
    return [float(np.log1p(n)), float(np.log1p(len(found))), float(np.log1p(sizes.mean())) if found else 0.0, float(np.log1p(sizes.std())) if found else 0.0,
            _share(upper, upper + lower), _share(int(count[48:58].sum()), n), _share(int(count[[9, 10, 13, 32]].sum()), n), _share(stops, n), _share(marks, n),
            _share(int(count[124]), n), _share(int(count[128:].sum()), n), _share(len(kinds), len(found)), _share(again, len(found)),
            _share(max(kinds.values(), default=0), len(found)), _share(len(triples) - len(set(triples)), len(triples)),
            float(np.log1p(len(lines))), _share(len(lines) - len(set(lines)), len(lines)), _share(sum(w.isupper() and len(w) > 3 for w in found), len(found))]


def features(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)``: the statistics of every text."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [statistics(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return batched(docs.select("doc_id", utf8("text").alias("text")), run, schema)


def _moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """By class: number, sum and sum of outer products of the statistics."""
    p = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + p + p * p))
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), dtype=np.float64).reshape(-1, p)
            y = batch.column("y").to_numpy()
            for k in (0, 1):
                own = x[y == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        k, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(total[k, at])], names=["k", "at", "v"])

    total = np.zeros((2, 1 + p + p * p))
    for r in labelled.mapInArrow(run, "k int, at int, v double").groupBy("k", "at").agg(F.sum("v").alias("v")).collect():
        total[r["k"], r["at"]] = r["v"]
    return {k: (t[0], t[1:1 + p], t[1 + p:].reshape(p, p)) for k, t in enumerate(total)}


@dataclass
class Discriminant:
    """Per class: mean, inverse Cholesky factor of the covariance, log-determinant and log-prior."""
    parts: list[tuple[np.ndarray, np.ndarray, float, float]]
    centre: np.ndarray
    scale: np.ndarray

    @classmethod
    def of(cls, moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> "Discriminant":
        p, all_n = len(NAMES), sum(m[0] for m in moments.values())
        if min(m[0] for m in moments.values()) < 2:
            return cls([], np.zeros(p), np.ones(p))
        centre = sum(m[1] for m in moments.values()) / all_n
        scale = np.sqrt(np.maximum(np.diag(sum(m[2] for m in moments.values()) / all_n) - centre ** 2, 1e-6))
        means, covs = {}, {}
        for k, (n, s, ss) in moments.items():
            m = s / n
            means[k] = (m - centre) / scale
            covs[k] = (ss / n - np.outer(m, m)) / np.outer(scale, scale)
        pooled = sum(moments[k][0] * covs[k] for k in moments) / all_n
        parts = []
        for k, (n, _, _) in sorted(moments.items()):
            cov = (1 - TOWARDS_POOLED) * covs[k] + TOWARDS_POOLED * pooled
            cov = (1 - TOWARDS_DIAGONAL) * cov + TOWARDS_DIAGONAL * np.diag(np.diag(cov)) + 1e-3 * np.eye(p)
            factor = np.linalg.cholesky(cov)
            parts.append((means[k], np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum()), float(np.log(n / all_n))))
        return cls(parts, centre, scale)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.parts:
            return np.full(len(x), 0.5)
        z = (x - self.centre) / self.scale
        low, high = (prior - 0.5 * (logdet + (((z - mean) @ inverse.T) ** 2).sum(axis=1)) for mean, inverse, logdet, prior in self.parts)
        return 1.0 / (1.0 + np.exp(-np.clip(high - low, -30, 30)))


def fit(found: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    return Discriminant.of(_moments(found.join(learnable(labels, label), "doc_id").filter(F.col("y").isin(0, 1)).select("x", "y")))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``(doc_id, score)`` of every row: how likely its quality label is 1."""
    found = materialise(features(docs), "statistics")
    model = fit(found, labels, label)
    schema = T.StructType([found.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array(batch.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(NAMES))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return batched(found, run, schema)
