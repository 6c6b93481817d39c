"""A linear student fitted by a fixed number of full-batch gradient steps, each a sum that SQL can repeat.

Words are hashed to features; a row's features are shares of its words. A step sums, over all rows, feature
share times (predicted probability - one for the row's label). Tasks add up their own rows, one row of each feature and task is aggregated, and at most
``n_features`` sums reach the driver, where the weights are moved. Nothing is sampled or shuffled by row, so a step costs one scan, and
a repeated task adds the same numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutelage.functions.constants import LABELS, SAMPLE_SEED, STUDENT_MAX_LEN
from tutelage.functions.text import first_words, token_id, tokens
from tutelage.operators.sampling import split_column
from tutelage.session import materialise

N_FEATURES = 1 << 10


@dataclass
class StepStudent:
    """``weights``: features by labels; the last row is the bias."""

    weights: np.ndarray
    labels: tuple[str, ...]
    max_len: int = STUDENT_MAX_LEN

    def frame(self, spark: SparkSession) -> DataFrame:
        """``(feature, label, weight)``; feature -1 is the bias."""
        n = len(self.weights) - 1
        rows = [(i if i < n else -1, lab, float(w)) for i, own in enumerate(self.weights) for lab, w in zip(self.labels, own, strict=True)]
        return spark.createDataFrame(rows, "feature int, label string, weight double")

    def predict(self, df: DataFrame, text_col: str = "question") -> DataFrame:
        """Adds ``prediction``, the label of the highest score; a tie goes to the earlier label."""
        rows = df.withColumn("__f", features(text_col, len(self.weights) - 1, self.max_len))
        schema = T.StructType([*df.schema.fields, T.StructField("prediction", T.StringType())])
        weights, labels = self.weights, np.array(self.labels, dtype=object)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                best = labels[_logits(weights, *_flat(b.column("__f"))).argmax(axis=1)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(best, pa.string())], names=schema.fieldNames())

        return rows.mapInArrow(run, schema)


def features(text_col: str, n_features: int, max_len: int = STUDENT_MAX_LEN) -> Column:
    """The feature of each of the first ``max_len`` words, repeated ones repeated."""
    return F.transform(F.coalesce(tokens(first_words(text_col, max_len)), F.array().cast("array<string>")), lambda t: token_id(t, n_features))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All features of a batch in a row, and the number of each row's."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _logits(weights: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sizes), weights.shape[1]))
    row = np.repeat(np.arange(len(sizes)), sizes)
    np.add.at(out, row, weights[flat])
    return out / np.maximum(sizes, 1)[:, None] + weights[-1]


def gradient(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, int]:
    """The summed gradient of the softmax loss at ``weights`` and the number of rows ``(f, y)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(weights.shape), 0
        for b in batches:
            (flat, sizes), y = _flat(b.column(0)), b.column(1).to_numpy()
            z = _logits(weights, flat, sizes)
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1.0
            row = np.repeat(np.arange(len(y)), sizes)
            np.add.at(total, flat, (p / np.maximum(sizes, 1)[:, None])[row])
            total[-1] += p.sum(axis=0)
            n += len(y)
        own = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array([*own.tolist(), -1], pa.int32()), pa.array([*total[own].tolist(), [float(n)]], pa.list_(pa.float64()))], names=["i", "g"])

    k = weights.shape[1]
    sums = rows.select("f", "y").mapInArrow(run, "i int, g array<double>").groupBy("i").agg(F.array(*[F.sum(F.try_element_at("g", F.lit(c + 1))) for c in range(k)]).alias("g"))
    out, n = np.zeros(weights.shape), 0
    for r in sums.collect():  # a row a feature
        if r["i"] < 0:
            n = int(r["g"][0])
        else:
            out[r["i"]] = r["g"]
    return out, n


def fit_steps(df: DataFrame, text_col: str = "question", label_col: str = "teacher_label", rounds: int = 20, rate: float = 5.0, penalty: float = 1e-3,
              n_features: int = N_FEATURES, test_frac: float = 0.2, seed: int = SAMPLE_SEED, max_len: int = STUDENT_MAX_LEN,
              labels: Sequence[str] = LABELS) -> tuple[StepStudent, DataFrame]:
    """The student and the rows it was not shown (exactly ``ceil(test_frac * n)`` of those with a known label)."""
    marked = split_column(df.filter(F.col(label_col).isin(*labels)), test_frac, seed)
    place = F.array_position(F.array(*[F.lit(lab) for lab in labels]), F.col(label_col)).cast("int") - 1
    train = materialise(marked.filter(F.col("split") == "train").select(features(text_col, n_features, max_len).alias("f"), place.alias("y")), "student-rows")
    weights = np.zeros((n_features + 1, len(labels)))
    for _ in range(rounds):
        g, n = gradient(train, weights)
        weights -= rate * (g / max(n, 1) + penalty * np.vstack([weights[:-1], np.zeros(len(labels))]))
    return StepStudent(weights, tuple(labels), max_len), marked.filter(F.col("split") == "test").drop("split")
