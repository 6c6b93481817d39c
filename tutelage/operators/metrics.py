"""Classification metrics, comparison, margins and drift.

Every report starts from one pass of conditional counts (confusion cells), which are aggregated
on the map side; the rest is arithmetic on as many rows as there are models and labels.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tutelage.functions.constants import LABELS
from tutelage.operators.quantiles import exact_percentiles


def accuracy(df: DataFrame, true_col: str = "answer", pred_col: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    hit = F.coalesce(F.col(true_col) == F.col(pred_col), F.lit(False)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count("*").alias("n"))


class _Counts:
    """Confusion counts of each group side by side in one row, and the metrics as expressions on that row."""

    def __init__(self, df: DataFrame, labels: Sequence[str], true_col: str, pred_col: str, by: Sequence[str]):
        self.labels, self.by = tuple(labels), tuple(by)
        t, p = F.col(true_col), F.col(pred_col)
        cells = [F.count_if((t == a) & (p == b)).alias(f"c{i}_{j}") for i, a in enumerate(labels) for j, b in enumerate(labels)]
        hits = F.count_if(t == p).alias("hits")
        self.rows = df.groupBy(*by).agg(F.count("*").alias("total"), hits, *cells)

    def cell(self, i: int, j: int) -> Column:
        return F.col(f"c{i}_{j}")

    def _sum(self, columns: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a + b, columns)

    def support(self, i: int) -> Column:
        return self._sum([self.cell(i, j) for j in range(len(self.labels))])

    def precision(self, i: int) -> Column:
        return _ratio(self.cell(i, i), self._sum([self.cell(j, i) for j in range(len(self.labels))]))

    def recall(self, i: int) -> Column:
        return _ratio(self.cell(i, i), self.support(i))

    def f1(self, i: int) -> Column:
        return _ratio(2 * self.cell(i, i), self.support(i) + self._sum([self.cell(j, i) for j in range(len(self.labels))]))

    def macro(self, metric: str) -> Column:
        return self._sum([getattr(self, metric)(i) for i in range(len(self.labels))]) / len(self.labels)

    def weighted(self, metric: str) -> Column:
        weighed = [getattr(self, metric)(i) * self.support(i) for i in range(len(self.labels))]
        return _ratio(self._sum(weighed), self.known())

    def known(self) -> Column:
        return self._sum([self.support(i) for i in range(len(self.labels))])

    def accuracy(self) -> Column:
        return _ratio(F.col("hits"), F.col("total"))

    def class_rows(self) -> list[Column]:
        return [_report_row(lab, self.precision(i), self.recall(i), self.f1(i), self.support(i)) for i, lab in enumerate(self.labels)]

    def select(self, rows: Sequence[Column]) -> DataFrame:
        return self.rows.select(*self.by, F.inline(F.array(*rows)))


def _report_row(label: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
    return F.struct(F.lit(label).alias("label"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), support.alias("support"))


def confusion(df: DataFrame, labels: Sequence[str] = LABELS, true_col: str = "answer", pred_col: str = "prediction",
              by: Sequence[str] = ()) -> DataFrame:
    """``(y_true, y_pred, n)`` for every pair of labels, zeros kept, in label order."""
    c = _Counts(df, labels, true_col, pred_col, by)
    return c.select([F.struct(F.lit(a).alias("y_true"), F.lit(b).alias("y_pred"), c.cell(i, j).alias("n"))
                     for i, a in enumerate(labels) for j, b in enumerate(labels)])


def confusion_table(cells: DataFrame, labels: Sequence[str] = LABELS, by: Sequence[str] = ()) -> DataFrame:
    """Confusion cells as a matrix: a row per true label, a column per predicted one."""
    return cells.groupBy(*by, "y_true").pivot("y_pred", list(labels)).sum("n")


def class_report(df: DataFrame, labels: Sequence[str] = LABELS, true_col: str = "answer", pred_col: str = "prediction",
                 by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per label; 0/0 is 0."""
    c = _Counts(df, labels, true_col, pred_col, by)
    return c.select(c.class_rows())


def macro_avg(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted means over the labels of a class report."""
    return report.groupBy(*by).agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                                   F.avg("f1").alias("f1"), F.sum("support").alias("support"))


def weighted_avg(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Means over a class report, weighted by support."""
    mean = lambda m: _ratio(F.sum(F.col(m) * F.col("support")), F.sum("support"))
    return report.groupBy(*by).agg(*[mean(m).alias(m) for m in ("precision", "recall", "f1")], F.sum("support").alias("support"))


def full_report(df: DataFrame, labels: Sequence[str] = LABELS, true_col: str = "answer", pred_col: str = "prediction",
                by: Sequence[str] = ()) -> DataFrame:
    """Class rows, then accuracy, macro and weighted averages, all from one pass over the predictions."""
    c = _Counts(df, labels, true_col, pred_col, by)
    none = F.lit(None).cast("double")
    averages = [_report_row(name, *[mean(m) for m in ("precision", "recall", "f1")], c.known())
                for name, mean in (("macro avg", c.macro), ("weighted avg", c.weighted))]
    return c.select([*c.class_rows(), _report_row("accuracy", none, none, c.accuracy(), F.col("total")), *averages])


def summary(df: DataFrame, labels: Sequence[str] = LABELS, true_col: str = "answer", pred_col: str = "prediction",
            by: Sequence[str] = ()) -> DataFrame:
    """One row per group: accuracy, number of rows, macro averages."""
    c = _Counts(df, labels, true_col, pred_col, by)
    return c.rows.select(*by, c.accuracy().alias("accuracy"), F.col("total").alias("n"),
                         *[c.macro(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")])


def label_counts(df: DataFrame, true_col: str = "answer", pred_col: str = "prediction") -> DataFrame:
    """``(side, label, n)``: how often each label is the truth and how often it is predicted."""
    sides = F.array(F.struct(F.lit("true").alias("side"), F.col(true_col).alias("label")),
                    F.struct(F.lit("pred").alias("side"), F.col(pred_col).alias("label")))
    return df.select(F.inline(sides)).groupBy("side", "label").agg(F.count("*").alias("n"))


def compare_models(df: DataFrame, base: str, model_col: str = "model", true_col: str = "answer",
                   pred_col: str = "prediction", labels: Sequence[str] = LABELS) -> DataFrame:
    """Accuracy and macro averages per model, with the difference to the base model.

    Only the per-model summary (a row per model) meets in a window.
    """
    each = summary(df, labels, true_col, pred_col, (model_col,))
    of_base = lambda m: F.max(F.when(F.col(model_col) == base, F.col(m))).over(W.partitionBy(F.lit(0)))
    return each.withColumn("delta_accuracy", F.col("accuracy") - of_base("accuracy")).withColumn(
        "delta_macro_f1", F.col("macro_f1") - of_base("macro_f1"))


def margin_distribution(df: DataFrame, probs: Sequence[float] = (0.05, 0.5, 0.95), margin_col: str = "top2_margin",
                        by: str | None = None) -> DataFrame:
    """Exact percentiles of the margin, overall or per class."""
    return exact_percentiles(df, margin_col, probs, by)


def margin_histogram(df: DataFrame, low: float, high: float, n: int, margin_col: str = "top2_margin",
                     by: Sequence[str] = ()) -> DataFrame:
    """Rows per equal-width bucket; bucket 0 is below ``low``, bucket n + 1 from ``high`` on."""
    bucket = F.width_bucket(F.col(margin_col), F.lit(float(low)), F.lit(float(high)), F.lit(n))
    return df.groupBy(*by, bucket.alias("bucket")).agg(F.count("*").alias("n"))


def slice_drift(df: DataFrame, current: Column, label_col: str = "prediction") -> DataFrame:
    """Share of each class in a later slice (``current``) against the rest, and the difference.

    One pass; a class missing on one side has share 0. The window holds one row per class.
    """
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count_if(~current).alias("b"), F.count_if(current).alias("c"))
    share = lambda n: _ratio(F.col(n), F.sum(n).over(W.partitionBy(F.lit(0))))
    shares = counts.select("label", share("b").alias("baseline_share"), share("c").alias("current_share"))
    return shares.withColumn("drift", F.col("current_share") - F.col("baseline_share"))


def class_drift(baseline: DataFrame, current: DataFrame, label_col: str = "prediction") -> DataFrame:
    """``slice_drift`` of two frames."""
    both = baseline.select(label_col, F.lit(False).alias("later")).unionByName(current.select(label_col, F.lit(True).alias("later")))
    return slice_drift(both, F.col("later"), label_col)


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
