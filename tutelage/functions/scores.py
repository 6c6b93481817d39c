"""Row-local score maths. Scores of one example are an ``array<double>`` in label order, so
calibration, argmax, softmax and margin need no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tutelage.functions.constants import LABELS

NEG_INF = float("-inf")


def token_logprob(logits: Column, target: Column) -> Column:
    """Log-softmax over ``logits``, taken at the 0-based ``target``."""
    wide = F.transform(logits, lambda x: x.cast("double"))
    top = F.array_max(wide)
    total = F.aggregate(wide, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    return F.element_at(wide, target.cast("int") + 1) - top - F.log(total)


def prior_array(prior: Mapping[str, float], labels: Sequence[str] = LABELS) -> Column:
    return F.array(*[F.lit(float(prior[lab])) for lab in labels])


def calibrated(raw: Column, prior: Column) -> Column:
    """Scores less priors. A label without a score stays at minus infinity whatever its prior; so does one whose score is not a number."""
    none = F.lit(NEG_INF)
    return F.zip_with(raw, prior, lambda r, p: F.when(r.isNull(), None).when(F.isnan(r) | (r == none), none).otherwise(r - F.when(p == none, F.lit(0.0)).otherwise(p)))


def with_bias(scores: Column, bias: Mapping[str, float], labels: Sequence[str] = LABELS) -> Column:
    """Add a constant per label before the argmax."""
    return F.zip_with(scores, F.array(*[F.lit(float(bias.get(lab, 0.0))) for lab in labels]), lambda s, b: s + b)


def argmax_label(scores: Column, labels: Sequence[str] = LABELS) -> Column:
    """Label of the highest score; a tie goes to the earlier label."""
    return F.element_at(F.array(*[F.lit(lab) for lab in labels]),
                        F.array_position(scores, F.array_max(scores)).cast("int"))


def softmax(scores: Column) -> Column:
    exps = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    total = F.aggregate(exps, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(exps, lambda e: e / total)


def top2_margin(scores: Column) -> Column:
    """Best minus second best; infinite when there is only one label."""
    ranked = F.sort_array(scores, asc=False)
    return F.when(F.size(ranked) > 1, F.element_at(ranked, 1) - F.try_element_at(ranked, F.lit(2))).otherwise(
        F.lit(float("inf")))


def as_map(scores: Column, labels: Sequence[str] = LABELS) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(lab) for lab in labels]), scores)


def perplexity_of(sum_logprob: Column, n: Column) -> Column:
    """exp of the mean token loss; null when nothing was predicted."""
    return F.when(n > 0, F.exp(-sum_logprob / n))
