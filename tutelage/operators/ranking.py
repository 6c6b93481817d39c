"""Label ranking: token log-probabilities to a calibrated prediction.

Input is ``token_scores(example_id, label, variant, pos, logprob)``. One aggregate brings it to a
row per example; everything after that is row-local array maths (``functions.scores``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutelage.functions import scores as S
from tutelage.functions.constants import LABELS, NULL_FEATURES
from tutelage.functions.templates import credit_chat_prompt
from tutelage.operators.joins import join_lookup

VARIANTS = (" ", "")


#: Names of each label by which it may be asked for; the label itself is one only if it is listed.
Synonyms = Mapping[str, Sequence[str]]
ACROSS = ("max", "mean", "logsum")


def expand_candidates(df: DataFrame, labels: Sequence[str] = LABELS, variants: Sequence[str] = VARIANTS, synonyms: Synonyms | None = None) -> DataFrame:
    """Every example once per label and variant (variant 0 has a leading space): a generator, no join.

    With ``synonyms`` once per label, synonym and variant; ``synonym`` names it.
    """
    named = {lab: (lab,) for lab in labels} if synonyms is None else synonyms
    cells = [F.struct(F.lit(lab).alias("label"), *([] if synonyms is None else [F.lit(name).alias("synonym")]), F.lit(v).alias("variant"), F.lit(lead + name).alias("candidate"))
             for lab in labels for name in named[lab] for v, lead in enumerate(variants)]
    return df.select("*", F.inline(F.array(*cells)))


def null_features(df: DataFrame, nulls: Sequence[str] = NULL_FEATURES) -> DataFrame:
    """The content-free inputs and their prompts, once per row of ``df`` (say, per model).

    The list is used as it stands: the empty text is asked as a space, which then counts twice.
    """
    cells = [F.struct(F.lit(i).alias("null_id"), F.lit(t if t != "" else " ").alias("features"))
             for i, t in enumerate(nulls)]
    return df.select("*", F.inline(F.array(*cells))).withColumn("prompt", credit_chat_prompt("features"))


def sequence_score(token_scores: DataFrame, keys: Sequence[str] = ("example_id", "label", "variant")) -> DataFrame:
    """Mean token log-probability per candidate; a candidate without tokens has no row."""
    return (token_scores.filter(F.col("logprob").isNotNull()).groupBy(*keys)
            .agg((F.sum("logprob") / F.count("logprob")).alias("score"), F.count("logprob").alias("n_tokens")))


def best_variant(sequence_scores: DataFrame, how: str = "max", labels: Sequence[str] = LABELS,
                 keys: Sequence[str] = ("example_id",)) -> DataFrame:
    """``raw``: per example the best (or the mean) score of each label's variants, in label order.

    Variants may as well be synonyms of the label. A label without any score gets -inf.
    """
    pick = {"max": F.max, "mean": F.avg}[how]
    raw = [F.coalesce(pick(F.when(F.col("label") == lab, F.col("score"))), F.lit(S.NEG_INF)) for lab in labels]
    return sequence_scores.groupBy(*keys).agg(F.array(*raw).alias("raw"))


def raw_scores(token_scores: DataFrame, how: str = "max", labels: Sequence[str] = LABELS,
               variants: Sequence[int] = (0, 1), keys: Sequence[str] = ("example_id",)) -> DataFrame:
    """``best_variant(sequence_score(...))`` in a single shuffle.

    Sums and counts of every (label, variant) are aggregated side by side, so each map task sends
    one row per example, however many tokens an example has.
    """
    lp = F.col("logprob")
    cell = lambda lab, v: (F.col("label") == lab) & (F.col("variant") == v)
    aggs = []
    for i, lab in enumerate(labels):
        for v in variants:
            aggs += [F.sum(F.when(cell(lab, v), lp)).alias(f"s{i}_{v}"), F.count(F.when(cell(lab, v), lp)).alias(f"n{i}_{v}")]
    wide = token_scores.groupBy(*keys).agg(*aggs)

    def label_score(i: int) -> Column:
        each = [F.when(F.col(f"n{i}_{v}") > 0, F.col(f"s{i}_{v}") / F.col(f"n{i}_{v}")) for v in variants]
        found = F.filter(F.array(*each), lambda x: x.isNotNull())
        if how == "max":
            return F.coalesce(F.array_max(found), F.lit(S.NEG_INF))
        total = F.aggregate(found, F.lit(0.0), lambda acc, x: acc + x)
        return F.when(F.size(found) > 0, total / F.size(found)).otherwise(F.lit(S.NEG_INF))

    return wide.select(*keys, F.array(*[label_score(i) for i in range(len(labels))]).alias("raw"))


def across_synonyms(scores: Column, across: str = "max") -> Column:
    """One score of a label from the scores of its synonyms (nulls are none): the best, their mean, or the log of their summed likelihoods."""
    if across not in ACROSS:
        raise ValueError(across)
    found = F.filter(scores, lambda x: x.isNotNull() & (x > S.NEG_INF))
    top, n = F.array_max(found), F.size(found)
    total = lambda f: F.aggregate(found, F.lit(0.0), lambda acc, x: acc + f(x))
    out = {"max": top, "mean": total(lambda x: x) / n, "logsum": top + F.log(total(lambda x: F.exp(x - top)))}[across]
    return F.when(n > 0, out).otherwise(F.lit(S.NEG_INF))


def _by_cell(df: DataFrame, labels: Sequence[str], synonyms: Synonyms, across: str, keys: Sequence[str], cell: Callable[[int, int, Column], Sequence[Column]],
             score: Callable[[int, int], Column]) -> DataFrame:
    """``raw`` in one shuffle: ``cell`` gives the aggregates of a (label, synonym), ``score`` the score they make."""
    names = [(i, j, name) for i, lab in enumerate(labels) for j, name in enumerate(synonyms[lab])]
    aggs = [a for i, j, name in names for a in cell(i, j, (F.col("label") == labels[i]) & (F.col("synonym") == name))]
    wide = df.groupBy(*keys).agg(*aggs)
    raw = [across_synonyms(F.array(*[score(i, j) for i2, j, _ in names if i2 == i]), across) for i in range(len(labels))]
    return wide.select(*keys, F.array(*raw).alias("raw"))


def synonym_raw(token_scores: DataFrame, synonyms: Synonyms, across: str = "max", labels: Sequence[str] = LABELS, variants: Sequence[int] = (0, 1),
                keys: Sequence[str] = ("example_id",)) -> DataFrame:
    """``raw`` from token scores of labels' synonyms, ``(label, synonym, variant, pos, logprob)``, in two levels and one shuffle.

    A synonym scores as a label alone would: the best of its variants' mean token log-probabilities. ``across`` then makes one
    score of a label's synonyms. Null prompts go the same way, so that scores and priors are reduced alike.
    """
    lp = F.col("logprob")

    def cell(i: int, j: int, here: Column) -> list[Column]:
        return [f(F.when(here & (F.col("variant") == v), lp)).alias(f"{n}{i}_{j}_{v}") for v in variants for n, f in (("s", F.sum), ("n", F.count))]

    def score(i: int, j: int) -> Column:
        return F.array_max(F.array(*[F.when(F.col(f"n{i}_{j}_{v}") > 0, F.col(f"s{i}_{j}_{v}") / F.col(f"n{i}_{j}_{v}")) for v in variants]))

    return _by_cell(token_scores, labels, synonyms, across, keys, cell, score)


def best_synonym(sequence_scores: DataFrame, synonyms: Synonyms, across: str = "max", labels: Sequence[str] = LABELS, keys: Sequence[str] = ("example_id",)) -> DataFrame:
    """The same from scores of whole candidates, ``(label, synonym, variant, score)``."""
    return _by_cell(sequence_scores, labels, synonyms, across, keys, lambda i, j, here: [F.max(F.when(here, F.col("score"))).alias(f"b{i}_{j}")], lambda i, j: F.col(f"b{i}_{j}"))


def null_prior(null_raw: DataFrame, labels: Sequence[str] = LABELS, by: Sequence[str] = ()) -> DataFrame:
    """``prior``: mean raw score per label over the null prompts, per model. One row per model."""
    return null_raw.groupBy(*by).agg(
        F.array(*[F.avg(F.element_at("raw", i + 1)) for i in range(len(labels))]).alias("prior"))


def calibrate(raw: DataFrame, prior: DataFrame | Mapping[str, float], on: str = "model",
              labels: Sequence[str] = LABELS) -> DataFrame:
    """``scores`` = raw - prior. A prior of one model is a literal; priors of many are looked up."""
    if isinstance(prior, DataFrame):
        out = join_lookup(raw, prior.select(on, "prior"), on)
    else:
        out = raw.withColumn("prior", S.prior_array(prior, labels))
    return out.withColumn("scores", S.calibrated(F.col("raw"), F.col("prior")))


def predict(scored: DataFrame, bias: Mapping[str, float] | None = None, labels: Sequence[str] = LABELS) -> DataFrame:
    """``prediction``: argmax of ``scores`` (plus a constant per label, if given)."""
    scores = F.col("scores") if not bias else S.with_bias(F.col("scores"), bias, labels)
    return scored.withColumn("prediction", S.argmax_label(scores, labels))


def score_response(raw: DataFrame, prior: DataFrame | Mapping[str, float], on: str = "model",
                   labels: Sequence[str] = LABELS) -> DataFrame:
    """The served answer per row of ``raw``: prediction, four maps, margin. No shuffle of its own."""
    full = predict(calibrate(raw, prior, on, labels), labels=labels)
    return (full.withColumn("probabilities", S.as_map(S.softmax(F.col("scores")), labels))
            .withColumn("top2_margin", S.top2_margin(F.col("scores")))
            .withColumn("raw_scores", S.as_map(F.col("raw"), labels))
            .withColumn("prior", S.as_map(F.col("prior"), labels))
            .withColumn("scores", S.as_map(F.col("scores"), labels))
            .drop("raw"))


def by_label(df: DataFrame, columns: Mapping[str, str], labels: Sequence[str] = LABELS) -> DataFrame:
    """Score arrays back to one row per (example, label); ``columns`` maps array column to new name."""
    cells = [F.struct(F.lit(lab).alias("label"), *[F.element_at(c, i + 1).alias(new) for c, new in columns.items()])
             for i, lab in enumerate(labels)]
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(*cells)))
