"""Scorers with their null prior: made once, then used by batch and stream alike.

A scorer turns feature texts into ``raw`` scores per label; what follows is the same for all:
calibrate, predict, respond. Labels may go by several names (``synonyms``), whose scores are reduced ``across`` them in scores and priors alike.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.functions.constants import LABELS
from tutelage.functions.templates import credit_chat_prompt, credit_chat_words
from tutelage.operators import ranking as R
from tutelage.operators.countlm import CountLM, count_lm_scores, fit_count_lm
from tutelage.operators.inference import score_candidates, score_grouped


class Scorer:
    """``prior`` and ``raw`` are what a kind of scorer brings along; ``version`` names a stored one."""

    prior: dict[str, float]
    labels: Sequence[str]
    version: str | None = None

    def raw(self, df: DataFrame, features_col: str, keys: Sequence[str]) -> DataFrame:
        """``raw`` per row of ``df``; ``keys`` identify a row and are kept."""
        raise NotImplementedError

    def respond(self, df: DataFrame, features_col: str, keys: Sequence[str]) -> DataFrame:
        return R.score_response(self.raw(df, features_col, keys), self.prior, labels=self.labels)

    def predict(self, df: DataFrame, features_col: str, keys: Sequence[str], bias: Mapping[str, float] | None = None) -> DataFrame:
        return R.predict(R.calibrate(self.raw(df, features_col, keys), self.prior, labels=self.labels), bias, self.labels)

    def audit(self, df: DataFrame, features_col: str, keys: Sequence[str]) -> DataFrame:
        """``respond`` as rows to keep: with the scorer's version and a SHA-256 of the input instead of the input."""
        digest = df.select(*keys, F.col(features_col).alias("__f"), F.sha2(F.col(features_col), 256).alias("input_sha256"))
        return self.respond(digest, "__f", (*keys, "input_sha256")).withColumn("version", F.lit(self.version))

    def _fit_prior(self, spark: SparkSession) -> dict[str, float]:
        """Seven prompts make one row: it fits the driver, and is kept like the model it belongs to."""
        nulls = R.null_features(spark.range(1).select(F.lit("scorer").alias("model")))
        raw = self.raw(nulls.select("null_id", "features"), "features", ("null_id",))
        return dict(zip(self.labels, R.null_prior(raw, self.labels).first()["prior"], strict=True))


@dataclass
class CountScorer(Scorer):
    """Scores by token counts; needs no model. With ``synonyms`` there are counts for every name of a label."""

    lm: CountLM
    labels: Sequence[str] = LABELS
    prior: dict[str, float] = field(default_factory=dict)
    synonyms: R.Synonyms | None = None
    across: str = "max"
    version: str | None = None

    @classmethod
    def fit(cls, train: DataFrame, labels: Sequence[str] = LABELS, synonyms: R.Synonyms | None = None, across: str = "max") -> CountScorer:
        names = tuple(labels) if synonyms is None else tuple(n for lab in labels for n in synonyms[lab])
        made = cls(fit_count_lm(train, labels=names), labels, {}, synonyms, across)
        made.prior = made._fit_prior(train.sparkSession)
        return made

    def raw(self, df: DataFrame, features_col: str, keys: Sequence[str]) -> DataFrame:
        prompts = df.select(*keys, credit_chat_prompt(features_col).alias("prompt"))
        scored = count_lm_scores(prompts, self.lm, keys=keys, common=credit_chat_words())
        if self.synonyms is None:
            return scored
        place = {n: i for i, n in enumerate(self.lm.labels)}
        own = [R.across_synonyms(F.array(*[F.element_at("raw", place[n] + 1) for n in self.synonyms[lab]]), self.across) for lab in self.labels]
        return scored.withColumn("raw", F.when(F.col("raw").isNotNull(), F.array(*own)))


@dataclass
class ModelScorer(Scorer):
    """Scores by a Python model, loaded once per worker (see ``score_candidates``; ``make_prefix_fn``: see ``score_grouped``)."""

    make_score_fn: Callable
    labels: Sequence[str] = LABELS
    batch_size: int = 64
    prior: dict[str, float] = field(default_factory=dict)
    synonyms: R.Synonyms | None = None
    across: str = "max"
    version: str | None = None
    grouped: bool = False
    token_budget: int = 16_384

    @classmethod
    def load(cls, spark: SparkSession, make_score_fn: Callable, labels: Sequence[str] = LABELS, batch_size: int = 64, synonyms: R.Synonyms | None = None,
             across: str = "max", prior: Mapping[str, float] | None = None, **kw) -> ModelScorer:
        """A stored ``prior`` spares asking the model for the null prompts."""
        made = cls(make_score_fn, labels, batch_size, {}, synonyms, across, **kw)
        made.prior = dict(prior) if prior is not None else made._fit_prior(spark)
        return made

    def raw(self, df: DataFrame, features_col: str, keys: Sequence[str]) -> DataFrame:
        prompts = df.select(*keys, credit_chat_prompt(features_col).alias("prompt"))
        if self.grouped:
            candidates = score_grouped(prompts, self.make_score_fn, self._candidates(), token_budget=self.token_budget)
        else:
            candidates = score_candidates(R.expand_candidates(prompts, self.labels, synonyms=self.synonyms), self.make_score_fn, batch_size=self.batch_size)
        if self.synonyms is None:
            return R.best_variant(candidates, labels=self.labels, keys=keys)
        return R.best_synonym(candidates, self.synonyms, self.across, self.labels, keys)

    def _candidates(self) -> list[dict[str, object]]:
        named = {lab: (lab,) for lab in self.labels} if self.synonyms is None else self.synonyms
        return [{"label": lab, "synonym": n, "variant": v, "candidate": lead + n} for lab in self.labels for n in named[lab] for v, lead in enumerate(R.VARIANTS)]
