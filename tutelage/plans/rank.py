"""Queries on label ranking, calibration and perplexity, and the flagship evaluation."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from tutelage.functions import constants as K
from tutelage.functions import scores as S
from tutelage.functions.templates import credit_chat_prompt, credit_chat_words
from tutelage.operators import countlm, ranking as R, sampling
from tutelage.operators.inference import infer_batch
from tutelage.operators.metrics import full_report
from tutelage.plans import tables as T
from tutelage.plans.prepare import NULLS_SQL, sql_chat, sql_tokens
from tutelage.plans.registry import query, quote
from tutelage.plans.scorer import CountScorer, ModelScorer

LABEL_VALUES = "(VALUES ('Good', 1), ('Standard', 2), ('Bad', 3)) AS lab(label, place)"


def _finite(c: Column | str, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.abs(c) < 1e300, F.round(c, digits))


def _sql_finite(e: str, digits: int = 6) -> str:
    return f"CASE WHEN abs({e}) < 1e300 THEN round({e}, {digits}) END"


# --- ranking from stored token scores ----------------------------------------------------------

@query("e1_expand_candidates", f"""WITH {T.SQL_REQUESTS} SELECT event_id, features, label, variant, CASE WHEN variant = 0 THEN ' ' ELSE '' END || label AS candidate
FROM requests, {LABEL_VALUES}, (VALUES (0), (1)) AS v(variant)""")
def e1_expand_candidates(spark: SparkSession, d: str) -> DataFrame:
    return R.expand_candidates(T.requests(spark, d).select("event_id", "features"))


@query("e2_token_logprob", """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings), m AS (SELECT *, list_max(x) AS top FROM e)
SELECT vec_id, round(x[vec_id % len(x) + 1] - top - ln(list_sum(list_transform(x, lambda v: exp(v - top)))), 6) AS logprob FROM m""")
def e2_token_logprob(spark: SparkSession, d: str) -> DataFrame:
    emb = T.table(spark, d, "embeddings").select("vec_id", "embedding")
    target = F.col("vec_id") % F.size("embedding")
    return emb.select("vec_id", F.round(S.token_logprob(F.col("embedding"), target), 6).alias("logprob"))


SEQ = T.SQL_TOKEN_SCORES + """,
seq AS (SELECT example_id, label, variant, sum(logprob) / count(logprob) AS score, count(logprob) AS n_tokens FROM token_scores GROUP BY ALL)"""

RAW = SEQ + f""",
raw AS (SELECT e.example_id, lab.label, lab.place, coalesce(max(s.score), '-inf'::DOUBLE) AS raw
  FROM (SELECT DISTINCT example_id FROM token_scores) e CROSS JOIN {LABEL_VALUES} LEFT JOIN seq s ON s.example_id = e.example_id AND s.label = lab.label GROUP BY ALL)"""

PRIOR = T.SQL_NULL_TOKEN_SCORES + """,
nseq AS (SELECT model, null_id, label, variant, sum(logprob) / count(logprob) AS score FROM null_token_scores GROUP BY ALL),
nbest AS (SELECT model, null_id, label, max(score) AS score FROM nseq GROUP BY ALL),
prior AS (SELECT model, label, avg(score) AS prior FROM nbest GROUP BY ALL)"""

CAL = RAW + ", " + PRIOR + f""",
cal AS (SELECT r.example_id, p.model, r.label, r.place, r.raw, p.prior, r.raw - p.prior AS score
  FROM raw r JOIN prior p ON p.label = r.label AND p.model = {T._sql_model('r.example_id')}),
pred AS (SELECT example_id, model, arg_min(label, rk) AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY score DESC, place) AS rk FROM cal) GROUP BY ALL),
soft AS (SELECT *, exp(score - top) / sum(exp(score - top)) OVER (PARTITION BY example_id) AS probability FROM (SELECT *, max(score) OVER (PARTITION BY example_id) AS top FROM cal)),
margin AS (SELECT example_id, max(score) FILTER (rk = 1) - max(score) FILTER (rk = 2) AS margin FROM
  (SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY score DESC) AS rk FROM cal) GROUP BY example_id)"""


def priors(spark: SparkSession, d: str) -> DataFrame:
    """``(model, prior)`` from the stored null scores: four rows."""
    raw = R.raw_scores(T.null_token_scores(spark, d), keys=("model", "null_id"))
    return R.null_prior(raw, by=("model",))


def with_model(raw: DataFrame) -> DataFrame:
    return raw.withColumn("model", T._model(F.col("example_id")))


def scored(spark: SparkSession, d: str) -> DataFrame:
    """``(example_id, model, raw, prior, scores)``."""
    return R.calibrate(with_model(R.raw_scores(T.token_scores(spark, d))), priors(spark, d))


@query("e3_sequence_score", f"WITH {SEQ} SELECT example_id, label, variant, round(score, 6) AS score, n_tokens FROM seq")
def e3_sequence_score(spark: SparkSession, d: str) -> DataFrame:
    return R.sequence_score(T.token_scores(spark, d)).withColumn("score", F.round("score", 6))


@query("e4_best_variant", f"WITH {RAW} SELECT example_id, label, {_sql_finite('raw')} AS raw FROM raw")
def e4_best_variant(spark: SparkSession, d: str) -> DataFrame:
    best = R.best_variant(R.sequence_score(T.token_scores(spark, d)))
    return R.by_label(best, {"raw": "raw"}).withColumn("raw", _finite("raw"))


@query("e4_raw_scores", f"WITH {RAW} SELECT example_id, label, {_sql_finite('raw')} AS raw FROM raw")
def e4_raw_scores(spark: SparkSession, d: str) -> DataFrame:
    return R.by_label(R.raw_scores(T.token_scores(spark, d)), {"raw": "raw"}).withColumn("raw", _finite("raw"))


@query("e5_null_prior", f"WITH {PRIOR} SELECT model, label, round(prior, 6) AS prior FROM prior")
def e5_null_prior(spark: SparkSession, d: str) -> DataFrame:
    return R.by_label(priors(spark, d), {"prior": "prior"}).withColumn("prior", F.round("prior", 6))


@query("e6_calibrate", f"WITH {CAL} SELECT example_id, label, {_sql_finite('score')} AS score FROM cal")
def e6_calibrate(spark: SparkSession, d: str) -> DataFrame:
    return R.by_label(scored(spark, d).select("example_id", "scores"), {"scores": "score"}).withColumn("score", _finite("score"))


@query("e7_predict", f"WITH {CAL} SELECT example_id, model, prediction FROM pred")
def e7_predict(spark: SparkSession, d: str) -> DataFrame:
    return R.predict(scored(spark, d)).select("example_id", "model", "prediction")


@query("e8_softmax", f"WITH {CAL} SELECT example_id, label, round(probability, 6) AS probability FROM soft")
def e8_softmax(spark: SparkSession, d: str) -> DataFrame:
    probs = scored(spark, d).select("example_id", S.softmax(F.col("scores")).alias("p"))
    return R.by_label(probs, {"p": "probability"}).withColumn("probability", F.round("probability", 6))


@query("e9_top2_margin", f"WITH {CAL} SELECT example_id, {_sql_finite('margin')} AS top2_margin FROM margin")
def e9_top2_margin(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).select("example_id", _finite(S.top2_margin(F.col("scores"))).alias("top2_margin"))


def _per_label(source: str, out: str) -> str:
    return ", ".join(f"max({_sql_finite(source)}) FILTER (label = '{lab}') AS {out}_{lab.lower()}" for lab in K.LABELS)


@query("e10_score_requests", f"""WITH {CAL} SELECT s.example_id, s.model, any_value(prediction) AS prediction, {_per_label('s.raw', 'raw')}, {_per_label('s.prior', 'prior')},
{_per_label('s.score', 'score')}, {_per_label('s.probability', 'prob')}, {_sql_finite('any_value(margin)')} AS top2_margin
FROM soft s JOIN pred USING (example_id) JOIN margin USING (example_id) GROUP BY s.example_id, s.model""")
def e10_score_requests(spark: SparkSession, d: str) -> DataFrame:
    full = R.score_response(with_model(R.raw_scores(T.token_scores(spark, d))), priors(spark, d))
    maps = {"raw_scores": "raw", "prior": "prior", "scores": "score", "probabilities": "prob"}
    cells = [_finite(F.col(m)[lab]).alias(f"{out}_{lab.lower()}") for m, out in maps.items() for lab in K.LABELS]
    return full.select("example_id", "model", "prediction", *cells, _finite("top2_margin").alias("top2_margin"))


@query("e14_predict_bias", f"""WITH {CAL} SELECT example_id, arg_min(label, rk) AS prediction FROM
(SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY score + CASE WHEN label = 'Standard' THEN 0.5 ELSE 0 END DESC, place) AS rk FROM cal) GROUP BY example_id""")
def e14_predict_bias(spark: SparkSession, d: str) -> DataFrame:
    return R.predict(scored(spark, d), bias={"Standard": 0.5}).select("example_id", "prediction")


@query("e15_verbalizers", f"""WITH {SEQ}, m AS (SELECT e.example_id, lab.label, avg(s.score) AS raw FROM (SELECT DISTINCT example_id FROM token_scores) e
CROSS JOIN {LABEL_VALUES} LEFT JOIN seq s ON s.example_id = e.example_id AND s.label = lab.label GROUP BY ALL) SELECT example_id, label, round(raw, 6) AS raw FROM m""")
def e15_verbalizers(spark: SparkSession, d: str) -> DataFrame:
    best = R.best_variant(R.sequence_score(T.token_scores(spark, d)), how="mean")
    return R.by_label(best, {"raw": "raw"}).withColumn("raw", _finite("raw"))


_REDUCED = {"max": "max(score)", "mean": "avg(score)", "logsum": "max(score) + ln(sum(exp(score - top)))"}


def _sql_reduced(source: str, keys: str, how: str) -> str:
    """One score per label: the best variant of each synonym, then one of ``_REDUCED`` over the synonyms."""
    return f"""(SELECT {keys}, label, {_REDUCED[how]} AS raw FROM (SELECT *, max(score) OVER (PARTITION BY {keys}, label) AS top FROM
  (SELECT {keys}, label, synonym, max(score) AS score FROM (SELECT {keys}, label, synonym, variant, avg(logprob) AS score FROM {source} GROUP BY ALL) GROUP BY ALL)) GROUP BY ALL)"""


def _sql_synonyms(how: str) -> str:
    return f"""SELECT e.example_id, lab.label, '{how}' AS across, round(r.raw, 6) AS raw, round(r.raw - p.prior, 6) AS score
FROM (SELECT DISTINCT example_id FROM synonym_scores) e CROSS JOIN {LABEL_VALUES} LEFT JOIN {_sql_reduced('synonym_scores', 'example_id', how)} r ON r.example_id = e.example_id AND r.label = lab.label
LEFT JOIN (SELECT model, label, avg(raw) AS prior FROM {_sql_reduced('null_synonym_scores', 'model, null_id', how)} GROUP BY ALL) p ON p.label = lab.label AND p.model = {T._sql_model('e.example_id')}"""


@query("e15_synonyms", f"WITH {T.SQL_SYNONYM_SCORES} {' UNION ALL '.join(map(_sql_synonyms, R.ACROSS))}")
def e15_synonyms(spark: SparkSession, d: str) -> DataFrame:
    """Labels under two names each, reduced in three ways, in scores and priors alike."""
    def reduced(across: str) -> DataFrame:
        raw = with_model(R.synonym_raw(T.synonym_token_scores(spark, d), T.SYNONYMS, across))
        prior = R.null_prior(R.synonym_raw(T.null_synonym_token_scores(spark, d), T.SYNONYMS, across, keys=("model", "null_id")), by=("model",))
        full = R.by_label(R.calibrate(raw, prior).select("example_id", "raw", "scores"), {"raw": "raw", "scores": "score"})
        return full.select("example_id", "label", F.lit(across).alias("across"), _finite("raw").alias("raw"), _finite("score").alias("score"))

    parts = [reduced(a) for a in R.ACROSS]
    return parts[0].union(parts[1]).union(parts[2])


# --- count scorer ------------------------------------------------------------------------------

def sql_lm(source: str, text: str = "question", name: str = "lm") -> str:
    """Counts per token and label, tokens per label, distinct tokens."""
    return f"""{name}_tok AS (SELECT answer AS label, unnest({sql_tokens(text)}) AS token FROM {source}),
{name}_c AS (SELECT label, token, count(*) AS c FROM {name}_tok GROUP BY ALL), {name}_n AS (SELECT label, count(*) AS n FROM {name}_tok GROUP BY label),
{name}_v AS (SELECT count(DISTINCT token) AS v FROM {name}_tok)"""


def sql_score(source: str, key: str, text: str, name: str = "lm") -> str:
    """Mean log-probability per row and label."""
    return f"""(SELECT t.{key}, n.label, avg(ln((coalesce(c.c, 0) + 1) / (n.n + v.v))) AS raw FROM (SELECT {key}, unnest({sql_tokens(text)}) AS token FROM {source}) t
  CROSS JOIN {name}_n n CROSS JOIN {name}_v v LEFT JOIN {name}_c c ON c.token = t.token AND c.label = n.label GROUP BY ALL)"""


@query("e13_fit_count_lm", f"""WITH {T.SQL_LABELLED}, {sql_lm('labelled_docs')}
SELECT token, coalesce(max(c) FILTER (label = 'Good'), 0) AS good, coalesce(max(c) FILTER (label = 'Standard'), 0) AS standard, coalesce(max(c) FILTER (label = 'Bad'), 0) AS bad FROM lm_c GROUP BY token""")
def e13_fit_count_lm(spark: SparkSession, d: str) -> DataFrame:
    lm = countlm.fit_count_lm(T.labelled_docs(spark, d))
    return lm.counts.select("token", *[F.element_at("c", i + 1).alias(lab.lower()) for i, lab in enumerate(K.LABELS)])


@query("e13_count_lm_scores", f"""WITH {T.SQL_CREDIT}, {sql_lm('credit_orders')}
SELECT id, label, round(raw, 6) AS raw FROM {sql_score('credit_orders', 'id', sql_chat('question'))}""")
def e13_count_lm_scores(spark: SparkSession, d: str) -> DataFrame:
    orders = T.spread(T.credit_orders(spark, d), "id")
    scorer = CountScorer.fit(orders)
    return R.by_label(scorer.raw(orders, "question", ("id",)).select("id", "raw"), {"raw": "raw"}).withColumn("raw", F.round("raw", 6))


@query("e13_scores_shuffled", f"""WITH {T.SQL_CREDIT}, {sql_lm('credit_orders')}
SELECT id, label, round(raw, 6) AS raw FROM {sql_score('credit_orders', 'id', sql_chat('question'))}""")
def e13_scores_shuffled(spark: SparkSession, d: str) -> DataFrame:
    """As with a vocabulary too large to broadcast: the counts lie in buckets by token."""
    orders = T.credit_orders(spark, d)
    fitted = countlm.fit_count_lm(orders)
    lm = countlm.bucketed(fitted, f"counts_{uuid.uuid4().hex}", 8)
    fitted.unpersist()
    prompts = orders.select("id", credit_chat_prompt("question").alias("prompt"))
    raw = countlm.count_lm_scores(prompts, lm, keys=("id",), broadcast_bytes=0, common=credit_chat_words())
    return R.by_label(raw.select("id", "raw"), {"raw": "raw"}).withColumn("raw", F.round("raw", 6))


_COUNT_SYNONYMS = "CASE WHEN id % 2 = 0 THEN answer ELSE CASE answer WHEN 'Good' THEN 'Strong' WHEN 'Standard' THEN 'Average' ELSE 'Weak' END END"


@query("e15_count_synonyms", f"""WITH {T.SQL_CREDIT}, named AS (SELECT id, question, {_COUNT_SYNONYMS} AS answer FROM credit_orders), {sql_lm('named')},
label_of(name, label, place) AS (VALUES ('Good', 'Good', 1), ('Strong', 'Good', 1), ('Standard', 'Standard', 2), ('Average', 'Standard', 2), ('Bad', 'Bad', 3), ('Weak', 'Bad', 3)),
prompts AS (SELECT id, {sql_chat('question')} AS prompt FROM credit_orders), nulls AS (SELECT null_id, {sql_chat('features')} AS prompt FROM {NULLS_SQL}),
prior AS (SELECT label, avg(raw) AS prior FROM (SELECT null_id, l.label, avg(raw) AS raw FROM {sql_score('nulls', 'null_id', 'prompt')} s JOIN label_of l ON l.name = s.label GROUP BY ALL) GROUP BY label)
SELECT id, label, round(raw - prior, 6) AS score FROM (SELECT id, l.label, avg(raw) AS raw FROM {sql_score('prompts', 'id', 'prompt')} s JOIN label_of l ON l.name = s.label GROUP BY ALL) JOIN prior USING (label)""")
def e15_count_synonyms(spark: SparkSession, d: str) -> DataFrame:
    """Counts for every name of a label; a label's score, and its prior, is the mean over its names."""
    orders = T.credit_orders(spark, d)
    second = F.coalesce(*[F.when(F.col("answer") == lab, names[1]) for lab, names in T.SYNONYMS.items()])
    named = orders.withColumn("answer", F.when(F.col("id") % 2 == 0, F.col("answer")).otherwise(second))
    scorer = CountScorer.fit(named, synonyms=T.SYNONYMS, across="mean")
    raw = scorer.raw(orders, "question", ("id",))
    return R.by_label(R.calibrate(raw, scorer.prior).select("id", "scores"), {"scores": "score"}).withColumn("score", F.round("score", 6))


@query("e13_token_scores", f"""WITH {T.SQL_LABELLED}, {sql_lm('labelled_docs')}
SELECT id AS example_id, label, 0 AS variant, round(raw, 6) AS score FROM {sql_score('labelled_docs', 'id', 'question')}""")
def e13_token_scores(spark: SparkSession, d: str) -> DataFrame:
    docs = T.spread(T.labelled_docs(spark, d), "id")
    ts = countlm.token_scores(docs, countlm.fit_count_lm(docs), "question", "id")
    return R.sequence_score(ts).select("example_id", "label", "variant", F.round("score", 6).alias("score"))


@query("e11_perplexity", f"""WITH w AS (SELECT doc_id, {sql_tokens('text')} AS ws FROM documents), c AS (SELECT token, count(*) AS c FROM (SELECT unnest(ws) AS token FROM w) GROUP BY token),
s AS (SELECT sum(c) AS n, count(*) AS v FROM c), lp AS (SELECT token, ln((c + 1) / (n + v)) AS lp FROM c, s),
p AS (SELECT doc_id, exp(-avg(lp)) AS ppl FROM (SELECT doc_id, unnest(ws[2:{K.MAX_LEN}]) AS token FROM w) JOIN lp USING (token) GROUP BY doc_id)
SELECT w.doc_id, round(ppl, 3) AS perplexity FROM w LEFT JOIN p USING (doc_id)""")
def e11_perplexity(spark: SparkSession, d: str) -> DataFrame:
    docs = T.documents(spark, d)
    lm = countlm.fit_count_lm(docs, "text", None)
    return countlm.count_perplexity(docs, lm, "text", "doc_id").select("doc_id", F.round("perplexity", 3).alias("perplexity"))


@query("e11_perplexity_stored", f"""WITH {T.SQL_TOKEN_SCORES} SELECT example_id, round(exp(-avg(logprob) FILTER (pos > 0)), 3) AS perplexity FROM token_scores GROUP BY example_id""")
def e11_perplexity_stored(spark: SparkSession, d: str) -> DataFrame:
    return countlm.perplexity(T.token_scores(spark, d)).withColumn("perplexity", F.round("perplexity", 3))


def _linear_model():
    """Stands in for a model load: weights once per worker, then batches of vectors."""
    import numpy as np

    def predict(x: np.ndarray) -> np.ndarray:
        return x.astype("float64") @ (np.arange(1, x.shape[1] + 1) / x.shape[1])

    return predict


@query("e12_infer_batch", """SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: CAST(embedding[i] AS DOUBLE) * i / 64)), 4) AS output FROM embeddings""")
def e12_infer_batch(spark: SparkSession, d: str) -> DataFrame:
    emb = T.table(spark, d, "embeddings").select("vec_id", "embedding")
    out = infer_batch(emb, _linear_model, ["embedding"], "output", ST.DoubleType(), batch_size=256, input_tensor_shapes=[[64]])
    return out.select("vec_id", F.round("output", 4).alias("output"))


def _length_model():
    """Stands in for a language model: a score from the lengths of prompt and candidate, one token per word."""
    import numpy as np

    def score(prompts, candidates):
        p = np.array([len(t) for t in prompts], dtype="int64")
        c = np.array([len(t) for t in candidates], dtype="int64")
        return {"sum_logprob": -((p * 31 + c * 17) % 101) / 7.0, "n_tokens": np.array([len(t.split()) for t in candidates], dtype="int64")}

    return score


_LENGTH_RAW = f"""SELECT {{key}}, label, max(-((length(prompt) * 31 + length(CASE variant WHEN 0 THEN ' ' ELSE '' END || label) * 17) % 101) / 7.0) AS raw
  FROM {{source}}, {LABEL_VALUES}, (VALUES (0), (1)) AS v(variant) GROUP BY ALL"""


@query("e12_model_scorer", f"""WITH {T.SQL_CREDIT}, prompts AS (SELECT id, {sql_chat('question')} AS prompt FROM credit_orders), nulls AS (SELECT null_id, {sql_chat('features')} AS prompt FROM {NULLS_SQL}),
prior AS (SELECT label, avg(raw) AS prior FROM ({_LENGTH_RAW.format(key='null_id', source='nulls')}) GROUP BY label)
SELECT id, label, round(raw - prior, 6) AS score FROM ({_LENGTH_RAW.format(key='id', source='prompts')}) JOIN prior USING (label)""")
def e12_model_scorer(spark: SparkSession, d: str) -> DataFrame:
    scorer = ModelScorer.load(spark, _length_model)
    raw = scorer.raw(T.spread(T.credit_orders(spark, d), "id"), "question", ("id",))
    return R.by_label(R.calibrate(raw, scorer.prior).select("id", "scores"), {"scores": "score"}).withColumn("score", F.round("score", 6))


class _LengthModel:
    """The same for grouped scoring: a token per character, the prompt's state its length."""

    def tokenize(self, texts):
        return [[ord(c) for c in t] for t in texts]

    def prefix(self, batch):
        return [len(ids) for ids in batch]

    def continue_(self, state, ids):
        return [-((p * 31 + len(ids) * 17) % 101) / 7.0 for p in state]


_GROUPED_RAW = f"""SELECT {{key}}, label, max(-((length(prompt) * 31 + length(c) * 17) % 101) / 7.0 / length(c)) AS raw
  FROM (SELECT {{key}}, prompt, label, CASE variant WHEN 0 THEN ' ' ELSE '' END || label AS c FROM {{source}}, {LABEL_VALUES}, (VALUES (0), (1)) AS v(variant)) GROUP BY ALL"""


@query("e12_grouped_scorer", f"""WITH {T.SQL_CREDIT}, prompts AS (SELECT id, {sql_chat('question')} AS prompt FROM credit_orders), nulls AS (SELECT null_id, {sql_chat('features')} AS prompt FROM {NULLS_SQL}),
prior AS (SELECT label, avg(raw) AS prior FROM ({_GROUPED_RAW.format(key='null_id', source='nulls')}) GROUP BY label)
SELECT id, label, round(raw - prior, 6) AS score FROM ({_GROUPED_RAW.format(key='id', source='prompts')}) JOIN prior USING (label)""")
def e12_grouped_scorer(spark: SparkSession, d: str) -> DataFrame:
    """Each prompt is evaluated once for its six candidates, in batches of about equal length."""
    scorer = ModelScorer.load(spark, _LengthModel, grouped=True)
    raw = scorer.raw(T.credit_orders(spark, d), "question", ("id",))
    return R.by_label(R.calibrate(raw, scorer.prior).select("id", "scores"), {"scores": "score"}).withColumn("score", F.round("score", 6))


# --- flagship ----------------------------------------------------------------------------------

def evaluated(spark: SparkSession, d: str) -> DataFrame:
    """``(id, answer, prediction)`` on balanced validation documents, scored by counts of all the others."""
    docs = T.spread(T.labelled_docs(spark, d), "id")
    val = sampling.balanced_val(docs)
    scorer = CountScorer.fit(sampling.remainder(docs, val))
    return scorer.predict(val, "question", ("id", "answer"))


EVALUATED = T.SQL_LABELLED + f""",
q AS (SELECT least(greatest(1, greatest(1, floor(sum(n) * 0.1)) // 3), min(n)) AS k FROM (SELECT count(*) AS n FROM labelled_docs GROUP BY answer)),
val AS (SELECT id, answer, question FROM (SELECT *, row_number() OVER (PARTITION BY answer ORDER BY md5('7:' || id), id) AS rn FROM labelled_docs) WHERE rn <= (SELECT k FROM q)),
train AS (SELECT * FROM labelled_docs WHERE id NOT IN (SELECT id FROM val)),
{sql_lm('train')},
prompts AS (SELECT id, {sql_chat('question')} AS prompt FROM val), nulls AS (SELECT null_id, {sql_chat('features')} AS prompt FROM {NULLS_SQL}),
prior AS (SELECT label, avg(raw) AS prior FROM {sql_score('nulls', 'null_id', 'prompt')} GROUP BY label),
scores AS (SELECT s.id, s.label, place, raw - prior AS score FROM {sql_score('prompts', 'id', 'prompt')} s JOIN prior USING (label) JOIN {LABEL_VALUES} ON lab.label = s.label),
predicted AS (SELECT id, answer, arg_min(label, rk) AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, place) AS rk FROM scores) JOIN val USING (id) GROUP BY ALL)"""


def sql_report(source: str) -> str:
    """Class rows of precision, recall, F1, support."""
    return f"""(SELECT label, coalesce(tp / nullif(pred, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall, coalesce(2 * tp / nullif(pred + support, 0), 0.0) AS f1, support
  FROM (SELECT lab.label, count(*) FILTER (answer = lab.label AND prediction = lab.label) AS tp, count(*) FILTER (prediction = lab.label) AS pred,
    count(*) FILTER (answer = lab.label) AS support FROM {LABEL_VALUES} CROSS JOIN {source} GROUP BY lab.label))"""


def sql_full_report(source: str) -> str:
    r6 = "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support"
    mean = lambda m: f"avg({m}) AS {m}"
    wmean = lambda m: f"sum({m} * support) / sum(support) AS {m}"
    three = ("precision", "recall", "f1")
    return f"""SELECT label, {r6} FROM (SELECT * FROM rep
  UNION ALL SELECT 'accuracy', NULL, NULL, avg(CASE WHEN answer = prediction THEN 1.0 ELSE 0.0 END), count(*) FROM {source}
  UNION ALL SELECT 'macro avg', {', '.join(map(mean, three))}, sum(support) FROM rep
  UNION ALL SELECT 'weighted avg', {', '.join(map(wmean, three))}, sum(support) FROM rep)"""


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("calibrated_eval", f"WITH {EVALUATED}, rep AS {sql_report('predicted')} {sql_full_report('predicted')}")
def calibrated_eval(spark: SparkSession, d: str) -> DataFrame:
    return rounded(full_report(evaluated(spark, d)), "precision", "recall", "f1")


@query("calibrated_predictions", f"WITH {EVALUATED} SELECT id, answer, prediction FROM predicted")
def calibrated_predictions(spark: SparkSession, d: str) -> DataFrame:
    return evaluated(spark, d).select("id", "answer", "prediction")
