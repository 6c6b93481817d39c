"""Queries on metrics, reports and evaluation of generated text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.functions import constants as K
from tutelage.functions import scores as S
from tutelage.functions.jsontext import extract_json, json_eval
from tutelage.functions.templates import kd_prompt
from tutelage.functions.text import strip_prompt
from tutelage.operators import countlm, evaluation as E, metrics as M, ranking as R
from tutelage.plans import tables as T
from tutelage.plans.prepare import STRIPPED_ANSWER, sql_tokens
from tutelage.plans.rank import CAL, rounded, scored, sql_full_report, sql_report, LABEL_VALUES
from tutelage.plans.registry import query, sql_render
from tutelage.session import fresh_path, materialise
from tutelage.sources import readers, sinks

# --- classification metrics --------------------------------------------------------------------

PREDICTED = CAL + f", {T.SQL_ORDER_LABELS}, predicted AS (SELECT example_id AS id, model, answer, prediction FROM pred JOIN order_labels ON id = example_id)"


def predicted(spark: SparkSession, d: str) -> DataFrame:
    """``(id, model, answer, prediction)`` of all scored orders."""
    pred = R.predict(scored(spark, d)).select(F.col("example_id").alias("id"), "model", "prediction")
    return pred.join(T.order_labels(spark, d), "id")


@query("f1_accuracy", f"WITH {PREDICTED} SELECT round(avg(CASE WHEN answer = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM predicted")
def f1_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.accuracy(predicted(spark, d)), "accuracy")


@query("f2_confusion", f"""WITH {PREDICTED} SELECT t.label AS y_true, p.label AS y_pred, count(id) AS n FROM {LABEL_VALUES.replace('lab(', 't(')}
CROSS JOIN {LABEL_VALUES.replace('lab(', 'p(')} LEFT JOIN predicted ON answer = t.label AND prediction = p.label GROUP BY ALL""")
def f2_confusion(spark: SparkSession, d: str) -> DataFrame:
    return M.confusion(predicted(spark, d))


@query("f2_confusion_table", f"""WITH {PREDICTED} SELECT answer AS y_true, count(*) FILTER (prediction = 'Good') AS "Good", count(*) FILTER (prediction = 'Standard') AS "Standard",
count(*) FILTER (prediction = 'Bad') AS "Bad" FROM predicted GROUP BY answer""")
def f2_confusion_table(spark: SparkSession, d: str) -> DataFrame:
    return M.confusion_table(M.confusion(predicted(spark, d)))


@query("f3_class_report", f"WITH {PREDICTED}, rep AS {sql_report('predicted')} SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep")
def f3_class_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.class_report(predicted(spark, d)), "precision", "recall", "f1")


@query("f3_full_report", f"WITH {PREDICTED}, rep AS {sql_report('predicted')} {sql_full_report('predicted')}")
def f3_full_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.full_report(predicted(spark, d)), "precision", "recall", "f1")


@query("f4_macro_avg", f"""WITH {PREDICTED}, rep AS {sql_report('predicted')} SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
round(avg(f1), 6) AS f1, CAST(sum(support) AS BIGINT) AS support FROM rep""")
def f4_macro_avg(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.macro_avg(M.class_report(predicted(spark, d))), "precision", "recall", "f1")


@query("f5_weighted_avg", f"""WITH {PREDICTED}, rep AS {sql_report('predicted')} SELECT round(sum(precision * support) / sum(support), 6) AS precision,
round(sum(recall * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1, CAST(sum(support) AS BIGINT) AS support FROM rep""")
def f5_weighted_avg(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.weighted_avg(M.class_report(predicted(spark, d))), "precision", "recall", "f1")


@query("f6_label_counts", f"""WITH {PREDICTED} SELECT 'true' AS side, answer AS label, count(*) AS n FROM predicted GROUP BY answer
UNION ALL SELECT 'pred', prediction, count(*) FROM predicted GROUP BY prediction""")
def f6_label_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.label_counts(predicted(spark, d))


@query("f12_teacher_accuracy", f"""WITH {T.SQL_ORDER_LABELS}, {T.sql_teacher('order_labels')}
SELECT round(avg(CASE WHEN answer = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM order_labels JOIN teacher USING (id)""")
def f12_teacher_accuracy(spark: SparkSession, d: str) -> DataFrame:
    gold = T.order_labels(spark, d)
    joined = gold.join(T.teacher(gold).select("id", F.col("label").alias("teacher_label")), "id")
    return rounded(M.accuracy(joined, pred_col="teacher_label"), "accuracy")


_BY_MODEL = " UNION ALL ".join(
    f"SELECT '{m}' AS model, avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1 FROM "
    + sql_report(f"(SELECT * FROM predicted WHERE model = '{m}')") for m in ("base", "sft", "kd", "dpo"))


@query("f13_compare_models", f"""WITH {PREDICTED}, macro AS ({_BY_MODEL}),
acc AS (SELECT model, avg(CASE WHEN answer = prediction THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n FROM predicted GROUP BY model)
SELECT a.model, round(accuracy, 6) AS accuracy, n, round(macro_precision, 6) AS macro_precision, round(macro_recall, 6) AS macro_recall, round(macro_f1, 6) AS macro_f1,
  round(accuracy - (SELECT accuracy FROM acc WHERE model = 'base'), 6) AS delta_accuracy, round(macro_f1 - (SELECT macro_f1 FROM macro WHERE model = 'base'), 6) AS delta_macro_f1
FROM acc a JOIN macro USING (model)""")
def f13_compare_models(spark: SparkSession, d: str) -> DataFrame:
    out = M.compare_models(predicted(spark, d), base="base")
    return rounded(out, *[c for c in out.columns if c not in ("model", "n")])


MARGINS = CAL + ", margins AS (SELECT example_id, prediction, CASE WHEN abs(margin) < 1e300 THEN margin END AS top2_margin FROM margin JOIN pred USING (example_id))"


def margins(spark: SparkSession, d: str) -> DataFrame:
    """``(example_id, prediction, top2_margin)``; no margin where only one label had a score."""
    m = S.top2_margin(F.col("scores"))
    return R.predict(scored(spark, d)).select("example_id", "prediction", F.when(m < 1e300, m).alias("top2_margin"))


@query("f14_margin_distribution", f"""WITH {MARGINS} SELECT prediction, prob, round(quantile_cont(top2_margin, 0.05), 6) AS value FROM margins, (VALUES (0.05)) v(prob) GROUP BY ALL
UNION ALL SELECT prediction, prob, round(quantile_cont(top2_margin, 0.5), 6) FROM margins, (VALUES (0.5)) v(prob) GROUP BY ALL
UNION ALL SELECT prediction, prob, round(quantile_cont(top2_margin, 0.95), 6) FROM margins, (VALUES (0.95)) v(prob) GROUP BY ALL""".replace("v(prob)", "v0(p0)").replace("prediction, prob,", "prediction, CAST(p0 AS DOUBLE) AS prob,"))
def f14_margin_distribution(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.margin_distribution(margins(spark, d), by="prediction"), "value")


_BY_DAY = " UNION ALL ".join(f"SELECT day, CAST({p} AS DOUBLE) AS prob, round(quantile_cont(top2_margin, {p}), 6) AS value FROM by_day WHERE top2_margin IS NOT NULL GROUP BY day" for p in (0.05, 0.5, 0.95))


@query("f14_margin_by_many", f"WITH {MARGINS}, by_day AS (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, top2_margin FROM margins JOIN orders ON o_orderkey = example_id) {_BY_DAY}")
def f14_margin_by_many(spark: SparkSession, d: str) -> DataFrame:
    """A group for each day of orders, thousands of them."""
    days = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("example_id"), F.col("o_orderdate").cast("date").cast("string").alias("day"))
    return rounded(M.margin_distribution(margins(spark, d).join(days, "example_id"), by="day"), "value")


@query("f14_margin_histogram", f"""WITH {MARGINS} SELECT prediction, CASE WHEN top2_margin < 0 THEN 0 WHEN top2_margin >= 2 THEN 21 ELSE CAST(floor(top2_margin / 2 * 20) AS BIGINT) + 1 END AS bucket, count(*) AS n
FROM margins WHERE top2_margin IS NOT NULL GROUP BY ALL""")
def f14_margin_histogram(spark: SparkSession, d: str) -> DataFrame:
    found = margins(spark, d).filter(F.col("top2_margin").isNotNull())
    return M.margin_histogram(found, 0.0, 2.0, 20, by=("prediction",))


@query("f16_class_drift", f"""WITH {PREDICTED}, s AS (SELECT prediction AS label, year(o_orderdate) < 1999 AS early FROM predicted JOIN orders ON o_orderkey = id),
a AS (SELECT label, count(*) FILTER (early) / sum(count(*) FILTER (early)) OVER () AS b, count(*) FILTER (NOT early) / sum(count(*) FILTER (NOT early)) OVER () AS c FROM s GROUP BY label)
SELECT label, round(b, 6) AS baseline_share, round(c, 6) AS current_share, round(c - b, 6) AS drift FROM a""")
def f16_class_drift(spark: SparkSession, d: str) -> DataFrame:
    days = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), (F.year("o_orderdate") < 1999).alias("early"))
    rows = predicted(spark, d).join(days, "id")
    return rounded(M.slice_drift(rows, ~F.col("early")), "baseline_share", "current_share", "drift")


# --- generated text ----------------------------------------------------------------------------

def _sql_object(e: str) -> str:
    return f"(CASE WHEN json_valid(regexp_extract({e}, '\\{{.*\\}}', 0, 's')) THEN regexp_extract({e}, '\\{{.*\\}}', 0, 's') END)"


JSON_EVAL = T.SQL_ANSWERS + f""",
jk AS (SELECT id, json_keys({_sql_object('answer')}) AS gk, json_keys({_sql_object('gold_json')}) AS rk FROM answers),
je AS (SELECT id, gk IS NOT NULL AND rk IS NOT NULL AS valid_json,
  CASE WHEN gk IS NOT NULL AND rk IS NOT NULL THEN len(list_intersect(gk, rk)) / len(rk) ELSE 0.0 END AS field_match,
  CASE WHEN gk IS NOT NULL AND rk IS NOT NULL THEN len(rk) END AS num_fields,
  CASE WHEN gk IS NOT NULL AND rk IS NOT NULL THEN len(list_intersect(gk, rk)) END AS num_matched_fields FROM jk)"""


@query("f7_extract_json", f"WITH {T.SQL_ANSWERS} SELECT id, {_sql_object('answer')} AS json FROM answers")
def f7_extract_json(spark: SparkSession, d: str) -> DataFrame:
    return T.invoice_answers(spark, d).select("id", extract_json("answer").alias("json"))


@query("f8_json_eval", f"WITH {JSON_EVAL} SELECT id, valid_json, round(field_match, 6) AS field_match, num_fields, num_matched_fields FROM je")
def f8_json_eval(spark: SparkSession, d: str) -> DataFrame:
    gen = T.generations(spark, d)
    out = gen.select("id", json_eval(strip_prompt("generated", "prompt"), "reference").alias("e")).select("id", "e.*")
    return rounded(out, "field_match").withColumns({c: F.col(c).cast("long") for c in ("num_fields", "num_matched_fields")})


@query("f9_json_metrics", f"""WITH {JSON_EVAL} SELECT count(*) AS num_examples, round(avg(CASE WHEN valid_json THEN 1.0 ELSE 0.0 END), 6) AS valid_json_ratio,
round(coalesce(avg(field_match) FILTER (valid_json), 0), 6) AS avg_field_match FROM je""")
def f9_json_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = T.invoice_answers(spark, d).select(json_eval("answer", "reference").alias("json_eval"))
    return rounded(E.json_metrics(rows), "valid_json_ratio", "avg_field_match")


def sql_ppl(lm_source: str, lm_text: str, source: str, key: str, text: str) -> str:
    """CTEs ending in ``ppl(key, perplexity)``: a one-class count model of one text applied to another."""
    return f"""pc AS (SELECT token, count(*) AS c FROM (SELECT unnest({sql_tokens(lm_text)}) AS token FROM {lm_source}) GROUP BY token),
ps AS (SELECT sum(c) AS n, count(*) AS v FROM pc),
ppl AS (SELECT t.{key}, exp(-avg(ln((coalesce(c, 0) + 1) / (n + v)))) AS perplexity FROM
  (SELECT {key}, unnest({sql_tokens(text)}[2:{K.MAX_LEN}]) AS token FROM {source}) t CROSS JOIN ps LEFT JOIN pc ON pc.token = t.token GROUP BY t.{key})"""


@query("f10_lm_metrics", f"WITH {sql_ppl('documents', 'text', 'documents', 'doc_id', 'text')} SELECT (SELECT count(*) FROM documents) AS num_examples, round(avg(perplexity), 3) AS avg_perplexity FROM ppl")
def f10_lm_metrics(spark: SparkSession, d: str) -> DataFrame:
    docs = T.documents(spark, d)
    ppl = countlm.count_perplexity(docs, countlm.fit_count_lm(docs, "text", None), "text", "doc_id")
    return E.lm_metrics(ppl).withColumn("avg_perplexity", F.round("avg_perplexity", 3))


def invoice_rows(spark: SparkSession, d: str) -> DataFrame:
    """Invoices' facts with a number for each row (``row``), written: their texts, many times as large, are made of them wherever they are read."""
    return materialise(T.invoice_facts(spark, d).withColumn("row", F.monotonically_increasing_id()), "invoices", "zstd")


def sft_examples(facts: DataFrame, *keep: str) -> DataFrame:
    return T.answers(facts, *keep).select("id", F.col("text").alias("input"), F.col("reference").alias("output"), F.concat("text", F.lit("\n"), "answer").alias("generated"), *keep)


def sft_results(spark: SparkSession, d: str) -> DataFrame:
    """Result rows of invoice extraction: the document is the input, the answer follows it.

    The facts are shuffled once, by row, for the perplexities and for the join with them; no text is.
    """
    facts = invoice_rows(spark, d)
    lm = countlm.fit_count_lm(T.answers(facts), "reference", None)
    facts = facts.repartition(T.parts(spark), "row")
    ppl = E.perplexities(sft_examples(facts, "row"), "sft", lm, "row")
    return E.eval_rows(sft_examples(facts.join(ppl, "row", "left"), "perplexity"), "sft", perplexity_col="perplexity")


SFT_RESULTS = JSON_EVAL + f""", full_text AS (SELECT id, text || chr(10) || chr(10) || {STRIPPED_ANSWER} AS full_text FROM answers),
{sql_ppl('answers', 'gold_json', 'full_text', 'id', 'full_text')}"""


@query("f11_eval_sft", f"""WITH {SFT_RESULTS} SELECT a.id, a.text AS input, gold_json AS reference, {STRIPPED_ANSWER} AS generated, round(perplexity, 3) AS perplexity, valid_json, round(field_match, 6) AS field_match
FROM answers a JOIN ppl USING (id) JOIN je USING (id)""")
def f11_eval_sft(spark: SparkSession, d: str) -> DataFrame:
    return sft_results(spark, d).select("id", "input", "reference", "generated", F.round("perplexity", 3).alias("perplexity"),
                                        "json_eval.valid_json", F.round("json_eval.field_match", 6).alias("field_match"))


@query("f11_eval_metrics", f"""WITH {SFT_RESULTS} SELECT count(*) AS num_examples, round(avg(perplexity), 3) AS avg_perplexity, round(avg(CASE WHEN valid_json THEN 1.0 ELSE 0.0 END), 6) AS valid_json_ratio,
round(coalesce(avg(field_match) FILTER (valid_json), 0), 6) AS avg_field_match FROM ppl JOIN je USING (id)""")
def f11_eval_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = E.eval_metrics(sft_results(spark, d), "sft")
    return rounded(out, "valid_json_ratio", "avg_field_match").withColumn("avg_perplexity", F.round("avg_perplexity", 3))


@query("f11_eval_from_file", f"""WITH {SFT_RESULTS} SELECT count(*) AS num_examples, round(avg(perplexity), 3) AS avg_perplexity, round(avg(CASE WHEN valid_json THEN 1.0 ELSE 0.0 END), 6) AS valid_json_ratio,
round(coalesce(avg(field_match) FILTER (valid_json), 0), 6) AS avg_field_match, count(*) AS n_ids, count(*) - 1 AS last_id FROM ppl JOIN je USING (id)""")
def f11_eval_from_file(spark: SparkSession, d: str) -> DataFrame:
    """From a file of examples to metrics: the rows' ids are their line numbers."""
    facts, path = invoice_rows(spark, d), fresh_path(spark, "examples")
    sft_examples(facts.repartition(T.parts(spark), "row")).drop("id").write.json(path, compression="gzip")  # a file of these is read by one task
    examples = readers.read_set(spark, path, f"{readers.SFT}, generated string", numbered=True)
    results = E.eval_rows(examples, "sft", lm=countlm.fit_count_lm(T.answers(facts), "reference", None), key_col="id")
    rows = materialise(results.select("id", "perplexity", "json_eval"), "results")  # the texts stay in the file
    ids = rows.agg(F.count_distinct("id").alias("n_ids"), F.max("id").alias("last_id"))
    found = E.eval_metrics(rows, "sft").select("*", ids.select("n_ids").scalar().alias("n_ids"), ids.select("last_id").scalar().alias("last_id"))
    return rounded(found, "valid_json_ratio", "avg_field_match").withColumn("avg_perplexity", F.round("avg_perplexity", 3))


_KD_PROMPT = sql_render(K.KD_CODE_PROMPT, "input")


@query("f11_eval_kd", f"""WITH {T.SQL_PAIRS}, g AS (SELECT conv_id * 100000 + turn AS id, input, output, {_KD_PROMPT} || chr(10) || chr(10) || trim(output, ' ' || chr(9) || chr(10) || chr(13)) AS full_text FROM turn_pairs),
{sql_ppl('turn_pairs', 'output', 'g', 'id', 'full_text')}
SELECT id, input, output AS teacher_output, trim(output, ' ' || chr(9) || chr(10) || chr(13)) AS generated, round(perplexity, 3) AS perplexity FROM g JOIN ppl USING (id)""")
def f11_eval_kd(spark: SparkSession, d: str) -> DataFrame:
    pairs = T.pairs(spark, d)
    lm = countlm.fit_count_lm(pairs, "output", None)
    examples = pairs.select((F.col("conv_id") * 100000 + F.col("turn")).alias("id"), "input", F.col("output").alias("teacher_output"),
                            F.concat(kd_prompt("input"), F.lit("\n"), "output").alias("generated"))
    return E.eval_rows(examples, "kd", lm=lm).withColumn("perplexity", F.round("perplexity", 3))


@query("f11_eval_dpo", f"""WITH {T.SQL_ANSWERS} SELECT id, text AS prompt, gold_json AS chosen, answer AS rejected, {STRIPPED_ANSWER} AS generated FROM answers""")
def f11_eval_dpo(spark: SparkSession, d: str) -> DataFrame:
    from tutelage.functions.templates import dpo_prompt

    inv = T.invoice_answers(spark, d)
    examples = inv.select("id", F.col("text").alias("prompt"), F.col("reference").alias("chosen"), F.col("answer").alias("rejected"),
                          F.concat(dpo_prompt("text", True), F.lit("\n"), "answer").alias("generated"))
    return E.eval_rows(examples, "dpo", idp_mode=True)


@query("a6_write_results", f"""WITH {SFT_RESULTS} SELECT a.id, md5({STRIPPED_ANSWER}) AS generated_md5, round(perplexity, 3) AS perplexity, valid_json, num_fields, num_matched_fields
FROM answers a JOIN ppl USING (id) JOIN je USING (id)""")
def a6_write_results(spark: SparkSession, d: str) -> DataFrame:
    rows = sft_results(spark, d)
    path = sinks.write_results(rows, fresh_path(spark, "model"), "sft", compression="gzip")
    back = spark.read.schema(rows.schema).json(path)
    return back.select("id", F.md5("generated").alias("generated_md5"), F.round("perplexity", 3).alias("perplexity"), "json_eval.valid_json",
                       F.col("json_eval.num_fields").cast("long").alias("num_fields"), F.col("json_eval.num_matched_fields").cast("long").alias("num_matched_fields"))


_FIELDS = ("invoice_number", "invoice_date", "vendor_name", "total_amount", "currency")


@query("f15_field_prf", f"""WITH {T.SQL_ANSWERS}, o AS (SELECT {_sql_object('answer')} AS g, gold_json AS r FROM answers),
f AS ({' UNION ALL '.join(f"SELECT '{n}' AS field, json_extract_string(g, '$.{n}') AS gen, json_extract_string(r, '$.{n}') AS ref FROM o" for n in _FIELDS)}),
c AS (SELECT field, count(gen) AS n_extracted, count(ref) AS n_expected, count(*) FILTER (gen = ref) AS n_right FROM f GROUP BY field)
SELECT *, round(coalesce(n_right / nullif(n_extracted, 0), 0), 6) AS precision, round(coalesce(n_right / nullif(n_expected, 0), 0), 6) AS recall FROM c""")
def f15_field_prf(spark: SparkSession, d: str) -> DataFrame:
    return rounded(E.field_prf(T.invoice_answers(spark, d), "answer", "reference", _FIELDS), "precision", "recall")
