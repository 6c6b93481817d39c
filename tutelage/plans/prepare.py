"""Queries on sources, sinks, prompts, samples and tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.functions import constants as K
from tutelage.functions import templates as P
from tutelage.functions.text import parse_sections, py_strip, strip_prompt
from tutelage.operators import datasets as D
from tutelage.operators import ranking as R
from tutelage.operators import routing, sampling, tokens
from tutelage.operators.metrics import accuracy
from tutelage.operators.evaluation import metric_rows
from tutelage.plans import tables as T
from tutelage.plans.registry import query, quote, sql_render
from tutelage.session import fresh_path
from tutelage.sources import readers, sinks

# --- sources and sinks -----------------------------------------------------------------------

BALANCED_DOCS = T.SQL_LABELLED + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY answer ORDER BY md5('7:' || id), id) AS rn FROM labelled_docs),
kept AS (SELECT * FROM ranked WHERE rn <= (SELECT min(c) FROM (SELECT count(*) AS c FROM labelled_docs GROUP BY answer)))"""

BALANCED_ORDERS = T.SQL_CREDIT + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY answer ORDER BY md5('7:' || id), id) AS rn FROM credit_orders),
kept AS (SELECT * FROM ranked WHERE rn <= (SELECT min(c) FROM (SELECT count(*) AS c FROM credit_orders GROUP BY answer)))"""

TRAIN_PROMPT = sql_render(K.CREDIT_TRAIN_PROMPT, "question")
REJECTED = """CASE WHEN substr(md5('neg:7:' || id), 1, 1) < '8'
    THEN CASE answer WHEN 'Good' THEN 'Standard' ELSE 'Good' END
    ELSE CASE answer WHEN 'Bad' THEN 'Standard' ELSE 'Bad' END END"""


@query("a1_read_labeled", f"WITH {T.SQL_CREDIT} SELECT id, question, answer FROM credit_orders")
def a1_read_labeled(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "labelled")
    T.credit_orders(spark, d).write.json(path)
    return readers.read_labeled(spark, path, id_col="id", lines=True)


@query("a1_read_labeled_array", f"WITH {T.SQL_CREDIT} SELECT id, question, answer FROM credit_orders")
def a1_read_labeled_array(spark: SparkSession, d: str) -> DataFrame:
    """Files of one array each, of the labelled orders of 10,000 ids."""
    path = fresh_path(spark, "arrays")
    arrays = T.credit_orders(spark, d).groupBy(F.floor(F.col("id") / 10_000)).agg(F.to_json(F.collect_list(F.struct("id", "question", "answer"))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_labeled(spark, path, id_col="id")


@query("a1_array_positions", f"WITH {T.SQL_CREDIT} SELECT count(*) AS n, count(*) AS n_ids, 0 AS first_id, count(*) - 1 AS last_id, CAST(sum(id) AS BIGINT) AS keys FROM credit_orders")
def a1_array_positions(spark: SparkSession, d: str) -> DataFrame:
    """Array files without ids: their elements are numbered without a gap over all files, and each is there once."""
    path = fresh_path(spark, "arrays")
    keyed = F.struct(F.concat(F.lit('{"'), F.col("id").cast("string")).alias("question"), "answer")
    arrays = T.credit_orders(spark, d).groupBy(F.floor(F.col("id") / 10_000)).agg(F.to_json(F.collect_list(keyed)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    rows = readers.read_labeled(spark, path)
    return rows.agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"), F.min("id").cast("int").alias("first_id"), F.max("id").alias("last_id"),
                    F.sum(F.substring("question", 3, 20).cast("bigint")).alias("keys"))


def _written(spark: SparkSession, d: str, method: str) -> str:
    return sinks.write_distill_sets({method: D.build_sets(T.labelled_docs(spark, d))[method]}, fresh_path(spark, "sets"))[method]


@query("a2_read_sft", f"WITH {BALANCED_DOCS} SELECT {TRAIN_PROMPT} AS input, answer AS output FROM kept")
def a2_read_sft(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_sft(spark, _written(spark, d, "sft"))


@query("a3_read_kd", f"WITH {BALANCED_DOCS} SELECT {TRAIN_PROMPT} AS input, answer AS teacher_output, CAST(NULL AS VARCHAR) AS teacher_logits_path FROM kept")
def a3_read_kd(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_kd(spark, _written(spark, d, "kd"))


@query("a4_read_dpo", f"WITH {BALANCED_DOCS} SELECT {TRAIN_PROMPT} AS prompt, answer AS chosen, {REJECTED} AS rejected FROM kept")
def a4_read_dpo(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_dpo(spark, _written(spark, d, "dpo"))


@query("a5_write_distill_sets", f"""WITH {BALANCED_ORDERS}
SELECT 'sft' AS method, md5({TRAIN_PROMPT}) AS prompt_md5, answer AS target FROM kept
UNION ALL SELECT 'kd', md5({TRAIN_PROMPT}), answer FROM kept
UNION ALL SELECT 'dpo', md5({TRAIN_PROMPT}), answer || '/' || {REJECTED} FROM kept""")
def a5_write_distill_sets(spark: SparkSession, d: str) -> DataFrame:
    paths = sinks.write_distill_sets(D.build_sets(T.credit_orders(spark, d), written=True), fresh_path(spark, "sets"))
    out = [(readers.read_sft(spark, paths["sft"]), "sft", "input", F.col("output")),
           (readers.read_kd(spark, paths["kd"]), "kd", "input", F.col("teacher_output")),
           (readers.read_dpo(spark, paths["dpo"]), "dpo", "prompt", F.concat_ws("/", "chosen", "rejected"))]
    parts = [df.select(F.lit(m).alias("method"), F.md5(p).alias("prompt_md5"), t.alias("target")) for df, m, p, t in out]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("a5_commit_distill_sets", f"""WITH {BALANCED_DOCS}
SELECT 'sft' AS method, md5({TRAIN_PROMPT}) AS prompt_md5, answer AS target FROM kept
UNION ALL SELECT 'kd', md5({TRAIN_PROMPT}), answer FROM kept
UNION ALL SELECT 'dpo', md5({TRAIN_PROMPT}), answer || '/' || {REJECTED} FROM kept""")
def a5_commit_distill_sets(spark: SparkSession, d: str) -> DataFrame:
    """One commit for all sets of a run; the run is written a second time and counts once."""
    sets, root = D.build_sets(T.labelled_docs(spark, d), written=True), fresh_path(spark, "runs")
    for _ in range(2):
        sinks.commit_distill_sets(sets, root, "run-1")
    back = sinks.read_distill_sets(spark, root)
    out = [("sft", "input", F.col("output")), ("kd", "input", F.col("teacher_output")), ("dpo", "prompt", F.concat_ws("/", "chosen", "rejected"))]
    parts = [back[m].select(F.lit(m).alias("method"), F.md5(p).alias("prompt_md5"), t.alias("target")) for m, p, t in out]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("a7_log_run", f"""WITH {T.SQL_ORDER_LABELS}, {T.sql_teacher('order_labels')}
SELECT 'metric' AS kind, 'run-1' AS run_id, 'accuracy' AS key, round(avg(CAST(o.answer = t.label AS DOUBLE)), 6) AS value FROM order_labels o JOIN teacher t USING (id)
UNION ALL SELECT 'metric', 'run-1', 'n', count(*) FROM order_labels
UNION ALL SELECT 'param', 'run-1', 'batch_size', 4""")
def a7_log_run(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "runs")
    gold = T.order_labels(spark, d)
    joined = gold.join(T.teacher(gold).select("id", F.col("label").alias("prediction")), "id")
    for _ in range(2):  # a run that is logged again counts once
        sinks.log_run(metric_rows(accuracy(joined)), "run-1", path)
    sinks.log_run(spark.range(1).select(F.lit("batch_size").alias("key"), F.lit("4").alias("value")), "run-1", path, "param")
    return sinks.read_runs(spark, path).withColumn("value", F.round(F.col("value").cast("double"), 6))


@query("a8_pairs_from_turns", f"WITH {T.SQL_PAIRS} SELECT conv_id, turn, input, output FROM turn_pairs")
def a8_pairs_from_turns(spark: SparkSession, d: str) -> DataFrame:
    return T.pairs(spark, d)


# --- text and prompts ------------------------------------------------------------------------

@query("b1_py_strip", "SELECT doc_id, md5(trim(chr(160) || chr(9) || text || chr(10) || chr(8195), ' ' || chr(9) || chr(10) || chr(160) || chr(8195))) AS stripped_md5 FROM documents")
def b1_py_strip(spark: SparkSession, d: str) -> DataFrame:
    padded = F.concat(F.lit("\u00a0\t"), F.col("text"), F.lit("\n\u2003"))
    return T.documents(spark, d).select("doc_id", F.md5(py_strip(padded)).alias("stripped_md5"))


@query("b2_valid_labels", f"SELECT d.doc_id AS id, d.n_chars, {T._DOC_LABEL} AS answer FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def b2_valid_labels(spark: SparkSession, d: str) -> DataFrame:
    return sampling.valid_labels(T.raw_docs(spark, d))


@query("b3_credit_train_prompt", f"WITH {T.SQL_CREDIT} SELECT id, {TRAIN_PROMPT} AS prompt FROM credit_orders")
def b3_credit_train_prompt(spark: SparkSession, d: str) -> DataFrame:
    return T.credit_orders(spark, d).select("id", P.credit_train_prompt("question").alias("prompt"))


def sql_chat(expr: str) -> str:
    turn = lambda role, content: sql_render(K.CHAT_TURN, quote(role), content)
    return f"({turn('system', quote(K.CREDIT_SCORE_SYSTEM))} || {turn('user', sql_render(K.CREDIT_SCORE_USER, expr))} || {quote(K.CHAT_ASSISTANT_START)})"


@query("b4_credit_chat_prompt", f"WITH {T.SQL_CREDIT} SELECT id, {sql_chat('question')} AS prompt FROM credit_orders")
def b4_credit_chat_prompt(spark: SparkSession, d: str) -> DataFrame:
    return T.credit_orders(spark, d).select("id", P.credit_chat_prompt("question").alias("prompt"))




def _sql_mode(doc: str, code: str) -> str:
    return f"CASE WHEN turn % 2 = 0 THEN {sql_render(doc, 'text')} ELSE {sql_render(code, 'text')} END"


@query("b5_kd_prompt", f"SELECT conv_id, turn, {_sql_mode(K.KD_DOCUMENT_PROMPT, K.KD_CODE_PROMPT)} AS prompt FROM conversations")
def b5_kd_prompt(spark: SparkSession, d: str) -> DataFrame:
    return T.turns(spark, d).select("conv_id", "turn", P.kd_prompt("text", _idp()).alias("prompt"))


@query("b6_dpo_prompt", f"SELECT conv_id, turn, {_sql_mode(K.DPO_DOCUMENT_PROMPT, K.DPO_CODE_PROMPT)} AS prompt FROM conversations")
def b6_dpo_prompt(spark: SparkSession, d: str) -> DataFrame:
    return T.turns(spark, d).select("conv_id", "turn", P.dpo_prompt("text", _idp()).alias("prompt"))


@query("b7_sft_prompt", "SELECT conv_id, turn, text AS prompt FROM conversations")
def b7_sft_prompt(spark: SparkSession, d: str) -> DataFrame:
    return T.turns(spark, d).select("conv_id", "turn", P.sft_prompt("text").alias("prompt"))


@query("b8_format_prompt", f"""SELECT conv_id, turn, CASE conv_id % 4
  WHEN 0 THEN {_sql_mode(K.DPO_DOCUMENT_PROMPT, K.DPO_CODE_PROMPT)} WHEN 1 THEN {_sql_mode(K.KD_DOCUMENT_PROMPT, K.KD_CODE_PROMPT)}
  WHEN 2 THEN text ELSE '' END AS prompt FROM conversations""")
def b8_format_prompt(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("conv_id") % 4
    method = F.when(m == 0, "dpo").when(m == 1, "kd").when(m == 2, "sft").otherwise("other")
    return T.turns(spark, d).select("conv_id", "turn", P.format_prompt("text", method, _idp()).alias("prompt"))


@query("b8_served_prompt", f"""WITH {T.SQL_REQUESTS} SELECT event_id, CASE flow WHEN 'idp' THEN {sql_render(K.KD_DOCUMENT_PROMPT, 'features')}
  WHEN 'codegen' THEN {sql_render(K.KD_CODE_PROMPT, 'features')} ELSE features END AS prompt FROM requests""")
def b8_served_prompt(spark: SparkSession, d: str) -> DataFrame:
    return T.requests(spark, d).select("event_id", P.served_prompt("features", F.col("flow")).alias("prompt"))


@query("b9_idp_infer_prompt", f"WITH {T.SQL_INVOICES} SELECT id, {sql_render(K.IDP_INFER_PROMPT, 'text')} AS prompt FROM invoices")
def b9_idp_infer_prompt(spark: SparkSession, d: str) -> DataFrame:
    return T.invoices(spark, d).select("id", P.idp_infer_prompt("text").alias("prompt"))


@query("b10_codegen_infer_prompt", f"SELECT conv_id, turn, {_sql_mode(K.CODE_PLAN_INFER_PROMPT, K.CODE_INFER_PROMPT)} AS prompt FROM conversations")
def b10_codegen_infer_prompt(spark: SparkSession, d: str) -> DataFrame:
    return T.turns(spark, d).select("conv_id", "turn", P.codegen_infer_prompt("text", _idp()).alias("prompt"))


@query("b11_supervised_text", f"WITH {T.SQL_PAIRS} SELECT conv_id, turn, input || chr(10) || chr(10) || output AS text FROM turn_pairs")
def b11_supervised_text(spark: SparkSession, d: str) -> DataFrame:
    return T.pairs(spark, d).select("conv_id", "turn", P.supervised_text("input", "output").alias("text"))


@query("b12_few_shot_prompt", f"""WITH {T.SQL_CREDIT},
ex AS (SELECT *, row_number() OVER (PARTITION BY answer ORDER BY md5('42:' || id), id) AS rn FROM credit_orders),
block AS (SELECT string_agg({sql_render(K.FEW_SHOT_CASE, 'question', 'answer')}, '' ORDER BY CASE answer WHEN 'Good' THEN 1 WHEN 'Bad' THEN 2 ELSE 3 END, rn) AS b FROM ex WHERE rn <= 2)
SELECT id, md5({sql_render(K.TEACHER_SYSTEM_PROMPT, '(SELECT b FROM block)')}) AS system_md5, {sql_render(K.TEACHER_USER_PROMPT, 'question')} AS user_prompt FROM credit_orders""")
def b12_few_shot_prompt(spark: SparkSession, d: str) -> DataFrame:
    pool = T.credit_orders(spark, d)
    system = P.few_shot_prompt(sampling.few_shot_sample(pool))
    return pool.select("id", F.md5(system.scalar()).alias("system_md5"), P.teacher_user_prompt("question").alias("user_prompt"))


STRIPPED_ANSWER = "trim(answer, ' ' || chr(9) || chr(10) || chr(13))"


@query("b13_strip_prompt", f"WITH {T.SQL_GENERATIONS} SELECT id, {STRIPPED_ANSWER} AS response FROM generations JOIN answers USING (id)")
def b13_strip_prompt(spark: SparkSession, d: str) -> DataFrame:
    return T.generations(spark, d).select("id", strip_prompt("generated", "prompt").alias("response"))


@query("b14_encode_label", f"""WITH {T.SQL_ORDER_LABELS} SELECT id, CASE answer WHEN 'Bad' THEN 0 WHEN 'Standard' THEN 1 ELSE 2 END AS label_id,
  CASE answer WHEN 'Bad' THEN 0 WHEN 'Good' THEN 1 ELSE 2 END AS class_id, answer AS decoded FROM order_labels""")
def b14_encode_label(spark: SparkSession, d: str) -> DataFrame:
    coded = D.class_encode(T.order_labels(spark, d), "answer", "class_id").withColumn("label_id", D.encode_label("answer"))
    return coded.select("id", "label_id", "class_id", D.decode_label("label_id").alias("decoded"))


@query("b14_class_encode_parts", """SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY l_partkey) - 1 AS INT) AS part_id FROM lineitem""")
def b14_class_encode_parts(spark: SparkSession, d: str) -> DataFrame:
    lines = T.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return D.class_encode(lines, "l_partkey", "part_id").select("l_orderkey", "l_linenumber", "part_id")


@query("b15_prune_rename", f"WITH {T.SQL_LABELLED} SELECT question AS text, CASE answer WHEN 'Bad' THEN 0 WHEN 'Standard' THEN 1 ELSE 2 END AS labels FROM labelled_docs")
def b15_prune_rename(spark: SparkSession, d: str) -> DataFrame:
    return (T.labelled_docs(spark, d).withColumn("labels", D.encode_label("answer")).withColumnRenamed("question", "text").drop("id", "answer"))


NULLS_SQL = "(VALUES " + ", ".join(f"({i}, {quote(t or ' ')})" for i, t in enumerate(K.NULL_FEATURES)) + ") AS n(null_id, features)"


@query("b16_null_features", f"SELECT event_type AS model, null_id, features, {sql_chat('features')} AS prompt FROM (SELECT DISTINCT event_type FROM events), {NULLS_SQL}")
def b16_null_features(spark: SparkSession, d: str) -> DataFrame:
    models = T.table(spark, d, "events").select(F.col("event_type").alias("model")).distinct()
    return R.null_features(models)


@query("b17_features_text", f"WITH {T.SQL_CREDIT} SELECT id, question FROM credit_orders")
def b17_features_text(spark: SparkSession, d: str) -> DataFrame:
    return T.credit_orders(spark, d).select("id", "question")


@query("b18_route_models", f"""WITH {T.SQL_REQUESTS},
registry AS (SELECT flow || '_' || method || '_' || substr(run_id, 1, 8) AS model_key, flow, min(event_id) AS load_order FROM requests
  WHERE run_id IS NOT NULL AND event_id % 4 = 0 AND flow <> 'mlqa' AND method <> 'dpo' GROUP BY ALL),
firsts AS (SELECT flow, min_by(model_key, load_order) AS first_key FROM registry GROUP BY flow)
SELECT r.event_id, CASE WHEN r.run_id IS NULL THEN f.first_key ELSE g.model_key END AS model_key,
  CASE WHEN r.flow = 'codegen' THEN {quote(K.DEFAULT_BASE_BY_FLOW['codegen'])} ELSE {quote(K.DEFAULT_BASE_OTHER_FLOW)} END AS base_model,
  CASE WHEN r.method = 'sft' THEN {quote(K.DEFAULT_BASE_BY_METHOD['sft'])} ELSE {quote(K.DEFAULT_BASE_BY_METHOD['kd'])} END AS method_base
FROM requests r LEFT JOIN registry g ON r.flow || '_' || r.method || '_' || substr(r.run_id, 1, 8) = g.model_key LEFT JOIN firsts f ON f.flow = r.flow""")
def b18_route_models(spark: SparkSession, d: str) -> DataFrame:
    reqs = T.requests(spark, d)
    routed = routing.route_models(reqs, T.registry(reqs))
    return routed.select("event_id", "model_key", "base_model", routing.default_base_by_method(F.col("method")).alias("method_base"))


@query("b19_parse_sections", f"""WITH {T.SQL_PAIRS} SELECT conv_id, turn, CASE WHEN turn % 4 < 2 THEN input END AS plan, output AS code FROM turn_pairs""")
def b19_parse_sections(spark: SparkSession, d: str) -> DataFrame:
    plan = F.when(F.col("turn") % 4 < 2, F.concat(F.lit("<PLAN>\n"), "input", F.lit("\n</PLAN>\n"))).otherwise("")
    tagged = F.concat(plan, F.lit("<CODE>\n"), "output", F.lit("\n</CODE>"))
    return T.pairs(spark, d).select("conv_id", "turn", parse_sections(tagged).alias("s")).select("conv_id", "turn", "s.plan", "s.code")


# --- samples -----------------------------------------------------------------------------------

@query("c1_class_distribution", f"""WITH {T.SQL_LABELLED} SELECT label, count(id) AS n FROM (VALUES ('Good'), ('Standard'), ('Bad')) v(label)
LEFT JOIN labelled_docs ON answer = label GROUP BY label""")
def c1_class_distribution(spark: SparkSession, d: str) -> DataFrame:
    return sampling.class_distribution(T.labelled_docs(spark, d))


@query("c1_value_counts", "SELECT coalesce(lang, 'none') || '/' || coalesce(source, 'none') AS label, count(*) AS n FROM documents GROUP BY 1")
def c1_value_counts(spark: SparkSession, d: str) -> DataFrame:
    slices = F.concat_ws("/", F.coalesce("lang", F.lit("none")), F.coalesce("source", F.lit("none")))
    return sampling.class_distribution(T.table(spark, d, "documents").select(slices.alias("slice")), "slice", labels=None)


@query("c2_balance", f"WITH {BALANCED_DOCS} SELECT id, answer, question FROM kept")
def c2_balance(spark: SparkSession, d: str) -> DataFrame:
    return sampling.balance(T.labelled_docs(spark, d)).select("id", "answer", "question")


@query("c2_balance_orders", f"WITH {BALANCED_ORDERS} SELECT id, answer, question FROM kept")
def c2_balance_orders(spark: SparkSession, d: str) -> DataFrame:
    return sampling.balance(T.credit_orders(spark, d)).select("id", "answer", "question")


@query("c3_balanced_val", f"""WITH {T.SQL_CREDIT}, c AS (SELECT answer, count(*) AS n FROM credit_orders GROUP BY answer),
q AS (SELECT least(greatest(1, greatest(1, floor(sum(n) * 0.1)) // 3), min(n)) AS k FROM c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY answer ORDER BY md5('7:' || id), id) AS rn FROM credit_orders)
SELECT id, answer, question FROM ranked WHERE rn <= (SELECT k FROM q)""")
def c3_balanced_val(spark: SparkSession, d: str) -> DataFrame:
    return sampling.balanced_val(T.credit_orders(spark, d)).select("id", "answer", "question")


@query("c3_balanced_val_excluded", f"""WITH {BALANCED_ORDERS},
pool AS (SELECT * FROM credit_orders WHERE id NOT IN (SELECT id FROM ranked WHERE rn <= 50)),
again AS (SELECT *, row_number() OVER (PARTITION BY answer ORDER BY md5('7:' || id), id) AS rn FROM pool)
SELECT id, answer, question FROM again WHERE rn <= 1500 AND rn <= (SELECT min(c) FROM (SELECT count(*) AS c FROM pool GROUP BY answer))""")
def c3_balanced_val_excluded(spark: SparkSession, d: str) -> DataFrame:
    pool = T.credit_orders(spark, d)
    train = sampling.balance(T.order_labels(spark, d), per_class=50)
    return sampling.balanced_val(pool, per_class=1500, exclude=train).select("id", "answer", "question")


@query("c4_stratified_n", f"""WITH {T.SQL_CREDIT} SELECT id, answer, question FROM (
  SELECT *, row_number() OVER (PARTITION BY answer ORDER BY md5('42:' || id), id) AS rn FROM credit_orders) WHERE rn <= 100""")
def c4_stratified_n(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified_n(T.credit_orders(spark, d), 100).select("id", "answer", "question")


@query("c4_stratified_parts", """SELECT l_partkey, id FROM (SELECT l_partkey, id, row_number() OVER (PARTITION BY l_partkey ORDER BY md5('42:' || id), id) AS rn
  FROM (SELECT l_partkey, l_orderkey * 10 + l_linenumber AS id FROM lineitem)) WHERE rn <= 1""")
def c4_stratified_parts(spark: SparkSession, d: str) -> DataFrame:
    lines = T.table(spark, d, "lineitem").select("l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return sampling.stratified_n(lines, 1, label_col="l_partkey").select("l_partkey", "id")


@query("c5_remainder", f"""WITH {T.SQL_CREDIT} SELECT id, answer, question FROM (
  SELECT *, row_number() OVER (PARTITION BY answer ORDER BY md5('42:' || id), id) AS rn FROM credit_orders) WHERE rn > 100""")
def c5_remainder(spark: SparkSession, d: str) -> DataFrame:
    pool = T.credit_orders(spark, d)
    return sampling.remainder(pool, sampling.stratified_n(T.order_labels(spark, d), 100)).select("id", "answer", "question")


@query("c6_few_shot_sample", f"""WITH {T.SQL_LABELLED} SELECT id, answer, md5('42:' || id) AS draw, md5(question) AS question_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY answer ORDER BY md5('42:' || id), id) AS rn FROM labelled_docs) WHERE rn <= 2""")
def c6_few_shot_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.few_shot_sample(T.labelled_docs(spark, d)).select("id", "answer", "draw", F.md5("question").alias("question_md5"))


@query("c7_train_test_split", f"""WITH {T.SQL_CREDIT} SELECT id, answer, question,
  CASE WHEN row_number() OVER (ORDER BY md5('42:' || id), id) <= (SELECT ceil(count(*) / 10) FROM credit_orders) THEN 'test' ELSE 'train' END AS split FROM credit_orders""")
def c7_train_test_split(spark: SparkSession, d: str) -> DataFrame:
    return sampling.split_column(T.credit_orders(spark, d), 0.1).select("id", "answer", "question", "split")


@query("c8_shuffle_rank", f"WITH {T.SQL_CREDIT} SELECT id, answer, question, row_number() OVER (ORDER BY md5('7:' || id), id) AS rank FROM credit_orders")
def c8_shuffle_rank(spark: SparkSession, d: str) -> DataFrame:
    return sampling.shuffle_rank(T.credit_orders(spark, d), K.BALANCE_SEED).select("id", "answer", "question", "rank")


@query("c9_head_n", f"WITH {T.SQL_CREDIT} SELECT id, answer, question FROM credit_orders ORDER BY id LIMIT 1500")
def c9_head_n(spark: SparkSession, d: str) -> DataFrame:
    return sampling.head_n(T.credit_orders(spark, d), 1500).select("id", "answer", "question")


@query("c10_negative_label", f"WITH {T.SQL_ORDER_LABELS} SELECT id, answer, {REJECTED} AS rejected FROM order_labels")
def c10_negative_label(spark: SparkSession, d: str) -> DataFrame:
    return T.order_labels(spark, d).select("id", "answer", D.negative_label("answer", "id").alias("rejected"))


@query("c11_build_sets", f"""WITH {BALANCED_DOCS}
SELECT 'sft' AS method, id, md5({TRAIN_PROMPT}) AS prompt_md5, answer AS target, CAST(NULL AS VARCHAR) AS rejected FROM kept
UNION ALL SELECT 'kd', id, md5({TRAIN_PROMPT}), answer, NULL FROM kept
UNION ALL SELECT 'dpo', id, md5({TRAIN_PROMPT}), answer, {REJECTED} FROM kept""")
def c11_build_sets(spark: SparkSession, d: str) -> DataFrame:
    sets = D.build_sets(T.labelled_docs(spark, d))
    none = F.lit(None).cast("string")
    part = lambda m, p, t, r: sets[m].select(F.lit(m).alias("method"), "id", F.md5(p).alias("prompt_md5"), F.col(t).alias("target"), r.alias("rejected"))
    return (part("sft", "input", "output", none).unionByName(part("kd", "input", "teacher_output", none))
            .unionByName(part("dpo", "prompt", "chosen", F.col("rejected"))))


# --- tokens ------------------------------------------------------------------------------------

def sql_tokens(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '[ \\t\\n\\r\\f]+'), lambda t: t <> '')"


def sql_ids(expr: str, max_len: int) -> str:
    return f"list_transform({sql_tokens(expr)}[1:{max_len}], lambda t: CAST(('0x' || substr(md5(t), 1, 7)) AS BIGINT) % {tokens.VOCAB_SIZE})"


def _joined(c: str):
    return F.md5(F.array_join(F.transform(c, lambda x: x.cast("string")), " "))


@query("d1_tokenize", f"""SELECT doc_id, len(ids) AS n_kept, md5(array_to_string(ids, ' ')) AS ids_md5
FROM (SELECT doc_id, {sql_ids('text', K.MAX_LEN)} AS ids FROM documents)""")
def d1_tokenize(spark: SparkSession, d: str) -> DataFrame:
    df = tokens.tokenize(T.documents(spark, d))
    return df.select("doc_id", F.size("input_ids").cast("long").alias("n_kept"), _joined("input_ids").alias("ids_md5"))


@query("d2_mask_prompt", f"""WITH {T.SQL_PAIRS}, e AS (SELECT conv_id, turn, {sql_ids('input || chr(10) || chr(10) || output', 128)} AS ids,
  len({sql_tokens('input')}[1:128]) AS p FROM turn_pairs)
SELECT conv_id, turn, array_to_string(ids, ' ') AS input_ids,
  array_to_string(list_concat(list_transform(range(least(p, len(ids))), lambda i: CAST(-100 AS BIGINT)), ids[p + 1:]), ' ') AS labels, len(ids) AS n_mask FROM e""")
def d2_mask_prompt(spark: SparkSession, d: str) -> DataFrame:
    df = tokens.mask_prompt(T.pairs(spark, d), "input", "output", max_len=K.STUDENT_MAX_LEN)
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), " ").alias(c)
    return df.select("conv_id", "turn", text("input_ids"), text("labels"), F.size("attention_mask").cast("long").alias("n_mask"))


@query("d3_pad", f"""SELECT doc_id, md5(array_to_string(list_concat(ids, list_transform(range(128 - len(ids)), lambda i: CAST(0 AS BIGINT))), ' ')) AS ids_md5,
  len(ids) AS n_real, 128 AS n_total FROM (SELECT doc_id, {sql_ids('text', 128)} AS ids FROM documents)""")
def d3_pad(spark: SparkSession, d: str) -> DataFrame:
    df = tokens.pad(tokens.tokenize(T.documents(spark, d), max_len=K.STUDENT_MAX_LEN), K.STUDENT_MAX_LEN)
    real = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)
    return df.select("doc_id", _joined("input_ids").alias("ids_md5"), real.cast("long").alias("n_real"), F.size("attention_mask").alias("n_total"))


@query("d4_length_report", f"""WITH {T.SQL_LABELLED}, l AS (SELECT len({sql_tokens(TRAIN_PROMPT)}) AS p, len({sql_tokens(TRAIN_PROMPT + " || chr(10) || chr(10) || answer")}) AS t FROM labelled_docs),
r AS (SELECT count(*) AS n, min(t) AS min_len, round(avg(t), 6) AS avg_len, quantile_cont(t, 0.5) AS p50_len, round(quantile_cont(t, 0.95), 6) AS p95_len, max(t) AS max_len,
  count(*) FILTER (t > 2048) AS n_truncated, count(*) FILTER (least(p, 2048) >= least(t, 2048)) AS n_unsupervised FROM l)
SELECT *, CAST(ceil(n / 2) AS BIGINT) AS n_batches, CAST(ceil(ceil(n / 2) / 8) AS BIGINT) AS steps_per_epoch, CAST(ceil(ceil(n / 2) / 8) * 5 AS BIGINT) AS total_steps,
  CAST(floor(ceil(ceil(n / 2) / 8) * 5 * 0.03) AS BIGINT) AS warmup_steps FROM r""")
def d4_length_report(spark: SparkSession, d: str) -> DataFrame:
    df = T.labelled_docs(spark, d).select(P.credit_train_prompt("question").alias("prompt"), F.col("answer").alias("target"))
    out = tokens.length_report(df, epochs=5)
    long = [F.col(c).cast("long").alias(c) for c in ("min_len", "max_len")]
    rounded = [F.round(c, 6).alias(c) for c in ("avg_len", "p95_len")]
    rest = [c for c in out.columns if c not in ("min_len", "max_len", "avg_len", "p95_len")]
    return out.select(*rest, *long, *rounded)


def _idp():
    return F.col("turn") % 2 == 0
