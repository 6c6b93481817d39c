"""Queries on structured extraction, teacher and student, and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.functions import constants as K
from tutelage.functions.text import norm_date
from tutelage.operators import datasets as D
from tutelage.operators import extraction as X
from tutelage.operators import student
from tutelage.operators.joins import join_lookup
from tutelage.operators.steps import StepStudent, fit_steps
from tutelage.plans import tables as T
from tutelage.plans.prepare import NULLS_SQL, sql_chat, sql_tokens
from tutelage.plans.rank import LABEL_VALUES, rounded, sql_lm, sql_report, sql_score
from tutelage.plans.registry import query, sql_render
from tutelage.plans.scorer import CountScorer
from tutelage.plans.store import load_scorer, save_scorer
from tutelage.session import fresh_path
from tutelage.streaming.kpi import compact_partials, current_from, current_kpis, kpis, partials, rank_error, write_partials
from tutelage.streaming.scoring import score_stream, stored_score

# --- structured extraction ---------------------------------------------------------------------

_VIOLATION = """CASE WHEN h < '8' OR (h >= 'a' AND h < 'c') THEN '' WHEN h < 'a' THEN '$.currency: missing' WHEN h < 'f' THEN '$: not JSON'
  ELSE '$.total_amount: not number' END"""


@query("g1_validate_json", f"WITH {T.SQL_ANSWERS} SELECT id, {_VIOLATION} AS violations FROM answers")
def g1_validate_json(spark: SparkSession, d: str) -> DataFrame:
    checked = X.validate_json(T.invoice_answers(spark, d).select("id", "answer"), "answer")
    return checked.select("id", F.array_join("violations", "; ").alias("violations"))


@query("f15_schema_rate", f"""WITH {T.SQL_ANSWERS}, v AS (SELECT {_VIOLATION} AS v FROM answers)
SELECT CASE WHEN v = '' THEN 'conforms' ELSE v END AS violation, count(*) AS n, round(count(*) / (SELECT count(*) FROM v), 6) AS share FROM v GROUP BY 1
UNION ALL SELECT 'all', count(*), 1.0::DOUBLE FROM v""")
def f15_schema_rate(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.schema_rate(X.validate_json(T.invoice_answers(spark, d).select("id", "answer"), "answer")), "share")


@query("g2_to_records", f"""WITH {T.SQL_ANSWERS}, n AS (SELECT id, count(*) AS n_items, sum(q) AS total_qty FROM lines GROUP BY id)
SELECT id, number AS invoice_number, strftime(day, '%Y-%m-%d') AS invoice_date, vendor AS vendor_name, total_cents / 100 AS total_amount, currency, n_items, CAST(total_qty AS DOUBLE) AS total_qty
FROM answers JOIN n USING (id) WHERE h < '8' OR (h >= 'a' AND h < 'c')""")
def g2_to_records(spark: SparkSession, d: str) -> DataFrame:
    rec = X.to_records(T.invoice_answers(spark, d).select("id", "answer"), "answer")
    qty = F.aggregate("line_items", F.lit(0.0), lambda a, x: a + x["qty"])
    return rec.select("id", "invoice_number", "invoice_date", "vendor_name", F.round("total_amount", 2).alias("total_amount"), "currency",
                      F.size("line_items").cast("long").alias("n_items"), qty.alias("total_qty"))


@query("g3_extract_invoice", f"""WITH {T.SQL_INVOICES}, n AS (SELECT id, count(*) AS n_items FROM lines GROUP BY id)
SELECT id, number AS invoice_number, strftime(day, '%Y-%m-%d') AS invoice_date, vendor AS vendor_name, total_cents / 100 AS total_amount, currency, n_items FROM invoices JOIN n USING (id)""")
def g3_extract_invoice(spark: SparkSession, d: str) -> DataFrame:
    out = X.extract_invoice(T.invoices(spark, d).select("id", "text"))
    return out.select("id", "invoice_number", "invoice_date", "vendor_name", "total_amount", "currency", F.size("line_items").cast("long").alias("n_items"))


@query("g4_norm_date", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 < 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders""")
def g4_norm_date(spark: SparkSession, d: str) -> DataFrame:
    day, form = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 4
    text = (F.when(form == 0, F.date_format(day, "yyyy-MM-dd")).when(form == 1, F.date_format(day, "dd MMM yyyy"))
            .when(form == 2, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "yyyy.MM.dd")))
    return T.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.date_format(norm_date(text), "yyyy-MM-dd").alias("iso"))


@query("g5_line_items", f"""WITH {T.SQL_LINES} SELECT o_orderkey AS id, CAST(pos AS INT) AS pos, description, CAST(q AS DOUBLE) AS qty, u / 100 AS unit_price, round(q * u / 100, 2) AS amount
FROM lines JOIN orders ON o_orderkey = id JOIN customer ON c_custkey = o_custkey""")
def g5_line_items(spark: SparkSession, d: str) -> DataFrame:
    return X.line_items(T.invoices(spark, d))


@query("g5_reconcile", f"""WITH {T.SQL_INVOICES} SELECT id, total_cents / 100 AS stated_total, items_cents / 100 AS items_total, (total_cents - items_cents) / 100 AS difference,
total_cents = items_cents AS balanced FROM invoices""")
def g5_reconcile(spark: SparkSession, d: str) -> DataFrame:
    out = X.reconcile(T.invoices(spark, d).select("id", "text"))
    return out.select("id", "balanced", *[F.col(c).cast("double").alias(c) for c in ("stated_total", "items_total", "difference")])


@query("g6_why_coverage", f"""WITH {T.SQL_INVOICES} SELECT id, CASE WHEN substr(md5('why:' || id), 1, 1) < '8' THEN 'invoice_number vendor_name total_amount' ELSE 'invoice_number total_amount' END AS explained,
CASE WHEN substr(md5('why:' || id), 1, 1) < '8' THEN 'invoice_date currency line_items' ELSE 'invoice_date vendor_name currency line_items' END AS unexplained FROM invoices""")
def g6_why_coverage(spark: SparkSession, d: str) -> DataFrame:
    out = X.why_coverage(T.invoices(spark, d).select("id", "gold_json"), "gold_json")
    return out.select("id", F.array_join("explained", " ").alias("explained"), F.array_join("unexplained", " ").alias("unexplained"))


def annotations(spark: SparkSession, d: str) -> DataFrame:
    """Teacher answers as JSON text; some lack a reason, some name a label that does not exist."""
    t = T.teacher(T.order_labels(spark, d))
    k = F.col("id") % 10
    label = F.when(k == 1, "Excellent").otherwise(F.col("label"))
    both = F.concat(F.lit('{"reason": "'), "reason", F.lit('", "label": "'), label, F.lit('"}'))
    return t.select("id", F.when(k == 0, F.concat(F.lit('{"label": "'), label, F.lit('"}'))).otherwise(both).alias("annotation"))


@query("g7_valid_annotations", f"WITH {T.SQL_ORDER_LABELS}, {T.sql_teacher('order_labels')} SELECT id, reason, label FROM teacher WHERE id % 10 > 1")
def g7_valid_annotations(spark: SparkSession, d: str) -> DataFrame:
    return D.valid_annotations(annotations(spark, d)).select("id", "reason", "label")


@query("g8_pair_quality", f"""WITH {T.SQL_ANSWERS}, v AS (SELECT CASE WHEN h < '8' THEN 'same' WHEN h >= 'a' AND h < 'c' THEN 'both conform' ELSE 'clear' END AS verdict FROM answers)
SELECT verdict, count(*) AS n FROM v GROUP BY verdict""")
def g8_pair_quality(spark: SparkSession, d: str) -> DataFrame:
    pairs = T.invoice_answers(spark, d).select("id", F.col("reference").alias("chosen"), F.col("answer").alias("rejected"))
    return X.pair_quality(pairs).groupBy("verdict").agg(F.count("*").alias("n"))


# --- teacher and student -----------------------------------------------------------------------

@query("h1_join_teacher", f"""WITH {T.SQL_CREDIT}, {T.sql_teacher('credit_orders')} SELECT id, question, answer, reason AS teacher_reason, label AS teacher_label
FROM credit_orders JOIN teacher USING (id) WHERE id % 10 > 1""")
def h1_join_teacher(spark: SparkSession, d: str) -> DataFrame:
    return D.join_teacher(T.credit_orders(spark, d), D.valid_annotations(annotations(spark, d)))


@query("h2_kd_rows", f"""WITH {T.SQL_CREDIT}, {T.sql_teacher('credit_orders')} SELECT id, {sql_render(K.CREDIT_TRAIN_PROMPT, 'question')} AS input,
CASE WHEN id % 10 > 1 THEN label ELSE answer END AS teacher_output FROM credit_orders JOIN teacher USING (id)""")
def h2_kd_rows(spark: SparkSession, d: str) -> DataFrame:
    ann = D.valid_annotations(annotations(spark, d)).select("id", F.col("label").alias("teacher_label"))
    return D.kd_rows(T.credit_orders(spark, d).join(ann, "id", "left"), "teacher_label")


def taught_docs(spark: SparkSession, d: str) -> DataFrame:
    return D.join_teacher(T.labelled_docs(spark, d), T.teacher(T.labelled_docs(spark, d).select("id", "answer")))


_HELD_OUT = f"""{T.SQL_LABELLED}, {T.sql_teacher('labelled_docs')},
held AS (SELECT id, answer, label AS teacher_label, array_to_string(list_filter(string_split_regex(question, '[ \\t\\r\\n]+'), lambda w: w <> '')[1:{K.STUDENT_MAX_LEN}], ' ') AS question,
  CASE WHEN row_number() OVER (ORDER BY md5('42:' || id), id) <= (SELECT ceil(count(*) / 5) FROM labelled_docs) THEN 'test' ELSE 'train' END AS split
  FROM labelled_docs JOIN teacher USING (id))"""


@query("h3_held_out", f"WITH {_HELD_OUT} SELECT id, answer, teacher_label, split, md5(question) AS question_md5 FROM held")
def h3_held_out(spark: SparkSession, d: str) -> DataFrame:
    return student.student_inputs(taught_docs(spark, d)).select("id", "answer", "teacher_label", "split", F.md5("question").alias("question_md5"))


@query("h4_teacher_vs_gold", f"""WITH {_HELD_OUT} SELECT 'teacher vs gold' AS compared, round(avg(CASE WHEN answer = teacher_label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
count(*) AS n FROM held WHERE split = 'test'""")
def h4_teacher_vs_gold(spark: SparkSession, d: str) -> DataFrame:
    held_out = student.student_inputs(taught_docs(spark, d)).filter(F.col("split") == "test").select("answer", "teacher_label")
    report = student.student_report(held_out.withColumn("prediction", F.col("teacher_label")))
    return rounded(report.filter(F.col("compared") == "teacher vs gold").select("compared", "accuracy", "n"), "accuracy")


def student_rows(spark: SparkSession, d: str) -> DataFrame:
    """``(id, answer, teacher_label, prediction)`` of the rows the student was not shown."""
    model, held_out = student.train_student(taught_docs(spark, d))
    return student.student_predict(model, held_out).select("id", "answer", "teacher_label", "prediction")


@query("h3_train_student")
def h3_train_student(spark: SparkSession, d: str) -> DataFrame:
    return student_rows(spark, d)


STEPS, STEP_FEATURES, STEP_RATE, STEP_PENALTY = 6, 256, 5.0, 1e-3


def sql_steps(rounds: int, n: int = STEP_FEATURES, rate: float = STEP_RATE, penalty: float = STEP_PENALTY) -> str:
    """CTEs ending in ``w{rounds}(f, label, w)`` and ``b{rounds}(label, b)``: the weights after so many steps."""
    parts = [f"""lab(label, place) AS (VALUES ('Good', 1), ('Standard', 2), ('Bad', 3)),
x AS MATERIALIZED (SELECT id, f, count(*) / sum(count(*)) OVER (PARTITION BY id) AS tf FROM
  (SELECT id, CAST('0x' || substr(md5(t), 1, 7) AS BIGINT) % {n} AS f FROM (SELECT id, unnest({sql_tokens('question')}) AS t FROM held)) GROUP BY id, f),
tr AS (SELECT id, teacher_label AS y FROM held WHERE split = 'train'),
w0 AS (SELECT f, label, CAST(0 AS DOUBLE) AS w FROM range({n}) r(f), lab), b0 AS (SELECT label, CAST(0 AS DOUBLE) AS b FROM lab)"""]
    for i in range(rounds):
        parts.append(f"""e{i} AS MATERIALIZED (SELECT id, label, p / sum(p) OVER (PARTITION BY id) - CAST(y = label AS INT) AS e FROM (SELECT id, y, label, exp(z - max(z) OVER (PARTITION BY id)) AS p FROM
  (SELECT id, any_value(y) AS y, w.label, sum(tf * w) + any_value(b) AS z FROM tr JOIN x USING (id) JOIN w{i} w USING (f) JOIN b{i} USING (label) GROUP BY id, w.label)))""")
        parts.append(f"""w{i + 1} AS MATERIALIZED (SELECT w.f, w.label, w - {rate} * (coalesce(g, 0) / (SELECT count(*) FROM tr) + {penalty} * w) AS w
  FROM w{i} w LEFT JOIN (SELECT f, label, sum(tf * e) AS g FROM e{i} JOIN x USING (id) GROUP BY f, label) g ON g.f = w.f AND g.label = w.label)""")
        parts.append(f"b{i + 1} AS MATERIALIZED (SELECT label, b - {rate} * avg(e) AS b FROM b{i} JOIN e{i} USING (label) GROUP BY label, b)")
    return ",\n".join(parts)


def step_student(spark: SparkSession, d: str) -> tuple[StepStudent, DataFrame]:
    return fit_steps(taught_docs(spark, d), rounds=STEPS, rate=STEP_RATE, penalty=STEP_PENALTY, n_features=STEP_FEATURES)


@query("h3_student_steps", f"""WITH {_HELD_OUT}, {sql_steps(STEPS)} SELECT CAST(f AS INT) AS feature, label, round(w, 6) AS weight FROM w{STEPS}
UNION ALL SELECT -1, label, round(b, 6) FROM b{STEPS}""")
def h3_student_steps(spark: SparkSession, d: str) -> DataFrame:
    return step_student(spark, d)[0].frame(spark).withColumn("weight", F.round("weight", 6))


_STUDENT_ROWS = f"""{_HELD_OUT}, {sql_steps(STEPS)},
z AS (SELECT id, w.label, place, sum(tf * w) + any_value(b) AS z FROM held JOIN x USING (id) JOIN w{STEPS} w USING (f) JOIN b{STEPS} USING (label) JOIN lab USING (label) WHERE split = 'test' GROUP BY id, w.label, place),
s AS (SELECT id, answer, teacher_label, arg_max(label, (z, -place)) AS student FROM z JOIN held USING (id) GROUP BY ALL)"""


def _sql_compared(name: str, truth: str, predicted: str) -> str:
    rows = f"(SELECT {truth} AS answer, {predicted} AS prediction FROM s)"
    return f"""SELECT '{name}' AS compared, (SELECT round(avg(CAST(answer = prediction AS INT)), 6) FROM {rows}) AS accuracy, (SELECT count(*) FROM s) AS n, round(avg(f1), 6) AS macro_f1 FROM {sql_report(rows)}"""


@query("h4_student_report", f"""WITH {_STUDENT_ROWS} {_sql_compared('student vs teacher', 'teacher_label', 'student')} UNION ALL
{_sql_compared('student vs gold', 'answer', 'student')} UNION ALL {_sql_compared('teacher vs gold', 'answer', 'teacher_label')}""")
def h4_student_report(spark: SparkSession, d: str) -> DataFrame:
    student_model, held_out = step_student(spark, d)
    return rounded(student.student_report(student_model.predict(held_out).select("answer", "teacher_label", "prediction")), "accuracy", "macro_f1")


# --- streams -----------------------------------------------------------------------------------

EVENT_COLUMNS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
REQUEST_KEYS = ("event_id", "ts", "latency_ms")


def scored_stream(spark: SparkSession, d: str) -> str:
    """Run the request stream to its end and give the folder of its answers."""
    scorer = CountScorer.fit(T.spread(T.credit_orders(spark, d), "id"))
    customer = T.table(spark, d, "customer")
    events = spark.readStream.schema(EVENT_COLUMNS).option("pathGlobFilter", "events*.parquet").parquet(d)
    out, state = fresh_path(spark, "scored"), fresh_path(spark, "scored-state")
    score_stream(events, lambda batch: scorer.respond(T.as_requests(batch, customer), "features", REQUEST_KEYS), out, state).awaitTermination()
    return out


SCORED = f"""{T.SQL_CREDIT}, {T.SQL_REQUESTS}, {sql_lm('credit_orders')},
prompts AS (SELECT event_id, {sql_chat('features')} AS prompt FROM requests), nulls AS (SELECT null_id, {sql_chat('features')} AS prompt FROM {NULLS_SQL}),
prior AS (SELECT label, avg(raw) AS prior FROM {sql_score('nulls', 'null_id', 'prompt')} GROUP BY label),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY score DESC, place) AS rk FROM
  (SELECT s.event_id, s.label, place, raw - prior AS score FROM {sql_score('prompts', 'event_id', 'prompt')} s JOIN prior USING (label) JOIN {LABEL_VALUES} ON lab.label = s.label)),
scored AS (SELECT event_id, max(label) FILTER (rk = 1) AS prediction, max(score) FILTER (rk = 1) - max(score) FILTER (rk = 2) AS top2_margin FROM ranked GROUP BY event_id)"""


@query("i1_score_stream", f"WITH {SCORED} SELECT event_id, prediction, round(top2_margin, 6) AS top2_margin, latency_ms FROM scored JOIN requests USING (event_id)")
def i1_score_stream(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(scored_stream(spark, d)).select("event_id", "prediction", F.round("top2_margin", 6).alias("top2_margin"), "latency_ms")


@query("i1_replayed_stream", f"WITH {SCORED} SELECT event_id, prediction, round(top2_margin, 6) AS top2_margin, latency_ms FROM scored JOIN requests USING (event_id)")
def i1_replayed_stream(spark: SparkSession, d: str) -> DataFrame:
    """All requests sent twice, the second time in later micro-batches, and each answered once by the stored scorer."""
    scorer, root = CountScorer.fit(T.credit_orders(spark, d)), fresh_path(spark, "store")
    save_scorer(scorer, root, "credit", "v1")
    scorer.lm.unpersist()
    folder, requests = fresh_path(spark, "requests"), T.requests(spark, d).select(*REQUEST_KEYS, "features")
    requests.write.parquet(folder)
    first = spark.read.schema(requests.schema).parquet(folder).inputFiles()
    requests.write.mode("append").parquet(folder)
    # Without a limit all files are one micro-batch; the earliest come first, so with that of the first sending the second comes after it.
    stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", len(first)).parquet(folder)
    out, state = fresh_path(spark, "scored"), fresh_path(spark, "scored-state")
    score_stream(stream, stored_score(root, "credit", "features", REQUEST_KEYS), out, state, id_cols=("event_id",), within="3650 days").awaitTermination()
    return spark.read.parquet(out).select("event_id", "prediction", F.round("top2_margin", 6).alias("top2_margin"), "latency_ms")


@query("e10_from_store", f"""WITH {SCORED} SELECT event_id, prediction, round(top2_margin, 6) AS top2_margin, 'v1' AS version, sha256(features) AS input_sha256
FROM scored JOIN requests USING (event_id)""")
def e10_from_store(spark: SparkSession, d: str) -> DataFrame:
    """Requests answered by a scorer that was stored and loaded, as audit rows."""
    scorer, root = CountScorer.fit(T.credit_orders(spark, d)), fresh_path(spark, "store")
    save_scorer(scorer, root, "credit", "v1")
    scorer.lm.unpersist()
    answers = load_scorer(spark, root, "credit", labels=K.LABELS).audit(T.requests(spark, d), "features", ("event_id",))
    return answers.select("event_id", "prediction", F.round("top2_margin", 6).alias("top2_margin"), "version", "input_sha256")


KPIS = f"""WITH {SCORED} SELECT CAST(epoch(time_bucket(INTERVAL '6 hours', ts)) AS BIGINT) AS window_start, prediction, count(*) AS n, round(avg(top2_margin), 6) AS mean_margin,
quantile_disc(latency_ms, 0.5) AS latency_p50, quantile_disc(latency_ms, 0.95) AS latency_p95 FROM scored JOIN requests USING (event_id) GROUP BY ALL"""


def _kpi_columns(df: DataFrame) -> DataFrame:
    return df.select(F.unix_seconds("window_start").alias("window_start"), "prediction", "n", F.round("mean_margin", 6).alias("mean_margin"), "latency_p50", "latency_p95")


@query("i2_kpi_stream", KPIS)
def i2_kpi_stream(spark: SparkSession, d: str) -> DataFrame:
    """The answers in eight files of no order in time, a file to a micro-batch."""
    folder = fresh_path(spark, "answers")
    spark.read.parquet(scored_stream(spark, d)).repartition(8, "event_id").write.parquet(folder)
    answers = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out, state = fresh_path(spark, "kpis"), fresh_path(spark, "kpis-state")
    write_partials(answers, out, state, window="6 hours").awaitTermination()
    compact_partials(spark, out)
    return _kpi_columns(current_kpis(spark, out))


@query("i2_kpi_sketched", f"""WITH {SCORED} SELECT CAST(epoch(time_bucket(INTERVAL '5 days', ts, TIMESTAMP '1970-01-01')) AS BIGINT) AS window_start, prediction, count(*) AS n,
round(avg(top2_margin), 6) AS mean_margin, true AS p50_within, true AS p95_within FROM scored JOIN requests USING (event_id) GROUP BY ALL""")
def i2_kpi_sketched(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of small merged sketches, held against the ranks they really have: within twice the stated error."""
    k, window = 64, "5 days"
    rows = spark.read.parquet(scored_stream(spark, d))
    found = current_from(partials(rows, window, k=k), ("prediction",))
    error = 2 * rank_error(k)
    placed = rows.select(F.window("ts", window)["start"].alias("window_start"), "prediction", F.col("latency_ms").alias("x"))
    met = join_lookup(placed, found, ["window_start", "prediction"], "inner")

    def within(c: str, share: float) -> Column:
        below, upto = F.count_if(F.col("x") < F.col(c)) / F.count("x"), F.count_if(F.col("x") <= F.col(c)) / F.count("x")
        return ((below <= share + error) & (upto >= share - error)).alias(c.replace("latency_", "") + "_within")

    ranks = met.groupBy("window_start", "prediction").agg(F.max("n").alias("n"), F.round(F.max("mean_margin"), 6).alias("mean_margin"), within("latency_p50", 0.5), within("latency_p95", 0.95))
    return ranks.withColumn("window_start", F.unix_seconds("window_start"))


@query("i2_kpi_batch", KPIS)
def i2_kpi_batch(spark: SparkSession, d: str) -> DataFrame:
    scorer = CountScorer.fit(T.spread(T.credit_orders(spark, d), "id"))
    return _kpi_columns(kpis(scorer.respond(T.spread(T.requests(spark, d), "event_id"), "features", REQUEST_KEYS), window="6 hours"))
