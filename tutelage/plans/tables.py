"""The operators' inputs, derived from the supplied tables; each with its SQL twin.

None of the tables has the shape the work starts from (labelled examples, token scores, invoices,
generated texts, requests), so Spark derives them, whole, from what is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.functions import constants as K
from tutelage.functions.templates import idp_infer_prompt
from tutelage.functions.text import features_text
from tutelage.operators.datasets import pairs_from_turns
from tutelage.plans.registry import sql_render


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Long texts in fewer files than there are cores would be read by a few tasks; a large table is left alone.

    The parts are balanced by their bytes, so that there are more of them where there is more to read.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.hint("rebalance", key) if len(df.inputFiles()) < n else df


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id")


def _doc_label() -> Column:
    return F.when(F.col("toxic") == 1, "Bad").when(F.col("quality") == 1, "Good").otherwise("Standard")


def labelled_docs(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", _doc_label().alias("answer"))
    docs = table(spark, d, "documents").select("doc_id", "text").join(labels, "doc_id")
    return docs.select(F.col("doc_id").alias("id"), F.col("text").alias("question"), "answer")


def raw_docs(spark: SparkSession, d: str) -> DataFrame:
    """Labels as they come: padded with whitespace, and unknown where a document has none."""
    labels = table(spark, d, "labels").select("doc_id", F.concat(F.lit(" \t"), _doc_label(), F.lit(" \n")).alias("answer"))
    docs = table(spark, d, "documents").select("doc_id", "n_chars").join(labels, "doc_id", "left")
    return docs.select(F.col("doc_id").alias("id"), "n_chars", F.coalesce("answer", F.lit("Unlabelled")).alias("answer"))


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def credit_orders(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    customer = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    question = features_text({"Order Priority": F.col("o_orderpriority"), "Total Price": _money("o_totalprice"),
                              "Market Segment": F.col("c_mktsegment"), "Account Balance": _money("c_acctbal")})
    answer = F.when(F.col("o_orderstatus") == "F", "Good").when(F.col("o_orderstatus") == "O", "Standard").otherwise("Bad")
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("id"), question.alias("question"), answer.alias("answer")))


def order_labels(spark: SparkSession, d: str) -> DataFrame:
    """Ids and labels of ``credit_orders`` alone: one narrow scan."""
    answer = F.when(F.col("o_orderstatus") == "F", "Good").when(F.col("o_orderstatus") == "O", "Standard").otherwise("Bad")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), answer.alias("answer"))


def turns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations")


def pairs(spark: SparkSession, d: str) -> DataFrame:
    return pairs_from_turns(turns(spark, d))


def teacher(labelled: DataFrame) -> DataFrame:
    """Annotations of a teacher that names the next label for 3 ids in 16."""
    wrong = F.substring(F.md5(F.concat(F.lit("teacher:"), F.col("id").cast("string"))), 1, 1) < "3"
    after = F.when(F.col("answer") == "Good", "Standard").when(F.col("answer") == "Standard", "Bad").otherwise("Good")
    label = F.when(wrong, after).otherwise(F.col("answer"))
    return labelled.select("id", F.concat(F.lit("Judged from the features as "), label).alias("reason"), label.alias("label"))


# --- stored token scores -------------------------------------------------------------------

def token_scores(spark: SparkSession, d: str) -> DataFrame:
    """Line items read as stored token log-probabilities of orders: flag = label, status = variant."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice")
    return li.select(F.col("l_orderkey").alias("example_id"), _flag_label().alias("label"), _status_variant().alias("variant"),
                     F.col("l_linenumber").alias("pos"), (-F.log1p("l_extendedprice")).alias("logprob"))


def null_token_scores(spark: SparkSession, d: str) -> DataFrame:
    """The same for the seven null prompts of four models."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice")
    return li.select(_model(F.col("l_partkey")).alias("model"), (F.col("l_suppkey") % 7).alias("null_id"), _flag_label().alias("label"),
                     _status_variant().alias("variant"), F.col("l_linenumber").alias("pos"), (-F.log1p("l_extendedprice")).alias("logprob"))


#: Two names for each label.
SYNONYMS = {"Good": ("Good", "Strong"), "Standard": ("Standard", "Average"), "Bad": ("Bad", "Weak")}


def _synonym() -> Column:
    """The supplier's number picks the label's name."""
    return F.coalesce(*[F.when(_flag_label() == lab, F.when(F.col("l_suppkey") % 2 == 0, first).otherwise(second)) for lab, (first, second) in SYNONYMS.items()])


def synonym_token_scores(spark: SparkSession, d: str) -> DataFrame:
    """``token_scores`` of labels that go by two names."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus", "l_extendedprice")
    return li.select(F.col("l_orderkey").alias("example_id"), _flag_label().alias("label"), _synonym().alias("synonym"), _status_variant().alias("variant"),
                     F.col("l_linenumber").alias("pos"), (-F.log1p("l_extendedprice")).alias("logprob"))


def null_synonym_token_scores(spark: SparkSession, d: str) -> DataFrame:
    """The same for the seven null prompts of four models."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice")
    return li.select(_model(F.col("l_partkey")).alias("model"), (F.col("l_orderkey") % 7).alias("null_id"), _flag_label().alias("label"), _synonym().alias("synonym"),
                     _status_variant().alias("variant"), F.col("l_linenumber").alias("pos"), (-F.log1p("l_extendedprice")).alias("logprob"))


def _flag_label() -> Column:
    return F.when(F.col("l_returnflag") == "A", "Good").when(F.col("l_returnflag") == "N", "Standard").otherwise("Bad")


def _status_variant() -> Column:
    return F.when(F.col("l_linestatus") == "F", 0).otherwise(1)


def _model(key: Column) -> Column:
    m = key % 4
    return F.when(m == 0, "base").when(m == 1, "sft").when(m == 2, "kd").otherwise("dpo")


# --- invoices and generated texts ----------------------------------------------------------

# The wording of the three layouts repeats that of sample invoices: fixed values, here and in the SQL twin.

def parts(spark: SparkSession) -> int:
    """Texts are made and searched behind a shuffle of their few bytes of facts, so that its parts are dealt by work: several for each core."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def invoice_facts(spark: SparkSession, d: str) -> DataFrame:
    """``(id, vendor, day, lines)`` of an order: all that its texts are made of, in a fraction of their bytes.

    The lines gathered per order become one text, so they are as many as one document holds.
    """
    qty = F.col("l_quantity").cast("bigint")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    lines = (table(spark, d, "lineitem")
             .select("l_orderkey", F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), qty.alias("qty"),
                                            F.floor(cents / qty).cast("bigint").alias("unit")).alias("line"))
             .repartition(parts(spark), "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("line")).alias("lines")))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    customer = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("vendor"))
    found = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))  # narrow rows first, so that lines are shuffled once
             .join(lines, F.col("o_orderkey") == F.col("l_orderkey")))
    return found.select(F.col("o_orderkey").alias("id"), "vendor", "day", F.transform("lines", lambda x: F.struct(x["part"], x["qty"], x["unit"])).alias("lines"))


def invoices(spark: SparkSession, d: str) -> DataFrame:
    """``(id, text, gold_json)``: an order as an invoice in one of three layouts."""
    return invoice_texts(invoice_facts(spark, d))


def invoice_texts(facts: DataFrame, *keep: str) -> DataFrame:
    """``invoices`` of their facts, row by row, with the columns ``keep`` of these."""
    base = (facts.withColumn("layout", F.col("id") % 3)
            .withColumn("currency", F.when(F.col("layout") == 0, "USD").when(F.col("layout") == 1, "INR").otherwise("EUR"))
            .withColumn("number", F.concat(F.lit("INV-"), F.col("id").cast("string")))
            .withColumn("items_cents", F.aggregate("lines", F.lit(0).cast("bigint"), lambda a, x: a + x["qty"] * x["unit"]))
            .withColumn("total_cents", F.col("items_cents") + F.when(_hex("total", "id") < "3", 500).otherwise(0)))
    nl = F.lit("\n")
    s = lambda c: c.cast("string")
    desc = lambda x: F.concat(F.lit("Part "), s(x["part"]))
    total = _cents(F.col("total_cents"))
    item0 = F.transform("lines", lambda x, i: F.concat(s(i + 1), F.lit(") "), desc(x), F.lit(" x"), s(x["qty"]), F.lit(" @ "), _cents(x["unit"]), F.lit(" USD")))
    item1 = F.transform("lines", lambda x, i: F.concat(s(i + 1), F.lit(". "), desc(x), F.lit(" "), s(x["qty"]), F.lit(" @ INR "), _cents(x["unit"])))
    item2 = F.transform("lines", lambda x: F.concat(desc(x), F.lit(" qty "), s(x["qty"]), F.lit(" @ "), _cents(x["unit"]), F.lit(" EUR")))
    text0 = F.concat(F.lit("Invoice #"), F.col("number"), F.lit(" dated "), F.date_format("day", "yyyy-MM-dd"), F.lit(" from "), F.col("vendor"),
                     nl, F.lit("Items:"), nl, F.array_join(item0, "\n"), nl, F.lit("Total: USD "), total)
    text1 = F.concat(F.lit("TAX INVOICE\nSeller: "), F.col("vendor"), nl, F.lit("Invoice No: "), F.col("number"), nl, F.lit("Date: "),
                     F.date_format("day", "dd MMM yyyy"), nl, F.array_join(item1, "\n"), nl, F.lit("TOTAL (INR): "), total)
    text2 = F.concat(F.lit("Receipt / Invoice\nVendor: "), F.col("vendor"), nl, F.lit("Ref: "), F.col("number"), nl, F.lit("Date Issued: "),
                     F.date_format("day", "MM/dd/yyyy"), nl, F.array_join(item2, "\n"), nl, F.lit("Grand Total EUR "), total)
    gold_items = F.transform("lines", lambda x: F.concat(
        F.lit('{"description": "'), desc(x), F.lit('", "qty": '), s(x["qty"]), F.lit(', "unit_price": '), _cents(x["unit"]),
        F.lit(', "amount": '), _cents(x["qty"] * x["unit"]), F.lit("}")))
    why = F.concat(F.lit('{"invoice_number": "printed", "total_amount": "printed"'),
                   F.when(_hex("why", "id") < "8", ', "vendor_name": "printed"').otherwise(""), F.lit("}"))
    gold = F.concat(F.lit('{"invoice_number": "'), F.col("number"), F.lit('", "invoice_date": "'), F.date_format("day", "yyyy-MM-dd"),
                    F.lit('", "vendor_name": "'), F.col("vendor"), F.lit('", "total_amount": '), total, F.lit(', "currency": "'),
                    F.col("currency"), F.lit('", "line_items": ['), F.array_join(gold_items, ", "), F.lit('], "why": '), why, F.lit("}"))
    text = F.when(F.col("layout") == 0, text0).when(F.col("layout") == 1, text1).otherwise(text2)
    return base.select("id", text.alias("text"), gold.alias("gold_json"), *keep)


def generations(spark: SparkSession, d: str) -> DataFrame:
    """``(id, prompt, generated, reference)``: the gold answer after its prompt, damaged for half of the ids."""
    return invoices(spark, d).select("id", idp_infer_prompt("text").alias("prompt"), F.col("gold_json").alias("reference"),
                                     F.concat(idp_infer_prompt("text"), F.lit("\n"), _damaged()).alias("generated"))


def invoice_answers(spark: SparkSession, d: str) -> DataFrame:
    """``generations`` as answer texts alone, without the prompt before them."""
    return answers(invoice_facts(spark, d))


def answers(facts: DataFrame, *keep: str) -> DataFrame:
    """``invoice_answers`` of invoices' facts, row by row, with the columns ``keep`` of these."""
    return invoice_texts(facts, *keep).select("id", "text", F.col("gold_json").alias("reference"), _damaged().alias("answer"), *keep)


def _damaged() -> Column:
    gold, h = F.col("gold_json"), _hex("gen", "id")
    return (F.when(h < "8", gold)
            .when(h < "a", F.regexp_replace(gold, r'"currency": "[A-Z]+", ', ""))
            .when(h < "c", F.concat(F.lit("Here is the JSON:\n"), gold, F.lit("\nAnything else?")))
            .when(h < "e", F.substring(gold, F.lit(1), F.floor(F.length(gold) / 2).cast("int")))
            .when(h < "f", F.lit("I could not read the document."))
            .otherwise(F.regexp_replace(gold, r'"total_amount": [0-9.]+', '"total_amount": "unknown"')))


def _hex(salt: str, col: str) -> Column:
    return F.substring(F.md5(F.concat(F.lit(f"{salt}:"), F.col(col).cast("string"))), 1, 1)


def _cents(c: Column) -> Column:
    return F.concat(F.floor(c / 100).cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


# --- requests ------------------------------------------------------------------------------

def as_requests(events: DataFrame, customer: DataFrame) -> DataFrame:
    """Events as scoring requests; works on a batch and on a stream.

    ``ts`` is a local timestamp in the files; it is read as UTC whatever the session's zone is.
    """
    question = features_text({"Market Segment": F.col("c_mktsegment"), "Account Balance": _money("c_acctbal"), "Event Type": F.col("event_type")})
    utc = F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")
    h = F.substring(F.md5(F.concat(F.lit("run:"), F.col("event_type"))), 1, 12)
    joined = events.join(customer.select("c_custkey", "c_acctbal", "c_mktsegment"), F.col("user_id") == F.col("c_custkey"))
    return joined.select(
        "event_id", utc.alias("ts"), "event_type", question.alias("features"), F.col("value").alias("latency_ms"),
        F.when(F.col("event_type").isin("click", "view"), "codegen").when(F.col("event_type") == "error", "mlqa").otherwise("idp").alias("flow"),
        F.when(F.col("event_id") % 3 == 0, "sft").when(F.col("event_id") % 3 == 1, "kd").otherwise("dpo").alias("method"),
        F.when(F.col("event_id") % 2 == 0, h).alias("run_id"))


def requests(spark: SparkSession, d: str) -> DataFrame:
    return as_requests(table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value"), table(spark, d, "customer"))


def registry(requests: DataFrame) -> DataFrame:
    """Loaded models: those runs whose flow and method were asked for by an event divisible by four."""
    loaded = requests.filter(F.col("run_id").isNotNull() & (F.col("event_id") % 4 == 0) & (F.col("flow") != "mlqa"))
    key = F.concat_ws("_", "flow", "method", F.substring("run_id", 1, 8))
    return loaded.filter(F.col("method") != "dpo").groupBy(key.alias("model_key"), "flow").agg(F.min("event_id").alias("load_order"))


# --- SQL twins -----------------------------------------------------------------------------

_DOC_LABEL = "CASE WHEN toxic = 1 THEN 'Bad' WHEN quality = 1 THEN 'Good' ELSE 'Standard' END"
_ORDER_LABEL = "CASE o_orderstatus WHEN 'F' THEN 'Good' WHEN 'O' THEN 'Standard' ELSE 'Bad' END"
_FLAG_LABEL = "CASE l_returnflag WHEN 'A' THEN 'Good' WHEN 'N' THEN 'Standard' ELSE 'Bad' END"

SQL_LABELLED = f"labelled_docs AS (SELECT d.doc_id AS id, d.text AS question, {_DOC_LABEL} AS answer FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"

SQL_CREDIT = f"""credit_orders AS (
  SELECT o_orderkey AS id, 'Order Priority: ' || o_orderpriority || ', Total Price: ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
    || ', Market Segment: ' || c_mktsegment || ', Account Balance: ' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS question,
    {_ORDER_LABEL} AS answer
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

SQL_ORDER_LABELS = f"order_labels AS (SELECT o_orderkey AS id, {_ORDER_LABEL} AS answer FROM orders)"

SQL_PAIRS = """turn_pairs AS (
  SELECT conv_id, turn, CASE WHEN system IS NOT NULL THEN system || chr(10) || chr(10) || text ELSE text END AS input, next_text AS output
  FROM (SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text,
          last_value(CASE WHEN role = 'system' THEN text END IGNORE NULLS)
            OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS system
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""


def sql_teacher(source: str) -> str:
    return f"""teacher AS (SELECT id, 'Judged from the features as ' || label AS reason, label FROM (
  SELECT id, CASE WHEN substr(md5('teacher:' || id), 1, 1) < '3'
    THEN CASE answer WHEN 'Good' THEN 'Standard' WHEN 'Standard' THEN 'Bad' ELSE 'Good' END ELSE answer END AS label FROM {source}))"""


SQL_TOKEN_SCORES = f"""token_scores AS (SELECT l_orderkey AS example_id, {_FLAG_LABEL} AS label,
  CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS variant, l_linenumber AS pos, -ln(1 + l_extendedprice) AS logprob FROM lineitem)"""


def _sql_model(key: str) -> str:
    return f"CASE {key} % 4 WHEN 0 THEN 'base' WHEN 1 THEN 'sft' WHEN 2 THEN 'kd' ELSE 'dpo' END"


SQL_NULL_TOKEN_SCORES = f"""null_token_scores AS (SELECT {_sql_model('l_partkey')} AS model, l_suppkey % 7 AS null_id, {_FLAG_LABEL} AS label,
  CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS variant, l_linenumber AS pos, -ln(1 + l_extendedprice) AS logprob FROM lineitem)"""


_SQL_CELL = f"{_FLAG_LABEL} AS label, l_suppkey % 2 AS synonym, CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS variant, -ln(1 + l_extendedprice) AS logprob FROM lineitem"
SQL_SYNONYM_SCORES = f"""synonym_scores AS (SELECT l_orderkey AS example_id, {_SQL_CELL}),
null_synonym_scores AS (SELECT {_sql_model('l_partkey')} AS model, l_orderkey % 7 AS null_id, {_SQL_CELL})"""


def _sql_cents(e: str) -> str:
    return f"(CAST(({e}) // 100 AS VARCHAR) || '.' || lpad(CAST(({e}) % 100 AS VARCHAR), 2, '0'))"


SQL_LINES = """lines AS (SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, q, u) AS pos,
  'Part ' || l_partkey AS description, q, u
  FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q, CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS u FROM lineitem))"""

SQL_INVOICES = SQL_LINES + f""",
invoice_facts AS (SELECT o_orderkey AS id, o_orderkey % 3 AS layout, 'INV-' || o_orderkey AS number, c_name AS vendor, o_orderdate AS day,
    CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'INR' ELSE 'EUR' END AS currency,
    CAST(items AS BIGINT) AS items_cents, CAST(items AS BIGINT) + CASE WHEN substr(md5('total:' || o_orderkey), 1, 1) < '3' THEN 500 ELSE 0 END AS total_cents,
    t0, t1, t2, gold_items
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN (
    SELECT id, sum(q * u) AS items,
      string_agg(pos || ') ' || description || ' x' || q || ' @ ' || {_sql_cents('u')} || ' USD', chr(10) ORDER BY pos) AS t0,
      string_agg(pos || '. ' || description || ' ' || q || ' @ INR ' || {_sql_cents('u')}, chr(10) ORDER BY pos) AS t1,
      string_agg(description || ' qty ' || q || ' @ ' || {_sql_cents('u')} || ' EUR', chr(10) ORDER BY pos) AS t2,
      string_agg('{{"description": "' || description || '", "qty": ' || q || ', "unit_price": ' || {_sql_cents('u')}
        || ', "amount": ' || {_sql_cents('q * u')} || '}}', ', ' ORDER BY pos) AS gold_items
    FROM lines GROUP BY id) g ON g.id = o_orderkey),
invoices AS (SELECT id, layout, number, vendor, day, currency, items_cents, total_cents,
  CASE layout
    WHEN 0 THEN 'Invoice #' || number || ' dated ' || strftime(day, '%Y-%m-%d') || ' from ' || vendor || chr(10) || 'Items:' || chr(10) || t0 || chr(10) || 'Total: USD ' || {_sql_cents('total_cents')}
    WHEN 1 THEN 'TAX INVOICE' || chr(10) || 'Seller: ' || vendor || chr(10) || 'Invoice No: ' || number || chr(10) || 'Date: ' || strftime(day, '%d %b %Y') || chr(10) || t1 || chr(10) || 'TOTAL (INR): ' || {_sql_cents('total_cents')}
    ELSE 'Receipt / Invoice' || chr(10) || 'Vendor: ' || vendor || chr(10) || 'Ref: ' || number || chr(10) || 'Date Issued: ' || strftime(day, '%m/%d/%Y') || chr(10) || t2 || chr(10) || 'Grand Total EUR ' || {_sql_cents('total_cents')}
  END AS text,
  '{{"invoice_number": "' || number || '", "invoice_date": "' || strftime(day, '%Y-%m-%d') || '", "vendor_name": "' || vendor || '", "total_amount": ' || {_sql_cents('total_cents')}
    || ', "currency": "' || currency || '", "line_items": [' || gold_items || '], "why": {{"invoice_number": "printed", "total_amount": "printed"'
    || CASE WHEN substr(md5('why:' || id), 1, 1) < '8' THEN ', "vendor_name": "printed"' ELSE '' END || '}}}}' AS gold_json
  FROM invoice_facts)"""

SQL_ANSWERS = SQL_INVOICES + """,
answers AS (SELECT *, CASE
    WHEN h < '8' THEN gold_json
    WHEN h < 'a' THEN regexp_replace(gold_json, '"currency": "[A-Z]+", ', '')
    WHEN h < 'c' THEN 'Here is the JSON:' || chr(10) || gold_json || chr(10) || 'Anything else?'
    WHEN h < 'e' THEN substr(gold_json, 1, CAST(length(gold_json) // 2 AS INT))
    WHEN h < 'f' THEN 'I could not read the document.'
    ELSE regexp_replace(gold_json, '"total_amount": [0-9.]+', '"total_amount": "unknown"') END AS answer
  FROM (SELECT *, substr(md5('gen:' || id), 1, 1) AS h FROM invoices))"""

SQL_GENERATIONS = SQL_ANSWERS + f""",
generations AS (SELECT id, {sql_render(K.IDP_INFER_PROMPT, 'text')} AS prompt, gold_json AS reference,
  {sql_render(K.IDP_INFER_PROMPT, 'text')} || chr(10) || answer AS generated FROM answers)"""

SQL_REQUESTS = """requests AS (SELECT event_id, ts, event_type,
    'Market Segment: ' || c_mktsegment || ', Account Balance: ' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || ', Event Type: ' || event_type AS features,
    value AS latency_ms,
    CASE WHEN event_type IN ('click', 'view') THEN 'codegen' WHEN event_type = 'error' THEN 'mlqa' ELSE 'idp' END AS flow,
    CASE event_id % 3 WHEN 0 THEN 'sft' WHEN 1 THEN 'kd' ELSE 'dpo' END AS method,
    CASE WHEN event_id % 2 = 0 THEN substr(md5('run:' || event_type), 1, 12) END AS run_id
  FROM events JOIN customer ON user_id = c_custkey)"""
