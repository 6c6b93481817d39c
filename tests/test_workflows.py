import json
import re
from datetime import datetime

from pyspark.sql import functions as F

from tutelage import session
from tutelage.operators import countlm
from tutelage.operators import evaluation as E
from tutelage.plans import evaluate
from tutelage.plans import tables as T
from tutelage.plans import workflows as W
from tutelage.plans.scorer import CountScorer, ModelScorer
from tutelage.sources import readers, sinks


def labelled(spark, n=120):
    words = {"Good": "low debt high income", "Standard": "medium debt some income", "Bad": "late payment huge debt"}
    rows = [(i, f"Age: {i}, {words[lab]}", lab) for i in range(n) for lab in [("Good", "Standard", "Bad", "Good")[i % 4]]]
    return spark.createDataFrame(rows, "id long, question string, answer string")


def test_prepare_from_an_array_file(spark, tmp_path):
    rows = [{"question": r["question"], "answer": f" {r['answer']}"} for r in labelled(spark).collect()] + [{"question": "?", "answer": "Unknown"}]
    (tmp_path / "src.json").write_text(json.dumps(rows))
    paths = W.prepare(spark, str(tmp_path / "src.json"), str(tmp_path / "out"), name="credit")
    sft, kd, dpo = (readers.READERS[m](spark, paths[m]) for m in ("sft", "kd", "dpo"))
    assert sft.groupBy("output").count().select("count").distinct().collect() == [(30,)]
    prompts = lambda d, c: sorted(r[0] for r in d.select(c).collect())
    assert prompts(sft, "input") == prompts(kd, "input") == prompts(dpo, "prompt")
    assert dpo.filter("chosen = rejected").count() == 0


def test_evaluate_classifier(spark):
    df = labelled(spark)
    out = W.evaluate_classifier(df, CountScorer.fit(df), per_class=20)
    report = {r["label"]: r for r in out.report.collect()}
    assert report["accuracy"]["f1"] == 1.0 and report["accuracy"]["support"] == 60
    assert {r["label"]: r["n"] for r in out.original.collect()} == {"Good": 60, "Standard": 30, "Bad": 30}
    assert sum(r["n"] for r in out.confusion.collect()) == 60 and sum(r["n"] for r in out.labels.collect()) == 120


def keyword_model():
    import numpy as np

    signs = {"Good": "low", "Standard": "medium", "Bad": "late"}

    def score(prompts, candidates):
        hit = [1.0 if signs[c.strip()] in p else 4.0 for p, c in zip(prompts, candidates)]
        n = np.array([len(c.split()) for c in candidates], dtype="int64")
        return {"sum_logprob": -np.array(hit) * n, "n_tokens": n}

    return score


def test_model_scorer(spark):
    df = labelled(spark, 40)
    scorer = ModelScorer.load(spark, keyword_model, batch_size=7)
    assert scorer.prior == {"Good": -4.0, "Standard": -4.0, "Bad": -4.0}
    rows = scorer.respond(df, "question", ("id", "answer")).collect()
    assert all(r["prediction"] == r["answer"] and r["top2_margin"] == 3.0 for r in rows) and len(rows) == 40


def test_evaluate_generation(spark, tmp_path):
    df = spark.createDataFrame([(1, "doc one", '{"a": 1, "b": 2}', 'doc one {"a": 5}'), (2, "doc two", '{"a": 1}', "doc two sorry"), (3, "doc three", "{}", "doc three")],
                               "id long, input string, output string, generated string")
    lm = countlm.fit_count_lm(df, "generated", None)
    runs = str(tmp_path / "runs")
    rows, found = W.evaluate_generation(df, "sft", str(tmp_path / "m"), lm=lm, limit=2, run_id="r1", runs=runs, params={"max_len": 2048})
    assert rows.count() == 2 and spark.read.json(str(tmp_path / "m" / "sft_eval_results.jsonl")).count() == 2
    m = found.first()
    assert (m["num_examples"], m["valid_json_ratio"], m["avg_field_match"]) == (2, 0.5, 0.5) and m["avg_perplexity"] > 1
    logged = {(r["kind"], r["key"]): r["value"] for r in sinks.read_runs(spark, runs).collect()}
    assert logged["metric", "valid_json_ratio"] == "0.5" and logged["param", "max_len"] == "2048" and len(logged) == 8


def test_evaluate_a_file(spark, tmp_path):
    rows = [{"input": f"doc {i}", "output": '{"a": 1}', "generated": f'doc {i} {{"a": {i}}}'} for i in range(7)]
    (tmp_path / "e.jsonl").write_text("\n".join(map(json.dumps, rows)))
    lm = countlm.fit_count_lm(spark.createDataFrame([("doc one",)], "t string"), "t", None)
    stored, found = W.evaluate_file(spark, str(tmp_path / "e.jsonl"), "sft", str(tmp_path / "m"), limit=3, generated=True, lm=lm)
    assert sorted(r["id"] for r in stored.collect()) == [0, 1, 2] and found.first()["num_examples"] == 3 and found.first()["avg_field_match"] == 1.0


def test_annotation_requests_keep_exemplars_apart(spark):
    out = W.annotation_requests(labelled(spark), per_class=5).collect()
    assert len(out) == 15 and len({r["system_prompt"] for r in out}) == 1
    system = out[0]["system_prompt"]
    assert system.count("Brief reasoning") == 6 and not any(r["question"] + "\n" in system for r in out)
    assert all(r["user_prompt"] == "Customer Data:\n" + r["question"] for r in out)


def test_generation_with_a_model(spark, tmp_path):
    def load():
        import numpy as np

        return lambda prompts: np.array([p + ' {"a": 1}' for p in prompts], dtype=object)

    df = spark.createDataFrame([(i, f"task {i}", f'{{"a": {i}, "b": 2}}') for i in range(6)], "id long, input string, output string")
    lm = countlm.fit_count_lm(df, "input", None)
    rows, found = W.evaluate_generation(df, "sft", str(tmp_path / "m"), lm=lm, make_generate_fn=load)
    assert {r["generated"] for r in rows.collect()} == {'{"a": 1}'} and found.first()["avg_field_match"] == 0.5
    kd = df.select("id", "input", "output").withColumnRenamed("output", "teacher_output")
    rows, found = W.evaluate_generation(kd, "kd", str(tmp_path / "m"), lm=lm, make_generate_fn=load)
    assert rows.columns == ["id", "input", "teacher_output", "generated", "perplexity"] and found.first()["num_examples"] == 6


def test_answer_requests(spark):
    def load():
        import numpy as np

        return lambda keys, prompts: np.array([f"{p} by {k}\n" for k, p in zip(keys, prompts)], dtype=object)

    reg = spark.createDataFrame([("idp_sft_aaaaaaaa", "idp", 1)], "model_key string, flow string, load_order int")
    req = spark.createDataFrame([(1, "idp", "sft", "aaaaaaaabbbb", "doc"), (2, "idp", "kd", None, "doc"), (3, "codegen", "kd", None, "code")],
                                "id int, flow string, method string, run_id string, text string")
    got = {r["id"]: r["response"] for r in W.answer_requests(req, reg, load).collect()}
    assert got == {1: "by idp_sft_aaaaaaaa", 2: "by idp_sft_aaaaaaaa", 3: None}


def test_extract_documents(spark, tmp_path):
    def load():
        import numpy as np

        return lambda prompts: np.array(['{"n": "x"}' if "bad" in p else 'Here: {"n": 1}' for p in prompts], dtype=object)

    (tmp_path / "schema.json").write_text('{"type": "object",\n "properties": {"n": {"type": "number"}}, "required": ["n"]}')
    schema = readers.read_schema(spark, str(tmp_path / "schema.json"))
    df = spark.createDataFrame([(1, "good"), (2, "bad")], "id int, text string")
    got = {r["id"]: (r["json"], r["violations"]) for r in W.extract_documents(df, schema, load).collect()}
    assert got == {1: ('{"n": 1}', []), 2: ('{"n": "x"}', ["$.n: not number"])}


def invoice_tables(spark, folder, n=40):
    """Orders of one to four lines; those of every tenth id come twice."""
    twice = [i for i in range(n) for _ in range(2 if i % 10 == 0 else 1)]
    tables = {"customer": ([(i, f"Customer {i}") for i in range(5)], "c_custkey long, c_name string"),
              "orders": ([(i, i % 5, datetime(2024, 1, 1 + i % 28)) for i in twice], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
              "lineitem": ([(i, k, 100 * i + k, 1.0 + k, 10.25 * (i + 1) + k) for i in range(n) for k in range(1 + i % 4)],
                           "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_results_with_and_without_their_facts_agree(spark, tmp_path, monkeypatch):
    d = invoice_tables(spark, tmp_path)
    answers = T.invoice_answers(spark, d)
    lm = countlm.fit_count_lm(answers, "reference", None)
    examples = answers.select("id", F.col("text").alias("input"), F.col("reference").alias("output"), F.concat("text", F.lit("\n"), "answer").alias("generated"))
    rows = lambda df: sorted((r["id"], r["input"], r["reference"], r["generated"], round(r["perplexity"], 9), tuple(r["json_eval"])) for r in df.collect())
    expected = rows(E.eval_rows(examples, "sft", lm=lm))
    assert len(expected) == 44
    for limit in (countlm.BROADCAST_BYTES, 0):
        monkeypatch.setattr(countlm.count_lm_scores, "__defaults__", tuple(limit if x == countlm.BROADCAST_BYTES else x for x in countlm.count_lm_scores.__defaults__))
        monkeypatch.setattr(countlm.count_perplexity, "__defaults__", tuple(limit if x == countlm.BROADCAST_BYTES else x for x in countlm.count_perplexity.__defaults__))
        assert rows(evaluate.sft_results(spark, d)) == expected


def test_no_text_is_written_or_shuffled_for_results(spark, tmp_path, monkeypatch):
    """What is written on the way holds the facts of an invoice or figures, and exchanges only these; files of texts are compressed."""
    d, kept = invoice_tables(spark, tmp_path / "in"), tmp_path / "kept"
    monkeypatch.setattr(evaluate, "fresh_path", lambda spark, name: f"{kept}/{name}")
    monkeypatch.setattr(evaluate, "materialise", lambda df, name, *a: seen.update({name: df.columns}) or session.materialise(df, name, *a))
    seen = {}
    plan = evaluate.f11_eval_sft(spark, d)._jdf.queryExecution().executedPlan().toString()
    hashed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any(h.startswith("row#") for h in hashed) and not any("__text" in h or "__key" in h for h in hashed)
    assert evaluate.a6_write_results(spark, d).count() == 44
    found = evaluate.f11_eval_from_file(spark, d).first()
    assert found["num_examples"] == found["n_ids"] == found["last_id"] + 1 == 44
    assert seen == {"invoices": ["id", "vendor", "day", "lines", "row"], "results": ["id", "perplexity", "json_eval"]}
    texts = [p.name for p in kept.rglob("part-*")]
    assert len(texts) >= 2 and all(t.endswith(".json.gz") for t in texts)
