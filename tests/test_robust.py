"""One bad row does not end a job, and texts are parsed once."""

import re

import pytest
from pyspark.sql import functions as F

from tutelage.functions import scores as S
from tutelage.functions.jsontext import canonical_json, extract_json, json_eval, json_keys, standard_json
from tutelage.operators import datasets as D
from tutelage.operators import evaluation as E
from tutelage.operators import extraction as X
from tutelage.operators import metrics as M
from tutelage.operators import sampling


def test_surrogates_and_numbers_that_are_none(spark):
    texts = ['{"\\ud800": 1}', '{"a": "\\ud800x"}', '{"a": NaN, "b": [Infinity, 1]}', "[" * 900 + "]" * 900, '{"a":' * 5000 + "1" + "}" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(json_keys("t").alias("k"), canonical_json("t").alias("c"), extract_json("t").alias("x"), json_eval("t", "t").alias("e"), standard_json("t").alias("s")).collect()
    assert rows[0]["k"] == ["\\ud800"] and rows[0]["c"] == '{"\\ud800": 1}' and rows[1]["c"] == '{"a": "\\ud800x"}'
    assert rows[2]["s"] == '{"a": null, "b": [null, 1]}' and rows[2]["e"]["valid_json"]
    assert rows[3]["k"] is None
    schema = {"type": "object", "properties": {"a": {"type": "number"}}}
    assert [r["v"] for r in X.validate_json(df.limit(3), "t", schema, "v").collect()] == [[], ["$.a: not number"], ["$.a: not number"]]


def test_large_numbers_and_scales(spark):
    lines = ["a 1234567890123 @ 2.00 USD", "b 2 @ 123456789012345.00 USD", "c 1000 @ 0.125 USD", "d 99999999999999999999999 @ 9999999999999999999999.5 USD", "e 9999999999 @ 9999999999.99 USD"]
    df = spark.createDataFrame([(i, f"Invoice #1 dated 2025-01-01 from V\n{t}\nTotal: USD {'9' * 30}.00") for i, t in enumerate(lines)] + [(9, "Invoice #1\nc 1000 @ 0.125 USD\nTotal: USD 125.00")], "id int, text string")
    items = {r["id"]: r for r in X.line_items(df).collect()}
    assert items[0]["qty"] == 1234567890123.0 and items[1]["unit_price"] == 123456789012345.0 and (items[2]["unit_price"], items[2]["amount"]) == (0.125, 125.0)
    assert items[3]["amount"] > 1e44 and items[4]["amount"] == pytest.approx(9999999999 * 9999999999.99)
    rows = {r["id"]: r for r in X.reconcile(df).collect()}
    assert rows[9]["balanced"] and not rows[3]["balanced"]
    assert X.extract_invoice(df).count() == 6


def test_schema_keys_types_and_keywords(spark):
    df = spark.createDataFrame([('{"a.b": 1, "c d": "x", "e": 5, "f": "no"}',), ('{"a.b": null, "c d": 2, "e": 50, "f": "yes", "z": 1}',)], "t string")
    schema = {"type": "object", "required": ["a.b", "c d"], "additionalProperties": False, "properties": {
        "a.b": {"type": ["number", "null"]}, "c d": {"type": ["string", "boolean"]}, "e": {"type": "number", "minimum": 1, "maximum": 10}, "f": {"enum": ["yes", "maybe"]}}}
    got = [sorted(r["v"]) for r in X.validate_json(df, "t", schema, "v").collect()]
    assert got == [["$.f: not in enum"], ["$.e: beyond maximum", "$.z: not allowed", "$['c d']: not string or boolean"]]
    with pytest.raises(ValueError, match="pattern"):
        X.validate_json(df, "t", {"type": "object", "properties": {"a": {"type": "string", "pattern": "x"}}})


def test_texts_are_parsed_once(spark):
    df = spark.createDataFrame([(1, "{}")], "id int, t string")
    plan = X.to_records(df, "t")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"standard_json\(", plan)) <= 2 and len(re.findall(r"ArrowEvalPython \[", plan)) == 1
    assert len(re.findall(r"parse_json|tryparsejson|parseJson", plan, re.I)) <= 2


def test_fields_are_compared_as_parsed(spark):
    df = spark.createDataFrame([('{"b":1,"b":2}', '{"b":2}')], "g string, r string")
    assert E.field_prf(df, "g", "r", ["b"]).first()["n_right"] == 1


def test_labels_without_a_score_are_never_chosen(spark):
    inf = float("inf")
    df = spark.createDataFrame([([0.0, -inf, -1.0], [0.0, -inf, 0.0])], "raw array<double>, prior array<double>")
    out = df.select(S.calibrated(F.col("raw"), F.col("prior")).alias("s")).select("s", S.argmax_label(F.col("s")).alias("p"), S.softmax(F.col("s")).alias("q")).first()
    assert out["s"] == [0.0, -inf, -1.0] and out["p"] == "Good" and out["q"][1] == 0.0


def test_null_answers_are_no_hits_and_null_is_no_class(spark):
    df = spark.createDataFrame([(1, None, None), (2, "Good", "Good")], "id int, answer string, prediction string")
    assert M.accuracy(df).first()["accuracy"] == 0.5
    assert [r["id"] for r in sampling.stratified_n(df, 1).collect()] == [2]
    assert {r["id"]: r["labels"] for r in D.class_encode(df, "answer").collect()} == {1: None, 2: 0}


def test_many_classes(spark):
    df = spark.range(5000).selectExpr("id", "id % 2500 answer")
    assert sampling.stratified_n(df, 1).groupBy("answer").count().filter("count = 1").count() == 2500
    assert D.class_encode(df, "answer").filter("labels != answer").count() == 0
