import json

import pytest
from pyspark.sql import functions as F

from tutelage.functions.constants import INVOICE_SCHEMA
from tutelage.operators import extraction as X

# Sample documents of every layout with what they say.
DOCS = [
    ("Invoice #INV-001 dated 2025-09-12 from Acme Co.\nItems:\n1) USB-C Cable x2 @ 9.99 USD\n2) 65W Charger x1 @ 24.50 USD\nTotal: USD 44.48",
     ("INV-001", "2025-09-12", "Acme Co.", 44.48, "USD"), [("USB-C Cable", 2, 9.99, 19.98), ("65W Charger", 1, 24.5, 24.5)], True),
    ("TAX INVOICE\nSeller: Foo Labs Pvt Ltd\nInvoice No: FL-77-A\nDate: 01 Aug 2025\n1. Consultation Hours 3 @ INR 1200\n2. Report Prep 1 @ INR 500\nTOTAL (INR): 4100",
     ("FL-77-A", "2025-08-01", "Foo Labs Pvt Ltd", 4100.0, "INR"), [("Consultation Hours", 3, 1200.0, 3600.0), ("Report Prep", 1, 500.0, 500.0)], True),
    ("Receipt / Invoice\nVendor: Bar & Sons LLC\nRef: INV-9-2025\nDate Issued: 10/01/2025\nItem A qty 5 @ 2.00 USD\nItem B qty 2 @ 5.75 USD\nGrand Total USD 26.50",
     ("INV-9-2025", "2025-10-01", "Bar & Sons LLC", 26.5, "USD"), [("Item A", 5, 2.0, 10.0), ("Item B", 2, 5.75, 11.5)], False),
    ("Invoice #INV-001 dated 2025-09-12 from Acme Co. Total: USD 1234.50.", ("INV-001", "2025-09-12", "Acme Co.", 1234.5, "USD"), [], False),
    ("Invoice text: INV-77, date 2025-08-01, vendor Foo Ltd., total INR 999.00.", ("INV-77", "2025-08-01", "Foo Ltd.", 999.0, "INR"), [], False),
    ("nothing here", (None,) * 5, [], False),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, d[0]) for i, d in enumerate(DOCS)], "id long, text string")


def test_invoice_fields_and_items(docs):
    for r in X.extract_invoice(docs).collect():
        _, fields, items, _ = DOCS[r["id"]]
        assert (r["invoice_number"], r["invoice_date"], r["vendor_name"], r["total_amount"], r["currency"]) == fields
        assert [tuple(i) for i in r["line_items"]] == items
    assert X.line_items(docs).filter("id = 1").orderBy("pos").first()["description"] == "Consultation Hours"


def test_reconcile(docs):
    got = {r["id"]: r for r in X.reconcile(docs).collect()}
    assert [got[i]["balanced"] for i in range(len(DOCS))] == [d[3] for d in DOCS]
    assert float(got[2]["difference"]) == 5.0


def test_extracted_json_conforms(docs):
    out = X.extract_invoice(docs.filter("id < 3")).withColumn("json", X.invoice_json())
    rows = X.to_records(out.select("id", "json"), "json").orderBy("id").collect()
    assert [r["total_amount"] for r in rows] == [44.48, 4100.0, 26.5] and rows[0]["line_items"][0]["unit_price"] == 9.99


GOOD = {"invoice_number": "1", "invoice_date": "2025-01-01", "vendor_name": "V", "total_amount": 1.5, "currency": "USD"}
ITEM = {"description": "d", "qty": 1, "unit_price": 2, "amount": 2.0}


@pytest.mark.parametrize("text, want", [
    (json.dumps(GOOD), []),
    ("Answer: " + json.dumps({**GOOD, "line_items": [ITEM], "extra": True}), []),
    (json.dumps({**GOOD, "line_items": []}), []),
    (json.dumps({k: v for k, v in GOOD.items() if k != "currency"}), ["$.currency: missing"]),
    (json.dumps({**GOOD, "total_amount": "1.5"}), ["$.total_amount: not number"]),
    (json.dumps({**GOOD, "total_amount": True}), ["$.total_amount: not number"]),
    (json.dumps({**GOOD, "vendor_name": None}), ["$.vendor_name: not string"]),
    (json.dumps({**GOOD, "line_items": {}}), ["$.line_items: not array"]),
    (json.dumps({**GOOD, "line_items": [ITEM, {**ITEM, "qty": "2"}, 5]}),
     ["$.line_items[1].qty: not number", "$.line_items[2].amount: missing", "$.line_items[2].description: missing",
      "$.line_items[2].qty: missing", "$.line_items[2].unit_price: missing", "$.line_items[2]: not object"]),
    ('{"invoice":"77","date":"2025/08/01","vendor":"Foo","amount":"INR Nine Hundred"}', sorted(f"$.{k}: missing" for k in GOOD)),
    (json.dumps(GOOD)[:-3], ["$: not JSON"]),
    (json.dumps(GOOD) + json.dumps(GOOD), ["$: not JSON"]),
    (json.dumps(GOOD)[:-1] + ', "currency": "INR"}', []),
    (None, ["$: not JSON"]),
])
def test_schema(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert sorted(X.validate_json(df, "t").first()["violations"]) == sorted(want)


def test_other_schema_types(spark):
    schema = {"type": "object", "properties": {"n": {"type": "integer"}, "b": {"type": "boolean"}, "tags": {"type": "array", "items": {"type": "string"}}}}
    df = spark.createDataFrame([(1, '{"n": 3, "b": false, "tags": ["a"]}'), (2, '{"n": 3.5, "b": 0, "tags": ["a", 1]}'), (3, '{"n": 3.0}')], "id int, t string")
    got = {r["id"]: sorted(r["violations"]) for r in X.validate_json(df, "t", schema).collect()}
    assert got == {1: [], 2: ["$.b: not boolean", "$.n: not integer", "$.tags[1]: not string"], 3: []}
    assert X.schema_type(schema).simpleString() == "struct<n:bigint,b:boolean,tags:array<string>>"


def test_why_coverage(spark):
    out = json.dumps({**GOOD, "why": {"currency": "printed", "other": "x"}})
    df = spark.createDataFrame([(1, out), (2, json.dumps(GOOD)), (3, "junk")], "id int, output string")
    got = {r["id"]: (r["explained"], r["unexplained"]) for r in X.why_coverage(df).collect()}
    assert got[1] == (["currency"], ["invoice_number", "invoice_date", "vendor_name", "total_amount"])
    assert got[2] == ([], list(INVOICE_SCHEMA["required"])) and got[3] == ([], [])


def test_pair_quality(spark):
    good, bad = json.dumps(GOOD), '{"invoice":"77"}'
    df = spark.createDataFrame([(good, bad), (bad, good), (good, good), (bad, "x"), (good, good + " ")], "chosen string, rejected string")
    assert [r["verdict"] for r in X.pair_quality(df).collect()] == ["clear", "inverted", "same", "neither conforms", "both conform"]


def test_schema_rate_counts_each_kind_once_a_row(spark):
    rows = [(["$.items[0].qty: missing", "$.items[12].qty: missing"],), ([],), ([],), (["$: not JSON"],)]
    out = X.schema_rate(spark.createDataFrame(rows, "violations array<string>")).collect()
    assert {r["violation"]: (r["n"], r["share"]) for r in out} == {
        "all": (4, 1.0), "conforms": (2, 0.5), "$.items[].qty: missing": (1, 0.25), "$: not JSON": (1, 0.25)}
    assert X.schema_rate(spark.createDataFrame([], "violations array<string>")).count() == 0


def test_extra_keys_are_one_kind(spark):
    schema = {"type": "object", "properties": {"a": {"type": "array", "items": {"type": "object", "properties": {}, "additionalProperties": False}}}, "additionalProperties": False}
    df = spark.createDataFrame([(json.dumps({f"k{i}.x": 1, f"m: not {i}": 2, "a": [{f"z{i}": 1}]}),) for i in range(50)], "t string")
    out = {r["violation"]: (r["n"], r["share"]) for r in X.schema_rate(X.validate_json(df, "t", schema)).collect()}
    assert out == {"all": (50, 1.0), "additional key: not allowed": (50, 1.0)}


def test_each_text_is_searched_and_parsed_once(spark):
    """However often a result is used behind it: counted in the plan that runs."""
    import re

    from tutelage.operators.datasets import valid_annotations

    def planned(df, what):
        return len(re.findall(what, df._jdf.queryExecution().optimizedPlan().toString()))

    text = spark.createDataFrame([(1, "x")], "id int, text string").filter("id > 0").repartition(2)
    out = X.extract_invoice(text).filter("currency = 'USD' and total_amount > 1").select("invoice_date", "vendor_name", "line_items", "currency")
    assert planned(out, r"regexp_extract\(text") <= 20 and planned(out, r"regexp_extract_all\(") == 1
    balanced = X.reconcile(text).filter("balanced")
    assert planned(balanced, r"regexp_extract\(text") <= 4 and planned(balanced, r"regexp_extract_all\(") == 1
    covered = X.why_coverage(text, "text").filter("size(unexplained) > 0 and size(explained) > 0")
    assert planned(covered, r"from_json\(") == 2
    assert planned(valid_annotations(text, "text"), r"from_json\(") == 1


def test_a_text_that_surely_conforms_is_not_checked_again(spark, monkeypatch):
    import random

    from tutelage.functions import jsontext

    rng = random.Random(4)
    odd = [None, True, 7, 7.5, 1e300, float("nan"), 10**40, "x", "\ud800", [], {}, [[1]], [{"description": "d", "qty": 1, "unit_price": 2, "amount": True}]]
    good = {"invoice_number": "1", "invoice_date": "d", "vendor_name": "v", "total_amount": 1.5, "currency": "EUR", "line_items": [{"description": "a", "qty": 1, "unit_price": 2.5, "amount": 2.5}], "why": {"a": ["b"]}}
    values = [good, {**good, "more": {"a": [1, {"b": None}]}}]
    for key in [*good, "more"]:
        values += [{**good, key: v} for v in odd] + [{k: v for k, v in good.items() if k != key}]
        values += [{**good, "line_items": [{**good["line_items"][0], rng.choice(["qty", "description", "extra"]): v}]} for v in odd]
    rows = [(i, json.dumps(v)) for i, v in enumerate([*values, *odd])] + [(-1, None), (-2, "{"), (-3, '{"a": 1} {"a": 2}'), (-4, json.dumps({**good, "why": "w" * 50_000}))]
    df = spark.createDataFrame(rows, "id int, t string").coalesce(1)
    schemas = [INVOICE_SCHEMA, {"type": ["object", "null"], "additionalProperties": False, "properties": {"total_amount": {"minimum": 2}}}, {"type": "object", "properties": {"why": {}, "total_amount": {"type": "integer"}}}]
    for schema in schemas:
        check = lambda: sorted((r["id"], r["violations"]) for r in X.validate_json(df, "t", schema).collect())  # noqa: B023, E731
        quick = check()
        sure = [r["s"]["sure"] for r in df.select(jsontext.standard_and_sure(schema)("t").alias("s")).collect()]
        monkeypatch.setattr(jsontext, "PLAIN_CHARS", -1)
        assert quick == check()
        monkeypatch.undo()
        assert any(sure) != ("additionalProperties" in schema)
