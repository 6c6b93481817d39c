import random

from pyspark.sql import functions as F

from tutelage.functions import templates as P
from tutelage.functions.constants import PY_WHITESPACE
from tutelage.functions.text import features_text, norm_date, parse_sections, py_strip, strip_prompt, tokens


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_py_strip_is_str_strip(spark):
    rng = random.Random(1)
    alphabet = PY_WHITESPACE + "ab​﻿é"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(500)] + ["", " "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r["s"] for r in df.select("t", py_strip("t").alias("s")).collect()] == [t.strip() for t in texts]
    assert one(spark, py_strip(F.lit(None).cast("string"))) is None


def test_strip_prompt_goes_by_position(spark):
    rows = [("abcé", "abcé  answer \n", "answer"), ("abc", "xyz tail", "tail"), ("longer than it", "short", ""), ("", " all ", "all")]
    df = spark.createDataFrame(rows, "p string, g string, want string")
    for r in df.select(strip_prompt("g", "p").alias("got"), "want").collect():
        assert r["got"] == r["want"]


def test_features_text(spark):
    spec = {"Age": F.lit("23.0"), "Occupation": F.lit("Scientist"), "Missing": F.lit(None).cast("string"), "Annual Income": F.lit(19114.12)}
    assert one(spark, features_text(spec)) == "Age: 23.0, Occupation: Scientist, Annual Income: 19114.12"


def test_parse_sections(spark):
    both = one(spark, parse_sections(F.lit("<PLAN>\n- a\n- b\n</PLAN>\n<CODE>\nx = 1\n  y\n</CODE>")))
    assert (both["plan"], both["code"]) == ("- a\n- b", "x = 1\n  y")
    code = one(spark, parse_sections(F.lit("<CODE>\n\n</CODE>")))
    assert (code["plan"], code["code"]) == (None, "")
    neither = one(spark, parse_sections(F.lit("def f(): pass")))
    assert (neither["plan"], neither["code"]) == (None, None)


def test_norm_date(spark):
    for text, want in {"2025-09-12": "2025-09-12", "01 Aug 2025": "2025-08-01", " 1 Aug 2025": "2025-08-01", "10/01/2025": "2025-10-01",
                       "2025-02-30": None, "2025/08/01": None, "": None}.items():
        got = one(spark, norm_date(F.lit(text)))
        assert (None if got is None else got.isoformat()) == want, text


def test_tokens(spark):
    assert one(spark, tokens(F.lit("  a\tb\n\nc  "))) == ["a", "b", "c"]
    assert one(spark, tokens(F.lit(" \n"))) == []


def test_prompts(spark):
    # The wordings are fixed: training and scoring differ, and so do the two document prompts.
    assert one(spark, P.credit_train_prompt(F.lit("Age: 1"))).startswith("Classify the credit risk into one of {Good, Standard, Bad}.\n\nFeatures:\nAge: 1\n")
    chat = one(spark, P.credit_chat_prompt(F.lit("Age: 1")))
    assert "into exactly one of {Good, Standard, Bad}." in chat and chat.endswith("<|im_end|>\n<|im_start|>assistant\n")
    assert chat.startswith("<|im_start|>system\nYou are a careful credit risk classifier.<|im_end|>\n<|im_start|>user\n")
    custom = one(spark, P.credit_chat_prompt(F.lit("x"), turn="[%s]%s", assistant_start="[a]"))
    assert custom.startswith("[system]You are") and custom.endswith("Return only the label.[a]")
    d = F.lit("DOC")
    assert one(spark, P.kd_prompt(d, True)) != one(spark, P.dpo_prompt(d, True))
    assert one(spark, P.kd_prompt(d, True)).endswith("<document>\nDOC\n</document>\nReturn only JSON.")
    assert one(spark, P.kd_prompt(d)).endswith("Problem:\nDOC\n\nProduce correct, runnable code.")
    assert one(spark, P.dpo_prompt(d)).endswith("Problem:\nDOC\nRespond with correct, runnable code.")
    assert one(spark, P.codegen_infer_prompt(d, True)).endswith("final <CODE>.\nProblem:\nDOC\n")
    assert one(spark, P.format_prompt(d, "sft")) == "DOC"
    assert one(spark, P.format_prompt(d, "other")) == ""
    assert one(spark, P.supervised_text(F.lit("a"), F.lit("b"))) == "a\n\nb"
    assert one(spark, P.supervised_text(F.lit("a"), F.lit(None))) is None
