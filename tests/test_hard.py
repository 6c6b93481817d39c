"""Hard examples, their preference pairs, and the form of code answers."""

from pyspark.sql import functions as F

from tutelage.operators import hard as H

NONE = float("-inf")


def test_hard_examples_and_pairs(spark):
    rows = [(1, "Good", [.5, .45, .1]), (2, "Bad", [.5, .4, .1]), (3, "Standard", [.1, .9, .2]), (4, None, [1., 2., 3.]),
            (5, "Bad", [NONE, NONE, NONE]), (6, "Good", [0., NONE, NONE]), (7, "Other", [1., 2., 3.])]
    df = spark.createDataFrame(rows, "id int, answer string, scores array<double>")
    found = {r["id"]: (r["rival"], round(r["gap"], 6)) for r in H.hard_examples(df).collect()}
    assert found == {1: ("Standard", 0.05), 2: ("Good", -0.4), 5: ("Good", NONE)}
    pairs = {r["id"]: (r["prompt"], r["chosen"], r["rejected"]) for r in H.hard_pairs(df, F.lit("p")).collect()}
    assert pairs == {1: ("p", "Good", "Standard"), 2: ("p", "Bad", "Good"), 5: ("p", "Bad", "Good")}
    assert H.hard_examples(df.limit(0)).count() == 0


def test_code_conformance(spark):
    texts = ["<PLAN>a</PLAN><CODE>b</CODE>", "<CODE>b</CODE><PLAN>a</PLAN>", "<PLAN>a</PLAN><CODE> </CODE>", None, "x"]
    df = spark.createDataFrame([(t,) for t in texts], "generated string")
    assert H.code_conformance(df).first().asDict() == {
        "num_examples": 5, "plan_rate": 0.6, "code_rate": 0.6, "order_rate": 0.4, "empty_code_rate": 0.2, "conforming_rate": 0.2}
    assert H.code_conformance(df.limit(0)).first()["plan_rate"] is None
