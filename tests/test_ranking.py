import math

import pytest
from pyspark.sql import functions as F

from tutelage.functions import scores as S
from tutelage.operators import ranking as R

# Recorded answers of three models (raw, prior, calibrated, probability per label).
GOLDEN = {
    "base": ("Standard", 2.1224888392857144, {
        "Good": (-3.78125, -2.4419642857142856, -1.3392857142857144, 0.06468190283292168),
        "Standard": (-0.275390625, -1.4944196428571428, 1.2190290178571428, 0.8353043801933099),
        "Bad": (-1.5234375, -0.6199776785714286, -0.9034598214285714, 0.10001371697376847)}),
    "sft": ("Good", 2.8571428571428568, {
        "Good": (-0.3125, -2.3895089285714284, 2.0770089285714284, 0.9456149213144531),
        "Standard": (-1.3125, -0.5323660714285714, -0.7801339285714286, 0.05430914174963094),
        "Bad": (-9.0625, -1.7098214285714286, -7.352678571428571, 0.00007593693591605525)}),
    "kd": ("Bad", 1.1768275669642856, {
        "Good": (-5.21875, -3.5982142857142856, -1.6205357142857144, 0.05564325990462114),
        "Standard": (-0.98046875, -0.7459542410714286, -0.2345145089285714, 0.22251225081286485),
        "Bad": (-0.48046875, -1.4227818080357142, 0.9423130580357142, 0.721844489282514)}),
}


def test_recorded_responses(spark):
    raw = spark.createDataFrame([(m, [v[0] for v in g[2].values()]) for m, g in GOLDEN.items()], "model string, raw array<double>")
    prior = spark.createDataFrame([(m, [v[1] for v in g[2].values()]) for m, g in GOLDEN.items()], "model string, prior array<double>")
    for r in R.score_response(raw, prior).collect():
        prediction, margin, labels = GOLDEN[r["model"]]
        assert r["prediction"] == prediction
        assert r["top2_margin"] == pytest.approx(margin, abs=1e-9)
        for lab, (a, b, c, p) in labels.items():
            got = (r["raw_scores"][lab], r["prior"][lab], r["scores"][lab], r["probabilities"][lab])
            assert got == pytest.approx((a, b, c, p), abs=1e-9)


def test_ties_and_single_label(spark):
    row = spark.createDataFrame([([1.0, 2.0, 2.0], [0.5], [1.0, float("-inf"), 0.0])], "a array<double>, b array<double>, c array<double>")
    r = row.select(S.argmax_label(F.col("a")).alias("tie"), S.top2_margin(F.col("a")).alias("m0"), S.top2_margin(F.col("b")).alias("m1"),
                   S.softmax(F.col("c")).alias("p")).first()
    assert r["tie"] == "Standard" and r["m0"] == 0.0 and r["m1"] == math.inf
    assert r["p"][1] == 0.0 and sum(r["p"]) == pytest.approx(1.0)


def scores(spark):
    rows = [(1, "Good", 0, 0, -1.0), (1, "Good", 0, 1, -3.0), (1, "Good", 1, 0, -1.5), (1, "Standard", 0, 0, -1.25), (1, "Bad", 1, 0, -9.0),
            (2, "Bad", 0, 0, -0.5), (2, "Good", 0, 0, None)]
    return spark.createDataFrame(rows, "example_id long, label string, variant int, pos int, logprob double")


@pytest.mark.parametrize("how", ["max", "mean"])
def test_one_pass_scores_equal_the_long_way(spark, how):
    ts = scores(spark)
    long = {r["example_id"]: r["raw"] for r in R.best_variant(R.sequence_score(ts), how).collect()}
    wide = {r["example_id"]: r["raw"] for r in R.raw_scores(ts, how).collect()}
    assert long == wide
    want = [-1.5, -1.25, -9.0] if how == "max" else [-1.75, -1.25, -9.0]
    assert wide[1] == want and wide[2] == [-math.inf, -math.inf, -0.5]


def test_bias_changes_the_argmax(spark):
    s = spark.createDataFrame([([0.0, -0.2, -1.0],)], "scores array<double>")
    assert R.predict(s).first()["prediction"] == "Good"
    assert R.predict(s, bias={"Standard": 0.3}).first()["prediction"] == "Standard"


def test_null_prompts(spark):
    rows = R.null_features(spark.range(2).withColumnRenamed("id", "model")).collect()
    assert len(rows) == 14 and sum(r["features"] == " " for r in rows) == 4 and all("Features:" in r["prompt"] for r in rows)


def test_token_logprob_is_stable(spark):
    df = spark.createDataFrame([([1000.0, 1001.0, 999.0], 1)], "x array<double>, t int")
    got = df.select(S.token_logprob(F.col("x"), F.col("t")).alias("v")).first()["v"]
    assert got == pytest.approx(-math.log(math.exp(-1) + 1 + math.exp(-2)))


def test_candidates(spark):
    rows = R.expand_candidates(spark.range(1)).collect()
    assert [(r["label"], r["variant"], r["candidate"]) for r in rows][:2] == [("Good", 0, " Good"), ("Good", 1, "Good")] and len(rows) == 6
