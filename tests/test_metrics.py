import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tutelage.operators import metrics as M
from tutelage.operators.quantiles import exact_percentiles

LABELS = ("Good", "Standard", "Bad")

# Recorded confusion matrices (truth in rows, both in the order Good, Standard, Bad) and
# reports: accuracy, macro F1, then precision, recall, F1 of Bad, Good, Standard.
RECORDED = {
    "base": ([[283, 855, 362], [196, 841, 463], [147, 874, 479]], 0.3562, 0.3404,
             [(.3673, .3193, .3417), (.4521, .1887, .2662), (.3272, .5607, .4133)]),
    "sft": ([[1472, 18, 10], [1098, 62, 340], [85, 37, 1378]], 0.6471, 0.5463,
            [(.7975, .9187, .8538), (.5544, .9813, .7085), (.5299, .0413, .0767)]),
    "kd": ([[1027, 243, 230], [813, 264, 423], [599, 266, 635]], 0.4280, 0.4031,
           [(.4930, .4233, .4555), (.4211, .6847, .5215), (.3415, .1760, .2323)]),
    "dpo": ([[891, 353, 256], [625, 365, 510], [223, 314, 963]], 0.4931, 0.4783,
            [(.5570, .6420, .5965), (.5124, .5940, .5502), (.3537, .2433, .2883)]),
}


@pytest.fixture(scope="module")
def rows(spark):
    cells = [(m, LABELS[i], LABELS[j], n) for m, (mx, *_) in RECORDED.items() for i, r in enumerate(mx) for j, n in enumerate(r)]
    df = spark.createDataFrame(cells, "model string, answer string, prediction string, n int")
    return df.select("model", "answer", "prediction", F.explode(F.sequence(F.lit(1), "n"))).drop("col").persist()


@pytest.mark.parametrize("model", RECORDED)
def test_recorded_reports(rows, model):
    matrix, acc, macro, classes = RECORDED[model]
    one = rows.filter(F.col("model") == model)
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in M.confusion(one).collect()}
    assert [[cells[t, p] for p in LABELS] for t in LABELS] == matrix
    full = {r["label"]: r for r in M.full_report(one).collect()}
    assert round(full["accuracy"]["f1"], 4) == acc and round(full["macro avg"]["f1"], 4) == macro
    for lab, want in zip(("Bad", "Good", "Standard"), classes):
        assert tuple(round(full[lab][m], 4) for m in ("precision", "recall", "f1")) == want
        assert full[lab]["support"] == 1500
    assert full["weighted avg"]["f1"] == pytest.approx(full["macro avg"]["f1"]) and full["weighted avg"]["support"] == 4500
    counts = {(r["side"], r["label"]): r["n"] for r in M.label_counts(one).collect()}
    assert [counts["pred", lab] for lab in LABELS] == [sum(r[j] for r in matrix) for j in range(3)]


def test_compare(rows):
    got = {r["model"]: r for r in M.compare_models(rows, "base").collect()}
    assert got["base"]["delta_accuracy"] == 0 and round(got["sft"]["delta_accuracy"], 4) == round(2912 / 4500 - 1603 / 4500, 4)
    assert round(got["dpo"]["macro_f1"], 4) == 0.4783


def test_zero_division(spark):
    df = spark.createDataFrame([("Good", "Good"), ("Good", "Bad")], "answer string, prediction string")
    got = {r["label"]: r for r in M.class_report(df).collect()}
    assert (got["Standard"]["precision"], got["Standard"]["recall"], got["Standard"]["f1"], got["Standard"]["support"]) == (0, 0, 0, 0)
    assert got["Bad"]["precision"] == 0.0 and got["Good"]["recall"] == 0.5


def test_confusion_table(rows):
    table = {(r["model"], r["y_true"]): [r[lab] for lab in LABELS] for r in M.confusion_table(M.confusion(rows, by=("model",)), by=("model",)).collect()}
    assert table["sft", "Standard"] == [1098, 62, 340]


def test_drift(spark):
    a = spark.createDataFrame([("Good",), ("Good",), ("Bad",), ("Old",)], "prediction string")
    b = spark.createDataFrame([("Good",), ("Standard",)], "prediction string")
    got = {r["label"]: (r["baseline_share"], r["current_share"], r["drift"]) for r in M.class_drift(a, b).collect()}
    assert got == {"Good": (.5, .5, 0), "Bad": (.25, 0, -.25), "Old": (.25, 0, -.25), "Standard": (0, .5, .5)}


@pytest.mark.parametrize("accuracy, max_inside", [(50, 10), (1000, 100), (10_000, 10**6)])
def test_exact_percentiles(spark, accuracy, max_inside):
    rng = random.Random(3)
    groups = {"even": [rng.random() for _ in range(4000)], "same": [1.5] * 3000, "third": [0.0] * 1000 + [rng.gauss(0, 1e6) for _ in range(2000)],
              "tiny": [3.0, 1.0], "single": [7.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("tiny", None)], "g string, v double").repartition(4)
    probs = (0.0, 0.05, 0.5, 0.95, 1.0)
    got = {(r["g"], r["prob"]): r["value"] for r in exact_percentiles(df, "v", probs, "g", accuracy, max_inside).collect()}
    for g, vs in groups.items():
        assert [got[g, p] for p in probs] == pytest.approx(list(np.quantile(vs, probs)), rel=1e-12)
    assert exact_percentiles(df.filter("false"), "v", probs).count() == 0


@pytest.mark.parametrize("max_inside", [40, 10**6])
def test_percentiles_of_many_groups(spark, max_inside):
    """Thousands of groups, some far larger than others, at plans of the same size."""
    rng = random.Random(5)
    groups = {g: [round(rng.gauss(0, 10), 1) for _ in range(1 + g % 7)] for g in range(1500)}
    groups[7] = [rng.choice([1.0, 2.0, rng.random()]) for _ in range(3000)]
    groups[8] = [0.0] * 500 + [1e30] * 3 + [-1e30]
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [(None, 5.0), (3, None)], "g int, v double").repartition(4)
    probs = (0.0, 0.3, 0.5, 1.0)
    got = {(r["g"], r["prob"]): r["value"] for r in exact_percentiles(df, "v", probs, "g", max_inside=max_inside).collect()}
    assert len(got) == len(groups) * len(probs)
    for g, vs in groups.items():
        assert [got[g, p] for p in probs] == pytest.approx(list(np.quantile(vs, probs)), rel=1e-9)
