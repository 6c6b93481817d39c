import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tutelage.operators import datasets as D
from tutelage.operators import routing


def brute_pairs(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        system = None
        for i, (_, turn, role, text) in enumerate(turns):
            if role == "system":
                system = text
            nxt = turns[i + 1] if i + 1 < len(turns) else None
            if role == "user" and nxt and nxt[2] == "assistant":
                out.append((conv, turn, text if system is None else f"{system}\n\n{text}", nxt[3]))
    return sorted(out)


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_pairs_in_blocks(spark, block):
    rng = random.Random(2)
    # One conversation holds most of the turns; turn numbers have gaps.
    rows = [(0 if i < 300 else i % 20, t, rng.choice(["user", "assistant", "assistant", "user", "system"]), f"t{i}")
            for i, t in enumerate(rng.sample(range(2000), 500))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(tuple(r) for r in D.pairs_from_turns(df, block).collect()) == brute_pairs(rows)


def test_negative_label(spark):
    df = spark.range(3000).withColumn("y", F.element_at(F.array(*map(F.lit, D.LABELS)), (F.col("id") % 3 + 1).cast("int")))
    rows = df.select("y", D.negative_label("y", "id").alias("n")).collect()
    counts = Counter((r["y"], r["n"]) for r in rows)
    assert len(counts) == 6 and all(y != n for y, n in counts) and min(counts.values()) > 400
    two = spark.range(10).select(D.negative_label(F.lit("a"), "id", labels=("a", "b")).alias("n"))
    assert {r["n"] for r in two.collect()} == {"b"}


def test_sets_share_one_selection(spark):
    df = spark.range(90).select("id", F.when(F.col("id") < 50, "Good").when(F.col("id") < 80, "Standard").otherwise(" Bad ").alias("answer"), F.lit("q").alias("question"))
    sets = D.build_sets(df)
    ids = {m: sorted(r["id"] for r in s.collect()) for m, s in sets.items()}
    assert ids["sft"] == ids["kd"] == ids["dpo"] and len(ids["sft"]) == 30
    assert Counter(r["output"] for r in sets["sft"].collect()) == {"Good": 10, "Standard": 10, "Bad": 10}


def test_teacher(spark):
    gold = spark.createDataFrame([(1, "q1", "Good"), (2, "q2", "Bad"), (3, "q3", "Bad")], "id long, question string, answer string")
    ann = spark.createDataFrame([(1, '{"reason": "r", "label": "Bad"}'), (2, '{"reason": "r", "label": "Awful"}'), (3, '{"label": "Bad"}'), (4, "junk")], "id long, annotation string")
    good = D.valid_annotations(ann)
    assert [(r["id"], r["label"]) for r in good.collect()] == [(1, "Bad")]
    assert D.join_teacher(gold, good).first()["teacher_label"] == "Bad"
    kd = D.kd_rows(gold.join(good.select("id", F.col("label").alias("t")), "id", "left"), "t")
    assert {r["id"]: r["teacher_output"] for r in kd.collect()} == {1: "Bad", 2: "Bad", 3: "Bad"}


def test_label_ids(spark):
    df = spark.createDataFrame([("Bad",), ("Standard",), ("Good",), ("Other",)], "y string")
    assert [r[0] for r in df.select(D.encode_label("y")).collect()] == [0, 1, 2, None]
    assert [r[0] for r in df.select(D.decode_label(D.encode_label("y"))).collect()] == ["Bad", "Standard", "Good", None]
    assert [r["labels"] for r in D.class_encode(df, "y").collect()] == [0, 3, 1, 2]


def test_routing(spark):
    reg = spark.createDataFrame([("idp_sft_abcdefgh", "idp", 2), ("idp_kd_12345678", "idp", 1), ("codegen_dpo_zzzzzzzz", "codegen", 3)], "model_key string, flow string, load_order int")
    req = spark.createDataFrame([(1, "idp", "sft", "abcdefghij"), (2, "idp", "sft", "other-run-id"), (3, "idp", "sft", None), (4, "codegen", "kd", None), (5, "mlqa", "kd", None)],
                                "id int, flow string, method string, run_id string")
    got = {r["id"]: (r["model_key"], r["base_model"]) for r in routing.route_models(req, reg).collect()}
    assert [got[i][0] for i in range(1, 6)] == ["idp_sft_abcdefgh", None, "idp_kd_12345678", "codegen_dpo_zzzzzzzz", None]
    assert got[4][1] != got[1][1] == got[5][1]
