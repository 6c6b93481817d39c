from pyspark.sql import functions as F

from tutelage.operators import tokens as K


def test_mask_and_pad(spark):
    df = spark.createDataFrame([(1, "a b c", "d e"), (2, "a b c d e f", "g"), (3, "", "x")], "id long, prompt string, target string")
    rows = {r["id"]: r for r in K.mask_prompt(df, max_len=5).collect()}
    assert rows[1]["labels"][:3] == [-100] * 3 and rows[1]["labels"][3:] == rows[1]["input_ids"][3:]
    assert rows[2]["labels"] == [-100] * 5 and len(rows[2]["input_ids"]) == 5
    assert rows[3]["labels"] == rows[3]["input_ids"] and rows[1]["attention_mask"] == [1] * 5
    padded = {r["id"]: r for r in K.pad(K.tokenize(df, "prompt", 4), 4).collect()}
    assert padded[1]["attention_mask"] == [1, 1, 1, 0] and padded[1]["input_ids"][3] == 0
    assert padded[3]["attention_mask"] == [0] * 4


def test_own_tokenizer(spark):
    def letters(texts):
        return [[ord(c) for c in t] for t in texts]

    df = spark.createDataFrame([("abc", "de")], "prompt string, target string")
    row = K.mask_prompt(df, fn=letters).first()
    assert row["input_ids"] == [ord(c) for c in "abc\n\nde"] and row["labels"] == [-100] * 3 + [ord(c) for c in "\n\nde"]
    assert K.length_report(df, fn=letters).first()["max_len"] == 7


def test_step_counts(spark):
    df = spark.createDataFrame([(22764,)], "n long")
    r = K.step_counts(df, "n", batch=2, accum=8, epochs=5).first()
    assert (r["n_batches"], r["steps_per_epoch"], r["total_steps"], r["warmup_steps"]) == (11382, 1423, 7115, 213)
    assert K.step_counts(df, "n", 2, 8, 5, max_steps=100).first()["total_steps"] == 100


def test_length_report(spark):
    df = spark.createDataFrame([("a b", "c"), ("a b c d e f", "g")], "prompt string, target string")
    r = K.length_report(df, max_len=5).first()
    assert (r["n"], r["min_len"], r["max_len"], r["n_truncated"], r["n_unsupervised"]) == (2, 3, 7, 1, 1)
    assert r["p50_len"] == 5.0


def test_pad_cuts_what_is_too_long(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4]), (2, [1]), (3, [])], "id int, input_ids array<int>")
    got = {r["id"]: (r["input_ids"], r["attention_mask"]) for r in K.pad(df, 3).collect()}
    assert got == {1: ([1, 2, 3], [1, 1, 1]), 2: ([1, 0, 0], [1, 0, 0]), 3: ([0, 0, 0], [0, 0, 0])}
