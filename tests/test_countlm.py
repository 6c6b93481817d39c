import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tutelage.operators import countlm as C
from tutelage.operators.joins import join_lookup, join_skewed
from tutelage.plans.scorer import CountScorer

RNG = random.Random(5)
WORDS = [f"w{i}" for i in range(60)]
# One word makes up a third of everything, in the training texts and in the unknown words of the scored ones.
TRAIN = [(i, RNG.choice(["Good", "Standard", "Bad"]), " ".join(RNG.choice(["the"] * 30 + WORDS) for _ in range(RNG.randint(1, 20)))) for i in range(80)]
SCORED = [(i, " ".join(RNG.choice(["the", "oov"] * 30 + WORDS + ["x1", "x2"]) for _ in range(RNG.randint(0, 15)))) for i in range(60)]


@pytest.fixture(scope="module")
def lm(spark):
    return C.fit_count_lm(spark.createDataFrame(TRAIN, "id long, answer string, question string"))


def brute():
    counts = {lab: Counter() for lab in C.LABELS}
    for _, lab, text in TRAIN:
        counts[lab].update(text.split())
    v = len(set().union(*counts.values()))
    lp = lambda t, lab: math.log((counts[lab][t] + 1) / (sum(counts[lab].values()) + v))
    return {i: [sum(lp(t, lab) for t in text.split()) / len(text.split()) for lab in C.LABELS] if text.split() else None for i, text in SCORED}


@pytest.mark.parametrize("broadcast_bytes", [10**6, 0])
def test_scores(spark, lm, broadcast_bytes):
    df = spark.createDataFrame(SCORED, "example_id long, prompt string")
    got = {r["example_id"]: r["raw"] for r in C.count_lm_scores(df, lm, broadcast_bytes=broadcast_bytes).collect()}
    want = brute()
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert (got[i] is None and w is None) or got[i] == pytest.approx(w, abs=1e-12)


def test_long_form_agrees(spark, lm):
    df = spark.createDataFrame(SCORED, "example_id long, prompt string")
    for b in (10**6, 0):
        rows = C.token_scores(df, lm, broadcast_bytes=b).groupBy("example_id", "label").agg(F.avg("logprob").alias("s")).collect()
        for r in rows:
            assert r["s"] == pytest.approx(brute()[r["example_id"]][C.LABELS.index(r["label"])], abs=1e-12)


def test_saved_counts_score_the_same(spark, lm, tmp_path):
    lm.save(str(tmp_path / "lm"))
    again = C.load_count_lm(spark, str(tmp_path / "lm"))
    assert (again.n, again.v, again.size) == (lm.n, lm.v, lm.size)
    df = spark.createDataFrame(SCORED, "example_id long, prompt string")
    score = lambda m: sorted((r["example_id"], r["n_tokens"]) for r in C.count_lm_scores(df, m).collect())
    assert score(lm) == score(again)


def test_perplexity(spark):
    texts = [(1, "a a b"), (2, "b"), (3, ""), (4, "c a a a")]
    df = spark.createDataFrame(texts, "id long, text string")
    lm = C.fit_count_lm(df, "text", None)
    n, v, c = 8, 3, {"a": 5, "b": 2, "c": 1}
    nll = lambda ts: math.exp(-sum(math.log((c[t] + 1) / (n + v)) for t in ts) / len(ts))
    for b in (10**6, 0):
        got = {r["id"]: r["perplexity"] for r in C.count_perplexity(df, lm, max_len=3, broadcast_bytes=b).collect()}
        assert got[1] == pytest.approx(nll(["a", "b"])) and got[4] == pytest.approx(nll(["a", "a"]))
        assert got[2] is None and got[3] is None
    stored = spark.createDataFrame([(1, 0, -5.0), (1, 1, -1.0), (1, 2, -2.0), (2, 0, -1.0)], "example_id long, pos int, logprob double")
    got = {r["example_id"]: r["perplexity"] for r in C.perplexity(stored).collect()}
    assert got[1] == pytest.approx(math.exp(1.5)) and got[2] is None


def test_scorer_prior_counts_the_space_twice(spark):
    scorer = CountScorer.fit(spark.createDataFrame(TRAIN, "id long, answer string, question string"))
    again = scorer.respond(spark.createDataFrame([(0, "N/A")], "id long, f string"), "f", ("id",)).first()
    assert set(again["probabilities"]) == set(C.LABELS) and again["prediction"] in C.LABELS


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_skewed_keeps_every_row(spark, how):
    rows = [(i, "hot" if i % 3 else (f"k{i % 50}" if i % 7 else None)) for i in range(600)]
    left = spark.createDataFrame(rows, "id long, k string")
    right = spark.createDataFrame([("hot", 1), ("k3", 2), ("k6", 3), ("unused", 4)], "k string, v int")
    want = sorted(map(tuple, left.join(right, "k", how).select("id", "k", "v").collect()))
    for n in (1, 3, 1000):
        assert sorted(map(tuple, join_skewed(left, right, ["k"], how, n).select("id", "k", "v").collect())) == want
    for limit in (0, 100):
        assert sorted(map(tuple, join_lookup(left, right, "k", how, limit).select("id", "k", "v").collect())) == want


def test_only_open_tokens_leave_their_text(spark, monkeypatch):
    """Words of a template, known or not, stay with their text; only rare words that the counts may hold go through the shuffle."""
    monkeypatch.setattr(C.frequent, "__defaults__", (2,))
    fitted = C.fit_count_lm(spark.createDataFrame([(i, f"the own{i}") for i in range(300)], "id long, text string"), "text", None)
    rows = [(i, "never seen words of a template the " + f"own{i} new{i} " * (i % 2)) for i in range(200)] + [(7, None), (None, ""), (None, " \t")]
    df = spark.createDataFrame(rows, "id long, text string")
    settled = C._settled(df, fitted, "text", ("id",), slice(0, None), False).collect()
    open_ = [r["__w"] for r in settled if r["__w"] is not None]
    assert {f"own{i}" for i in range(1, 200, 2)} <= set(open_) and len(open_) <= 110 and len(settled) <= 215
    assert sum(r["__n"] for r in settled) == 200 * 7 + 100 * 2
    score = lambda b: sorted((repr(r["id"]), r["n_tokens"], round(r["raw"][0], 9) if r["raw"] else None) for r in C.count_lm_scores(df, fitted, "text", ("id",), broadcast_bytes=b).collect())
    assert score(0) == score(10**6)
    assert C.frequent(fitted).count() == 1 and C.frequent(C.fit_count_lm(df.filter("id = 1"), "text", None)).count() == 2


def test_a_full_filter_lets_few_unknown_tokens_through(spark, monkeypatch):
    monkeypatch.setattr(C, "SLICES", 1)  # 4 bits for each of 32,768 tokens
    fitted = C.fit_count_lm(spark.range(32768).select(F.concat(F.lit("word"), "id").alias("text")), "text", None)
    known = C._filter(fitted)
    assert C._possible([f"word{i}" for i in range(0, 32768, 7)], known).all()
    assert C._possible([f"other{i}" for i in range(20000)], known).mean() < 0.2


def test_files_of_bucketed_counts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(C, "BUCKET_BYTES", 4096)
    fitted = C.fit_count_lm(spark.createDataFrame([(i, f"word{i}") for i in range(300)], "id long, text string"), "text", None)
    stored = C.bucketed(fitted, "bounded_counts", 2)
    assert -(-fitted.size // 4096) > 2 and stored.counts.count() == 300
    assert spark.sql("describe extended bounded_counts").filter("col_name = 'Num Buckets'").first()["data_type"] == str(-(-fitted.size // 4096))
