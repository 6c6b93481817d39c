"""Stored scorers, synonyms, grouped scoring, fixed steps, the large vocabulary."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tutelage.functions.constants import LABELS
from tutelage.operators import countlm as C
from tutelage.operators import inference as I
from tutelage.operators import ranking as R
from tutelage.operators import steps
from tutelage.plans import store
from tutelage.plans.scorer import CountScorer, ModelScorer

SYN = {"Good": ("Good", "Strong"), "Standard": ("Standard",), "Bad": ("Bad", "Weak", "Poor")}


def train(spark):
    rows = [(1, "Good", "a a b"), (2, "Bad", "c c"), (3, "Standard", "b c d"), (4, "Strong", "a e"), (5, "Poor", "c f f")]
    return spark.createDataFrame(rows, "id long, answer string, question string")


@pytest.mark.parametrize("across", R.ACROSS)
def test_synonyms_reduce_in_two_levels(spark, across):
    rng = random.Random(1)
    rows = [(e, lab, n, v, p, rng.choice([None, -rng.random() * 5])) for e in range(12) for lab, names in SYN.items() if (e, lab) != (3, "Bad")
            for n in names for v in (0, 1) for p in range(rng.randint(0, 3))]
    df = spark.createDataFrame(rows, "example_id int, label string, synonym string, variant int, pos int, logprob double")

    def plain(e, lab):
        names = []
        for n in SYN[lab]:
            means = []
            for v in (0, 1):
                own = [r[5] for r in rows if r[:4] == (e, lab, n, v) and r[5] is not None]
                means += [sum(own) / len(own)] if own else []
            names += [max(means)] if means else []
        if not names:
            return -math.inf
        return {"max": max(names), "mean": sum(names) / len(names), "logsum": math.log(sum(map(math.exp, names)))}[across]

    got = {r["example_id"]: r["raw"] for r in R.synonym_raw(df, SYN, across).collect()}
    for e, raw in got.items():
        assert raw == pytest.approx([plain(e, lab) for lab in LABELS])
    again = R.best_synonym(R.sequence_score(df, ("example_id", "label", "synonym", "variant")), SYN, across)
    again = {r["example_id"]: r["raw"] for r in again.collect()}
    assert again.keys() == {e for e, r in got.items() if any(x > -math.inf for x in r)} and all(r == pytest.approx(got[e]) for e, r in again.items())
    with pytest.raises(ValueError):
        R.across_synonyms(F.array(F.lit(1.0)), "median")


def test_scorers_ask_for_every_synonym(spark):
    def load():
        import numpy as np

        good = {"Strong": 1.0, "Weak": 2.0}
        return lambda prompts, c: {"sum_logprob": np.array([-good.get(x.strip(), 9.0) for x in c]), "n_tokens": np.ones(len(c), dtype="int64")}

    df = train(spark)
    for across, best in (("max", [-1.0, -9.0, -2.0]), ("mean", [-5.0, -9.0, -20 / 3])):
        scorer = ModelScorer.load(spark, load, synonyms=SYN, across=across)
        assert [scorer.prior[lab] for lab in LABELS] == pytest.approx(best)  # reduced alike in priors
        assert all(r["raw"] == pytest.approx(best) for r in scorer.raw(df, "question", ("id",)).collect())
    single = CountScorer.fit(df, synonyms={lab: (lab,) for lab in LABELS})
    plain = CountScorer.fit(df)
    assert single.prior == pytest.approx(plain.prior)
    both = CountScorer.fit(df, synonyms=SYN, across="mean")
    place = both.lm.labels.index
    alone = C.count_lm_scores(df.select("id", F.col("question").alias("prompt")), both.lm, keys=("id",)).collect()
    assert set(both.lm.labels) == {n for names in SYN.values() for n in names} and len(alone) == 5
    raw = {r["id"]: r["raw"] for r in both.raw(df, "question", ("id",)).collect()}
    names = {r["id"]: r["raw"] for r in C.count_lm_scores(df.select("id", R.credit_chat_prompt("question").alias("prompt")), both.lm, keys=("id",)).collect()}
    assert raw[1][0] == pytest.approx((names[1][place("Good")] + names[1][place("Strong")]) / 2)


def test_store_keeps_versions_and_checks(spark, tmp_path):
    root, df = str(tmp_path / "store"), train(spark)
    with pytest.raises(FileNotFoundError):
        store.load_scorer(spark, root, "credit")
    first, second = CountScorer.fit(df), CountScorer.fit(df.filter("id < 4"))
    store.save_scorer(first, root, "credit", "v1")
    store.save_scorer(second, root, "credit", "v1")  # a version that is there stays
    answers = lambda s: {r["id"]: (r["prediction"], r["top2_margin"]) for r in s.respond(df, "question", ("id",)).collect()}
    loaded = store.load_scorer(spark, root, "credit", labels=LABELS)
    assert answers(loaded) == answers(first) and loaded.version == "v1" and loaded.prior == first.prior
    store.save_scorer(second, root, "credit", "v2")
    store.save_scorer(first, root, "other", "v9")
    assert store.latest_version(spark, root, "credit") == "v2" and answers(store.load_scorer(spark, root, "credit")) == answers(second)
    assert store.load_scorer(spark, root, "credit", "v1").lm.v == first.lm.v
    with pytest.raises(ValueError, match="stored for the labels"):
        store.load_scorer(spark, root, "credit", labels=LABELS[::-1])
    syn = CountScorer.fit(df, synonyms=SYN, across="logsum")
    store.save_scorer(syn, root, "syn", "1")
    assert answers(store.load_scorer(spark, root, "syn")) == answers(syn)
    counts = store.commits.folders(spark, root, "credit@v2")["counts"]
    spark.createDataFrame([("zz", [1, 1, 1])], store.COUNTS).write.mode("append").parquet(counts)
    with pytest.raises(ValueError, match="not those that were stored"):
        store.load_scorer(spark, root, "credit", "v2")
    with pytest.raises(ValueError):
        store.save_scorer(first, root, "a/b", "v1")


def test_saved_counts_know_their_labels(spark, tmp_path):
    lm = C.fit_count_lm(train(spark))
    lm.save(str(tmp_path / "lm"))
    assert C.load_count_lm(spark, str(tmp_path / "lm")).n == lm.n
    with pytest.raises(ValueError, match="asked for"):
        C.load_count_lm(spark, str(tmp_path / "lm"), LABELS[::-1])


def test_prior_of_a_model_is_kept(spark, tmp_path):
    def load():
        raise AssertionError("the model was asked")

    root = str(tmp_path / "priors")
    store.save_prior(spark, root, "sft", "1", {"Good": -1.0, "Standard": -2.0, "Bad": -3.0}, LABELS)
    scorer = ModelScorer.load(spark, load, prior=store.load_prior(spark, root, "sft", labels=LABELS))
    assert scorer.prior["Bad"] == -3.0


def test_audit_rows(spark, tmp_path):
    import hashlib

    root, df = str(tmp_path / "store"), train(spark)
    store.save_scorer(CountScorer.fit(df), root, "credit", "v1")
    row = store.load_scorer(spark, root, "credit").audit(df, "question", ("id",)).filter("id = 1").first()
    assert row["input_sha256"] == hashlib.sha256(b"a a b").hexdigest() and row["version"] == "v1" and set(row["prior"]) == set(LABELS)
    assert "question" not in row.asDict()


# --- grouped scoring -------------------------------------------------------------------------

class Counting:
    """Counts what it is asked for, in a file: padded tokens and prefixes."""

    path = None

    def tokenize(self, texts):
        return [t.split(" ") if t else [] for t in texts]

    def prefix(self, batch):
        with open(self.path, "a") as f:
            f.write(f"{len(batch)} {len(batch) * max(map(len, batch))} {sum(map(len, batch))}\n")
        return [len(ids) for ids in batch]

    def continue_(self, state, ids):
        return [-p * len(ids) / 8 for p in state]


def test_a_prompt_is_evaluated_once_in_batches_of_equal_length(spark, tmp_path):
    path = str(tmp_path / "asked")

    def make():
        model = Counting()
        model.path = path
        return model

    rng = random.Random(4)
    rows = [(i, "x " * rng.choice([0, 1, 2, 3, 200])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, prompt string").coalesce(1)
    cells = [{"label": lab, "variant": v, "candidate": lead + lab} for lab in LABELS for v, lead in enumerate(("", " a "))] + [{"label": "none", "variant": 0, "candidate": ""}]
    got = {(r["id"], r["label"], r["variant"]): (r["score"], r["n_tokens"]) for r in I.score_grouped(df, make, cells, token_budget=1000).collect()}
    for i, t in rows:
        n = len(t.split(" ")) if t else 0
        assert got[i, "Good", 0] == (-n / 8, 1) and got[i, "Good", 1] == (-n / 8, 3) and got[i, "none", 0] == (None, 0)
    asked = [tuple(map(int, line.split())) for line in open(path)]
    assert sum(n for n, _, _ in asked) == 500  # one prefix for each prompt, not one for each candidate
    assert max(padded for _, padded, _ in asked) <= 1000 and sum(p for _, p, _ in asked) < 1.1 * sum(r for _, _, r in asked)


def test_batches_keep_to_the_budget():
    lengths = [5, 1, 9, 9, 1, 30, 2]
    batches = list(I.budgeted(lengths, 18, 3))
    assert sorted(i for b in batches for i in b) == list(range(7))
    assert all(len(b) == 1 or len(b) * max(lengths[i] for i in b) <= 18 for b in batches) and max(map(len, batches)) <= 3
    assert list(I.budgeted([], 5, 5)) == []


# --- fixed steps -----------------------------------------------------------------------------

def test_steps_against_plain_gradients(spark):
    rng = random.Random(7)
    words = {"Good": "alpha beta", "Standard": "gamma delta", "Bad": "epsilon zeta"}
    rows = [(i, " ".join(rng.choice((words[lab] + " the of").split()) for _ in range(rng.randint(0, 9))), lab) for i in range(200) for lab in [LABELS[i % 3]]]
    rows += [(900, "alpha", "unknown"), (901, None, "Good")]
    df = spark.createDataFrame(rows, "id long, question string, teacher_label string")
    student, held = steps.fit_steps(df, rounds=4, n_features=64, rate=2.0, penalty=0.01)
    test = {r["id"] for r in held.collect()}
    assert len(test) == math.ceil(201 * 0.2) and 900 not in test
    import hashlib

    feature = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % 64
    x, y = [], []
    for i, t, lab in rows:
        if lab in LABELS and i not in test:
            v = np.zeros(64)
            for w in (t or "").split():
                v[feature(w)] += 1 / len(t.split())
            x.append(v)
            y.append(LABELS.index(lab))
    x, y, w, b = np.array(x), np.array(y), np.zeros((64, 3)), np.zeros(3)
    for _ in range(4):
        z = x @ w + b
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        w, b = w - 2.0 * (x.T @ p / len(y) + 0.01 * w), b - 2.0 * p.mean(axis=0)
    assert student.weights == pytest.approx(np.vstack([w, b]), abs=1e-12)
    assert student.frame(spark).filter("feature = -1").count() == 3
    predicted = {r["id"]: r["prediction"] for r in student.predict(df).collect()}
    assert len(predicted) == 202 and predicted[900] == "Good"


def test_steps_learn_the_teacher(spark):
    words = F.when(F.col("id") % 3 == 0, "alpha beta").when(F.col("id") % 3 == 1, "gamma delta").otherwise("epsilon zeta")
    teacher = F.when(F.col("id") % 3 == 0, "Good").when(F.col("id") % 3 == 1, "Standard").otherwise("Bad")
    df = spark.range(150).select("id", words.alias("question"), teacher.alias("teacher_label"))
    student, held = steps.fit_steps(df, rounds=5)
    assert student.predict(held).filter("prediction = teacher_label").count() == held.count() == 30


# --- the large vocabulary --------------------------------------------------------------------

def test_shuffled_counts_give_the_same(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, LABELS[i % 3], " ".join(rng.choice("a b c d e f g h".split()) if rng.random() < 0.7 else f"w{rng.randint(0, 300)}" for _ in range(rng.randint(0, 30)))) for i in range(150)]
    df = spark.createDataFrame([*rows, (900, "Good", None)], "id long, answer string, question string")
    lm = C.fit_count_lm(df)
    plain = {r["id"]: r for r in C.count_lm_scores(df, lm, "question", ("id",)).collect()}
    monkeypatch.setattr(C.frequent, "__defaults__", (3,))
    stored = C.bucketed(lm, "bucketed_counts", 4)
    for counts in (lm, stored):
        got = {r["id"]: r for r in C.count_lm_scores(df, counts, "question", ("id",), broadcast_bytes=0).collect()}
        assert got.keys() == plain.keys() and all(got[i]["n_tokens"] == plain[i]["n_tokens"] for i in plain)
        assert all((got[i]["raw"] is None and plain[i]["raw"] is None) or got[i]["raw"] == pytest.approx(plain[i]["raw"]) for i in plain)
    long = C.token_scores(df.filter("question is not null"), lm, "question", "id", broadcast_bytes=0)
    short = C.token_scores(df.filter("question is not null"), lm, "question", "id")
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, short.collect()))


def test_bucketed_counts_are_not_moved(spark, tmp_path):
    df = train(spark)
    lm = C.bucketed(C.fit_count_lm(df), "unmoved_counts", 4)
    path = str(tmp_path / "corpus")
    df.write.parquet(path)
    rows = spark.read.parquet(path).select("id", F.col("question"))
    plan = C.count_lm_scores(rows, lm, "question", ("id",), broadcast_bytes=0)._jdf.queryExecution().executedPlan().toString()
    counts_side = plan[plan.index("SortMergeJoin"):]
    assert "Bucketed: true" in plan and plan.count(path) <= 2 and counts_side.count("Exchange hashpartitioning(key") == 1
