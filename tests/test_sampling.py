import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tutelage.functions.templates import few_shot_prompt
from tutelage.operators import sampling as S


def key(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


def brute(rows, n, seed):
    out = set()
    for label in {a for _, a in rows}:
        ids = sorted((key(seed, i), i) for i, a in rows if a == label)
        out |= {i for _, i in ids[: n[label] if isinstance(n, dict) else n]}
    return out


# A class that holds most of the rows, and two small ones.
ROWS = [(i, "Good" if i % 9 else ("Standard" if i % 2 else "Bad")) for i in range(3000)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id long, answer string").withColumn("question", F.concat(F.lit("q"), "id"))


def ids(d):
    return sorted(r["id"] for r in d.select("id").collect())


def test_balance_is_exact(df):
    n = min(Counter(a for _, a in ROWS).values())
    assert ids(S.balance(df)) == sorted(brute(ROWS, n, 7))
    assert ids(S.balance(df, per_class=5, seed=3)) == sorted(brute(ROWS, 5, 3))


@pytest.mark.parametrize("prefix", [1, 2, 5])
def test_slice_width_does_not_matter(df, prefix):
    got = S.lowest(df, lambda sizes: {"Good": 700, "Bad": 1, "Standard": 10**9}, 7, "answer", prefix=prefix)
    assert ids(got) == sorted(brute(ROWS, {"Good": 700, "Bad": 1, "Standard": 10**9}, 7))


def test_sample_needs_no_shuffle(df):
    plan = S.balance(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_balance_errors(spark, df):
    with pytest.raises(ValueError, match="no example for Bad"):
        S.balance(df.filter("answer <> 'Bad'"))
    with pytest.raises(ValueError, match="fewer than 2000"):
        S.balance(df, per_class=2000)


def test_labels_are_stripped_and_unknown_ones_dropped(spark):
    d = spark.createDataFrame([(1, " Good\n"), (2, "good"), (3, " Bad"), (4, None), (5, "Standard")], "id long, answer string")
    assert {(r["id"], r["answer"]) for r in S.valid_labels(d).collect()} == {(1, "Good"), (3, "Bad"), (5, "Standard")}


def test_balanced_val(df):
    sizes = Counter(a for _, a in ROWS)
    n = min(max(1, max(1, int(3000 * 0.1)) // 3), min(sizes.values()))
    assert ids(S.balanced_val(df)) == sorted(brute(ROWS, n, 7))
    assert ids(S.balanced_val(df, per_class=10**6)) == sorted(brute(ROWS, min(sizes.values()), 7))
    assert ids(S.balanced_val(df.filter("answer <> 'Bad'"))) == []
    few = df.filter("id < 20")
    assert Counter(r["answer"] for r in S.balanced_val(few, frac=0.0001).collect()) == {"Good": 1, "Standard": 1, "Bad": 1}


def test_excluded_rows_stay_out(df):
    train = S.balance(df, per_class=20)
    val = S.balanced_val(df, per_class=20, exclude=train)
    assert not set(ids(train)) & set(ids(val)) and val.count() == 60


def test_stratified_and_remainder(df):
    sample = S.stratified_n(df, 50)
    assert ids(sample) == sorted(brute(ROWS, 50, 42))
    assert sorted(ids(sample) + ids(S.remainder(df, sample))) == list(range(3000))
    with pytest.raises(ValueError):
        S.stratified_n(df, 1000)


def test_split_sizes(df):
    for frac, n in ((0.1, 300), (0.2, 600), (0.0003, 1), (1.0, 3000)):
        train, test = S.train_test_split(df, frac)
        assert (train.count(), test.count()) == (3000 - n, n)
    want = sorted(i for _, i in sorted((key(42, i), i) for i in range(3000))[:300])
    assert ids(S.train_test_split(df, 0.1)[1]) == want


def test_shuffle_rank(df):
    want = [i for _, i in sorted((key(7, i), i) for i in range(3000))]
    got = {r["rank"]: r["id"] for r in S.shuffle_rank(df, 7).collect()}
    assert [got[k] for k in range(1, 3001)] == want
    assert [r["id"] for r in S.shuffle(df, 7).collect()] == want


def test_distribution(spark, df):
    assert {r["label"]: r["n"] for r in S.class_distribution(df.filter("answer <> 'Bad'")).collect()}["Bad"] == 0
    assert {r["label"]: r["n"] for r in S.class_distribution(df, labels=None).collect()} == Counter(a for _, a in ROWS)


def test_head(df):
    assert ids(S.head_n(df, 3)) == [0, 1, 2] and S.head_n(df, 0).count() == 3000


def test_few_shot(df):
    picked = S.few_shot_sample(df)
    assert ids(picked) == sorted(brute(ROWS, 2, 42))
    text = few_shot_prompt(picked).first()["system_prompt"]
    labels = [line.split('"label": "')[1].split('"')[0] for line in text.splitlines() if "Brief reasoning" in line]
    assert labels == ["Good", "Good", "Bad", "Bad", "Standard", "Standard"]
    with pytest.raises(ValueError, match="Standard"):
        S.few_shot_sample(df.filter("answer <> 'Standard'"))


def test_small_classes_need_one_scan(spark, tmp_path, monkeypatch):
    """Counts and cut-offs come from one look at the rows; only a cut inside a fuller slice needs another."""
    path, rows = str(tmp_path / "rows"), [(i, "Good" if i % 3 else "Bad") for i in range(900)]
    spark.createDataFrame(rows, "id long, answer string").write.parquet(path)
    df, asked = spark.read.parquet(path), []
    plain = S._keyed

    def keyed(*args):
        out = plain(*args)
        watched = out.filter
        asked.append(out)
        out.filter = lambda *a: (asked.append("again"), watched(*a))[1]
        return out

    monkeypatch.setattr(S, "_keyed", keyed)
    got = S.lowest(df, lambda sizes: {"Good": 70, "Bad": 30}, 7, "answer")
    assert ids(got) == sorted(brute(rows, {"Good": 70, "Bad": 30}, 7)) and "again" not in asked
    asked.clear()
    got = S.lowest(df, lambda sizes: {"Good": 300, "Bad": 100}, 7, "answer", prefix=1)
    assert ids(got) == sorted(brute(rows, {"Good": 300, "Bad": 100}, 7)) and "again" in asked
    assert ids(S.lowest_n(df, 40, 7, "answer")) == ids(S.lowest_n(df, 40, 7, "answer", prefix=1)) == sorted(brute(rows, 40, 7))
    assert ids(S.lowest_n(df, 10**6, 7, "answer")) == list(range(900))
