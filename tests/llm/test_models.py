"""Quality and toxicity: held-out accuracy, brute-force densities, edge cases."""

import random
import zlib
import zlib

import numpy as np

from tutelage.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


def split(rows, label):
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    return [(r["score"], r["predicted"], label[r["doc_id"]]) for r in held if r["doc_id"] in label]


def auc(pairs):
    ranks = np.argsort(np.argsort([p[0] for p in pairs]))
    y = np.array([p[2] == 1 for p in pairs])
    return (ranks[y].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (~y).sum())


def test_held_out_accuracy(spark):
    from tutelage.llm.queries import QUERIES

    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    pairs = split(QUERIES["op4_quality_classifier"](spark, SF).collect(), {k: r["quality"] for k, r in labels.items()})
    assert auc(pairs) > 0.99 and sum(p[1] == p[2] for p in pairs) > 0.98 * len(pairs)
    pairs = split(QUERIES["op8_toxicity"](spark, SF).collect(), {k: r["toxic"] for k, r in labels.items()})
    clean = [p for p in pairs if p[2] == 0]
    assert auc(pairs) > 0.93 and sum(p[1] for p in clean) < 0.01 * len(clean)


def test_discriminant_against_plain_densities():
    rng = np.random.default_rng(1)
    p = len(quality.NAMES)
    x = {0: rng.normal(1, 2, (400, p)), 1: rng.normal(0, 1, (900, p))}
    model = quality.Discriminant.of({k: (float(len(v)), v.sum(axis=0), v.T @ v) for k, v in x.items()})
    points = rng.normal(0.5, 1.5, (50, p))
    z = (points - model.centre) / model.scale
    logs = []
    for mean, inverse, logdet, prior in model.parts:
        cov = np.linalg.inv(inverse.T @ inverse)
        d = z - mean
        assert np.isclose(logdet, np.linalg.slogdet(cov)[1])
        logs.append(prior - 0.5 * (np.linalg.slogdet(cov)[1] + np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)))
    assert np.allclose(model.score(points), 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -30, 30))))
    both = np.concatenate([model.score(x[0]) < 0.5, model.score(x[1]) >= 0.5])
    assert both.mean() > 0.95


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 2.0), (2, "", 2.0), (3, "Some words here.", 1.0), (3, "Some words here.", 1.0), (None, "x", 0.0)], "doc_id long, text string, x double")
    labels = spark.createDataFrame([(3, 1), (3, None), (None, 0)], "doc_id long, quality int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 5 and all(r["score"] == 0.5 for r in rows)
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert len(quality.statistics(b"")) == len(quality.NAMES) == len(quality.statistics("é\n\n!".encode()))


def test_misspellings_share_n_grams():
    rng = random.Random(2)
    plain = [f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("nt", "rs", "l") for c in ("a", "o", "en")]
    texts, y = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(40)]
        if i % 4 == 0:
            words[rng.randrange(40)] = rng.choice(["scumbag", "worthless"])
        texts.append(" ".join(words).encode())
        y.append(int(i % 4 == 0))
    model = toxicity.train_texts(texts, np.array(y))
    clean = " ".join(plain).encode()
    assert model.score(clean) < 0.5 < min(model.score(clean + b" " + w) for w in (b"scumbag", b"SCUMBAGS!", b"w0rthless"))


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (4, "words", "c"), (4, "words", "c")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(2, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 4 and all(r["score"] == 0.5 for r in rows)
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.score(docs, model, keep=("doc_id", "score"), out="t").columns == ["doc_id", "score", "t"]


def test_rare_subwords_share_no_row_with_clean_ones():
    rng = random.Random(6)
    vocabulary = [f"{''.join(rng.choice('abcdefghijklmnopqrstuvwxyz') for _ in range(9))}" for _ in range(30_000)]
    grams = lambda w: {f"<{w}>"[i:i + n] for n in (3, 4, 5) for i in range(len(w) + 3 - n)}
    known = set().union(*map(grams, vocabulary))
    new = {g for a in ("qzjk", "vkqj", "zzqx") for b in ("wvqk", "jjzq", "kxvz") for g in grams(f"{a}x{b}")} - known
    row = lambda g: zlib.crc32(g.encode()) & (toxicity.BUCKETS - 1)
    taken = set(map(row, known))
    assert len(new) > 30 and sum(row(g) in taken for g in new) < 0.25 * len(new)  # with 2^18 rows over half are taken


def test_contrast_is_chosen_on_folds():
    rng = random.Random(7)
    texts, y = [], []
    for i in range(1200):
        words = [f"plain{rng.randrange(300)}" for _ in range(30)]
        if i % 4 == 0:
            words[rng.randrange(30)] = f"{'abcdefghijklmnopqrst'[rng.randrange(20)] * 4}vile"[:rng.choice([4, 8])]
        texts.append(" ".join(words).encode())
        y.append(int(i % 4 == 0))
    labels, folds = np.array(y), np.array([toxicity.fold(t) for t in texts])
    found = toxicity.held(texts, labels)
    keys, many = np.array(list(found)), np.zeros((toxicity.FOLDS, 2), np.int64)
    np.add.at(many, (folds, labels), 1)
    sets = toxicity.candidates(*toxicity.table_of(*keys.T, np.array(list(found.values()))), many)
    assert set(sets) == {(f, c) for f in (-1, 0, 1, 2) for c in toxicity.CONTRASTS}
    model = toxicity.train_texts(texts, labels)
    assert set(model.weight) in [set(sets[-1, c].tolist()) for c in toxicity.CONTRASTS]


def test_scores_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(12)
    rows = []
    for i in range(500):
        words = [f"plain{rng.randrange(200)}" for _ in range(20)] + [rng.choice(["scumbag", "w0rthless", "vile"])] * (i % 3 == 0)
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    scores = []
    for order in (rows, rows[::-1], rng.sample(rows, len(rows))):
        docs = spark.createDataFrame([r[:2] for r in order], "doc_id long, text string").repartition(3)
        labels = spark.createDataFrame([(r[0], r[2]) for r in order], "doc_id long, toxic int")
        scores.append({r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()})
    assert scores[0] == scores[1] == scores[2] and max(scores[0].values()) > 0.7 > 0.3 > min(scores[0].values())


def test_words_met_long_ago_are_let_go(monkeypatch):
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 20)
    weight = {row: 0.5 for w in (b"often", b"w7", b"w199") for row in toxicity.subwords(w)}
    texts = [b"often w%d x%d" % (i, i) for i in range(200)] + [b"often w7", b""]
    model = toxicity.Model(weight, 0.1)
    assert [model.score(t) for t in texts] == [toxicity.Model(weight, 0.1).score(t) for t in texts]
    assert b"often" in model.known | model.before and len(model.known) + len(model.before) < 50


def test_the_driver_gets_only_rows_that_can_be_trained(spark, monkeypatch):
    seen = []
    plain = toxicity.candidates
    monkeypatch.setattr(toxicity, "candidates", lambda rows, counts, many: seen.append((rows, counts)) or plain(rows, counts, many))
    texts = [f"{'vile rotten' if i % 2 else 'kind gentle'} once{i}x{i * i}" for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    got = toxicity.fit(docs, labels)
    used = [i for i in range(120) if zlib.crc32(str(i).encode()) % 3 != 1]
    want = toxicity.train_texts(sorted((texts[i].encode() for i in used), key=lambda t: b"vile" in t), np.array(sorted(i % 2 for i in used)))
    assert set(got.weight) == set(want.weight) and len(got.weight) > 0
    (rows, counts), all_rows = seen[0], {r for i in used for r in toxicity.bag(texts[i].encode())}
    assert counts.sum(axis=(0, 1)).min() >= toxicity.LEAST_HELD and len(rows) < len(all_rows) and (np.diff(rows) > 0).all()
