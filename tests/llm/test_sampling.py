import hashlib
import random

import numpy as np

from tutelage.llm import sampling as S


def weighted(text):
    return dict(zip(*S.terms(text.encode()), strict=True))


def jaccard(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / max(1e-9, sum(max(a.get(k, 0), b.get(k, 0)) for k in keys))


def text(rng, n):
    return " ".join(f"w{rng.randint(0, 60)}" for _ in range(n))


def test_word_hashes_ignore_place_case_and_white_space(monkeypatch):
    whole = "Alpha beta \t\ngamma  ALPHA é" + " x" * 50
    a = S.word_hashes(whole.encode())
    assert a[0] == a[3] and len(set(a[:5].tolist())) == 4 and (a[5:] == a[5]).all()
    monkeypatch.setattr(S, "BYTES", 16)
    assert (S.word_hashes(whole.encode()) == a).all()
    assert len(S.word_hashes(b"y" * 40 + b" z")) == 2
    assert len(S.word_hashes(b" \n")) == 0


def test_collision_rate_is_generalised_jaccard():
    rng, errors = random.Random(4), []
    for _ in range(150):
        a = np.array([rng.randint(1, 1 << 62) for _ in range(60)], np.uint64)
        shared = rng.randint(0, 60)
        b = np.concatenate([a[:shared], np.array([rng.randint(1, 1 << 62) for _ in range(60 - shared)], np.uint64)])
        wa, wb = (np.array([rng.choice([1, 1, 2, 3, 7]) for _ in range(60)], np.float32) for _ in range(2))
        j = jaccard(dict(zip(a.tolist(), wa, strict=True)), dict(zip(b.tolist(), wb, strict=True)))
        errors.append(S.likeness(S.signature(a, wa), S.signature(b, wb)) - j)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.09


def test_edits_against_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "a", "  ", "é" * 7, *[text(rng, rng.randint(1, 80)) for _ in range(40)]]
    docs = spark.createDataFrame([(3 * i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _range string").repartition(5)
    rows = {r["doc_id"]: r for r in S.edits(docs).collect()}
    order = sorted(range(len(texts)), reverse=True)
    for k, i in enumerate(order):
        own, following = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        half = len(own) // 2
        changed = own[:len(own) - half] + following[:half]
        r = rows[3 * i]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = (S.signature(*S.terms(t.encode())) for t in (own, changed, following))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (a.tobytes().hex(), b.tobytes().hex())
        assert r["near_edited"] == S.likeness(a, b) and r["near_next"] == S.likeness(a, c)
    assert len(rows) == len(texts)
    plain = {r["doc_id"]: r["fingerprint"] for r in S.fingerprints(docs).collect()}
    assert plain == {k: r["fingerprint"] for k, r in rows.items()}


def test_edges(spark):
    one = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    r = S.edits(one).first()
    assert r["near_next"] == 1.0 and r["n_chars"] == 11
    assert S.edits(one.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "z"), (None, None)], "doc_id long, text string")
    rows = S.edits(same).collect()
    assert len(rows) == 4 and len({r["fingerprint"] for r in rows if r["doc_id"] == 1}) == 1


def test_likeness_has_no_step_in_length():
    rng, near = random.Random(5), []
    for n in range(18, 30):
        words = [f"v{rng.randint(0, 10 ** 6)}" for _ in range(n + 1)]
        shorter, longer = " ".join(words[:-1]), " ".join(words)
        assert jaccard(weighted(shorter), weighted(longer)) > 0.9
        near.append(S.likeness(*[S.signature(*S.terms(t.encode())) for t in (shorter, longer)]))
    assert min(near) > 0.8


def test_words_are_drawn_by_their_weight():
    rng, errors = random.Random(6), []
    for _ in range(150):
        words = [f"u{rng.randint(0, 10 ** 6)}" for _ in range(30)]
        at = rng.randint(0, 29)
        a, b = " ".join(words), " ".join([*words[:at], *sorted(words[at:])])
        errors.append(S.likeness(*[S.signature(*S.terms(t.encode())) for t in (a, b)]) - jaccard(weighted(a), weighted(b)))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.09
