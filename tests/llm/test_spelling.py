"""Spelling variants: brute force over all pairs, signatures, edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from tests.oracle import compare, connect
from tutelage.llm import spelling
from tutelage.llm.queries import ORACLE, QUERIES

UPPER = str.maketrans(spelling.UPPER, spelling.LOWER)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(docs, every=199, least_chars=6, least_count=5):
    count = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    n = {w: c for w, c in count.items() if len(w) >= least_chars and c >= least_count}
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o.encode()), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def got(spark, docs, **kw):
    return sorted(map(tuple, spelling.group(spark.createDataFrame(docs, "doc_id long, text string, word string, n int, sig int"), **kw).collect()))


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), sf, QUERIES["op13_spelling_variants"], ORACLE["op13_spelling_variants"]) is None


def test_variants_against_brute_force(spark):
    rng = random.Random(2)
    bases = ["".join(rng.choice("abcdeßé") for _ in range(rng.randint(5, 9))) for _ in range(12)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "banana", "bananas"]
    words = ["kettenb"] * 400 + ["kettenbe"] * 31 + ["kettenbee"] * 6  # a form of a form
    for k, w in enumerate(bases):
        words += [w] * (6 * 5 ** (k % 4))
        for _ in range(6):
            at, c = rng.randrange(len(w)), rng.choice("abcdeßéÉ")
            words += [rng.choice([w[:at] + c + w[at + 1:], w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + c + w[at + 2:]])] * rng.choice([4, 5, 6, 26])
    rng.shuffle(words)
    docs = [(i if i % 7 else None, rng.choice([" ", "-", "1", "×. "]).join(w.upper() if rng.random() < 0.3 and w.isascii() else w for w in words[i * 40:i * 40 + 40])) for i in range(len(words) // 40 + 1)]
    expected = brute(docs, every=7)
    assert got(spark, [(*d, "", 0, 0) for d in docs], every=7) == expected
    assert sum(r[1] is not None for r in expected) > 10 and any(r[2] != r[1] and r[1] for r in expected) and max(r[4] for r in expected) > 3


def test_every_pair_at_one_edit_shares_a_signature():
    rng = random.Random(3)
    place = {c: i for i, c in enumerate("etaonx")}

    def signatures(w):
        roles, sigs = spelling.signatures_of(np.array([spelling.parts_held(w, place, spelling.PARTS, {})], np.uint64), np.array([len(w)]))
        return list(zip(roles.tolist(), sigs[0].tolist()))

    for _ in range(300):
        w = "".join(rng.choice("etaonxzß") for _ in range(rng.randint(1, 12)))
        at, c = rng.randrange(len(w)), rng.choice("etaonxq")
        same, longer = w[:at] + c + w[at + 1:], w[:at] + c + w[at:]
        assert {s for r, s in signatures(w) if r == 0} & {s for r, s in signatures(same) if r == 0}
        assert {s for r, s in signatures(w) if r == 1} & {s for r, s in signatures(longer) if r == 2}
    assert len(signatures("banana")) == 27


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(23)] + [("x", "w22")]
    ends = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert len(ends) == 24 and set(ends.values()) == {"w23"}


def test_empty_null_long_and_repeated(spark):
    assert got(spark, []) == [] and got(spark, [(1, None, "", 0, 0), (None, "", "", 0, 0), (2, "12 ab", "", 0, 0)]) == []
    long = "ab" * 50_000
    rows = [(i, f"{long} {long}c", "", 0, 0) for i in range(5)] + [(7, "Straße " * 3, "", 0, 0)] * 2
    assert got(spark, rows, every=10**12) == [(long, None, long, 5, 1, None), (f"{long}c", None, f"{long}c", 5, 1, None), ("straße", None, "straße", 6, 0, None)]


def test_words_are_never_broadcast(spark, monkeypatch):
    plans, write = [], spelling.materialise

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(spelling, "materialise", seen)
    docs = [(i, "kitten " * 6 + ("kitte" if i % 5 else "mitten") + " sitting sittinq") for i in range(10)]
    out = spelling.group(spark.createDataFrame(docs, "doc_id long, text string"), least_count=1)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)  # tables as small as these, and files that Spark sizes too low
    assert {r["word"]: r["root"] for r in out.collect()}["mitten"] == "kitten"
