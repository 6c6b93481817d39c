import random
import re
from itertools import combinations

import numpy as np
import xxhash

from tutelage.llm import simhash
from tutelage.llm.components import components


def plain(text, width=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(words[k:k + width]) for k in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def grouped(items, near):
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(items, 2):
        if near(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


def test_positions_cover_every_choice():
    for shared in range(1, 9):
        chosen = simhash.covering(shared)
        assert all(any(set(c) <= set(k) for c in chosen) for k in combinations(range(8), shared))
    assert len(simhash.covering(4)) == 20


def test_fingerprints_and_components_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", "  \n", "one", "One two", "ONE two"]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(30, 300))]
        for _ in range(4):
            other = list(base)
            for _ in range(rng.randint(0, 2)):
                other[rng.randrange(len(other))] = rng.choice(words)
            texts.append(" ".join(other) + rng.choice(["", "é x"]))
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(3, texts[3], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = {(r["doc_id"]): (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    marks = {i: plain(t) for i, t in enumerate(texts)}
    want = grouped(list(marks), lambda a, b: bin(marks[a] ^ marks[b]).count("1") <= 4)
    assert got == {i: (f"{marks[i]:016x}", want[i]) for i in marks}
    assert simhash.near_duplicates(docs).count() == len(rows)


def test_heavy_lists_are_cut_and_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base, nodes = rng.integers(0, 1 << 63, 3), []
    for b in base:
        for _ in range(120):
            nodes.append(int(b) ^ sum(1 << int(k) for k in set(rng.integers(0, 63, rng.integers(0, 3)))))
    nodes = sorted(set(nodes))
    frame = spark.createDataFrame([(n, n) for n in nodes], "node long, l0 long")
    want = grouped(nodes, lambda a, b: bin(a ^ b).count("1") <= 4)
    for heavy, known in ((1024, 50_000), (16, 50_000), (16, 0)):
        monkeypatch.setattr(simhash, "HEAVY", heavy)
        monkeypatch.setattr(simhash, "HEAVY_BROADCAST", known)
        links = simhash.near_links(frame, 4)
        got = {r["node"]: r["root"] for r in components(links).collect()}
        assert {n: got.get(n, n) for n in nodes} == want
        assert links.count() < 25 * len(nodes) * (1 if heavy > 16 else 20)


def test_components_of_chains_and_hubs(spark):
    rows = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 160)}


def test_representatives_keep_one_of_each_group(spark):
    rng = random.Random(1)
    base = [f"word{rng.randint(0, 5000)}" for _ in range(300)]
    near = list(base)
    near[150] = "other"
    texts = [" ".join(base), " ".join(base).upper(), " ".join(near), " ".join(f"x{rng.randint(0, 5000)}" for _ in range(300)), None, ""]
    rows = [(10 - i, t, i) for i, t in enumerate(texts)] + [(7, texts[3], 3), (None, " ".join(base), 9), (None, "alone here", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, least int")
    out = simhash.representatives(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["least"]) for r in out.collect()) == [(-1, 11), (5, 5), (7, 3), (8, 2)]
    assert simhash.representatives(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_a_repeated_line_links_no_clean_documents(spark):
    rng = random.Random(8)
    line = [f"line{i}" for i in range(14)]
    texts = [" ".join(line * 40 + [f"own{rng.randint(0, 10 ** 6)}" for _ in range(600)]) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert simhash.representatives(docs).count() == 12


def test_representatives_are_decided_by_exact_similarity(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(304)]  # 300 shingles
    texts = [" ".join([*base[:-k], *[f"{k}x{i}" for i in range(k)]]) if k else " ".join(base) for k in (0, 33, 34)]  # 267 / 333 = 0.802, 266 / 334 = 0.796
    sets = [simhash.shingles(t.encode(), 5) for t in texts]
    assert simhash.similarity(sets[0], sets[1]) >= 0.8 > simhash.similarity(sets[0], sets[2])
    pairs = spark.createDataFrame([(0, 1), (0, 2)], "a long, b long")
    rows = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "node long, text binary")
    assert [tuple(r) for r in simhash.similar(pairs, simhash.shingle_sets(rows, 5), 0.8).collect()] == [(0, 1)]
    group = [list(base) for _ in range(40)]
    for k, words in enumerate(group):
        words[7 * k] = f"other{k}"
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(group)] + [(99, texts[2])], "doc_id long, text string")
    for known in (200_000, 0):
        monkeypatch.setattr(simhash, "TEXTS_BROADCAST", known)
        assert sorted(r["doc_id"] for r in simhash.representatives(docs).collect()) == [0, 99]


def test_pairs_just_above_the_bound_are_all_found(spark):
    rng = random.Random(10)
    rows = []
    for n in range(60):
        base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(304)]
        other = [*base[:-33], *[f"x{rng.randint(0, 10 ** 6)}" for _ in range(33)]]  # 267 / 333 = 0.802
        rows += [(2 * n, " ".join(base)), (2 * n + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.representatives(docs).collect()) == list(range(0, 120, 2))


def test_prefixes_of_similar_sets_meet_under_any_sketch():
    rng = np.random.default_rng(11)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.r_[a[rng.random(len(a)) < 0.93], rng.integers(0, 1 << 63, int(rng.integers(0, 4)), dtype=np.uint64)])
        sketch = rng.integers(0, 50, 64).astype(np.int32)
        both = len(np.intersect1d(a, b))
        if len(b) and both / (len(a) + len(b) - both) >= 0.8:
            p, q = simhash.prefix(a, sketch, 0.8), simhash.prefix(b, sketch, 0.8)
            met = [(i, j) for i, h in enumerate(p) for j, k in enumerate(q) if h == k]
            assert met and any(simhash._possible(np.array([len(a), len(b)]), np.array([i, j]), 0, np.array([1]), 0.8)[0] for i, j in met)


def test_sketch_counts_texts(spark):
    texts = ["a b c d e f", "a b c d e f", "b c d e f", None, "", "a b c d e f a b c d e f"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    sketch = simhash.frequencies(docs, 5)
    at = lambda t: sketch[int(simhash.hashes(t, 5)[0]) & simhash.COUNTERS - 1]
    assert at(b"a b c d e") == 3 and at(b"b c d e f") == 4 and sketch.sum() == 2 + 2 + 1 + 6


def asked(monkeypatch):
    """Pairs handed to the exact count."""
    seen, plain_similar = [], simhash.similar

    def similar(pairs, sets, least):
        seen.extend(tuple(sorted(r)) for r in pairs.collect())
        return plain_similar(pairs, sets, least)

    monkeypatch.setattr(simhash, "similar", similar)
    return seen


def test_texts_that_share_a_block_are_not_verified_in_pairs(spark, monkeypatch):
    """300 common and 100 own words each, a similarity of 0.6: all pairs of them would be 79,800."""
    seen, rng = asked(monkeypatch), random.Random(12)
    block = " ".join(f"c{i}" for i in range(300))
    docs = spark.createDataFrame([(k, f"{block} " + " ".join(f"o{rng.randint(0, 10 ** 7)}" for _ in range(100))) for k in range(400)], "doc_id long, text string")
    assert simhash.representatives(docs).count() == 400 and len(seen) < 4000


def test_no_pair_is_verified_twice(spark, monkeypatch):
    """A group in which neighbours are alike and others are not, in lists long enough for rounds."""
    seen, words = asked(monkeypatch), [f"w{i}" for i in range(800)]
    rows = [(k, " ".join(words[8 * k:8 * k + 200])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash, "SMALL", 2)
    kept = sorted(r["doc_id"] for r in simhash.representatives(docs).collect())
    sets = {k: simhash.shingles(t.encode(), 5) for k, t in rows}
    want = grouped(list(sets), lambda a, b: simhash.similarity(sets[a], sets[b]) >= 0.8)
    assert kept == sorted(set(want.values())) and len(seen) == len(set(seen))


def test_representatives_against_brute_force(spark):
    rng = random.Random(13)
    line, texts = " ".join(f"line{i}" for i in range(30)), ["", None, "one", "one two three", "ONE two three", "one two three four five six"]
    for _ in range(30):
        base = [rng.choice("abcdefghij") + str(rng.randint(0, 300)) for _ in range(rng.randint(5, 150))]
        for _ in range(4):
            other = list(base)
            for _ in range(rng.choice([0, 1, 2, 5, 20])):
                other[rng.randrange(len(other))] = f"n{rng.randint(0, 99)}"
            texts.append(" ".join(other) + rng.choice(["", f" {line}", " more"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {k: simhash.shingles((t or "").lower().encode(), 5) for k, t in enumerate(texts)}
    want = grouped(list(sets), lambda a, b: simhash.similarity(sets[a], sets[b]) >= 0.8)
    assert sorted(r["doc_id"] for r in simhash.representatives(docs).collect()) == sorted(set(want.values()))


def test_representatives_take_the_index_first(spark, monkeypatch):
    """Near copies come out of the fingerprint index, decided by their texts; pairs that it leaves apart come from the lists."""
    rng = random.Random(12)
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(600)]
    close, far = [*base[:-1], "other"], [*base[:-60], *[f"x{rng.randint(0, 10 ** 6)}" for _ in range(60)]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate((base, close, far, [f"y{i}" for i in range(600)]))], "doc_id long, text string")
    seen, verified = [], simhash.verified_links

    def watched(lists, verify, least, indexed):
        seen.extend(tuple(r) for r in indexed.distinct().collect())
        return verified(lists, verify, least, indexed)

    monkeypatch.setattr(simhash, "verified_links", watched)
    assert sorted(r["doc_id"] for r in simhash.representatives(docs).collect()) == [0, 3]
    marks = {r["_node"]: r["doc_id"] for r in simhash.distinct_marks(docs, 5, 4, ("doc_id",), simhash.frequencies(docs.select("text"), 5), 0.8).collect()}
    assert {frozenset(marks[x] for x in pair) for pair in seen} == {frozenset((0, 1))}
    monkeypatch.setattr(simhash, "near_pairs", lambda lists, *a: spark.createDataFrame([], "key long, pair long, a long, b long"))
    assert sorted(r["doc_id"] for r in simhash.representatives(docs).collect()) == [0, 2, 3]
