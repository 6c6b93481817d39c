"""Embedding near-dedup and centroid clustering: brute force, bounds, edge cases."""

import hashlib
from itertools import combinations

import numpy as np
import pytest

from tests.oracle import compare, connect
from tutelage.llm import centroids, cosine
from tutelage.llm.queries import ORACLE, QUERIES

ROWS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("name", ["op11_cosine_near_dedup", "op12_ns_bounds_clustering"])
def test_queries_against_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), sf, QUERIES[name], ORACLE[name]) is None


def cos(x, y):
    if len(x) != len(y):
        return 0.0
    x, y = np.array(x, np.float64), np.array(y, np.float64)
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return float(x @ y / np.sqrt((x @ x) * (y @ y)))


def fine(v):
    return bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)


def brute(rows, least=0.9):
    near = [(a, b) for a, b in combinations(range(len(rows)), 2) if fine(rows[a][1]) and fine(rows[b][1]) and cos(rows[a][1], rows[b][1]) >= least]
    root, n = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in near:
        n[a] += 1
        n[b] += 1
        root[max(find(a), find(b))] = min(find(a), find(b))
    least_id = {}
    for i, (k, _) in enumerate(rows):
        least_id.setdefault(find(i), []).append(k)
    return sorted((k, n[i], min(least_id[find(i)]), k == min(least_id[find(i)])) for i, (k, _) in enumerate(rows))


def groups(rng, dim, many=40):
    rows = []
    for _ in range(many):
        base = rng.normal(0, 1, dim)
        for spread in (0.0, 0.02, 0.2, 0.4, 0.45, 0.5, 0.9):
            rows.append((base + rng.normal(0, 1, dim) * spread).astype(np.float32).tolist())
    return rows


def test_near_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = groups(rng, 64) + groups(rng, 20, 6) + [[1e30] * 64, [1e-30] * 64, [-1.0] * 64]
    vectors += [vectors[7]] * 9 + [(np.array(vectors[3]) * 4).tolist()]  # copies, and one of another length
    rows = [(i, v) for i, v in enumerate(rng.permutation(np.array(vectors, dtype=object)).tolist())]
    bad = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63]
    rows += [(1000 + i, v) for i, v in enumerate(bad)]
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], ROWS)
    expected = brute(rows)
    assert sorted(map(tuple, cosine.near(df).collect())) == expected and sum(r[1] for r in expected) > 200
    monkeypatch.setattr(cosine, "BLOCK_BYTES", 4096)  # many blocks, small steps, slices of pairs
    monkeypatch.setattr(cosine, "ROWS", 8)
    monkeypatch.setattr(cosine, "COLUMNS", 16)
    monkeypatch.setattr(cosine, "PAIRS", 5)
    assert sorted(map(tuple, cosine.near(df).collect())) == expected


def test_leading_coordinates_never_lose_a_pair():
    rng = np.random.default_rng(5)
    x = np.array(groups(rng, 64, 60), np.float64) * (1.0 / np.arange(1, 65))
    turn = cosine.rotation(cosine.unit(x))
    held = (cosine.unit(x) @ turn) ** 2
    assert (np.diff(held.sum(axis=0)) <= 1e-9).all()  # most variance first
    side = cosine.prepared(x, turn)
    found = {(int(a), int(b)) for i, j in cosine.tile_links(side, None, 0.9) for a, b in zip(i, j)}
    sim = cosine.unit(x) @ cosine.unit(x).T
    assert found == {(a, b) for a, b in combinations(range(len(x)), 2) if sim[a, b] >= 0.9}


def test_pairs_stop_early():
    """Of unrelated pairs almost none reaches the second step, and none the last."""
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (400, 64))
    side = cosine.prepared(x, cosine.rotation(cosine.unit(x)))
    first = (side[1][0] @ side[1][0].T >= 0.9 - cosine.SLACK)[np.triu_indices(400, 1)]
    i, j = np.triu_indices(400, 1)
    assert first.mean() < 0.05 and len(cosine._survivors(i[first], j[first], side[1], side[1], 0.9)[0]) == 0


def test_unite_gives_the_first_of_each_set():
    first = np.arange(10)
    cosine.unite(first, np.array([8, 2, 5, 9]), np.array([2, 1, 9, 3]))
    cosine.unite(first, np.array([1]), np.array([5]))
    assert first.tolist() == [0, 1, 1, 1, 4, 1, 6, 7, 1, 1]


def test_empty_clashing_and_null_ids(spark):
    assert cosine.near(spark.createDataFrame([], ROWS)).count() == 0
    names = "vec_id long, embedding array<double>, node long, h1 long, n_links long, component_id long, copies int, root int, dim int, low int, usable int"
    more = (0,) * 9
    df = spark.createDataFrame([(5, [1.0, 0.0], *more), (5, [1.0, 0.0], *more), (None, [1.0, 0.1], *more), (7, [0.0, 1.0], *more), (None, None, *more)], names)
    got = sorted(map(tuple, cosine.near(df).collect()), key=str)
    assert got == sorted([(5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, False), (7, 0, 7, True), (None, 0, None, True)], key=str)


# --- clustering ------------------------------------------------------------------------------

def lloyd(rows, k, rounds):
    kept = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if v is not None and len(v) == 64 and all(c is not None and np.isfinite(c) for c in v)]
    kept_first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1].tolist()))
    c = np.array([x for _, x in kept_first[:k]])
    x = np.array([x for _, x in kept])
    nearest = lambda: np.array([((row - c) ** 2).sum(axis=1).argmin() for row in x])
    for _ in range(rounds):
        a = nearest()
        c = np.array([x[a == j].sum(axis=0) // (a == j).sum() if (a == j).any() else c[j] for j in range(len(c))])
    a = nearest()
    d = ((x - c[a]) ** 2).sum(axis=1)
    sha = [hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest() for row in c]
    return sorted((i, int(a[n]), int(d[n]), int(d[a == a[n]].sum()), int(d.sum()), sha[a[n]]) for n, (i, _) in enumerate(kept))


def test_clusters_against_full_search(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(0, 0.2, (12, 64))
    rows = [(i, (base[i % 12] + rng.normal(0, 0.1, 64)).astype(np.float32).tolist()) for i in range(600)]
    rows += [(600 + i, [0.25] * 64) for i in range(9)]  # ties
    bad = [(900, None), (901, [0.1] * 63), (902, [None] + [0.1] * 63), (903, [float("nan")] + [0.1] * 63), (904, [float("-inf")] + [0.1] * 63)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], ROWS)
    for rounds in (0, 3, 6):
        assert sorted(map(tuple, centroids.cluster(df, rounds=rounds).collect())) == lloyd(rows, 16, rounds)


def test_bounds_spare_distances_and_hold():
    rng = np.random.default_rng(9)
    x = np.floor(64 * (rng.normal(0, 1, (12, 64))[np.arange(2000) % 12] + rng.normal(0, 0.1, (2000, 64)))).astype(np.int64)
    history = [x[:12] + rng.integers(-3, 4, (12, 64))]
    state = centroids.full_search(x, history[0], 0)[:5]
    for _ in range(4):
        history.append(history[-1] + rng.integers(-2, 3, (12, 64)))
        *state, evaluated = centroids.search(x, np.array(history), *state)
        d = np.sqrt(np.array([((x - c) ** 2).sum(axis=1) for c in history[-1]]).T)
        assert (state[0] == d.argmin(axis=1)).all() and evaluated < 0.2 * d.size
        moved = np.sqrt(((np.array(history) - history[-1]) ** 2).sum(axis=2))
        assert (state[3] - moved[state[4], np.arange(12)] <= d + 1e-6).all()


def test_displacements_are_summed_before_the_norm():
    """A centroid that moves away and back loosens nothing: its whole displacement is zero."""
    x, c = np.array([[0, 0], [100, 0]]), np.array([[0, 0], [100, 0]])
    state = centroids.full_search(x, c, 0)[:5]
    history = np.array([c, c + 60, c])
    assert centroids.search(x, history, *state)[5] == 0


def test_few_equal_clashing_and_large(spark):
    assert centroids.cluster(spark.createDataFrame([], ROWS)).collect() == []
    names = "vec_id long, embedding array<double>, x int, cluster int, upper int, distance int, c int"
    rows = [(1, [0.5] * 64), (2, [0.5] * 64), (2, [0.5] * 64), (None, [-0.01] * 64)]
    got = centroids.cluster(spark.createDataFrame([(i, v, 0, 0, 0, 0, 0) for i, v in rows], names)).collect()
    assert [r["vec_id"] for r in got if r["vec_id"] is None] == [None] and len(got) == 4
    assert {r["distance"] for r in got} == {0} and {r["inertia"] for r in got} == {0} and len({r["cluster"] for r in got}) == 2
    with pytest.raises(Exception, match="component too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64, 0)], ROWS)).collect()
