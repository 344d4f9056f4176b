import math

import numpy as np
import pytest

import tabsift.llm.embedding_dedup as E
from tabsift.llm.embedding_dedup import embedding_dedup, spanning_roots, tile_pairs
from tests.llm import brute


def want(rows, threshold=0.9):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links = []
    for i in range(n):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if usable(a) and usable(b) and len(a) == len(b):
                a, b = np.array(a, float), np.array(b, float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    links.append((i, j))
    place = brute.components(range(n), links)
    low = {}
    for i in range(n):
        low[place[i]] = min(low.get(place[i], rows[i][0]), rows[i][0])
    degree = np.bincount([x for p in links for x in p], minlength=n)
    return sorted((rows[i][0], int(degree[i]), low[place[i]], rows[i][0] == low[place[i]]) for i in range(n))


def cloud(n=300, dim=24, seed=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(n // 6, dim))
    x = centre[rng.integers(0, len(centre), n)] + 0.28 * rng.normal(size=(n, dim))
    x[10:40] = x[7]
    x[40:50] = 3 * x[7]
    return [(int(i), [float(v) for v in row]) for i, row in zip(rng.permutation(n) * 3, x)]


@pytest.mark.parametrize("block,tile", [(8192, 1024), (40, 16)])
def test_matches_brute_force(spark, monkeypatch, block, tile):
    monkeypatch.setattr(E, "BLOCK", block)
    monkeypatch.setattr(E, "TILE", tile)
    rows = cloud()
    got = embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got)) == want(rows)


def test_table_matches_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(map(tuple, embedding_dedup(df).collect())) == want(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]),
        (8, [2.0, 0.0]), (9, [-1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [1e200, 0.0]), (12, [1e-200, 1e-201]), (13, [-0.0, 5.0]), (14, [0.0, 5.0]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, key string")
    got = sorted(map(tuple, embedding_dedup(df).collect()))
    pair = {7, 8, 11, 12}
    assert {g[0]: g[2] for g in got if g[0] in pair} == dict.fromkeys(pair, 7)
    assert [g[1] for g in got if g[0] in pair] == [4] * 5
    assert [g[1:3] for g in got if g[0] in (13, 14)] == [(1, 13), (1, 13)]
    assert all(g[1] == 0 and g[2] == g[0] and g[3] for g in got if g[0] not in pair | {13, 14})
    assert embedding_dedup(df.where("false")).count() == 0
    assert embedding_dedup(df.where("vec_id < 4")).count() == 3


def test_tiles_leave_no_pair_out():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 40))
    x[200:] = x[:200] + 0.4 * rng.normal(size=(200, 40))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j, dot = tile_pairs(x, x, 0.9)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(x @ x.T >= 0.9))))
    assert np.allclose(dot, (x @ x.T)[i, j])


def test_spanning_roots():
    a, b = np.array([5, 4, 9, 1]), np.array([4, 3, 8, 1])
    assert spanning_roots(10, a, b).tolist() == [0, 1, 2, 3, 3, 3, 6, 7, 8, 8]
