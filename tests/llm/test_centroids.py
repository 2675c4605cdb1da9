"""Centroid clustering against plain Lloyd rounds and against SQL."""

import hashlib
import math
import random

import numpy as np
import pytest

from packlift.llm import centroids

ROW = "vec_id long, embedding array<float>, label int, cluster string"


def brute(rows, k, rounds, dims):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in start[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cs = [[sum(x) // len(groups[i]) for x in zip(*groups[i])] if i in groups else c for i, c in enumerate(cs)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    return out, cs


def f32(x):
    return float(np.float32(x))


def make(n, dims, seed):
    rng = random.Random(seed)
    rows = [(i, [f32(rng.choice((-1, 0, 0, 1)) + rng.random() / 8) for _ in range(dims)]) for i in range(n)]
    return rows + [(n, [0.0] * dims), (n, [0.0] * dims), (n + 1, None), (n + 2, [0.0] * (dims - 1)),
                   (n + 3, [0.0] * (dims - 1) + [None]), (n + 4, [float("nan")] * dims),
                   (n + 5, [float("inf")] * dims), (None, [0.5] * dims), (n + 6, [])]


@pytest.mark.parametrize("k,rounds,seed", [(8, 10, 1), (5, 3, 2), (1, 2, 3)])
def test_equals_plain_rounds(spark, k, rounds, seed):
    rows = make(150, 6, seed)
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], ROW).repartition(5)
    out, cs = centroids.cluster(df, k, rounds, 6)
    want, want_cs = brute(rows, k, rounds, 6)
    assert cs == want_cs
    got = [tuple(r) for r in out.select("vec_id", "cluster", "distance").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    full = centroids.centroid_clusters(df, k, rounds, 6).collect()
    total = sum(d for _, _, d in want)
    for r in full:
        assert r["inertia"] == total
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cs[r["cluster"]])).encode()).hexdigest()


@pytest.mark.parametrize("seed", range(4))
def test_search_finds_the_nearest_with_ties(seed):
    rng = np.random.default_rng(seed)
    cs, x = rng.integers(-3, 4, (9, 3)), rng.integers(-4, 5, (400, 3))
    cs[5] = cs[2]
    at, best = centroids.Orchard(cs).nearest(x)
    d = ((x[:, None, :] - cs[None]) ** 2).sum(axis=2)
    assert (best == d.min(axis=1)).all() and (at == d.argmin(axis=1)).all()


def test_search_skips_what_is_far():
    cs = np.array([[0, 0], [1000, 0], [0, 1000], [3, 0]])
    asked = []
    search = centroids.Orchard(cs)
    plain = search._distance
    search._distance = lambda x, c: asked.append(len(x)) or plain(x, c)
    assert search.nearest(np.array([[1, 0]] * 10))[0].tolist() == [0] * 10
    assert sum(asked) <= 20      # its own start and the one near centroid


def test_few_and_none(spark):
    two = spark.createDataFrame([(1, [0.0, 1.0], 0, ""), (2, [5.0, 1.0], 0, "")], ROW)
    assert centroids.centroid_clusters(two, 8, 10, 2).count() == 2
    assert centroids.centroid_clusters(two.limit(0), 8, 10, 2).count() == 0
    assert centroids.centroid_clusters(two, 8, 10, 64).count() == 0


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30, 1.0], 0, "")], ROW)
    with pytest.raises(Exception, match="after scaling"):
        centroids.cluster(df, 2, 1, 2)
