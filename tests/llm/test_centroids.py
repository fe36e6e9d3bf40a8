"""Centroid clustering against exhaustive search, and defined cases."""

import hashlib
import math

import numpy as np
import pytest

from catalog_engine.llm.centroids import Lists, centroid_clustering
from catalog_engine.llm.queries import op11_centroids


@pytest.mark.parametrize("k, dims, spread", [(1, 3, 5), (2, 1, 3), (8, 64, 300), (8, 4, 2), (40, 2, 6), (60, 5, 1000)])
def test_nearest_is_exact_with_ties(k, dims, spread):
    r = np.random.default_rng(k * dims)
    centroids = r.integers(-spread, spread + 1, (k, dims))
    centroids[k // 2] = centroids[0]  # equal centroids: the smaller number
    x = r.integers(-spread, spread + 1, (500, dims))
    x[:3] = [[-(1 << 27)] * dims, [1 << 27] * dims, centroids[0].tolist()]
    far = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    cluster, distance = Lists(centroids).nearest(x)
    assert (cluster == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def test_walk_stops_early(monkeypatch):
    """Far centroids are never measured."""
    r = np.random.default_rng(1)
    centroids = np.repeat(np.arange(200)[:, None] * 1000, 4, axis=1)
    x = np.repeat(r.integers(0, 200, 300)[:, None] * 1000, 4, axis=1) + r.integers(-20, 20, (300, 4))
    lists, measured = Lists(centroids), []
    real = np.nonzero
    monkeypatch.setattr(np, "nonzero", lambda a: (measured.append(int(a.sum())), real(a))[1])
    cluster, _ = lists.nearest(x)
    assert (cluster == x[:, 0].__add__(500) // 1000).all()
    assert sum(measured) <= 3 * len(x)


def plain(rows, dims, k, rounds, seed=3):
    """The clustering in Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centroids = [v for _, v in sorted(named)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        of = {}
        for _, v in kept:
            of.setdefault(near(v)[1], []).append(v)
        for n, vs in of.items():
            centroids[n] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *near(v)[::-1]) for i, v in kept] if centroids else []
    return found, centroids, [sum(d for _, c, d in found if c == n) for n in range(len(centroids))]


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "7 AS id", "'x' AS v", "1 AS cluster", "2L AS distance").repartition(3)


@pytest.mark.parametrize("n, k", [(120, 8), (5, 8), (40, 1)])
def test_clustering_equals_plain_python(spark, n, k):
    r = np.random.default_rng(n)
    rows = [(int(i), [float(np.float32(x)) for x in r.normal(size=4)]) for i in range(n)]
    rows += rows[:2] + [(None, rows[0][1]), (900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 0.0, 0.0]),
                        (904, [math.nan, 0.0, 0.0, 0.0]), (905, [0.0, math.inf, 0.0, 0.0])]
    got = centroid_clustering(table(spark, rows), dims=4, k=k, rounds=4)
    want, centroids, inertia = plain(rows, 4, k, 4)
    assert sorted(map(tuple, got.rows.collect()), key=repr) == sorted(want, key=repr)
    assert (got.centroids, got.inertia) == (centroids, inertia)


def test_empty_and_single_values(spark):
    for rows in ([], [(1, None), (2, [1.0])], [(None, [0.0] * 4)]):
        got = centroid_clustering(table(spark, rows), dims=4)
        assert got.rows.collect() == [] and got.centroids == []
    got = centroid_clustering(table(spark, [(k, [0.5, -0.5, 0.25, 0.0]) for k in range(30)]), dims=4)
    assert {(r.cluster, r.distance) for r in got.rows.collect()} == {(0, 0)}
    assert got.centroids[0] == [512, -512, 256, 0]


def test_large_components_are_kept_in_range(spark):
    got = centroid_clustering(table(spark, [(1, [3e38, 0.0, 0.0, 0.0]), (2, [-3e38, 0.0, 0.0, 0.0])]), dims=4, k=1, rounds=0)
    assert sorted(r.distance for r in got.rows.collect()) == [0, 1 << 60]


def test_query_on_empty_table(spark, tmp_path):
    table(spark, [(1, [1.0])]).select("vec_id", "embedding").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert op11_centroids(spark, str(tmp_path)).collect() == []


def test_query_equals_plain_python(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    want, centroids, inertia = plain(rows, 64, 8, 10)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    assert sorted(map(tuple, op11_centroids(spark, "/root/testdata/sf0.001").collect())) == sorted(
        (i, c, d, inertia[c], sum(inertia), digests[c]) for i, c, d in want)
