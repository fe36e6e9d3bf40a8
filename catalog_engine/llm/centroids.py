"""Clustering by centroids; the nearest one by the threshold algorithm.

Every dimension has a list of the centroids sorted by their value in it. For a
vector all lists are walked outward from the vector's own value, one centroid a
step and list, the nearer side first. A centroid that shows up in any list for
the first time gets its exact distance. What has not shown up yet lies, in every
dimension, at or beyond the next entry of that list (the frontier), so the walk
ends when the sum of the squared frontier distances strictly exceeds the best
exact distance: an equal distance may still belong to a smaller number.

Vectors are whole numbers, floor(scale * x), and all sums are exact. A round is
one pass: each task adds up its vectors per centroid, and the k x dims sums of
all tasks are added by Spark; only the new centroids, k x dims numbers, reach
the driver and go out with the next round. The whole-number vectors are written
once to the shared folder and read from there.

Defined cases: vectors with another number of components, a null or a
non-finite one, and null vectors are left out; a vector without id is clustered
but never a first centroid; repeated rows count as often as they stand there;
first centroids with equal hashes (repeated ids) follow the order of their
components; fewer than k vectors give as many centroids, no vectors none and an
empty result; an empty centroid stays where it was; ties go to the smaller
number. Components are kept within +-sqrt(2^60 / dims) after scaling (2^27 for
64 dimensions, 131,072 before scaling by 1,024), so that no distance leaves 64
bits; no table here comes near.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import INT64_MAX, cut, release

DIMS, K, ROUNDS, SEED, SCALE = 64, 8, 10, 3, 1024
#: Numbers that the arrays of a step may hold.
CELLS = 1 << 21
#: Beyond either end of a list: farther than any two components are apart.
_END = 1 << 40


class Lists:
    """The centroids by dimension, sorted, with an end mark on either side."""

    def __init__(self, centroids: np.ndarray):
        k, dims = centroids.shape
        self.centroids = centroids
        order = np.argsort(centroids, axis=0, kind="stable")
        self.number = np.vstack([np.zeros((1, dims), np.int64), order, np.zeros((1, dims), np.int64)])
        self.value = np.vstack([np.full((1, dims), -_END), np.take_along_axis(centroids, order, 0), np.full((1, dims), _END)])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid."""
        n, (k, dims) = len(vectors), self.centroids.shape
        best, cluster = np.full(n, INT64_MAX), np.zeros(n, np.int64)
        step = max(1, CELLS // (k * dims))
        for lo in range(0, n, step):
            best[lo:lo + step], cluster[lo:lo + step] = self._walk(vectors[lo:lo + step])
        return cluster, best

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, (k, dims) = len(x), self.centroids.shape
        best, cluster, seen = np.full(n, INT64_MAX), np.zeros(n, np.int64), np.zeros((n, k), bool)
        column = np.arange(dims)
        above = np.empty((n, dims), np.int64)
        for d in range(dims):
            above[:, d] = 1 + np.searchsorted(self.value[1:-1, d], x[:, d])
        below, live = above - 1, np.arange(n)
        for depth in range(k):
            at = x[live]
            down = at - self.value[below, column] <= self.value[above, column] - at
            met = self.number[np.where(down, below, above), column]
            fresh = np.zeros((len(live), k), bool)
            fresh[np.arange(len(live))[:, None], met] = True
            fresh &= ~seen[live]
            seen[live] |= fresh
            row, number = np.nonzero(fresh)
            exact = np.full((len(live), k), INT64_MAX)
            exact[row, number] = ((at[row] - self.centroids[number]) ** 2).sum(axis=1)
            number = exact.argmin(axis=1)  # the first of equal ones
            exact = exact[np.arange(len(live)), number]
            better = (exact < best[live]) | ((exact == best[live]) & (number < cluster[live]))
            best[live[better]], cluster[live[better]] = exact[better], number[better]
            if depth + 1 == k:
                break
            below, above = below - down, above + ~down
            frontier = np.minimum(at - self.value[below, column], self.value[above, column] - at)
            go_on = (frontier ** 2).sum(axis=1) <= best[live]
            live, below, above = live[go_on], below[go_on], above[go_on]
            if not len(live):
                break
        return best, cluster


class Clustering(NamedTuple):
    """rows: (id, cluster int, distance long); centroids: k lists of whole
    numbers; inertia: the sum of distances per centroid."""

    rows: DataFrame
    centroids: list[list[int]]
    inertia: list[int]


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, v): the vectors that count, as whole numbers."""
    limit = float(isqrt((1 << 60) // dims))
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.filter((F.size(v) == dims) & finite).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(v, lambda x: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), x * scale))).cast("int")).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dims).astype(np.int64)


def _sums(rows: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[list[int], int, int]]:
    """Per centroid with vectors: sums by dimension, distances and count."""
    lists = Lists(np.array(centroids, np.int64))
    k, dims = lists.centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, far, count = np.zeros((k, dims), np.int64), [0] * k, np.zeros(k, np.int64)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0), dims)
                cluster, distance = lists.nearest(x)
                by = np.argsort(cluster, kind="stable")
                heads = np.flatnonzero(np.diff(cluster[by], prepend=-1))
                names = cluster[by][heads]
                total[names] += np.add.reduceat(x[by], heads, axis=0)
                count += np.bincount(cluster, minlength=k)
                for c in names.tolist():
                    far[c] += sum(distance[cluster == c].tolist())
        c = np.flatnonzero(count)
        # dimension -1 is the distance, -2 the count
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(c, dims + 2)), pa.array(np.tile(np.concatenate([np.arange(dims), [-1, -2]]), len(c))),
            pa.array([str(x) for i in c.tolist() for x in (*total[i].tolist(), far[i], count[i])], pa.string())],
            ["cluster", "dim", "total"])
        release()

    found = (rows.select("v").mapInArrow(add, "cluster long, dim long, total string").groupBy("cluster", "dim")
             .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())  # k x (dims + 2) rows
    held: dict[int, dict[int, int]] = {}
    for r in found:
        held.setdefault(r["cluster"], {})[r["dim"]] = int(r["total"])
    return {c: ([x[d] for d in range(dims)], x[-1], x[-2]) for c, x in held.items()}


def centroid_clustering(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, dims: int = DIMS,
                        k: int = K, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE) -> Clustering:
    """Clusters all vectors. The first centroids are the k vectors with smallest
    sha256 of `seed:id`; after each of `rounds` assignments a centroid becomes
    the floor of its vectors' mean; a last assignment follows."""
    rows = cut(whole_vectors(vectors, id_col, vector_col, dims, scale))
    first = rows.filter("id is not null").orderBy(
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256), "v").limit(k)
    centroids = [list(r["v"]) for r in first.collect()]
    if not centroids:
        return Clustering(rows.filter("false").selectExpr("id", "0 AS cluster", "0L AS distance"), [], [])
    for _ in range(rounds):
        for c, (total, _, count) in _sums(rows, centroids).items():
            centroids[c] = [x // count for x in total]
    far = _sums(rows, centroids)
    lists = Lists(np.array(centroids, np.int64))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cluster, distance = lists.nearest(_matrix(b.column(1), dims))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster, pa.int32()), pa.array(distance)],
                                             ["id", "cluster", "distance"])

    return Clustering(rows.mapInArrow(assign, "id long, cluster int, distance long"), centroids,
                      [far[c][1] if c in far else 0 for c in range(len(centroids))])
