"""Centroid clustering with n-simplex projection as filter.

Vectors are integer points. A few pivots are chosen among the first centroids;
the distances of a point to the pivots make an apex over the simplex of the
pivots (Connor et al., "High-dimensional simplexes for supermetric search",
2017): one coordinate for each pivot, the last one its height. The Euclidean distance of two apexes is a lower bound of the distance
of their points, and with the second height turned over it is an upper bound.
A point's pivot distances are taken once and kept with it; those of the
centroids once a round. A centroid whose lower bound exceeds the smallest upper
bound cannot be nearest; the others are compared by exact integer distances, a
tie going to the smaller number. Rounding is covered by a margin on the squared
bounds, so the filter never changes a result.

Scale. Points are read, checked and projected once and written with their
apexes; a round is one pass without moving a point. A task adds its points into
at most ``k`` sums, so a cluster with a third of all points is as cheap as any
other; the driver receives ``k`` x ``dim`` numbers a round (sums are exact
decimals). Centroids travel to the tasks in the closure (``k`` x ``dim`` integers).
Rounds read the written table, so a lost executor costs its tasks only.

Output: one row for each kept vector: vec_id, cluster, distance (squared),
cluster_inertia, inertia, centroid_sha256.

Defined cases. Vectors that are null, of another length, or hold a null or
non-finite component are left out. Repeated rows are points of their own. A
null vec_id is a point too, but the first centroids take it only if ids run
out; equal hashes (repeated ids) go by their components. With fewer than ``k``
points there are as many centroids. Integers of 2^27 and more in size raise an
error: a squared distance of such points can exceed a long. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import written

LIMIT = 1 << 27  # 64 x (2 x LIMIT)^2 fits a long
ROWS = 2000  # points of one numpy step


@dataclass
class Simplex:
    """Pivots in an order in which each adds to the simplex of those before."""

    pivots: np.ndarray  # m x dim
    base: np.ndarray  # (m - 1) x (m - 1), lower triangular: pivots 1.. seen from pivot 0
    margin: float  # part of the squared sizes that rounding can cost

    @staticmethod
    def choose(points: np.ndarray, most: int) -> Simplex:
        """Greedily the point that stands highest over the pivots so far; the
        points that hardly rise over them would make the base ill-conditioned."""
        x = points.astype(float)
        rest, chosen, axes = x - x[0], [0], []
        size = np.sqrt((rest**2).sum(axis=1)).max()
        while len(chosen) < min(most, len(x)):
            height = np.sqrt((rest**2).sum(axis=1))
            best = int(height.argmax())
            if height[best] <= 1e-3 * size or best in chosen:
                break
            axes.append(rest[best] / height[best])
            rest = rest - np.outer(rest @ axes[-1], axes[-1])
            chosen.append(best)
        base = np.tril((x[chosen[1:]] - x[0]) @ np.array(axes).T) if axes else np.zeros((0, 0))
        worst = np.linalg.cond(base) if axes else 1.0
        return Simplex(points[chosen], base, 1e-12 * worst**2)

    def apexes(self, points: np.ndarray) -> np.ndarray:
        """n x m: coordinates in the space of the pivots, and the height."""
        squares = squared(points, self.pivots)
        own = (self.base**2).sum(axis=1)
        right = (squares[:, :1] + own - squares[:, 1:]) / 2
        inner = np.linalg.solve(self.base, right.T).T if len(own) else np.zeros((len(points), 0))
        height = np.sqrt(np.maximum(squares[:, 0] - (inner**2).sum(axis=1), 0))
        return np.column_stack([inner, height])


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to a few others."""
    out = np.empty((len(points), len(others)), dtype=np.int64)
    for j, o in enumerate(others):
        d = points - o
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def nearest(points: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each point."""
    size = (apexes**2).sum(axis=1)[:, None] + (tops**2).sum(axis=1)
    flat = apexes[:, :-1] @ tops[:, :-1].T
    heights = np.outer(apexes[:, -1], tops[:, -1])
    low, high = size - 2 * (flat + heights), size - 2 * (flat - heights)
    slack = 1.0 + margin * size
    left = low - slack <= (high + slack).min(axis=1)[:, None]
    rows, cols = np.nonzero(left)  # by point, then by number of the centroid
    exact = np.empty(len(rows), dtype=np.int64)
    for s in range(0, len(rows), 20_000):
        d = points[rows[s : s + 20_000]] - centroids[cols[s : s + 20_000]]
        exact[s : s + 20_000] = np.einsum("ij,ij->i", d, d)
    all_of = np.full(left.shape, np.iinfo(np.int64).max)
    all_of[rows, cols] = exact
    best = all_of.argmin(axis=1)  # the first of equal ones
    return best, all_of[np.arange(len(best)), best]


def _matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def points(embeddings: DataFrame, dim: int, scale: int) -> DataFrame:
    """(vec_id, point): kept vectors as ``dim`` long integers."""
    ok = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = embeddings.where((F.size("embedding") == dim) & ok)
    point = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), point.alias("point"))


def _checked(x: np.ndarray) -> np.ndarray:
    if len(x) and np.abs(x).max() >= LIMIT:
        raise ValueError("a component is too large: squared distances would not fit a long")
    return x


def cluster(
    embeddings: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dim: int = 64, scale: int = 256, pivots: int = 16
) -> DataFrame:
    """Clusters of all kept vectors after ``rounds`` rounds."""
    pts = points(embeddings, dim, scale)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = pts.orderBy(name.asc_nulls_last(), "point").limit(k).collect()  # k rows
    centroids = _checked(np.array([r["point"] for r in first], dtype=np.int64).reshape(-1, dim))
    if not len(centroids):
        return pts.select(
            "vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")),
            F.lit("").alias("centroid_sha256"),
        ).limit(0)
    simplex = Simplex.choose(centroids, pivots)
    wide = len(simplex.pivots)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, len(b), ROWS):
                p = b.slice(s, ROWS)
                x = _checked(np.asarray(p["point"].flatten(), dtype=np.int64).reshape(-1, dim))
                y = simplex.apexes(x)
                yield pa.RecordBatch.from_arrays(
                    [p["vec_id"], pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary()), pa.array([r.tobytes() for r in y.astype("<f8")], pa.binary())],
                    names=["vec_id", "point", "apex"],
                )

    table = written(pts.mapInArrow(projected, "vec_id long, point binary, apex binary"), "apexes")

    def assigned(b: pa.RecordBatch, now: np.ndarray, tops: np.ndarray) -> Iterator[tuple]:
        for s in range(0, len(b), ROWS):
            p = b.slice(s, ROWS)
            x = _matrix(p["point"], "<i4", dim).astype(np.int64)
            yield (p, x, *nearest(x, _matrix(p["apex"], "<f8", wide), now, tops, simplex.margin))

    def sums(now: np.ndarray) -> DataFrame:
        tops = simplex.apexes(now)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros((len(now), dim), dtype=np.int64), np.zeros(len(now), dtype=np.int64)
            for b in batches:
                for _, x, best, _ in assigned(b, now, tops):
                    np.add.at(total, best, x)
                    n += np.bincount(best, minlength=len(now))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(total[some].tolist(), pa.list_(pa.int64()))],
                names=["cluster", "n", "total"],
            )

        parts = table.select("point", "apex").mapInArrow(run, "cluster int, n long, total array<long>")
        one = parts.select("cluster", "n", F.posexplode("total").alias("at", "part"))
        exact = "decimal(38,0)"
        return one.groupBy("cluster", "at").agg(F.sum(F.col("n").cast(exact)).alias("n"), F.sum(F.col("part").cast(exact)).alias("total"))

    for _ in range(rounds):
        new = centroids.copy()
        for r in sums(centroids).collect():  # k x dim rows
            new[r["cluster"], r["at"]] = int(r["total"]) // int(r["n"])
        centroids = new

    tops = simplex.apexes(centroids)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, _, best, distance in assigned(b, centroids, tops):
                yield pa.RecordBatch.from_arrays(
                    [p["vec_id"], pa.array(best.astype(np.int32)), pa.array(distance), pa.array([digests[i] for i in best])],
                    names=["vec_id", "cluster", "distance", "centroid_sha256"],
                )

    found = written(table.mapInArrow(last, "vec_id long, cluster int, distance long, centroid_sha256 string"), "clusters")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(exact.alias("d")).collect()}  # at most k rows
    of_all = sum(inertia.values())
    own = F.create_map(*(F.lit(x) for c, d in sorted(inertia.items()) for x in (c, d))) if inertia else F.create_map()
    return found.select(
        "vec_id", "cluster", "distance", F.element_at(own, F.col("cluster")).cast("long").alias("cluster_inertia"),
        F.lit(of_all).cast("long").alias("inertia"), "centroid_sha256",
    )
