"""Centroid clustering of integer vectors; the nearest centroid is found by the threshold algorithm.

Each dimension keeps the centroids sorted by their value there.  From a vector's own value every
such list is walked outwards, nearest first; a centroid met for the first time is compared exactly.
What no list has shown yet lies at least as far away as all frontiers together, so a vector is done
once the sum of its squared frontier distances strictly exceeds its best exact distance (strictly:
an unseen centroid as near as the best one may have the smaller number).

Spark deals the vectors; a task turns its batches into one row per centroid and component with exact
sums, which are combined map-side.  Only centroids cross to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailspark.llm.common import packed, unpacked, written

SIZE, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
MOST = 2**63 - 1
#: Vectors compared at once.
BLOCK = 512
_LIMB = 32
_COUNT, _INERTIA = -1, -2


def _small(size: int) -> int:
    """Below this magnitude squared distances of ``size`` components fit 64 bits; beyond, Python integers are used."""
    return 2 ** ((62 - size.bit_length()) // 2 - 1)


def valid(vector: Column, size: int = SIZE) -> Column:
    """Exactly ``size`` components, all finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) == size) & finite, F.lit(False))


def quantised(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` of doubles as integers, of Python's kind where 64 bits could not hold what follows."""
    with np.errstate(over="ignore"):  # beyond doubles: told apart below
        scaled = np.floor(values * float(scale))
    if not scaled.size or np.abs(scaled).max() < _small(values.shape[-1]):
        return scaled.astype(np.int64)
    exact = [int(x) if np.isfinite(x) else int(v) * scale for x, v in zip(scaled.ravel().tolist(), values.ravel().tolist())]
    return np.array(exact, dtype=object).reshape(values.shape)


@dataclass(frozen=True)
class Centroids:
    """Centroids as integer tuples; ``lists`` holds, per dimension, their numbers by ascending value."""

    points: tuple[tuple[int, ...], ...]

    def array(self) -> np.ndarray:
        small = all(abs(x) < _small(len(p)) for p in self.points for x in p)
        return np.array(self.points, dtype=np.int64 if small else object)

    def sha256(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in self.points]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid of each row (ties: the smaller number)."""
        points = self.array()
        if vectors.dtype == object or points.dtype == object:
            vectors, points = vectors.astype(object), points.astype(object)
        found = [_threshold(vectors[i : i + BLOCK], points) for i in range(0, len(vectors), BLOCK)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _threshold(vectors: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, k, size = len(vectors), len(points), points.shape[1]
    order = np.argsort(points, axis=0, kind="stable").T  # per dimension: centroid numbers by value
    values = np.take_along_axis(points.T, order, 1)
    dims = np.arange(size)
    right = np.stack([np.searchsorted(values[d], vectors[:, d]) for d in range(size)], 1)  # next to walk to, upwards
    left = right - 1  # and downwards
    best = np.zeros(n, vectors.dtype)
    cluster = np.full(n, -1, np.int64)
    seen = np.zeros((n, k), bool)
    active = np.arange(n)
    for _ in range(k):
        v, lo, hi = vectors[active], left[active], right[active]
        down = v - values[dims, np.maximum(lo, 0)]
        up = values[dims, np.minimum(hi, k - 1)] - v
        lower = (hi >= k) | ((lo >= 0) & (down <= up))
        frontier = np.where(lower, down, up)
        shown = order[dims, np.where(lower, lo, hi)]
        left[active], right[active] = lo - lower, hi + ~lower
        new = np.zeros((len(active), k), bool)
        new[np.arange(len(active))[:, None], shown] = True
        new &= ~seen[active]
        seen[active] |= new
        row, number = np.nonzero(new)
        gap = v[row] - points[number]
        exact = (gap * gap).sum(1)
        for at in _by_number(number):  # ascending, so that a tie keeps the smaller number of this step
            who, c, d = active[row[at]], number[at], exact[at]
            nearer = (cluster[who] < 0) | (d < best[who]) | ((d == best[who]) & (c < cluster[who]))
            best[who[nearer]], cluster[who[nearer]] = d[nearer], c[nearer]
        active = active[~((frontier * frontier).sum(1) > best[active]).astype(bool)]
        if not len(active):
            break
    return cluster, best


def _by_number(number: np.ndarray) -> Iterator[np.ndarray]:
    order = np.argsort(number, kind="stable")
    return (part for part in np.split(order, np.flatnonzero(np.diff(number[order])) + 1) if len(part))


def _matrix(column: pa.Array, size: int, scale: int) -> np.ndarray:
    return quantised(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size), scale)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """An integer as sum of part << (32 * number); the sign goes with every part."""
    sign, value, at = (1, value, 0) if value >= 0 else (-1, -value, 0)
    while value:
        yield at, sign * (value & (2**_LIMB - 1))
        value, at = value >> _LIMB, at + 1


class _Sums:
    """Exact sums over batches: (centroid, component) to integer."""

    def __init__(self):
        self.values: dict[tuple[int, int], int] = {}

    def add(self, cluster: int, component: int, value: int) -> None:
        self.values[cluster, component] = self.values.get((cluster, component), 0) + int(value)

    def batch(self) -> pa.RecordBatch:
        rows = [(c, d, at, part) for (c, d), value in self.values.items() for at, part in _limbs(value)]
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["cluster", "component", "limb", "part"])


_SUMS = "cluster int, component int, limb int, part bigint"


def _collected(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Sums of all tasks: as many rows as centroids times components, whatever the input."""
    total = parts.groupBy("cluster", "component", "limb").agg(F.sum("part").alias("part")).collect()
    out: dict[tuple[int, int], int] = {}
    for r in total:
        out[r["cluster"], r["component"]] = out.get((r["cluster"], r["component"]), 0) + (r["part"] << (_LIMB * r["limb"]))
    return out


def moved(vectors: DataFrame, centroids: Centroids, column: str, size: int = SIZE, scale: int = SCALE) -> Centroids:
    """One round: every centroid becomes the componentwise floor of its vectors' mean; empty ones stay."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for batch in batches:
            block = _matrix(batch.column(0), size, scale)
            cluster, _ = centroids.nearest(block)
            for c in np.unique(cluster):
                own = block[cluster == c]
                sums.add(c, _COUNT, len(own))
                for d, value in enumerate(own.sum(0)):
                    sums.add(c, d, value)
        yield sums.batch()

    total = _collected(vectors.select(column).mapInArrow(partial, _SUMS))
    points = []
    for c, point in enumerate(centroids.points):
        n = total.get((c, _COUNT), 0)
        points.append(tuple(total.get((c, d), 0) // n for d in range(size)) if n else point)
    return Centroids(tuple(points))


def seeds(vectors: DataFrame, key: str, column: str, clusters: int = CLUSTERS, scale: int = SCALE) -> Centroids:
    """The vectors with the smallest sha256 of ``1:<key>``, in that order; equal keys by their components."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    first = vectors.select(digest.alias("digest"), F.col(column).alias("v")).orderBy("digest", "v").limit(clusters)
    rows = [r["v"] for r in first.collect()]  # as many rows as centroids
    return Centroids(tuple(tuple(int(x) for x in quantised(np.array(v, dtype=np.float64), scale).tolist()) for v in rows))


def clustered(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", size: int = SIZE, clusters: int = CLUSTERS, rounds: int = ROUNDS,
    scale: int = SCALE, columns: list[str] | None = None,
) -> DataFrame:
    """The input columns (or those named) of all vectors of exactly ``size`` finite components, ``cluster``,
    ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Other rows (null, shorter or longer vectors, null or infinite components) are left out.  Repeated
    rows count each; a null key hashes as an empty text.  Fewer vectors than centroids give as many
    centroids as there are vectors, none an empty result.  A distance or sum beyond 64 bits is given
    as the greatest 64-bit value; all comparisons are exact all the same.
    """
    columns = vectors.columns if columns is None else columns
    kept = vectors.where(valid(vectors[column], size)).select(packed(vectors, columns=columns), vectors[key].alias("key"), vectors[column].cast("array<double>").alias("vector"))
    centroids = seeds(kept, "key", "vector", clusters, scale)
    for _ in range(rounds if centroids.points else 0):
        centroids = moved(kept, centroids, "vector", size, scale)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = centroids.nearest(_matrix(batch.column("vector"), size, scale))
            far = pa.array([min(int(d), MOST) for d in distance.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(cluster, pa.int32()), far], ["row", "cluster", "distance"])

    schema = kept.select("row").withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")}).schema
    found = written(kept.select("row", "vector").mapInArrow(assign, schema))
    # Sums of 32-bit halves cannot overflow; one row per cluster.
    halves = [F.sum(F.expr("distance & 4294967295")).alias("low"), F.sum(F.expr("shiftright(distance, 32)")).alias("high")]
    sums = {r["cluster"]: (r["high"] << 32) + r["low"] for r in found.groupBy("cluster").agg(*halves).collect()}
    digests = centroids.sha256()

    def by_cluster(values: Sequence, kind: str) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")[F.col("cluster")]

    results = {
        "cluster": F.col("cluster"),
        "distance": F.col("distance"),
        "cluster_inertia": by_cluster([min(sums.get(c, 0), MOST) for c in range(len(digests))], "bigint"),
        "inertia": F.lit(min(sum(sums.values()), MOST)).cast("bigint"),
        "centroid_sha256": by_cluster(digests, "string"),
    }
    return unpacked(found, columns, results)
