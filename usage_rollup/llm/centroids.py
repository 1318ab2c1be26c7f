"""Operator 12: integer k-means by equal-average equal-variance centroid search.

Vectors become integers. For two vectors of d components with sums S and
deviations V (V * V = sum of squared differences from the own mean),

    |x - c|^2  >=  (Sx - Sc)^2 / d + (Vx - Vc)^2.

Centroids are sorted by mean. A vector scans them outward from its own mean: once
the first term alone exceeds the best distance, no centroid further out can win
(mean inequality); a centroid whose both terms exceed it is skipped (deviation
inequality); for all others the distance is computed in whole numbers. The bounds
are rounded down, so ties are never rejected and the result is exact.

Each round is one pass over the vectors: a task adds up its vectors per cluster
and sends one row per cluster and component, which Spark sums. Only the centroids
(k x d numbers) reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, stored

#: Integer components are held within this, so that every distance fits 64 bits.
LIMIT = 1 << 27
_ROWS = 8192


def integer_vectors(batch: pa.RecordBatch, vec: str, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their integer vectors) of a batch."""
    lists = batch.column(vec)
    length = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length == dim)
    if not len(rows):
        return rows, np.zeros((0, dim), np.int64)
    flat = pc.list_flatten(lists.take(pa.array(rows))).cast(pa.float64())
    x = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False).reshape(-1, dim)
    fine = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(scale * x[fine]), -LIMIT, LIMIT)
    return rows[fine], x.astype(np.int64)


class Centroids:
    """Centroids in ascending order of their mean, with what the bounds need."""

    def __init__(self, c: np.ndarray):
        self.number = np.lexsort((np.arange(len(c)), c.sum(axis=1)))
        self.c = c[self.number]
        self.total, self.spread = moments(self.c)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(centroid number, squared distance) per row of ``x``, and how many distances were computed."""
        k, (n, d) = len(self.c), x.shape
        total, spread = moments(x)
        # rounding of the deviations, generously
        slack = 1e-12 * (np.abs(x).max(axis=1, initial=0) * np.sqrt(d) + spread + self.spread.max(initial=0)
                         + np.abs(self.c).max(initial=0) * np.sqrt(d))
        right = np.searchsorted(self.total, total).astype(np.int64)
        left = right - 1
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k, np.int64)
        active = np.arange(n)
        computed = 0
        for _ in range(k):
            lo, hi = left[active], right[active]
            to_left = np.where(lo >= 0, total[active] - self.total[np.maximum(lo, 0)], np.inf)
            to_right = np.where(hi < k, self.total[np.minimum(hi, k - 1)] - total[active], np.inf)
            go_left = to_left <= to_right
            j = np.where(go_left, lo, hi)
            left[active] -= go_left
            right[active] += ~go_left
            by_mean = np.minimum(to_left, to_right) ** 2 / d * (1 - 1e-9)
            on = by_mean <= best[active]  # beyond this every further centroid is farther
            active, j, by_mean = active[on], j[on], by_mean[on]
            if not len(active):
                break
            gap = np.maximum(np.abs(spread[active] - self.spread[j]) - slack[active], 0) ** 2 * (1 - 1e-9)
            close = by_mean + gap <= best[active]
            rows, j = active[close], j[close]
            diff = x[rows] - self.c[j]
            dist = np.einsum("ij,ij->i", diff, diff)
            computed += len(rows)
            better = (dist < best[rows]) | ((dist == best[rows]) & (self.number[j] < number[rows]))
            best[rows[better]] = dist[better]
            number[rows[better]] = self.number[j[better]]
        return number, best, computed


def moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum, deviation) per row."""
    total = x.sum(axis=1).astype(np.float64)
    centred = x - (total / x.shape[1])[:, None]
    return total, np.sqrt(np.einsum("ij,ij->i", centred, centred))


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per kept vector.

    Kept are vectors of exactly ``dim`` components, none NULL or non-finite; a
    component x becomes floor(scale * x), held within +-2^27. The first centroids are the ``k``
    kept vectors with the smallest sha256 of ``<seed>:<id>``; with fewer vectors there are
    fewer centroids. Ties go to the smaller centroid number, empty clusters keep
    their centroid. Repeated rows count as often as they stand; a NULL id is
    clustered but never starts a centroid. No kept vector (or none with an id): no rows.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    v = F.col(vec_col)
    if vectors.schema[vec_col].dataType.simpleString() not in ("array<float>", "array<double>"):
        v = v.cast("array<double>")
    narrow = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))

    def integers(batches):
        for b in batches:
            rows, x = integer_vectors(b, "v", dim, scale)
            yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(rows)), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["vec_id", "x"])

    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = (narrow.where("vec_id is not null").mapInArrow(integers, "vec_id long, x binary")
             .orderBy(order, "x").limit(k).collect())
    centroids = np.array([np.frombuffer(r.x, np.int64) for r in first], np.int64).reshape(-1, dim)
    for _ in range(rounds if len(first) else 0):
        centroids = _moved(narrow, centroids, dim, scale)

    shared = spark.sparkContext.broadcast(centroids)

    def assigned(batches):
        search = Centroids(shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, _ROWS):
                part = b.slice(lo, _ROWS)
                rows, x = integer_vectors(part, "v", dim, scale)
                number, distance, _ = search.nearest(x)
                yield pa.RecordBatch.from_arrays([part.column("vec_id").take(pa.array(rows)), pa.array(number.astype(np.int32)),
                                                  pa.array(distance)], names=["vec_id", "cluster", "distance"])

    members = narrow if len(first) else narrow.limit(0)
    out = stored(members.mapInArrow(assigned, "vec_id long, cluster int, distance long"), "centroid-members")
    per = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    facts = [(c, s, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sorted(per.items())]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select(  # k rows at most
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(per.values())).cast("long").alias("inertia"), "centroid_sha256")


def _moved(narrow: DataFrame, centroids: np.ndarray, dim: int, scale: int) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of each cluster's vectors, empty ones as they were."""
    shared = narrow.sparkSession.sparkContext.broadcast(centroids)

    def sums(batches):
        search = Centroids(shared.value)
        k = len(search.c)
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, _ROWS):
                _, x = integer_vectors(b.slice(lo, _ROWS), "v", dim, scale)
                number, _, _ = search.nearest(x)
                count += np.bincount(number, minlength=k)
                for c in np.unique(number):
                    total[c] += x[number == c].sum(axis=0)
        used = np.flatnonzero(count)
        columns = np.hstack([total[used], count[used][:, None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dim + 1).astype(np.int32)), pa.array(np.tile(np.arange(dim + 1, dtype=np.int32), len(used))),
             pa.array(columns.reshape(-1))], names=["cluster", "component", "value"])

    rows = (narrow.select("v").mapInArrow(sums, "cluster int, component int, value long").groupBy("cluster", "component")
            .agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("s")).collect())
    exact = {(r["cluster"], r["component"]): int(r["s"]) for r in rows}
    out = centroids.copy()
    for c in {c for c, _ in exact}:
        out[c] = [exact[c, j] // exact[c, dim] for j in range(dim)]
    return out


def op12_query(spark, sf_dir):
    return cluster(documents(spark, sf_dir, "embeddings"))


_STEP = r"""
d{i} AS (SELECT kept.vec_id, v, c, list_sum(list_transform(range(1, 65), lambda j: (v[j] - w[j]) * (v[j] - w[j]))) AS d FROM kept, c{i}),
a{i} AS (SELECT * FROM d{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)"""
_MOVE = r""",
u{i} AS (SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS j FROM a{i}) GROUP BY c, j),
m{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS w FROM u{i} GROUP BY c),
c{j} AS (SELECT c{i}.c, coalesce(m{i}.w, c{i}.w) AS w FROM c{i} LEFT JOIN m{i} USING (c)),"""
OP12_SQL = r"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v AS w FROM (
  SELECT v, sha256('1:' || vec_id) AS h FROM kept ORDER BY h LIMIT 16)),""" + "".join(
    _STEP.format(i=i) + (_MOVE.format(i=i, j=i + 1) if i < 3 else "") for i in range(4)) + r"""
SELECT vec_id, CAST(a3.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY a3.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.c = a3.c
"""
