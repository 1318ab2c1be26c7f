"""Operator 2: nearest neighbours by stable projections, a kd-tree and a chi-square stop.

Unit vectors are projected to ``m`` dimensions by a fixed Gaussian (2-stable)
matrix, so squared projected distances are the true ones times a chi-square
variable of m degrees. A kd-tree of the projections, fitted on a bounded sample,
cuts all vectors into cells; each cell cuts its own rows into small leaves. A
query verifies neighbours by rising projected distance, leaf by leaf, until the
test holds: what is left lies farther in projection than ``d_k * sqrt(chi2(confidence))``,
so a closer vector would lie there with probability 1 - confidence at most. Within a leaf
only the rows inside that radius are verified. The home cell gives the first bound on
d_k; then the query goes to just the cells within its radius. All queries that come to
a leaf in the same step are taken as one matrix product. Scores of the results are
computed anew from the original vectors, in double precision.

Cells that hold more rows than planned, and vectors of lengths too rare for a tree of
their own, are cut into parts by hash; a query visits all parts. Cells that
many queries visit are handed out to several tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, stored

SAMPLE = 1 << 16  # projected vectors the cells are fitted on
CELL_ROWS = 4096
#: The tree is no finer than its sample can tell; larger cells are cut into parts by hash.
MAX_CELLS = 1 << 12
#: Queries that one part of a cell takes at once.
CELL_QUERIES = 16_384
LEAF = 128


def chi2_quantile(m: int, p: float) -> float:
    """Quantile of the chi-square distribution with an even number of degrees."""
    def cdf(x):
        term, total = 1.0, 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    lo, hi = 0.0, 1000.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def _projection(dim: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, m))


def _units(blobs) -> np.ndarray:
    x = np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Cells:
    """kd-tree over projections: inner nodes (axis, cut), leaves numbered from left to right."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth, m = depth, points.shape[1]
        self.axis = np.zeros((1 << depth) - 1, np.int64)
        self.cut = np.full((1 << depth) - 1, np.inf)
        self.low, self.high = np.full((1 << depth, m), -np.inf), np.full((1 << depth, m), np.inf)
        self._split(points, 0, 0, np.full(m, -np.inf), np.full(m, np.inf))

    def _split(self, x, node, level, low, high):
        if level == self.depth:
            self.low[node - (1 << self.depth) + 1], self.high[node - (1 << self.depth) + 1] = low, high
            return
        a = int(np.argmax(np.ptp(x, axis=0))) if len(x) > 1 else 0
        cut = float(np.median(x[:, a])) if len(x) else 0.0
        self.axis[node], self.cut[node] = a, cut
        left = x[:, a] <= cut
        h, w = high.copy(), low.copy()
        h[a], w[a] = cut, cut
        self._split(x[left], 2 * node + 1, level + 1, low, h)
        self._split(x[~left], 2 * node + 2, level + 1, w, high)

    def of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.axis[node]] > self.cut[node])
        return node - (1 << self.depth) + 1

    def within(self, q: np.ndarray, radius2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, cell) of the cells that the queries' balls reach."""
        return np.nonzero(_box_distances(self.low, self.high, q) <= radius2[:, None])


def _box_distances(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distance of each query to each box, one dimension at a time."""
    out = np.zeros((len(q), len(low)))
    for j in range(q.shape[1]):
        gap = np.maximum(np.maximum(low[:, j] - q[:, j:j + 1], q[:, j:j + 1] - high[:, j]), 0)
        out += gap * gap
    return out


def _leaves(p: np.ndarray) -> list[np.ndarray]:
    todo, out = [np.arange(len(p))], []
    while todo:
        i = todo.pop()
        if len(i) <= LEAF:
            out.append(i)
            continue
        a = int(np.argmax(np.ptp(p[i], axis=0)))
        order = np.argpartition(p[i, a], len(i) // 2)
        todo += [i[order[:len(i) // 2]], i[order[len(i) // 2:]]]
    return out


def search_cell(x, ids, queries, bounds, project, factor, k):
    """Of each query the k best rows of a cell: (list of (query number, ids, scores, bound), rows verified).

    ``x`` and ``queries`` are original vectors; ``bounds`` the squared distances
    to the k-th neighbour known so far; ``factor`` the chi-square quantile.
    """
    nx, nq = np.linalg.norm(x, axis=1), np.linalg.norm(queries, axis=1)
    ux, uq = x / nx[:, None], queries / nq[:, None]
    p, pq = ux @ project, uq @ project
    leaves = _leaves(p)
    low = np.array([p[i].min(axis=0) for i in leaves])
    high = np.array([p[i].max(axis=0) for i in leaves])
    near = _box_distances(low, high, pq)
    order = np.argsort(near, axis=1, kind="stable")
    keep = min(k + 3, len(x))  # some more than k, for ties are settled by the scores computed anew
    best_s, best_i = np.full((len(queries), keep), -np.inf), np.full((len(queries), keep), -1)
    d_k, verified = bounds.astype(np.float64).copy(), 0
    live = np.arange(len(queries))
    for step in range(len(leaves)):
        # the chi-square test: nothing in the leaves left can be close enough
        live = live[near[live, order[live, step]] <= d_k[live] * factor]
        if not len(live):
            break
        at = order[live, step]
        by = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], at[by][1:] != at[by][:-1], [True]]))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            q, rows = live[by[lo:hi]], leaves[at[by[lo]]]
            gap = (pq[q] ** 2).sum(axis=1)[:, None] + (p[rows] ** 2).sum(axis=1) - 2 * (pq[q] @ p[rows].T)
            inside = gap <= (d_k[q] * factor)[:, None] + 1e-9
            verified += int(inside.sum())
            score = np.where(inside, uq[q] @ ux[rows].T, -np.inf)
            some = np.concatenate([best_s[q], score], axis=1)
            number = np.concatenate([best_i[q], np.broadcast_to(rows, score.shape)], axis=1)
            top = np.argpartition(-some, keep - 1, axis=1)[:, :keep]
            best_s[q], best_i[q] = np.take_along_axis(some, top, 1), np.take_along_axis(number, top, 1)
            if keep >= k:
                kth = -np.partition(-best_s[q], k - 1, axis=1)[:, k - 1]
                d_k[q] = np.minimum(d_k[q], np.where(kth > -np.inf, np.maximum(2 - 2 * kth, 0) * (1 + 1e-9) + 1e-12, np.inf))
    out = []
    for n, q in enumerate(queries):
        i = best_i[n][best_s[n] > -np.inf]
        s = (x[i] * q).sum(axis=1) / (nx[i] * nq[n])
        pairs = sorted((-a, v) for r, a in zip(i, s) for v in ids[r])[:k]
        out.append((n, [v for _, v in pairs], [-a for a, _ in pairs], d_k[n]))
    return out, verified


def nearest(vectors: DataFrame, query_ids: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            m: int = 16, confidence: float = 0.95, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: of each query its k nearest by cosine, own id excluded.

    ``query_ids`` (one column of ids) names the queries among the rows. Vectors
    that are NULL, empty, zero or hold NULL or non-finite components take no part,
    nor do rows without an id; repeated rows count once; vectors of another length
    are never compared. Equal vectors are searched once and answered by their
    smallest ids. Ties go to the smaller id.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = rows.where("vec_id is not null and v is not null and size(v) > 0").where(
        ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists("v", lambda c: c != 0))

    def packed(batches):
        for b in batches:
            blobs, dims = [], []
            for v in b.column("v"):
                a = np.asarray(v.values, np.float64) + 0.0  # -0.0 becomes 0.0
                a = a / np.abs(a).max() if not 1e-100 < np.abs(a).max() < 1e100 else a
                blobs.append(a.tobytes())
                dims.append(len(a))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(dims, pa.int32()), pa.array(blobs, pa.binary())],
                                             names=["vec_id", "dim", "x"])

    fine = stored(fine.mapInArrow(packed, "vec_id long, dim int, x binary"), "ann-vectors")
    # of equal vectors the k + 1 smallest ids can answer; the limit is applied before the shuffle
    top = F.row_number().over(Window.partitionBy("dim", "x").orderBy("vec_id"))
    distinct = (fine.distinct().withColumn("r", top).where(F.col("r") <= k + 1).groupBy("dim", "x")
                .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    distinct = stored(distinct.withColumn("key", F.element_at("ids", 1)), "ann-distinct")
    cells = {}
    sizes = distinct.groupBy("dim").count().where(F.col("count") > CELL_ROWS).orderBy(F.desc("count"), "dim").limit(16).collect()
    for r in sizes:  # the trees are broadcast: 16 lengths at most have one
        depth = math.ceil(math.log2(min(MAX_CELLS, r["count"] / CELL_ROWS)))
        sample = distinct.where(F.col("dim") == r["dim"]).orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("x").collect()
        cells[r["dim"]] = Cells(_units([s.x for s in sample]) @ _projection(r["dim"], m, seed), depth)
    shared = spark.sparkContext.broadcast(cells)
    factor = chi2_quantile(m, confidence)

    def home(batches):
        for b in batches:
            dims, blobs = b.column("dim").to_pylist(), b.column("x").to_pylist()
            cell = np.zeros(len(dims), np.int64)
            for d in set(dims):
                at = [i for i, x in enumerate(dims) if x == d]
                if d in shared.value:
                    cell[at] = shared.value[d].of(_units([blobs[i] for i in at]) @ _projection(d, m, seed))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=[*b.schema.names, "cell"])

    base = distinct.schema.simpleString()[7:-1].replace("key:", "key ").replace("dim:", "dim ").replace("x:", "x ").replace("ids:", "ids ")
    index = stored(distinct.mapInArrow(home, base + ", cell long"), "ann-index")
    parts = stored(index.groupBy("dim", "cell").agg(F.ceil(F.count("*") / (2 * CELL_ROWS)).cast("int").alias("parts")), "ann-parts")
    asked = fine.join(query_ids.toDF("vec_id").distinct(), "vec_id").distinct()
    owner = asked.join(distinct.select("dim", "x", "key"), ["dim", "x"])
    owner = stored(owner.select(F.col("vec_id").alias("query_id"), "key"), "ann-owners")
    queries = stored(index.join(owner.select("key").distinct(), "key", "left_semi").select("dim", "cell", "key", "x"), "ann-queries")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            dim = int(left["dim"].iloc[0])
            x = np.frombuffer(b"".join(left["x"]), np.float64).reshape(len(left), dim)
            q = np.frombuffer(b"".join(right["x"]), np.float64).reshape(len(right), dim)
            bounds = right["bound"].to_numpy() if "bound" in right else np.full(len(right), 4.0)
            keys, ids = right["key"].to_numpy(), list(left["ids"])
            for at in range(0, len(q), 512):
                found, _ = search_cell(x, ids, q[at:at + 512], bounds[at:at + 512], _projection(dim, m, seed), factor, k + 1)
                out += [(keys[at + n], [int(v) for v in of], scores, d_k) for n, of, scores, d_k in found]
        return pd.DataFrame(out, columns=["key", "ids", "scores", "bound"])

    def met(asking: DataFrame) -> DataFrame:
        """Every part of a cell with the queries that visit it, several groups of them where they are many."""
        groups = asking.groupBy("dim", "cell").agg(F.ceil(F.count("*") / CELL_QUERIES).cast("int").alias("groups"))
        plan = parts.join(groups, ["dim", "cell"])
        rows = (index.join(plan, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
                .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("parts", "groups"))
        who = (asking.join(plan, ["dim", "cell"]).withColumn("group", F.pmod(F.xxhash64("key"), F.col("groups")).cast("int"))
               .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "groups"))
        by = ["dim", "cell", "part", "group"]
        return rows.groupBy(*by).cogroup(who.groupBy(*by)).applyInPandas(search, schema)

    schema = "key long, ids array<long>, scores array<double>, bound double"
    first = stored(met(queries), "ann-first")

    def spread(batches):
        for b in batches:
            dims, home_, keys, blobs, bounds = (b.column(n).to_pylist() for n in ("dim", "cell", "key", "x", "bound"))
            for d in set(dims) & set(shared.value):
                rows = np.array([i for i, x in enumerate(dims) if x == d])
                q = _units([blobs[i] for i in rows]) @ _projection(d, m, seed)
                for at in range(0, len(rows), 256):
                    some = rows[at:at + 256]
                    who, cell = shared.value[d].within(q[at:at + 256], np.array([bounds[i] for i in some]) * factor)
                    on = cell != np.array([home_[i] for i in some])[who]
                    of = some[who[on]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(of), d, np.int32)), pa.array(cell[on].astype(np.int64)), pa.array([keys[i] for i in of], pa.int64()),
                         pa.array([blobs[i] for i in of], pa.binary()), pa.array([bounds[i] for i in of], pa.float64())],
                        names=["dim", "cell", "key", "x", "bound"])

    bound = first.groupBy("key").agg(F.min("bound").alias("bound"))
    wider = stored(queries.join(bound, "key").select("dim", "cell", "key", "x", "bound")
                   .mapInArrow(spread, "dim int, cell long, key long, x binary, bound double"), "ann-visits")
    second = met(wider)
    found = first.union(second).select("key", F.explode(F.arrays_zip("ids", "scores")).alias("f")).select(
        "key", F.col("f.ids").alias("vec_id"), F.col("f.scores").alias("score"))
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (owner.join(found, "key").where("vec_id <> query_id").withColumn("rank", F.row_number().over(mine))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def op2_query(spark, sf_dir):
    rows = documents(spark, sf_dir, "embeddings")
    return nearest(rows, rows.select("vec_id").where("vec_id % 50 = 0"))
