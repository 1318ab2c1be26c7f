"""Operator 11: MinHash near-dedup with sequential Bayesian verification.

A document's set holds its distinct word shingles; equal sets are one set from
the start. A set's signature has ``bands * rows`` minima; sets that agree in all
rows of a band are candidates. With 48 bands of 6 rows a pair of similarity 0.8
shares no band with probability 5e-7.

Candidates do not become all pairs of their band. A band's smallest set is its
pivot, and the others are its family. A member is compared with the pivot it shares
most bands with, and then only with pivots outside its component. A comparison is made by
signatures first, one byte a minimum, in batches of 32. After n minima with m agreements and a uniform prior,
the agreement rate has the posterior Beta(m + 1, n - m + 1); once the
probability that it reaches the rate of the wanted similarity falls below
``miss``, the pair is dropped and its remaining batches are not looked at. Pairs
that survive all batches are verified on the full sets.

Members that end up outside their pivot's component are compared with all other
members of its family, in blocks of bounded size, by the same two steps; so a
link between two members is never lost because a third one was the pivot. Pairs
inside one component are never compared: they can't change the result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .common import connected_components, documents, lean, stored
from .ngram_join import _blocks, _by_block, _linked, _met, _verified

BATCH = 32
_KEY = np.uint64(0xA24BAED4963EE407)
#: Shingles hashed at once; bounds the matrix of (minima, shingles).
_SLICE = 512


class Signer:
    """Minima of ``bands * rows`` hash functions, as one byte each and as one 64-bit name per band."""

    def __init__(self, bands: int, rows: int, seed: int):
        r = np.random.default_rng(seed)
        n = bands * rows
        self.bands, self.rows = bands, rows
        self.factor = (r.integers(0, 1 << 32, n, np.uint32) | np.uint32(1))[:, None]
        self.add = r.integers(0, 1 << 32, n, np.uint32)[:, None]
        self.mixer = r.integers(0, 1 << 63, (bands, rows), np.uint64) * np.uint64(2) + np.uint64(1)
        self.name = r.integers(0, 1 << 63, bands, np.uint64)

    def __call__(self, shingles: np.ndarray) -> tuple[bytes, np.ndarray]:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.factor), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), _SLICE):
            y = x[i:i + _SLICE] * self.factor
            y += self.add
            np.minimum(low, y.min(axis=1), out=low)
        per_band = (ta.mix(low.astype(np.uint64) + np.uint64(1)).reshape(self.bands, self.rows) * self.mixer).sum(axis=1)
        small = ((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
        return small.tobytes(), ta.mix(per_band + self.name).view(np.int64)


def agreement(percent: int) -> float:
    """Share of equal signature bytes of two sets of that similarity."""
    return percent / 100 + (1 - percent / 100) / 256


def least_agreements(total: int, percent: int, miss: float) -> list[tuple[int, int]]:
    """(minima looked at, fewest agreements to go on) after each batch.

    P(rate >= p) under Beta(m + 1, n - m + 1) equals P(Binomial(n + 1, p) <= m).
    """
    p, out = agreement(percent), []
    for n in [*range(BATCH, total, BATCH), total]:
        tail, m = 0.0, 0
        while True:
            tail += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
                             + m * math.log(p) + (n + 1 - m) * math.log1p(-p))
            if tail >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def survivors(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, int]:
    """(rows of the two signature matrices that pass every batch, bytes compared)."""
    alive, same, at, seen = np.arange(len(left)), np.zeros(len(left), np.int64), 0, 0
    for n, least in steps:
        same += (left[alive, at:n] == right[alive, at:n]).sum(axis=1)
        seen += len(alive) * (n - at)
        on = same >= least
        alive, same, at = alive[on], same[on], n
        if not len(alive):
            break
    return alive, seen


def _sets(batch, text, size):
    """(row, sorted distinct shingles) of a batch."""
    for i, h in ta.text_rows(batch, text, ta.LOWER_WORDS, size):
        h = np.sort(h)
        yield i, h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def _key(h: np.ndarray) -> int | None:
    return int(ta.mix(h ^ _KEY).sum().view(np.int64)) if len(h) else None


def _entities(text, size, signer_of):
    """One row per document; the signature and band names stand once per set and task."""

    def run(batches):
        signer, seen = signer_of(), set()
        for b in batches:
            out = []
            for i, h in _sets(b, text, size):
                key = _key(h)
                sig = names = None
                if key is not None and key not in seen:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(key)
                    sig, names = signer(h)
                out.append((i, key, len(h), sig, names))
                if len(out) >= 2000:
                    yield _rows(b, out)
                    out = []
            if out:
                yield _rows(b, out)

    return run, "doc_id long, key long, n long, sig binary, bands array<long>"


def _rows(batch, out):
    i, key, n, sig, names = zip(*out)
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(pa.array(i)), pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.binary()),
         pa.array(names, pa.list_(pa.int64()))], names=["doc_id", "key", "n", "sig", "bands"])


def _full_sets(text, size):
    """(key, set) once per set and task, in batches of bounded size."""

    def run(batches):
        seen, keys, sets, held = set(), [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], names=["key", "tokens"])

        for b in batches:
            for _, h in _sets(b, text, size):
                key = _key(h)
                if key is None or key in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(key)
                keys.append(key)
                sets.append(h.tobytes())
                held += len(h)
                if held > 1_000_000:
                    yield flush()
                    keys, sets, held = [], [], 0
        if keys:
            yield flush()

    return run, "key long, tokens binary"


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer() for v in column), np.uint8).reshape(-1, width)


def _likely(pairs: DataFrame, sigs: DataFrame, steps, percent: int) -> DataFrame:
    """Pairs (a, b) that their sizes allow and whose signatures pass every batch."""
    x = sigs.select(F.col("key").alias("a"), F.col("sig").alias("x"), F.col("n").alias("na"))
    y = sigs.select(F.col("key").alias("b"), F.col("sig").alias("y"), F.col("n").alias("nb"))
    met = pairs.join(x, "a").join(y, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def run(batches):
        for b in batches:
            on, _ = survivors(_matrix(b.column("x"), steps[-1][0]), _matrix(b.column("y"), steps[-1][0]), steps)
            yield b.select(["a", "b"]).take(pa.array(on))

    return met.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _promising(blocks: DataFrame, sigs: DataFrame, steps, percent: int) -> DataFrame:
    """(p, key) of the members with a partner in a block that their sizes allow and whose signatures pass."""

    def run(batches):
        for rows in _by_block(batches):
            left, right = [r for r in rows if r[0] != 1], [r for r in rows if r[0] != 0]
            if not left or not right:
                continue
            i, j = (g.reshape(-1) for g in np.meshgrid(np.arange(len(left)), np.arange(len(right)), indexing="ij"))
            n, m = np.array([r[3] for r in left])[i], np.array([r[3] for r in right])[j]
            other = np.array([r[2] for r in left])[i] != np.array([r[2] for r in right])[j]
            fit = other & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            i, j = i[fit], j[fit]
            x, y = (np.stack([r[5].view(np.uint8) for r in side]) for side in (left, right))
            on = np.concatenate([s + survivors(x[i[s:s + 4096]], y[j[s:s + 4096]], steps)[0] for s in range(0, len(i), 4096)] or [i])
            hit = sorted({left[k][2] for k in i[on]} | {right[k][2] for k in j[on]})
            yield pa.RecordBatch.from_arrays([pa.array([rows[0][1]] * len(hit), pa.int64()), pa.array(hit, pa.int64())], names=["p", "key"])

    data = sigs.select("key", "n", F.lit(0).alias("need"), F.col("sig").alias("data"))
    return _met(blocks, data, run, "p long, key long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2, percent: int = 80,
                    bands: int = 48, rows: int = 6, miss: float = 1e-9, seed: int = 11) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id reachable by links of similarity ``percent``
    / 100 or more, itself included; kept tells whether that is the document's own. Links
    are exact on the full sets; a linked pair is missed with probability (1 - s^rows)^bands
    by the bands, and a few times ``miss`` per signature batch at the very threshold. A document without words (or NULL
    text) has an empty set and is its own component. Repeated rows stay repeated. A NULL
    doc_id takes part, never names a component unless no member has an id, and has a NULL
    ``kept``. An empty table gives no rows. Other columns are ignored.
    """
    if bands * rows % 8:
        raise ValueError("bands * rows must be a multiple of 8")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    run, schema = _entities("text", size, lambda: Signer(bands, rows, seed))
    entities = stored(narrow.mapInArrow(lean(run), schema), "minhash-sets")
    steps = least_agreements(bands * rows, percent, miss)

    named = entities.where("sig is not null").select("key", F.explode("bands").alias("band"))
    pivots = named.groupBy("band").agg(F.min("key").alias("p"), F.max("key").alias("last")).where("p < last").select("band", "p")
    family = stored(named.join(pivots, "band").where("key <> p").groupBy("p", "key").agg(F.count("*").alias("votes")), "minhash-families")
    wanted = family.select(F.explode(F.array("p", "key")).alias("key")).distinct()
    sigs = stored(entities.where("sig is not null").select("key", "n", "sig").join(wanted, "key", "left_semi")
                  .dropDuplicates(["key"]), "minhash-signatures")
    sets = stored(_sets_of(narrow, entities, wanted, size), "minhash-full")

    def verified(pairs):
        return _verified(_likely(pairs.select(F.col("key").alias("a"), F.col("p").alias("b")), sigs, steps, percent), sets, percent)

    # a member meets the pivot it shares most bands with, then the pivots that are in other components then
    near = family.groupBy("key").agg(F.max_by("p", F.struct("votes", "p")).alias("p")).select("p", "key")
    near = stored(near, "minhash-pairs")
    links = stored(verified(near), "minhash-links")
    comp = connected_components(links)
    placed = stored(_with_components(family, comp), "minhash-placed")
    more = stored(verified(placed.where("of_p <> of_key").select("p", "key").join(near, ["p", "key"], "left_anti")), "minhash-links")

    # members that did not link meet the other members; those in their pivot's component don't meet each other
    hits = more.select(F.col("b").alias("p"), F.col("a").alias("key"), F.lit(True).alias("hit"))
    inside = placed.join(hits, ["p", "key"], "left").select(
        "p", "key", (F.coalesce("hit", F.lit(False)) | (F.col("of_p") == F.col("of_key"))).alias("linked"))
    inside = stored(inside, "minhash-placed")
    likely = _promising(_blocks(inside), sigs, steps, percent).join(inside, ["p", "key"])
    rest = _linked(_blocks(likely.select("p", "key", "linked")), sets, percent)
    return _named(entities, connected_components(stored(links.union(more).union(rest), "minhash-links")))


def _with_components(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs (p, key) with their components; a set without links is its own."""
    of_p = comp.select(F.col("node").alias("p"), F.col("component").alias("cp"))
    of_key = comp.select(F.col("node").alias("key"), F.col("component").alias("ck"))
    return pairs.join(of_p, "p", "left").join(of_key, "key", "left").select(
        "p", "key", F.coalesce("cp", "p").alias("of_p"), F.coalesce("ck", "key").alias("of_key"))


def _sets_of(narrow: DataFrame, entities: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """(key, tokens) of ``keys``, from one document that holds each set."""
    holder = entities.join(keys, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    run, schema = _full_sets("text", size)
    texts = narrow.where("doc_id is not null").join(holder.select("doc_id").distinct(), "doc_id", "left_semi").union(
        narrow.where("doc_id is null"))  # these have no other name
    return texts.select("text").mapInArrow(lean(run), schema).join(keys, "key", "left_semi").dropDuplicates(["key"])


def _named(entities: DataFrame, comp: DataFrame) -> DataFrame:
    own = entities.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("own"))
    group = own.join(comp.withColumnRenamed("node", "key"), "key", "left").select("key", "own", F.coalesce("component", "key").alias("g"))
    ids = group.groupBy("g").agg(F.min("own").alias("component_id"))
    by_key = group.join(ids, "g").select("key", "component_id")
    component = F.coalesce("component_id", "doc_id")
    return entities.select("doc_id", "key", F.col("n").alias("n_shingles")).join(by_key, "key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def op11_query(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir))


# All shared shingles counted, then components by recursion over the links (both directions).
OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
      ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN m ON m.x = w.doc_id
"""
