"""Operator 10: n-gram Jaccard self-join with token-combination prefixes.

A document's set holds its distinct word shingles. Two sets link when their
Jaccard similarity reaches ``percent`` / 100. A set of n shingles may lose
``e = n - ceil(percent * n / 100)`` of them to a partner, so in one global
token order (rare tokens first, by hash; frequent ones after, by count) a
prefix that stays connected after any ``e`` losses must meet the partner's:

* *rare* tokens are indexed singly. A prefix of ``e + l`` rare tokens meets
  the partner's in at least ``l`` tokens (``l`` = 1 + n // 25), which the
  candidate filter checks on the small signature lists alone.
* *frequent* tokens fall into hash classes; a class with c prefix tokens keeps
  a common pair unless c - 1 are lost, so the prefix is extended until
  ``sum(max(0, c - 1))`` covers the losses and token *pairs* of each class are
  indexed. The number of classes depends on the size band (64, 256, ...), and a
  set near a band's lower bound is indexed in the band below as well.

Candidates share a signature; equal sets are collapsed first. A signature group
does not emit its pairs. Its first member is its pivot, and the sets that share a
signature with a pivot form the pivot's family. Members that link with the pivot
are one component; the others meet all members in blocks of bounded size, where
products of 0/1 matrices give the overlaps of all pairs at once and one edge a
linked member leaves the block. Members without a likely partner by their
signature lists are left out before full sets are sent. Verification is exact on
the full sets.

Shingles and sets are represented by 64-bit hashes (sets by the sum of mixed
shingle hashes).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .common import connected_components, documents, lean, stored

MIN_FREQUENT = 64
#: Largest number of tokens held as frequent, hence broadcast (8 bytes each).
#: Any other token is indexed as a rare one, so the bound changes no result.
MAX_FREQUENT = 1 << 18
#: Bits of the broadcast filter for sets to verify; a fuller filter passes more sets.
FILTER_BITS = 1 << 23
#: Sets per side of a block of comparisons.
BUCKET = 256
_FLUSH = 4_000_000
_KEY = np.uint64(0xD6E8FEB86659FD93)


def _sets(batches, text, size):
    """Yields (batch, row, sorted distinct shingles, key)."""
    for batch in batches:
        for i, h in ta.text_rows(batch, text, ta.LOWER_WORDS, size):
            if len(h):
                h = np.sort(h)
                h = h[np.concatenate([[True], h[1:] != h[:-1]])]
                yield batch, i, h, int(ta.mix(h ^ _KEY).sum().view(np.int64))
            else:
                yield batch, i, h, None


def _as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _entities(id_col, text, size):
    """One row per document (kind 0) and per token seen twice or more in a task's distinct sets (kind 1)."""
    schema = "kind int, doc_id long, key long, n long"

    def flush(held):
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        hot = counts > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(hot.sum(), np.int32)), pa.nulls(int(hot.sum()), pa.int64()), _as_long(tokens[hot]),
             pa.array(counts[hot].astype(np.int64))], names=["kind", "doc_id", "key", "n"])

    def run(batches):
        seen, held, count = set(), [], 0
        for batch in batches:
            keys, ns = [], []
            for _, _, h, key in _sets([batch], text, size):
                keys.append(key)
                ns.append(len(h))
                if key is not None and key not in seen:
                    seen.add(key)
                    held.append(h)
                    count += len(h)
                    if count > _FLUSH:
                        yield flush(held)
                        seen, held, count = set(), [], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(keys), np.int32)), batch.column(id_col).cast(pa.int64()),
                 pa.array(keys, pa.int64()), pa.array(ns, pa.int64())], names=["kind", "doc_id", "key", "n"])
        if held:
            yield flush(held)

    return run, schema


def _losses(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100


def _bands(n: int, percent: int) -> list[int]:
    """Lower bounds of the size bands that a set of n shingles is indexed in."""
    low = 4
    while low * 4 <= n and low < 1 << 20:
        low *= 4
    low = max(low, 16) if n >= 16 else 4
    return [low, low // 4] if low > 4 and percent * n < 100 * low else [low]


def signatures_of(h: np.ndarray, is_frequent: np.ndarray, order: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """(signatures, how many a linked partner must share) of one sorted set.

    ``order`` ranks its frequent tokens (count, hash). A need of 0 marks a set
    with frequent tokens in its prefix: it asks for one shared signature only.
    """
    n = len(h)
    e = _losses(n, percent)
    rare = h[~is_frequent]
    extra = 1 + n // 25
    if len(rare) >= e + extra:
        return rare[:e + extra], extra
    common = h[is_frequent][order]
    out = [rare]
    for low in _bands(n, percent):
        m = max(1, low // 16)
        cls = (common >> np.uint64(40)).astype(np.int64) % m
        # within a class the second and each later token covers one loss
        rank = np.zeros(len(common), np.int64)
        by = np.argsort(cls, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], cls[by][1:] != cls[by][:-1]])) if len(by) else by
        rank[by] = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by)))) if len(by) else 0
        cover = len(rare) + np.cumsum(rank > 0)
        end = int(np.searchsorted(cover, e + 1)) + 1 if len(cover) and cover[-1] >= e + 1 else len(common)
        for c in np.unique(cls[:end]):
            t = np.sort(common[:end][cls[:end] == c])
            i, j = np.triu_indices(len(t), 1)
            out.append(ta.mix(t[i] * np.uint64(3) + ta.mix(t[j]) + np.uint64(low)))
    return np.concatenate(out), 0


def _signatures(text, size, percent, frequent):
    def run(batches):
        order = frequent.value  # tokens by rising count, then hash
        where = np.argsort(order, kind="stable")
        tokens = order[where]
        seen: set = set()
        sigs, keys, ns, needs, held = [], [], [], [], 0

        def batch_out():
            return pa.RecordBatch.from_arrays(
                [_as_long(np.concatenate(sigs)), pa.array(np.concatenate(keys)),
                 pa.array(np.concatenate(ns)), pa.array(np.concatenate(needs))], names=["sig", "key", "n", "need"])

        for _, _, h, key in _sets(batches, text, size):
            if len(h) < 4 or key in seen:  # below 4 shingles only equal sets link
                continue
            if len(seen) > 1_000_000:
                seen.clear()
            seen.add(key)
            if len(tokens):
                at = np.minimum(np.searchsorted(tokens, h), len(tokens) - 1)
                is_frequent = tokens[at] == h
                rank = np.argsort(where[at[is_frequent]])
            else:
                is_frequent, rank = np.zeros(len(h), bool), np.zeros(0, np.int64)
            s, need = signatures_of(h, is_frequent, rank, percent)
            sigs.append(s)
            keys.append(np.full(len(s), key, np.int64))
            ns.append(np.full(len(s), len(h), np.int32))
            needs.append(np.full(len(s), need, np.int32))
            held += len(s)
            if held > 200_000:
                yield batch_out()
                sigs, keys, ns, needs, held = [], [], [], [], 0
        if held:
            yield batch_out()

    return run, "sig long, key long, n int, need int"


def _full_sets(text, size, wanted):
    """(key, set) of documents that the bit filter passes, once per key and task."""

    def run(batches):
        bits = wanted.value
        seen: set = set()
        keys, sets, held = [], [], 0
        for _, _, h, key in _sets(batches, text, size):
            if key is None or key in seen or not _passes(bits, key):
                continue
            if len(seen) > 1_000_000:
                seen.clear()
            seen.add(key)
            keys.append(key)
            sets.append(h.tobytes())
            held += len(h)
            if held > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())],
                                                 names=["key", "tokens"])
                keys, sets, held = [], [], 0
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())],
                                             names=["key", "tokens"])

    return run, "key long, tokens binary"


def _passes(bits: np.ndarray, key: int) -> bool:
    p = key % FILTER_BITS
    return bool((int(bits[p >> 6]) >> (p & 63)) & 1)


def _bit_filter(keys: DataFrame) -> np.ndarray:
    """Bits of ``key mod FILTER_BITS``: FILTER_BITS / 64 words at most reach the driver."""
    p = F.pmod(F.col("key"), F.lit(FILTER_BITS))
    rows = (keys.select((p / 64).cast("long").alias("w"), (p % 64).cast("int").alias("b"))
            .select("w", F.expr("shiftleft(1L, b)").alias("m")).groupBy("w").agg(F.bit_or("m").alias("m")).toArrow())
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[rows["w"].to_numpy()] = rows["m"].to_numpy()
    return bits.view(np.uint64)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets link."""

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = (pairs.join(sets.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a")
            .join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b"))
    return full.mapInArrow(run, "a long, b long")


def _likely(pairs: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that pass the size filter and share as many signatures as a link needs."""
    x = lists.select(F.col("key").alias("a"), F.col("sigs").alias("sa"), F.col("n").alias("na"), F.col("need").alias("ka"))
    y = lists.select(F.col("key").alias("b"), F.col("sigs").alias("sb"), F.col("n").alias("nb"), F.col("need").alias("kb"))
    need = (F.when((F.col("ka") > 0) & (F.col("kb") > 0), F.least("ka", "kb"))
            .otherwise(F.greatest("ka", "kb", F.lit(1))))
    return (pairs.join(x, "a").join(y, "b")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
            .where(F.size(F.array_intersect("sa", "sb")) >= need).select("a", "b"))


# --- families, compared in blocks ------------------------------------------------------


def _blocks(family: DataFrame) -> DataFrame:
    """(p, key, block, side) of the blocks in which members of family ``p`` meet.

    Open members fall into buckets of about BUCKET, and so do the ones known to
    link with p (``linked``); every pair of buckets that has open members is a
    block. Linked members never meet each other: they are in one component.
    """
    sizes = family.groupBy("p").agg(F.count(F.when(~F.col("linked"), 1)).alias("u"), F.count(F.when(F.col("linked"), 1)).alias("l"))
    count = lambda c: F.ceil(F.col(c) / BUCKET).cast("int")
    rows = family.join(sizes.select("p", count("u").alias("nu"), count("l").alias("nl")).where("nu > 0 and nu + nl > 0"), "p")
    own = F.when(F.col("linked"), F.col("nu") + F.pmod(F.xxhash64("key"), F.greatest("nl", F.lit(1)))).otherwise(
        F.pmod(F.xxhash64("key"), F.greatest("nu", F.lit(1)))).cast("int")
    upto = F.when(F.col("linked"), F.col("nu")).otherwise(F.col("nu") + F.col("nl"))
    met = rows.withColumn("own", own).withColumn("t", F.explode(F.sequence(F.lit(0), upto - 1)))
    return met.select("p", "key", F.xxhash64("p", F.least("own", "t"), F.greatest("own", "t")).alias("block"),
                      F.when(F.col("own") == F.col("t"), 2).otherwise((F.col("own") > F.col("t")).cast("int")).alias("side"))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all left with all right sets, by products of 0/1 matrices over token slices."""
    out = np.zeros((len(left), len(right)), np.float32)
    if len(left) * len(right) <= 4:
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                out[i, j] = len(np.intersect1d(x, y, assume_unique=True))
        return out
    sets = [*left, *right]
    tokens, at = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(at, minlength=len(tokens)) > 1
    col = np.cumsum(shared) - 1
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    keep = shared[at]
    row, col = row[keep], col[at[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    width = 1 << 13
    for lo in range(0, int(shared.sum()), width):
        i, j = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((len(sets), width), np.float32)
        m[row[i:j], col[i:j] - lo] = 1
        out += m[:len(left)] @ m[len(left):].T
    return out


def _by_block(batches):
    """Yields the rows of one block at a time from batches sorted by block."""
    held: list = []
    for b in batches:
        for row in zip(*(b.column(c) for c in ("block", "side", "p", "key", "n", "need", "data"))):
            block = row[0].as_py()
            if held and held[0] != block:
                yield held[1]
                held = []
            if not held:
                held = [block, []]
            held[1].append((row[1].as_py(), row[2].as_py(), row[3].as_py(), row[4].as_py(), row[5].as_py(),
                            np.frombuffer(row[6].as_buffer(), np.uint64)))
    if held:
        yield held[1]


def _compare(rows, percent, exact):
    """(left rows, right rows, matrix of the pairs that pass) of one block."""
    left = [r for r in rows if r[0] != 1]
    right = [r for r in rows if r[0] != 0]
    if not left or not right:
        return left, right, np.zeros((len(left), len(right)), bool)
    both = _overlaps([r[5] for r in left], [r[5] for r in right])
    n, m = np.array([r[3] for r in left])[:, None], np.array([r[3] for r in right])[None, :]
    if exact:
        good = 100 * both >= percent * (n + m - both)
    else:
        k, q = np.array([r[4] for r in left])[:, None], np.array([r[4] for r in right])[None, :]
        need = np.where((k > 0) & (q > 0), np.minimum(k, q), np.maximum(np.maximum(k, q), 1))
        good = (both >= need) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
    same = np.array([r[2] for r in left])[:, None] == np.array([r[2] for r in right])[None, :]
    return left, right, good & ~same


def _met(blocks: DataFrame, data: DataFrame, run, schema: str) -> DataFrame:
    rows = blocks.join(data, "key").select("block", "side", "p", "key", "n", "need", "data")
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, schema)


def _promising(blocks: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """(p, key) of the members that have a likely partner in a block, by their signature lists."""

    def pack(batches):
        for b in batches:
            data = [np.asarray(v.values, np.int64).tobytes() for v in b.column("sigs")]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("n"), b.column("need"), pa.array(data, pa.binary())],
                                             names=["key", "n", "need", "data"])

    def run(batches):
        ps, keys = [], []
        for rows in _by_block(batches):
            left, right, good = _compare(rows, percent, exact=False)
            hit = {r[2] for r, g in zip(left, good.any(axis=1)) if g} | {r[2] for r, g in zip(right, good.any(axis=0)) if g}
            ps += [rows[0][1]] * len(hit)
            keys += hit
            if len(keys) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array(keys, pa.int64())], names=["p", "key"])
                ps, keys = [], []
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array(keys, pa.int64())], names=["p", "key"])

    packed = lists.mapInArrow(pack, "key long, n int, need int, data binary")
    return _met(blocks, packed, run, "p long, key long").distinct()


def _linked(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect what links in a block: each member with the smallest key it reaches there."""

    def run(batches):
        a, b = [], []
        for rows in _by_block(batches):
            left, right, good = _compare(rows, percent, exact=True)
            root: dict[int, int] = {}

            def find(x):
                while root.get(x, x) != x:
                    root[x] = root.get(root[x], root[x])
                    x = root[x]
                return x

            for i, j in zip(*np.nonzero(good)):
                x, y = find(left[i][2]), find(right[j][2])
                root[max(x, y)] = min(x, y)
            for x in {r[2] for r in rows}:
                if find(x) != x:
                    a.append(x)
                    b.append(find(x))
            if len(a) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    data = sets.select("key", F.col("tokens").alias("data"), (F.octet_length("tokens") / 8).cast("int").alias("n"), F.lit(0).alias("need"))
    return _met(blocks, data, run, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                       percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    component_id is the smallest doc_id reachable by links, itself included;
    equal sets are linked. A document without words (or NULL text) has an empty
    set and links with nothing, its component is its own doc_id. Repeated rows
    stay repeated; a NULL doc_id takes part and never names a component unless
    no member has an id. Other columns are ignored.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    run, schema = _entities("doc_id", "text", size)
    first = stored(narrow.mapInArrow(lean(run), schema), "jaccard-entities")
    entities = first.where("kind = 0").select("doc_id", "key", "n")
    frequent = (first.where("kind = 1").groupBy("key").agg(F.sum("n").alias("df")).where(F.col("df") >= MIN_FREQUENT)
                .orderBy(F.desc("df"), "key").limit(MAX_FREQUENT).toArrow())
    order = frequent["key"].to_numpy().view(np.uint64)
    df = frequent["df"].to_numpy()
    order = order[np.lexsort((order, df))]

    run, schema = _signatures("text", size, percent, spark.sparkContext.broadcast(order))
    sigs = narrow.select("text").mapInArrow(lean(run), schema)
    groups = sigs.groupBy("sig").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("sig")
    shared = stored(sigs.join(groups, "sig").distinct(), "jaccard-signatures")
    lists = stored(shared.groupBy("key").agg(F.sort_array(F.collect_list("sig")).alias("sigs"), F.max("n").alias("n"),
                                             F.max("need").alias("need")), "jaccard-lists")
    # a family: all sets that share a signature with its pivot, which leads the signature's group
    pivots = shared.groupBy("sig").agg(F.expr("min_by(key, xxhash64(key))").alias("p"))
    family = stored(shared.select("sig", "key").join(pivots, "sig").select("p", "key").distinct(), "jaccard-families")
    to_pivot = stored(_likely(family.where("p <> key").select(F.col("key").alias("a"), F.col("p").alias("b")), lists, percent), "jaccard-likely")
    found = _promising(_blocks(family.withColumn("linked", F.lit(False))), lists, percent)
    family = stored(found, "jaccard-families")
    wanted = spark.sparkContext.broadcast(_bit_filter(family.select("key").union(to_pivot.selectExpr("explode(array(a, b))"))))
    run, schema = _full_sets("text", size, wanted)
    sets = stored(narrow.select("text").mapInArrow(lean(run), schema).dropDuplicates(["key"]), "jaccard-sets")
    first = stored(_verified(to_pivot, sets, percent), "jaccard-pivots")
    hits = first.select(F.col("b").alias("p"), F.col("a").alias("key"), F.lit(True).alias("hit"))
    family = family.join(hits, ["p", "key"], "left").select(
        "p", "key", (F.coalesce("hit", F.lit(False)) | (F.col("key") == F.col("p"))).alias("linked"))
    comp = connected_components(stored(first.union(_linked(_blocks(family), sets, percent)), "jaccard-links"))

    named = entities.join(comp.withColumnRenamed("node", "key"), "key", "left").select(
        "doc_id", "key", "n", F.coalesce("component", "key").alias("component"))
    ids = named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(ids, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without near duplicates: of each component the row of the smallest
    id stays, with all its columns. Documents without words all stay, and so
    do rows without an id. Of repeated rows with that id one stays."""
    links = jaccard_components(docs, id_col, text_col, **options)
    drop = links.where("n_shingles > 0 and component_id <> doc_id").select(F.col("doc_id").alias("_dropped")).distinct()
    key, text = docs[id_col].cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = docs.join(drop, key == drop["_dropped"], "left_anti")
    words = F.rlike(text, F.lit(r"[^\x20\x09-\x0D]"))
    once = kept.where(words & F.col(id_col).isNotNull()).dropDuplicates([id_col, text_col])
    return once.unionByName(kept.where(~words | F.col(id_col).isNull()))


def op10_query(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir))


# All shared shingles counted, then components by recursion over the links (both directions).
OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) m ON m.x = w.doc_id
"""
