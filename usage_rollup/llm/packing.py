"""Operator 7: best-fit packing by bin completion branch-and-bound.

Documents are tokenised, longer ones cut into pieces of ``capacity`` tokens
(the first piece may be shorter), and pieces packed into as few sequences as
possible. Piece lengths are whole numbers up to ``capacity``, so the problem is
a histogram of at most ``capacity`` rows whatever the corpus size. The solver
works on that histogram: around the largest remaining length it enumerates
undominated fillings (fewer, larger pieces first, least waste first), applies a
filling as often as the counts allow, and branches on the alternatives; a branch
whose waste exceeds what the incumbent leaves is pruned. The best-fit-decreasing
solution is the first incumbent. The plan (at most a few fillings per length)
then maps (length, rank among equal lengths) to (sequence, offset); ranks come
from salted counts, so a length that a third of all pieces share is split.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, lean, stored

CAPACITY = 2048
#: Search effort: fillings tried beyond the first descent.
MAX_NODES = 4000
SALTS = 1024


# --- tokenising ---------------------------------------------------------------------


class ByteBpe:
    """Ids of the byte-level BPE vocabulary.

    The vocabulary file of ``tokenizers`` gives the merges' ranks; ``tiktoken``
    applies them (same ids, faster), to a whole text at once: a cache of words in
    Python takes longer than it saves, and memory.
    """

    def __init__(self, ranks_path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), np.uint32)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


PIECES = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long"


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 end_id: int = 0, ranks_path: str | None = None) -> DataFrame:
    """Pieces of the documents: ids are little-endian unsigned 32-bit numbers."""

    def run(batches):
        bpe = ByteBpe(ranks_path or default_ranks())
        names = ["doc_id", "piece", "start", "length", "ids", "ids_crc32"]
        for b in batches:
            rows, held = [], 0
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(bpe.encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                head = len(ids) % capacity or capacity
                cuts = [0, *range(head, len(ids) + 1, capacity)]
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[lo:hi].tobytes()
                    rows.append((doc_id, k, lo, hi - lo, part, zlib.crc32(part)))
                held += len(ids)
                if held > 250_000:
                    yield _batch(rows, names)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, names)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(lean(run), PIECES)


def _batch(rows, names):
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


# --- the solver ---------------------------------------------------------------------


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Fillings with multiplicities: largest length first, each gap filled by the largest piece that fits."""
    c, plan = counts.copy(), []
    top = int(np.max(np.flatnonzero(c), initial=0))
    while top:
        fill, gap, at = {}, capacity, top
        while at:
            take = min(int(c[at]), gap // at)
            if take:
                fill[at] = take
                gap -= take * at
            at = _largest(c, min(at - 1, gap))
        times = min(int(c[s]) // k for s, k in fill.items())
        for s, k in fill.items():
            c[s] -= times * k
        plan.append((fill, times))
        top = _largest(c, top)
    return plan


def _largest(c: np.ndarray, upto: int) -> int:
    if upto <= 0:
        return 0
    found = np.flatnonzero(c[1:upto + 1])
    return int(found[-1]) + 1 if len(found) else 0


def fillings(c: np.ndarray, gap: int, most: int = 4) -> list[tuple[int, dict[int, int]]]:
    """Undominated completions (waste, pieces) of a gap, best first.

    One piece, then the best pairs, then triples: a filling with more pieces is
    kept only if it wastes less than those with fewer, larger ones; what is left
    of the gap after three pieces is filled greedily.
    """
    found: list[tuple[int, dict[int, int]]] = []
    one = _largest(c, gap)
    if not one:
        return [(gap, {})]
    size = np.arange(gap + 1)
    below = np.maximum.accumulate(np.where(c[:gap + 1] > 0, size, 0))

    def pairs(room: int, upto: int, used: int | None):
        a = np.flatnonzero(c[:min(room, upto) + 1])
        a = a[a > 0]
        if used is not None and c[used] < 2:
            a = a[a != used]
        if not len(a):
            return None
        b = np.minimum(below[room - a], a)
        b = np.where((b > 0) & (c[np.maximum(b, 0)] <= (b == a) + (0 if used is None else (b == used))), 0, b)
        b = np.where((b > 0) & (c[b] == 0), 0, b)
        waste = room - a - b
        k = len(a) - 1 - int(np.argmin(waste[::-1]))
        return int(waste[k]), int(a[k]), int(b[k])

    def add(pieces):
        fill: dict[int, int] = {}
        for p in pieces:
            if p:
                fill[p] = fill.get(p, 0) + 1
        room = gap - sum(p * k for p, k in fill.items())
        at = _largest(c, room)
        while at:
            take = min(int(c[at]) - fill.get(at, 0), room // at)
            if take > 0:
                fill[at] = fill.get(at, 0) + take
                room -= take * at
            at = _largest(c, min(at - 1, room))
        if all(c[s] >= k for s, k in fill.items()) and all(fill != f for _, f in found):
            found.append((room, fill))

    add([one])
    if found and found[0][0] == 0:
        return found
    two = pairs(gap, gap, None)
    if two:
        add(two[1:])
    if min(w for w, _ in found) > 0:
        best = None
        for a in np.flatnonzero(c[:gap])[::-1][:64]:
            if a and (three := pairs(gap - int(a), int(a), int(a))) and (best is None or three[0] < best[0]):
                best = (three[0], int(a), *three[1:])
                if best[0] == 0:
                    break
        if best:
            add(best[1:])
    return sorted(found, key=lambda f: (f[0], sum(f[1].values())))[:most]


def bin_completion(counts: np.ndarray, capacity: int = CAPACITY, max_nodes: int = MAX_NODES):
    """(plan, bins): fillings with multiplicities that use up ``counts[length]``."""
    total = int((np.arange(len(counts)) * counts).sum())
    bound = -(-total // capacity)
    best = best_fit_decreasing(counts, capacity)
    best_bins = sum(t for _, t in best)
    nodes = 0
    stack = [(counts.copy(), [], 0, 0)]
    while stack and best_bins > bound and nodes < max_nodes:
        c, plan, bins, waste = stack.pop()
        while True:
            allowed = (best_bins - 1) * capacity - total
            if waste > allowed:
                break
            top = _largest(c, capacity)
            if not top:
                best, best_bins = plan, bins
                break
            nodes += 1
            c[top] -= 1
            options = fillings(c, capacity - top)
            c[top] += 1
            states = []
            for lost, fill in options:
                fill = dict(fill)
                fill[top] = fill.get(top, 0) + 1
                times = min(int(c[s]) // k for s, k in fill.items())
                if lost and waste + lost * times > allowed:
                    continue
                states.append((lost, fill, times))
            if not states:
                break
            for lost, fill, times in states[:0:-1]:
                d = c.copy()
                for s, k in fill.items():
                    d[s] -= k * times
                stack.append((d, [*plan, (fill, times)], bins + times, waste + lost * times))
            del stack[:-256]
            lost, fill, times = states[0]
            for s, k in fill.items():
                c[s] -= k * times
            plan, bins, waste = [*plan, (fill, times)], bins + times, waste + lost * times
    return best, best_bins


def plan_slots(plan) -> np.ndarray:
    """Columns (length, first rank, copies per sequence, first sequence, offset), sorted by length and rank."""
    used: dict[int, int] = {}
    rows, seq = [], 0
    for fill, times in plan:
        offset = 0
        for s in sorted(fill, reverse=True):
            rows.append((s, used.get(s, 0), fill[s], seq, offset))
            used[s] = used.get(s, 0) + fill[s] * times
            offset += s * fill[s]
        seq += times
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = 0, ranks_path: str | None = None, max_nodes: int = MAX_NODES) -> DataFrame:
    """All pieces of ``docs`` with their place (see ``place_pieces``).

    NULL and empty texts give a piece that holds the end id alone. Rows with a
    NULL or repeated doc_id are packed like any other, columns other than the two
    named ones are ignored. An empty table gives no rows.
    """
    pieces = stored(token_pieces(docs, id_col, text_col, capacity, end_id, ranks_path), "pack-pieces")
    return place_pieces(pieces, capacity, max_nodes)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, max_nodes: int = MAX_NODES) -> DataFrame:
    """Rows of ``pieces`` (a stored ``token_pieces`` table) with sequence_id and offset, without their ids;
    ``packed_sequences`` joins the ids to the places."""
    spark = pieces.sparkSession
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    slots = plan_slots(bin_completion(counts, capacity, max_nodes)[0])
    keys = spark.sparkContext.broadcast((slots[:, 0] << 40 | slots[:, 1], slots))

    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    by_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("m"))
    before = by_salt.select("length", "salt", (F.sum("m").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("m")).alias("before"))
    ranked = (salted.withColumn("r", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")))
        .join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("r") - 1))

    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches):
        key, slot = keys.value
        for b in batches:
            length, rank = (b.column(x).to_numpy(zero_copy_only=False) for x in ("length", "rank"))
            s = slot[np.searchsorted(key, length << 40 | rank, side="right") - 1]
            r = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), pa.array(s[:, 3] + r // s[:, 2]), pa.array(s[:, 4] + r % s[:, 2] * length)],
                                             names=[*cols, "sequence_id", "offset"])

    return ranked.select(*cols, "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def packed_sequences(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """sequence_id and its token ids (array<long>), for ``placed`` rows with unique (doc_id, piece)."""
    return (placed.join(pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"]).groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.transform("parts", lambda p: p["ids"]).alias("parts")))


def op7_query(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
