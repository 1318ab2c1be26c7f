"""Operator 6: SentencePiece encoding with the N best segmentations, and decoding.

The piece lattice of a text has its characters' boundaries as nodes and the
vocabulary's pieces as edges. Forward Viterbi scores are exact costs-to-go for a
search that runs backward from the end, so A-star pops the segmentations in order
of score. No piece of the vocabulary crosses from a word into the space before the
next one, so the lattice falls into units (a run of spaces and the word after it),
and the same units recur: numpy runs Viterbi over the distinct units of a chunk of
texts at once, and A-star only visits the units that a text's N best can change:
those N - 1 with the smallest gap between their two best segmentations.

Scores are sums of the vocabulary's own piece scores. A character without a piece
of its own is an edge with a penalty and encodes to byte pieces. In a BPE vocabulary
the scores are the ranks of its merges, so the best segmentation is the one of
largest sum of ranks: it is exact for these scores, but not the one that applying the merges
in turn gives. A unigram vocabulary's scores are log-probabilities, and there it is.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .common import documents, lean

N_BEST = 3
#: Rows handed on at once.
ROWS = 1000
#: Bytes of text segmented at once (its lattice edges take some 200 times as much).
CHUNK = 1 << 19
_UNKNOWN_PENALTY = 10.0


class Pieces:
    """Vocabulary as a byte trie; the space mark is held as the byte of a space."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.path = path or public_tokenizers.path("piece_bpe_32k.model")
        self.sp = sentencepiece.SentencePieceProcessor(model_file=self.path)
        n = self.sp.get_piece_size()
        self.score = np.array([self.sp.get_score(i) for i in range(n)])
        self.byte_ids = np.zeros(256, np.int64)
        kids: list[dict[int, int]] = [{}]
        ids = [-1]
        crosses = False
        self.length = np.zeros(n, np.int64)
        for i in range(n):
            if self.sp.is_byte(i):
                self.byte_ids[int(self.sp.id_to_piece(i)[3:-1], 16)] = i
                continue
            if self.sp.is_control(i) or self.sp.is_unknown(i):
                continue
            text = self.sp.id_to_piece(i).replace("▁", " ")
            crosses |= " " in text.lstrip(" ")
            at = 0
            raw = text.encode()
            self.length[i] = len(raw)
            for b in raw:
                if b not in kids[at]:
                    kids[at][b] = len(kids)
                    kids.append({})
                    ids.append(-1)
                at = kids[at][b]
            ids[at] = i
        if crosses:
            raise ValueError("a piece holds a space after other characters; the lattice can't be cut into words")
        self.next = np.zeros((len(kids), 256), np.int32)
        for s, k in enumerate(kids):
            for b, t in k.items():
                self.next[s, b] = t
        self.id = np.array(ids, np.int64)
        self.unknown = float(self.score.min()) - _UNKNOWN_PENALTY

    def edges(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(unit, start, end, id) of all lattice edges; id -1 is a character without a piece."""
        size = ends - starts
        unit = np.repeat(np.arange(len(starts)), size)
        pos = np.arange(len(unit)) - np.repeat(np.cumsum(size) - size, size)
        byte = buf[np.repeat(starts, size) + pos]
        head = (byte & 0xC0) != 0x80
        unit, pos = unit[head], pos[head]
        width = np.select([byte[head] < 0x80, byte[head] < 0xE0, byte[head] < 0xF0], [1, 2, 3], 4)
        state, act, out = np.zeros(len(unit), np.int32), np.arange(len(unit)), []
        single = np.zeros(len(unit), bool)
        depth = 0
        while len(act):
            at = pos[act] + depth
            ok = at < size[unit[act]]
            act, state, at = act[ok], state[ok], at[ok]
            state = self.next[state, buf[starts[unit[act]] + at]]
            ok = state > 0
            act, state = act[ok], state[ok]
            depth += 1
            got = self.id[state] >= 0
            hit = act[got]
            out.append((unit[hit], pos[hit], pos[hit] + depth, self.id[state[got]]))
            single[hit[width[hit] == depth]] = True
        lone = np.flatnonzero(~single)
        out.append((unit[lone], pos[lone], pos[lone] + width[lone], np.full(len(lone), -1)))
        return tuple(np.concatenate(x) for x in zip(*out))

    def viterbi(self, buf, starts, ends):
        """Of each unit: best score, gap to the second best (inf if none), ids (ragged: values, first)."""
        size = ends - starts
        base = np.concatenate([[0], np.cumsum(size + 1)])
        u, s, e, pid = self.edges(buf, starts, ends)
        score = np.where(pid >= 0, self.score[pid], self.unknown)
        src, dst = base[u] + s, base[u] + e
        order = np.lexsort((s, dst, e))  # by end position, so that sources are done; longer pieces first
        src, dst, score, pid, e = src[order], dst[order], score[order], pid[order], e[order]
        alpha = np.full(base[-1], -np.inf)
        alpha[base[:-1]] = 0
        best_edge = np.full(base[-1], -1)
        second = np.full(base[-1], np.inf)  # smallest regret of another edge into the node
        cuts = np.searchsorted(e, np.arange(1, (int(size.max()) if len(size) else 0) + 2))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if lo == hi:
                continue
            value = alpha[src[lo:hi]] + score[lo:hi]
            node = dst[lo:hi]
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            top = np.maximum.reduceat(value, first)
            alpha[node[first]] = top
            count = np.diff(np.append(first, hi - lo))
            regret = np.repeat(top, count) - value
            pick = np.where(regret == 0, np.arange(hi - lo), hi - lo)
            chosen = np.minimum.reduceat(pick, first)
            best_edge[node[first]] = lo + chosen
            regret[chosen] = np.inf
            second[node[first]] = np.minimum.reduceat(regret, first)
        # walk back from every unit's end
        at, live = base[1:] - 1, np.arange(len(starts))
        live = live[size > 0]
        at = at[size > 0]
        gap = np.full(len(starts), np.inf)
        steps = []
        while len(live):
            gap[live] = np.minimum(gap[live], second[at])
            edge = best_edge[at]
            steps.append((live, edge))
            at = src[edge]
            more = at > base[live]
            live, at = live[more], at[more]
        if steps:
            unit = np.concatenate([x for x, _ in steps])
            edge = np.concatenate([x for _, x in steps])
            order = np.lexsort((-np.concatenate([np.full(len(x), k) for k, (x, _) in enumerate(steps)]), unit))
            unit, edge = unit[order], edge[order]
        else:
            unit = edge = np.zeros(0, np.int64)
        ids = pid[edge] if len(edge) else np.zeros(0, np.int64)
        if (ids < 0).any():  # spell out characters without a piece
            span = e[edge] - (src[edge] - base[unit])
            reps = np.where(ids < 0, span, 1)
            first = np.repeat(np.cumsum(reps) - reps, reps)
            inner = np.arange(reps.sum()) - first
            where = np.repeat(starts[unit] + src[edge] - base[unit], reps) + inner
            spelled = np.repeat(ids, reps)
            spelled = np.where(spelled < 0, self.byte_ids[buf[where]], spelled)
            unit, ids = np.repeat(unit, reps), spelled
        return alpha[base[1:] - 1], gap, ids, np.searchsorted(unit, np.arange(len(starts) + 1))

    def n_best(self, unit: bytes, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of one unit: A-star from the end, forward Viterbi as exact heuristic."""
        buf = np.frombuffer(unit, np.uint8)
        _, s, e, pid = self.edges(buf, np.array([0]), np.array([len(buf)]))
        into: dict[int, list] = {}
        for a, b, i in sorted(zip(s.tolist(), e.tolist(), pid.tolist()), key=lambda x: (x[1], x[0])):
            into.setdefault(b, []).append((a, i, float(self.score[i]) if i >= 0 else self.unknown))
        alpha = {0: 0.0}
        for b in sorted(into):
            alpha[b] = max((alpha[a] + c for a, _, c in into[b] if a in alpha), default=-np.inf)
        heap, count, out = [(-alpha.get(len(buf), 0.0), 0, len(buf), 0.0, None)], 0, []
        while heap and len(out) < n:
            f, _, at, tail, path = heapq.heappop(heap)
            if at == 0:
                ids = []
                while path:
                    a, b, i, path = path
                    ids += [i] if i >= 0 else [int(self.byte_ids[x]) for x in unit[a:b]]
                out.append((-f, ids))
                continue
            for a, i, c in into.get(at, []):
                count += 1
                heapq.heappush(heap, (-(alpha[a] + c + tail), count, a, tail + c, (a, at, i, path)))
        return out

    def decode(self, ids) -> str:
        """Text of the ids: byte pieces joined, the first space (the encoder's) cut off."""
        return self.sp.decode(ids.tolist() if isinstance(ids, np.ndarray) else [int(i) for i in ids])


class UnitTable:
    """Results of the units seen by a task, by unit hash; emptied when it holds ``limit`` units."""

    def __init__(self, pieces: Pieces, limit: int = 300_000):
        self.pieces, self.limit = pieces, limit
        self._empty()

    def _empty(self):
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.best, self.gap = np.zeros(0), np.zeros(0)
        self.size, self.at, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def find(self, keys, buf, starts, ends) -> np.ndarray:
        """Slots of the units (distinct sorted hashes and spans), new ones segmented first."""
        if len(self.keys) > self.limit:
            self._empty()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            best, gap, ids, first = self.pieces.viterbi(buf, starts[new], ends[new])
            slots = len(self.best) + np.arange(len(new))
            self.at = np.concatenate([self.at, first[:-1] + len(self.ids)])
            self.size, self.ids = np.concatenate([self.size, np.diff(first)]), np.concatenate([self.ids, ids.astype("<u4")])
            self.best, self.gap = np.concatenate([self.best, best]), np.concatenate([self.gap, gap])
            self.keys, self.slot = np.insert(self.keys, place[new], keys[new]), np.insert(self.slot, place[new], slots)
            place = np.searchsorted(self.keys, keys)
        return self.slot[place]


def unit_spans(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """First byte of every unit: texts' starts and spaces after another character."""
    first = np.zeros(len(buf), bool)
    first[1:] = (buf[1:] == 32) & (buf[:-1] != 32)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(first)


def _texts(batch, column):
    """Bytes and offsets with the encoder's leading space before each text that has any characters."""
    rows = [b" " + t.as_buffer().to_pybytes() if t.is_valid and t.as_buffer().size else b"" for t in batch.column(column).cast(pa.large_string())]
    return np.frombuffer(b"".join(rows), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)


SCHEMA = "doc_id long, n_units long, scores array<double>, ids binary, variants array<binary>, decoded string"


def segment(docs: DataFrame, n: int = N_BEST, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
            keep_variants: bool = True) -> DataFrame:
    """Per row: doc_id, n_units, scores of the n best segmentations (falling), ids of the best and of the others
    (little-endian unsigned 32-bit), and the text decoded from the best ids.

    A text has as many scores as it has segmentations, up to n. NULL and empty
    texts have one, of no pieces, with score 0. Rows with a NULL or repeated id are kept as they
    are; other columns are ignored. Equal scores are ordered by the unit they
    differ in, first unit first.
    """

    def run(batches):
        pieces = Pieces(path)
        table, cache = UnitTable(pieces), {}
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                data, off = _texts(batch, "text")
                rows = []
                for lo, hi in ta.chunks(off, CHUNK):
                    rows += _segment_chunk(table, cache, data, off, lo, hi, n, keep_variants)
                    if len(cache) > 100_000:
                        cache.clear()
                decoded = pa.array([pieces.decode(np.frombuffer(r[2], "<u4")) for r in rows], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.float64())),
                     pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.list_(pa.binary())), decoded],
                    names=["doc_id", "n_units", "scores", "ids", "variants", "decoded"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(lean(run), SCHEMA)


def _segment_chunk(table, cache, data, off, lo, hi, n, keep_variants):
    buf, bounds = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
    if not len(buf):
        return [(0, [0.0], b"", [])] * (hi - lo)
    starts = unit_spans(buf, bounds)
    ends = np.append(starts[1:], len(buf))
    up, down = ta._pow(len(buf) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ta.WORDS[1][buf] * up[:len(buf)])])
    h = ta.mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    keys, where, which = np.unique(h, return_index=True, return_inverse=True)
    which = table.find(keys, buf, starts[where], ends[where])[which]
    first = np.searchsorted(starts, bounds)
    rows = []
    for i in range(hi - lo):
        span = slice(first[i], first[i + 1])
        units = which[span]
        if not len(units):
            rows.append((0, [0.0], b"", []))
            continue
        score = float(table.best[units].sum())
        reps = table.size[units]
        at = np.repeat(table.at[units] - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum())
        whole = table.ids[at]
        gaps = table.gap[units]
        k = min(n - 1, len(units))
        near = np.argpartition(gaps, k - 1)[:k] if 0 < k < len(units) else np.arange(len(units)) if k else np.zeros(0, np.int64)
        if 0 < k < len(units):  # ties at the border: first units first
            limit = gaps[near].max()
            below = np.flatnonzero(gaps < limit)
            near = np.sort(np.concatenate([below, np.flatnonzero(gaps == limit)[:k - len(below)]]))
        found = _combine(table.pieces, cache, buf, starts[span], ends[span], near[np.isfinite(gaps[near])], n)
        scores, variants = [score], []
        cuts = np.concatenate([[0], np.cumsum(reps)])
        for loss, changes in found:
            scores.append(score - loss)
            if keep_variants:
                parts, last = [], 0
                for j, alt in changes:
                    parts += [whole[last:cuts[j]], np.array(alt, "<u4")]
                    last = cuts[j + 1]
                variants.append(np.concatenate([*parts, whole[last:]]).tobytes())
        rows.append((len(units), scores, whole.tobytes(), variants))
    return rows


def _combine(pieces, cache, buf, starts, ends, near, n):
    """(loss, [(unit place, ids)]) of the n - 1 next best combinations of the units' own alternatives."""
    options = []
    for j in near.tolist():
        raw = buf[starts[j]:ends[j]].tobytes()
        key = raw if len(raw) < 64 else None
        alts = cache.get(key) if key else None
        if alts is None:
            alts = pieces.n_best(raw, n)
            if key:
                cache[key] = alts
        options.append((j, [(alts[0][0] - s, a) for s, a in alts]))
    heap, out = [(0.0, ())], []
    while heap and len(out) < n:
        loss, state = heapq.heappop(heap)  # state: (unit number, alternative), unit numbers rising
        out.append((loss, [(options[a][0], options[a][1][b][1]) for a, b in state]))
        last = state[-1][0] if state else -1
        if state and state[-1][1] + 1 < len(options[last][1]):
            b = state[-1][1] + 1
            heapq.heappush(heap, (loss - options[last][1][b - 1][0] + options[last][1][b][0], state[:-1] + ((last, b),)))
        for a in range(last + 1, len(options)):
            if len(options[a][1]) > 1:
                heapq.heappush(heap, (loss + options[a][1][1][0], state + ((a, 1),)))
    return out[1:]


def op6_query(spark, sf_dir):
    docs = documents(spark, sf_dir)
    done = segment(docs)
    crc = lambda c: F.crc32(c)
    return done.select("doc_id", "n_units", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), "scores",
                       crc(F.col("ids")).alias("ids_crc32"), F.transform("variants", crc).alias("variants_crc32"),
                       F.length("decoded").cast("long").alias("decoded_chars"), F.md5("decoded").alias("decoded_md5"))
