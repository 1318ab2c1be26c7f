"""Operator 8: toxicity by the nearest labelled examples under TF-IDF cosine.

Terms are lower-cased words without punctuation and their prefixes. All those whose presence differs
between toxic and clean labelled rows (chi-square) form the vocabulary; inverse
document frequencies come from all documents. The labelled examples lie in blocks of 16 in
order of their terms, so that neighbours in the order share terms, and a block-max
inverted index lists for every term the blocks that hold it with its largest weight there. The
lists of a query's terms add up to an upper bound of the cosine in each block; blocks are visited
by falling bound, and those whose bound is below the k-th score found are skipped. The best of
the visited blocks are scored anew in double precision, so the neighbours are exact. Votes are
weighted by similarity and calibrated by a logistic fit on leave-one-out votes.

The fit uses at most ``max_labelled`` labelled rows (smallest hash of doc_id
first), which bounds the vocabulary too; document frequencies and scores cover every text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .common import documents, give_back, lean, stored

MAX_LABELLED = 20_000
#: Chi-square that a term needs, whatever the number of labelled rows.
CHI2 = 15.0
#: Examples a block of the index.
BLOCK = 16
#: How many of the blocks left are visited in each step; the last one repeats.
STEPS = (8, 24, 64, 128, 256)
#: Terms of more than this share of the examples are held as columns besides.
DENSE = 0.1
#: Bound of the rounding error of 32-bit bounds and scores.
ROUNDING = 1e-4
#: Besides a word, its first so many bytes are terms (they join inflected forms).
PREFIXES = (3, 6)


def _terms(h: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term numbers, counts) of the word hashes that the sorted vocabulary holds."""
    if not len(vocabulary) or not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    return np.unique(at[vocabulary[at] == h], return_counts=True)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(text, toxic) of at most ``max_labelled`` labelled rows, smallest hash first, one row (smallest text) per doc_id."""
    picked = (labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # partial minimum first: a doc_id that many rows share leaves one row a task
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


class ToxicityModel:
    """Vocabulary, idf, inverted index and calibration; size bounded by the sample."""

    def __init__(self, vocabulary: np.ndarray, k: int = 25):
        self.vocabulary, self.k = vocabulary, k
        self.idf = np.ones(len(vocabulary))
        self.a, self.b = 0.0, 0.0

    def weights(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.idf[terms]
        return w / np.linalg.norm(w) if len(w) else w

    def index(self, examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        """Block-max index of (terms, counts) examples; those without terms are in no block."""
        self.labels = labels
        # 32-bit numbers and few copies: the driver holds all entries while it orders them
        self.term = (np.concatenate([t for t, _ in examples]) if examples else np.zeros(0)).astype(np.int32, copy=False)
        self.value = np.concatenate([self.weights(t, c) for t, c in examples]) if examples else np.zeros(0)
        #: first entry of each example
        self.start = np.concatenate([[0], np.cumsum([len(t) for t, _ in examples])]).astype(np.int64)
        sizes = np.diff(self.start)
        #: numbers of the examples in the order of the blocks, and where their entries begin
        self.filled = np.flatnonzero(sizes)
        self.entry = np.append(self.start[self.filled], self.start[-1])
        self.blocks = -(-len(self.filled) // BLOCK)
        # inverted lists of (place, weight), by term, then place; of each block the largest weight
        order = np.argsort(self.term, kind="stable")
        self.list_place = np.repeat(np.arange(len(self.filled), dtype=np.int32), sizes[self.filled])[order]
        self.list_weight, by = self.value.astype(np.float32)[order], self.term[order]
        del order
        self.list_first = np.searchsorted(by, np.arange(len(self.vocabulary) + 1, dtype=np.int32))
        cell = by.astype(np.int64)
        del by
        cell *= max(self.blocks, 1)
        cell += self.list_place // BLOCK
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
        self.max_cell = cell[first]
        del cell
        self.max_weight = np.maximum.reduceat(self.list_weight, first) if len(first) else np.zeros(0, np.float32)
        often = np.diff(self.list_first) > DENSE * len(self.filled)
        #: column of each frequent term, -1 without
        self.column = np.where(often, np.cumsum(often) - 1, -1)
        self._unfolded = None
        self.visited = self.asked = 0

    def __getstate__(self):
        return {**self.__dict__, "_unfolded": None}  # unfolded again where it is used

    def unfolded(self) -> tuple[np.ndarray, np.ndarray]:
        """Largest weights as a matrix (term, block), and weights of frequent terms as (block, example, column)."""
        if self._unfolded is None:
            top = np.zeros((len(self.vocabulary), self.blocks), np.float32)
            top.reshape(-1)[self.max_cell] = self.max_weight
            wide = np.zeros((self.blocks * BLOCK, int(self.column.max(initial=-1)) + 1), np.float32)
            for t in np.flatnonzero(self.column >= 0):
                at = slice(self.list_first[t], self.list_first[t + 1])
                wide[self.list_place[at], self.column[t]] = self.list_weight[at]
            self._unfolded = top, wide.reshape(self.blocks, BLOCK, -1)
        return self._unfolded

    def fold(self) -> None:
        """Drops the matrices (a worker that waits for its next stage keeps the model)."""
        self._unfolded = None

    def neighbours(self, terms: np.ndarray, counts: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine over 0 (exact; ties to the smaller number): (numbers, cosines)."""
        return self._without(terms, self.weights(terms, counts), skip)

    def _without(self, terms: np.ndarray, w: np.ndarray, skip: int) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours of a weight vector.

        Blocks are visited by falling upper bound, some at a time; those whose bound lies below
        the k-th cosine found so far are never visited. ``skip`` is an example to leave out.
        """
        if not len(terms) or not self.blocks:
            return np.zeros(0, np.int64), np.zeros(0)
        top, wide = self.unfolded()
        light = w.astype(np.float32)
        upper = light @ top[terms] + np.float32(ROUNDING)
        rare = np.zeros(self.blocks * BLOCK, np.float32)
        for t, x in zip(terms.tolist(), light):
            if self.column[t] < 0:
                at = slice(self.list_first[t], self.list_first[t + 1])
                rare[self.list_place[at]] += x * self.list_weight[at]
        rare = rare.reshape(self.blocks, BLOCK)
        heavy = np.zeros(wide.shape[2], np.float32)
        some = self.column[terms] >= 0
        heavy[self.column[terms[some]]] = light[some]
        left, bar = np.flatnonzero(upper > ROUNDING), np.float32(0)
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.float32)
        own = int(np.searchsorted(self.filled, skip)) if skip >= 0 else -1
        self.asked += self.blocks
        for step in (*STEPS, *[STEPS[-1]] * self.blocks):
            left = left[upper[left] >= bar]
            if not len(left):
                break
            now, left = left, left[:0]
            if len(now) > step:
                by = np.argpartition(-upper[now], step - 1)
                now, left = now[by[:step]], now[by[step:]]
            self.visited += len(now)
            s = wide[now].reshape(len(now) * BLOCK, len(heavy)) @ heavy + rare[now].reshape(-1)
            on = np.flatnonzero((s >= bar) & (s > 0))
            place = now[on // BLOCK] * BLOCK + on % BLOCK
            if skip >= 0 and self.filled[own] == skip:
                on, place = on[place != own], place[place != own]
            places, scores = np.concatenate([places, place]), np.concatenate([scores, s[on]])
            if len(scores) > self.k:
                bar = max(np.partition(scores, -self.k)[-self.k] - np.float32(2 * ROUNDING), np.float32(0))
                places, scores = places[scores >= bar], scores[scores >= bar]
        return self._exact(places, terms, w)

    def _exact(self, places: np.ndarray, terms: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k best of some examples by their cosines in double precision."""
        if not len(places):
            return places, np.zeros(0)
        full = np.zeros(len(self.vocabulary))
        full[terms] = w
        first, n = self.entry[places], self.entry[places + 1] - self.entry[places]
        ends = np.cumsum(n)
        at = np.repeat(first - ends + n, n) + np.arange(ends[-1])
        s, d = np.add.reduceat(full[self.term[at]] * self.value[at], ends - n), self.filled[places]
        order = np.lexsort((d, -s))[:self.k]
        return d[order], s[order]

    def vote(self, numbers: np.ndarray, cosines: np.ndarray) -> float:
        """Similarity-weighted share of toxic neighbours, as log-odds smoothed towards the base rate."""
        w = cosines ** 2
        toxic = float((w * (self.labels[numbers] == 1)).sum())
        return math.log((toxic + 0.5 * self.rate) / (float(w.sum()) - toxic + 0.5 * (1 - self.rate)))

    def set_rate(self) -> None:
        """Smoothed share of toxic examples."""
        self.rate = (float((self.labels == 1).sum()) + 1) / (len(self.labels) + 2)

    def vote_without(self, number: int) -> float:
        """The vote on an example by all others."""
        at = slice(self.start[number], self.start[number + 1])
        # its own stored weights stand for terms and counts
        return self.vote(*self._without(self.term[at], self.value[at], number))

    def calibrate(self, votes: np.ndarray) -> None:
        """Logistic fit of labels on leave-one-out votes (Newton steps, ridge for separable votes)."""
        x = np.asarray(votes, float)
        y = (self.labels == 1).astype(float)
        z = np.column_stack([x, np.ones(len(x))]) if len(x) else np.zeros((0, 2))
        beta, ridge = np.array([1.0, 0.0]), 1e-2
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(2),
                                   z.T @ (y - p) - ridge * (beta - np.array([1.0, 0.0])))
            beta = beta + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        self.a, self.b = float(max(beta[0], 1e-3)), float(beta[1])

    def score(self, numbers: np.ndarray, cosines: np.ndarray) -> float:
        if not len(self.labels):
            return 0.0
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.a * self.vote(numbers, cosines) + self.b))))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, k: int = 25) -> ToxicityModel:
    """Model of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    spark = docs.sparkSession
    sample = stored(labelled_sample(docs, labels, max_labelled), "toxicity-sample")

    def hashes(batches):
        for b in batches:
            rows = [np.unique(h).view(np.int64) for _, h in ta.text_rows(b, "text", ta.BARE_WORDS, prefixes=PREFIXES)]
            toxic = b.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)),
                 pa.array(np.repeat(toxic, [len(r) for r in rows]))], names=["term", "toxic"])

    totals = sample.groupBy().agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    n, t = totals["n"], totals["t"]
    a, m = F.col("a").cast("double"), F.col("m").cast("double")
    expected = m * t / max(n, 1)
    chi2 = (a - expected) ** 2 * n / F.greatest(expected * (n - t) / max(n, 1) * (1 - m / max(n, 1)), F.lit(1e-9))
    rows = (sample.mapInArrow(lean(hashes), "term long, toxic long").groupBy("term")
            .agg(F.sum("toxic").alias("a"), F.count("*").alias("m")).withColumn("chi2", chi2 / n if n else F.lit(0.0))
            .where(F.col("chi2") >= CHI2).select("term").toArrow())
    model = ToxicityModel(np.sort(rows["term"].to_numpy().astype(np.int64).view(np.uint64)), k)
    shared = spark.sparkContext.broadcast(model.vocabulary)

    def frequencies(batches):
        total, count = np.zeros(len(shared.value), np.int64), 0
        for b in batches:
            count += b.num_rows
            for _, h in ta.text_rows(b, "text", ta.BARE_WORDS, prefixes=PREFIXES):
                total[_terms(h, shared.value)[0]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total))), pa.array(np.append(count, total))],
                                         names=["term", "df"])

    df = np.zeros(len(model.vocabulary) + 1)
    rows = docs.select("text").mapInArrow(lean(frequencies), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df[rows["term"].to_numpy() + 1] = rows["df"].to_numpy()
    model.idf = np.log((df[0] + 1) / (df[1:] + 1)) + 1

    def vectors(batches):
        for b in batches:
            found = [_terms(h, shared.value) for _, h in ta.text_rows(b, "text", ta.BARE_WORDS, prefixes=PREFIXES)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tolist() for x, _ in found], pa.list_(pa.int32())),
                                              pa.array([c.tolist() for _, c in found], pa.list_(pa.int32())),
                                              b.column("toxic").cast(pa.int64())], names=["terms", "counts", "toxic"])

    rows = sample.mapInArrow(lean(vectors), "terms array<int>, counts array<int>, toxic long").toArrow()
    found = sorted(zip((x.values.to_numpy() for x in rows["terms"]), (x.values.to_numpy() for x in rows["counts"]), rows["toxic"].to_pylist()),
                   key=lambda r: (r[0].tobytes(), r[1].tobytes(), r[2]))
    model.index([(x, c) for x, c, _ in found], np.array([y for _, _, y in found], np.int64))
    del rows, found
    give_back()
    model.set_rate()
    model.calibrate(_votes(spark, model))
    return model


def _votes(spark, model: ToxicityModel) -> np.ndarray:
    """Leave-one-out votes on all examples, by number; taken in tasks, one number an example comes back."""
    shared, out = spark.sparkContext.broadcast(model), np.zeros(len(model.labels))

    def run(batches):
        try:
            for b in batches:
                numbers = b.column("id").to_pylist()
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([shared.value.vote_without(i) for i in numbers], pa.float64())],
                                                 names=["id", "vote"])
        finally:
            shared.value.fold()

    parts = max(1, min(spark.sparkContext.defaultParallelism, len(out) // 500))
    rows = spark.range(len(out), numPartitions=parts).mapInArrow(lean(run), "id long, vote double").toArrow()
    shared.unpersist()
    out[rows["id"].to_numpy()] = rows["vote"].to_numpy()
    return out


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the columns score (0 to 1) and neighbours (example numbers and cosines as evidence).

    NULL and empty texts, and texts without any vocabulary term, have no
    neighbours and get the calibrated base rate. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    kind = "struct<score:double,neighbours:array<struct<example:long,label:long,cosine:double>>>"
    columns = pa.struct([("score", pa.float64()), ("neighbours", pa.list_(pa.struct([
        ("example", pa.int64()), ("label", pa.int64()), ("cosine", pa.float64())])))])

    def scores(model: ToxicityModel, texts: pa.Array) -> pa.Array:
        keys, distinct = [], {}
        for _, h in ta.text_rows(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", ta.BARE_WORDS, prefixes=PREFIXES):
            terms, counts = _terms(h, model.vocabulary)
            keys.append(terms.tobytes() + counts.tobytes())
            distinct.setdefault(keys[-1], (terms, counts))
        known = {}
        for key, (terms, counts) in distinct.items():
            d, s = model.neighbours(terms, counts)
            near = [{"example": int(x), "label": int(model.labels[x]), "cosine": float(c)} for x, c in zip(d, s)]
            known[key] = {"score": model.score(d, s), "neighbours": near}
        return pa.array([known[key] for key in keys], columns)

    @F.arrow_udf(kind)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                yield scores(shared.value, texts)
                give_back()
        finally:
            shared.value.fold()
            give_back()

    return (docs.withColumn("_toxicity", scored(F.col(text_col).cast("string")))
            .withColumns({score: F.col("_toxicity.score"), "neighbours": F.col("_toxicity.neighbours")}).drop("_toxicity"))


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op8_query(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = documents(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out())
    scored = score_toxicity(docs, fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
