"""Operator 3: secret scans by grammar inference.

Fixed patterns find the *base* spans (assign, access, hex). Their values are the
labelled credentials: per kind a prefix tree of the values is built and its
statistically compatible states are merged (Hoeffding test on symbol and end
frequencies, red-blue order), which gives a probabilistic automaton of the
kind's format. Every candidate run of credential characters that no base span
covers is then scored by its log-likelihood under the best automaton against a
character-bigram background of unlabelled candidates; those above the threshold
are added as ``learned`` spans.

The fit uses at most ``max_labelled`` values a kind (smallest hash first) and the
bigrams of all candidates; scanning and scoring cover every text. Offsets are
code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textarrays as ta
from .common import documents, give_back, lean, stored

KINDS = ("assign", "access", "hex")
# The base patterns.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_CANDIDATE = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_RUN = np.ones(256, bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = False
_RUN = (_RUN, ta.WORDS[1])


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind index, end, value start, value end), by start, then kind."""
    out = [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _flagged(batch, text):
    """(row, may hold an assignment, holds a run of MIN_CANDIDATE) of rows worth a closer look."""
    data, off = ta.text_buffers(batch.column(text))
    for lo, hi in ta.chunks(off):
        buf, starts, ends, first = ta.word_spans(data, off, lo, hi, _RUN)
        long_ = np.concatenate([[0], np.cumsum(ends - starts >= MIN_CANDIDATE)])
        eq = np.concatenate([[0], np.cumsum((buf == 58) | (buf == 61))])
        bounds = off[lo:hi + 1] - off[lo]
        runs, marks = np.diff(long_[first]) > 0, np.diff(eq[bounds]) > 0
        for i in np.flatnonzero(runs | marks):
            yield lo + int(i), bool(marks[i]), bool(runs[i])


def _samples(docs: DataFrame) -> DataFrame:
    """(kind, value): values of base spans by kind, and as kind ``other`` candidates outside them."""

    def run(batches):
        for b in batches:
            kinds, values = [], []
            for i, _, _ in _flagged(b, "text"):
                text = b.column("text")[i].as_py() or ""
                spans = base_spans(text)
                for _, k, _, lo, hi in spans:
                    kinds.append(KINDS[k])
                    values.append(text[lo:hi])
                for m in CANDIDATE.finditer(text):
                    if not any(s < m.end() and m.start() < e for s, _, e, _, _ in spans):
                        kinds.append("other")
                        values.append(m.group())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())],
                                             names=["kind", "value"])

    return docs.select("text").mapInArrow(lean(run), "kind string, value string")


# --- grammar inference ----------------------------------------------------------------


class Automaton:
    """Probabilistic automaton of a list of strings (prefix tree with compatible states merged)."""

    def __init__(self, values: list[str], alpha: float = 0.05):
        self.kids: list[dict[str, int]] = [{}]
        self.n, self.ends = [0], [0]
        self.hits: list[dict[str, int]] = [{}]
        for v in values:
            at = 0
            self.n[0] += 1
            for c in v:
                self.hits[at][c] = self.hits[at].get(c, 0) + 1
                if c not in self.kids[at]:
                    self.kids[at][c] = len(self.kids)
                    self.kids.append({})
                    self.hits.append({})
                    self.n.append(0)
                    self.ends.append(0)
                at = self.kids[at][c]
                self.n[at] += 1
            self.ends[at] += 1
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()

    def _differs(self, f1, n1, f2, n2) -> bool:
        return abs(f1 / n1 - f2 / n2) > self._bound * (n1 ** -0.5 + n2 ** -0.5)

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if not self.n[a] or not self.n[b]:
                continue
            if self._differs(self.ends[a], self.n[a], self.ends[b], self.n[b]):
                return False
            for c in self.hits[a].keys() | self.hits[b].keys():
                if self._differs(self.hits[a].get(c, 0), self.n[a], self.hits[b].get(c, 0), self.n[b]):
                    return False
            todo += [(self.kids[a][c], k) for c, k in self.kids[b].items() if c in self.kids[a] and self.kids[a][c] != k]
        return True

    def _fold(self, a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.n[a] += self.n[b]
            self.ends[a] += self.ends[b]
            for c, h in self.hits[b].items():
                self.hits[a][c] = self.hits[a].get(c, 0) + h
            for c, k in self.kids[b].items():
                if c in self.kids[a]:
                    if self.kids[a][c] != k:
                        todo.append((self.kids[a][c], k))
                else:
                    self.kids[a][c] = k

    def _merge(self) -> None:
        red, seen = [0], {0}
        while True:
            blue = next(((r, c) for r in red for c in sorted(self.kids[r]) if self.kids[r][c] not in seen), None)
            if blue is None:
                break
            r, c = blue
            b = self.kids[r][c]
            into = next((q for q in red if self._compatible(q, b)), None)
            if into is None:
                red.append(b)
                seen.add(b)
            else:
                self.kids[r][c] = into
                self._fold(into, b)
        at = {q: i for i, q in enumerate(red)}
        #: states: (symbol -> (log2 probability, next state), log2 probability of anything else)
        self.states = [({c: (math.log2((h + 0.1) / (self.n[q] + 8)), at.get(self.kids[q][c], 0))
                         for c, h in self.hits[q].items()}, math.log2(0.1 / (self.n[q] + 8))) for q in red]
        del self.kids, self.hits, self.n, self.ends

    def bits(self, text: str) -> float:
        """log2 likelihood of the symbols of ``text``."""
        at, total = 0, 0.0
        for c in text:
            moves, other = self.states[at]
            p, at = moves.get(c, (other, at))
            total += p
        return total


class Background:
    """Character bigrams with add-half smoothing over the 68 candidate characters."""

    def __init__(self, values: list[str], pairs: dict[str, int] | None = None):
        """Counts of ``pairs``, besides those of ``values``; a value's first character pairs with ``^``."""
        self.pairs: dict[str, int] = dict(pairs or {})
        for v in values:
            for a, b in zip("^" + v, v):
                self.pairs[a + b] = self.pairs.get(a + b, 0) + 1
        self.one: dict[str, int] = {}
        for pair, n in self.pairs.items():
            self.one[pair[0]] = self.one.get(pair[0], 0) + n

    def bits(self, text: str) -> float:
        return sum(math.log2((self.pairs.get(a + b, 0) + 0.5) / (self.one.get(a, 0) + 34)) for a, b in zip("^" + text, text))


class SecretModel:
    """Automata per kind, background and threshold; holds bounded samples and the counts of pairs of characters only."""

    def __init__(self, values: dict[str, list[str]], min_bits: float = 0.5, pairs: dict[str, int] | None = None):
        self.automata = {k: Automaton(values[k]) for k in KINDS if len(values.get(k, [])) >= 20}
        self.background = Background(values.get("other", []), pairs)
        self.min_bits = min_bits

    def score(self, text: str) -> float:
        """Bits a character by which the best automaton beats the background."""
        if not self.automata:
            return -math.inf
        return (max(a.bits(text) for a in self.automata.values()) - self.background.bits(text)) / max(1, len(text))


def fit(docs: DataFrame, max_labelled: int = 2000) -> SecretModel:
    """Model of at most ``max_labelled`` distinct values a kind and the bigrams of all distinct other candidates.

    The smallest hashes are taken, so the sample does not depend on partitions.
    """
    values = stored(_samples(docs).distinct(), "secret-values")
    # the smallest hashes of each of 256 groups a kind first, so that no task sorts all values of a kind
    order = [F.xxhash64("value"), F.col("value")]
    some = F.row_number().over(Window.partitionBy("kind", F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(256))).orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(*order))
    rows = (values.where("kind <> 'other'").withColumn("r", some).where(F.col("r") <= max_labelled)
            .withColumn("r", rank).where(F.col("r") <= max_labelled))
    held: dict[str, list[str]] = {}
    for r in sorted(rows.select("kind", "value").collect()):
        held.setdefault(r.kind, []).append(r.value)
    pair = F.explode(F.expr("transform(sequence(1, length(value)), i -> substring(concat('^', value), i, 2))"))
    pairs = values.where("kind = 'other'").select(pair.alias("pair")).groupBy("pair").count()  # at most 69 x 68 rows
    return SecretModel(held, pairs={r["pair"]: r["count"] for r in pairs.collect()})


SPANS = "array<struct<kind:string,start:long,end:long>>"


def find_secrets(docs: DataFrame, model: SecretModel, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with the column ``out``: base and learned spans by start, then kind.

    NULL and empty texts have none; every row and column stays, a column named
    ``out`` is replaced. Learned spans never overlap base ones.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = [*KINDS, "learned"]

    @F.pandas_udf(SPANS)
    def spans(texts):  # type: ignore[no-untyped-def]
        import pandas as pd

        model = shared.value
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string(), from_pandas=True)], names=["text"])
        rows: list[list[dict]] = [[] for _ in range(len(texts))]
        for i, _, runs in _flagged(batch, "text"):
            text = texts.iloc[i]
            found = [(s, k, e) for s, k, e, _, _ in base_spans(text)]
            if runs:
                taken = [(s, e) for s, _, e in found]
                found += [(m.start(), 3, m.end()) for m in CANDIDATE.finditer(text)
                          if not any(s < m.end() and m.start() < e for s, e in taken)
                          and model.score(m.group()) >= model.min_bits]
            rows[i] = [{"kind": kinds[k], "start": s, "end": e} for s, k, e in sorted(found)]
        give_back()
        return pd.Series(rows)

    return docs.withColumn(out, spans(F.col(text_col).cast("string")))


def redact(docs: DataFrame, spans: str = "secrets", text_col: str = "text", mark: str = "[redacted]") -> DataFrame:
    """Texts with every span replaced by ``mark`` (overlapping spans once); other texts stay as they are."""

    @F.pandas_udf("string")
    def cut(texts, found):  # type: ignore[no-untyped-def]
        import pandas as pd

        out = []
        for text, rows in zip(texts, found):
            if text is not None and len(rows):
                parts, at = [], 0
                for r in sorted(rows, key=lambda r: r["start"]):
                    if r["start"] >= at:
                        parts += [text[at:r["start"]], mark]
                    at = max(at, r["end"])
                text = "".join([*parts, text[at:]])
            out.append(text)
        give_back()
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, F.when(F.size(spans) > 0, cut(F.col(text_col), F.col(spans))).otherwise(F.col(text_col)))


def op3_query(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = find_secrets(docs, fit(docs))
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"] != "learned")
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("secrets")).alias("spans"), count("learned"))
