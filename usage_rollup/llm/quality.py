"""Operator 5: quality rules with n-gram perplexity bands.

Base rules count words, symbols, repeated lines and repeated 8-word windows.
The perplexity comes from a modified Kneser-Ney model of character 4-grams over all
languages, or one a language (``per_language``). Spark counts the 4-grams of all texts; every order's discounts, context
totals and continuation counts (distinct left neighbours) are aggregates and joins over
the distinct grams, so the model grows with the alphabets and texts of the
corpus and no step gathers it. What comes out is a table of (model, gram,
log-probability), which tasks hold as sorted arrays of 64-bit gram keys and search for each
character of a text. The table is handed out in parts of at most ``PART_ROWS`` grams:
one part where it is small, else the texts are read once a part and the sums added up.
Per language, texts outside the band of log-perplexities are rejected.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textarrays as ta
from .common import documents, lean, stored

ORDER = 4
#: Bits of a symbol in a gram's key. Code points beyond them share 2048 values that no text holds.
BITS = 16
#: Grams a task holds at once (16 bytes each in the broadcast).
PART_ROWS = 2_000_000
#: Log-probability of a gram that the model does not know (none, where it was counted on the scored texts).
FLOOR = float(np.log(1e-12))
_FLUSH = 2_000_000
# ASCII characters that stand for a class: white space, digits, sentence marks, exclamations, all others but letters.
_FOLDED = np.full(128, ord("#"), np.uint32)
for _chars, _symbol in ((ta.SPACES, " "), (b"0123456789", "0"), (b".,;:", "."), (b"!?", "!")):
    _FOLDED[list(_chars)] = ord(_symbol)
_LETTERS = [*range(65, 91), *range(97, 123)]
_FOLDED[_LETTERS] = _LETTERS
_MARKS = np.zeros(256, bool)
_MARKS[list(b"#*$%&|<>")] = True
_LINES = ta.byte_tables(b"\n", lower=False)
#: Width of the bands in spreads of the quartiles, chosen on the labelled rows that are not held out (README).
WIDTH = 2.0


def symbols_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of UTF-8 bytes and the byte each starts at: code points in 16 bits, ASCII other than letters by its class."""
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    lead = raw[at]
    more = (lead >= 0xC0).astype(np.int8) + (lead >= 0xE0) + (lead >= 0xF0)
    sym = np.where(more == 0, lead, lead & np.array([0xFF, 0x1F, 0x0F, 0x07], np.uint8)[more]).astype(np.uint32)
    for k in (1, 2, 3):
        on = np.flatnonzero(more >= k)
        sym[on] = sym[on] << 6 | (raw[np.minimum(at[on] + k, len(raw) - 1)] & 0x3F)
    sym[sym >= 1 << BITS] = 0xD800 + sym[sym >= 1 << BITS] % 2048
    ascii_ = sym < 128
    sym[ascii_] = _FOLDED[sym[ascii_]]
    return sym, at


def grams_of(data, off, lo, hi) -> tuple[np.ndarray, np.ndarray]:
    """4-gram keys of rows [lo, hi) and their first index per row. A text is led by white space, whose runs
    count as one symbol."""
    base = off[lo]
    sym, at = symbols_of(data[base:off[hi]])
    starts = np.searchsorted(at, off[lo:hi + 1] - base)
    keep = np.ones(len(sym), bool)
    if len(sym):
        keep[1:] = ~((sym[1:] == 32) & (sym[:-1] == 32))
        keep[starts[:-1][starts[:-1] < len(sym)]] = True
    count = np.concatenate([[0], np.cumsum(keep)])[starts]
    body, n = sym[keep].astype(np.uint64), np.diff(count)
    led = np.full(len(body) + 3 * len(n), 32, np.uint64)  # three white spaces before each text
    at = np.arange(len(body)) + 3 * (np.repeat(np.arange(len(n)), n) + 1)
    led[at] = body
    keys = led[at - 3] << np.uint64(48) | led[at - 2] << np.uint64(32) | led[at - 1] << np.uint64(16) | body
    return keys, count


def _by_language(batch: pa.RecordBatch, lo: int, hi: int, count: np.ndarray):
    """(language, mask over the grams of rows [lo, hi) or None for all)."""
    codes = batch.column("l").slice(lo, hi - lo).dictionary_encode()
    names, of = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
    if len(names) == 1:
        return [(names[0], None)]
    per = np.repeat(of, np.diff(count))
    return [(name, per == i) for i, name in enumerate(names)]


def language_key(column: str = "lang"):
    """A language's name as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def gram_counts(docs: DataFrame) -> DataFrame:
    """(l, gram, n) over all texts of ``docs`` (l, text); tasks add up before the shuffle."""

    def run(batches):
        held: dict[str, list] = {}
        size = 0

        def merged(parts):
            keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)

        def flush():
            for name in held:
                keys, n = merged(held[name])
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
                                                 names=["l", "gram", "n"])

        for b in batches:
            data, off = ta.text_buffers(b.column("text"))
            for lo, hi in ta.chunks(off):
                keys, count = grams_of(data, off, lo, hi)
                for name, on in _by_language(b, lo, hi, count):
                    part = np.unique(keys if on is None else keys[on], return_counts=True)
                    held.setdefault(name, []).append(part)
                    size += len(part[0])
                if size > 2 * _FLUSH:
                    held = {name: [merged(parts)] for name, parts in held.items()}
                    size = sum(len(p[0][0]) for p in held.values())
                    if size > _FLUSH:
                        yield from flush()
                        held, size = {}, 0
        yield from flush()

    return docs.select("l", "text").mapInArrow(lean(run), "l string, gram long, n long").groupBy("l", "gram").agg(F.sum("n").alias("n"))


def _levels(counts: DataFrame) -> dict[int, DataFrame]:
    """Of each order (l, gram, n, t, w, d1, d2, d3, kinds): count, context's total and sum of discounts, the order's discounts.

    Counts are those of the texts for the highest order, else distinct left neighbours.
    """
    levels = {ORDER: stored(counts, "quality-grams")}
    for k in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND((1 << BITS * k) - 1).alias("gram")
        levels[k] = stored(levels[k + 1].groupBy("l", shorter).agg(F.count("*").alias("n")), "quality-grams")
    out = {}
    for k, rows in levels.items():
        ones = [F.greatest(F.count_if(F.col("n") == i), F.lit(1)).cast("double").alias(f"m{i}") for i in (1, 2, 3, 4)]
        y = F.col("m1") / (F.col("m1") + 2 * F.col("m2"))
        cut = [F.least(F.greatest(i - (i + 1) * y * F.col(f"m{i + 1}") / F.col(f"m{i}"), F.lit(0.0)), F.lit(i - 0.01)).alias(f"d{i}") for i in (1, 2, 3)]
        discount = rows.groupBy("l").agg(*ones, F.count("*").alias("kinds")).select("l", "kinds", *cut)
        of = Window.partitionBy("l", F.shiftrightunsigned("gram", BITS))  # as many rows as symbols follow a context
        out[k] = rows.join(discount, "l").withColumn("t", F.sum("n").over(of)).withColumn("w", F.sum(_discount(F.col("n"), F.col)).over(of))
    return out


def _discount(c, column):
    return F.when(c <= 0, 0.0).when(c == 1, column("d1")).when(c == 2, column("d2")).otherwise(column("d3"))


def kneser_ney(counts: DataFrame, leave_out: bool = False) -> DataFrame:
    """(l, gram, logp) of every counted 4-gram: modified Kneser-Ney, interpolated down to a uniform unigram.

    Of a gram with count c in a context with total t,
    p = (c - d(c)) / t + (sum of d over the context / t) * p of the gram without its first symbol.
    With ``leave_out`` the occurrence that is scored is left out of c, t and the sum, and of the
    lower orders' counts where it was the only one: a corpus that scores itself then gives a
    text no credit for having been counted (README: why the query does not ask for it).
    """
    levels = _levels(counts)
    rows = levels[ORDER].select("l", "gram", F.struct("n", "t", "w", "d1", "d2", "d3", "kinds").alias(f"o{ORDER}"))
    for k in range(ORDER - 1, 0, -1):
        low = levels[k].select("l", F.col("gram").alias("short"), F.struct("n", "t", "w", "d1", "d2", "d3", "kinds").alias(f"o{k}"))
        rows = rows.withColumn("short", F.col("gram").bitwiseAND((1 << BITS * k) - 1)).join(low, ["l", "short"]).drop("short")
    removed = F.lit(int(leave_out))
    for k in range(ORDER, 0, -1):  # what is left of each order's count
        rows = rows.withColumn(f"r{k}", removed).withColumn(f"c{k}", F.col(f"o{k}.n") - F.col(f"r{k}"))
        removed = F.when(F.col(f"c{k}") == 0, F.col(f"r{k}")).otherwise(0)
    p = 1 / F.col("o1.kinds")
    for k in range(1, ORDER + 1):
        column = lambda name, k=k: F.col(f"o{k}.{name}")
        c, t = F.col(f"c{k}"), column("t") - F.col(f"r{k}")
        w = column("w") - _discount(column("n"), column) + _discount(c, column)
        rows = rows.withColumn(f"p{k}", F.when(t > 0, (c - _discount(c, column)) / t + w / t * p).otherwise(p))
        p = F.col(f"p{k}")
    return stored(rows.select("l", "gram", F.log(F.greatest(p, F.lit(1e-12))).cast("float").alias("logp")), "quality-model")


class Lookup:
    """One part of the model: per language sorted gram keys and log-probabilities."""

    def __init__(self, rows: pa.Table, part: int, parts: int):
        self.part, self.parts, self.tables = part, parts, {}
        names = rows["l"].combine_chunks().dictionary_encode()
        if isinstance(names, pa.ChunkedArray):
            names = names.combine_chunks()
        of = names.indices.to_numpy(zero_copy_only=False)
        keys, logp = rows["gram"].to_numpy().view(np.uint64), rows["logp"].to_numpy()
        for i, name in enumerate(names.dictionary.to_pylist()):
            on = np.flatnonzero(of == i)
            on = on[np.argsort(keys[on])]
            self.tables[name] = keys[on], logp[on].astype(np.float32)

    def of(self, name: str, grams: np.ndarray) -> np.ndarray:
        """Log-probabilities of a language's grams; 0 for those that belong to another part."""
        mine = None if self.parts == 1 else part_of(grams, self.parts) == self.part
        keys, logp = self.tables.get(name, (np.zeros(0, np.uint64), np.zeros(0, np.float32)))
        if not len(keys):
            out = np.full(len(grams), FLOOR, np.float32)
        else:
            at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
            out = np.where(keys[at] == grams, logp[at], np.float32(FLOOR))
        return out if mine is None else np.where(mine, out, np.float32(0))


def part_of(grams: np.ndarray, parts: int) -> np.ndarray:
    return (ta.mix(grams) >> np.uint64(33)).astype(np.int64) % parts


def model_parts(model: DataFrame, part_rows: int = PART_ROWS) -> list[Lookup]:
    """The model in parts of about ``part_rows`` grams, by hash; each comes to the driver by itself to be broadcast."""
    parts = max(1, -(-model.count() // part_rows))

    def numbered(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part_of(b.column("gram").to_numpy().view(np.uint64), parts))],
                                             names=[*b.schema.names, "part"])

    if parts == 1:
        return [Lookup(model.toArrow(), 0, 1)]
    split = stored(model.mapInArrow(numbered, "l string, gram long, logp float, part long"), "quality-parts")
    return [Lookup(split.where(F.col("part") == i).drop("part").toArrow(), i, parts) for i in range(parts)]


RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def rules_and_sums(docs: DataFrame, lookup: Lookup, rules: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, lang, l, text): rule counts (0 if not asked for), n_grams and the sum of their log-probabilities."""
    shared = docs.sparkSession.sparkContext.broadcast(lookup)

    def run(batches):
        for b in batches:
            data, off = ta.text_buffers(b.column("text"))
            for lo, hi in ta.chunks(off):
                counts = _rules(data, off, lo, hi) if rules else [np.zeros(hi - lo, np.int64)] * len(RULES)
                grams, first = grams_of(data, off, lo, hi)
                logp = np.zeros(len(grams), np.float32)
                for name, on in _by_language(b, lo, hi, first):
                    if on is None:
                        logp = shared.value.of(name, grams)
                    else:
                        logp[on] = shared.value.of(name, grams[on])
                total = np.diff(np.concatenate([[0.0], np.cumsum(logp, dtype=np.float64)])[first])
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "lang", "l", "row")), *(pa.array(c.astype(np.int64)) for c in counts),
                     pa.array(np.diff(first).astype(np.int64)), pa.array(total)],
                    names=["doc_id", "lang", "l", "row", *RULES, "n_grams", "log_sum"])

    return docs.mapInArrow(lean(run), "doc_id long, lang string, l string, row long, " + ", ".join(f"{n} long" for n in RULES)
                           + ", n_grams long, log_sum double")


def perplexity_and_rules(docs: DataFrame, parts: list[Lookup]) -> DataFrame:
    """Per row of ``docs`` (doc_id, lang, l, text): rule counts and log_ppl (mean negative log-probability a symbol)."""
    rows = docs.withColumn("row", F.xxhash64("doc_id", "l", "text"))
    first = rules_and_sums(rows, parts[0])
    if len(parts) > 1:  # rows of one name are equal, so any of their sums will do
        sums = functools.reduce(DataFrame.union, [rules_and_sums(rows, p, rules=False).select("row", F.lit(i).alias("part"), "log_sum")
                                                  for i, p in enumerate(parts[1:])])
        rest = sums.groupBy("row", "part").agg(F.max("log_sum").alias("s")).groupBy("row").agg(F.sum("s").alias("rest"))
        first = first.join(rest, "row").withColumn("log_sum", F.col("log_sum") + F.col("rest")).drop("rest")
    return first.withColumn("log_ppl", F.when(F.col("n_grams") > 0, -F.col("log_sum") / F.col("n_grams"))).drop("row", "log_sum", "n_grams")


def _repeats(h: np.ndarray, size: int = 8) -> int:
    """Words in ``size``-word windows that occur twice or more."""
    if len(h) <= size:
        return 0
    win, _ = ta.shingle_hashes(h, np.array([0, len(h)]), size)
    order = np.argsort(win, kind="stable")
    same = win[order][1:] == win[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(win), bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    at = np.flatnonzero(hit)
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def _rules(data, off, lo, hi):
    buf, starts, ends, first = ta.word_spans(data, off, lo, hi, ta.WORDS)
    bounds = off[lo:hi + 1] - off[lo]
    sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[bounds])
    in_word = ~ta.WORDS[0][buf]
    chars, marks = sums(in_word & ((buf & 0xC0) != 0x80)), sums(_MARKS[buf])
    words, _ = ta.word_hashes(data, off, lo, hi, ta.WORDS)
    repeats = np.array([_repeats(words[first[i]:first[i + 1]]) for i in range(hi - lo)], np.int64)
    _, s, e, line_first = ta.word_spans(data, off, lo, hi, _LINES)
    lines, _ = ta.word_hashes(data, off, lo, hi, _LINES)
    filled = np.concatenate([[0], np.cumsum(in_word)])
    full = filled[e] > filled[s]
    dup = np.zeros(hi - lo, np.int64)
    for i in range(hi - lo):
        x = lines[line_first[i]:line_first[i + 1]][full[line_first[i]:line_first[i + 1]]]
        dup[i] = len(x) - len(np.unique(x)) if len(x) > 1 else 0
    return np.diff(first), chars, marks, dup, repeats


def quality_rules(docs: DataFrame, width: float = WIDTH, least_spread: float = 0.02,
                  slack: float = 1.0, part_rows: int = PART_ROWS, per_language: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): counts, base_failed, log_ppl, band (low, high), kept.

    The band of a language runs from its lower quartile minus to its upper
    quartile plus ``width`` times the spread of the quartiles (``least_spread``
    at least, so that a language of near-equal texts rejects none) over the texts that pass the base rules.
    A text of n symbols gets ``slack / sqrt(n)`` more on each side, for short texts vary more.
    NULL texts count as empty (they fail the base rules), a NULL language forms
    one of its own, repeated rows count as often as they occur, an empty table
    gives no rows, other columns are ignored.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                         (language_key() if per_language else F.lit("")).alias("l"), F.col("text").cast("string").alias("text"))
    parts = model_parts(kneser_ney(gram_counts(narrow)), part_rows)
    stats = stored(perplexity_and_rules(narrow, parts).withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))), "quality-rules")
    stats = stats.drop("l").withColumn("l", language_key())
    bands = (stats.where("not base_failed").groupBy("l")
             .agg(F.percentile_approx("log_ppl", [0.25, 0.75], 10000).alias("q"))
             .select("l", F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))
             .withColumn("w", width * F.greatest(F.col("hi") - F.col("lo"), F.lit(least_spread)))
             .select("l", (F.col("lo") - F.col("w")).alias("low"), (F.col("hi") + F.col("w")).alias("high")))
    joined = stats.join(bands, "l", "left").drop("l")
    more = slack / F.sqrt(F.greatest(F.col("word_chars") + F.col("n_words"), F.lit(1)))
    inside = F.col("log_ppl").between(F.col("low") - more, F.col("high") + more)
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))


def op5_query(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ppl")
