"""Operator 13: importance resampling towards a target text, by bit-sliced aggregation.

Words and word pairs fall into hash buckets. A bucket's gain is the scaled log
ratio of its smoothed share in the target and in the corpus. A document's weight
is the mean gain of its features; Gumbel noise on the weights draws documents
without replacement in proportion to their likelihood ratio.

The sum of gains is never taken feature by feature. A document's bucket counts
are cut into bit planes of one bit a bucket (plane i holds bit i of every count),
and so are the gains (two's complement; the last plane is the sign). The sum is

    sum over i, j of  2^i * w_j * popcount(count plane i AND gain plane j)

with w_j = 2^j, and -2^j for the sign: whole numbers throughout, hence exact.

Two passes over the texts: bucket totals (added up in each task, then by Spark),
then weights. Only the totals, one number a bucket, reach the driver.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .common import documents, lean, stored

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_WORDS = ta.byte_tables(_SEPARATORS, lower=True)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Longer words are hashed one by one.
_LONG = 64
#: Documents whose planes are built at once.
_BLOCK = 256


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0xEDB88320) ^ (t >> np.uint32(1)), t >> np.uint32(1))
    return t


_CRC = _crc_table()
_FULL = np.uint32(0xFFFFFFFF)


def _fed(state: np.ndarray, byte) -> np.ndarray:
    return _CRC[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def _crc_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 states after feeding each word's bytes to ``state``."""
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    at, out = starts[order], state[order]
    long_ = int(np.searchsorted(-length[order], -_LONG))  # words of more than _LONG bytes come first
    for r in range(long_):
        word = buf[at[r]:ends[order[r]]].tobytes()
        out[r] = zlib.crc32(word, int(out[r]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    steps = np.bincount(length[order[long_:]], minlength=1)
    left = len(order) - long_ - np.cumsum(steps)  # words longer than so many bytes
    for i in range(len(steps) - 1):
        part = slice(long_, long_ + int(left[i]))
        out[part] = _fed(out[part], buf[at[part] + i])
    result = np.empty_like(out)
    result[order] = out
    return result


def chunk_buckets(data, off, lo, hi, buckets: int, pairs: bool = True):
    """Of rows [lo, hi): row number and bucket of every feature, words per row."""
    raw, starts, ends, first = ta.word_spans(data, off, lo, hi, _WORDS)
    words = np.diff(first)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), words
    buf = _LOWER[raw]
    row = np.repeat(np.arange(hi - lo), words)
    one = _crc_words(buf, starts, ends, np.full(len(starts), _FULL))
    rows, crcs = [row], [one ^ _FULL]
    if pairs:
        second = np.flatnonzero(row[1:] == row[:-1]) + 1
        two = _crc_words(buf, starts[second], ends[second], _fed(one[second - 1], np.uint32(32)))
        rows.append(row[second])
        crcs.append(two ^ _FULL)
    return np.concatenate(rows), (np.concatenate(crcs) % np.uint32(buckets)).astype(np.int64), words


def _planes(values: np.ndarray, bits: int) -> np.ndarray:
    """(bits, words of 64) bit planes of a vector, or (rows, bits, words) of a matrix's rows."""
    wide = -(-values.shape[-1] // 64) * 64
    out = np.zeros((*values.shape[:-1], bits, wide), bool)
    for i in range(bits):
        out[..., i, :values.shape[-1]] = (values >> i) & 1
    return np.packbits(out, axis=-1, bitorder="little").view(np.uint64)


class GainPlanes:
    """Bit planes of signed gains, and the place value of each."""

    def __init__(self, gains: np.ndarray):
        bits = max(int(np.abs(gains).max(initial=0)).bit_length(), 1) + 1
        self.planes = _planes(gains, bits)
        self.value = np.array([1 << j for j in range(bits - 1)] + [-(1 << (bits - 1))], np.int64)

    def sums(self, row: np.ndarray, bucket: np.ndarray, rows: int, buckets: int) -> np.ndarray:
        """Sum of gains of each row's features, counted with repeats."""
        out = np.zeros(rows, np.int64)
        if not len(row):
            return out
        cell, count = np.unique(row * buckets + bucket, return_counts=True)
        row, bucket = cell // buckets, cell % buckets
        wide = self.planes.shape[-1] * 64
        for lo in range(0, rows, _BLOCK):
            i, j = np.searchsorted(row, [lo, lo + _BLOCK])
            n = min(_BLOCK, rows - lo)
            for bit in range(int(count[i:j].max(initial=0)).bit_length()):
                on = (count[i:j] >> bit) & 1 == 1
                flat = np.zeros((n, wide), bool)
                flat[row[i:j][on] - lo, bucket[i:j][on]] = True
                plane = np.packbits(flat, axis=1, bitorder="little").view(np.uint64)
                for gain, value in zip(self.planes, self.value):
                    out[lo:lo + n] += np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64) * (int(value) << bit)
        return out


def bucket_totals(texts: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket stands in ``texts`` (one column of text)."""
    name = texts.columns[0]

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            data, off = ta.text_buffers(b.column(name))
            for lo, hi in ta.chunks(off):
                total += np.bincount(chunk_buckets(data, off, lo, hi, buckets)[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(lean(run), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) per bucket."""
    k, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((a + 1.0) * (s + k) / ((b + 1.0) * (t + k))))
                     for a, b in zip(target.tolist(), corpus.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, n_words, n_features, weight."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        planes, buckets = GainPlanes(shared.value), len(shared.value)
        for b in batches:
            data, off = ta.text_buffers(b.column("text"))
            for lo, hi in ta.chunks(off):
                row, bucket, words = chunk_buckets(data, off, lo, hi, buckets)
                features = words + np.maximum(words - 1, 0)
                total = planes.sums(row, bucket, hi - lo, buckets)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array(words), pa.array(features),
                     pa.array(total // np.maximum(features, 1))], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.mapInArrow(lean(run), "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, buckets: int = 10000,
             seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs``.

    rank counts from 1 among the drawn ``percent`` of the documents with at
    least ``min_words`` words, by falling score, ties to the smaller id; it is NULL
    for all others. A NULL text has no features and weight 0. A NULL id has no
    score: it counts towards the corpus, is neither drawn nor one of the N. Repeated rows are
    documents of their own with equal scores. An empty ``docs`` gives no rows; an empty target has gains
    from smoothing alone. Other columns are ignored.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    aim = target.select(F.col(target_col).cast("string").alias("text"))
    gain = gains(bucket_totals(aim, buckets), bucket_totals(narrow.select("text"), buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weights(narrow, gain).withColumn("score", (F.col("weight") + noise).cast("long"))
    fit = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    # the salt only lets a sort cut a run of equal ids
    scored = stored(scored.withColumn("fit", fit).withColumn("salt", F.monotonically_increasing_id()), "resample-scores")
    return ranked(scored, percent).select("doc_id", "n_features", "weight", "score", "rank")


def ranked(scored: DataFrame, percent: int) -> DataFrame:
    """``scored`` with rank: a range-partitioned sort, then each partition's offset is added to its row numbers."""
    by = [F.desc("score"), F.asc("doc_id"), F.asc("salt")]
    placed = scored.where("fit").repartitionByRange(*by).sortWithinPartitions(*by).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    placed = stored(placed, "resample-order")
    sizes = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}  # one number a partition
    before, total = [], 0
    for part in sorted(sizes):
        before.append((part, total))
        total += sizes[part]
    before = scored.sparkSession.createDataFrame(before, "part int, before long")
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    order = placed.join(F.broadcast(before), "part").withColumn(
        "rank", F.when(rank <= percent * total // 100, rank))
    return order.select(*scored.columns, "rank").unionByName(
        scored.where("not fit").withColumn("rank", F.lit(None).cast("long")))


def op13_query(spark, sf_dir):
    return resample(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


# CRC-32 by table over the bytes of every distinct feature.
OP13_SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
src AS (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT kind, id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM src),
f AS (SELECT kind, id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS g FROM w),
fc AS (SELECT kind, id, g, count(*) AS n FROM f GROUP BY ALL),
hx AS (SELECT g, hex(encode(g)) AS x FROM (SELECT DISTINCT g FROM fc)),
b AS (SELECT g, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2),
        lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
      lambda c, v: xor(c >> 8, t[xor(c & 255, v) + 1])), 4294967295) % 10000 AS bucket FROM hx, crc),
n AS (SELECT bucket, sum(CASE WHEN kind = 0 THEN n ELSE 0 END) AS s, sum(CASE WHEN kind = 1 THEN n ELSE 0 END) AS t
      FROM fc JOIN b USING (g) GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(sum(s) OVER () AS DOUBLE) + 10000)
      / ((CAST(s AS DOUBLE) + 1) * (CAST(sum(t) OVER () AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM n),
d AS (SELECT id, sum(n) AS nf, sum(n * gain) AS total FROM fc JOIN b USING (g) JOIN gain USING (bucket) WHERE kind = 0 GROUP BY id),
s AS (SELECT w.id AS doc_id, len(ws) AS words, CAST(coalesce(nf, 0) AS BIGINT) AS n_features,
      CAST(coalesce((total - ((total % nf) + nf) % nf) // nf, 0) AS BIGINT) AS weight,
      CAST('0x' || substr(sha256('7:' || w.id), 1, 8) AS BIGINT) AS h FROM w LEFT JOIN d ON d.id = w.id WHERE kind = 0),
z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM s),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total FROM z WHERE words >= 20)
SELECT z.doc_id, n_features, weight, score, CASE WHEN r.rank <= 25 * r.total // 100 THEN r.rank END AS rank
FROM z LEFT JOIN r ON r.doc_id = z.doc_id
"""
