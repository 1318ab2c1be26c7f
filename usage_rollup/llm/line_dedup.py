"""Operator 1: line dedup by a log-template tree (DataFrame functions only).

A line is cut into tokens and descends a tree of fixed depth: first by its token
count, then by its leading tokens. Tokens that hold a digit are variable fields
(``<*>``) everywhere. At the leaf the remaining tokens form ``SEGMENTS`` runs, and
a line stands under its full template and, if it is long enough, under each
template that leaves one run open: lines that agree in the leaf and in all other
runs share such a template, whatever stands in the open field. A template that
several documents hold recurs; its first document (smallest doc_id) keeps the
line, all others lose it.

Only hashes are shuffled. The first document of each template is a pre-aggregated
minimum, so a line that a third of all documents hold costs one row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, stored

DEPTH = 3
SEGMENTS = 4
MIN_TOKENS = 5
#: Fewest tokens for templates with an open run; below, one run is too large a share of the line.
MIN_OPEN = 12


def template_keys(line: Column, depth: int = DEPTH, min_tokens: int = MIN_TOKENS, min_open: int = MIN_OPEN) -> Column:
    """Array of template hashes of a line; empty for lines of fewer than ``min_tokens`` tokens."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", "<*>")).otherwise(line)
    tokens = F.split(F.btrim(masked, F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")
    return _let(tokens, lambda t: F.when(F.size(t) < min_tokens, F.array().cast("array<bigint>")).otherwise(_keys(t, depth, min_open)))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _keys(t: Column, depth: int, min_open: int) -> Column:
    n = F.size(t)
    step = F.greatest(F.ceil((n - depth) / SEGMENTS).cast("int"), F.lit(1))
    # the leaf's hash, then one for each run of the remaining tokens
    hashes = F.array(F.xxhash64(n, F.slice(t, 1, depth)), *[F.xxhash64(F.slice(t, depth + 1 + i * step, step)) for i in range(SEGMENTS)])

    def keys(h):
        full = F.xxhash64(F.lit(-1), *[h[i] for i in range(SEGMENTS + 1)])
        opened = [F.xxhash64(F.lit(i), h[0], *[h[j + 1] for j in range(SEGMENTS) if j != i]) for i in range(SEGMENTS)]
        return F.when(n < min_open, F.array(full)).otherwise(F.array(full, *opened))

    return _let(hashes, keys)


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                    min_tokens: int = MIN_TOKENS, min_open: int = MIN_OPEN) -> DataFrame:
    """(doc_id, text_hash, line) of the lines to drop, counted from 0, once each.

    text_hash (xxhash64 of the text) tells rows of one doc_id apart. Rows without
    an id or text neither lose lines nor count.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(
        "doc_id is not null and text is not null")
    lines = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line", "content"))
    keyed = stored(lines.select("doc_id", "text_hash", "line", template_keys(F.col("content"), depth, min_tokens, min_open).alias("keys"))
                   .where(F.size("keys") > 0), "line-templates")
    each = keyed.select("doc_id", "text_hash", "line", F.explode("keys").alias("key"))
    first = (each.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
             .where(F.col("first") < F.col("last")).select("key", "first"))
    return (each.join(first, "key").where(F.col("first") < F.col("doc_id")).select("doc_id", "text_hash", "line").distinct())


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                         min_tokens: int = MIN_TOKENS, min_open: int = MIN_OPEN) -> DataFrame:
    """``docs`` with recurring lines cut out of the text and the column ``n_dropped``.

    All rows and columns stay (a column named ``n_dropped`` is replaced). Texts
    without recurring lines, NULL and empty ones are unchanged; a text that loses
    all lines becomes empty. Repeated rows lose the same lines each.
    """
    taken = {c.lower() for c in docs.columns}
    doc, hash_, gone_ = (free_name(n, taken) for n in ("_doc", "_hash", "_gone"))
    gone = (recurring_lines(docs, id_col, text_col, depth, min_tokens, min_open).groupBy("doc_id", "text_hash")
            .agg(F.collect_list("line").alias(gone_)).withColumnsRenamed({"doc_id": doc, "text_hash": hash_}))
    text = F.col(text_col).cast("string")
    both = docs.drop("n_dropped").join(gone, (F.col(id_col).cast("long") == F.col(doc)) & (F.xxhash64(text) == F.col(hash_)), "left")
    lines = F.split(text, "\n")
    kept = F.transform(F.array(F.struct(lines.alias("l"), F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone_)).alias("k"))),
                       lambda s: F.array_join(F.transform(s["k"], lambda i: F.get(s["l"], i)), "\n"))[0]
    return (both.withColumn(text_col, F.when(F.col(gone_).isNull(), F.col(text_col)).otherwise(kept))
            .withColumn("n_dropped", F.coalesce(F.size(gone_), F.lit(0)).cast("long")).drop(gone_, doc, hash_))


def free_name(name: str, taken: set[str]) -> str:
    """``name`` with as many underscores in front as make it none of ``taken`` (lower case)."""
    while name in taken:
        name = f"_{name}"
    return name


def op1_query(spark, sf_dir):
    return drop_recurring_lines(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_dropped", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars_left"),
        F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


_TOKENS = r"string_split_regex(regexp_replace(CASE WHEN regexp_matches(l, '[0-9]') THEN regexp_replace(l, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g') ELSE l END, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '[\x20\x09-\x0D]+')"

# Templates as plain text: token count, leading tokens, and the four runs with '?' for an open one.
OP1_SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(ls))) AS line, unnest(ls) AS l
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL) a),
tok AS (SELECT doc_id, line, l, t, len(t) AS n, greatest(CAST(ceil((len(t) - {DEPTH}) / {SEGMENTS}.0) AS BIGINT), 1) AS s
        FROM (SELECT *, {_TOKENS} AS t FROM lines) b WHERE len(t) >= {MIN_TOKENS}),
runs AS (SELECT doc_id, line, n, array_to_string(t[1:{DEPTH}], ' ') AS lead,
                [{", ".join(f"array_to_string(t[{DEPTH} + {i} * s + 1:{DEPTH} + {i + 1} * s], ' ')" for i in range(SEGMENTS))}] AS r FROM tok),
keys AS (SELECT doc_id, line, unnest(CASE WHEN n < {MIN_OPEN} THEN [-1] ELSE [-1, 0, 1, 2, 3] END) AS o, n, lead, r FROM runs),
templ AS (SELECT doc_id, line, concat_ws(chr(1), n, lead, o, {", ".join(f"CASE WHEN o = {i} THEN '?' ELSE r[{i + 1}] END" for i in range(SEGMENTS))}) AS k FROM keys),
firsts AS (SELECT k, min(doc_id) AS f FROM templ GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT t.doc_id, t.line FROM templ t JOIN firsts f ON t.k = f.k AND f.f < t.doc_id),
kept AS (SELECT d.doc_id, string_agg(l.l, chr(10) ORDER BY l.line) AS txt, count(*) AS m
         FROM documents d JOIN lines l ON l.doc_id = d.doc_id
         WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = l.doc_id AND g.line = l.line) GROUP BY d.doc_id),
cnt AS (SELECT doc_id, count(*) AS g FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.g, 0) AS n_dropped, CAST(length(coalesce(k.txt, '')) AS BIGINT) AS chars_left,
       md5(coalesce(k.txt, '')) AS text_md5
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN cnt c ON c.doc_id = d.doc_id
"""
