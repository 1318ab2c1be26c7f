"""Operator 4: cumulative-snapshot collapse of logged conversations, then rendering (DataFrame functions only).

Loggers that store a conversation after every turn leave many rows that are
prefixes of longer ones. A turn's hash tells its place, role and text; the hash of
a prefix is the sum of its turns' hashes, so it rolls along the turns. A
conversation whose whole hash is the hash of a prefix of a longer one is dropped
by an anti-join, and of equal conversations the smallest conv_id stays.

Rolling sums are taken in chunks of ``CHUNK`` turn numbers: a window runs within
a chunk, and the chunk totals before it are added, so one conversation with a
third of all turns is spread over many tasks. Rendering joins at most ``CHUNK``
turns to a part, so no row outgrows a bound on turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, stored

CHUNK = 256
END = "\n<|end|>\n"


def turn_hashes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(conv_id, chunk, turn, role, text, place, low, high): place from 1 and rolling prefix hash after each turn.

    Repeated rows of a turn count once; different rows of one turn number follow
    each other by role and text. NULL role and text are empty, a NULL turn number
    comes first, a NULL conv_id names one conversation.
    """
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / chunk), F.lit(-(1 << 62))))
    within = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    placed = rows.withColumn("r", F.row_number().over(within))
    sizes = rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("m"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk")
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.chunk") == F.col(f"{b}.chunk"))
    before = sizes.select("conv_id", "chunk", (F.sum("m").over(earlier) - F.col("m")).alias("before"))
    placed = (placed.alias("p").join(before.alias("b"), same("p", "b")).select(
        "p.conv_id", "p.chunk", "turn", "role", "text", (F.col("r") + F.col("before")).alias("place")))
    # sums of 32-bit halves cannot overflow; two independent hashes of 64 bits each
    one, two = F.xxhash64("place", "role", "text"), F.xxhash64("text", "role", "place", F.lit(17))
    halves = {"a": F.shiftright(one, 32), "b": one.bitwiseAND(0xFFFFFFFF), "c": F.shiftright(two, 32), "d": two.bitwiseAND(0xFFFFFFFF)}
    hashed = stored(placed.withColumns(halves), "chat-turns")
    rolling = Window.partitionBy("conv_id", "chunk").orderBy("place")
    inner = hashed.select("conv_id", "chunk", "turn", "role", "text", "place", *[F.sum(c).over(rolling).alias(c) for c in halves])
    totals = hashed.groupBy("conv_id", "chunk").agg(*[F.sum(c).alias(c) for c in halves])
    carry = totals.select("conv_id", "chunk", *[(F.sum(c).over(earlier) - F.col(c)).alias(f"{c}0") for c in halves])
    return (inner.alias("i").join(carry.alias("c"), same("i", "c"))
            .select("i.conv_id", "i.chunk", "turn", "role", "text", "place",
                    *[(F.col(f"i.{c}") + F.col(f"c.{c}0")).alias(c) for c in halves]))


def maximal_conversations(turns: DataFrame, **columns) -> DataFrame:
    """Turns (with place) of the conversations that no other one extends, one of equal ones."""
    hashed = stored(turn_hashes(turns, **columns), "chat-prefixes")
    key = ["place", "a", "b", "c", "d"]
    whole = (hashed.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("w")).select("conv_id", "w.*"))
    whole = stored(whole.groupBy(*key).agg(F.min("conv_id").alias("conv_id")), "chat-whole")
    # prefixes proper: those a further turn of the same conversation follows, once each
    longest = hashed.groupBy("conv_id").agg(F.max("place").alias("last"))
    prefixes = (hashed.alias("h").join(longest.alias("l"), F.col("h.conv_id").eqNullSafe(F.col("l.conv_id")) & (F.col("place") < F.col("last")))
                .select(*key).distinct())
    kept = whole.join(prefixes, key, "left_anti").select(F.col("conv_id").alias("_conv"))
    return hashed.join(kept, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi").select(
        "conv_id", "chunk", "turn", "place", "role", "text")


def render(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, text: turns in order between role marks, one row per chunk of turn numbers."""
    said = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit(END))
    parts = turns.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(F.struct("place", said.alias("s")))).alias("x"))
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("chunk")) - 1
    return parts.select("conv_id", number.alias("part"), F.size("x").cast("long").alias("n_turns"),
                        F.array_join(F.transform("x", lambda t: t["s"]), "").alias("text"))


def op4_query(spark, sf_dir):
    return render(maximal_conversations(documents(spark, sf_dir, "conversations")))


# Conversations as full strings; a prefix test on them stands for the rolling hashes.
OP4_SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM t),
h AS (SELECT conv_id, place, string_agg(md5(role || chr(1) || text), '') OVER (PARTITION BY conv_id ORDER BY place) AS pre FROM p),
w AS (SELECT min(conv_id) AS conv_id, pre, n FROM (SELECT conv_id, max(pre) AS pre, max(place) AS n FROM h GROUP BY conv_id) x GROUP BY pre, n),
k AS (SELECT w.conv_id FROM w WHERE NOT EXISTS (SELECT 1 FROM (SELECT h.conv_id, h.pre, h.place, count(*) OVER (PARTITION BY h.conv_id) AS last FROM h) y
      WHERE y.pre = w.pre AND y.place < y.last)),
c AS (SELECT p.conv_id, CAST(floor(turn / {CHUNK}.0) AS BIGINT) AS chunk, place, '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS s
      FROM p JOIN k ON p.conv_id = k.conv_id)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY chunk) - 1 AS INTEGER) AS part, n_turns, text
FROM (SELECT conv_id, chunk, count(*) AS n_turns, string_agg(s, '' ORDER BY place) AS text FROM c GROUP BY conv_id, chunk) z
"""
