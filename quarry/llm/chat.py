"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

A chat logged after every turn leaves one conversation per snapshot, each a
prefix of the next. Every conversation gets a rolling hash of its turns so
far; a conversation whose whole hash is the hash of a proper prefix of
another is such a snapshot and goes, and of identical conversations the
smallest id stays. What remains is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns of a conversation hashed and rendered together; a longer one is dealt
#: over several tasks and rendered in parts.
BLOCK_TURNS = 64
TEMPLATE = ("<|", "|>\n", "<|end|>\n")
_FIRST = -(2 ** 63)


def _turns(convs: DataFrame) -> DataFrame:
    turn = F.coalesce(convs["turn"].cast("long"), F.lit(_FIRST))
    return convs.select(
        convs["conv_id"].cast("long").alias("conv_id"), turn.alias("turn"),
        F.floor(turn / F.lit(float(BLOCK_TURNS))).cast("long").alias("part"),
        F.coalesce(convs["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(convs["text"].cast("string"), F.lit("")).alias("text"))


def _xor(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0).cast("long")).bitwiseXOR(F.coalesce(b, F.lit(0).cast("long")))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, part, turn, p1, p2, n): two rolling hashes and the row count
    of every conversation up to and with each of its turns.

    A turn's hash holds its number, so the xor over a set of turns stands for
    the sequence. The running xor is taken in two levels, over whole blocks
    of turns and then inside a block, so one huge conversation is not one
    task's work."""
    row = turns.select("conv_id", "part", "turn",
                       F.xxhash64("turn", "role", "text").alias("h1"),
                       F.xxhash64("text", "role", "turn", F.lit(17)).alias("h2")).distinct()
    turn = row.groupBy("conv_id", "part", "turn").agg(
        F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.count(F.lit(1)).alias("c"))
    block = turn.groupBy("conv_id", "part").agg(
        F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"), F.sum("c").alias("bc"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = block.select(
        F.col("conv_id").alias("_c"), F.col("part").alias("_p"),
        F.bit_xor("b1").over(before).alias("o1"), F.bit_xor("b2").over(before).alias("o2"),
        F.sum("bc").over(before).alias("oc"))
    inside = Window.partitionBy("conv_id", "part").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    running = turn.select(
        "conv_id", "part", "turn", F.bit_xor("h1").over(inside).alias("r1"),
        F.bit_xor("h2").over(inside).alias("r2"), F.sum("c").over(inside).alias("rc"))
    return (running.join(offset, running["conv_id"].eqNullSafe(offset["_c"]) & (running["part"] == offset["_p"]))
            .select("conv_id", "part", "turn", _xor(F.col("r1"), F.col("o1")).alias("p1"),
                    _xor(F.col("r2"), F.col("o2")).alias("p2"),
                    (F.col("rc") + F.coalesce("oc", F.lit(0))).alias("n")))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that prefix no other
    one; the smallest id stands for identical ones."""
    prefix = prefix_hashes(turns)
    whole = prefix.groupBy("conv_id").agg(F.max(F.struct("turn", "p1", "p2", "n")).alias("w")).select("conv_id", "w.*")
    one = whole.groupBy("p1", "p2", "n").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    last = whole.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_last"))
    proper = (prefix.join(last, prefix["conv_id"].eqNullSafe(last["_c"]) & (prefix["turn"] < last["_last"]))
              .select("p1", "p2", "n").distinct())
    return (one.join(proper, ["p1", "p2", "n"], "left_anti")
            .select("conv_id", F.col("n").alias("n_turns"), "n_copies"))


def format_chats(convs: DataFrame) -> DataFrame:
    """Maximal conversations rendered: (conv_id, part, n_turns, n_copies, text).

    ``part`` is the turn number divided by 64 (one row per conversation up to
    64 turns); ``n_turns`` counts the conversation's distinct rows. Turns are
    compared by number, role and text; repeated rows count once; rows with
    the same turn number are ordered by role and text. A null turn comes
    first (in a part of its own), a null role or text is empty, and the rows
    with a null id form one conversation (which, being without an id, never
    stands for identical ones that have one). An empty table gives an empty
    result; other columns are not read.
    """
    turns = _turns(convs)
    keep = maximal(turns)
    parts = turns.select("conv_id", "part").distinct()
    kept = (parts.join(keep, parts["conv_id"].eqNullSafe(keep["conv_id"]))
            .select(parts["conv_id"].alias("_c"), parts["part"].alias("_p"), "n_turns", "n_copies"))
    a, b, c = TEMPLATE
    lines = F.transform(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))),
                        lambda t: F.concat(F.lit(a), t["role"], F.lit(b), t["text"], F.lit(c)))
    return (turns.join(kept, turns["conv_id"].eqNullSafe(kept["_c"]) & (turns["part"] == kept["_p"]))
            .groupBy("conv_id", "part").agg(
                F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"),
                F.array_join(lines, "").alias("text")))


ORACLE = f"""
WITH t AS (
  SELECT DISTINCT conv_id, coalesce(turn, {_FIRST}) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations),
c AS (
  SELECT conv_id, list({{'turn': turn, 'role': role, 'text': text}} ORDER BY turn, role, text) AS l,
         max(turn) AS last, count(*) AS n FROM t GROUP BY conv_id),
one AS (SELECT l, last, n, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY l, last, n),
keep AS (
  SELECT conv_id, n AS n_turns, n_copies FROM one a
  WHERE NOT EXISTS (
    SELECT 1 FROM c b WHERE b.l[1] = a.l[1] AND b.last > a.last
      AND list_filter(b.l, lambda x: x.turn <= a.last) = a.l))
SELECT k.conv_id, CAST(floor(turn / {BLOCK_TURNS}.0) AS BIGINT) AS part, n_turns, n_copies,
       string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), ''
                  ORDER BY turn, role, text) AS text
FROM t JOIN keep k ON t.conv_id IS NOT DISTINCT FROM k.conv_id
GROUP BY k.conv_id, part, n_turns, n_copies
"""
