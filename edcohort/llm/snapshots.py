"""Operator 10: collapse of cumulative conversation snapshots, then chat rendering.

Only DataFrame functions.  Each turn has a position-bound 128-bit hash; the exclusive-or of a
conversation's first k turn hashes is its rolling prefix hash of length k.  A conversation whose
whole hash is a strict prefix hash of a longer one is a snapshot of it and is removed by an
anti-join; of equal conversations the smallest id stays.

Rolling hashes run in two levels, within blocks of ``BLOCK`` turn numbers and over the
blocks' totals, so a conversation with a third of all turns is not one task's work; rendering
gives one row per conversation and block of turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freeze

#: Turn numbers in one block.
BLOCK = 1000
KEY = ("n", "h1", "h2")


def turns_of(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, block): distinct turns; null roles and texts are empty, a null
    turn number comes first, rows with a null conversation id form one conversation."""
    t = conversations.select(
        F.col(conv_col).alias("conv"), F.coalesce(F.col(turn_col).cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    return t.withColumn("block", F.floor(F.col("turn") / BLOCK))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv, turn, last, n, h1, h2) for each turn number of each conversation: count and hash of all
    turns up to it, and whether it is the last one."""
    h = lambda seed: F.xxhash64(F.lit(seed), "turn", "role", "text")
    t = turns.groupBy("conv", "block", "turn").agg(
        F.count("*").alias("n"), F.bit_xor(h(1)).alias("h1"), F.bit_xor(h(2)).alias("h2"))
    inside = Window.partitionBy("conv", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    blocks = t.groupBy("conv", "block").agg(F.sum("n").alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"),
                                            F.max("turn").alias("top"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("conv")
    blocks = blocks.select(F.col("conv").alias("b_conv"), F.col("block").alias("b_block"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                           F.coalesce(F.bit_xor("h1").over(before), F.lit(0)).alias("x1"),
                           F.coalesce(F.bit_xor("h2").over(before), F.lit(0)).alias("x2"),
                           F.max("top").over(every).alias("top"))
    t = t.select("conv", "block", "turn", *[f.over(inside).alias(c) for c, f in
                 (("n", F.sum("n")), ("h1", F.bit_xor("h1")), ("h2", F.bit_xor("h2")))])
    j = t.join(blocks, t["conv"].eqNullSafe(blocks["b_conv"]) & (t["block"] == blocks["b_block"]))
    return j.select("conv", "turn", (F.col("turn") == F.col("top")).alias("last"), (F.col("n") + F.col("n0")).alias("n"),
                    F.col("h1").bitwiseXOR(F.col("x1")).alias("h1"), F.col("h2").bitwiseXOR(F.col("x2")).alias("h2"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies) of the conversations that are no snapshot of a longer one; of
    equal ones the smallest id, with their number."""
    prefixes = freeze(prefix_hashes(turns))
    whole = prefixes.where("last").groupBy(*KEY).agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    inner = prefixes.where("not last").select(*KEY).distinct()
    return whole.join(inner, list(KEY), "left_anti").select("conv", F.col("n").alias("n_turns"), "n_copies")


def render_maximal(conversations: DataFrame, *, prefix: str = "<|", suffix: str = "|>\n", end: str = "<|end|>\n", **cols) -> DataFrame:
    """(conv_id, part, n_turns, n_copies, text): the maximal conversations, rendered turn by turn as
    ``prefix role suffix text end``; ``part`` is the block of turn numbers.  Turns with the same
    number follow by role, then text.  An empty table gives no rows."""
    turns = turns_of(conversations, **cols)
    keep = freeze(maximal_conversations(turns))
    t = turns.join(keep.withColumnRenamed("conv", "k"), F.col("conv").eqNullSafe(F.col("k")))
    line = F.concat(F.lit(prefix), "role", F.lit(suffix), "text", F.lit("\n"), F.lit(end))
    got = t.groupBy("conv", "block", "n_turns", "n_copies").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", line.alias("line")))).alias("rows"))
    return got.select(F.col("conv").alias("conv_id"), F.col("block").alias("part"), "n_turns", "n_copies",
                      F.array_join(F.transform("rows", lambda r: r["line"]), "").alias("text"))
