"""Chat formatting: collapse of cumulative snapshots, then rendering.

A logged conversation is often logged again with each further turn. The rolling hash of a
conversation's turns names each of its prefixes. A conversation whose whole hash is another's
prefix hash at the same length is a snapshot of a longer one: an anti join takes it out. Of
conversations with the same turns, the one with the smallest id stays (null last). What is left
is maximal and rendered turn by turn.

The rolling hash of the first k turns is the XOR of 128-bit hashes of (place, role, text), so it
is a window's running aggregate: no text goes through the joins, nothing is rebuilt per
prefix. Prefixes are distinct before the join, so one first turn that a third of all
conversations share is one row a task. Turns of one conversation meet in one task for
rendering, since they make one text; their number is that of one conversation.

Columns and SQL functions only. Defined cases: turns are ordered by ``turn`` (null first), then
role and text; null roles and texts render as empty and differ from empty ones in the hash.
Equal rows of one conversation count once. Rows with a null conversation id are one
conversation. Other columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How a turn is written; marks that a text holds itself are taken apart by a zero-width space.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def rendered_turn(role: Column, text: Column) -> Column:
    def plain(value: Column) -> Column:
        value = F.coalesce(value, F.lit(""))
        return F.replace(F.replace(value, F.lit(OPEN), F.lit("<​|im_start|>")), F.lit(CLOSE), F.lit("<​|im_end|>"))

    return F.concat(F.lit(OPEN), plain(role), F.lit("\n"), plain(text), F.lit(CLOSE + "\n"))


def prefixes(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """One row per different turn: ``conv_id, place`` (from 1), ``role, text, high, low``
    (rolling hash of the turns up to here), ``n_turns``."""
    rows = turns.select(*[F.col(f"`{c}`").alias(n) for c, n in
                          ((conv_id, "conv_id"), (turn, "turn"), (role, "role"), (text, "text"))])
    rows = rows.withColumn("digest", F.md5(F.to_json(F.struct("turn", "role", "text"))))
    # equal rows of a conversation stand side by side, so the first of them is told by its neighbour
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("again", F.coalesce(F.lag("digest").over(order) == F.col("digest"), F.lit(False))).where("not again")
    numbered = rows.withColumn("place", F.row_number().over(order))
    own = F.md5(F.to_json(F.struct("place", "role", "text"), {"ignoreNullFields": "true"}))
    half = [F.conv(F.substring(own, at, 15), 16, 10).cast("long") for at in (1, 17)]
    rolling = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("conv_id")
    return numbered.select(
        "conv_id", "place", "role", "text",
        F.bit_xor(half[0]).over(rolling).alias("high"), F.bit_xor(half[1]).over(rolling).alias("low"),
        F.count(F.lit(1)).over(whole).alias("n_turns"))


def maximal(prefixed: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies`` of the conversations that are prefixes of no other:
    ``n_copies`` conversations have these very turns."""
    whole = prefixed.where("place = n_turns").groupBy("n_turns", "high", "low").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    inner = prefixed.where("place < n_turns").select(F.col("place").alias("n_turns"), "high", "low").distinct()
    return whole.join(inner, ["n_turns", "high", "low"], "left_anti").select("conv_id", "n_turns", "n_copies")


def render(prefixed: DataFrame, kept: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies, text`` of the kept conversations."""
    turns = prefixed.select("conv_id", "place", rendered_turn(F.col("role"), F.col("text")).alias("written"))
    chosen = turns.join(kept.withColumnRenamed("conv_id", "kept_id"), F.col("conv_id").eqNullSafe(F.col("kept_id")))
    return chosen.groupBy("conv_id").agg(
        F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "written"))), lambda t: t["written"]), "").alias("text"))


def formatted(turns: DataFrame, **columns: str) -> DataFrame:
    """The maximal conversations, rendered."""
    prefixed = prefixes(turns, **columns)
    return render(prefixed, maximal(prefixed))
