"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions.

Logs hold the same conversation many times, each snapshot one or more turns
longer.  Every turn's prefix has a rolling hash: the exclusive-or of the
hashes of the turns so far, each salted with its place (two independent
64-bit hashes).  A conversation whose last prefix is a proper prefix of some
longer conversation goes by an anti-join; of equal conversations the smallest
id stays.  The conversations left are rendered.

Turns are ranked within blocks of 256 (``BLOCK_BITS``) turn numbers and shifted by
the turns of earlier blocks, so a conversation of any length is spread over
tasks.  Only hashes travel until the end; the texts of the conversations that
stay are shuffled once, in parts of at most 1024 (``PART_BITS``) turn
numbers.

Edge cases: a row without a conversation id belongs to no conversation and
is left out; a null role or text counts as empty; repeated rows of a
conversation count once; turns are ordered by number (null first, then
negative ones), ties by the hashes of role and text; gaps in the numbers do
not matter; an empty table gives an empty result.  Other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import stage

BLOCK_BITS = 8
PART_BITS = 10
#: Below every block number of a turn.
_NO_TURN = -(1 << 62)


def _named(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    return conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"), role.alias("role"), text.alias("text"),
        F.xxhash64(role, F.lit("\x00"), text).alias("h1"), F.xxhash64(F.lit("second"), text, F.lit("\x00"), role).alias("h2"),
    )


def _block(bits: int) -> Column:
    return F.coalesce(F.shiftright("turn", bits), F.lit(_NO_TURN))


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, p1, p2)``: rolling hashes of every prefix, from
    distinct ``(conv_id, turn, h1, h2)``."""
    rows = turns.select("conv_id", "turn", "h1", "h2").distinct().withColumn("block", _block(BLOCK_BITS))
    within = Window.partitionBy("conv_id", "block").orderBy("turn", "h1", "h2")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv_id", "block").count()
    # Most conversations are one block and need no shift.
    shift = counts.withColumn("before", F.sum("count").over(earlier)).where("before is not null").drop("count")
    placed = rows.join(shift, ["conv_id", "block"], "left").withColumn("place", F.row_number().over(within) + F.coalesce("before", F.lit(0)))
    salted = placed.select("conv_id", "block", "turn", "h1", "h2", "place", F.xxhash64("place", "h1").alias("g1"), F.xxhash64("h2", "place").alias("g2"))
    sofar = within.rowsBetween(Window.unboundedPreceding, 0)
    rolled = salted.withColumns({"p1": F.bit_xor("g1").over(sofar), "p2": F.bit_xor("g2").over(sofar)})
    sums = salted.groupBy("conv_id", "block").agg(F.bit_xor("g1").alias("s1"), F.bit_xor("g2").alias("s2"))
    carried = sums.withColumns({"c1": F.bit_xor("s1").over(earlier), "c2": F.bit_xor("s2").over(earlier)}).where("c1 is not null").drop("s1", "s2")
    whole = rolled.join(carried, ["conv_id", "block"], "left")
    mixed = {p: F.col(p).bitwiseXOR(F.coalesce(F.col(c), F.lit(0).cast("bigint"))) for p, c in (("p1", "c1"), ("p2", "c2"))}
    return whole.select("conv_id", F.col("place").cast("bigint").alias("place"), *[v.alias(k) for k, v in mixed.items()])


def maximal(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, n_copies)`` of the conversations that are no
    proper prefix of another, one for each distinct content."""
    every = stage(prefixes(turns), "turn-prefixes")
    last = every.groupBy("conv_id").agg(F.max(F.struct("place", "p1", "p2")).alias("end"))
    ends = last.groupBy("end").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    ends = ends.select("conv_id", F.col("end.place").alias("place"), F.col("end.p1").alias("p1"), F.col("end.p2").alias("p2"), "n_copies")
    length = last.select("conv_id", F.col("end.place").alias("length"))
    proper = every.join(length, "conv_id").where("place < length").select("place", "p1", "p2").distinct()
    return ends.join(proper, ["place", "p1", "p2"], "left_anti").select("conv_id", F.col("place").alias("n_turns"), "n_copies")


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>\n"))


def format_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, part, n_turns, n_copies, chat)`` of the conversations that
    stay: ``chat`` is the rendered text, ``n_turns`` the turns of the whole
    conversation and ``part`` the turn number over 1024 (null, and first, for
    turns without a number)."""
    turns = _named(conversations, conv_col, turn_col, role_col, text_col)
    kept = stage(maximal(turns), "maximal-conversations")
    rows = turns.withColumn("part", _block(PART_BITS)).join(kept, "conv_id")
    said = F.array_sort(F.collect_set(F.struct("turn", "h1", "h2", "role", "text")))
    parts = rows.groupBy("conv_id", "part", "n_turns", "n_copies").agg(said.alias("said"))
    chat = F.array_join(F.transform("said", lambda t: render_turn(t["role"], t["text"])), "")
    return parts.select("conv_id", F.when(F.col("part") != _NO_TURN, F.col("part")).alias("part"), "n_turns", "n_copies", chat.alias("chat"))
