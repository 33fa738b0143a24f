"""Preference formatting: the turns that a chosen and a rejected conversation share at their beginning
are the prompt, rendered once; what follows is rendered as a pair of completions in which only the
assistant's words are learnt.

The result has one row per rendered turn, with its place in the rendering, as a conversation can be of
any length: concatenating a part's segments by ``start`` gives its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, stage

ASSISTANT = "assistant"
# The template around a turn's text.
HEAD, HEAD_END, TURN_END = "<|", "|>\n", "<|end|>\n"
# end of fixed values
#: Turns whose lengths are added up together before places are known.
STRETCH = 1024
PROMPT, CHOSEN, REJECTED = "prompt", "chosen", "rejected"


def turns_of(turns: DataFrame, pair: str, turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per pair and turn: pair_id, turn, said (role, text). Rows without a pair or a turn are no
    turns; of several rows for one turn the least by role and text counts; null roles and texts count
    as empty."""
    said = F.struct(F.coalesce(quoted(role), F.lit("")).alias("role"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    rows = turns.select(quoted(pair).alias("pair_id"), quoted(turn).alias("turn"), said.alias("said"))
    return rows.where(F.col("pair_id").isNotNull() & F.col("turn").isNotNull()).groupBy("pair_id", "turn").agg(F.min("said").alias("said"))


def swapped_replies(turns: DataFrame, conversation: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Pairs out of plain conversations: chosen is a conversation up to its last reply; rejected is the
    same with the last reply of the neighbour (ids 2i and 2i+1) in its place, empty where the neighbour
    has none. Conversations without a reply make no pair. Both frames have pair_id, turn, role, text."""
    rows = stage(turns_of(turns, conversation), "chat-rows")
    replies = rows.where(F.col("said.role") == ASSISTANT)
    last = stage(replies.groupBy("pair_id").agg(F.max("turn").alias("last")), "chat-last")
    bounded = rows.join(last, "pair_id")
    kept = bounded.where(F.col("turn") <= F.col("last")).select("pair_id", "turn", "said.role", "said.text")
    before = bounded.where(F.col("turn") < F.col("last")).select("pair_id", "turn", "said.role", "said.text")
    other = replies.join(last.select("pair_id", F.col("last").alias("turn")), ["pair_id", "turn"])
    other = other.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("said.text").alias("text"))
    swapped = last.join(other, "pair_id", "left").select("pair_id", F.col("last").alias("turn"), F.lit(ASSISTANT).alias("role"), "text")
    return kept, before.unionByName(swapped)


def rendered(role: Column, text: Column) -> tuple[Column, Column]:
    """The rendered turn and the length of what stands before its text."""
    head = F.concat(F.lit(HEAD), role, F.lit(HEAD_END))
    return F.concat(head, text, F.lit(TURN_END)), F.length(head)


def preferences(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id") -> DataFrame:
    """pair_id, part (prompt, chosen or rejected), turn, role, segment (the rendered turn), start and end
    (characters of the part's rendering), learn_from and learn_to (what the loss covers: the assistant's
    text and the end mark within completions; null where all is masked).

    Turns are compared by role and text, place by place; the first place where they differ, or where one
    side has no turn, ends the prompt. Equal conversations have completions of no turns; conversations
    that differ at once have no prompt; a pair that only one side knows has one completion. See
    :func:`turns_of` for nulls and repeated rows. Empty tables give an empty table.
    """
    left = turns_of(chosen, pair).withColumnRenamed("said", "c")
    right = turns_of(rejected, pair).withColumnRenamed("said", "r")
    same = F.col("c").eqNullSafe(F.col("r"))
    both = left.join(right, ["pair_id", "turn"], "full").select("pair_id", "turn", "c", F.when(~same, F.col("r")).alias("r"), same.alias("same"))
    both = stage(both, "chat-turns")
    fork = stage(both.where(~F.col("same")).groupBy("pair_id").agg(F.min("turn").alias("fork")), "chat-forks")
    # after the fork, a turn that both sides happen to share belongs to both completions
    part = F.when(F.col("fork").isNull() | (F.col("turn") < F.col("fork")), F.array(F.struct(F.lit(PROMPT).alias("part"), F.col("c").alias("said"))))
    told = F.when(F.col("same"), F.col("c")).otherwise(F.col("r"))
    pairs = F.array(F.struct(F.lit(CHOSEN).alias("part"), F.col("c").alias("said")), F.struct(F.lit(REJECTED).alias("part"), told.alias("said")))
    parts = both.join(fork, "pair_id", "left").select("pair_id", "turn", F.explode(part.otherwise(pairs)).alias("p"))
    parts = parts.where(F.col("p.said").isNotNull()).select("pair_id", "turn", "p.part", "p.said.role", "p.said.text")
    segment, head = rendered(F.col("role"), F.col("text"))
    sized = parts.select("pair_id", "part", "turn", "role", segment.alias("segment"), head.cast("bigint").alias("head"))
    placed = starts(sized.withColumn("size", F.length("segment").cast("bigint")), ["pair_id", "part"], "turn", "size")
    learnt = (F.col("part") != PROMPT) & (F.col("role") == ASSISTANT)
    end = F.col("start") + F.col("size")
    return placed.select(
        "pair_id", "part", "turn", "role", "segment", "start", end.alias("end"),
        F.when(learnt, F.col("start") + F.col("head")).alias("learn_from"), F.when(learnt, end).alias("learn_to"),
    )


def starts(rows: DataFrame, keys: list[str], order: str, size: str) -> DataFrame:
    """``rows`` with ``start``, the sum of ``size`` over the earlier rows of the same keys. Sums are made
    by stretches of ``order`` first, so a key with very many rows is worked on by many tasks."""
    cut = rows.withColumn("stretch", F.floor(F.col(order) / STRETCH))
    earlier = Window.unboundedPreceding, -1
    within = Window.partitionBy(*keys, "stretch").orderBy(order).rowsBetween(*earlier)
    across = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(*earlier)
    sums = cut.groupBy(*keys, "stretch").agg(F.sum(size).alias("sum"))
    bases = sums.select(*keys, "stretch", F.coalesce(F.sum("sum").over(across), F.lit(0)).alias("base"))
    local = cut.withColumn("local", F.coalesce(F.sum(size).over(within), F.lit(0)))
    return local.join(bases, [*keys, "stretch"]).withColumn("start", F.col("base") + F.col("local")).drop("stretch", "local", "base")
