"""Preference formatting: one prompt, two masked completions.

A pair is two conversations, one chosen and one rejected. Their longest common prefix of turns (same number, role and
text) is the prompt and is rendered once; what follows in either is its completion. Only what the assistant says
in a completion counts for the loss: its text and line end, not the line with its role; the prompt and the other
turns are masked.

Everything is a join and an aggregate by turn, so a conversation of any length is no task's burden: the first place
where the two differ is the minimum of a full outer join on (pair, turn). ``rows_of_pairs`` has one row a pair, and
further ones for conversations with turn numbers of ``TURNS_PER_ROW`` and more, so that no row grows without bound.

Where a table names no preferences, ``swapped_replies`` makes them: the conversation as it is against the same turns
with the last thing that the assistant says in another one.

Results: turns without a conversation or a number are left out of the order and belong to no pair; a repeated turn
number keeps the smallest (role, text), missing values first; a missing role or text is empty and equals a missing
one; a missing partner is an empty conversation, so the pair has an empty prompt and one completion; two equal
conversations have a prompt and no completion. Extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
TURNS_PER_ROW = 64
OPEN, CLOSE = "<|", "|>"


def render(role: Column, text: Column) -> Column:
    """A turn as text: a line with the role, the text, a line end."""
    return F.concat(F.lit(OPEN), role, F.lit(CLOSE + "\n"), text, F.lit("\n"))


def neighbours(conversations: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected): conversations 2k and 2k + 1, whichever of them there are.

    Stands in for a table of preferences where there is none.
    """
    ids = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("c")).distinct()
    pair = F.floor(F.col("c") / 2).cast("long")
    return ids.groupBy(pair.alias("pair_id")).agg(F.min(F.when(F.pmod("c", F.lit(2)) == 0, F.col("c"))).alias("chosen"),
                                                   F.min(F.when(F.pmod("c", F.lit(2)) == 1, F.col("c"))).alias("rejected"))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, said), one row a turn; ``said`` is (role, text)."""
    return (conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL")
            .groupBy(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"))
            .agg(F.min(F.struct(F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))).alias("said")))


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Sides of a pair for every conversation: (pair_id, is_chosen, turn, said), ``pair_id`` being its conv_id.

    Chosen is the conversation itself. Rejected are the same turns, but the last one of the assistant has the text of the
    last one in its neighbour, 2k + 1 for 2k and 2k for 2k + 1. Where either has none, the rejected side is missing.
    """
    turns = turns_of(conversations)
    last = (turns.where(F.col("said.role") == ASSISTANT).groupBy("conv_id")
            .agg(F.max(F.struct("turn", "said.text")).alias("last")))
    neighbour = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("last.text").alias("other"))
    replies = last.join(neighbour, "conv_id").select("conv_id", F.col("last.turn").alias("at"), "other")
    text = F.when(F.col("turn") == F.col("at"), F.col("other")).otherwise(F.col("said.text"))
    rejected = turns.join(replies, "conv_id").select(F.col("conv_id").alias("pair_id"), F.lit(False).alias("is_chosen"), "turn",
                                                     F.struct(F.col("said.role").alias("role"), text.alias("text")).alias("said"))
    return turns.select(F.col("conv_id").alias("pair_id"), F.lit(True).alias("is_chosen"), "turn", "said").unionByName(rejected)


def sides_of(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same for given pairs: (pair_id, chosen, rejected), ids of conversations. A conversation may be in many pairs."""
    side = F.explode(F.array(F.struct(F.lit(True).alias("is_chosen"), F.col("chosen").alias("conv_id")),
                             F.struct(F.lit(False).alias("is_chosen"), F.col("rejected").alias("conv_id"))))
    members = pairs.select("pair_id", side.alias("m")).select("pair_id", "m.is_chosen", F.col("m.conv_id").cast("long").alias("conv_id")).where("conv_id IS NOT NULL")
    return members.join(turns_of(conversations), "conv_id").select("pair_id", "is_chosen", "turn", "said")


def segments(said: DataFrame) -> DataFrame:
    """(pair_id, segment, turn, role, text, rendered, loss), one row for each turn of prompt, chosen and rejected.

    said: (pair_id, is_chosen, turn, said), the sides of the pairs.
    """
    both = said.groupBy("pair_id", "turn").agg(
        F.min(F.when(F.col("is_chosen"), F.col("said"))).alias("chosen"), F.min(F.when(~F.col("is_chosen"), F.col("said"))).alias("rejected"))
    differs = ~F.coalesce(F.col("chosen") == F.col("rejected"), F.lit(False))
    parted = both.groupBy("pair_id").agg(F.min(F.when(differs, F.col("turn"))).alias("parted"))
    placed = both.join(parted, "pair_id").withColumn("common", F.col("parted").isNull() | (F.col("turn") < F.col("parted")))
    kinds = F.when(F.col("common"), F.array(F.struct(F.lit("prompt").alias("segment"), F.col("chosen").alias("said")))).otherwise(
        F.array(F.struct(F.lit("chosen").alias("segment"), F.col("chosen").alias("said")),
                F.struct(F.lit("rejected").alias("segment"), F.col("rejected").alias("said"))))
    rows = placed.select("pair_id", "turn", F.explode(kinds).alias("k")).where("k.said IS NOT NULL")
    role, text = F.col("k.said.role"), F.col("k.said.text")
    return rows.select("pair_id", F.col("k.segment").alias("segment"), "turn", role.alias("role"), text.alias("text"),
                       render(role, text).alias("rendered"), ((F.col("k.segment") != "prompt") & (role == ASSISTANT)).alias("loss"))


def rows_of_pairs(parts: DataFrame, turns_per_row: int = TURNS_PER_ROW) -> DataFrame:
    """(pair_id, stretch, prompt, chosen, rejected, chosen_mask, rejected_mask) from ``segments``.

    A row holds the turns numbered from ``stretch * turns_per_row`` on, so it has at most so many of each side; the texts of
    a pair's rows follow one another. A mask lists the spans (start, end) of characters of its
    row's completion that count for the loss.
    """
    def text(segment):
        own = F.filter("parts", lambda p: p.segment == segment)
        return F.array_join(F.transform(own, lambda p: p.rendered), "")

    def mask(segment):
        own = F.filter("parts", lambda p: p.segment == segment)
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
        walk = F.aggregate(own, zero, lambda acc, p: F.struct(
            (acc.at + F.length(p.rendered)).alias("at"),
            F.when(p.loss, F.concat(acc.spans, F.array(F.struct((acc.at + p.head).alias("start"), (acc.at + F.length(p.rendered)).alias("end")))))
            .otherwise(acc.spans).alias("spans")))
        return walk.spans

    head = (F.length("rendered") - F.length("text") - 1).alias("head")
    stretch = F.floor(F.col("turn") / turns_per_row).alias("stretch")
    gathered = parts.groupBy("pair_id", stretch).agg(F.array_sort(F.collect_list(F.struct("turn", "segment", "rendered", "loss", head))).alias("parts"))
    return gathered.select("pair_id", "stretch", text("prompt").alias("prompt"), text("chosen").alias("chosen"), text("rejected").alias("rejected"),
                           mask("chosen").alias("chosen_mask"), mask("rejected").alias("rejected_mask"))
