"""Preference formatting: pairs of conversations as one prompt and two masked completions.

Only DataFrame functions: no Python runs on the executors.

The longest common prefix of turns (equal role and text) of the chosen and the rejected
conversation is rendered once as the prompt; what follows in each is its completion.  A turn is
rendered as ``<|role|>``, a line feed, the text and a line feed.  The mask of a completion lists the
spans of characters (start, end) on which the loss is taken: the texts of assistant turns with the
line feed that ends them.

A training example is one row, so the turns of one pair meet in one row by its nature; they are
grouped with one shuffle by pair.

Edge cases: a null role or text counts as empty; turns sort by turn (null first), role, text, and
repeated rows are repeated turns; rows with a null conversation belong to none; a pair with one
conversation has an empty prompt and an empty other completion; equal conversations have empty
completions; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import let

TRAINED = "assistant"


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("\n"))), "")


def _mask(turns: Column) -> Column:
    """Spans of the trained texts in the rendered turns."""
    spans = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc, t):
        a = acc["at"] + F.length(t["role"]) + 5
        b = a + F.length(t["text"]) + 1
        own = F.array(F.struct(a.alias("start"), b.alias("end")))
        return F.struct(b.alias("at"), F.when(t["role"] == TRAINED, F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), spans.alias("spans")), step, lambda a: a["spans"])


def preference_pairs(turns: DataFrame, pairs: Column, side: Column) -> DataFrame:
    """pair_id, prompt, chosen, rejected, their turns, and the masks of both completions.

    ``pairs`` gives the pair of a turn's conversation and ``side`` is 0 for chosen, 1 for rejected.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(pairs.alias("pair_id"), F.struct(side.alias("side"), F.col("turn"), text("role").alias("role"), text("text").alias("text")).alias("t"))
    both = rows.groupBy("pair_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    split = both.select("pair_id", F.filter("t", lambda x: x["side"] == 0).alias("_a"), F.filter("t", lambda x: x["side"] == 1).alias("_b"))
    same = F.zip_with("_a", "_b", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    shared = let(same, lambda s: F.when(F.array_contains(s, False), F.array_position(s, False) - 1).otherwise(F.size(s)).cast("int"))
    cut = split.withColumn("_n", shared)
    rest = lambda c: F.slice(F.col(c), F.col("_n") + 1, F.greatest(F.size(c), F.lit(1)))
    parts = cut.select("pair_id", "_n", F.size("_a").alias("_na"), F.size("_b").alias("_nb"), F.slice("_a", F.lit(1), F.col("_n")).alias("_p"), rest("_a").alias("_a"), rest("_b").alias("_b"))
    return parts.select(
        "pair_id", F.col("_n").cast("long").alias("n_prompt_turns"), F.col("_na").cast("long").alias("n_chosen_turns"), F.col("_nb").cast("long").alias("n_rejected_turns"),
        _rendered(F.col("_p")).alias("prompt"), _rendered(F.col("_a")).alias("chosen"), _rendered(F.col("_b")).alias("rejected"),
        _mask(F.col("_a")).alias("chosen_mask"), _mask(F.col("_b")).alias("rejected_mask"),
    )


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
