"""Preference formatting: one shared prompt and a pair of masked completions per preference pair.

The chosen and the rejected conversation of a pair are compared turn by turn. Their longest common
prefix of turns is rendered once as the prompt; what follows on either side is a completion whose
mask lists the code-point spans of assistant texts (the part a trainer takes a loss on).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def _render(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("\n"))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _mask(turns: Column) -> Column:
    """[start, end) of each assistant text in the rendered turns, in code points."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(t["role"]) + 5
        end = start + F.length(t["text"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"),
                        F.when(t["role"] == ASSISTANT, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, empty, step)["spans"]


def format_pairs(turns: DataFrame, pair: str = "pair_id", side: str = "side", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """Format preference pairs given as one row per turn; ``side`` is 'chosen' or 'rejected'.

    Returns one row per pair id: ``pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask,
    rejected_mask``. A turn renders as ``<|role|>``, a line break, the text and a line break; every
    ``<|`` inside a role or text becomes ``<||``, so a text cannot forge a turn and the rendering
    can be undone.

    NULL role: 'unknown'. NULL text: empty. NULL turn: before turn 0. Turns with the same number
    are ordered by role and text, and repeated rows are all kept. A NULL pair id is a pair of its
    own. A side without turns has an empty completion; identical sides share the whole conversation
    as prompt and have two empty completions. Other ``side`` values are not part of a pair and are left out.
    No rows give no pairs; further columns are ignored. A conversation is rendered into one cell,
    so it has to fit a row; the pairs are spread by pair id and nothing gathers more than one pair.
    """
    safe = lambda c, default: F.replace(F.coalesce(c.cast("string"), F.lit(default)), F.lit("<|"), F.lit("<||"))
    rows = turns.select(F.col(pair).alias("pair_id"), F.col(side).alias("side"),
                        F.struct(F.col(turn).alias("turn"), safe(F.col(role), "unknown").alias("role"),
                                 safe(F.col(text), "").alias("text")).alias("t")).where(F.col("side").isin("chosen", "rejected"))
    of = lambda s: F.sort_array(F.collect_list(F.when(F.col("side") == s, F.col("t")))).alias(s)
    both = rows.groupBy("pair_id").agg(of("chosen"), of("rejected"))
    a, b = F.col("chosen"), F.col("rejected")
    shared = F.least(F.size(a), F.size(b))
    same = F.transform(F.sequence(F.lit(0), shared - 1), lambda i: (F.get(a, i)["role"] == F.get(b, i)["role"])
                       & (F.get(a, i)["text"] == F.get(b, i)["text"]))
    first_other = F.array_position(same, False).cast("int")
    cut = both.withColumn("n", F.when(shared == 0, 0).when(first_other == 0, shared).otherwise(first_other - 1))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.size(c))
    parts = cut.select("pair_id", F.col("n").alias("n_prompt_turns"), F.slice(a, 1, F.col("n")).alias("p"),
                       rest(a).alias("c"), rest(b).alias("r"))
    return parts.select("pair_id", "n_prompt_turns", _joined(F.col("p")).alias("prompt"), _joined(F.col("c")).alias("chosen"),
                        _joined(F.col("r")).alias("rejected"), _mask(F.col("c")).alias("chosen_mask"),
                        _mask(F.col("r")).alias("rejected_mask"))


def mismatched_pairs(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                     text: str = "text") -> DataFrame:
    """A pair per conversation: as it is (chosen), and with its last turn swapped for that of its neighbour (rejected).

    The neighbour of conversation n is n xor 1; without one, the rejected side just lacks the last turn.
    The last turn is the one with the greatest (turn, role, text), with all its repeats. Rows with a NULL conv id
    belong to no conversation and are left out.
    """
    t = conversations.select(F.col(conv).alias("pair_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                             F.col(text).alias("text")).where(F.col("pair_id").isNotNull())
    last = t.groupBy("pair_id").agg(F.max(F.struct("turn", "role", "text")).alias("last"))
    before = t.join(last, "pair_id").where(~F.struct("turn", "role", "text").eqNullSafe(F.col("last")))
    swapped = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), "last").join(
        last.select("pair_id", F.col("last.turn").alias("turn")), "pair_id")
    chosen = t.select("pair_id", F.lit("chosen").alias("side"), "turn", "role", "text")
    rejected = before.select("pair_id", F.lit("rejected").alias("side"), "turn", "role", "text").unionByName(
        swapped.select("pair_id", F.lit("rejected").alias("side"), "turn", F.col("last.role").alias("role"),
                       F.col("last.text").alias("text")))
    return chosen.unionByName(rejected)
