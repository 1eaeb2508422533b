"""Preference formatting of conversations.

For each pair of a chosen and a rejected conversation: the longest common prefix of their turns is rendered once as prompt, the rest of each as
its completion. Completions come with a mask: spans of the prompt-and-completion text, in code points, on which a loss is taken,
which are the assistant's turns after the prompt.

A pair is two conversations; pairs() names them by an integer id: 2k is the chosen, 2k + 1 the rejected.

Turns are one array for each conversation, ordered by turn; built-in functions compare and render them.

Defined cases: null role is "user", null text is empty; turns with equal number are ordered by role, then text; repeated rows are
turns of their own; turns without a number come first; conversations without id are left out; a pair with one side has the whole of
it as completion and null for the other; a pair of equal conversations has two empty completions; an empty table gives no rows;
texts of any length are rendered whole; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template.
HEAD, MID, TAIL = "<|", "|>\n", "<|end|>\n"


def _render(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), turn["role"], F.lit(MID), turn["text"], F.lit(TAIL))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def conversations_of(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """(conv, turns array<struct<turn, role, text>>)."""
    one = F.struct(
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("user")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    kept = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), one.alias("t"))
    return kept.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def format_pairs(sides: DataFrame) -> DataFrame:
    """sides(pair, chosen turns, rejected turns) as (pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask)."""
    none = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    both = F.col("chosen").isNotNull() & F.col("rejected").isNotNull()
    a, b = F.coalesce("chosen", none), F.coalesce("rejected", none)
    shorter = F.when(both, F.least(F.size(a), F.size(b))).otherwise(0)
    same = lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"])
    equal = F.zip_with(F.slice(a, F.lit(1), shorter), F.slice(b, F.lit(1), shorter), same)
    broken = F.array_position(equal, False)
    common = F.when(broken > 0, broken - 1).otherwise(shorter).cast("int")
    cut = sides.select("pair", a.alias("a"), b.alias("b"), "chosen", "rejected", common.alias("n"))
    rest = lambda side: F.slice(F.col(side), F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
    prompt = _text(F.slice(F.col("a"), F.lit(1), F.col("n")))
    made = cut.select("pair", "n", prompt.alias("prompt"), rest("a").alias("a"), rest("b").alias("b"), F.col("chosen").isNotNull().alias("has_a"), F.col("rejected").isNotNull().alias("has_b"))

    def mask(side: str) -> Column:
        start = F.struct(F.length("prompt").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

        def step(acc, t):
            body = acc["at"] + F.length(F.concat(F.lit(HEAD), t["role"], F.lit(MID)))
            end = body + F.length(t["text"]) + len(TAIL)
            span = F.array(F.struct(body.alias("start"), end.alias("end")))
            return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(F.col(side), start, step, lambda acc: acc["out"])

    return made.select(
        F.col("pair").alias("pair_id"), F.col("n").cast("long").alias("n_common"), "prompt",
        F.when(F.col("has_a"), _text(F.col("a"))).alias("chosen"), F.when(F.col("has_b"), _text(F.col("b"))).alias("rejected"),
        F.when(F.col("has_a"), mask("a")).alias("chosen_mask"), F.when(F.col("has_b"), mask("b")).alias("rejected_mask"),
    )


def pairs(turns: DataFrame, **columns) -> DataFrame:
    """The sides of every pair: one aggregation by pair, each side sorted from its own turns."""
    convs = conversations_of(turns, **columns)
    side = lambda odd: F.max(F.when(F.pmod("conv", F.lit(2)) == odd, F.col("turns")))
    return convs.groupBy(F.floor(F.col("conv") / 2).cast("long").alias("pair")).agg(side(0).alias("chosen"), side(1).alias("rejected"))


def preference_pairs(turns: DataFrame, **columns) -> DataFrame:
    return format_pairs(pairs(turns, **columns))
