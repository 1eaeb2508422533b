"""Temperature mixing of sources, in DataFrame functions only.

The sources' token shares p are raised to an exponent a and normalised: w ~ p^a. The exponent is found by bisection
so that the mixture meets a target entropy or keeps the highest repetition of any source within a limit. The weights are then
realised within a token budget: each source gets w * budget tokens, as whole passes over its rows and one partial pass.
A pass deals the source's rows into hashed blocks of bounded size; the blocks' order and the rows' order within them are
seeded permutations, and the partial pass takes blocks, then rows of the block at the cut, until its quota is met.

Defined cases: null or blank text has 0 tokens and its rows go with whole passes, or with the partial one if its place in
the permutation comes before the cut; a null source is a source of its own; repeated rows are rows of their own; an empty table gives
an empty mixture; extra columns are kept, whatever their names; texts of any length count whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyframe.llm.common import materialize, packed, unpacked

#: Rows of a block, about.
BLOCK_ROWS = 2_000
#: Parts into which a round cuts the exponent's interval, and rounds: 64 ** 5 is finer than float32.
PARTS, ROUNDS = 64, 5


@dataclass(frozen=True)
class Mix:
    """What to meet. repetition: most passes over any source when the budget is what gives `least_passes` of the least repeated
    one; entropy: in nats. Exactly one of the two is set. budget: tokens; None: the tokens that give every source at least `least_passes`."""

    repetition: float | None = None
    entropy: float | None = None
    budget: float | None = None
    least_passes: float = 1.0
    seed: int = 17


def tokens_of(text: Column) -> Column:
    """Blank-separated words."""
    trimmed = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[ \t\n\x0B\f\r]+"))).cast("long")


def exponent(totals: DataFrame, mix: Mix) -> float:
    """The exponent in [0, 1] that meets the target, by bisection over totals(tokens); 1 keeps the sources' own shares.

    Both measures fall as the exponent grows: entropy from log(sources), repetition spread from largest / smallest. Every round
    measures a row of exponents in one aggregation and keeps the part in which the target lies. No source reaches the driver.
    """
    total = totals.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    shares = totals.where("tokens > 0").select((F.col("tokens") / F.lit(float(total))).alias("p"))
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (hi - lo) / PARTS
        grid = shares.select("p", F.explode(F.array(*(F.lit(lo + i * step) for i in range(PARTS + 1)))).alias("a"))
        q = F.pow("p", "a")
        measured = grid.groupBy("a").agg(
            F.sum(q).alias("z"), F.sum(q * F.log(q)).alias("qlogq"),
            F.max(F.pow("p", F.col("a") - 1)).alias("most"), F.min(F.pow("p", F.col("a") - 1)).alias("least"),
        ).orderBy("a").collect()
        if mix.entropy is not None:
            over = [r["a"] for r in measured if r["z"] > 0 and _entropy(r) >= mix.entropy]
            lo = max(over, default=lo)  # the largest exponent that still has the entropy
            if not over:
                return 0.0
        else:
            over = [r["a"] for r in measured if r["most"] / r["least"] * mix.least_passes > mix.repetition]
            if not over:
                return lo
            lo = max(over)
        if lo >= 1.0:
            return 1.0
        hi = lo + step
    return lo if mix.entropy is not None else hi


def _entropy(r) -> float:
    return math.log(r["z"]) - r["qlogq"] / r["z"]


def plan(totals: DataFrame, mix: Mix) -> DataFrame:
    """For each row of totals(source, tokens, n): weight, quota in tokens, whole passes and the partial pass's quota."""
    if (mix.repetition is None) == (mix.entropy is None):
        raise ValueError("set repetition or entropy")
    a = exponent(totals, mix)
    q = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(a))).otherwise(0.0)
    z, spread = totals.agg(F.sum(q), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / q))).first()
    if not z:
        return totals.select("source", "tokens", "n", F.lit(0.0).alias("weight"), F.lit(0.0).alias("quota"), F.lit(1).cast("long").alias("passes"), F.lit(0).cast("long").alias("partial"))
    budget = mix.budget if mix.budget is not None else mix.least_passes * z * spread
    if mix.budget is not None and mix.repetition is not None and budget > mix.repetition * z * totals.agg(F.min(F.when(F.col("tokens") > 0, F.col("tokens") / q))).first()[0] * (1 + 1e-9):
        raise ValueError("the budget repeats a source more often than the limit allows")
    share = q / F.lit(z)
    quota = F.round(share * F.lit(budget), 6)
    passes = F.when(F.col("tokens") > 0, F.floor(quota / F.col("tokens") + F.lit(1e-9))).otherwise(F.lit(1)).cast("long")
    partial = F.greatest(F.round(quota - passes * F.col("tokens")), F.lit(0)).cast("long")
    return totals.select("source", "tokens", "n", share.alias("weight"), quota.alias("quota"), passes.alias("passes"), partial.alias("partial"))


def temperature_mix(docs: DataFrame, mix: Mix, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' columns and _tokens, _epoch, _block, _slot, which replace columns of these names: each row as often as the mixture takes it.

    Sorting by (_epoch, _block, _slot) streams the mixture: blocks of all sources are permuted together within an epoch.
    """
    key = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    tagged = docs.select(F.col(source_col).cast("string").alias("source"), key.alias("key"), tokens_of(F.col(text_col)).alias("tokens"))
    rows = materialize(tagged, "mix-rows")
    totals = materialize(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")), "mix-totals")
    wanted = materialize(plan(totals, mix), "mix-plan")
    few = wanted.count() <= 100_000
    shared = F.broadcast(wanted) if few else wanted

    blocks = lambda: F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.lit(1)).cast("long")
    at = lambda epoch, salt: F.xxhash64(F.lit(mix.seed), F.lit(salt), epoch, "key")
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))

    # the partial pass: copies of one row are one unit, kept or left together by key, so the cut is the same on every run
    partial = rows.alias("r").join(shared.where("partial > 0").alias("w"), same("r", "w")).select("r.source", "key", "r.tokens", "partial", "passes", "n")
    units = partial.groupBy("source", "key", "partial", "passes", "n").agg(F.sum("tokens").alias("tokens"))
    dealt = materialize(units.withColumn("block", F.pmod(at(F.col("passes"), "block"), blocks())), "mix-units")
    sums = dealt.groupBy("source", "block", "partial").agg(F.sum("tokens").alias("tokens"))
    before = W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    cut = materialize(sums.select("source", "block", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"), F.col("tokens").alias("held"), "partial"), "mix-blocks")
    whole = cut.where("before + held <= partial").select("source", "block")
    last = cut.where("before < partial and before + held > partial").select("source", "block", "before")
    in_block = W.partitionBy("source", "block").orderBy(at(F.col("passes"), "row"), "key").rowsBetween(W.unboundedPreceding, -1)
    took = lambda side: dealt.alias("d").join(side.alias("c"), same("d", "c") & (F.col("d.block") == F.col("c.block")))
    from_whole = took(whole).select("d.source", "d.key")
    ends = took(last).select("d.*", "c.before").withColumn("upto", F.coalesce(F.sum("tokens").over(in_block), F.lit(0)) + F.col("before"))
    chosen = from_whole.unionByName(ends.where("upto < partial").select("source", "key")).select("source", "key", F.lit(1).alias("extra"))

    kept = unpacked(docs, ("_tokens", "_epoch", "_block", "_slot"))
    plus = packed(docs, _tokens=tokens_of(F.col(text_col)), _tf_key=key, _tf_source=F.col(source_col).cast("string"))
    told = shared.select(F.col("source").alias("_tf_s"), F.col("passes").alias("_tf_passes"), F.col("n").alias("_tf_n"), (F.col("partial") > 0).alias("_tf_open"))
    sized = plus.join(told, F.col("_tf_source").eqNullSafe(F.col("_tf_s"))).drop("_tf_s")
    extra = chosen.select(F.col("source").alias("_tf_s"), F.col("key").alias("_tf_k"), F.col("extra").alias("_tf_extra"))
    taken = F.col("_tf_source").eqNullSafe(F.col("_tf_s")) & (F.col("_tf_key") == F.col("_tf_k")) & F.col("_tf_open")
    times = F.col("_tf_passes") + F.coalesce("_tf_extra", F.lit(0))
    marked = sized.join(extra, taken, "left").withColumn("_tf_times", times).where("_tf_times > 0")
    repeated = marked.withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tf_times") - 1)))
    seed, n_blocks = F.lit(mix.seed), F.greatest(F.ceil(F.col("_tf_n") / BLOCK_ROWS), F.lit(1)).cast("long")
    block = F.pmod(F.xxhash64(seed, F.lit("block"), "_epoch", "_tf_key"), n_blocks)
    return repeated.select(
        *kept, "_tokens", "_epoch", F.xxhash64(seed, F.lit("order"), "_epoch", F.coalesce("_tf_source", F.lit("")), block).alias("_block"),
        F.xxhash64(seed, F.lit("row"), "_epoch", "_tf_key").alias("_slot"),
    )
