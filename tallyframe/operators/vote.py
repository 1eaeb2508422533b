"""One vote per item, hierarchical consensus, tallies and confidence flags."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyframe.functions.scalars import fold_key, normal_placeholder
from tallyframe.operators.rank import best, winner_of_winners
from tallyframe.operators.staging import staged

LEVELS = ("domain", "phylum", "class", "order", "family", "genus", "species")


def one_vote(placements: DataFrame, query: str, item: str, panel: str, neighbor: str, distance: str, carry: Sequence[str]) -> DataFrame:
    """Each item's nearest labelled placement across all panels; ties by panel, then neighbor."""
    return best(placements.where(F.col(carry[0]) != ""), [query, item], [distance, panel, neighbor], carry=carry)


def lineage_votes(votes: DataFrame, query: str, panel: str, ranks: Sequence[str]) -> DataFrame:
    return votes.groupBy(query, panel, *ranks).agg(F.count("*").alias("n"))


def floors(fast: bool) -> list[int]:
    """Panels that must support each rank: three for the order unless fast, two elsewhere."""
    return [2 if fast or level != "order" else 3 for level in LEVELS]


def label(level: str, value: Column) -> Column:
    """o_Name: the level's letter and what follows the last double underscore."""
    if level == "domain":
        return F.concat(F.lit("d_"), value)
    last = F.element_at(F.split(value, "__"), -1)
    return F.concat(F.lit(f"{level[0]}_"), F.when(last != "", last).otherwise(value))


def hierarchical_consensus(votes: DataFrame, query: str, panel: str, ranks: Sequence[str], fast: bool = False) -> DataFrame:
    """(query, majority, strict, confidence) over lineage_votes().

    Rank by rank the winner across panels extends the prefix, until support is below the floor; lower ranks then stay blank. The strict
    lineage follows as long as a rank's votes under the prefix are unanimous. The votes are written once; after each rank the winners
    so far, one row a query, are written and meet the votes by query, so that a query's votes are only ever aggregated, never sorted
    in one task.
    """
    usual, needed = floors(False), floors(fast)
    votes = staged(votes, "votes")
    state = votes.select(query).distinct()
    for i, rank in enumerate(ranks):
        alive = votes
        if i:
            prefix = state.where(F.col(f"s{i - 1}") >= needed[i - 1]).select(F.col(query).alias("_q"), *(f"v{j}" for j in range(i)))
            same = [F.col(ranks[j]) == F.col(f"v{j}") for j in range(i)]
            alive = votes.join(prefix, functools.reduce(Column.__and__, same, F.col(query) == F.col("_q")), "left_semi")
        counts = alive.where(F.trim(rank) != "").groupBy(query, panel, rank).agg(F.sum("n").alias("n"))
        panels = counts.groupBy(query, panel).agg(F.min(F.struct((-F.col("n")).alias("o"), F.col(rank).alias("v"))).alias("t"), F.min(rank).alias("lo"), F.max(rank).alias("hi"))
        winners = panels.groupBy(query, F.col("t.v").alias("v")).agg(F.count("*").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        top = winners.groupBy(query).agg(F.min(F.struct((-F.col("s")).alias("o"), "v")).alias("t"), F.sum("s").alias(f"t{i}"), (F.min("lo") == F.max("hi")).alias(f"k{i}"))
        won = top.select(query, F.col("t.v").alias(f"v{i}"), (-F.col("t.o")).alias(f"s{i}"), f"t{i}", f"k{i}")
        state = staged(state.join(won, query, "left"), f"consensus-{i}")
        if i + 1 < len(ranks) and state.where(F.col(f"s{i}") >= needed[i]).isEmpty():
            rest = {f"{c}{j}": F.lit(None).cast(t) for j in range(i + 1, len(ranks)) for c, t in (("v", "string"), ("s", "long"), ("t", "long"), ("k", "boolean"))}
            state = state.withColumns(rest)
            break
    ok = [F.coalesce(F.col(f"s{i}") >= needed[i], F.lit(False)) for i in range(len(LEVELS))]
    strict, majority, strictly = F.lit(True), [], []
    for i, level in enumerate(LEVELS):
        blank, name = F.lit(f"{level[0]}_"), label(level, F.col(f"v{i}"))
        strict = strict & ok[i] & F.coalesce(f"k{i}", F.lit(False))
        majority.append(F.when(ok[i], name).otherwise(blank))
        strictly.append(F.when(strict, name).otherwise(blank))
    none = F.coalesce(F.col("t0"), F.lit(0)) == 0
    low = F.lit(False)
    for i in range(len(LEVELS)):  # ranks after the first failed one have no state
        low = low | (~ok[i] & (F.coalesce(F.col(f"t{i}"), F.lit(0)) > 0))
    reduced = F.lit(False)
    for i in range(len(LEVELS)):
        if needed[i] < usual[i]:
            reduced = reduced | (ok[i] & (F.col(f"s{i}") < usual[i]))
    return state.select(
        query, F.concat_ws(";", *majority).alias("majority"), F.concat_ws(";", *strictly).alias("strict"), confidence(none, low, reduced).alias("confidence")
    )


def confidence(no_support: Column, low_support: Column, reduced: Column) -> Column:
    """The flags that hold, strongest caveat first; 'high' if none does."""
    flags = F.concat_ws(",", F.when(no_support, "no_support"), F.when(low_support, "low_support"), F.when(reduced, "reduced_fastmode"))
    return F.when(flags == "", "high").otherwise(flags)


def flat_consensus(votes: DataFrame, query: str, panel: str, ranks: Sequence[str], fast: bool = False) -> DataFrame:
    """(query, level, value, supporting, total, ok): every rank on its own."""
    need = F.array(*(F.lit(n) for n in floors(fast)))
    each = F.array(*(F.struct(F.lit(i + 1).alias("at"), F.lit(level).alias("level"), F.col(r).alias("value")) for i, (level, r) in enumerate(zip(LEVELS, ranks, strict=True))))
    flat = votes.select(query, panel, "n", F.explode(each).alias("r")).select(query, panel, "n", "r.*").where(F.trim("value") != "")
    won = winner_of_winners(flat, [query, "at", "level"], panel, "value")
    return won.select(query, "level", "value", "supporting", "total", (F.col("supporting") >= F.element_at(need, F.col("at"))).alias("ok"))


def rank_counts(votes: DataFrame, query: str, ranks: Sequence[str], domain: str | None = None) -> DataFrame:
    """(query, level, taxon, n): votes at every rank in one pass, keyed domain__taxon below the first."""
    domain = domain or ranks[0]
    pairs = [F.struct(F.lit(level).alias("level"), (F.col(r) if r == domain else F.concat_ws("__", domain, r)).alias("taxon"), (F.trim(r) != "").alias("given")) for level, r in zip(LEVELS, ranks, strict=True)]
    flat = votes.select(query, "n", F.explode(F.array(*pairs)).alias("p")).where("p.given")
    return flat.groupBy(query, "p.level", "p.taxon").agg(F.sum("n").alias("n"))


def tally(counts: DataFrame, keys: Sequence[str], value: str, n: str = "n", fold_at: int = 5, level: str | None = None) -> DataFrame:
    """(keys, tally): 'taxon:n(pp.pp%)' by n descending, then taxon; shares of fold_at percent or less fold to their domain's other.

    Rows whose `level` is domain are counted by domain and never folded.
    """
    top = F.col(level) == "domain" if level else F.lit(False)
    named = counts.withColumn(value, F.when(top, F.substring_index(value, "__", 1)).otherwise(normal_placeholder(F.col(value))))
    named = named.groupBy(*keys, *([level] if level and level not in keys else []), value).agg(F.sum(n).alias("n"))
    named = named.withColumn("_total", F.sum("n").over(W.partitionBy(*keys)))
    minor = ~top & (F.col("n") * 100 <= F.col("_total") * fold_at)
    summed = named.withColumn(value, F.when(minor, fold_key(F.col(value))).otherwise(F.col(value))).groupBy(*keys, value).agg(F.sum("n").alias("n"), F.max("_total").alias("_total"))
    share = F.round((F.col("n") * 100).cast("decimal(20,0)") / F.col("_total").cast("decimal(20,0)"), 2).cast("decimal(20,2)")
    item = F.concat(F.col(value), F.lit(":"), F.col("n").cast("string"), F.lit("("), share.cast("string"), F.lit("%)"))
    listed = summed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(value).alias("v"), item.alias("s")))).alias("_l"))
    return listed.select(*keys, F.array_join(F.transform("_l", lambda x: x["s"]), ",").alias("tally"))


def majority_and_strict(counts: DataFrame, keys: Sequence[str], value: str, n: str = "n") -> DataFrame:
    """(keys, value, n, total, majority, strict): the top value, whether it has over half, whether it has all."""
    top = counts.groupBy(*keys).agg(F.min(F.struct((-F.col(n)).alias("o"), F.col(value).alias("v"))).alias("_t"), F.sum(n).alias("total"))
    top = top.select(*keys, F.col("_t.v").alias(value), (-F.col("_t.o")).alias("n"), "total")
    return top.withColumns({"majority": F.col("n") * 2 > F.col("total"), "strict": F.col("n") == F.col("total")})


def top_two_shares(counts: DataFrame, keys: Sequence[str], value: str, n: str = "n") -> DataFrame:
    """(keys, top_n, second_n, total)."""
    w = W.partitionBy(*keys).orderBy(F.col(n).desc(), F.col(value).asc())
    ranked = counts.withColumn("_rn", F.row_number().over(w))
    pick = lambda k: F.coalesce(F.max(F.when(F.col("_rn") == k, F.col(n))), F.lit(0))
    return ranked.groupBy(*keys).agg(pick(1).alias("top_n"), pick(2).alias("second_n"), F.sum(n).alias("total"))


def capsid_tally(placed: DataFrame, query: str, marker: str, item: str, neighbor: str, distance: str, family: str, phylum: str, families: Sequence[str], phyla: Sequence[str]) -> DataFrame:
    """(query, tally): 'type:n' by n descending, then type, of items by the type of their nearest neighbour.

    The type is the neighbour's family if it is one of families, else its phylum if that is one of phyla. Of an item's several markers
    the nearest one with a type counts; markers at the same distance that disagree drop the item. Queries without types give no row.
    """
    nearest = placed.groupBy(query, marker, item).agg(F.min(F.struct(distance, neighbor, family, phylum)).alias("_n"))
    fam, phy = F.trim(F.col(f"_n.{family}")), F.trim(F.col(f"_n.{phylum}"))
    typed = nearest.select(query, item, F.col(f"_n.{distance}").alias("_d"), F.when(fam.isin(*families), fam).when(phy.isin(*phyla), phy).alias("_t")).where("_t is not null")
    each = typed.groupBy(query, item, "_d").agg(F.min("_t").alias("_t"), F.count_distinct("_t").alias("_k"))
    one = each.groupBy(query, item).agg(F.min(F.struct("_d", "_t", "_k")).alias("_m")).where("_m._k = 1")
    counts = one.groupBy(query, F.col("_m._t").alias("_t")).agg(F.count("*").alias("_c"))
    listed = counts.groupBy(query).agg(F.array_sort(F.collect_list(F.struct((-F.col("_c")).alias("o"), "_t"))).alias("_l"))
    return listed.select(query, F.array_join(F.transform("_l", lambda x: F.concat_ws(":", x["_t"], (-x["o"]).cast("string"))), ",").alias("tally"))


def half_consensus(votes: DataFrame, keys: Sequence[str], value: str, n: str | None = None) -> DataFrame:
    """(keys, value): the most frequent value that is not blank, if at least half of these votes have it, ties by value; else no row."""
    count = F.sum(n) if n else F.count("*")
    counted = votes.where(F.trim(value) != "").groupBy(*keys, F.trim(value).alias(value)).agg(count.alias("_n"))
    top = counted.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("o"), F.col(value).alias("v"))).alias("_t"), F.sum("_n").alias("_all"))
    return top.where(-F.col("_t.o") * 2 >= F.col("_all")).select(*keys, F.col("_t.v").alias(value))
