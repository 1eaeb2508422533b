"""Ranking, deduplication and ties. Every order is total: callers list tie-breaking columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank_col: str | None = None) -> DataFrame:
    """The first n rows of each key; Spark limits groups before the shuffle."""
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n)
    return ranked.withColumnRenamed("_rn", rank_col) if rank_col else ranked.drop("_rn")


def best(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, carry: Sequence[str] = ()) -> DataFrame:
    """The least row by `order` for each key, as an aggregation with map-side combine. Prefix a column with '-' for descending numbers."""
    parts = [(-F.col(c[1:]) if c[0] == "-" else F.col(c)).alias(f"o{i}") for i, c in enumerate(order)]
    fields = parts + [F.col(c).alias(f"c_{c}") for c in carry]
    least = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_b"))
    back = [(-F.col(f"_b.o{i}") if c[0] == "-" else F.col(f"_b.o{i}")).alias(c.lstrip("-")) for i, c in enumerate(order)]
    return least.select(*keys, *back, *(F.col(f"_b.c_{c}").alias(c) for c in carry))


def stable_top(df: DataFrame, keys: Sequence[str], value: str, n: Column | str = "n") -> DataFrame:
    """(keys, value, n): each key's value with the highest n, ties by value ascending."""
    n = F.col(n) if isinstance(n, str) else n
    top = df.groupBy(*keys).agg(F.min(F.struct((-n).alias("neg"), F.col(value).alias("v"))).alias("_t"))
    return top.select(*keys, F.col("_t.v").alias(value), (-F.col("_t.neg")).alias("n"))


def winner_of_winners(votes: DataFrame, keys: Sequence[str], panel: str, value: str, n: str = "n") -> DataFrame:
    """(keys, value, supporting, total): the winner within each panel, then the winner across panels."""
    per_panel = stable_top(votes.groupBy(*keys, panel, value).agg(F.sum(n).alias("n")), [*keys, panel], value)
    counted = per_panel.groupBy(*keys, value).agg(F.count("*").alias("n"))
    top = counted.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col(value).alias("v"))).alias("_t"), F.sum("n").alias("total"))
    return top.select(*keys, F.col("_t.v").alias(value), (-F.col("_t.neg")).alias("supporting"), "total")


def first_n_then_unique(df: DataFrame, query: str, subject: str, seq: str, score: str, n: int) -> DataFrame:
    """(subject, score, query, seq): the first n rows of each query in file order, then each subject's best row over all queries.

    Ties go to the first query, then to the earliest row; ordering by score, query and seq lists the subjects best first.
    """
    capped = top_n(df, [query], [F.col(seq).asc(), F.col(subject).asc()], n)
    return best(capped, [subject], [f"-{score}", query, seq])


def best_model_split(df: DataFrame, item: str, model: str, score: str, seq: str, many: Column) -> DataFrame:
    """Rows under `many` keep the best of each (item, model), the others the single best model of each item."""
    order = [F.col(score).desc(), F.col(seq).asc(), F.col(model).asc()]
    kept = top_n(df.where(many), [item, model], order)
    return kept.unionByName(top_n(df.where(~many), [item], order))


def closest_or_drop(df: DataFrame, keys: Sequence[str], distance: str, label: str) -> DataFrame:
    """(keys, distance, label) at the least distance; keys whose nearest rows disagree on the label are dropped."""
    both = df.groupBy(*keys).agg(F.min(F.struct(F.col(distance).alias("d"), F.col(label).alias("l"))).alias("_lo"), F.max(F.struct((-F.col(distance)).alias("d"), F.col(label).alias("l"))).alias("_hi"))
    return both.where("_lo.l = _hi.l").select(*keys, F.col("_lo.d").alias(distance), F.col("_lo.l").alias(label))


def dominant_or_blank(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n): the most frequent value, '' where two lead."""
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    ends = counted.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))).alias("_lo"), F.max(F.struct("n", F.col(value).alias("v"))).alias("_hi"))
    return ends.select(*keys, F.when(F.col("_lo.v") == F.col("_hi.v"), F.col("_lo.v")).otherwise("").alias(value), F.col("_hi.n").alias("n"))


def nearest_then_top(df: DataFrame, query: str, group: str, item: str, distance: str, k: int) -> DataFrame:
    """The nearest item of each (query, group), then the k nearest groups of each query."""
    one = best(df, [query, group], [distance, item])
    return top_n(one, [query], [F.col(distance).asc(), F.col(group).asc()], k, "rank")


def running_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], width: str) -> DataFrame:
    """start and stop (1-based, inclusive) of blocks laid side by side in order."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    stop = F.sum(width).over(w)
    return df.withColumns({"start": stop - F.col(width) + 1, "stop": stop})


def take_until(df: DataFrame, keys: Sequence[str], order: Sequence[Column], size: str, target: Column | float) -> DataFrame:
    """Rows in order until their sum reaches the target; the crossing row is included."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("_before", F.coalesce(F.sum(size).over(w), F.lit(0))).where(F.col("_before") < target).drop("_before")


def ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "ordinal") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    return df.withColumn(name, F.max(value).over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def override_baseline(df: DataFrame, key: str, code: str, metrics: Sequence[str], baseline, wins: Column, preference: Sequence[int], digits: Mapping[str, int] | None = None) -> DataFrame:
    """The top-ranked candidate of each key replaces the baseline candidate only if `wins` holds.

    `wins` may use the metric columns, and each with the suffix _base for the baseline's. Metrics named in digits are rounded before all else.
    """
    df = df.withColumns({m: F.round(m, d) for m, d in (digits or {}).items()})
    place = F.array_position(F.array(*(F.lit(p) for p in preference)), F.col(code))
    order = [F.col(m).desc() for m in metrics] + [place.asc()]
    base = df.where(F.col(code) == baseline).select(key, *(F.col(m).alias(f"{m}_base") for m in metrics))
    lead = top_n(df.where(F.col(code) != baseline), [key], order)
    joined = base.join(lead, key, "left")
    chosen = F.when(F.coalesce(wins, F.lit(False)), F.col(code)).otherwise(F.lit(baseline))
    return joined.select(key, chosen.alias(code))


def override_in_order(df: DataFrame, keys: Sequence[str], code: str, codes: Sequence[str], hits: str, score: str, density: str, margin: float = 1.02) -> DataFrame:
    """(keys, best): codes are tried one after the other against the best so far, beginning with the first one, the base.

    A code wins with more hits, or as many and a higher score, or as many and the same score and a density above margin times the base's.
    A base without density stays. What wins depends on the order, so the few rows of a key are folded as one array.
    """
    place = F.array_position(F.array(*(F.lit(c) for c in codes)), F.col(code))
    rows = df.where(place > 0).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(place.alias("p"), F.col(hits).alias("h"), F.col(score).alias("s"), F.col(density).alias("d")))).alias("_r"))
    base = F.filter("_r", lambda r: r["p"] == 1)[0]["d"]
    told = rows.where(F.exists("_r", lambda r: r["p"] == 1)).withColumn("_base", base)
    first = F.col("_r")[0]

    def step(best, r):
        level = (r["h"] == best["h"]) & (r["s"] == best["s"])
        wins = (r["h"] > best["h"]) | ((r["h"] == best["h"]) & (r["s"] > best["s"])) | (level & (r["d"] > best["b"] * margin))
        return F.when((best["b"] > 0) & wins, F.struct(r["p"].alias("p"), r["h"].alias("h"), r["s"].alias("s"), best["b"].alias("b"))).otherwise(best)

    start = F.struct(first["p"].alias("p"), first["h"].alias("h"), first["s"].alias("s"), F.col("_base").alias("b"))
    won = F.aggregate(F.slice("_r", 2, len(codes)), start, step, lambda best: best["p"])
    return told.select(*keys, F.element_at(F.array(*(F.lit(c) for c in codes)), won.cast("int")).alias("best"))
