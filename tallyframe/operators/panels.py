"""Completeness of panels by category, dominant lineages, ranked subjects and label aliases."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def category_completeness(hits: DataFrame, key: str, model: str, item: str, categories: Mapping[str, str], domains: DataFrame, expected: str, counted: str) -> DataFrame:
    """(key, completeness, counted_items, total, duplication): categories by prefix of the model, with evidence.

    A category counts if one of its items has no known domain or the expected one; domains is (item, domain), and of an item's several
    domains one may be the expected one. total and counted_items (those of the category `counted`) are distinct items a category, whatever their domain.
    """
    named = F.array(*(F.when(F.col(model).startswith(prefix), F.lit(c)) for c, prefix in categories.items()))
    inside = hits.select(key, item, F.explode(F.array_compact(named)).alias("_c")).distinct().join(
        domains.where(F.col("domain").isNotNull()).groupBy(item).agg(F.bool_or(F.col("domain") == expected).alias("_known")), item, "left"
    )
    known = F.coalesce("_known", F.lit(True))
    each = inside.groupBy(key, "_c").agg(F.count("*").alias("_n"), F.bool_or(known).alias("_ok"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    per = hits.select(key).distinct().join(each, key, "left").groupBy(key)
    return per.agg(
        F.concat(F.count_if("_ok").cast("string"), F.lit(f"/{len(categories)}")).alias("completeness"),
        F.coalesce(F.sum(F.when(F.col("_c") == counted, F.col("_n"))), F.lit(0)).alias("counted_items"),
        total.alias("total"), (total / float(len(categories))).alias("duplication"),
    )


def dominant_lineage(votes: DataFrame, keys: Sequence[str], lineage: Sequence[str]) -> DataFrame:
    """(keys, lineage, n): the lineage with most votes, the first in order of its ranks among equals. Counted before it is compared."""
    n = votes.groupBy(*keys, *lineage).agg(F.count("*").alias("n"))
    best = n.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("_less"), *lineage)).alias("_b"))
    return best.select(*keys, *(F.col(f"_b.{c}").alias(c) for c in lineage), (-F.col("_b._less")).alias("n"))


def ranked_subjects(hits: DataFrame, keys: Sequence[str], subject: str, score: str, n: int) -> DataFrame:
    """(keys, subject, score, place): the n best subjects of each group by their best score, then by name."""
    best = hits.groupBy(*keys, subject).agg(F.max(score).alias(score))
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(score), F.asc(subject)))
    return best.withColumn("place", place).where(F.col("place") <= n)


def taxonomy_aliases(labels: DataFrame, label: str, taxonomy: str, active: str) -> DataFrame:
    """(label, alias): labels without evidence, whose taxonomy exactly one label with evidence has."""
    one = labels.groupBy(taxonomy).agg(F.count_if(active).alias("_n"), F.max(F.when(F.col(active), F.col(label))).alias("alias")).where("_n = 1")
    return labels.where(~F.col(active)).join(one, taxonomy).select(label, "alias")


def consolidated(hits: DataFrame, keys: Sequence[str], item: str, model: str, score: str, groups: DataFrame) -> DataFrame:
    """(keys, item, model): hits whose model is the item's best in the model's group, and all hits of models without a group.

    groups is (model, group), one row a model. Several rows of an item and a model count by their best score; equal scores in a group all stay.
    """
    one = hits.groupBy(*keys, item, model).agg(F.max(score).alias("_s"))
    told = one.join(groups.select(F.col("model").alias("_m"), "group"), F.col(model) == F.col("_m"), "left").drop("_m")
    top = told.where("group is not null").groupBy(*keys, item, "group").agg(F.max("_s").alias("_top"))
    met = told.join(top, [*keys, item, "group"], "left")
    return met.where("group is null or _s >= _top").select(*keys, item, model)


def panel_table(queries: DataFrame, hits: DataFrame, keys: Sequence[str], item: str, model: str, panels: Mapping[str, Sequence[str]]) -> DataFrame:
    """(keys, <panel>_completeness, <panel>_dup, <panel>_unique, <panel>_total, ...) for every row of queries, zeros where nothing was hit.

    completeness: models with hits out of the panel's, as text; dup: hits (distinct pairs of item and model) for each such model; unique: models
    with hits; total: distinct items. One aggregation for all panels.
    """
    pair = F.struct(item, model)
    inside = {name: F.col(model).isin(*models) for name, models in panels.items()}
    sums = hits.groupBy(*keys).agg(*(
        f for name, here in inside.items() for f in (
            F.count_distinct(F.when(here, F.col(model))).alias(f"{name}_unique"), F.count_distinct(F.when(here, pair)).alias(f"_{name}_pairs"), F.count_distinct(F.when(here, F.col(item))).alias(f"{name}_total"),
        )
    ))
    told = queries.select(*keys).distinct().join(sums, list(keys), "left").na.fill(0)
    out = []
    for name, models in panels.items():
        unique = F.col(f"{name}_unique")
        out += [
            F.concat(unique.cast("string"), F.lit(f"/{len(set(models))}")).alias(f"{name}_completeness"), F.coalesce(F.try_divide(F.col(f"_{name}_pairs"), unique), F.lit(0.0)).alias(f"{name}_dup"),
            unique.alias(f"{name}_unique"), F.col(f"{name}_total"),
        ]
    return told.select(*keys, *out)


def category_models(model: Column, categories: Mapping[str, Sequence[str]], prefix: bool = False) -> Column:
    """The categories that a model belongs to: by exact names, or by what names start with."""
    belongs = lambda names: functools.reduce(Column.__or__, (F.startswith(model, F.lit(n)) for n in names)) if prefix else model.isin(*names)
    return F.array_compact(F.array(*(F.when(belongs(names), F.lit(c)) for c, names in categories.items())))


def category_table(queries: DataFrame, hits: DataFrame, keys: Sequence[str], item: str, model: str, categories: Mapping[str, Sequence[str]], expected: str, domains: DataFrame | None = None, counted: str | None = None, prefix: bool = False) -> DataFrame:
    """(keys, completeness, duplication, total, counted) for every row of queries.

    A category is present if one of its items is not placed with another domain: domains(keys, item, domain), one row an item; without
    domains any hit will do. total: distinct items a category; duplication: these for each category; counted: those of one category.
    """
    inside = hits.select(*keys, item, F.explode(category_models(F.col(model), categories, prefix)).alias("_c")).distinct()
    if domains is None:
        inside = inside.withColumn("_known", F.lit(True))
    else:
        inside = inside.join(domains.select(*keys, item, (F.col("domain") == expected).alias("_known")), [*keys, item], "left").withColumn("_known", F.coalesce("_known", F.lit(True)))
    each = inside.groupBy(*keys, "_c").agg(F.count("*").alias("_n"), F.bool_or("_known").alias("_ok"))
    return _categories(queries, each, keys, len(categories), counted)


def category_counts(queries: DataFrame, counts: DataFrame, keys: Sequence[str], model: str, n: str, categories: Mapping[str, Sequence[str]], counted: str | None = None, prefix: bool = False) -> DataFrame:
    """category_table() where only counts(keys, model, n) are left: counts above 0 make a category present and are summed up."""
    inside = counts.where(F.col(n) > 0).select(*keys, F.col(n).alias("_k"), F.explode(category_models(F.col(model), categories, prefix)).alias("_c"))
    each = inside.groupBy(*keys, "_c").agg(F.sum("_k").alias("_n"), F.lit(True).alias("_ok"))
    return _categories(queries, each, keys, len(categories), counted)


def _categories(queries: DataFrame, each: DataFrame, keys: Sequence[str], size: int, counted: str | None) -> DataFrame:
    sums = each.groupBy(*keys).agg(F.count_if("_ok").alias("_p"), F.sum("_n").alias("_t"), F.sum(F.when(F.col("_c") == F.lit(counted), F.col("_n"))).alias("_o"))
    told = queries.select(*keys).distinct().join(sums, list(keys), "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return told.select(
        *keys, F.concat(zero("_p").cast("string"), F.lit(f"/{size}")).alias("completeness"), (zero("_t") / float(size)).alias("duplication"), zero("_t").alias("total"), zero("_o").alias("counted")
    )


def placed_items(queries: DataFrame, hits: DataFrame, keys: Sequence[str], item: str, model: str, prefix: str, expected: str, nearest: DataFrame | None) -> DataFrame:
    """(keys, n): distinct items that hit a model of the prefix and whose nearest reference in that model's tree is of the expected domain.

    nearest(keys, model, item, domain): the domain of the nearest reference, null if it has no label. Without trees every such hit counts.
    """
    mine = hits.where(F.startswith(F.col(model), F.lit(prefix))).select(*keys, item, model).distinct()
    if nearest is not None:
        mine = mine.join(nearest.where(F.col("domain") == expected).select(*keys, item, model).distinct(), [*keys, item, model], "left_semi")
    counts = mine.groupBy(*keys).agg(F.count_distinct(item).alias("n"))
    return queries.select(*keys).distinct().join(counts, list(keys), "left").na.fill(0)


def dominant_group(queries: DataFrame, hits: DataFrame, counts: DataFrame, keys: Sequence[str], item: str, model: str, n: str, groups: DataFrame) -> DataFrame:
    """(keys, group): each item votes once, for the group that most of its models belong to; the group with most votes wins; ties give ''.

    groups is (model, group). A query none of whose items has a vote falls back to the sums of counts(keys, model, n).
    """
    of = groups.select(F.col("model").alias(model), "group")

    def winner(votes: DataFrame, by: Sequence[str]) -> DataFrame:
        """(by, group): the one group with most votes, if it is one."""
        top = votes.groupBy(*by).agg(F.max("_v").alias("_top"))
        return votes.join(top, list(by)).where("_v = _top").groupBy(*by).agg(F.count("*").alias("_k"), F.min("group").alias("group")).where("_k = 1").drop("_k")

    votes = hits.select(*keys, item, model).distinct().join(of, model).groupBy(*keys, item, "group").agg(F.count("*").alias("_v"))
    by_item = winner(votes, [*keys, item]).groupBy(*keys, "group").agg(F.count("*").alias("_v"))
    by_count = counts.where(F.col(n) > 0).join(of, model).groupBy(*keys, "group").agg(F.sum(n).alias("_v"))
    voted = by_item.unionByName(by_count.join(by_item.select(*keys).distinct(), list(keys), "left_anti"))
    told = queries.select(*keys).distinct().join(winner(voted, keys), list(keys), "left")
    return told.select(*keys, F.coalesce("group", F.lit("")).alias("group"))


def best_hit_stats(hits: DataFrame, keys: Sequence[str], item: str, model: str, score: str, hit_score: str, length: str, start: str, stop: str, place: str, least: float = 0.66) -> DataFrame:
    """(keys, hits, mean_score, profiles, mean_best, mean_coverage, complete, mean_complete, items_per_profile).

    hits: items; mean_score: of each item's highest score; best: each item's row with the highest hit_score, the first by place among equals;
    coverage: the share of the profile that this row covers; complete: best rows that cover more than least. Keys without hits give no row.
    """
    coverage = (F.col(stop) - F.col(start) + 1) / F.col(length)
    first = F.min(F.struct((-F.col(hit_score)).alias("o"), F.col(place).alias("p"), coverage.alias("c")))
    each = hits.groupBy(*keys, item).agg(F.max(score).alias("_s"), first.alias("_b"), F.count_distinct(model).alias("_m"))
    best, whole = -F.col("_b.o"), F.col("_b.c") > least
    sums = each.groupBy(*keys).agg(
        F.count("*").alias("hits"), F.avg("_s").alias("_ms"), F.avg(best).alias("_mb"), F.avg("_b.c").alias("_mc"), F.count_if(whole).alias("complete"), F.avg(F.when(whole, best)).alias("_mw"), F.sum("_m").alias("_pairs")
    )
    profiles = hits.groupBy(*keys).agg(F.count_distinct(model).alias("profiles"))
    told = sums.join(profiles, list(keys))
    two = lambda c, d=2: F.round(F.round(F.coalesce(c, F.lit(0.0)), 9), d)
    return told.select(
        *keys, "hits", two(F.col("_ms")).alias("mean_score"), "profiles", two(F.col("_mb")).alias("mean_best"), two(F.col("_mc"), 3).alias("mean_coverage"), "complete", two(F.col("_mw")).alias("mean_complete"),
        two(F.col("_pairs") / F.col("profiles")).alias("items_per_profile"),
    )
