"""Sets of sequences: members of collapsed models, and unions in which the first one counts."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collapsed(hits: DataFrame, keys: Sequence[str], model: str, item: str, groups: DataFrame) -> DataFrame:
    """(keys, model, item): distinct hits with models replaced by their group, from groups(model, group); models without one stay."""
    told = hits.select(*keys, F.col(model).alias("_m"), item).join(groups.select(F.col("model").alias("_m"), "group"), "_m", "left")
    return told.select(*keys, F.coalesce("group", "_m").alias(model), item).distinct()


def first_of_union(sources: Sequence[DataFrame], key: str, place: str) -> DataFrame:
    """The rows of all sources with the number of their source, one for each key: of the first source that has it, there the one first by place."""
    every = functools.reduce(DataFrame.unionByName, (s.withColumn("source", F.lit(i)) for i, s in enumerate(sources)))
    rest = [c for c in every.columns if c not in (key, "source", place)]
    one = every.groupBy(key).agg(F.min(F.struct("source", place, *rest)).alias("_r"))
    return one.select(key, *(F.col(f"_r.{c}").alias(c) for c in every.columns if c != key))


def ordered_unique(values, mapping):
    """An array's values through a map, in order, each once; values that the map lacks stay."""
    return F.array_distinct(F.transform(values, lambda v: F.coalesce(F.try_element_at(mapping, v), v)))
