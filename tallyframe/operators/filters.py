"""Gates on hits, references, lineages and genomes."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def starts_with_any(value: Column, prefixes: Sequence[str]) -> Column:
    """Whether a value starts with one of the prefixes; null does not."""
    return F.coalesce(functools.reduce(Column.__or__, (F.startswith(value, F.lit(p)) for p in prefixes), F.lit(False)), F.lit(False))


def kept_models(hits: DataFrame, keys: Sequence[str], model: str, item: str, least: int = 1, drop_prefixes: Sequence[str] = ()) -> DataFrame:
    """(keys, model, n): models with at least so many distinct items, without those of the prefixes, as fast runs have it."""
    rows = hits.where(~starts_with_any(F.col(model), drop_prefixes)) if drop_prefixes else hits
    return rows.groupBy(*keys, model).agg(F.count_distinct(item).alias("n")).where(F.col("n") >= least)


def below_evalue(hits: DataFrame, evalue: str, most: float) -> DataFrame:
    """Hits whose e-value is a number and at most the cut."""
    return hits.where(F.coalesce(F.col(evalue) <= most, F.lit(False)))


def in_lineage(df: DataFrame, ranks: Sequence[str], selected: Sequence[str]) -> DataFrame:
    """Rows whose first ranks are the selected ones; no selected rank lets all rows through."""
    same = (F.col(r).eqNullSafe(F.lit(s)) for r, s in zip(ranks, selected, strict=False))
    return df.where(functools.reduce(Column.__and__, same, F.lit(True)))


def counted_in_text(text: Column, name: str) -> Column:
    """The number behind `name:` in a tally such as 'A:3,B:1'; 0 without one. The first is taken, and name may be the end of a longer one."""
    return F.coalesce(F.regexp_extract(text, rf"\Q{name}\E:(\d+)", 1).try_cast("int"), F.lit(0))


def base_rows(df: DataFrame, group: str, groups: Sequence[str], size: str, name: str, least: int, most: int, n: int = 2, single: str | None = None) -> DataFrame:
    """Of each of the groups the n smallest rows of a size within bounds, ties by name; with single, only rows where that column is 1.

    Raises if a group has fewer.
    """
    from tallyframe.operators.rank import top_n

    fit = df.where(F.col(group).isin(*groups) & F.col(size).between(least, most))
    fit = fit.where(F.col(single) == 1) if single else fit
    out = top_n(fit, [group], [F.col(size).asc(), F.col(name).asc()], n)
    found = {r[group]: r["count"] for r in out.groupBy(group).count().collect()}  # a row for each listed group
    if any(found.get(g, 0) < n for g in groups):
        raise ValueError(f"too few rows of a group: {found}")
    return out
