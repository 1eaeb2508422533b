"""Rewriting of sequence names through aliases, and the audit of what was rewritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.scalars import without_number

#: What a query's leaf begins with in trees that also hold references.
QUERY = "QUERY__"


def namespaced(name: Column, is_query: Column) -> Column:
    return F.when(is_query, F.concat(F.lit(QUERY), name)).otherwise(name)


def without_namespace(name: Column) -> Column:
    """A leaf's name without one prefix of queries; references stay as they are."""
    return F.when(F.startswith(name, F.lit(QUERY)), F.substring(name, len(QUERY) + 1, 1 << 30)).otherwise(name)


def label_candidates(name: Column) -> Column:
    """Labels that a name may stand for, in the order in which they are tried: itself, without number, before the bar, and that with its contig."""
    base, payload = F.substring_index(name, "|", 1), F.regexp_replace(name, r"^[^|]*\|", "")
    contig = F.when(F.instr(payload, "_") > 0, F.regexp_replace(payload, "_[^_]*$", "")).otherwise(payload)
    bar = F.instr(name, "|") > 0
    more = F.when(bar & (contig != ""), F.concat_ws("_", base, contig))
    return F.array_distinct(F.array_compact(F.array(name, without_number(name), F.when(bar, base), more)))


def rewritten(headers: DataFrame, aliases: DataFrame, excluded: DataFrame | None = None, name: str = "id") -> DataFrame:
    """headers with new_id, reason, source and target: names whose label is excluded are dropped (new_id null), names of aliases rewritten, others kept.

    aliases(alias, canonical), one row an alias; excluded(label). The first candidate decides whose rewriting changes the name: what follows the
    label stays, and what follows a bar stays behind the canonical label. Only distinct names are looked up.
    """
    ids = headers.select(F.col(name).alias("_id")).distinct()
    tried = ids.select("_id", F.posexplode(label_candidates(F.col("_id"))).alias("_pos", "_cand"))
    met = tried.join(aliases.select(F.col("alias").alias("_cand"), "canonical"), "_cand")
    bar = F.instr("_id", "|") > 0
    new = F.when(bar, F.concat("canonical", F.regexp_replace("_id", r"^[^|]*", ""))).when(F.startswith("_id", "_cand"), F.concat("canonical", F.substr("_id", F.length("_cand") + 1)))
    told = met.withColumn("_new", new).where("_new is not null and _new <> _id")
    first = told.groupBy("_id").agg(F.min(F.struct("_pos", "_new", F.col("_cand").alias("source"), F.col("canonical").alias("target"))).alias("_r"))
    found = ids.join(first, "_id", "left")
    if excluded is not None:
        out = tried.join(excluded.select(F.col("label").alias("_cand")).distinct(), "_cand").groupBy("_id").agg(F.min(F.struct("_pos", F.col("_cand").alias("source"))).alias("_x"))
        found = found.join(out, "_id", "left")
    else:
        found = found.withColumn("_x", F.lit(None).cast("struct<_pos:int,source:string>"))
    gone, hit = F.col("_x").isNotNull(), F.col("_r").isNotNull()
    told = found.select(
        F.col("_id").alias(name), F.when(gone, F.lit(None)).when(hit, F.col("_r._new")).otherwise(F.col("_id")).alias("new_id"),
        F.when(gone, "dropped_excluded_label").when(hit, "alias_rewrite").otherwise("").alias("reason"), F.when(gone, F.col("_x.source")).otherwise(F.col("_r.source")).alias("source"), F.when(~gone, F.col("_r.target")).alias("target"),
    )
    return headers.join(told, name)


def rewrite_totals(audited: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, seen, rewritten, dropped) of rewritten()."""
    is_ = lambda r: F.count_if(F.col("reason") == r)
    return audited.groupBy(*keys).agg(F.count("*").alias("seen"), is_("alias_rewrite").alias("rewritten"), is_("dropped_excluded_label").alias("dropped"))
