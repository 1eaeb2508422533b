"""Alignments as columns of sites: trimming, supermatrices and their partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.joins import grid_fill
from tallyframe.operators.rank import running_ranges


def widths(aligned: DataFrame, group: str, seq: str) -> DataFrame:
    """(group, width) of groups whose sequences all have one width."""
    return aligned.groupBy(group).agg(F.min(F.length(seq)).alias("width"), F.max(F.length(seq)).alias("_hi")).where("width = _hi").drop("_hi")


def trim_sites(aligned: DataFrame, group: str, taxon: str, seq: str, most_gaps: float) -> DataFrame:
    """Sequences without the sites at which more than the given share of the group's taxa have a gap."""
    sites = aligned.select(group, taxon, F.posexplode(F.split(seq, "")).alias("site", "c"))
    kept = sites.groupBy(group, "site").agg(F.count_if(F.col("c") == "-").alias("gaps"), F.count("*").alias("n")).where(F.col("gaps") <= F.col("n") * most_gaps)
    inside = kept.groupBy(group).agg(F.array_sort(F.collect_list("site")).alias("sites"))
    picked = F.array_join(F.transform("sites", lambda i: F.substr(F.col(seq), i + 1, F.lit(1))), "")
    return aligned.join(inside, group, "left").select(group, taxon, F.when(F.col("sites").isNull(), "").otherwise(picked).alias(seq))


def supermatrix(aligned: DataFrame, taxon: str, group: str, seq: str) -> DataFrame:
    """(taxon, seq): every group's block side by side, gaps where a taxon lacks a group."""
    blocks = widths(aligned, group, seq)
    cells = aligned.join(blocks.select(group), group).select(taxon, group, seq)
    full = grid_fill(cells, cells, taxon, blocks, group, {seq: F.expr("repeat('-', width)")})
    return full.groupBy(taxon).agg(F.array_sort(F.collect_list(F.struct(F.col(group).alias("g"), F.col(seq).alias("s")))).alias("_b")).select(
        taxon, F.array_join(F.transform("_b", lambda x: x["s"]), "").alias(seq)
    )


def partitions(aligned: DataFrame, group: str, seq: str) -> DataFrame:
    """(group, width, start, stop): one row for each group, so one running sum over all."""
    return running_ranges(widths(aligned, group, seq).withColumn("_all", F.lit(1)), ["_all"], [F.col(group).asc()], "width").drop("_all")


def same_taxa(before: DataFrame, after: DataFrame, group: str, taxon: str) -> DataFrame:
    """(group, missing, extra) of groups whose taxa differ."""
    a, b = before.select(group, taxon).distinct(), after.select(group, taxon).distinct()
    lost = a.join(b, [group, taxon], "left_anti").select(group, F.lit(1).alias("m"), F.lit(0).alias("x"))
    more = b.join(a, [group, taxon], "left_anti").select(group, F.lit(0).alias("m"), F.lit(1).alias("x"))
    return lost.unionByName(more).groupBy(group).agg(F.sum("m").alias("missing"), F.sum("x").alias("extra"))
