"""Fragments of sequences with log-normal lengths, drawn by hashes: the same key always gives the same fragments, whatever task makes them."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lengths:
    """Fragment lengths: mean, spread of their logarithm, bounds, and the length that one fragment at least should reach."""

    mean: int
    sigma: float
    least: int
    most: int
    long: int
    seed: int = 17

    def __post_init__(self):
        if not (self.mean > 0 and self.sigma > 0 and 1 <= self.least < self.most and self.long >= self.least):
            raise ValueError("lengths out of order")


def uniform(*parts: Column) -> Column:
    """A number above 0 and below 1 from 52 bits of the parts' hash."""
    digest = F.sha2(F.concat_ws(":", *(p.cast("string") for p in parts)), 256)
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def normal(*parts: Column) -> Column:
    """A standard normal variate of the parts."""
    return F.sqrt(-2 * F.ln(uniform(*parts, F.lit("r")))) * F.cos(2 * math.pi * uniform(*parts, F.lit("a")))


def fragments(contigs: DataFrame, key: str, size: str, lengths: Lengths) -> DataFrame:
    """(key, fragment, start, length): fragments from 1 on, starts from 0 on; a contig's lengths sum up to its size.

    As many variates as means fit into the contig are drawn, held within the bounds, scaled to the size and rounded; the last takes what
    rounding leaves. Fragments below the least length go to the next one, or to the last one at the end. If none reaches `long`, the
    longest are joined until one does and stands last, behind the others by falling length. A contig below the least length stays whole; one of
    size 0 has no fragment. Keys should be distinct.
    """
    n = F.greatest(F.bround(F.col(size) / lengths.mean), F.lit(1)).cast("int")
    mu = math.log(lengths.mean) - 0.5 * lengths.sigma**2
    draw = lambda i: F.exp(F.lit(mu) + F.lit(lengths.sigma) * normal(F.lit(lengths.seed), F.col(key), i))
    held = F.transform(F.sequence(F.lit(1), n), lambda i: F.least(F.greatest(draw(i), F.lit(float(lengths.least))), F.lit(float(lengths.most))))
    drawn = contigs.where(F.col(size) > 0).select(key, F.col(size).cast("long").alias("_size"), held.alias("_raw"))
    total = F.aggregate("_raw", F.lit(0.0), lambda a, x: a + x)
    told = drawn.withColumn("_total", total)
    told = told.withColumn("_round", F.transform("_raw", lambda x: F.rint(x * (F.col("_size") / F.col("_total"))).cast("long")))
    told = told.withColumn("_left", F.col("_size") - F.aggregate("_round", F.lit(0).cast("long"), lambda a, x: a + x))
    told = told.withColumn("_cut", F.transform("_round", lambda x, i: F.when(i == F.size("_round") - 1, x + F.col("_left")).otherwise(x)))
    start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("long").alias("carry"))

    def merge(acc: Column, x: Column) -> Column:
        both = acc["carry"] + x
        short = both < lengths.least
        return F.struct(F.when(short, acc["out"]).otherwise(F.concat(acc["out"], F.array(both))).alias("out"), F.when(short, both).otherwise(F.lit(0).cast("long")).alias("carry"))

    def close(acc: Column) -> Column:
        n_out = F.size(acc["out"])
        grown = F.concat(F.slice(acc["out"], F.lit(1), F.greatest(n_out - 1, F.lit(0))), F.array(F.element_at(acc["out"], -1) + acc["carry"]))
        return F.when(acc["carry"] == 0, acc["out"]).when(n_out == 0, F.array(acc["carry"])).otherwise(grown)

    told = told.withColumn("_merged", F.aggregate("_cut", start, merge, close))
    told = told.withColumn("_desc", F.sort_array("_merged", asc=False))
    # how many of the longest make up the long one
    sums = F.aggregate("_desc", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n")), lambda a, x: F.when(a["sum"] >= lengths.long, a).otherwise(F.struct((a["sum"] + x).alias("sum"), (a["n"] + 1).alias("n"))))
    told = told.withColumn("_top", sums)
    joined = F.concat(F.slice("_desc", F.col("_top.n") + 1, F.greatest(F.size("_desc") - F.col("_top.n"), F.lit(0))), F.array(F.col("_top.sum")))
    lacks = (F.array_max("_merged") < lengths.long) & (F.col("_size") >= lengths.long)
    final = F.when(F.col("_size") < lengths.least, F.array(F.col("_size"))).when(lacks, joined).otherwise(F.col("_merged"))
    rows = told.select(key, F.posexplode(final).alias("_i", "length"))
    before = W.partitionBy(key).orderBy("_i").rowsBetween(W.unboundedPreceding, -1)  # the fragments of one contig
    return rows.select(key, (F.col("_i") + 1).alias("fragment"), F.coalesce(F.sum("length").over(before), F.lit(0)).alias("start"), "length")


def shredded(contigs: DataFrame, key: str, sequence: str, lengths: Lengths) -> DataFrame:
    """fragments() of sequences with their pieces: (key, fragment, start, length, piece)."""
    cut = fragments(contigs.select(key, F.length(sequence).alias("_n")), key, "_n", lengths)
    piece = F.substring(F.col(sequence), (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    return cut.join(contigs.select(key, sequence), key).select(key, "fragment", "start", "length", piece.alias("piece"))
