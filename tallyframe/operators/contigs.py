"""Evidence of three levels: proteins vote on their lineage, contigs are judged by their proteins, bins by their contigs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.panels import dominant_lineage
from tallyframe.operators.rank import best
from tallyframe.operators.scoring import purity_class, suspicious_reason

# Domains by kind.
CELLULAR = ("BAC", "ARC", "EUK", "MITO", "PLASTID")
PHAGE = ("PHAGE", "PPV", "PLV", "VP")
GIANT = ("NCLDV", "MIRUS", "MRYA")
#: Fewer proteins with hits than this say nothing about a bin's contigs; from this share of contigs to proteins on, names carry no contig.
LEAST_PROTEINS, WEAK_SHARE = 5, 0.8


def best_hits(hits: DataFrame, bin_col: str = "bin") -> DataFrame:
    """Of hits(bin, protein, domain, order, identity, score) each protein's best, by score, identity, then name."""
    return best(hits, [bin_col, "protein"], ["-score", "-identity", "domain", "order"])


def attribution(bins: DataFrame, bearing: DataFrame) -> DataFrame:
    """(bin, n_proteins, mode) of bins(bin, kind): whether bearing(bin, protein, contig), the proteins with hits, can be trusted to name contigs.

    Called genes ('fna') are trusted; else a bin is weak without such proteins or when nearly each has a contig of its own.
    """
    counts = bearing.groupBy("bin").agg(F.count("*").alias("n_proteins"), F.count_distinct("contig").alias("_contigs"))
    told = bins.join(counts, "bin", "left").withColumn("n_proteins", F.coalesce("n_proteins", F.lit(0)))
    lone = (F.col("n_proteins") >= LEAST_PROTEINS) & (F.col("_contigs") / F.greatest("n_proteins", F.lit(1)) >= WEAK_SHARE)
    mode = F.when(F.col("kind") == "fna", "fna_gene_calling").when((F.col("n_proteins") == 0) | lone, "faa_weak_per_protein").otherwise("faa_contig_encoded")
    return told.select("bin", "n_proteins", mode.alias("mode"))


def contig_purity(bearing: DataFrame, votes: DataFrame, hits: DataFrame) -> DataFrame:
    """(bin, contig, n_proteins, n_viral, n_cellular, purity, median_identity, class) of every contig with bearing proteins.

    votes(bin, protein, domain, order, genus): one row for each placement of a protein, from any marker; the most voted lineage counts.
    purity: the share of the most frequent (domain, order) among cellular proteins; 0 for contigs with viral proteins or too few cellular ones.
    """
    lineage = dominant_lineage(votes, ["bin", "protein"], ["domain", "order", "genus"])
    hit = hits.select("bin", "protein", F.col("domain").alias("_hd"), "identity")
    rows = bearing.join(lineage.select("bin", "protein", "domain", "order"), ["bin", "protein"], "left").join(hit, ["bin", "protein"], "left")
    cellular = F.col("domain").isin(*CELLULAR)
    told = rows.withColumn("_cell", F.coalesce(cellular, F.lit(False))).withColumn("_viral", F.coalesce(F.col("domain").isin(*GIANT, *PHAGE), F.lit(False)))
    identity = F.when(F.col("_cell") & F.col("_hd").isin(*CELLULAR), F.col("identity"))
    sums = told.groupBy("bin", "contig").agg(F.count("*").alias("n_proteins"), F.count_if("_viral").alias("n_viral"), F.count_if("_cell").alias("n_cellular"), F.coalesce(F.median(identity), F.lit(0.0)).alias("median_identity"))
    top = told.where("_cell").groupBy("bin", "contig", "domain", "order").agg(F.count("*").alias("n")).groupBy("bin", "contig").agg(F.max("n").alias("_top"))
    judged = sums.join(top, ["bin", "contig"], "left")
    share = F.when((F.col("n_viral") == 0) & (F.col("n_cellular") >= 3), F.col("_top") / F.col("n_cellular")).otherwise(0.0)
    judged = judged.withColumn("purity", share)
    return judged.select(
        "bin", "contig", "n_proteins", "n_viral", "n_cellular", "purity", "median_identity",
        purity_class(F.col("n_viral"), F.col("n_cellular"), F.col("purity"), F.col("median_identity")).alias("class"),
    )


def contig_evidence(contigs: DataFrame, bearing: DataFrame, hits: DataFrame, markers: DataFrame, primary: DataFrame) -> DataFrame:
    """contigs(bin, contig, length) with counts of strong hits and of markers by kind, and the shares that the rules use.

    Strong hits have identity 60 and score 80 at least. markers(bin, contig, model, kind): kind cellular, phage or viral. primary(bin, order):
    the bin's own order; giant viruses of another one are foreign.
    """
    strong = bearing.join(hits, ["bin", "protein"]).where("identity >= 60 and score >= 80").join(primary.select("bin", F.col("order").alias("_own")), "bin", "left")
    giant = F.col("domain").isin(*GIANT)
    foreign = giant & (F.coalesce("_own", F.lit("")) != "") & (F.coalesce("order", F.lit("")) != "") & (F.col("order") != F.col("_own"))
    counted = strong.groupBy("bin", "contig").agg(
        F.count("*").alias("strong"), F.count_if(F.col("domain").isin(*CELLULAR)).alias("cellular_hits"), F.count_if(F.col("domain").isin(*PHAGE)).alias("phage_hits"),
        F.count_if(giant).alias("viral_hits"), F.count_if(foreign).alias("foreign"),
    )
    kinds = markers.distinct().groupBy("bin", "contig").agg(*(F.count_if(F.col("kind") == k).alias(f"{k}_markers") for k in ("cellular", "phage", "viral")))
    told = contigs.join(counted, ["bin", "contig"], "left").join(kinds, ["bin", "contig"], "left").na.fill(0)
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return told.withColumns({"nonviral": ratio(F.col("cellular_hits") + F.col("phage_hits"), F.col("strong")), "foreign_share": ratio(F.col("foreign"), F.col("viral_hits"))})


def suspicious(evidence: DataFrame, purity: DataFrame, modes: DataFrame) -> DataFrame:
    """evidence with reason: the first rule that a contig meets, null if none. Where contigs are judged by purity the cellular rules give way to it."""
    on = (F.col("mode") != "faa_weak_per_protein") & (F.col("n_proteins") >= LEAST_PROTEINS)
    told = evidence.join(modes.select("bin", on.alias("_on")), "bin").join(purity.select("bin", "contig", F.col("class").alias("_class")), ["bin", "contig"], "left")
    c = F.col
    reason = suspicious_reason(
        F.when(c("_on"), c("_class")), c("_on"), c("cellular_markers"), c("cellular_hits"), c("nonviral"), c("viral_markers"), c("phage_markers"), c("phage_hits"), c("foreign"), c("foreign_share")
    )
    return told.withColumn("reason", reason).drop("_on", "_class")


def bin_features(modes: DataFrame, purity: DataFrame, judged: DataFrame) -> DataFrame:
    """One row for each bin of modes: attribution, features of its coherent and virus-bearing contigs, and its suspicious contigs.

    Features are neutral where contigs are not judged by purity. Shares are in percent of proteins with hits and of the bases of all contigs (of 1 if
    there are none).
    """
    on = (F.col("mode") != "faa_weak_per_protein") & (F.col("n_proteins") >= LEAST_PROTEINS)
    base = judged.select("bin", "contig", "length", "reason").join(purity.drop("n_cellular"), ["bin", "contig"], "full")
    coherent = F.col("class") == "cellular_coherent"
    of = lambda c: F.when(coherent, F.col(c))
    sums = base.groupBy("bin").agg(
        F.count("length").alias("contigs"), F.count("reason").alias("suspicious"), F.coalesce(F.sum("length"), F.lit(0)).alias("_bp"), F.sum(F.when(F.col("reason").isNotNull(), F.col("length"))).alias("_odd"),
        F.count_if(coherent).alias("_n"), F.sum(of("n_proteins")).alias("_held"), F.sum(of("length")).alias("_own"), F.median(of("purity")).alias("_purity"),
        F.median(F.when(coherent & (F.col("median_identity") > 0), F.col("median_identity"))).alias("_identity"), F.count_if(F.col("class") == "viral_bearing").alias("_bearing"),
    )
    told = modes.withColumn("active", on).join(sums, "bin", "left")
    bases = F.greatest(F.coalesce("_bp", F.lit(0)), F.lit(1))
    when = lambda value, digits: F.when(F.col("active"), F.coalesce(F.round(value, digits), F.lit(0.0))).otherwise(0.0)
    count = lambda c: F.when(F.col("active"), F.coalesce(c, F.lit(0))).otherwise(0).cast("long")
    return told.select(
        "bin", "mode", "n_proteins", "active", F.coalesce("contigs", F.lit(0)).alias("contigs"), F.coalesce("suspicious", F.lit(0)).alias("suspicious"),
        F.round(F.coalesce("_odd", F.lit(0)) / bases * 100, 2).alias("suspicious_bp"), count("_n").alias("coherent"), when(F.col("_held") / F.col("n_proteins") * 100, 2).alias("coherent_proteins"),
        when(F.col("_own") / bases * 100, 2).alias("coherent_bp"), when(F.col("_purity"), 4).alias("purity"), when(F.col("_identity"), 2).alias("identity"), count("_bearing").alias("viral_bearing"),
    )
