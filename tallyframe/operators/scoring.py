"""Rule scores and classifications as expressions over typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clip(x: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def order_completeness(df: DataFrame, present: str, expected: str, hits: str, mean: str) -> DataFrame:
    """raw percent, duplication, and percent of the reference mean (raw without one)."""
    raw = F.coalesce(F.try_divide(F.col(present) * 100.0, F.col(expected)), F.lit(0.0))
    dup = F.coalesce(F.try_divide(F.col(hits) * 1.0, F.col(present)), F.lit(0.0))
    normal = F.when(F.coalesce(mean, F.lit(0.0)) <= 0, raw).otherwise(clip(raw / F.col(mean) * 100.0))
    return df.withColumns({"raw_completeness": raw, "duplication": dup, "normalised": normal})


def tier_score(df: DataFrame, weights=(("core", 0.7), ("shared", 0.2), ("accessory", 0.1))) -> DataFrame:
    """Mean presence of the tiers, by weight, over the tiers that have markers. Columns <tier>_present and <tier>_count."""
    top, bottom = F.lit(0.0), F.lit(0.0)
    for tier, w in weights:
        used = F.col(f"{tier}_count") > 0
        top = top + F.when(used, F.lit(w) * F.col(f"{tier}_present") / F.col(f"{tier}_count")).otherwise(0.0)
        bottom = bottom + F.when(used, F.lit(w)).otherwise(0.0)
    return df.withColumn("tier_score", F.coalesce(F.try_divide(top, bottom), F.lit(0.0)) * 100)


def tier_of(prevalence: Column, copies: Column) -> Column:
    """core, shared, accessory; null for a marker that fits no tier."""
    return (
        F.when((prevalence >= 0.9) & (copies <= 1.2), "core")
        .when((prevalence >= 0.65) & (prevalence < 0.9) & (copies <= 1.5), "shared")
        .when((prevalence >= 0.5) & (prevalence < 0.65), "accessory")
    )


def support(df: DataFrame, informative: str, present: str, refs: str, level: str) -> DataFrame:
    """support_score in percent and the flag of the first caveat that holds; the share is rounded to four digits before it is judged.

    It is rounded as a decimal of 18 digits: the shortest text of a binary fraction, which F.round() takes, may lie on the other side of a tie.
    """
    share = F.coalesce(F.try_divide(F.col(present) * 1.0, F.col(informative)), F.lit(0.0))
    units, step = ((share * 0.85 + F.least(F.lit(1.0), F.col(refs) / 10.0) * 0.15) * 1e18).cast("long") + 5 * 10**13, F.lit(10**14)
    score = (units - F.pmod(units, step)) / step / 1e4
    flag = (
        F.when(F.col(level) == "unavailable", "unassigned").when(F.col(informative) == 0, "no_informative_markers").when(F.col(present) == 0, "zero_informative_hits")
        .when(score < 0.2, "low_support").when(F.col(refs) < 5, "low_reference_support").otherwise("ok")
    )
    return df.withColumns({"support_score": F.round(score * 100, 2), "ood_flag": flag})


def shrink_to_floor(prediction: Column, first: Column, second: Column, flag: Column, support_score: Column, refs: Column) -> Column:
    """The prediction drawn to the more conservative score, by the caveat."""
    floor = F.greatest(first, second)
    s, r = clip(support_score / 100.0, 0, 1), clip(refs / 20.0, 0, 1)
    by = lambda a, b, c: F.greatest(floor, F.least(prediction, floor + (prediction - floor) * (F.lit(a) + r * b + s * c)))
    return (
        F.when(flag == "unassigned", floor).when(flag.isin("no_informative_markers", "zero_informative_hits"), by(0.20, 0.40, 0.20))
        .when(flag == "low_support", by(0.45, 0.30, 0.20)).when(flag == "low_reference_support", by(0.60, 0.15, 0.10)).otherwise(prediction)
    )


def gate_by_r2(r2: Column, has_model: Column) -> tuple[Column, Column]:
    """(strategy, quality) by the holdout R2; a NaN counts as missing."""
    missing = r2.isNull() | F.isnan(r2)
    strategy = F.when(~has_model, "tier_no_model").when(missing, "model").when(r2 < 0.5, "tier_r2_below_gate").otherwise("model")
    quality = F.when(~has_model | missing, "advisory_only").when(r2 < 0.5, "advisory_only").when(r2 < 0.7, "moderate").otherwise("high")
    return strategy, quality


def contamination_rules(df: DataFrame) -> DataFrame:
    """Four signals, their weighted score, its flag and the strongest source, none if the score is clean.

    Signals and score are taken to nine digits, so that sums of binary fractions do not decide thresholds and ties.

    Columns: unique_cell, total_cell, strong_cell, nonviral_pct, dom_nonviral_pct, unique_phage, total_phage, strong_phage, order_dup,
    panel_dup, second_order_pct, second_family_pct, foreign_order, foreign_family, dom_foreign_pct.
    """
    c, on = F.col, lambda cond: F.when(cond, 1.0).otherwise(0.0)
    nine = lambda x: F.round(x, 9)
    cell = clip(
        on(c("unique_cell") >= 1) * (relu(c("unique_cell") - 1.0) * 9 + relu(c("total_cell") - c("unique_cell") * 1.0) * 1.5)
        + c("strong_cell") * 3.0 + c("nonviral_pct") * 0.20 + on(c("strong_cell") >= 3) * c("dom_nonviral_pct") * 0.10
    )
    phage = clip(on(c("unique_phage") >= 2) * (c("unique_phage") - 1.0) * 10 + relu(c("total_phage") - c("unique_phage") * 1.0) * 2 + c("strong_phage") * 4.0)
    dup = clip(relu(c("order_dup") - 1.20) * 45 + relu(c("panel_dup") - 1.30) * 30)
    blend = clip(
        relu(c("second_order_pct") - 10.0) * 1.3 + relu(c("second_family_pct") - 15.0) * 0.8 + c("foreign_order") * 5.0 + c("foreign_family") * 2.5
        + on(c("foreign_order") >= 3) * c("dom_foreign_pct") * 0.15
    )
    cell, phage, dup, blend = nine(cell), nine(phage), nine(dup), nine(blend)
    score = nine(cell * 0.38 + phage * 0.12 + dup * 0.20 + blend * 0.30)
    flag = F.when(score >= 45, "high").when(score >= 20, "moderate").when(score >= 8, "low").otherwise("clean")
    most = F.greatest(cell, phage, dup, blend)
    source = F.when(score < 8, "none").when(cell == most, "cellular").when(phage == most, "phage").when(dup == most, "duplication").otherwise("viral_mixture")
    return df.withColumns({"cellular": cell, "phage": phage, "duplication": dup, "viral_mixture": blend, "score": score, "flag": flag, "source": source})


def purity_class(viral: Column, cellular: Column, top_share: Column, median_identity: Column) -> Column:
    coherent = (cellular >= 3) & (top_share >= 0.6) & (median_identity >= 70)
    return F.when(viral >= 1, "viral_bearing").when(coherent, "cellular_coherent").otherwise("ambiguous")


def suspicious_reason(purity: Column, classifier_on: Column, cell_markers: Column, cell_hits: Column, nonviral: Column, viral_markers: Column, phage_markers: Column, phage_hits: Column, foreign: Column, foreign_share: Column) -> Column:
    """The first rule that a contig meets; null if none."""
    few = viral_markers <= 1
    return (
        F.when(purity == "cellular_coherent", "cellular_coherent_lineage")
        .when(~classifier_on & (cell_markers >= 2), "cellular_markers")
        .when(~classifier_on & (cell_hits >= 3) & (nonviral >= 0.5) & few, "cellular_hits")
        .when((phage_markers >= 2) & few, "phage_markers")
        .when((phage_hits >= 3) & (nonviral >= 0.5) & few, "phage_hits")
        .when((foreign >= 2) & (foreign_share >= 0.6) & (viral_markers >= 2), "viral_mixture")
    )


def candidate_type(reason: Column) -> Column:
    """The kind of contamination a reason stands for; 'uncertain' for the rest."""
    return (
        F.when(reason.isin("cellular_markers", "cellular_hits"), "cellular").when(reason.isin("phage_markers", "phage_hits"), "phage")
        .when(reason == "viral_mixture", "mixed_viral").otherwise("uncertain")
    )


def contamination_type(estimate: Column, model_threshold: Column, coherent: Column, viral_contigs: Column, source: Column) -> Column:
    """A missing estimate or threshold counts as 0, a NaN estimate is uncertain, as are sources that are blank, none or unknown."""
    value, floor = F.coalesce(estimate, F.lit(0.0)), F.greatest(F.lit(10.0), F.coalesce(model_threshold, F.lit(0.0)))
    scattered = (source == "viral_mixture") & (F.coalesce(viral_contigs, F.lit(0)) >= 3)
    return (
        F.when(F.isnan(value), "uncertain").when(value < floor, "clean").when(F.coalesce(coherent, F.lit(0)) >= 1, "cellular").when(scattered, "uncertain")
        .when(source == "viral_mixture", "mixed_viral").when(source.isin("cellular", "phage", "duplication"), source).otherwise("uncertain")
    )


def marker_weight(p: Column, strategy: str) -> Column:
    """Weight of a marker by its prevalence: linear and information take a share, exponential a percentage."""
    if strategy == "linear":
        return p
    return F.exp(p / 20.0) if strategy == "exponential" else -F.log(F.lit(1.0) - p + F.lit(1e-10))


def weighted_completeness(df: DataFrame, keys: list[str], weight: str, present: str) -> DataFrame:
    """(keys, completeness, coverage, confidence) in percent; the confidence joins coverage with evenness of all expected weights."""
    w, here = F.col(weight), F.col(present)
    got = F.sum(F.when(here, w).otherwise(0.0))
    even = F.when(F.avg(w) > 0, clip(1 - F.stddev_pop(w) / F.avg(w), 0, 1)).otherwise(0.0)
    coverage = F.count_if(here) / F.count("*")
    agg = df.groupBy(*keys).agg(F.when(F.sum(w) > 0, got / F.sum(w) * 100).otherwise(0.0).alias("completeness"), coverage.alias("coverage"), even.alias("_even"))
    return agg.select(*keys, "completeness", (F.col("coverage") * 100).alias("coverage"), ((F.col("coverage") * 0.7 + F.col("_even") * 0.3) * 100).alias("confidence"))


def adaptive_scale(df: DataFrame, keys: list[str], weight: str, least_rows: int = 5) -> DataFrame:
    """Weights by median and interquartile range, then from 0.1 to 2.0; groups of fewer rows keep theirs."""
    q = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.percentile(weight, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"))
    scaled = df.join(q, keys).withColumn("_s", (F.col(weight) - F.col("_q")[1]) / F.when(F.col("_q")[2] > F.col("_q")[0], F.col("_q")[2] - F.col("_q")[0]).otherwise(1.0))
    ends = scaled.groupBy(*keys).agg(F.min("_s").alias("_lo"), F.max("_s").alias("_hi"))
    unit = F.when(F.col("_hi") > F.col("_lo"), (F.col("_s") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(0.5)
    out = F.when(F.col("_n") >= least_rows, unit * 1.9 + 0.1).otherwise(F.col(weight))
    return scaled.join(ends, keys).withColumn("scaled", out).drop("_n", "_q", "_s", "_lo", "_hi")
