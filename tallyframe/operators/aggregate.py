"""Panel, sequence and evaluation aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def panel_metrics(hits: DataFrame, keys: Sequence[str], model: str, item: str, panel: Sequence[str]) -> DataFrame:
    """(keys, present, total, size): models of the panel with hits, and distinct (item, model) hits."""
    inside = F.col(model).isin(*panel)
    pair = F.struct(item, model)
    return hits.groupBy(*keys).agg(
        F.count_distinct(F.when(inside, F.col(model))).alias("present"), F.count_distinct(F.when(inside, pair)).alias("total"), F.lit(len(panel)).alias("size")
    )


def max_then_sum(hits: DataFrame, keys: Sequence[str], model: str, score: str) -> DataFrame:
    """(keys, best_sum, n_models): the sum of each model's best score."""
    one = hits.groupBy(*keys, model).agg(F.max(score).alias("m"))
    return one.groupBy(*keys).agg(F.sum("m").alias("best_sum"), F.count("*").alias("n_models"))


def pivot_zero(df: DataFrame, key: str, column: str, values: Sequence[str], item: str) -> DataFrame:
    """A column of distinct items for each value, 0 where none."""
    cells = df.groupBy(key).pivot(column, list(values)).agg(F.count_distinct(item))
    return cells.select(key, *(F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(v.replace("#", "_").replace(" ", "_")) for v in values))


def sequence_stats(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """(keys, contigs, bases, gc): sequences, characters, and G and C in either case. Upper case is not taken: it lengthens some letters."""
    text = F.coalesce(seq, F.lit(""))
    gc = F.length(text) - F.length(F.translate(text, "GCgc", ""))
    return df.groupBy(*keys).agg(F.count("*").alias("contigs"), F.sum(F.length(text)).alias("bases"), F.sum(gc).alias("gc"))


def conditional_counts(df: DataFrame, keys: Sequence[str], **conditions: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *(F.count_if(c).alias(k) for k, c in conditions.items()))


def medians(df: DataFrame, keys: Sequence[str], *values: str) -> DataFrame:
    """Exact interpolated medians."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *(F.median(v).alias(f"median_{v}") for v in values))


def prevalence(counts: DataFrame, group: str, marker: str, genome: str, n: str, markers: Sequence[str] | None = None) -> DataFrame:
    """(group, marker, n_genomes, with_marker, copies, mean_copy): genomes of the group, those with the marker, its copies, and these over
    all genomes of the group, absent counting as 0. With a list of markers each group has a row for each of them, also where no genome has it."""
    genomes = counts.groupBy(group).agg(F.count_distinct(genome).alias("n_genomes"))
    present = counts.where(F.col(n) > 0).groupBy(group, marker).agg(F.count_distinct(genome).alias("with_marker"), F.sum(n).alias("copies"))
    if markers is not None:
        grid = genomes.select(group, F.explode(F.array(*(F.lit(m) for m in markers))).alias(marker))
        present = grid.join(present, [group, marker], "left").na.fill(0, ["with_marker", "copies"])
    return present.join(genomes, group).withColumn("mean_copy", F.col("copies") / F.col("n_genomes"))


def pivot_best(df: DataFrame, key: str, column: str, values: Sequence[str], score: str) -> DataFrame:
    """A column of the highest score for each value, 0 where none."""
    cells = df.groupBy(key).pivot(column, list(values)).agg(F.max(score))
    return cells.select(key, *(F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(v.replace("#", "_").replace(" ", "_")) for v in values))


def assembly_stats(contigs: DataFrame, genes: DataFrame, keys: Sequence[str], seq: str, length: str) -> DataFrame:
    """(keys, contigs, bases, gc_percent, genes, coding_percent) of contigs with sequences and genes with lengths; percentages to two digits, 0 of nothing."""
    share = lambda a, b: F.round(F.round(F.coalesce(F.try_divide(a * 100.0, b), F.lit(0.0)), 9), 2)
    called = genes.groupBy(*keys).agg(F.count("*").alias("genes"), F.sum(length).alias("_coding"))
    told = sequence_stats(contigs, keys, seq).join(called, list(keys), "left").na.fill(0, ["genes", "_coding"])
    return told.select(*keys, "contigs", "bases", share(F.col("gc"), F.col("bases")).alias("gc_percent"), "genes", share(F.col("_coding"), F.col("bases")).alias("coding_percent"))


def single_parent(df: DataFrame, child: str, parent: str) -> DataFrame:
    """(child, parent) for children that map to one parent only."""
    pairs = df.select(child, parent).where(F.col(child).isNotNull() & F.col(parent).isNotNull())
    return pairs.groupBy(child).agg(F.min(parent).alias(parent), F.max(parent).alias("_hi")).where(F.col(parent) == F.col("_hi")).drop("_hi")


def confusion(df: DataFrame, truth: Column, guess: Column, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, tp, fp, fn, tn)."""
    one = lambda a, b: F.count_if(a & b)
    return df.groupBy(*keys).agg(one(truth, guess).alias("tp"), one(~truth, guess).alias("fp"), one(truth, ~guess).alias("fn"), one(~truth, ~guess).alias("tn"))


def precision_recall(counts: DataFrame) -> DataFrame:
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({"precision": div(tp, tp + fp), "recall": div(tp, tp + fn), "f1": div(2 * tp, 2 * tp + fp + fn)})


def best_threshold(df: DataFrame, truth: Column, score: str, grid: Sequence[float]) -> DataFrame:
    """(threshold, f1): the first threshold of the grid with the highest F1.

    Each row goes to its place in the grid once and the grid's counts are summed up, so rows are not multiplied by thresholds.
    """
    values = F.array(*(F.lit(float(g)) for g in sorted(grid)))
    upto = F.size(F.filter(values, lambda g: g <= F.col(score)))
    bins = df.groupBy(upto.alias("k")).agg(F.count_if(truth).alias("pos"), F.count("*").alias("n"))
    total = bins.agg(F.sum("pos").alias("all_pos"))
    each = bins.select(F.explode(F.sequence(F.lit(1), F.greatest("k", F.lit(1)))).alias("i"), "k", "pos", "n").where("i <= k")
    sums = each.groupBy("i").agg(F.sum("pos").alias("tp"), F.sum("n").alias("called")).join(F.broadcast(total))
    f1 = F.coalesce(F.try_divide(F.col("tp") * 2, F.col("called") + F.col("all_pos")), F.lit(0.0))
    rated = sums.select(F.element_at(values, F.col("i")).alias("threshold"), f1.alias("f1"))
    return rated.agg(F.min(F.struct((-F.col("f1")).alias("o"), F.col("threshold").alias("t"))).alias("_b")).select(F.col("_b.t").alias("threshold"), (-F.col("_b.o")).alias("f1"))


def running_before(per: DataFrame, score: str, sums: Sequence[str], keys: Sequence[str] = (), descending: bool = False, bins: int = 256) -> DataFrame:
    """per with before_<sum>: the sum over the rows whose score comes first, in order of score. per has one row for each score and keys.

    Scores are cut into ranges at approximate quantiles; the ranges' totals are summed up first, then the rows within each range, so no
    task holds more than a range.
    """
    cuts = sorted(set(per.approxQuantile(score, [i / bins for i in range(1, bins)], 0.25 / bins))) if bins > 1 else []
    at = F.size(F.filter(F.array(*(F.lit(float(c)) for c in cuts)).cast("array<double>"), lambda c: c <= F.col(score)))
    binned = per.withColumn("_bin", -at if descending else at)
    first = lambda col, *by: W.partitionBy(*by).orderBy(col).rowsBetween(W.unboundedPreceding, -1)
    totals = binned.groupBy(*keys, "_bin").agg(*(F.sum(c).alias(c) for c in sums))
    ranges = first("_bin", *(keys or [F.lit(0)]))  # at most `bins` rows of each key
    offsets = totals.select(*keys, "_bin", *(F.coalesce(F.sum(c).over(ranges), F.lit(0)).alias(f"_{c}") for c in sums))
    within = first(F.col(score).desc() if descending else F.col(score).asc(), *keys, "_bin")
    met = binned.join(offsets, [*keys, "_bin"])
    return met.withColumns({f"before_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"_{c}") for c in sums}).drop("_bin", *(f"_{c}" for c in sums))


def auroc(df: DataFrame, truth: Column, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, auroc): by sums over distinct scores, ties counted half; only the distinct scores are ranked. Rows without score rank lowest.

    Cuts between ranges of scores are measured while the plan is built, over all keys together."""
    per = df.groupBy(*keys, score).agg(F.count_if(truth).alias("pos"), F.count_if(~truth).alias("neg"))
    below = running_before(per, score, ["neg"], keys)
    won = F.sum(F.col("pos") * (2 * F.col("before_neg") + F.col("neg")))
    return below.groupBy(*keys).agg(F.try_divide(won, 2 * F.sum("pos") * F.sum("neg")).alias("auroc"))


def average_precision(df: DataFrame, truth: Column, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, average_precision): precision at each distinct score from the highest on, weighted by the positives there. Rows without score come last."""
    per = df.groupBy(*keys, score).agg(F.count_if(truth).alias("pos"), F.count("*").alias("n"))
    run = running_before(per, score, ["pos", "n"], keys, descending=True)
    tp, called = F.col("before_pos") + F.col("pos"), F.col("before_n") + F.col("n")
    return run.groupBy(*keys).agg(F.try_divide(F.sum(F.col("pos") * tp / called), F.sum("pos")).alias("average_precision"))


def mean_error(df: DataFrame, truth: str, guess: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.abs(F.col(truth) - F.col(guess))).alias("mae"), F.count("*").alias("n"))


def baselines(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """(keys, baseline_mean, baseline_median, n_refs): to four digits."""
    four = lambda c: F.round(F.round(c, 9), 4)
    return df.groupBy(*keys).agg(four(F.avg(score)).alias("baseline_mean"), four(F.median(score)).alias("baseline_median"), F.count("*").alias("n_refs"))


def mean_or_zero(df: DataFrame, entities: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, mean) for every row of entities; 0 where there is nothing to average."""
    sums = df.groupBy(*keys).agg(F.avg(value).alias("mean"))
    return entities.select(*keys).distinct().join(sums, list(keys), "left").withColumn("mean", F.coalesce("mean", F.lit(0.0)))


def means(df: DataFrame, keys: Sequence[str], values: Sequence[str], digits: int = 2) -> DataFrame:
    """(keys, values): the mean of each value."""
    return df.groupBy(*keys).agg(*(F.round(F.round(F.avg(v), 9), digits).alias(v) for v in values))


def largest(df: DataFrame, keys: Sequence[str], part: str, size: str) -> DataFrame:
    """(keys, part, size): the part with the largest sum of sizes, the first by name among equals."""
    sums = df.groupBy(*keys, part).agg(F.sum(size).alias("_s"))
    top = sums.groupBy(*keys).agg(F.min(F.struct((-F.col("_s")).alias("o"), F.col(part).alias("p"))).alias("_t"))
    return top.select(*keys, F.col("_t.p").alias(part), (-F.col("_t.o")).alias(size))


def foreign_size(base: Column, share: Column, least: int = 2000) -> Column:
    """How much must be added to base so that it makes up the share of the whole; at least `least`. Ties to even."""
    return F.greatest(F.lit(least), F.bround(base * share / F.greatest(1.0 - share, F.lit(1e-9)))).cast("long")
