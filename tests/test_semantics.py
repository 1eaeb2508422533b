"""Small cases that tell right results from near ones, worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import scalars
from tallyframe.operators import aggregate, rank, scoring, tree, vote
from tallyframe.sources import tables


def _signals(spark, **given):
    names = "unique_cell total_cell strong_cell nonviral_pct dom_nonviral_pct unique_phage total_phage strong_phage order_dup panel_dup second_order_pct second_family_pct foreign_order foreign_family dom_foreign_pct".split()
    values = dict.fromkeys(names, 0.0) | {"order_dup": 1.0, "panel_dup": 1.0} | given
    return spark.createDataFrame([tuple(float(values[n]) for n in names)], names)


def test_a_clean_score_has_no_source(spark):
    """A cellular signal of 10 gives a score of 3.8: clean, however strong the signal."""
    r = scoring.contamination_rules(_signals(spark, nonviral_pct=50.0)).first()
    assert (r.cellular, round(r.score, 6), r.flag, r.source) == (10.0, 3.8, "clean", "none")
    r = scoring.contamination_rules(_signals(spark, nonviral_pct=100.0, strong_cell=1.0)).first()
    assert (round(r.score, 6), r.source) == (8.74, "cellular")


def test_foreign_orders_are_a_viral_mixture(spark):
    no = F.lit(False)
    reason = scoring.suspicious_reason(F.lit("viral_bearing"), no, F.lit(0), F.lit(0), F.lit(0.0), F.lit(2), F.lit(0), F.lit(0), F.lit(2), F.lit(0.6))
    r = spark.range(1).select(reason.alias("reason"), scoring.candidate_type(reason).alias("kind")).first()
    assert (r.reason, r.kind) == ("viral_mixture", "mixed_viral")


@pytest.mark.parametrize(
    ("estimate", "threshold", "coherent", "viral", "source", "kind"),
    [
        (None, None, None, None, None, "clean"), (float("nan"), 12.0, 1, 3, "phage", "uncertain"), (11.0, 12.0, 1, 0, "phage", "clean"), (12.0, 12.0, 1, 0, "phage", "cellular"),
        (50.0, None, 0, 0, "soil", "uncertain"), (50.0, 0.0, 0, 0, "none", "uncertain"), (50.0, 0.0, 0, 0, None, "uncertain"), (50.0, 0.0, 0, 3, "viral_mixture", "uncertain"),
        (50.0, 0.0, 0, 2, "viral_mixture", "mixed_viral"), (50.0, 0.0, None, None, "duplication", "duplication"),
    ],
)
def test_contamination_types(spark, estimate, threshold, coherent, viral, source, kind):
    row = spark.createDataFrame([(estimate, threshold, coherent, viral, source)], "e double, t double, c int, v int, s string")
    assert row.select(scoring.contamination_type(*(F.col(c) for c in "etcvs"))).first()[0] == kind


def test_confidence_takes_all_expected_weights(spark):
    """Weights 1 (present) and 9 (absent): coverage 0.5, mean 5, deviation 4, so 35 + 30 * 0.2 = 41."""
    df = spark.createDataFrame([("a", 1.0, True), ("a", 9.0, False), ("z", 0.0, True), ("z", 0.0, True)], "k string, w double, here boolean")
    got = {r.k: (round(r.completeness, 6), round(r.confidence, 6)) for r in scoring.weighted_completeness(df, ["k"], "w", "here").collect()}
    assert got == {"a": (10.0, 41.0), "z": (0.0, 70.0)}


def test_copies_are_averaged_over_all_genomes(spark):
    df = spark.createDataFrame([("g", "m", i, 2) for i in range(6)] + [("g", "n", i, 1) for i in range(10)], "grp string, marker string, genome int, n int")
    m = aggregate.prevalence(df, "grp", "marker", "genome", "n").where("marker = 'm'").first()
    assert (m.with_marker, m.n_genomes, m.copies, m.mean_copy) == (6, 10, 12, 1.2)


def test_tallies_fold_below_the_domain_only(spark):
    rows = [("domain", "A", 99), ("domain", "B", 1), ("order", "A__x", 96), ("order", "B_y", 2), ("order", "A__A_unclassified", 2), ("class", "A__A_other", 50), ("class", "A__c", 50)]
    df = spark.createDataFrame(rows, "level string, taxon string, n long")
    got = {r.level: r.tally for r in vote.tally(df, ["level"], "taxon", level="level").collect()}
    assert got == {"domain": "A:99(99.00%),B:1(1.00%)", "order": "A__x:96(96.00%),A__other:2(2.00%),B__other:2(2.00%)", "class": "A__c:50(50.00%),A__other:50(50.00%)"}


def test_a_subject_is_listed_once_over_all_queries(spark):
    rows = [("q1", "s", 1, 5.0), ("q2", "s", 1, 9.0), ("q1", "t", 2, 9.0), ("q2", "t", 2, 9.0), ("q1", "late", 3, 99.0)]
    got = rank.first_n_then_unique(spark.createDataFrame(rows, "q string, s string, at int, score double"), "q", "s", "at", "score", 2)
    assert [(r.s, r.score, r.q) for r in got.orderBy(F.desc("score"), "q", "at").collect()] == [("t", 9.0, "q1"), ("s", 9.0, "q2")]


def test_clade_spread_is_the_mean_over_its_pairs(spark):
    """((a:1,b:2):3,(c:4,r:5):6): queries a, b, c; the clade of a and b has distance 3, that of c alone none."""
    edges = spark.createDataFrame(
        [("t", 0, None, 0.0, None), ("t", 1, 0, 3.0, None), ("t", 2, 0, 6.0, None), ("t", 3, 1, 1.0, "a"), ("t", 4, 1, 2.0, "b"), ("t", 5, 2, 4.0, "c"), ("t", 6, 2, 5.0, "r")],
        "tree string, node int, parent int, length double, leaf string",
    )
    queries = spark.createDataFrame([("t", x) for x in "abc"], "tree string, leaf string")
    assert sorted((r.node, r.mean_dist, r.pairs) for r in tree.clade_spread(edges, queries).collect()) == [(1, 3.0, 1), (5, 0.0, 0)]
    whole = spark.createDataFrame([("t", x) for x in "abcr"], "tree string, leaf string")
    got = tree.clade_spread(edges, whole).first()
    pairs = tree.patristic(edges, whole, whole).where("a < b")
    assert (got.node, got.pairs) == (0, 6) and got.mean_dist == pytest.approx(pairs.agg(F.avg("dist")).first()[0]) == pytest.approx((3 + 14 + 15 + 15 + 16 + 9) / 6)


@pytest.mark.parametrize(
    ("seq", "kind"),
    [("MKWVNDHRYSGACD", "protein"), ("ACGTNNRY", "nucleotide"), ("acgtacgtacgta", "nucleotide"), ("GAGAGSGAGAGS", "protein"), ("GAGAG", "nucleotide"), ("NNN--", "nucleotide"), ("", "nucleotide"), (None, "nucleotide"), ("ACGU", "protein"), ("AC*", "protein"), ("RYA", "protein")],
)
def test_alphabets(spark, seq, kind):
    assert spark.createDataFrame([(seq,)], "s string").select(scalars.alphabet(F.col("s"))).first()[0] == kind


def test_support_is_rounded_before_it_is_judged(spark):
    """A share of 0.23528 alone gives 0.199988, which rounds to 0.2."""
    df = spark.createDataFrame([(100_000, 23_528, 0, "order"), (100_000, 23_520, 0, "order")], "inf int, pre int, refs int, level string")
    assert [r.ood_flag for r in scoring.support(df, "inf", "pre", "refs", "level").collect()] == ["low_reference_support", "low_support"]


def test_hits_without_an_e_value_stay(spark):
    line = "q\ts\t50.0\t9\t0\t0\t1\t9\t1\t9\t{}\t77"
    lines = spark.createDataFrame([(line.format("1e-5"),), (line.format("none"),), (line.replace("50.0", "x").format("1"),)], "value string")
    assert tables.similarity_hits(lines).count() == 2


@pytest.mark.parametrize("bins", [1, 3, 256])
def test_running_sums_over_ranges(spark, bins):
    per = spark.createDataFrame([(i * 0.5, i % 3) for i in range(200)], "score double, n int")
    for down in (False, True):
        got = {r.score: r.before_n for r in aggregate.running_before(per, "score", ["n"], descending=down, bins=bins).collect()}
        order = sorted(range(200), reverse=down)
        assert got == {i * 0.5: sum(j % 3 for j in order[:at]) for at, i in enumerate(order)}
