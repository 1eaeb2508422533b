"""Cases that a reviewer found: each failed before its finding was settled."""

from pyspark.sql import functions as F

from tallyframe.functions import scalars
from tallyframe.operators import grid, joins, scoring
from tallyframe.plans import grid_queries, join_queries, structure_queries, vote_queries

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_equal_signals_name_the_first_source(spark):
    names = "unique_cell total_cell strong_cell nonviral_pct dom_nonviral_pct unique_phage total_phage strong_phage order_dup panel_dup second_order_pct second_family_pct foreign_order foreign_family dom_foreign_pct".split()
    # cellular: 2 * 9 + 2 * 1.5 + 2 * 3 = 27; duplication: 45 * 0.55 + 30 * 0.075 = 27
    row = (3, 5, 2, 0.0, 0.0, 0, 1, 1, 1.75, 1.375, 0.0, 0.0, 1, 0, 0.0)
    got = scoring.contamination_rules(spark.createDataFrame([row], names)).first()
    assert (got.cellular, got.duplication, got.source, got.score) == (27.0, 27.0, "cellular", 17.88)


def test_negative_zero_keeps_its_sign(spark):
    df = spark.createDataFrame([(-0.0,), (0.0,), (-0.04,), (-0.25,), (None,)], "x double")
    assert [r[0] for r in df.select(scalars.fixed_text(F.col("x"), 1)).collect()] == ["-0.0", "0.0", "-0.0", "-0.2", ""]


def test_support_is_rounded_as_a_decimal(spark):
    rows = [(33, 40, 1), (19, 40, 2), (23, 40, 3), (9, 40, 4), (1, 8, 0), (5, 8, 0), (0, 0, 12)]
    df = spark.createDataFrame([(*r, "order") for r in rows], "present long, informative long, refs long, level string")
    got = [r.support_score for r in scoring.support(df, "informative", "present", "refs", "level").collect()]
    assert got == [71.63, 43.38, 53.37, 25.12, 10.63, 53.13, 15.0]


def test_pairs_are_counted_where_they_are_made(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_MEMBERS", 3)
    monkeypatch.setattr(joins, "PAIRS_PER_TASK", 20)
    sets = {f"s{i}": {m for m in range(40) if (m * 7 + i * i) % (i % 4 + 2) == 0} for i in range(9)}
    df = spark.createDataFrame([(s, m) for s, ms in sets.items() for m in ms] + [("s0", 0), ("s1", None)], "s string, m int")
    few = {m: sum(m in ms for ms in sets.values()) for m in range(40)}
    want = {(a, b): n for a in sets for b in sets if a < b and (n := sum(2 <= few[m] <= 4 for m in sets[a] & sets[b]))}
    out = joins.shared_members(df, "s", "m", 4)
    assert {(r.a, r.b): r.shared for r in out.collect()} == want
    # the pairs themselves are shuffled only after they were counted, dealt by a set
    assert "REPARTITION_BY_NUM" in plan_of(out)


def test_counted_pairs_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_MEMBERS", 5)
    # sizes fall as names rise, s3 and s4 are equal; a row without set counts among the sets of its member, one without member in its set's size
    sets = {"s1": set(range(12)), "s2": set(range(1, 10)), "s3": {0, 1, 2, 9}, "s4": {2, 3, 9, 20}, "s5": {5}, "s6": {30}}
    rows = [(s, m) for s, ms in sets.items() for m in ms] + [("s2", 1), ("s5", None), (None, 0), (None, 1)]
    out = joins.shared_members(spark.createDataFrame(rows, "s string, m int"), "s", "m", 3)
    few = {m: sum(m in ms for ms in sets.values()) + (m in (0, 1)) for m in range(40)}
    size = {s: len(ms) + (s == "s5") for s, ms in sets.items()}
    want = {(a, b, n, n / min(size[a], size[b])) for a in sets for b in sets if a < b and (n := sum(few[m] <= 3 for m in sets[a] & sets[b]))}
    # sizes come with the sets: no join meets the pairs, and of the two exchanges the one above deals the sets
    plan = plan_of(out)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert {tuple(r) for r in out.collect()} == want and ("s1", "s5", 1, 0.5) in want


def test_configurations_are_not_shuffled(spark):
    stats, sizes, samples, present = grid_queries._inputs(spark, SF)
    assert "hashpartitioning(name" not in plan_of(grid.scores(stats, sizes, samples, present, grid_queries._CONFIGS))


def test_hot_prefix_is_shared_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_PART", 3)
    names, prefixes = [f"ab{i:03d}" for i in range(60)] + ["b", None], [("ab", i) for i in range(20)] + [("ab05", 20), ("b", 21), ("b", 21), (None, 22), ("abcdef", 23)]
    out = joins.prefix_join(spark.createDataFrame([(n,) for n in names], "name string"), "name", spark.createDataFrame(prefixes, "prefix string, i int"), "prefix")
    assert sorted(map(tuple, out.collect())) == sorted((n, p, i) for n in names for p, i in prefixes if n and p and n.startswith(p))
    assert out.where("prefix = 'ab'").select(F.spark_partition_id()).distinct().count() > 1


def test_votes_of_a_query_meet_once(spark):
    counts = vote_queries.taxon_counts(spark, SF)
    assert "hashpartitioning(query" in plan_of(counts) and plan_of(counts).count("REPARTITION_BY_NUM") >= 2
    assert "level" not in "".join(x for x in plan_of(counts).splitlines() if "Exchange" in x)


def test_contigs_are_counted_without_copies_of_rows(spark):
    assert "Expand" not in plan_of(join_queries.contig_rollup(spark, SF))


def test_trees_are_not_broadcast(spark):
    for query in (structure_queries.nearest_reference, structure_queries.nearest_genomes_in_tree, structure_queries.query_only_clades, structure_queries.mean_pairwise_distance):
        assert "BroadcastHashJoin" not in plan_of(query(spark, SF))
