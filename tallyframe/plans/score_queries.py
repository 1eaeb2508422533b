"""Scoring and classification queries over synthetic signals from lineitem."""

from pyspark.sql import functions as F

from tallyframe.operators import scoring
from tallyframe.plans.aggregate_queries import _PREV, prevalence
from tallyframe.plans.base import query, table

# one row for each supplier with small integer signals
_SIGNALS = """sig AS (SELECT l_suppkey AS query, count(*) AS n, count(*) FILTER (l_linenumber = 7) AS unique_cell, count(*) FILTER (l_linenumber >= 6) AS total_cell, count(*) FILTER (l_quantity >= 49) AS strong_cell,
  count(*) FILTER (l_returnflag = 'R' AND l_linenumber = 6) AS unique_phage, count(*) FILTER (l_returnflag = 'R' AND l_linenumber >= 6) AS total_phage, count(*) FILTER (l_quantity = 1 AND l_linenumber = 1) AS strong_phage,
  count(*) FILTER (l_discount = 0.1) % 4 AS foreign_order, count(*) FILTER (l_discount = 0.09) % 5 AS foreign_family, count(*) % 100 AS pct, count(*) % 7 AS small FROM lineitem GROUP BY l_suppkey),
inp AS (SELECT query, unique_cell % 5 AS unique_cell, unique_cell % 5 + total_cell % 4 AS total_cell, strong_cell % 6 AS strong_cell, pct * 1.0 AS nonviral_pct, pct * 0.5 AS dom_nonviral_pct, unique_phage % 4 AS unique_phage,
  unique_phage % 4 + total_phage % 3 AS total_phage, strong_phage % 3 AS strong_phage, 1.0 + small * 0.25 AS order_dup, 1.0 + small * 0.125 AS panel_dup, (pct % 50) * 1.0 AS second_order_pct, (pct % 40) * 1.0 AS second_family_pct,
  foreign_order, foreign_family, (pct % 30) * 1.0 AS dom_foreign_pct FROM sig)"""


def _signals(spark, sf):
    c, n = F.col, F.count_if
    s = table(spark, sf, "lineitem").groupBy(c("l_suppkey").alias("query")).agg(
        n(c("l_linenumber") == 7).alias("uc"), n(c("l_linenumber") >= 6).alias("tc"), n(c("l_quantity") >= 49).alias("sc"),
        n((c("l_returnflag") == "R") & (c("l_linenumber") == 6)).alias("up"), n((c("l_returnflag") == "R") & (c("l_linenumber") >= 6)).alias("tp"),
        n((c("l_quantity") == 1) & (c("l_linenumber") == 1)).alias("sp"), n(c("l_discount") == 0.1).alias("fo"), n(c("l_discount") == 0.09).alias("ff"), F.count("*").alias("all"),
    )
    pct, small = c("all") % 100, c("all") % 7
    return s.select(
        "query", (c("uc") % 5).alias("unique_cell"), (c("uc") % 5 + c("tc") % 4).alias("total_cell"), (c("sc") % 6).alias("strong_cell"), (pct * 1.0).alias("nonviral_pct"),
        (pct * 0.5).alias("dom_nonviral_pct"), (c("up") % 4).alias("unique_phage"), (c("up") % 4 + c("tp") % 3).alias("total_phage"), (c("sp") % 3).alias("strong_phage"),
        (small * 0.25 + 1.0).alias("order_dup"), (small * 0.125 + 1.0).alias("panel_dup"), ((pct % 50) * 1.0).alias("second_order_pct"), ((pct % 40) * 1.0).alias("second_family_pct"),
        (c("fo") % 4).alias("foreign_order"), (c("ff") % 5).alias("foreign_family"), ((pct % 30) * 1.0).alias("dom_foreign_pct"),
    )


@query(f"""WITH {_SIGNALS}, s AS (SELECT *, least(greatest((CASE WHEN unique_cell >= 1 THEN 1 ELSE 0 END) * (greatest(unique_cell - 1, 0) * 9 + greatest(total_cell - unique_cell, 0) * 1.5) + 3 * strong_cell + 0.2 * nonviral_pct
    + (CASE WHEN strong_cell >= 3 THEN 1 ELSE 0 END) * 0.1 * dom_nonviral_pct, 0), 100) AS cell,
  least(greatest((CASE WHEN unique_phage >= 2 THEN 1 ELSE 0 END) * (unique_phage - 1) * 10 + 2 * greatest(total_phage - unique_phage, 0) + 4 * strong_phage, 0), 100) AS phage_,
  least(45 * greatest(order_dup - 1.2, 0) + 30 * greatest(panel_dup - 1.3, 0), 100) AS dup_,
  least(1.3 * greatest(second_order_pct - 10, 0) + 0.8 * greatest(second_family_pct - 15, 0) + 5 * foreign_order + 2.5 * foreign_family + (CASE WHEN foreign_order >= 3 THEN 1 ELSE 0 END) * 0.15 * dom_foreign_pct, 100) AS mix FROM inp),
r AS (SELECT *, 0.38 * cell + 0.12 * phage_ + 0.2 * dup_ + 0.3 * mix AS sc, greatest(cell, phage_, dup_, mix) AS top FROM s)
SELECT query, CAST(round(sc * 10000) AS BIGINT) AS score, CASE WHEN sc >= 45 THEN 'high' WHEN sc >= 20 THEN 'moderate' WHEN sc >= 8 THEN 'low' ELSE 'clean' END AS flag,
  CASE WHEN sc < 8 THEN 'none' WHEN cell = top THEN 'cellular' WHEN phage_ = top THEN 'phage' WHEN dup_ = top THEN 'duplication' ELSE 'viral_mixture' END AS source FROM r""")
def contamination_rules(spark, sf):
    return scoring.contamination_rules(_signals(spark, sf)).select("query", F.round(F.round(F.col("score") * 10000, 4)).cast("long").alias("score"), "flag", "source")


_CONTIGS = """con AS (SELECT l_orderkey AS contig, count(*) FILTER (l_returnflag = 'A') AS viral, count(*) FILTER (l_returnflag = 'N') AS cell, count(*) FILTER (l_returnflag = 'R') AS phage,
  max(l_linenumber) AS n, median(l_quantity) AS med, count(*) FILTER (l_linestatus = 'F') AS frn FROM lineitem GROUP BY l_orderkey)"""


def _contigs(spark, sf):
    c, n = F.col, F.count_if
    return table(spark, sf, "lineitem").groupBy(c("l_orderkey").alias("contig")).agg(
        n(c("l_returnflag") == "A").alias("viral"), n(c("l_returnflag") == "N").alias("cell"), n(c("l_returnflag") == "R").alias("phage"), F.max("l_linenumber").alias("n"),
        F.median("l_quantity").alias("med"), n(c("l_linestatus") == "F").alias("frn"),
    )


_PURITY = "CASE WHEN viral >= 1 THEN 'viral_bearing' WHEN cell >= 3 AND cell / n >= 0.6 AND med * 2 >= 70 THEN 'cellular_coherent' ELSE 'ambiguous' END"


@query(f"WITH {_CONTIGS} SELECT contig, {_PURITY} AS purity FROM con")
def contig_purity(spark, sf):
    c = _contigs(spark, sf)
    return c.select("contig", scoring.purity_class(c["viral"], c["cell"], c["cell"] / c["n"], c["med"] * 2).alias("purity"))


@query(f"""WITH {_CONTIGS}, p AS (SELECT *, {_PURITY} AS purity FROM con), r AS (SELECT *, CASE WHEN purity = 'cellular_coherent' THEN 'cellular_coherent_lineage'
  WHEN NOT n >= 5 AND cell >= 2 THEN 'cellular_markers' WHEN NOT n >= 5 AND frn >= 3 AND cell / n >= 0.5 AND viral <= 1 THEN 'cellular_hits' WHEN phage >= 2 AND viral <= 1 THEN 'phage_markers'
  WHEN frn >= 3 AND cell / n >= 0.5 AND viral <= 1 THEN 'phage_hits' WHEN frn >= 2 AND frn / n >= 0.6 AND viral >= 2 THEN 'viral_mixture' END AS reason FROM p)
SELECT contig, reason, CASE WHEN reason IN ('cellular_markers', 'cellular_hits') THEN 'cellular' WHEN reason IN ('phage_markers', 'phage_hits') THEN 'phage' WHEN reason = 'viral_mixture' THEN 'mixed_viral' ELSE 'uncertain' END AS kind
FROM r WHERE reason IS NOT NULL""")
def suspicious_contigs(spark, sf):
    c = _contigs(spark, sf)
    purity = scoring.purity_class(c["viral"], c["cell"], c["cell"] / c["n"], c["med"] * 2)
    reason = scoring.suspicious_reason(purity, c["n"] >= 5, c["cell"], c["frn"], c["cell"] / c["n"], c["viral"], c["phage"], c["frn"], c["frn"], c["frn"] / c["n"])
    return c.select("contig", reason.alias("reason")).where("reason is not null").withColumn("kind", scoring.candidate_type(F.col("reason")))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 AND o_orderkey % 11 <> 0 THEN 'uncertain' WHEN coalesce(e, 0) < greatest(10, coalesce(t, 0)) THEN 'clean' WHEN coh >= 1 THEN 'cellular' WHEN src = 'viral_mixture' AND vir >= 3 THEN 'uncertain'
  WHEN src = 'viral_mixture' THEN 'mixed_viral' WHEN src IN ('cellular', 'phage', 'duplication') THEN src ELSE 'uncertain' END AS kind
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE (o_orderkey % 60) * 1.0 END AS e, CASE WHEN o_custkey % 17 > 0 THEN (o_custkey % 20) * 1.0 END AS t, o_custkey % 3 = 0 AS c3, CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END AS coh, o_custkey % 6 AS vir,
  CASE o_orderkey % 6 WHEN 0 THEN 'viral_mixture' WHEN 1 THEN 'none' WHEN 2 THEN 'phage' WHEN 3 THEN 'duplication' WHEN 4 THEN 'soil' ELSE 'cellular' END AS src FROM orders)""")
def contamination_kind(spark, sf):
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    e = F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, F.lit(float("nan"))).otherwise((k % 60) * 1.0)
    src = F.element_at(F.array(*map(F.lit, ("viral_mixture", "none", "phage", "duplication", "soil", "cellular"))), (k % 6 + 1).cast("int"))
    kind = scoring.contamination_type(e.cast("double"), F.when(u % 17 > 0, (u % 20) * 1.0).cast("double"), F.when(u % 3 == 0, 1).otherwise(0), u % 6, src)
    return table(spark, sf, "orders").select("o_orderkey", kind.alias("kind"))


@query("""WITH s AS (SELECT l_suppkey AS q, count(DISTINCT l_linenumber) AS present, count(*) AS hits, 7 AS expected FROM lineitem WHERE l_quantity >= 45 GROUP BY ALL)
SELECT q, present * 100.0 / expected AS raw_completeness, hits * 1.0 / present AS duplication,
  CASE WHEN q % 4 = 0 THEN present * 100.0 / expected ELSE least(present * 100.0 / expected / (q % 4 * 30) * 100, 100) END AS normalised FROM s""")
def order_completeness(spark, sf):
    s = table(spark, sf, "lineitem").where("l_quantity >= 45").groupBy(F.col("l_suppkey").alias("q")).agg(F.count_distinct("l_linenumber").alias("present"), F.count("*").alias("hits"))
    s = s.withColumns({"expected": F.lit(7), "mean": F.when(F.col("q") % 4 != 0, (F.col("q") % 4 * 30).cast("double"))})
    return scoring.order_completeness(s, "present", "expected", "hits", "mean").select("q", "raw_completeness", "duplication", "normalised")


@query(f"""WITH {_PREV}, t AS (SELECT *, with_marker / n_genomes AS p, copies / n_genomes AS c FROM prev)
SELECT grp, marker, CASE WHEN p >= 0.9 AND c <= 1.2 THEN 'core' WHEN p >= 0.65 AND p < 0.9 AND c <= 1.5 THEN 'shared' WHEN p >= 0.5 AND p < 0.65 THEN 'accessory' END AS tier FROM t""")
def marker_tiers(spark, sf):
    t = prevalence(spark, sf)
    return t.select("grp", "marker", scoring.tier_of(F.col("with_marker") / F.col("n_genomes"), F.col("mean_copy")).alias("tier"))


_TIERS = """tiers AS (SELECT l_orderkey AS k, count(*) FILTER (l_linenumber <= 3) AS core_count, count(*) FILTER (l_linenumber <= 3 AND l_quantity >= 20) AS core_present,
  count(*) FILTER (l_linenumber IN (4, 5)) AS shared_count, count(*) FILTER (l_linenumber IN (4, 5) AND l_quantity >= 20) AS shared_present,
  count(*) FILTER (l_linenumber >= 6) AS accessory_count, count(*) FILTER (l_linenumber >= 6 AND l_quantity >= 20) AS accessory_present, l_orderkey % 12 AS refs FROM lineitem GROUP BY ALL)"""


def _tiers(spark, sf):
    n, many = F.col("l_linenumber"), F.col("l_quantity") >= 20
    aggs = []
    for tier, cond in (("core", n <= 3), ("shared", n.isin(4, 5)), ("accessory", n >= 6)):
        aggs += [F.count_if(cond).alias(f"{tier}_count"), F.count_if(cond & many).alias(f"{tier}_present")]
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(*aggs).withColumn("refs", F.col("k") % 12)


@query(f"""WITH {_TIERS} SELECT k, CAST(round(1e6 * ((CASE WHEN core_count > 0 THEN 0.7 * core_present / core_count ELSE 0 END) + (CASE WHEN shared_count > 0 THEN 0.2 * shared_present / shared_count ELSE 0 END)
  + (CASE WHEN accessory_count > 0 THEN 0.1 * accessory_present / accessory_count ELSE 0 END)) / nullif((CASE WHEN core_count > 0 THEN 0.7 ELSE 0 END) + (CASE WHEN shared_count > 0 THEN 0.2 ELSE 0 END)
  + (CASE WHEN accessory_count > 0 THEN 0.1 ELSE 0 END), 0)) AS BIGINT) AS tier_score FROM tiers""")
def tier_scores(spark, sf):
    return scoring.tier_score(_tiers(spark, sf)).select("k", F.round(F.col("tier_score") * 1e4).cast("long").alias("tier_score"))


_SUPPORT = f"""{_TIERS}, sup AS (SELECT k, core_count + shared_count AS inf, core_present + shared_present AS pre, refs, CASE WHEN k % 13 = 0 THEN 'unavailable' ELSE 'order' END AS lvl FROM tiers),
sco AS (SELECT *, CAST(round(CAST(coalesce(pre / nullif(inf, 0), 0) * 0.85 + least(1, refs / 10) * 0.15 AS DECIMAL(38, 18)), 4) AS DOUBLE) AS s FROM sup),
flg AS (SELECT *, CASE WHEN lvl = 'unavailable' THEN 'unassigned' WHEN inf = 0 THEN 'no_informative_markers' WHEN pre = 0 THEN 'zero_informative_hits' WHEN s < 0.2 THEN 'low_support' WHEN refs < 5 THEN 'low_reference_support' ELSE 'ok' END AS flag FROM sco)"""


def _support(spark, sf):
    t = _tiers(spark, sf).select(
        "k", "refs", (F.col("core_count") + F.col("shared_count")).alias("inf"), (F.col("core_present") + F.col("shared_present")).alias("pre"), F.when(F.col("k") % 13 == 0, "unavailable").otherwise("order").alias("lvl")
    )
    return scoring.support(t, "inf", "pre", "refs", "lvl")


@query(f"WITH {_SUPPORT} SELECT k, CAST(round(s * 1e4) AS BIGINT) AS support, flag FROM flg")
def support_flags(spark, sf):
    return _support(spark, sf).select("k", F.round(F.col("support_score") * 100).cast("long").alias("support"), F.col("ood_flag").alias("flag"))


def _shrink_sql(a, b, c):
    return f"greatest(fl, least(pr, fl + (pr - fl) * ({a} + least(1, refs / 20) * {b} + least(1, s) * {c})))"


@query(f"""WITH {_SUPPORT}, x AS (SELECT *, (k % 90) * 1.0 AS pr, greatest((k % 70) * 1.0, (k % 50) * 1.0) AS fl FROM flg)
SELECT k, CAST(round(1e6 * CASE WHEN flag = 'unassigned' THEN fl WHEN flag IN ('no_informative_markers', 'zero_informative_hits') THEN {_shrink_sql(0.2, 0.4, 0.2)} WHEN flag = 'low_support' THEN {_shrink_sql(0.45, 0.3, 0.2)}
  WHEN flag = 'low_reference_support' THEN {_shrink_sql(0.6, 0.15, 0.1)} ELSE pr END) AS BIGINT) AS capped FROM x""")
def shrunk_predictions(spark, sf):
    k = F.col("k")
    capped = scoring.shrink_to_floor((k % 90) * 1.0, (k % 70) * 1.0, (k % 50) * 1.0, F.col("ood_flag"), F.col("support_score"), F.col("refs"))
    return _support(spark, sf).select("k", F.round(capped * 1e6).cast("long").alias("capped"))


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'tier_no_model' WHEN p_size % 7 = 0 THEN 'model' WHEN p_size < 25 THEN 'tier_r2_below_gate' ELSE 'model' END AS strategy,
  CASE WHEN p_size % 5 = 0 OR p_size % 7 = 0 OR p_size < 25 THEN 'advisory_only' WHEN p_size < 35 THEN 'moderate' ELSE 'high' END AS quality FROM part""")
def r2_gate(spark, sf):
    z = F.col("p_size")
    r2 = F.when(z % 7 == 0, F.lit(float("nan"))).otherwise(z / 50.0)
    strategy, quality = scoring.gate_by_r2(r2.cast("double"), z % 5 != 0)
    return table(spark, sf, "part").select("p_partkey", strategy.alias("strategy"), quality.alias("quality"))


@query(f"""WITH {_PREV} SELECT grp, marker, CAST(round(1e6 * with_marker / n_genomes) AS BIGINT) AS linear, CAST(round(1e6 * exp(100.0 * with_marker / n_genomes / 20)) AS BIGINT) AS exponential,
  CAST(round(1e6 * -ln(1 - 0.9 * with_marker / n_genomes + 1e-10)) AS BIGINT) AS information FROM prev""")
def marker_weights(spark, sf):
    p = F.col("with_marker") / F.col("n_genomes")
    fixed = lambda x: F.round(x * 1e6).cast("long")
    return prevalence(spark, sf).select(
        "grp", "marker", fixed(scoring.marker_weight(p, "linear")).alias("linear"), fixed(scoring.marker_weight(F.lit(100.0) * p, "exponential")).alias("exponential"), fixed(scoring.marker_weight(p * 0.9, "information")).alias("information")
    )


@query(f"""WITH {_PREV}, w AS (SELECT grp, with_marker * 1.0 AS w, copies % 3 > 0 AS here FROM prev), a AS (SELECT grp, sum(CASE WHEN here THEN w ELSE 0 END) / sum(w) AS c, count(*) FILTER (here) / count(*) AS cov,
  CASE WHEN avg(w) > 0 THEN stddev_pop(w) / avg(w) ELSE 1 END AS sp FROM w GROUP BY grp)
SELECT grp, CAST(round(c * 1e8) AS BIGINT) AS completeness, CAST(round(cov * 1e8) AS BIGINT) AS coverage, CAST(round(1e8 * (0.7 * cov + 0.3 * least(greatest(1 - sp, 0), 1))) AS BIGINT) AS confidence FROM a""")
def weighted_completeness(spark, sf):
    w = prevalence(spark, sf).select("grp", (F.col("with_marker") * 1.0).cast("double").alias("w"), (F.col("copies") % 3 > 0).alias("here"))
    out = scoring.weighted_completeness(w, ["grp"], "w", "here")
    return out.select("grp", *(F.round(F.col(c) * 1e6).cast("long").alias(c) for c in ("completeness", "coverage", "confidence")))


@query(f"""WITH {_PREV}, q AS (SELECT grp, count(*) AS n, quantile_cont(with_marker * 1.0, 0.25) AS q1, quantile_cont(with_marker * 1.0, 0.5) AS q2, quantile_cont(with_marker * 1.0, 0.75) AS q3 FROM prev GROUP BY grp),
s AS (SELECT grp, marker, with_marker, n, (with_marker - q2) / (CASE WHEN q3 > q1 THEN q3 - q1 ELSE 1 END) AS s FROM prev JOIN q USING (grp)), e AS (SELECT grp, min(s) AS lo, max(s) AS hi FROM s GROUP BY grp)
SELECT grp, marker, CAST(round(1e6 * CASE WHEN n >= 5 THEN (CASE WHEN hi > lo THEN (s - lo) / (hi - lo) ELSE 0.5 END) * 1.9 + 0.1 ELSE with_marker END) AS BIGINT) AS scaled FROM s JOIN e USING (grp)""")
def adaptive_weights(spark, sf):
    w = prevalence(spark, sf).select("grp", "marker", (F.col("with_marker") * 1.0).cast("double").alias("w"))
    return scoring.adaptive_scale(w, ["grp"], "w").select("grp", "marker", F.round(F.col("scaled") * 1e6).cast("long").alias("scaled"))
