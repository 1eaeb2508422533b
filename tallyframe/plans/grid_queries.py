"""The grid of tier configurations over suppliers as genomes: nations are families, regions orders, brands markers."""

from pyspark.sql import functions as F

from tallyframe.operators import grid
from tallyframe.plans.base import query, table

_CONFIGS = grid.config_grid()
_VALUES = ", ".join(str((c.name, c.core, c.shared, c.accessory, c.core_copy, c.shared_copy, c.least_genomes, c.least_markers, c.w_core, c.w_shared, c.w_accessory)) for c in _CONFIGS)
#: Shares of a genome's markers that synthetic samples keep.
_LEVELS = (0.3, 0.6, 0.9)

# regions 0 to 3 have markers; genomes are suppliers, those of region 4 have no order
_SQL = f"""WITH cfg(name, core, shared, accessory, core_copy, shared_copy, least_genomes, least_markers, w1, w2, w3) AS (VALUES {_VALUES}),
gen AS (SELECT s_suppkey AS g, n_regionkey AS ord, s_nationkey AS fam FROM supplier JOIN nation ON s_nationkey = n_nationkey),
cnt AS (SELECT l_suppkey AS g, p_brand AS m, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber <= 2 AND (l_partkey % 25 < 7 OR p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')) GROUP BY ALL),
ref AS (SELECT gen.*, m, n FROM gen JOIN cnt USING (g) WHERE ord < 4),
lev AS (SELECT 'family' AS level, ord, fam, g, m, n FROM ref UNION ALL SELECT 'order', ord, -1, g, m, n FROM ref),
st AS (SELECT level, ord, fam, m, count(*) / any_value(k) AS prev, sum(n) / any_value(k) AS cop FROM lev JOIN (SELECT level, ord, fam, count(DISTINCT g) AS k FROM lev GROUP BY ALL) USING (level, ord, fam) GROUP BY ALL),
sz AS (SELECT ord, fam, count(DISTINCT g) AS k FROM ref GROUP BY ALL),
pm AS (SELECT g, m, row_number() OVER (PARTITION BY g ORDER BY md5(CAST(g AS VARCHAR) || m)) AS i, count(*) OVER (PARTITION BY g) AS n FROM cnt),
smp AS (SELECT 'i' || g AS s, ord, fam, 'isolate' AS kind, NULL AS expected, CAST(g % 101 AS DOUBLE) AS fallback FROM gen UNION ALL SELECT 'y' || l || '_' || g, ord, fam, 'synthetic', l, NULL FROM gen, (VALUES {", ".join(f"({x * 100})" for x in _LEVELS)}) v(l)),
pres AS (SELECT 'i' || g AS s, m FROM cnt UNION ALL SELECT 'y' || l || '_' || g, m FROM pm, (VALUES {", ".join(f"({x * 100})" for x in _LEVELS)}) v(l) WHERE i <= greatest(1, round_even(n * l / 100, 0))),
tier AS (SELECT name, level, ord, fam, m, CASE WHEN prev >= core THEN CASE WHEN cop <= core_copy THEN 1 END WHEN prev >= shared THEN CASE WHEN cop <= shared_copy THEN 2 END WHEN prev >= accessory THEN 3 END AS t FROM st, cfg),
have AS (SELECT name, s, t.level, count(*) FILTER (t = 1) AS n1, count(*) FILTER (t = 2) AS n2, count(*) FILTER (t = 3) AS n3, count(*) FILTER (t = 1 AND p.m IS NOT NULL) AS k1, count(*) FILTER (t = 2 AND p.m IS NOT NULL) AS k2, count(*) FILTER (t = 3 AND p.m IS NOT NULL) AS k3
  FROM smp JOIN tier t ON t.ord = smp.ord AND (t.level = 'order' OR t.fam = smp.fam) LEFT JOIN pres p USING (s, m) GROUP BY ALL),
sc AS (SELECT name, h.s, h.level, n1 + n2 AS inf, CAST(round(CAST(100.0 * coalesce((CASE WHEN n1 > 0 THEN w1 * k1 / n1 ELSE 0 END + CASE WHEN n2 > 0 THEN w2 * k2 / n2 ELSE 0 END + CASE WHEN n3 > 0 THEN w3 * k3 / n3 ELSE 0 END) /
  nullif(CASE WHEN n1 > 0 THEN w1 ELSE 0 END + CASE WHEN n2 > 0 THEN w2 ELSE 0 END + CASE WHEN n3 > 0 THEN w3 ELSE 0 END, 0), 0) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS score,
  CASE WHEN h.level = 'order' THEN 1 WHEN coalesce(sz.k, 0) >= least_genomes AND n1 + n2 >= least_markers THEN 0 END AS o FROM have h JOIN cfg USING (name) JOIN smp ON smp.s = h.s LEFT JOIN sz ON sz.ord = smp.ord AND sz.fam = smp.fam),
one AS (SELECT name AS config, smp.s AS sample, any_value(kind) AS kind, any_value(expected) AS expected, any_value(fallback) AS fallback, arg_min(level, o) AS level, arg_min(inf, o) AS informative, arg_min(sc.score, o) AS score
  FROM cfg CROSS JOIN smp LEFT JOIN (SELECT name AS nm, s, level, inf, score, o FROM sc WHERE o IS NOT NULL) sc ON sc.nm = cfg.name AND sc.s = smp.s GROUP BY ALL)"""


def _inputs(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("order"))
    genomes = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("g"), "order", F.col("s_nationkey").alias("family"))
    items = table(spark, sf, "lineitem").where("l_linenumber <= 2").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    kept = items.where((F.col("l_partkey") % 25 < 7) | F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"))
    counts = kept.groupBy(F.col("l_suppkey").alias("g"), F.col("p_brand").alias("marker")).agg(F.count("*").alias("n"))
    ref = genomes.where("order < 4").join(counts, "g")
    ways = F.array(F.struct(F.lit("family").alias("level"), F.col("family").alias("f")), F.struct(F.lit("order").alias("level"), F.lit(None).cast("int").alias("f")))
    lev = ref.select("order", "g", "marker", "n", F.explode(ways).alias("w")).select(F.col("w.level").alias("level"), "order", F.col("w.f").alias("family"), "g", "marker", "n")
    same = lambda a, b: (F.col(f"{a}.level") == F.col(f"{b}.level")) & (F.col(f"{a}.order") == F.col(f"{b}.order")) & F.col(f"{a}.family").eqNullSafe(F.col(f"{b}.family"))
    size = lev.groupBy("level", "order", "family").agg(F.count_distinct("g").alias("k"))
    stats = lev.groupBy("level", "order", "family", "marker").agg(F.count("*").alias("c"), F.sum("n").alias("n")).alias("a").join(size.alias("b"), same("a", "b"))
    stats = stats.select("a.level", "a.order", "a.family", "marker", (F.col("c") / F.col("k")).alias("prevalence"), (F.col("n") / F.col("k")).alias("copies"))
    sizes = ref.groupBy("order", "family").agg(F.count_distinct("g").alias("genomes"))
    levels = F.explode(F.array(*(F.lit(x * 100) for x in _LEVELS)))
    of = lambda level: F.concat(F.lit("y"), level.cast("string"), F.lit("_"), F.col("g").cast("string"))
    own = F.concat(F.lit("i"), F.col("g").cast("string"))
    isolates = genomes.select(own.alias("sample"), "order", "family", F.lit("isolate").alias("kind"), F.lit(None).cast("double").alias("expected"), (F.col("g") % 101).cast("double").alias("fallback"))
    made = genomes.withColumn("l", levels).select(of(F.col("l")).alias("sample"), "order", "family", F.lit("synthetic").alias("kind"), F.col("l").alias("expected"), F.lit(None).cast("double").alias("fallback"))
    samples = isolates.unionByName(made)
    shuffled = F.array_sort(F.collect_list(F.struct(F.md5(F.concat(F.col("g").cast("string"), "marker").cast("binary")).alias("h"), "marker")))
    lists = counts.groupBy("g").agg(shuffled.alias("ms")).withColumn("l", levels)
    n = F.greatest(F.bround(F.size("ms") * F.col("l") / 100), F.lit(1)).cast("int")
    thinned = lists.select(of(F.col("l")).alias("sample"), F.explode(F.slice("ms", F.lit(1), n)).alias("m")).select("sample", "m.marker")
    return stats, sizes, samples, counts.select(own.alias("sample"), "marker").unionByName(thinned)


@query(f"{_SQL} SELECT config, sample, level, informative, score FROM one")
def grid_scores(spark, sf):
    stats, sizes, samples, present = _inputs(spark, sf)
    return grid.scores(stats, sizes, samples, present, _CONFIGS)


@query(f"""{_SQL}, v AS (SELECT *, CASE WHEN kind = 'isolate' THEN coalesce(score, fallback) ELSE score END AS s FROM one),
a AS (SELECT config, count(*) FILTER (kind = 'isolate') AS n, avg(s) FILTER (kind = 'isolate') AS mean, median(s) FILTER (kind = 'isolate') AS med, count(*) FILTER (kind = 'isolate' AND s >= 90) AS ge, count(*) FILTER (kind = 'isolate' AND s < 50) AS lt,
  avg(abs(100 - s)) FILTER (kind = 'isolate') AS gap, coalesce(avg(abs(expected - s)) FILTER (level IS NOT NULL), 100.0) AS mae, 1 - sum((expected - s) ** 2) FILTER (level IS NOT NULL) / (var_pop(expected) FILTER (level IS NOT NULL) * count(expected) FILTER (level IS NOT NULL)) AS r2,
  count(*) FILTER (kind = 'isolate' AND informative = 0) AS z, count(*) FILTER (kind = 'isolate' AND level = 'family') AS lf, count(*) FILTER (kind = 'isolate' AND level = 'order') AS lo, count(*) FILTER (kind = 'isolate' AND level IS NULL) AS lu FROM v GROUP BY config)
SELECT config, n, CAST(round(CAST(mean AS DECIMAL(18, 9)), 2) AS DOUBLE) AS isolate_mean, CAST(round(CAST(med AS DECIMAL(18, 9)), 2) AS DOUBLE) AS isolate_median, ge AS isolate_ge90, lt AS isolate_lt50, CAST(round(CAST(gap AS DECIMAL(18, 9)), 2) AS DOUBLE) AS isolate_gap, CAST(round(CAST(mae AS DECIMAL(18, 9)), 2) AS DOUBLE) AS synthetic_mae, round(r2, 4) AS synthetic_r2, z AS informative_zero,
  lf AS level_family, lo AS level_order, lu AS level_unavailable, CAST(round(CAST(mae + 0.5 * gap + 0.2 * z AS DECIMAL(18, 9)), 2) AS DOUBLE) AS composite FROM a""")
def grid_evaluation(spark, sf):
    stats, sizes, samples, present = _inputs(spark, sf)
    return grid.evaluation(grid.scores(stats, sizes, samples, present, _CONFIGS), samples.select("sample", "kind", "expected", "fallback"))
