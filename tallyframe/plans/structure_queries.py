"""Trees, graphs, matrices and incremental runs as queries."""

from pyspark.sql import functions as F

from tallyframe.operators import graph, matrix, tree
from tallyframe.operators.staging import tasks_for
from tallyframe.plans.base import query, table
from tallyframe.plans.join_queries import PAIRS, pairs

#: Nodes that one task reads and joins.
NODES_PER_TASK = 50_000

# a heap over parts: node n hangs below n / 2; trees of 127 nodes
_TREE = """edges AS (SELECT CAST((p_partkey - 1) // 127 AS VARCHAR) AS tree, CAST((p_partkey - 1) % 127 + 1 AS INT) AS node, CASE WHEN (p_partkey - 1) % 127 > 0 THEN CAST(((p_partkey - 1) % 127 + 1) // 2 AS INT) END AS parent,
  p_size * 1.0 AS length FROM part), leaves AS (SELECT e.tree, e.node, 'L' || lpad(CAST(e.node AS VARCHAR), 3, '0') AS leaf FROM edges e WHERE NOT EXISTS (SELECT 1 FROM edges c WHERE c.tree = e.tree AND c.parent = e.node)),
up AS (WITH RECURSIVE u AS (SELECT tree, node, node AS ancestor, 0.0::DOUBLE AS dist, parent, length FROM edges UNION ALL
  SELECT u.tree, u.node, e.node, u.dist + u.length, e.parent, e.length FROM u JOIN edges e ON u.tree = e.tree AND u.parent = e.node) SELECT tree, node, ancestor, dist FROM u)"""


def edges(spark, sf):
    at = F.col("p_partkey") - 1
    node = (at % 127 + 1).cast("int")
    parts = table(spark, sf, "part")
    e = parts.select(
        F.expr("cast((p_partkey - 1) div 127 as string)").alias("tree"), node.alias("node"), F.when(at % 127 > 0, F.expr("cast(((p_partkey - 1) % 127 + 1) div 2 as int)")).alias("parent"), (F.col("p_size") * 1.0).cast("double").alias("length")
    )
    e = e.repartition(tasks_for(spark, parts.count(), NODES_PER_TASK), "tree", "node")  # a file of many nodes may be one task's
    inner = e.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct().withColumn("inner", F.lit(True))
    name = F.when(F.col("inner").isNull(), F.concat(F.lit("L"), F.lpad(F.col("node").cast("string"), 3, "0")))
    return e.join(inner.hint("merge"), ["tree", "node"], "left").select("tree", "node", "parent", "length", name.alias("leaf"))


def _sides(spark, sf):
    e = edges(spark, sf)
    leaves = e.where("leaf is not null")
    q = F.col("node") % 5 == 0
    return e, leaves.where(q).select("tree", "leaf"), leaves.where(~q).select("tree", "leaf")


_DIST = f"""{_TREE}, dist AS (SELECT a.tree, x.leaf AS a, y.leaf AS b, min(a.dist + b.dist) AS dist FROM up a JOIN up b ON a.tree = b.tree AND a.ancestor = b.ancestor JOIN leaves x ON x.tree = a.tree AND x.node = a.node
  JOIN leaves y ON y.tree = b.tree AND y.node = b.node WHERE x.node % 5 = 0 AND y.node % 5 <> 0 GROUP BY ALL)"""


@query(f"WITH {_DIST} SELECT tree, a, b, dist FROM dist")
def patristic_distances(spark, sf):
    e, q, r = _sides(spark, sf)
    return tree.patristic(e, q, r)


@query(f"WITH {_DIST} SELECT tree, a, b, dist FROM (SELECT *, row_number() OVER (PARTITION BY tree, a ORDER BY dist, b) AS k FROM dist) WHERE k = 1")
def nearest_reference(spark, sf):
    e, q, r = _sides(spark, sf)
    return tree.nearest_below(e, q, r, tree.ancestors(e))


@query(f"""WITH {_DIST}, g AS (SELECT *, substr(b, 4, 1) AS genome FROM dist), o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree, a, genome ORDER BY dist, b) AS k FROM g) WHERE k = 1)
SELECT tree, a, genome, b, dist, rank FROM (SELECT tree, a, genome, b, dist, CAST(row_number() OVER (PARTITION BY tree, a ORDER BY dist, genome) AS INT) AS rank FROM o) WHERE rank <= 3""")
def nearest_genomes_in_tree(spark, sf):
    e, q, r = _sides(spark, sf)
    return tree.nearest_genomes(tree.patristic(e, q, r).withColumn("genome", F.substring("b", 4, 1)), "genome", 3)


@query(f"""WITH {_TREE}, und AS (SELECT up.tree, ancestor AS node, bool_and(l.node % 3 > 0) AS pure, string_agg(leaf, ';' ORDER BY leaf) AS members, CAST(count(*) AS INT) AS size FROM up JOIN leaves l ON up.tree = l.tree AND up.node = l.node GROUP BY ALL)
SELECT e.tree, e.node, u.members, u.size FROM edges e JOIN und u ON e.tree = u.tree AND e.node = u.node LEFT JOIN und p ON p.tree = e.tree AND p.node = e.parent WHERE u.pure AND NOT coalesce(p.pure, false)""")
def query_only_clades(spark, sf):
    e = edges(spark, sf)
    return tree.query_clades(e, e.where("leaf is not null and node % 3 > 0").select("tree", "leaf"))


@query(f"""WITH {_TREE}, und AS (SELECT up.tree, ancestor AS node, bool_and(l.node % 3 > 0) AS pure FROM up JOIN leaves l ON up.tree = l.tree AND up.node = l.node GROUP BY ALL),
top AS (SELECT e.tree, e.node FROM edges e JOIN und u ON e.tree = u.tree AND e.node = u.node LEFT JOIN und p ON p.tree = e.tree AND p.node = e.parent WHERE u.pure AND NOT coalesce(p.pure, false)),
mem AS (SELECT t.tree, t.node, l.node AS at FROM top t JOIN up ON up.tree = t.tree AND up.ancestor = t.node JOIN leaves l ON l.tree = up.tree AND l.node = up.node),
d AS (SELECT x.tree, x.node, x.at, y.at, min(ux.dist + uy.dist) AS dist FROM mem x JOIN mem y ON x.tree = y.tree AND x.node = y.node AND x.at < y.at JOIN up ux ON ux.tree = x.tree AND ux.node = x.at
  JOIN up uy ON uy.tree = y.tree AND uy.node = y.at AND uy.ancestor = ux.ancestor GROUP BY ALL)
SELECT t.tree, t.node, coalesce(avg(dist), 0.0) AS mean_dist, count(dist) AS pairs FROM top t LEFT JOIN d ON d.tree = t.tree AND d.node = t.node GROUP BY ALL""")
def mean_pairwise_distance(spark, sf):
    e = edges(spark, sf)
    return tree.clade_spread(e, e.where("leaf is not null and node % 3 > 0").select("tree", "leaf"))


# queries here: leaves whose node's number has the remainder 0 or 1 by 5; references' labels: the part's brand, for even nodes
_PLACED = f"""{_TREE}, ref AS (SELECT tree, node, leaf FROM leaves WHERE node % 5 > 1), qry AS (SELECT tree, node, leaf FROM leaves WHERE node % 5 <= 1),
pd AS (SELECT a.tree, a.node AS x, b.node AS y, min(a.dist + b.dist) AS dist FROM up a JOIN up b ON a.tree = b.tree AND a.ancestor = b.ancestor
  JOIN leaves l ON l.tree = a.tree AND l.node = a.node JOIN leaves m ON m.tree = b.tree AND m.node = b.node WHERE l.node % 5 <= 1 GROUP BY ALL),
og AS (SELECT tree, arg_min(node, leaf) AS node FROM ref GROUP BY tree),
-- clades on the tree rooted at the outgroup: of each edge the side without it
og_up AS (SELECT og.tree, up.ancestor AS node FROM og JOIN up ON up.tree = og.tree AND up.node = og.node),
sides AS (SELECT e.tree, e.node AS edge, l.node AS leaf FROM edges e JOIN og USING (tree) JOIN leaves l ON l.tree = e.tree LEFT JOIN og_up o ON o.tree = e.tree AND o.node = e.node
  LEFT JOIN up u ON u.tree = e.tree AND u.node = l.node AND u.ancestor = e.node WHERE e.parent IS NOT NULL AND ((o.node IS NULL) = (u.node IS NOT NULL))),
pure AS (SELECT tree, edge, count(*) AS n FROM sides GROUP BY ALL HAVING bool_and(leaf % 5 <= 1)),
own AS (SELECT s.tree, s.leaf, max(p.n) AS size FROM sides s JOIN pure p ON p.tree = s.tree AND p.edge = s.edge GROUP BY ALL),
mem AS (SELECT DISTINCT o.tree, o.leaf, o.size, s2.leaf AS other FROM own o JOIN sides s ON s.tree = o.tree AND s.leaf = o.leaf JOIN pure p ON p.tree = s.tree AND p.edge = s.edge AND p.n = o.size
  JOIN sides s2 ON s2.tree = s.tree AND s2.edge = s.edge),
cl AS (SELECT m.tree, m.leaf, m.size, min(l.leaf) AS clade_id, string_agg(l.leaf, ';' ORDER BY l.leaf) AS names FROM mem m JOIN leaves l ON l.tree = m.tree AND l.node = m.other GROUP BY ALL),
nn AS (SELECT m.tree, m.leaf, arg_min({{'name': r.leaf, 'node': r.node, 'dist': pd.dist}}, {{'k': round(pd.dist, 9), 'n': r.leaf}}) AS b FROM mem m JOIN pd ON pd.tree = m.tree AND pd.x = m.other JOIN ref r ON r.tree = pd.tree AND r.node = pd.y GROUP BY ALL),
sp AS (SELECT m.tree, m.leaf, avg(pd.dist) AS mean FROM mem m JOIN mem k ON k.tree = m.tree AND k.leaf = m.leaf AND m.other < k.other JOIN pd ON pd.tree = m.tree AND pd.x = m.other AND pd.y = k.other GROUP BY ALL)"""


@query(f"""WITH {_PLACED} SELECT cl.tree, q.leaf AS query, nn.b.name AS nn_genome, coalesce('d_' || p_brand, 'unknown') AS nn_taxonomy, pd.dist AS nn_distance, CASE WHEN size > 1 THEN clade_id ELSE '' END AS clade_id,
  CASE WHEN size > 1 THEN names ELSE '' END AS clade_members, CASE WHEN size > 1 THEN sp.mean END AS clade_mean_dist, CASE WHEN size > 1 THEN nn.b.dist END AS clade_ref_dist
FROM cl JOIN qry q ON q.tree = cl.tree AND q.node = cl.leaf JOIN nn ON nn.tree = cl.tree AND nn.leaf = cl.leaf JOIN pd ON pd.tree = cl.tree AND pd.x = cl.leaf AND pd.y = nn.b.node
LEFT JOIN sp ON sp.tree = cl.tree AND sp.leaf = cl.leaf LEFT JOIN (SELECT 'L' || lpad(CAST(p_partkey AS VARCHAR), 3, '0') AS leaf, p_brand FROM part WHERE p_partkey % 2 = 0 AND p_partkey < 127) lab ON lab.leaf = nn.b.name""")
def species_placements(spark, sf):
    e = edges(spark, sf)
    p = table(spark, sf, "part").where("p_partkey % 2 = 0 and p_partkey < 127")
    labels = p.select(F.concat(F.lit("L"), F.lpad(F.col("p_partkey").cast("string"), 3, "0")).alias("leaf"), F.concat(F.lit("d_"), "p_brand").alias("taxonomy"))
    return tree.placements(e, e.where("leaf is not null and node % 5 <= 1").select("tree", "leaf"), labels)


@query(f"""WITH {_TREE}, og AS (SELECT tree, arg_min(node, leaf) AS node FROM leaves WHERE node % 5 > 1 GROUP BY tree), path AS (SELECT up.tree, up.ancestor AS node, e.parent, e.length,
    row_number() OVER (PARTITION BY up.tree ORDER BY up.ancestor DESC) - 1 AS h FROM og JOIN up USING (tree, node) JOIN edges e ON e.tree = up.tree AND e.node = up.ancestor),
big AS (SELECT tree, max(node) + 1 AS new FROM edges GROUP BY tree),
turned AS (SELECT p.tree, p.node, CASE WHEN p.h <= 1 THEN new ELSE b.node END AS parent, CASE WHEN p.h <= 1 THEN o.length / 2 ELSE b.length END AS length FROM path p JOIN big USING (tree) JOIN path o ON o.tree = p.tree AND o.h = 0
    LEFT JOIN path b ON b.tree = p.tree AND b.h = p.h - 1),
joined AS (SELECT tree, node, parent, length FROM turned UNION ALL SELECT tree, new, NULL, 0.0 FROM big JOIN og USING (tree) UNION ALL SELECT tree, node, parent, length FROM edges WHERE (tree, node) NOT IN (SELECT (tree, node) FROM path)),
-- old roots are the nodes 1
lone AS (SELECT j.tree, 1 AS node, count(*) AS n FROM joined j JOIN og USING (tree) WHERE j.parent = 1 GROUP BY j.tree HAVING count(*) = 1), gone AS (SELECT j.* FROM joined j JOIN lone USING (tree, node))
SELECT j.tree, j.node, CAST(coalesce(g.parent, j.parent) AS INT) AS parent, j.length + coalesce(g.length, 0.0) AS length, l.leaf FROM joined j LEFT JOIN gone g ON g.tree = j.tree AND g.node = j.parent
LEFT JOIN leaves l ON l.tree = j.tree AND l.node = j.node WHERE (j.tree, j.node) NOT IN (SELECT (tree, node) FROM gone)""")
def rerooted_trees(spark, sf):
    e = edges(spark, sf)
    return tree.rerooted(e, e.where("leaf is not null and node % 5 > 1").groupBy("tree").agg(F.min("leaf").alias("leaf")))


@query(f"""WITH {PAIRS}, ed AS (SELECT a, b FROM pairs WHERE overlap >= 0.02 AND shared >= 12), bi AS (SELECT a, b FROM ed UNION SELECT b, a FROM ed),
reach AS (WITH RECURSIVE r AS (SELECT a AS node, a AS seen, 0 AS d FROM bi UNION SELECT r.node, bi.b, r.d + 1 FROM r JOIN bi ON r.seen = bi.a WHERE r.d < 8) SELECT * FROM r)
SELECT node, min(seen) AS component FROM reach GROUP BY node""")
def overlap_components(spark, sf):
    return graph.overlap_groups(pairs(spark, sf), 0.02, 12)


@query("""WITH g AS (SELECT p_partkey AS node, p_size AS component FROM part WHERE p_partkey % 9 <> 0), n AS (SELECT component, note, count(*) AS n FROM (SELECT component, CASE WHEN node % 4 > 0 THEN p_type END AS note FROM g JOIN part ON node = p_partkey) WHERE note IS NOT NULL GROUP BY ALL),
t AS (SELECT component, note, n FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY n DESC, note) AS k FROM n) WHERE k = 1), s AS (SELECT component, count(*) AS n_members, count(*) FILTER (node % 4 > 0) AS annotated FROM g GROUP BY ALL)
SELECT component, n_members, annotated, coalesce(n / nullif(annotated, 0), 0.0) AS coherence, note AS dominant, CASE WHEN annotated = 0 THEN 'no_annotation' WHEN annotated >= 3 AND coalesce(n / nullif(annotated, 0), 0) < 0.6 THEN 'REVIEW_mixed' ELSE 'ok' END AS flag
FROM s LEFT JOIN t USING (component)""")
def group_annotation(spark, sf):
    p = table(spark, sf, "part")
    groups = graph.curate(p.select(F.col("p_partkey").alias("node"), F.col("p_size").alias("component")), drop=p.where("p_partkey % 9 = 0").select(F.col("p_partkey").alias("node")))
    notes = p.where("p_partkey % 4 > 0").select(F.col("p_partkey").alias("node"), F.col("p_type").alias("note"))
    return graph.group_flags(groups, notes)


# alignments: the last four digits of a customer's order keys, by segment
_ALN = """aln AS (SELECT o_orderstatus AS grp, CAST(o_custkey % 40 AS INT) AS taxon, max(translate(lpad(CAST(o_orderkey AS VARCHAR), 8, '0'), '07', '--')) AS s FROM orders GROUP BY ALL)"""


def _aligned(spark, sf):
    s = F.translate(F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), "07", "--")
    return table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("grp"), (F.col("o_custkey") % 40).cast("int").alias("taxon")).agg(F.max(s).alias("s"))


@query(f"""WITH {_ALN}, site AS (SELECT grp, taxon, i, substr(s, CAST(i AS INT), 1) AS c FROM aln, range(1, 9) t(i)), keep AS (SELECT grp, i FROM site GROUP BY ALL HAVING count(*) FILTER (c = '-') <= 0.5 * count(*))
SELECT grp, taxon, coalesce(string_agg(c, '' ORDER BY i) FILTER (keep.i IS NOT NULL), '') AS s FROM site LEFT JOIN keep USING (grp, i) GROUP BY ALL""")
def trimmed_alignment(spark, sf):
    return matrix.trim_sites(_aligned(spark, sf), "grp", "taxon", "s", 0.5)


@query(f"""WITH {_ALN}, g AS (SELECT DISTINCT grp FROM aln), t AS (SELECT DISTINCT taxon FROM aln) SELECT taxon, string_agg(coalesce(s, '--------'), '' ORDER BY grp) AS s FROM t CROSS JOIN g LEFT JOIN aln USING (taxon, grp) GROUP BY taxon""")
def supermatrix(spark, sf):
    return matrix.supermatrix(_aligned(spark, sf), "taxon", "grp", "s")


@query(f"""WITH {_ALN} SELECT grp, CAST(8 AS INT) AS width, CAST(row_number() OVER (ORDER BY grp) * 8 - 7 AS BIGINT) AS start, CAST(row_number() OVER (ORDER BY grp) * 8 AS BIGINT) AS stop FROM (SELECT DISTINCT grp FROM aln)""")
def matrix_partitions(spark, sf):
    return matrix.partitions(_aligned(spark, sf), "grp", "s")
