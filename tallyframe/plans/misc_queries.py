"""Rewritten names, capsid types, baselines, splits and unions."""

from pyspark.sql import functions as F

from tallyframe.functions import scalars
from tallyframe.operators import aggregate, graph, joins, ml, rank, rewrite, sets, vote
from tallyframe.plans.base import HITS, PLACEMENTS, hits, placements, query, table

# names in five forms; every third part has an alias, by its name, its name with a contig, or its name before the bar
_NAMES = """ids AS (SELECT p_brand AS file, CASE p_partkey % 5 WHEN 0 THEN 'V__' || p_partkey || '_7' WHEN 1 THEN 'V__' || p_partkey || '|c_2_9' WHEN 2 THEN 'V__' || p_partkey WHEN 3 THEN 'V__' || p_partkey || '|x' ELSE 'V__' || p_partkey || '_a_3' END AS id, p_partkey AS k FROM part),
al AS (SELECT 'V__' || p_partkey || CASE p_partkey % 4 WHEN 1 THEN '_c_2' WHEN 3 THEN '_a' ELSE '' END AS alias, CASE WHEN p_partkey % 9 = 0 THEN 'V__' || p_partkey ELSE 'W__' || p_partkey END AS canonical FROM part WHERE p_partkey % 3 = 0),
ex AS (SELECT 'V__' || p_partkey AS label FROM part WHERE p_partkey % 7 = 0),
cand AS (SELECT id, k, unnest([id, regexp_replace(id, '_[0-9]+$', ''), CASE WHEN contains(id, '|') THEN split_part(id, '|', 1) END, CASE WHEN contains(id, '|') THEN split_part(id, '|', 1) || '_' || regexp_replace(split_part(id, '|', 2), '_[^_]*$', '') END]) AS c, unnest([1, 2, 3, 4]) AS pos FROM ids),
hit AS (SELECT id, arg_min({'new': n, 'source': c, 'target': canonical}, pos) AS r FROM (SELECT *, CASE WHEN contains(id, '|') THEN canonical || '|' || split_part(id, '|', 2) WHEN starts_with(id, c) THEN canonical || substr(id, length(c) + 1) END AS n FROM cand JOIN al ON c = alias) WHERE n IS NOT NULL AND n <> id GROUP BY id),
gone AS (SELECT id, arg_min(c, pos) AS source FROM cand JOIN ex ON c = label GROUP BY id),
done AS (SELECT file, ids.id, CASE WHEN gone.id IS NOT NULL THEN NULL ELSE coalesce(r.new, ids.id) END AS new_id, CASE WHEN gone.id IS NOT NULL THEN 'dropped_excluded_label' WHEN r IS NOT NULL THEN 'alias_rewrite' ELSE '' END AS reason,
  CASE WHEN gone.id IS NOT NULL THEN gone.source ELSE r.source END AS source, CASE WHEN gone.id IS NULL THEN r.target END AS target FROM ids LEFT JOIN hit ON hit.id = ids.id LEFT JOIN gone ON gone.id = ids.id)"""


def _rewritten(spark, sf):
    p = table(spark, sf, "part")
    k, v = F.col("p_partkey"), F.concat(F.lit("V__"), F.col("p_partkey").cast("string"))
    tail = F.when(k % 5 == 0, "_7").when(k % 5 == 1, "|c_2_9").when(k % 5 == 2, "").when(k % 5 == 3, "|x").otherwise("_a_3")
    headers = p.select(F.col("p_brand").alias("file"), F.concat(v, tail).alias("id"))
    aliases = p.where("p_partkey % 3 = 0").select(F.concat(v, F.when(k % 4 == 1, "_c_2").when(k % 4 == 3, "_a").otherwise("")).alias("alias"), F.when(k % 9 == 0, v).otherwise(F.concat(F.lit("W__"), k.cast("string"))).alias("canonical"))
    return rewrite.rewritten(headers, aliases, p.where("p_partkey % 7 = 0").select(v.alias("label")))


@query(f"WITH {_NAMES} SELECT file, id, new_id, reason, source, target FROM done")
def rewritten_names(spark, sf):
    return _rewritten(spark, sf)


@query(f"WITH {_NAMES} SELECT file, count(*) AS seen, count(*) FILTER (reason = 'alias_rewrite') AS rewritten, count(*) FILTER (reason = 'dropped_excluded_label') AS dropped FROM done GROUP BY file")
def rewrite_totals(spark, sf):
    return rewrite.rewrite_totals(_rewritten(spark, sf), ["file"])


@query(f"""WITH {PLACEMENTS}, n AS (SELECT query, marker, protein, arg_min({{'f': r3, 'p': r1, 'd': distance}}, {{'d': distance, 'n': neighbor, 'f': r3, 'p': r1}}) AS x FROM placements WHERE marker IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4') GROUP BY ALL),
t AS (SELECT query, protein, x.d AS d, CASE WHEN x.f IN ('BUILDING', 'MACHINERY') THEN x.f WHEN x.p IN ('ASIA', 'EUROPE') THEN x.p END AS t FROM n), e AS (SELECT query, protein, d, min(t) AS t, count(DISTINCT t) AS k FROM t WHERE t IS NOT NULL GROUP BY ALL),
o AS (SELECT query, protein, arg_min({{'t': t, 'k': k}}, d) AS m FROM e GROUP BY ALL), c AS (SELECT query, m.t AS t, count(*) AS n FROM o WHERE m.k = 1 GROUP BY ALL)
SELECT query, string_agg(t || ':' || n, ',' ORDER BY n DESC, t) AS tally FROM c GROUP BY query""")
def capsid_types(spark, sf):
    rows = placements(spark, sf).where(F.col("marker").isin("Brand#1", "Brand#2", "Brand#3", "Brand#4"))
    return vote.capsid_tally(rows, "query", "marker", "protein", "neighbor", "distance", "r3", "r1", ["BUILDING", "MACHINERY"], ["ASIA", "EUROPE"])


@query(f"""WITH {PLACEMENTS}, c AS (SELECT query, marker, r1, count(*) AS n FROM placements GROUP BY ALL), t AS (SELECT query, marker, arg_min(r1, {{'o': -n, 'v': r1}}) AS r1, max(n) AS top, sum(n) AS total FROM c GROUP BY ALL) SELECT query, marker, r1 FROM t WHERE top * 2 >= total""")
def half_consensus(spark, sf):
    return vote.half_consensus(placements(spark, sf), ["query", "marker"], "r1")


@query("""SELECT s_nationkey, CAST(round(CAST(avg(s_acctbal) AS DECIMAL(28, 9)), 4) AS DOUBLE) AS baseline_mean, CAST(round(CAST(median(s_acctbal) AS DECIMAL(28, 9)), 4) AS DOUBLE) AS baseline_median, count(*) AS n_refs FROM supplier GROUP BY s_nationkey""")
def group_baselines(spark, sf):
    return aggregate.baselines(table(spark, sf, "supplier"), ["s_nationkey"], "s_acctbal")


@query("""SELECT c_custkey, coalesce(avg(CAST(round(o_totalprice) AS BIGINT)), 0.0) AS mean FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY c_custkey""")
def mean_or_zero(spark, sf):
    rows = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), F.round("o_totalprice").cast("long").alias("v"))
    return aggregate.mean_or_zero(rows, table(spark, sf, "customer"), ["c_custkey"], "v")


@query("""SELECT l_returnflag, l_linestatus, CAST(round(CAST(avg(l_quantity) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS l_quantity, CAST(round(CAST(avg(l_linenumber) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS l_linenumber FROM lineitem GROUP BY ALL""")
def scenario_means(spark, sf):
    return aggregate.means(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity", "l_linenumber"])


@query("""SELECT s AS l_suppkey, arg_min(c, {'o': -n, 'c': c}) AS contig, CAST(max(n) AS BIGINT) AS n FROM (SELECT l_suppkey AS s, l_orderkey % 50 AS c, sum(CAST(l_quantity AS BIGINT)) AS n FROM lineitem GROUP BY ALL) GROUP BY s""")
def largest_contig(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_suppkey", (F.col("l_orderkey") % 50).alias("contig"), F.col("l_quantity").cast("long").alias("n"))
    return aggregate.largest(rows, ["l_suppkey"], "contig", "n")


@query("""SELECT p_partkey, share, CAST(greatest(2000, round_even(p_size * 1000 * share / (1 - share), 0)) AS BIGINT) AS n FROM part, (VALUES (0.05::DOUBLE), (0.1::DOUBLE), (0.25::DOUBLE)) v(share)""")
def foreign_sizes(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", F.explode(F.array(F.lit(0.05), F.lit(0.1), F.lit(0.25))).alias("share"))
    return p.select("p_partkey", "share", aggregate.foreign_size(F.col("p_size") * 1000, F.col("share")).alias("n"))


@query(f"""WITH {HITS}, g AS (SELECT DISTINCT p_brand AS model, 'g' || CAST(substr(p_brand, 7) AS INT) % 6 AS grp FROM part WHERE CAST(substr(p_brand, 7) AS INT) % 6 < 3) SELECT DISTINCT query, coalesce(grp, model) AS model, protein FROM hits LEFT JOIN g USING (model)""")
def collapsed_models(spark, sf):
    number = F.substring("p_brand", 7, 9).cast("int") % 6
    groups = table(spark, sf, "part").where(number < 3).select(F.col("p_brand").alias("model"), F.concat(F.lit("g"), number.cast("string")).alias("group")).distinct()
    return sets.collapsed(hits(spark, sf), ["query"], "model", "protein", groups)


# queries' sequences come first, then references' files in order
@query("""WITH a AS (SELECT 0 AS source, c_name AS name, c_custkey AS place, c_mktsegment AS seq FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 1, c_name, c_custkey, 'second' FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 1, 'Customer#000000002', 999999, 'late'
  UNION ALL SELECT 2, s_name, s_suppkey, 'other' FROM supplier) SELECT name, source, place, seq FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY source, place, seq) AS k FROM a) WHERE k = 1""")
def first_of_union(spark, sf):
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    late = spark.createDataFrame([("Customer#000000002", 999_999, "late")], "name string, place long, seq string")
    second = c.where("c_custkey % 2 = 0").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("place"), F.lit("second").alias("seq"))
    return sets.first_of_union(
        [c.where("c_custkey % 3 = 0").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("place"), F.col("c_mktsegment").alias("seq")), second.unionByName(late), s.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("place"), F.lit("other").alias("seq"))],
        "name", "place",
    )


@query("""SELECT o_custkey, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM (SELECT o_custkey, list_transform(list(o_orderpriority ORDER BY o_orderkey, o_orderpriority), lambda p: CASE p WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' ELSE p END) AS l FROM orders GROUP BY o_custkey)""")
def ordered_names(spark, sf):
    mapping = F.create_map(F.lit("1-URGENT"), F.lit("high"), F.lit("2-HIGH"), F.lit("high"))
    lists = table(spark, sf, "orders").groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))), lambda x: x["o_orderpriority"]).alias("l"))
    return lists.select("o_custkey", sets.ordered_unique(F.col("l"), mapping).alias("l"))


# groups are parts of one size; those with part 3 go, those with part 5 or 8 are split by their brand's remainder, every ninth part is dropped
@query("""WITH g AS (SELECT p_partkey AS node, p_size AS component, CAST(substr(p_brand, 7) AS INT) % 3 AS piece FROM part), gone AS (SELECT DISTINCT component FROM g WHERE node = 3), o AS (SELECT * FROM g WHERE component NOT IN (SELECT component FROM gone)),
sp AS (SELECT component, min(node) AS seed FROM o WHERE node IN (5, 8) GROUP BY component), f AS (SELECT DISTINCT component FROM g WHERE node % 40 = 0),
a AS (SELECT node, component || '/' || piece AS component, false AS forced FROM o JOIN sp USING (component) WHERE piece < 2 UNION ALL SELECT node, CAST(component AS VARCHAR), component IN (SELECT component FROM f) FROM o WHERE component NOT IN (SELECT component FROM sp) AND node % 9 > 0)
SELECT node, component, forced FROM a WHERE component IN (SELECT component FROM a GROUP BY component HAVING count(*) >= 2)""")
def recut_groups(spark, sf):
    p = table(spark, sf, "part")
    groups = p.select(F.col("p_partkey").alias("node"), F.col("p_size").alias("component"))
    piece = F.substring("p_brand", 7, 9).cast("int") % 3
    pieces = p.where(piece < 2).select(F.explode(F.array(F.lit(5).cast("long"), F.lit(8).cast("long"))).alias("seed"), piece.alias("piece"), F.col("p_partkey").alias("node"))
    return graph.recut(groups, groups.where("node % 9 = 0"), groups.where("node = 3"), pieces, groups.where("node % 40 = 0"))


@query("""WITH n AS (SELECT c_custkey, 'complete' AS status, 'new' AS run FROM customer WHERE c_custkey % 5 = 0), o AS (SELECT c_custkey, 'complete' AS status, 'old' AS run FROM customer WHERE c_custkey % 3 = 0)
SELECT * FROM n UNION ALL SELECT * FROM o WHERE c_custkey NOT IN (SELECT c_custkey FROM n) UNION ALL SELECT c_custkey, 'missing_summary', NULL FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 5 > 0 AND c_custkey % 3 > 0""")
def combined_runs(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    run = lambda n, name: c.where(f"c_custkey % {n} = 0").select("c_custkey", F.lit("complete").alias("status"), F.lit(name).alias("run"))
    return joins.combined_runs(c.where("c_custkey % 2 = 0"), run(3, "old"), run(5, "new"), "c_custkey")


_MARKERS = ["Brand#1", "Brand#2", "Brand#77"]


@query("""WITH c AS (SELECT n_regionkey AS grp, p_brand AS marker, l_suppkey AS genome, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_quantity >= 45 GROUP BY ALL),
g AS (SELECT grp, count(DISTINCT genome) AS n_genomes FROM c GROUP BY grp), v(marker) AS (VALUES ('Brand#1'), ('Brand#2'), ('Brand#77'))
SELECT grp, marker, n_genomes, count(DISTINCT genome) AS with_marker, CAST(coalesce(sum(n), 0) AS BIGINT) AS copies, coalesce(sum(n), 0) / n_genomes AS mean_copy FROM g CROSS JOIN v LEFT JOIN c USING (grp, marker) GROUP BY grp, marker, n_genomes""")
def prevalence_of_listed(spark, sf):
    items = table(spark, sf, "lineitem").where("l_quantity >= 45").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    placed = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").alias("grp"))
    counts = items.join(placed, "l_suppkey").groupBy("grp", F.col("p_brand").alias("marker"), F.col("l_suppkey").alias("genome")).agg(F.count("*").alias("n"))
    return aggregate.prevalence(counts, "grp", "marker", "genome", "n", _MARKERS)


@query(f"""WITH {HITS} SELECT query, coalesce(max(seq_score) FILTER (model = 'Brand#1'), 0) AS Brand_1, coalesce(max(seq_score) FILTER (model = 'Brand#2'), 0) AS Brand_2, coalesce(max(seq_score) FILTER (model = 'Brand#77'), 0) AS Brand_77 FROM hits GROUP BY query""")
def best_score_pivot(spark, sf):
    return aggregate.pivot_best(hits(spark, sf), "query", "model", _MARKERS, "seq_score")


@query("""WITH c AS (SELECT source, count(*) AS contigs, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS bases, sum(length(coalesce(text, '')) - length(translate(coalesce(text, ''), 'GCgc', ''))) AS gc FROM documents GROUP BY source),
g AS (SELECT source, count(*) AS genes, sum(n_chars // 2) AS coding FROM documents WHERE doc_id % 3 > 0 AND source <> 'src5' GROUP BY source)
SELECT source, contigs, bases, CAST(round(CAST(coalesce(gc * 100.0 / nullif(bases, 0), 0) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS gc_percent, coalesce(genes, 0) AS genes, CAST(round(CAST(coalesce(coalesce(coding, 0) * 100.0 / nullif(bases, 0), 0) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS coding_percent FROM c LEFT JOIN g USING (source)""")
def assembly_statistics(spark, sf):
    docs = table(spark, sf, "documents")
    genes = docs.where("doc_id % 3 > 0 and source <> 'src5'").select("source", F.expr("n_chars div 2").alias("n"))
    return aggregate.assembly_stats(docs, genes, ["source"], "text", "n")


# hits, score and density of a supplier's line numbers; density counts to the whole hundred
@query("""WITH c AS (SELECT l_suppkey AS q, l_linenumber AS code, CAST(count(*) % 4 AS BIGINT) AS hits, round(avg(l_tax) * 10, 0) AS density FROM lineitem GROUP BY ALL), b AS (SELECT q, hits AS h, density AS d FROM c WHERE code = 1),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY hits DESC, density DESC, list_position([3, 2, 4, 5, 6, 7], code)) AS k FROM c WHERE code <> 1) WHERE k = 1)
SELECT b.q, CAST(CASE WHEN l.hits > h OR (l.hits = h AND l.density > d) THEN l.code ELSE 1 END AS INT) AS code FROM b LEFT JOIN l ON l.q = b.q""")
def code_choice_rounded(spark, sf):
    stats = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("q"), F.col("l_linenumber").alias("code")).agg((F.count("*") % 4).alias("hits"), (F.avg("l_tax") * 10).alias("density"))
    wins = (F.col("hits") > F.col("hits_base")) | ((F.col("hits") == F.col("hits_base")) & (F.col("density") > F.col("density_base")))
    return rank.override_baseline(stats, "q", "code", ["hits", "density"], 1, wins, [3, 2, 4, 5, 6, 7], {"density": 0})


@query("""WITH p AS (SELECT p_partkey AS k, p_brand AS b, p_type AS t, p_name AS n FROM part)
SELECT k, CASE WHEN k % 3 > 0 THEN b || '__' || t ELSE t END AS taxon, replace(n, 'r', '-') AS gaps, CASE WHEN k % 2 = 0 THEN k || '.1' END AS accession, CASE WHEN k % 4 = 0 THEN n ELSE printf('%d.50', k) END AS cell, [b, t, '', ''] AS padded, b AS attribute,
  CASE k % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'v' || k WHEN 2 THEN 'not installed' WHEN 3 THEN 'v1.2' ELSE 'dev' END AS label, CASE k % 3 WHEN 0 THEN 'ncldv_euk_pev_e' WHEN 1 THEN 'refs' ELSE lower(replace(b, '#', '_')) END AS slug, CASE WHEN k % 2 = 0 THEN b ELSE coalesce(nullif(CASE WHEN k % 3 = 0 THEN n ELSE ' ' END, ' '), t) END AS setting,
  'QUERY__' || n AS spaced, n AS bare, CASE WHEN k % 6 = 0 THEN [1, 20, 3] END AS version FROM p""")
def text_helpers(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    s, text = scalars, k.cast("string")
    version = F.when(k % 5 == 0, "").when(k % 5 == 1, text).when(k % 5 == 2, "Not Installed").when(k % 5 == 3, " v1.2 ").otherwise("dev")
    prefixes = F.when(k % 3 == 0, F.array(F.lit("NCLDV__"), F.lit("EUK-pEV/E__"))).when(k % 3 == 1, F.array(F.lit("__"))).otherwise(F.array("p_brand"))
    return p.select(
        k.alias("k"), s.taxon_key(F.when(k % 3 > 0, F.col("p_brand")).otherwise(""), F.col("p_type")).alias("taxon"), s.stops_as_gaps(F.replace("p_name", F.lit("r"), F.lit("*"))).alias("gaps"),
        s.accession(F.concat(F.lit("x GCA_"), text, F.when(k % 2 == 0, F.lit("-1")).otherwise(F.lit("")))).alias("accession"), s.only_numeric(F.when(k % 4 == 0, F.col("p_name")).otherwise(F.concat(text, F.lit(".499999"))), 2).alias("cell"),
        s.padded_lineage(F.concat_ws("|", "p_brand", "p_type"), ranks=4).alias("padded"), s.attributes(F.concat(F.lit("ID="), "p_brand", F.lit(";x=1;")))["ID"].alias("attribute"), s.version_label(version).alias("label"), s.prefix_slug(prefixes).alias("slug"),
        s.first_given(F.when(k % 2 == 0, F.col("p_brand")), F.when(k % 3 == 0, F.col("p_name")).otherwise(" "), F.col("p_type")).alias("setting"), rewrite.namespaced(F.col("p_name"), F.lit(True)).alias("spaced"),
        rewrite.without_namespace(rewrite.namespaced(F.col("p_name"), k % 2 == 0)).alias("bare"), s.version_parts(F.when(k % 6 == 0, "v1.20.3").otherwise("1.x")).alias("version"),
    )


@query("""WITH t AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%dT%H%M%S') AS run, lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS a, translate(lpad(CAST(o_custkey AS VARCHAR), 8, '0'), '7', '-') AS b FROM orders),
c AS (SELECT k, run, count(*) FILTER (x <> '-' AND y <> '-' AND x = y) AS matches, count(*) FILTER (x <> '-' AND y <> '-' AND x <> y) AS mismatches, count(*) FILTER (x = '-' OR y = '-') AS gaps FROM (SELECT k, run, unnest(string_split(a, '')) AS x, unnest(string_split(b, '')) AS y FROM t) GROUP BY ALL) SELECT * FROM c""")
def alignment_identity(spark, sf):
    o = table(spark, sf, "orders")
    found = scalars.identity(F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.translate(F.lpad(F.col("o_custkey").cast("string"), 8, "0"), "7", "-"))
    return o.select(F.col("o_orderkey").alias("k"), scalars.run_id(F.col("o_orderdate")).alias("run"), found.alias("f")).select("k", "run", "f.matches", "f.mismatches", "f.gaps")


@query("""SELECT p_brand, string_agg(p_name, 'TTAATTAATTAA' ORDER BY p_partkey) || CASE WHEN count(*) > 1 THEN 'TTAATTAATTAA' ELSE '' END AS text FROM part WHERE p_size > 25 GROUP BY p_brand""")
def training_texts(spark, sf):
    lists = table(spark, sf, "part").where("p_size > 25").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))).alias("l"))
    return lists.select("p_brand", scalars.training_text(F.col("l.p_name")).alias("text"))


@query("""WITH s AS (SELECT DISTINCT l_suppkey AS k, p_brand AS m FROM lineitem JOIN part ON l_partkey = p_partkey), g AS (SELECT s.*, level, rep, count(*) OVER (PARTITION BY k, level, rep) AS n, row_number() OVER (PARTITION BY k, level, rep ORDER BY md5('42:' || k || ':' || level || ':' || rep || ':' || m), m) AS i
  FROM s, (VALUES (0.25::DOUBLE), (0.5::DOUBLE)) a(level), (VALUES (0), (1)) b(rep)) SELECT k, level, rep AS repeat, m FROM g WHERE i <= greatest(round_even(n * level, 0), 1)""")
def simulated_subsets(spark, sf):
    s = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").alias("k"), F.col("p_brand").alias("m")).distinct()
    return ml.simulated_subsets(s, "k", "m", [0.25, 0.5], 2)


@query("""SELECT o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('42:' || o_orderkey), o_orderkey) AS i FROM orders) WHERE i <= 200""")
def capped_sample(spark, sf):
    return ml.capped_sample(table(spark, sf, "orders"), "o_orderstatus", 200, ["o_orderkey"]).select("o_orderstatus", "o_orderkey")


@query("""SELECT o_orderkey, CAST(CAST('0x' || substr(md5('42:' || o_custkey), 1, 8) AS BIGINT) % 5 AS INT) AS fold FROM orders""")
def group_folds(spark, sf):
    return ml.folds(table(spark, sf, "orders"), "o_custkey", 5).select("o_orderkey", "fold")


@query("""WITH m AS (SELECT s_nationkey, median(s_acctbal) AS m, count(*) AS n FROM supplier GROUP BY s_nationkey), d AS (SELECT s.*, m, n, abs(s_acctbal - m) AS d FROM supplier s JOIN m USING (s_nationkey)), a AS (SELECT s_nationkey, median(d) AS mad FROM d GROUP BY s_nationkey)
SELECT s_suppkey, CASE WHEN n >= 3 AND mad > 0 AND d * 0.6745 > mad * 1.0 THEN s_acctbal * 0.5 ELSE s_acctbal END AS damped FROM d JOIN a USING (s_nationkey)""")
def damped_outliers(spark, sf):
    return ml.damp_outliers(table(spark, sf, "supplier"), ["s_nationkey"], "s_acctbal", 3, 1.0).select("s_suppkey", "damped")
