"""Join queries."""

from pyspark.sql import functions as F

from tallyframe.operators import joins, rank
from tallyframe.operators.rank import best
from tallyframe.plans.base import HITS, hits, query, table, tasks

# ids such as Customer#000000001|x_7, Customer#000000002_7 and odd_7
_IDS = """ids AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN c_name || '_' || o_orderkey WHEN 1 THEN c_name || '|p_' || o_orderkey
  WHEN 2 THEN 'odd' || o_orderkey || '_' || o_orderkey ELSE c_name END AS id FROM orders JOIN customer ON o_custkey = c_custkey),
labels_ AS (SELECT c_name AS label, c_mktsegment AS lineage FROM customer WHERE c_custkey % 5 <> 0)"""


def _ids(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    num = k.cast("string")
    shape = F.when(k % 4 == 0, F.concat_ws("_", "c_name", num)).when(k % 4 == 1, F.concat(F.col("c_name"), F.lit("|p_"), num)).when(k % 4 == 2, F.concat(F.lit("odd"), num, F.lit("_"), num)).otherwise(F.col("c_name"))
    labels = c.where(F.col("c_custkey") % 5 != 0).select(F.col("c_name").alias("label"), F.col("c_mktsegment").alias("lineage"))
    return j.select(k.alias("k"), shape.alias("id")), labels


@query(f"""WITH {_IDS} SELECT k, id, coalesce(a.label, b.label, regexp_replace(id, '_\\d+$', '')) AS resolved FROM ids
  LEFT JOIN labels_ a ON a.label = regexp_replace(id, '_\\d+$', '') LEFT JOIN labels_ b ON b.label = split_part(id, '|', 1)""")
def id_fallback_stripped(spark, sf):
    ids, labels = _ids(spark, sf)
    stripped = joins.stripped_then_bar(F.col("id"))
    return joins.resolve(ids, "id", labels, "label", stripped, stripped[0]).select("k", "id", "resolved")


@query(f"""WITH {_IDS} SELECT k, id, coalesce(e.label, a.label, b.label, regexp_replace(id, '_\\d+$', '')) AS resolved FROM ids LEFT JOIN labels_ e ON e.label = id
  LEFT JOIN labels_ a ON a.label = regexp_replace(id, '_\\d+$', '') LEFT JOIN labels_ b ON b.label = split_part(id, '|', 1)""")
def id_fallback_exact_first(spark, sf):
    ids, labels = _ids(spark, sf)
    tried = joins.exact_then_stripped(F.col("id"))
    return joins.resolve(ids, "id", labels, "label", tried, tried[1]).select("k", "id", "resolved")


@query("""SELECT o_orderkey, coalesce(c_mktsegment, 'NA') AS domain, coalesce(c_name, '') AS name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) ON o_custkey = c_custkey""")
def label_with_default(spark, sf):
    dim = table(spark, sf, "customer").where(F.col("c_custkey") % 3 == 0).select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("domain"), F.col("c_name").alias("name"))
    return joins.left_default(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), dim, "o_custkey", domain=F.lit("NA"), name=F.lit("")).drop("o_custkey")


@query("""WITH top AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity = 50)
SELECT p_partkey, p_size FROM part WHERE p_partkey IN (SELECT k FROM top) OR p_size IN (SELECT k FROM top)""")
def semi_by_either_key(spark, sf):
    keys = table(spark, sf, "lineitem").where(F.col("l_quantity") == 50).select(F.col("l_partkey").alias("k"))
    return joins.semi_either(table(spark, sf, "part").select("p_partkey", "p_size"), keys, "k", ["p_partkey", "p_size"])


@query("""SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""")
def anti_chain(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return c.join(o.where("o_orderstatus = 'F'"), "c_custkey", "left_anti").join(o.where("o_orderstatus = 'P'"), "c_custkey", "left_anti")


@query(f"""WITH {HITS} SELECT query, prefix, count(DISTINCT protein) AS n FROM hits JOIN (SELECT unnest(['Brand#1', 'Brand#12', 'Brand#2']) AS prefix) ON starts_with(model, prefix) GROUP BY ALL""")
def prefix_category_counts(spark, sf):
    return joins.prefix_counts(hits(spark, sf), "model", "protein", ["Brand#1", "Brand#12", "Brand#2"], ["query"])


_SETS = "sets AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS m FROM lineitem)"
_FEW = "few AS (SELECT s, m FROM sets WHERE m IN (SELECT m FROM sets GROUP BY m HAVING count(*) BETWEEN 2 AND 40))"
PAIRS = f"""{_SETS}, {_FEW}, z AS (SELECT s, count(*) AS n FROM sets GROUP BY s),
pairs AS (SELECT a, b, shared, shared / least(x.n, y.n) AS overlap FROM (SELECT p.s AS a, q.s AS b, count(*) AS shared FROM few p JOIN few q ON p.m = q.m AND p.s < q.s GROUP BY ALL)
  JOIN z x ON x.s = a JOIN z y ON y.s = b)"""


def pairs(spark, sf):
    items = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("m"))
    return joins.shared_members(items, "s", "m", 40)


@query(f"WITH {PAIRS} SELECT * FROM pairs")
def overlap_pairs(spark, sf):
    return pairs(spark, sf)


@query("""WITH f AS (SELECT p_brand, min(p_size) AS lo, max(p_size) AS hi FROM part GROUP BY p_brand HAVING count(*) > 80), o AS (SELECT p_type, min(p_size) AS lo, max(p_size) AS hi FROM part GROUP BY p_type)
SELECT p_partkey, CASE WHEN f.lo IS NOT NULL THEN 'p_brand' WHEN o.lo IS NOT NULL THEN 'p_type' ELSE 'unavailable' END AS group_level, coalesce(f.lo, o.lo) AS lo, coalesce(f.hi, o.hi) AS hi
FROM part LEFT JOIN f USING (p_brand) LEFT JOIN o USING (p_type)""")
def nested_group_fallback(spark, sf):
    p = table(spark, sf, "part")
    ends = lambda c: p.groupBy(c).agg(F.min("p_size").alias("lo"), F.max("p_size").alias("hi"), F.count("*").alias("n"))
    narrow = ends("p_brand").where("n > 80").drop("n")
    out = joins.nested_fallback(p.select("p_partkey", "p_brand", "p_type"), narrow, "p_brand", ends("p_type").drop("n"), "p_type", ["lo", "hi"])
    return out.select("p_partkey", "group_level", "lo", "hi")


@query("""WITH s AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL)
SELECT p_brand, p_type, n FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_type = (SELECT min(p_type) FROM part) THEN 0 ELSE 1 END, p_type) AS k FROM s) WHERE k = 1""")
def stats_partition_fallback(spark, sf):
    p = table(spark, sf, "part")
    first = p.agg(F.min("p_type")).first()[0]
    return joins.partition_fallback(p.groupBy("p_brand", "p_type").agg(F.count("*").alias("n")), "p_brand", "p_type", first, [F.col("p_type").asc()])


@query("""WITH c AS (SELECT c_nationkey AS g, c_mktsegment AS m, count(*) AS n FROM customer WHERE c_acctbal > 5000 GROUP BY ALL), w AS (SELECT c_mktsegment AS m, CAST(max(length(c_mktsegment)) AS INT) AS width FROM customer GROUP BY ALL)
SELECT n_nationkey AS g, w.m, width, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN repeat('-', width) ELSE '+' END AS block FROM nation CROSS JOIN w LEFT JOIN c ON g = n_nationkey AND c.m = w.m""")
def grid_gap_fill(spark, sf):
    c = table(spark, sf, "customer")
    cells = c.where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("g"), F.col("c_mktsegment").alias("m")).agg(F.count("*").alias("n")).withColumn("block", F.lit("+"))
    w = c.groupBy(F.col("c_mktsegment").alias("m")).agg(F.max(F.length("c_mktsegment")).alias("width"))
    rows = table(spark, sf, "nation").select(F.col("n_nationkey").alias("g"))
    return joins.grid_fill(cells, rows, "g", w, "m", {"n": F.lit(0), "block": F.expr("repeat('-', width)")})


@query("""WITH m AS (SELECT p_partkey AS s, p_brand AS t FROM part WHERE p_size > 25) SELECT l_orderkey, l_linenumber, coalesce(t, CAST(l_partkey AS VARCHAR)) AS model FROM lineitem LEFT JOIN m ON s = l_partkey""")
def model_to_group(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("model"))
    m = table(spark, sf, "part").where("p_size > 25").select(F.col("p_partkey").cast("string").alias("s"), F.col("p_brand").alias("t"))
    return joins.mapped(items, "model", m, "s", "t")


@query(f"""WITH {HITS}, b AS (SELECT protein, ptype, max(seq_score) AS best FROM hits GROUP BY ALL)
SELECT protein, model, ptype, seq FROM hits JOIN b USING (protein, ptype) WHERE seq_score = best""")
def best_in_group(spark, sf):
    h = hits(spark, sf)
    top = h.groupBy("protein", "ptype").agg(F.max("seq_score").alias("best"))
    return h.join(top, ["protein", "ptype"]).where("seq_score = best").select("protein", "model", "ptype", "seq")


@query("""SELECT c_custkey, count(DISTINCT o_orderkey) AS contigs, count(l_linenumber) AS proteins, count(DISTINCT l_partkey) AS markers, count(DISTINCT CASE WHEN l_quantity >= 40 THEN l_partkey END) AS strong
FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_custkey""")
def contig_rollup(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity")
    owned = table(spark, sf, "customer").select("c_custkey").join(o, "c_custkey")
    chain = items.repartition(tasks(spark, sf), "o_orderkey").join(owned, "o_orderkey")
    # each contig's first row counts it, so that only markers are told apart by groups and no row is copied for each distinct count
    first = rank.ordinal(chain, ["c_custkey", "o_orderkey"], [F.col("l_linenumber").asc()], "_i")
    markers = first.repartition(tasks(spark, sf), "c_custkey").groupBy("c_custkey", "l_partkey").agg(
        F.count_if(F.col("_i") == 1).alias("contigs"), F.count("l_linenumber").alias("proteins"), F.coalesce(F.bool_or(F.col("l_quantity") >= 40), F.lit(False)).alias("strong"),
    )
    return markers.groupBy("c_custkey").agg(
        F.sum("contigs").alias("contigs"), F.sum("proteins").alias("proteins"), F.count("l_partkey").alias("markers"), F.count_if(F.col("strong") & F.col("l_partkey").isNotNull()).alias("strong"),
    )


@query("""SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')""")
def three_way_intersection(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    c = table(spark, sf, "customer").select("c_custkey")
    return c.join(o.where("o_orderstatus = 'F'"), "c_custkey", "left_semi").join(o.where("o_orderpriority like '1%'"), "c_custkey", "left_semi")


@query("""SELECT o_orderkey, 'new' AS status FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, 'old' FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0""")
def resume_upsert(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    old = o.where("o_orderkey % 2 = 0").withColumn("status", F.lit("old"))
    return joins.upsert(old, o.where("o_orderkey % 3 = 0").withColumn("status", F.lit("new")), ["o_orderkey"])


_DONOR = """WITH b AS (SELECT s_suppkey AS k, s_nationkey AS f, n_regionkey AS o, CAST(round(s_acctbal * 100) AS BIGINT) AS z FROM supplier JOIN nation ON s_nationkey = n_nationkey),
fam AS (SELECT k, d FROM (SELECT x.k, y.k AS d, row_number() OVER (PARTITION BY x.k ORDER BY y.z {0}, y.k) AS r FROM b x JOIN b y ON x.f = y.f AND x.k <> y.k) WHERE r = 1),
ord AS (SELECT k, d FROM (SELECT x.k, y.k AS d, row_number() OVER (PARTITION BY x.k ORDER BY y.z {0}, y.k) AS r FROM b x JOIN b y ON x.o = y.o AND x.k <> y.k) WHERE r = 1),
far AS (SELECT k, d FROM (SELECT x.k, y.k AS d, row_number() OVER (PARTITION BY x.k ORDER BY y.z {0}, y.k) AS r FROM b x JOIN b y ON x.o <> y.o) WHERE r = 1)
SELECT b.k, coalesce(fam.d, ord.d) AS related, far.d AS divergent FROM b LEFT JOIN fam USING (k) LEFT JOIN ord USING (k) LEFT JOIN far USING (k)"""


def _donors(spark, sf, largest):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("f"), F.col("n_regionkey").alias("o"))
    b = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("f"), F.round(F.col("s_acctbal") * 100).cast("long").alias("z")).join(n, "f")
    return joins.donors(b, b, "k", "f", "o", "z", largest)


@query(_DONOR.format("DESC"))
def donors_largest(spark, sf):
    return _donors(spark, sf, True)


@query(_DONOR.format("ASC"))
def donors_smallest(spark, sf):
    return _donors(spark, sf, False)


@query("""WITH e AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_quantity > 45), al AS (SELECT p_partkey AS a, p_partkey + 1 AS t FROM part WHERE p_partkey % 10 = 0), act AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 7 <> 0),
via AS (SELECT DISTINCT coalesce(t, id) AS id FROM e LEFT JOIN al ON a = id)
SELECT 'unresolved' AS status, id FROM via WHERE id NOT IN (SELECT k FROM act) UNION ALL SELECT 'no_evidence', k FROM act WHERE k NOT IN (SELECT id FROM via)""")
def alias_audit(spark, sf):
    p = table(spark, sf, "part").select("p_partkey")
    e = table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("id"))
    al = p.where("p_partkey % 10 = 0").select(F.col("p_partkey").alias("a"), (F.col("p_partkey") + 1).alias("t"))
    return joins.unresolved(e, "id", al, "a", "t", p.where("p_partkey % 7 <> 0"), "p_partkey")


@query("""WITH a AS (SELECT c_custkey AS label, c_custkey // 3 AS acc, c_mktsegment AS dom FROM customer), p AS (SELECT acc, max(label) AS kept FROM a WHERE dom = 'BUILDING' GROUP BY acc)
SELECT label, coalesce(kept, label) AS relabelled FROM a LEFT JOIN p USING (acc)""")
def group_relabel(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("label"), F.expr("c_custkey div 3").alias("acc"), F.col("c_mktsegment").alias("dom"))
    p = a.where("dom = 'BUILDING'").groupBy("acc").agg(F.max("label").alias("kept"))
    return a.join(p, "acc", "left").select("label", F.coalesce("kept", "label").alias("relabelled"))


@query("""WITH placed AS (SELECT l_suppkey AS g, l_returnflag AS m, min(l_partkey) AS p FROM lineitem WHERE l_discount < 0.02 GROUP BY ALL), longest AS (
  SELECT g, m, p FROM (SELECT l_suppkey AS g, l_returnflag AS m, l_partkey AS p, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_quantity DESC, l_partkey) AS k FROM lineitem) WHERE k = 1)
SELECT g, m, coalesce(placed.p, longest.p) AS rep FROM longest LEFT JOIN placed USING (g, m)""")
def representative_fill(spark, sf):
    items = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("g"), F.col("l_returnflag").alias("m"), F.col("l_partkey").alias("p"), "l_discount", "l_quantity")
    placed = items.where("l_discount < 0.02").groupBy("g", "m").agg(F.min("p").alias("near"))
    longest = best(items, ["g", "m"], ["-l_quantity", "p"]).select("g", "m", "p")
    return longest.join(placed, ["g", "m"], "left").select("g", "m", F.coalesce("near", "p").alias("rep"))


@query(f"""WITH {HITS}, c AS (SELECT p_brand AS model, CAST(100 * (CASE WHEN p_brand LIKE '%5' THEN 60000 ELSE 30000 END) AS BIGINT) AS cut FROM part WHERE p_brand NOT LIKE '%3' GROUP BY ALL)
SELECT protein, seq, model FROM hits LEFT JOIN c USING (model) WHERE coalesce(seq_score >= cut, true)""")
def gate_keep_without_cutoff(spark, sf):
    h, c = _cuts(spark, sf)
    return h.join(c, "model", "left").where(F.coalesce(F.col("seq_score") >= F.col("cut"), F.lit(True))).select("protein", "seq", "model")


@query(f"""WITH {HITS}, c AS (SELECT p_brand AS model, CAST(100 * (CASE WHEN p_brand LIKE '%5' THEN 60000 ELSE 30000 END) AS BIGINT) AS cut FROM part WHERE p_brand NOT LIKE '%3' GROUP BY ALL)
SELECT protein, seq, model FROM hits JOIN c USING (model) WHERE seq_score >= cut AND dom_score >= 20""")
def gate_drop_without_cutoff(spark, sf):
    h, c = _cuts(spark, sf)
    return h.join(c, "model").where("seq_score >= cut and dom_score >= 20").select("protein", "seq", "model")


def _cuts(spark, sf):
    cut = F.when(F.col("model").like("%5"), 6_000_000).otherwise(3_000_000).cast("long")
    c = table(spark, sf, "part").select(F.col("p_brand").alias("model")).distinct().where(~F.col("model").like("%3")).withColumn("cut", cut)
    return hits(spark, sf), c
