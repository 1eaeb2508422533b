"""Prefix joins, neighbours by names, indexed sequences, fragments and the order-dependent choice of codes."""

from pyspark.sql import functions as F

from tallyframe.operators import fragments, joins, rank, tree
from tallyframe.operators.staging import shared_path
from tallyframe.plans.base import query, table
from tallyframe.plans.structure_queries import _TREE, edges
from tallyframe.sources import fasta_index
from tallyframe.sources.sequences import write_fasta


@query("""SELECT c_custkey, c_name, s_suppkey, prefix FROM customer JOIN (SELECT s_suppkey, substr(replace(s_name, 'Supplier', 'Customer'), 1, 13 + s_suppkey % 6) AS prefix FROM supplier) s ON starts_with(c_name, prefix)""")
def names_by_prefix(spark, sf):
    named = F.replace("s_name", F.lit("Supplier"), F.lit("Customer"))
    prefixes = table(spark, sf, "supplier").select("s_suppkey", F.substring(named, F.lit(1), (13 + F.col("s_suppkey") % 6).cast("int")).alias("prefix"))
    return joins.prefix_join(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_name", prefixes, "prefix")


# every tree is searched for leaves of 'L0' and a digit, every fourth for a second name
@query(f"""WITH {_TREE}, q AS (SELECT DISTINCT tree, 'L0' || (6 + CAST(tree AS INT) % 4) AS query FROM edges UNION SELECT DISTINCT tree, 'L1' FROM edges WHERE CAST(tree AS INT) % 4 = 0), p(prefix) AS (VALUES ('L07'), ('L09'), ('L1'), ('L12')),
mine AS (SELECT q.tree, query, node FROM q JOIN leaves l ON l.tree = q.tree AND starts_with(leaf, query)),
cand AS (SELECT DISTINCT q.tree, query, node, leaf FROM q JOIN leaves l ON l.tree = q.tree AND NOT starts_with(leaf, query) JOIN p ON starts_with(leaf, prefix)),
d AS (SELECT c.tree, c.query, c.leaf, min(a.dist + b.dist) AS dist FROM cand c JOIN up a ON a.tree = c.tree AND a.node = c.node JOIN mine m ON m.tree = c.tree AND m.query = c.query
  JOIN up b ON b.tree = m.tree AND b.node = m.node AND b.ancestor = a.ancestor GROUP BY ALL),
g AS (SELECT * FROM (SELECT *, right(leaf, 1) AS genome, row_number() OVER (PARTITION BY tree, query, right(leaf, 1) ORDER BY dist, leaf) AS k FROM d) WHERE k = 1)
SELECT tree, query, genome, leaf, dist, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY tree, query ORDER BY dist, genome) AS rank FROM g) WHERE rank <= 4""")
def neighbours_by_prefix(spark, sf):
    e = edges(spark, sf)
    trees = e.select("tree").distinct()
    n = F.col("tree").cast("int") % 4
    asked = trees.select("tree", F.concat(F.lit("L0"), (6 + n).cast("string")).alias("query")).unionByName(trees.where(n == 0).select("tree", F.lit("L1").alias("query")))
    kept = spark.createDataFrame([("L07",), ("L09",), ("L1",), ("L12",)], "prefix string")
    return tree.top_k_neighbors(e, asked, kept, F.right("leaf", F.lit(1)), 4)


_SEQ = "translate(md5(CAST(p_partkey AS VARCHAR)) || md5(p_name), '0123456789abcdef', 'ACGTACGTACGTACGT')"


@query(f"""WITH rec AS (SELECT 'P' || p_partkey AS id, 'P' || p_partkey || ' ' || p_name || ' ' || p_type AS description, {_SEQ} AS seq FROM part),
asked AS (SELECT DISTINCT CASE WHEN l_partkey % 3 = 0 THEN 'P' || p_partkey || ' ' || p_name || ' ' || p_type WHEN l_partkey % 7 = 0 THEN 'Q' || p_partkey ELSE 'P' || p_partkey END AS name
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 49)
SELECT name, id, CASE WHEN name = id THEN 'id' ELSE 'description' END AS how, seq FROM asked JOIN rec ON name IN (id, description)""")
def sequences_by_name(spark, sf):
    parts = table(spark, sf, "part")
    name, text = F.concat(F.lit("P"), F.col("p_partkey").cast("string")), F.concat_ws(" ", F.concat(F.lit("P"), F.col("p_partkey").cast("string")), "p_name", "p_type")
    seq = F.translate(F.concat(F.md5(F.col("p_partkey").cast("string").cast("binary")), F.md5(F.col("p_name").cast("binary"))), "0123456789abcdef", "ACGTACGTACGTACGT")
    path = shared_path(spark, "fasta")
    write_fasta(parts.select(text.alias("name"), seq.alias("seq")), path, "name", "seq", 40)
    asks = F.when(F.col("l_partkey") % 3 == 0, text).when(F.col("l_partkey") % 7 == 0, F.concat(F.lit("Q"), F.col("p_partkey").cast("string"))).otherwise(name)
    asked = table(spark, sf, "lineitem").where("l_quantity >= 49").select("l_partkey").join(parts, F.col("l_partkey") == F.col("p_partkey")).select(asks.alias("name")).distinct()
    return fasta_index.fetch(fasta_index.build_index(spark, path), asked, "name").select("name", "id", "how", "seq")


_LENGTHS = fragments.Lengths(mean=600, sigma=0.7, least=200, most=2500, long=900)
_UNIFORM = "((CAST('0x' || substr(sha256('17:' || doc_id || ':' || i || ':{}'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)"


@query(f"""WITH RECURSIVE c AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS size, greatest(CAST(round_even(length(text) / 600.0, 0) AS INT), 1) AS n FROM documents WHERE length(text) > 0),
v AS (SELECT doc_id, size, n, i, least(greatest(exp(ln(600.0) - 0.5 * 0.7 * 0.7 + 0.7 * sqrt(-2 * ln({_UNIFORM.format('r')})) * cos(2 * pi() * {_UNIFORM.format('a')})), 200.0), 2500.0) AS x
  FROM (SELECT doc_id, size, n, unnest(range(1, n + 1)) AS i FROM c)),
r AS (SELECT *, CAST(round_even(x * (size / sum(x) OVER (PARTITION BY doc_id)), 0) AS BIGINT) AS y FROM v),
f AS (SELECT doc_id, size, n, list(CASE WHEN i = n THEN y + size - s ELSE y END ORDER BY i) AS l FROM (SELECT *, CAST(sum(y) OVER (PARTITION BY doc_id) AS BIGINT) AS s FROM r) GROUP BY doc_id, size, n),
m AS (SELECT doc_id, size, l, 0 AS i, CAST([] AS BIGINT[]) AS done, CAST(0 AS BIGINT) AS carry FROM f UNION ALL
  SELECT doc_id, size, l, i + 1, CASE WHEN carry + l[i + 1] < 200 THEN done ELSE list_append(done, carry + l[i + 1]) END, CASE WHEN carry + l[i + 1] < 200 THEN carry + l[i + 1] ELSE 0 END FROM m WHERE i < len(l)),
e AS (SELECT doc_id, size, CASE WHEN carry = 0 THEN done WHEN len(done) = 0 THEN [carry] ELSE list_append(done[:len(done) - 1], done[len(done)] + carry) END AS a FROM m WHERE i = len(l)),
g AS (SELECT doc_id, size, a, CASE WHEN list_max(a) >= 900 OR size < 900 THEN NULL ELSE list_reverse_sort(a) END AS d FROM e),
j AS (SELECT doc_id, size, a, d, CASE WHEN d IS NULL THEN 0 ELSE list_min([k FOR k IN range(1, len(d) + 1) IF list_sum(d[:k]) >= 900]) END AS k FROM g),
o AS (SELECT doc_id, CASE WHEN size < 200 THEN [size] WHEN d IS NULL THEN a ELSE list_append(d[k + 1:], CAST(list_sum(d[:k]) AS BIGINT)) END AS a FROM j),
x AS (SELECT doc_id, fragment, a[fragment] AS length FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS fragment FROM o)),
y AS (SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY doc_id ORDER BY fragment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM x)
SELECT doc_id, CAST(fragment AS INT) AS fragment, start, y.length, md5(substr(text, start + 1, y.length)) AS piece FROM y JOIN c USING (doc_id)""")
def shredded_documents(spark, sf):
    cut = fragments.shredded(table(spark, sf, "documents"), "doc_id", "text", _LENGTHS)
    return cut.withColumn("piece", F.md5(F.col("piece").cast("binary")))


_CODES = ["meta", "code1", "code4", "code6", "code11", "code15", "code29"]
_STATS = """stats AS (SELECT l_suppkey AS genome, CASE l_linenumber WHEN 1 THEN 'meta' WHEN 2 THEN 'code1' WHEN 3 THEN 'code4' WHEN 4 THEN 'code6' WHEN 5 THEN 'code11' WHEN 6 THEN 'code15' ELSE 'code29' END AS code, l_linenumber AS p,
  CAST(count(*) % 4 AS BIGINT) AS hits, CAST(count(*) % 3 AS BIGINT) AS score, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) / 10.0 AS density FROM lineitem GROUP BY ALL)"""


@query(f"""WITH RECURSIVE {_STATS}, b AS (SELECT * FROM stats WHERE p = 1),
w AS (SELECT genome, 1 AS i, code AS best, hits AS h, score AS s, density AS b FROM b UNION ALL
  SELECT x.genome, x.i + 1, CASE WHEN ok THEN x.code ELSE best END, CASE WHEN ok THEN x.hits ELSE h END, CASE WHEN ok THEN x.score ELSE s END, b
  FROM (SELECT w.*, t.code, t.hits, t.score, coalesce(t.hits > h OR (t.hits = h AND t.score > s) OR (t.hits = h AND t.score = s AND t.density > b * 1.02), false) AS ok FROM w LEFT JOIN stats t ON t.genome = w.genome AND t.p = w.i + 1 WHERE w.i < 7) x)
SELECT genome, best FROM w WHERE i = 7""")
def code_choice_in_order(spark, sf):
    items = table(spark, sf, "lineitem")
    code = F.element_at(F.array(*(F.lit(c) for c in _CODES)), F.col("l_linenumber"))
    stats = items.groupBy(F.col("l_suppkey").alias("genome"), code.alias("code")).agg(
        (F.count("*") % 4).alias("hits"), (F.count("*") % 3).alias("score"), (F.sum(F.col("l_quantity").cast("long")) / 10.0).alias("density")
    )
    return rank.override_in_order(stats, ["genome"], "code", _CODES, "hits", "score", "density")
