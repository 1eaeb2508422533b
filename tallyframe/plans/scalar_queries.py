"""Scalar functions, filters and set operations as queries."""

from pyspark.sql import functions as F

from tallyframe.functions import scalars as S
from tallyframe.plans.base import query, table


@query(r"""SELECT o_orderkey, regexp_replace(x, '_\d+$', '') AS bare, split_part(x, '|', 1) AS before, regexp_replace(x, '_[^_]*$', '') AS base, CASE WHEN contains(x, '__') THEN split_part(x, '__', 1) ELSE 'NA' END AS domain,
  regexp_replace(y, '[^A-Za-z0-9._-]+', '_', 'g') AS slug FROM (SELECT o_orderkey, o_orderstatus || '__' || o_orderpriority || '|p_' || o_custkey AS x, o_orderpriority || ' / ' || o_orderstatus AS y FROM orders)""")
def identifier_parts(spark, sf):
    x = F.concat(F.col("o_orderstatus"), F.lit("__"), F.col("o_orderpriority"), F.lit("|p_"), F.col("o_custkey").cast("string"))
    o = table(spark, sf, "orders").select("o_orderkey", x.alias("x"), F.concat_ws(" / ", "o_orderpriority", "o_orderstatus").alias("y"))
    c = F.col("x")
    return o.select("o_orderkey", S.without_number(c).alias("bare"), S.before_bar(c).alias("before"), S.without_last_part(c).alias("base"), S.domain_of(c, F.lit("NA")).alias("domain"), S.slug(F.col("y")).alias("slug"))


@query("""SELECT page_id, CASE WHEN b = '' THEN 'unnamed' ELSE b END AS name FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '[<>:"/\\\\|?*\\s]', '_', 'g'), '_+', '_', 'g'), '^[_.]+|[_.]+$', '', 'g') AS b FROM pages)""")
def safe_names(spark, sf):
    return table(spark, sf, "pages").select("page_id", S.safe_name(F.col("url")).alias("name"))


@query("""SELECT doc_id, length(text) - length(translate(text, 'ACGT', '')) AS n_acgt, coalesce((length(text) - length(translate(text, 'GCgc', ''))) * 100.0 / nullif(length(text), 0), 0.0) AS gc FROM documents""")
def character_counts(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.count_of(F.col("text"), "ACGT").alias("n_acgt"), S.gc_percent(F.col("text")).alias("gc"))


@query("""SELECT c_custkey, 'd_' || r_name || ';p_' || n_name || CASE WHEN c_custkey % 2 = 0 THEN ';c_' || c_mktsegment ELSE '' END AS lineage FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def lineage_text(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    third = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("")
    return c.select("c_custkey", S.lineage_text([F.col("r_name"), F.col("n_name"), third, *[F.lit("")] * 4]).alias("lineage"))


@query("""SELECT l_orderkey, l_linenumber, l_linenumber - 1 AS zero_start, l_linenumber + CAST(l_quantity AS BIGINT) AS zero_end, (3 - (l_orderkey % 3)) % 3 AS phase, (CAST(l_quantity AS BIGINT) + 1) * 1.0 / 60 AS coverage,
  (CAST(l_quantity AS BIGINT) + 1) * 1.0 / 60 > 0.66 AS complete FROM lineitem""")
def coordinates(spark, sf):
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("long")
    z = S.to_zero_based(n, n + q)
    cov = S.coverage(n, n + q, F.lit(60))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", z["start"].alias("zero_start"), z["end"].alias("zero_end"), S.phase(F.col("l_orderkey")).alias("phase"), cov.alias("coverage"), (cov > 0.66).alias("complete"))


@query("""SELECT c_custkey, printf('%.1f', c_acctbal) AS fixed FROM customer""")
def fixed_decimals(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", S.fixed_text(F.col("c_acctbal"), 1).alias("fixed"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_fields(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(p_type, ' '), lambda x: CASE WHEN x IN ('STANDARD', 'SMALL') THEN 'PPV' ELSE x END), ' ') AS remapped FROM part""")
def remapped_fields(spark, sf):
    return table(spark, sf, "part").select("p_partkey", S.remap_field(F.col("p_type"), " ", ["STANDARD", "SMALL"], "PPV").alias("remapped"))


@query("""SELECT doc_id, sha256(text) AS sha, length(text) AS n FROM documents""")
def content_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.length("text").alias("n"))


@query("""SELECT doc_id, n_chars FROM documents WHERE n_chars >= 1000 AND NOT regexp_matches(text, '[0-9]')""")
def length_and_alphabet_filter(spark, sf):
    return table(spark, sf, "documents").where((F.col("n_chars") >= 1000) & ~F.col("text").rlike("[0-9]")).select("doc_id", "n_chars")


@query("""SELECT p_partkey FROM part WHERE contains(p_type, 'STANDARD') AND NOT (contains(p_type, 'TIN') OR contains(p_type, 'BRASS'))""")
def keyword_filter(spark, sf):
    t = F.col("p_type")
    return table(spark, sf, "part").where(F.contains(t, F.lit("STANDARD")) & ~(F.contains(t, F.lit("TIN")) | F.contains(t, F.lit("BRASS")))).select("p_partkey")


@query("""SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 49 INTERSECT SELECT p_partkey FROM part WHERE p_size > 10""")
def set_intersection(spark, sf):
    return table(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("k")).intersect(table(spark, sf, "part").where("p_size > 10").select("p_partkey"))


@query("""SELECT 'missing' AS side, p_partkey AS k FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 30) UNION ALL
SELECT DISTINCT 'extra', l_partkey FROM lineitem WHERE l_quantity > 30 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)""")
def bijection_audit(spark, sf):
    items = table(spark, sf, "lineitem").where("l_quantity > 30").select(F.col("l_partkey").alias("k")).distinct()
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_size")
    missing = p.select("k").join(items, "k", "left_anti").select(F.lit("missing").alias("side"), "k")
    return missing.unionByName(items.join(p.where("p_size > 5"), "k", "left_anti").select(F.lit("extra").alias("side"), "k"))


@query("""SELECT o_custkey, o_orderstatus FROM orders EXCEPT ALL SELECT o_custkey, 'F' FROM orders WHERE o_orderkey % 2 = 0""")
def multiset_difference(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_custkey", "o_orderstatus").exceptAll(o.where("o_orderkey % 2 = 0").select("o_custkey", F.lit("F")))


@query("""SELECT l_suppkey, l_returnflag, p_brand, n FROM (SELECT l_suppkey, l_returnflag, p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand IN ('Brand#11', 'Brand#11.x') GROUP BY ALL)""")
def marker_scan(spark, sf):
    p = table(spark, sf, "part").where(F.col("p_brand").isin("Brand#11", "Brand#11.x")).select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_partkey").join(p, "l_partkey").groupBy("l_suppkey", "l_returnflag", "p_brand").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, CASE WHEN starts_with(o_orderpriority, '1') THEN 'first' WHEN starts_with(o_orderpriority, '2') OR starts_with(o_orderpriority, '3') THEN 'second' ELSE 'rest' END AS panel FROM orders""")
def panel_routing(spark, sf):
    p = F.col("o_orderpriority")
    return table(spark, sf, "orders").select("o_orderkey", F.when(F.startswith(p, F.lit("1")), "first").when(F.startswith(p, F.lit("2")) | F.startswith(p, F.lit("3")), "second").otherwise("rest").alias("panel"))


@query("""WITH s AS (SELECT p_partkey, repeat(substr('acgtNRYSWKMBDHVNELPQAGAGAG-', CAST(p_partkey % 24 + 1 AS BIGINT), CAST(1 + p_size % 5 AS BIGINT)), CAST(p_partkey % 7 AS BIGINT)) AS seq FROM part),
u AS (SELECT p_partkey, upper(seq) AS u, replace(replace(upper(seq), 'N', ''), '-', '') AS inf FROM s), n AS (SELECT *, length(inf) AS n, length(inf) - length(translate(inf, 'ACGT', '')) AS base,
  (contains(inf, 'A'))::INT + (contains(inf, 'C'))::INT + (contains(inf, 'G'))::INT + (contains(inf, 'T'))::INT AS kinds FROM u)
SELECT p_partkey, CASE WHEN translate(u, 'ATCGRYSWKMBDHVN-', '') <> '' THEN 'protein' WHEN n = 0 THEN 'nucleotide' WHEN n >= 12 AND kinds < 3 THEN 'protein' WHEN base * 2 >= n THEN 'nucleotide' ELSE 'protein' END AS kind FROM n""")
def sequence_alphabet(spark, sf):
    k = F.col("p_partkey")
    seq = F.repeat(F.substr(F.lit("acgtNRYSWKMBDHVNELPQAGAGAG-"), (k % 24 + 1).cast("int"), (F.col("p_size") % 5 + 1).cast("int")), (k % 7).cast("int"))
    return table(spark, sf, "part").select("p_partkey", S.alphabet(seq).alias("kind"))
