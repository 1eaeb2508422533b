"""Ranking queries."""

from pyspark.sql import functions as F

from tallyframe.operators import rank
from tallyframe.plans.base import HITS, PLACEMENTS, hits, placements, query, table


@query(f"""WITH {HITS} SELECT query, protein, model, seq, seq_score FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY seq_score DESC, protein, seq) AS rn FROM hits) WHERE rn <= 100""")
def top_hits_per_query(spark, sf):
    h = rank.top_n(hits(spark, sf), ["query"], [F.col("seq_score").desc(), F.col("protein").asc(), F.col("seq").asc()], 100)
    return h.select("query", "protein", "model", "seq", "seq_score")


@query(f"""WITH {HITS}, capped AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY protein, seq, model) AS rn FROM hits) WHERE rn <= 50)
SELECT query, model, seq_score, place FROM (SELECT query, model, seq_score, protein * 8 + seq AS place,
  row_number() OVER (PARTITION BY model ORDER BY seq_score DESC, query, protein * 8 + seq) AS k FROM capped) WHERE k = 1""")
def first_hits_then_best_subject(spark, sf):
    h = hits(spark, sf).withColumn("place", F.col("protein") * 8 + F.col("seq"))
    return rank.first_n_then_unique(h, "query", "model", "place", "seq_score", 50)


@query(f"""WITH {HITS} SELECT protein, model, seq_score, dom_score, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY protein, model ORDER BY seq_score DESC, dom_score DESC, seq) AS rn FROM hits) WHERE rn = 1""")
def best_row_per_protein_model(spark, sf):
    return rank.best(hits(spark, sf), ["protein", "model"], ["-seq_score", "-dom_score", "seq"])


@query(f"""WITH {HITS} SELECT protein, model, seq_score, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY protein, CASE WHEN model LIKE 'Brand#1%' THEN model ELSE '' END ORDER BY seq_score DESC, seq, model) AS rn FROM hits)
WHERE rn = 1""")
def best_model_per_protein(spark, sf):
    kept = rank.best_model_split(hits(spark, sf), "protein", "model", "seq_score", "seq", F.startswith(F.col("model"), F.lit("Brand#1")))
    return kept.select("protein", "model", "seq_score", "seq")


@query(f"""WITH {PLACEMENTS} SELECT query, protein, distance, marker, neighbor, r1, r3 FROM (
  SELECT *, row_number() OVER (PARTITION BY query, protein ORDER BY distance, marker, neighbor) AS rn FROM placements) WHERE rn = 1""")
def nearest_placement(spark, sf):
    return rank.best(placements(spark, sf), ["query", "protein"], ["distance", "marker", "neighbor"], carry=["r1", "r3"])


@query(f"""WITH {PLACEMENTS}, one AS (SELECT query, r2, min(distance) AS distance FROM placements GROUP BY ALL),
w AS (SELECT p.query, p.r2, p.distance, min(neighbor) AS neighbor FROM placements p JOIN one USING (query, r2, distance) GROUP BY ALL)
SELECT query, r2, distance, neighbor, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, r2) AS rank FROM w) WHERE rank <= 5""")
def nearest_genomes_per_query(spark, sf):
    return rank.nearest_then_top(placements(spark, sf), "query", "r2", "neighbor", "distance", 5)


@query(f"""WITH {PLACEMENTS}, near AS (SELECT query, protein, min(distance) AS distance FROM placements GROUP BY ALL)
SELECT p.query, p.protein, p.distance, min(marker) AS marker FROM placements p JOIN near USING (query, protein, distance) GROUP BY ALL HAVING min(marker) = max(marker)""")
def closest_type_or_drop(spark, sf):
    return rank.closest_or_drop(placements(spark, sf), ["query", "protein"], "distance", "marker")


@query(f"""WITH {HITS}, c AS (SELECT query, ptype, count(*) AS n FROM hits GROUP BY ALL), m AS (SELECT query, max(n) AS n FROM c GROUP BY ALL)
SELECT query, CASE WHEN count(*) = 1 THEN min(ptype) ELSE '' END AS ptype, n FROM c JOIN m USING (query, n) GROUP BY query, n""")
def dominant_type_or_blank(spark, sf):
    return rank.dominant_or_blank(hits(spark, sf), ["query"], "ptype")


@query(f"""WITH {HITS}, c AS (SELECT query, model, count(*) AS n FROM hits GROUP BY ALL)
SELECT query, model, n FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY n DESC, model) AS k FROM c) WHERE k = 1""")
def stable_top_model(spark, sf):
    return rank.stable_top(hits(spark, sf).groupBy("query", "model").agg(F.count("*").alias("n")), ["query"], "model")


@query(f"""WITH {PLACEMENTS}, c AS (SELECT query, marker, r2, count(*) AS n FROM placements GROUP BY ALL),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query, marker ORDER BY n DESC, r2) AS k FROM c) WHERE k = 1),
v AS (SELECT query, r2, count(*) AS supporting FROM p GROUP BY ALL), t AS (SELECT query, count(*) AS total FROM p GROUP BY ALL)
SELECT query, r2, supporting, total FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY supporting DESC, r2) AS k FROM v) JOIN t USING (query) WHERE k = 1""")
def winner_across_markers(spark, sf):
    votes = placements(spark, sf).groupBy("query", "marker", "r2").agg(F.count("*").alias("n"))
    return rank.winner_of_winners(votes, ["query"], "marker", "r2")


@query(f"""WITH {HITS} SELECT query, protein, seq_score, length FROM (SELECT query, protein, seq_score, dom_score AS length,
  row_number() OVER (PARTITION BY query ORDER BY dom_score DESC, protein, seq_score DESC) AS k FROM hits) WHERE k = 1""")
def longest_per_genome(spark, sf):
    h = hits(spark, sf).withColumnRenamed("dom_score", "length")
    return rank.best(h, ["query"], ["-length", "protein", "-seq_score"])


@query("""SELECT o_custkey, o_orderkey, w AS width, sum(w) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - w + 1 AS start,
  sum(w) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS stop FROM (SELECT *, CAST(floor(o_totalprice / 1000) AS BIGINT) AS w FROM orders)""")
def partition_ranges(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.floor(F.col("o_totalprice") / 1000).cast("long").alias("width"))
    return rank.running_ranges(o, ["o_custkey"], [F.col("o_orderkey").asc()], "width")


@query("""SELECT l_suppkey, l_orderkey, l_linenumber, q FROM (SELECT l_suppkey, l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q,
  coalesce(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM lineitem) WHERE b < 500""")
def take_until_target(spark, sf):
    items = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("q"))
    return rank.take_until(items, ["l_suppkey"], [F.col("l_orderkey").asc(), F.col("l_linenumber").asc(), F.col("q").asc()], "q", 500)


@query("""SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS ordinal FROM lineitem""")
def gene_ordinal(spark, sf):
    return rank.ordinal(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"], [F.col("l_linenumber").asc()]).withColumn("ordinal", F.col("ordinal").cast("long"))


@query("""SELECT user_id, event_id, max(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS progress FROM events""")
def monotone_progress(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", F.round(F.col("value") * 100).cast("long").alias("p"))
    return rank.running_max(e, ["user_id"], [F.col("ts").asc(), F.col("event_id").asc()], "p", "progress").select("user_id", "event_id", "progress")


@query("""WITH a AS (SELECT o_custkey AS k, CASE WHEN o_orderpriority LIKE '1%' THEN 'GCF' WHEN o_orderpriority LIKE '2%' THEN 'GCA' ELSE 'txt' END AS kind, o_orderkey AS acc FROM orders)
SELECT k, kind, acc FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY kind = 'GCF' DESC, kind = 'GCA' DESC, acc DESC) AS rn FROM a) WHERE rn = 1""")
def preferred_accession(spark, sf):
    p = F.col("o_orderpriority")
    kind = F.when(F.startswith(p, F.lit("1")), "GCF").when(F.startswith(p, F.lit("2")), "GCA").otherwise("txt")
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), kind.alias("kind"), F.col("o_orderkey").alias("acc"))
    best = a.groupBy("k").agg(F.max(F.struct((F.col("kind") == "GCF").alias("f"), (F.col("kind") == "GCA").alias("g"), "acc", "kind")).alias("b"))
    return best.select("k", "b.kind", "b.acc")


CODES = """codes AS (SELECT l_suppkey AS q, l_linenumber AS code, count(*) AS complete, CAST(round(sum(l_extendedprice)) AS BIGINT) AS score, CAST(sum(l_quantity) AS BIGINT) AS density
  FROM lineitem GROUP BY ALL)"""


@query(f"""WITH {CODES}, base AS (SELECT q, complete AS cb, score AS sb, density AS db FROM codes WHERE code = 1),
lead AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY complete DESC, score DESC, density DESC, list_position([3, 2, 4, 5, 6, 7], code)) AS k FROM codes WHERE code <> 1) WHERE k = 1)
SELECT base.q, CASE WHEN complete >= cb + 2 OR score * 100 >= sb * 110 OR density * 100 >= db * 105 THEN code ELSE 1 END AS code FROM base LEFT JOIN lead USING (q)""")
def genetic_code_choice(spark, sf):
    items = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("q"), F.col("l_linenumber").alias("code")).agg(
        F.count("*").alias("complete"), F.round(F.sum("l_extendedprice")).cast("long").alias("score"), F.sum("l_quantity").cast("long").alias("density")
    )
    wins = (F.col("complete") >= F.col("complete_base") + 2) | (F.col("score") * 100 >= F.col("score_base") * 110) | (F.col("density") * 100 >= F.col("density_base") * 105)
    return rank.override_baseline(items, "q", "code", ["complete", "score", "density"], 1, wins, [3, 2, 4, 5, 6, 7])
