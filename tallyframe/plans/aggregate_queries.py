"""Aggregate, panel and evaluation queries."""

from pyspark.sql import functions as F

from tallyframe.operators import aggregate
from tallyframe.plans.base import HITS, hits, query, table

_PANEL = ["Brand#11", "Brand#12", "Brand#13", "Brand#21", "Brand#99"]
_IN = ", ".join(f"'{p}'" for p in _PANEL)


@query(f"""WITH {HITS} SELECT query, model, count(DISTINCT protein) AS n FROM hits GROUP BY ALL""")
def distinct_proteins_per_model(spark, sf):
    return hits(spark, sf).groupBy("query", "model").agg(F.count_distinct("protein").alias("n"))


@query(f"""WITH {HITS} SELECT query, count(DISTINCT CASE WHEN model IN ({_IN}) THEN model END) AS present, count(DISTINCT CASE WHEN model IN ({_IN}) THEN protein || '/' || model END) AS total, 5 AS size,
  coalesce(count(DISTINCT CASE WHEN model IN ({_IN}) THEN protein || '/' || model END) / nullif(count(DISTINCT CASE WHEN model IN ({_IN}) THEN model END), 0), 0.0) AS dup,
  count(DISTINCT CASE WHEN model IN ({_IN}) THEN model END) || '/5' AS ratio FROM hits GROUP BY query""")
def panel_completeness(spark, sf):
    m = aggregate.panel_metrics(hits(spark, sf), ["query"], "model", "protein", _PANEL)
    return m.withColumns({"dup": F.coalesce(F.try_divide("total", "present"), F.lit(0.0)), "ratio": F.concat_ws("/", F.col("present").cast("string"), F.col("size").cast("string"))})


@query(f"""WITH {HITS} SELECT query, CAST(sum(m) AS BIGINT) AS best_sum, count(*) AS n_models FROM (SELECT query, model, max(seq_score) AS m FROM hits GROUP BY ALL) GROUP BY query""")
def sum_of_best_scores(spark, sf):
    return aggregate.max_then_sum(hits(spark, sf), ["query"], "model", "seq_score")


@query(f"""WITH {HITS} SELECT query, {", ".join(f"count(DISTINCT CASE WHEN model = '{p}' THEN protein END) AS {p.replace('#', '_')}" for p in _PANEL)} FROM hits GROUP BY query""")
def model_pivot(spark, sf):
    return aggregate.pivot_zero(hits(spark, sf), "query", "model", _PANEL, "protein")


@query("""SELECT source, count(*) AS contigs, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS bases, CAST(sum(length(coalesce(text, '')) - length(translate(coalesce(text, ''), 'GCgc', ''))) AS BIGINT) AS gc
FROM documents GROUP BY source""")
def sequence_totals(spark, sf):
    return aggregate.sequence_stats(table(spark, sf, "documents"), ["source"], "text")


@query(f"""WITH {HITS} SELECT protein, count(*) AS n, count(*) FILTER (seq_score >= 5000000) AS strong, count(*) FILTER (model LIKE 'Brand#1%') AS cellular, count(*) FILTER (model LIKE 'Brand#2%' AND dom_score >= 25) AS phage
FROM hits GROUP BY protein""")
def contig_class_counts(spark, sf):
    m = F.col("model")
    return aggregate.conditional_counts(
        hits(spark, sf), ["protein"], strong=F.col("seq_score") >= 5_000_000, cellular=m.like("Brand#1%"), phage=m.like("Brand#2%") & (F.col("dom_score") >= 25)
    )


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, median(l_quantity) AS median_l_quantity, median(l_discount) AS median_l_discount FROM lineitem GROUP BY ALL""")
def exact_medians(spark, sf):
    return aggregate.medians(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "l_discount")


_PREV = """counts AS (SELECT n_regionkey AS grp, p_brand AS marker, l_suppkey AS genome, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL),
prev AS (SELECT c.grp, marker, count(DISTINCT genome) AS with_marker, CAST(sum(n) AS BIGINT) AS copies, any_value(g.n_genomes) AS n_genomes FROM counts c JOIN (SELECT grp, count(DISTINCT genome) AS n_genomes FROM counts GROUP BY grp) g ON c.grp = g.grp GROUP BY ALL)"""


def prevalence(spark, sf):
    items = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("marker"))
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").alias("grp"))
    counts = items.join(parts, "l_partkey").join(s, "l_suppkey").groupBy("grp", "marker", F.col("l_suppkey").alias("genome")).agg(F.count("*").alias("n"))
    return aggregate.prevalence(counts, "grp", "marker", "genome", "n")


@query(f"WITH {_PREV} SELECT grp, marker, n_genomes, with_marker, copies, copies / n_genomes AS mean_copy FROM prev")
def marker_prevalence(spark, sf):
    return prevalence(spark, sf)


@query("""SELECT o_custkey, min(o_orderstatus) AS o_orderstatus FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) = 1""")
def functional_dependency(spark, sf):
    return aggregate.single_parent(table(spark, sf, "orders"), "o_custkey", "o_orderstatus")


_LABELLED = "lab AS (SELECT d.doc_id, n_chars, quality, toxic, source FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


def _labelled(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "n_chars", "source").join(table(spark, sf, "labels"), "doc_id")


@query(f"""WITH {_LABELLED}, c AS (SELECT source, count(*) FILTER (quality = 1 AND n_chars >= 1000) AS tp, count(*) FILTER (quality <> 1 AND n_chars >= 1000) AS fp, count(*) FILTER (quality = 1 AND n_chars < 1000) AS fn, count(*) FILTER (quality <> 1 AND n_chars < 1000) AS tn FROM lab GROUP BY source)
SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1 FROM c""")
def confusion_by_source(spark, sf):
    c = aggregate.confusion(_labelled(spark, sf), F.col("quality") == 1, F.col("n_chars") >= 1000, ["source"])
    return aggregate.precision_recall(c)


_GRID = [100.0 * i for i in range(1, 60)]


@query(f"""WITH {_LABELLED}, g AS (SELECT CAST(100 * i AS DOUBLE) AS threshold FROM range(1, 60) t(i)), p AS (SELECT count(*) FILTER (quality = 1) AS pos FROM lab)
SELECT threshold, f1 FROM (SELECT threshold, coalesce(2 * count(*) FILTER (quality = 1) / nullif(count(*) + max(pos), 0), 0.0) AS f1 FROM g, p, lab WHERE n_chars >= threshold GROUP BY threshold) ORDER BY f1 DESC, threshold LIMIT 1""")
def best_f1_threshold(spark, sf):
    return aggregate.best_threshold(_labelled(spark, sf), F.col("quality") == 1, "n_chars", _GRID)


@query(f"""WITH {_LABELLED}, s AS (SELECT n_chars, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality <> 1) AS neg FROM lab GROUP BY n_chars),
b AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY n_chars ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT CAST(sum(pos * (2 * below + neg)) AS BIGINT) / CAST(2 * sum(pos) * sum(neg) AS BIGINT) AS auroc FROM b""")
def auroc(spark, sf):
    return aggregate.auroc(_labelled(spark, sf), F.col("quality") == 1, "n_chars")


@query(f"""WITH {_LABELLED}, s AS (SELECT n_chars, count(*) FILTER (toxic = 1) AS pos, count(*) AS n FROM lab GROUP BY n_chars),
r AS (SELECT pos, sum(pos) OVER (ORDER BY n_chars DESC) AS tp, sum(n) OVER (ORDER BY n_chars DESC) AS called FROM s)
SELECT round(sum(pos * tp / called) / sum(pos), 9) AS average_precision FROM r""")
def average_precision(spark, sf):
    ap = aggregate.average_precision(_labelled(spark, sf), F.col("toxic") == 1, "n_chars")
    return ap.select(F.round("average_precision", 9).alias("average_precision"))


@query("""SELECT l_returnflag, avg(abs(CAST(l_quantity AS BIGINT) - CAST(l_linenumber AS BIGINT))) AS mae, count(*) AS n FROM lineitem GROUP BY ALL""")
def mean_absolute_error(spark, sf):
    items = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_quantity").cast("long").alias("t"), F.col("l_linenumber").cast("long").alias("g"))
    return aggregate.mean_error(items, "t", "g", ["l_returnflag"])


@query("""SELECT o_orderpriority AS level, count(*) AS n, avg(CAST(round(o_totalprice) AS BIGINT)) AS mean, median(o_totalprice) AS median, count(*) FILTER (o_totalprice >= 90000) AS n_high FROM orders GROUP BY ALL""")
def describe_by_level(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("level")).agg(
        F.count("*").alias("n"), F.avg(F.round("o_totalprice").cast("long")).alias("mean"), F.median("o_totalprice").alias("median"), F.count_if(F.col("o_totalprice") >= 90000).alias("n_high")
    )


@query("""SELECT o_orderstatus AS status, count(*) AS n, count(*) * 1.0 / (SELECT count(*) FROM orders) AS share FROM orders GROUP BY ALL""")
def totals_by_status(spark, sf):
    o = table(spark, sf, "orders")
    total = o.agg(F.count("*").alias("t"))
    return o.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n")).join(F.broadcast(total)).select("status", "n", (F.col("n") / F.col("t")).alias("share"))


@query("""SELECT o_custkey, count(*) AS n, CAST(min(z) AS BIGINT) AS lo, CAST(max(z) AS BIGINT) AS hi, CAST(sum(z) AS BIGINT) AS total, avg(z) AS mean FROM (SELECT o_custkey, CAST(round(o_totalprice) AS BIGINT) AS z FROM orders) GROUP BY ALL""")
def fragment_stats(spark, sf):
    z = table(spark, sf, "orders").select("o_custkey", F.round("o_totalprice").cast("long").alias("z"))
    return z.groupBy("o_custkey").agg(F.count("*").alias("n"), F.min("z").alias("lo"), F.max("z").alias("hi"), F.sum("z").alias("total"), F.avg("z").alias("mean"))


@query("""SELECT l_partkey AS label, count(*) AS evidence, count(DISTINCT l_suppkey) AS files, avg(CASE WHEN l_quantity >= 50 THEN 1 ELSE 0 END) AS perfect_share FROM lineitem GROUP BY ALL""")
def evidence_counts(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("label")).agg(
        F.count("*").alias("evidence"), F.count_distinct("l_suppkey").alias("files"), F.avg(F.when(F.col("l_quantity") >= 50, 1).otherwise(0)).alias("perfect_share")
    )


@query("""WITH w AS (SELECT l_suppkey AS k, CAST(l_quantity AS BIGINT) AS w, CAST(l_linenumber AS BIGINT) AS x FROM lineitem)
SELECT k, CAST(sum(w * x) AS BIGINT) / CAST(sum(w) AS BIGINT) AS weighted_mean, CAST(sum(w) AS BIGINT) AS weight FROM w GROUP BY k""")
def weighted_mean(spark, sf):
    w = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").cast("long").alias("w"), F.col("l_linenumber").cast("long").alias("x"))
    return w.groupBy("k").agg((F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("weighted_mean"), F.sum("w").alias("weight"))
