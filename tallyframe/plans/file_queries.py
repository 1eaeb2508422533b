"""Sources, sinks and streams over files that are written from the tables first, in the shared folder."""

from pyspark.sql import functions as F

from tallyframe.functions.scalars import fixed_text
from tallyframe.operators import rank, summary, tree
from tallyframe.operators.staging import shared_path, staged
from tallyframe.plans.base import query, table
from tallyframe.sources import archives, sequences, tables
from tallyframe.streaming import handoff, progress


@query("""SELECT s_nationkey || '.tar' AS archive, s_name || '.summary.tsv' AS member, s_name AS query, CAST(s_suppkey AS VARCHAR) AS key, CASE WHEN s_suppkey % 5 > 0 THEN CAST(s_nationkey AS VARCHAR) END AS nation FROM supplier WHERE s_suppkey % 7 > 0""")
def archive_members(spark, sf):
    """Tables in archives, one for each nation: members without a row, and members of other kinds, are passed over."""
    s = table(spark, sf, "supplier")
    nation = F.when(F.col("s_suppkey") % 5 > 0, F.concat(F.lit("\t"), F.col("s_nationkey").cast("string"))).otherwise("")
    row = F.when(F.col("s_suppkey") % 7 > 0, F.concat(F.col("s_name"), F.lit("\t"), F.col("s_suppkey").cast("string"), nation, F.lit("\n"))).otherwise("")
    tsv = s.select("s_nationkey", F.concat("s_name", F.lit(".summary.tsv")).alias("m"), F.concat(F.lit("query\tkey\tnation\n"), row).alias("c"))
    other = s.select("s_nationkey", F.concat("s_name", F.lit(".log")).alias("m"), F.lit("not a table\nat all\n").alias("c"))
    folder = shared_path(spark, "archives")
    archives.write_archives(tsv.unionByName(other), "s_nationkey", "m", "c", folder).collect()  # a row for each archive
    spark.dataSource.register(archives.TarMembers)
    members = spark.read.format("tar_members").option("suffix", ".summary.tsv").option("rangeBytes", "200").load(folder)
    r = F.col("row")
    return archives.first_rows(members).select(
        F.element_at(F.split("archive", "/"), -1).alias("archive"), "member", r["query"].alias("query"), r["key"].alias("key"), F.try_element_at(r, F.lit("nation")).alias("nation")
    )


@query("""SELECT CAST(user_id AS VARCHAR) AS query, max(value) AS progress, arg_max(event_type, {'at': ts, 'p': value, 's': event_type}) AS stage, bool_or(event_type = 'purchase') AS done, bool_or(event_type = 'error') AS failed FROM events GROUP BY user_id""")
def streamed_progress(spark, sf):
    """Events as lines, folded by a stream with state, handed over in batches with markers, read back at their last stand."""
    path = f"{sf}/events.parquet"
    events = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{sf}/events.parque[t]")  # as a pattern, a file or a folder will do
    kind = F.when(F.col("event_type") == "purchase", "query_complete").when(F.col("event_type") == "error", "query_failed").otherwise("progress")
    told = events.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), kind.alias("event"), F.col("user_id").cast("string").alias("query"), F.col("value").alias("progress"), F.col("event_type").alias("stage"))
    folded = progress.fold(progress.parse_events(handoff.event_lines(told), handoff.PREFIX))
    folder = shared_path(spark, "handoff")
    handoff.publish(folded, folder, f"{folder}-checkpoint", mode="update").awaitTermination()
    return handoff.latest(handoff.published(spark, folder, "query string, progress double, stage string, done boolean, failed boolean"), ["query"])


def _file(spark, rows, name):
    """Lines(value) written as text files and scanned again: (value, path)."""
    path = shared_path(spark, name)
    rows.select("value").write.text(path)
    return tables.scan(spark, path)


def _noise(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


@query("""SELECT 'D' || p_partkey AS label, [p_brand, p_type, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE '' END, '', '', '', ''] AS ranks FROM part""")
def label_file(spark, sf):
    p = table(spark, sf, "part")
    rank = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("|"), "p_name")).otherwise("")
    lines = p.select(F.concat(F.lit("D"), F.col("p_partkey").cast("string"), F.lit("\t"), "p_brand", F.lit("|"), "p_type", rank).alias("value"))
    return tables.labels(_file(spark, lines.unionByName(_noise(spark, "# comment", "", "alone")), "labels"))


_M8 = """m8 AS (SELECT 'q' || l_orderkey AS query, 's' || l_partkey AS subject, l_quantity * 2 + l_tax * 100 AS identity, CAST(l_quantity AS INT) AS length, l_suppkey AS k, l_extendedprice AS score FROM lineitem)"""


def _m8(spark, sf):
    items = table(spark, sf, "lineitem")
    identity = (F.col("l_quantity") * 2 + F.round(F.col("l_tax") * 100)).cast("string")
    wrong = F.when(F.col("l_suppkey") % 17 == 0, "x").when(F.col("l_suppkey") % 19 == 0, "-3").otherwise(identity)
    row = F.concat_ws("\t", F.concat(F.lit("q"), F.col("l_orderkey").cast("string")), F.concat(F.lit("s"), F.col("l_partkey").cast("string")), wrong, F.col("l_quantity").cast("int").cast("string"), *[F.lit("1")] * 6, F.lit("1e-5"), F.col("l_extendedprice").cast("string"))
    cut = F.when(F.col("l_suppkey") % 23 == 0, F.substring_index(row, "\t", 9)).otherwise(row)
    return _file(spark, items.select(cut.alias("value")).unionByName(_noise(spark, "# fields", "")), "m8")


@query(f"""WITH {_M8} SELECT query, subject, identity, length, score FROM (SELECT * REPLACE (round(identity, 0) AS identity) FROM m8) WHERE k % 17 <> 0 AND k % 19 <> 0 AND k % 23 <> 0 AND identity BETWEEN 30 AND 100""")
def similarity_file(spark, sf):
    return tables.similarity_hits(_m8(spark, sf)).select("query", "subject", "identity", "length", "score")


@query(f"""WITH {_M8} SELECT count(*) AS lines, count(*) FILTER (k % 23 = 0) AS short, count(*) FILTER (k % 23 <> 0 AND k % 17 = 0) AS not_numeric, count(*) FILTER (k % 23 <> 0 AND k % 17 <> 0 AND (k % 19 = 0 OR round(identity, 0) > 100)) AS out_of_range FROM m8""")
def similarity_file_audit(spark, sf):
    return tables.similarity_audit(_m8(spark, sf))


@query("""SELECT 't' || l_orderkey AS target, p_brand AS model, 60 AS model_len, l_extendedprice AS score, l_quantity AS dom_score, 1 AS model_from, CAST(l_quantity AS INT) AS model_to FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_suppkey % 9 > 0 AND l_suppkey % 8 > 0""")
def domain_file(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    score = F.when(F.col("l_suppkey") % 8 == 0, "nan?").otherwise(F.col("l_extendedprice").cast("string"))
    f = [F.concat(F.lit("t"), F.col("l_orderkey").cast("string")), "-", "100", "p_brand", "-", "60", "1e-9", score, "0.1", "1", "1", "1e-9", "1e-9", F.col("l_quantity").cast("string"), "0.0", "1", F.col("l_quantity").cast("int").cast("string"), "1", "90", "1", "90", "0.9", "a  description"]
    line = F.concat_ws("  ", *(x if not isinstance(x, str) or x == "p_brand" else F.lit(x) for x in f))
    cut = F.when(F.col("l_suppkey") % 9 == 0, F.substring_index(line, "  ", 12)).otherwise(line)
    return tables.long_hits(_file(spark, rows.select(cut.alias("value")).unionByName(_noise(spark, "# target", "")), "domains"))


@query("""WITH n AS (SELECT p_brand AS marker, 'p' || l_orderkey AS protein, 'n' || l_partkey AS neighbor, l_discount AS d, l_suppkey AS k FROM lineitem JOIN part ON l_partkey = p_partkey) SELECT marker, protein, neighbor, max(d) AS distance FROM n WHERE k % 13 > 0 GROUP BY ALL""")
def neighbour_file(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    distance = F.when(F.col("l_suppkey") % 13 == 0, "far").otherwise(F.col("l_discount").cast("string"))
    line = F.concat_ws("\t", "p_brand", F.concat(F.lit("p"), F.col("l_orderkey").cast("string")), F.concat(F.lit("n"), F.col("l_partkey").cast("string")), distance)
    return tables.neighbours(_file(spark, rows.select(line.alias("value")).unionByName(_noise(spark, "marker\tquery\tneighbor\tdistance", "#", "a\tb")), "tree-nn"))


@query("""WITH g AS (SELECT 'g' || p_size AS grp, list(DISTINCT p_brand) AS m, CASE p_size % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'REVIEW_mixed' ELSE 'curated' END AS flag FROM part GROUP BY p_size)
SELECT grp AS "group", unnest(m) AS model FROM g WHERE flag <> 'REVIEW_mixed' AND len(m) >= 2""")
def marker_group_file(spark, sf):
    groups = table(spark, sf, "part").groupBy("p_size").agg(F.array_join(F.collect_set("p_brand"), ";").alias("m"))
    flag = F.when(F.col("p_size") % 3 == 0, "ok").when(F.col("p_size") % 3 == 1, "REVIEW_mixed").otherwise("curated")
    line = F.concat_ws("\t", F.concat(F.lit("g"), F.col("p_size").cast("string")), *[F.lit("x")] * 5, flag, F.concat("m", F.lit(";")))
    lines = groups.select(line.alias("value")).unionByName(_noise(spark, "group_name\ta\tb\tc\td\te\tflag\tmembers", "# note", "short\trow", "one\tx\tx\tx\tx\tx\tok\tonly;"))
    return tables.marker_groups(_file(spark, lines, "groups"), ["ok", "curated"])


# a file for each region, one of them broken
@query("""SELECT r_name AS name, count(*) AS nations, min(n_name) AS first FROM region JOIN nation ON n_regionkey = r_regionkey WHERE r_regionkey <> 3 GROUP BY r_name""")
def status_files(spark, sf):
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = nation.groupBy("r_regionkey", "r_name").agg(F.count("*").alias("nations"), F.min("n_name").alias("first"))
    text = F.to_json(F.struct(F.col("r_name").alias("name"), "nations", "first"))
    path = shared_path(spark, "status")
    broken = F.when(F.col("r_regionkey") == 3, F.substring(text, 1, 12)).otherwise(text)
    rows.select("r_regionkey", broken.alias("value")).repartition("r_regionkey").write.partitionBy("r_regionkey").text(path)
    return tables.json_files(spark, "name string, nations long, first string", f"{path}/*").drop("path", "r_regionkey")


@query("""SELECT 'P' || p_partkey || ' ' || p_name AS description, 'P' || p_partkey AS id, CAST(length(p_type) * 40 AS INT) AS n, sha256(repeat(p_type, 40)) AS digest FROM part""")
def sequence_files(spark, sf):
    p = table(spark, sf, "part")
    path = shared_path(spark, "sequences")
    named = F.concat_ws(" ", F.concat(F.lit("P"), F.col("p_partkey").cast("string")), "p_name")
    sequences.write_fasta(p.select(named.alias("name"), F.repeat("p_type", 40).alias("seq")), path, "name", "seq")
    read = sequences.read_fasta(spark, path)
    heads = sequences.read_headers(spark, path).select("id")
    return read.join(heads, "id").select("description", "id", F.length("seq").alias("n"), F.sha2("seq", 256).alias("digest"))


# a tree for each region: suppliers below nations
@query("""SELECT r_name AS tree, s_name AS leaf, (s_suppkey % 7 + n_nationkey + 1) * 1.0 AS depth FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def tree_files(spark, sf):
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    leaf = F.concat("s_name", F.lit(":"), (F.col("s_suppkey") % 7).cast("string"))
    below = rows.groupBy("r_name", "n_nationkey").agg(F.concat(F.lit("("), F.array_join(F.collect_list(leaf), ","), F.lit("):"), F.col("n_nationkey").cast("string")).alias("c"))
    text = below.groupBy("r_name").agg(F.concat(F.lit("(("), F.array_join(F.collect_list("c"), ","), F.lit("):1,(lost;")).alias("broken"), F.concat(F.lit("(("), F.array_join(F.collect_list("c"), ","), F.lit("):1);")).alias("value"))
    path = shared_path(spark, "trees")
    both = text.select("r_name", "value").unionByName(text.select(F.concat(F.lit("no "), "r_name").alias("r_name"), F.col("broken").alias("value")))
    both.repartition("r_name").write.partitionBy("r_name").text(path)
    raw = spark.read.option("wholetext", True).option("basePath", path).text(f"{path}/*").select(F.col("r_name").alias("tree"), F.col("value").alias("newick"))
    e = staged(tree.edges_of(raw, "tree", "newick"), "edges")
    roots = e.where("parent is null").select("tree", F.col("node").alias("ancestor"))
    return tree.ancestors(e).join(roots, ["tree", "ancestor"]).join(e.where("leaf is not null").select("tree", "node", "leaf"), ["tree", "node"]).select("tree", "leaf", F.col("dist").alias("depth"))


_SUMMARY = """s AS (SELECT 'q' || s_suppkey AS query, s_acctbal AS balance, CASE WHEN s_suppkey % 4 > 0 THEN n_name END AS nation, CASE s_suppkey % 10 WHEN 7 THEN 'failed' WHEN 8 THEN NULL ELSE 'complete' END AS status, s_suppkey AS size FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def _summary(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    status = F.when(F.col("s_suppkey") % 10 == 7, "failed").when(F.col("s_suppkey") % 10 == 8, F.lit(None)).otherwise("complete")
    return s.select(F.concat(F.lit("q"), F.col("s_suppkey").cast("string")).alias("query"), F.col("s_acctbal").alias("balance"), F.when(F.col("s_suppkey") % 4 > 0, F.col("n_name")).alias("nation"), status.alias("status"), F.col("s_suppkey").alias("size"))


@query(f"""WITH {_SUMMARY} SELECT query, printf('%.2f', balance) AS balance, coalesce(nation, 'nd') AS nation, CAST(size AS VARCHAR) AS size FROM s WHERE status = 'complete'""")
def summary_files(spark, sf):
    """The complete rows, rendered, as a table of tabs and one of commas; each half is read back from one of them."""
    complete, _ = summary.split_failed(_summary(spark, sf))
    shown = summary.rendered(complete.drop("status"), ["balance"], {"nation": "nd"})
    path = shared_path(spark, "summary")
    summary.write_table(shown, f"{path}.tsv", "\t", "query")
    summary.write_table(shown, f"{path}.csv", ",", "query")
    back = [summary.read_table(spark, f"{path}.tsv", "\t").where("size % 2 = 0"), summary.read_table(spark, f"{path}.csv", ",").where("size % 2 = 1")]
    return summary.combine(back)


@query(f"""WITH {_SUMMARY} SELECT query, coalesce(status, '') AS status, 'no result' AS error FROM s WHERE status IS DISTINCT FROM 'complete'""")
def failed_report(spark, sf):
    _, failed = summary.split_failed(_summary(spark, sf))
    path = shared_path(spark, "failed")
    summary.write_table(failed.select("query", "status", F.lit("no result").alias("error")), path, "\t", "query")
    return summary.read_table(spark, path, "\t")


@query("""WITH b AS (SELECT s_suppkey AS bin, CASE s_suppkey % 5 WHEN 0 THEN 'clean' WHEN 1 THEN 'uncertain' WHEN 2 THEN 'cellular' ELSE 'mixed_viral' END AS type, s_acctbal AS estimate FROM supplier),
c AS (SELECT l_suppkey AS bin, 'c' || l_orderkey AS contig, CASE WHEN max(l_quantity) >= 45 THEN 'cellular_hits' END AS reason, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT CAST(bin AS VARCHAR) AS bin, contig, reason, CAST(n AS VARCHAR) AS n, type, printf('%.2f', estimate) AS estimate FROM c JOIN b USING (bin) WHERE reason IS NOT NULL AND type NOT IN ('clean', 'uncertain')""")
def candidate_file(spark, sf):
    kind = F.expr("case s_suppkey % 5 when 0 then 'clean' when 1 then 'uncertain' when 2 then 'cellular' else 'mixed_viral' end")
    bins = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("bin"), kind.alias("type"), F.col("s_acctbal").alias("estimate"))
    found = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("bin"), F.concat(F.lit("c"), F.col("l_orderkey").cast("string")).alias("contig")).agg(F.when(F.max("l_quantity") >= 45, "cellular_hits").alias("reason"), F.count("*").alias("n"))
    path = shared_path(spark, "candidates")
    summary.write_table(summary.rendered(summary.candidate_table(found, bins), ["estimate"]), path, "\t", "bin")
    return summary.read_table(spark, path, "\t")


_UPDATES = """u AS (SELECT o_custkey AS key, CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'running' ELSE 'failed' END AS status, o_orderdate AS ts, CASE o_orderstatus WHEN 'O' THEN 1 ELSE 2 END AS o FROM orders),
m AS (SELECT key, max({'o': o, 'ts': ts, 'status': status}) AS m FROM (SELECT * FROM u UNION ALL SELECT c_custkey, 'pending', TIMESTAMP '1990-01-01', 0 FROM customer) GROUP BY key)"""


def _manifest(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "complete").when(F.col("o_orderstatus") == "O", "running").otherwise("failed")
    updates = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), status.alias("status"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"))
    start = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.lit("pending").alias("status"), F.lit("1990-01-01 00:00:00").cast("timestamp_ntz").alias("at"))
    return progress.advance(start, updates, "key")


@query(f"""WITH {_UPDATES} SELECT key, m.status AS status FROM m""")
def manifest_states(spark, sf):
    return _manifest(spark, sf).select("key", "status")


@query(f"""WITH {_UPDATES} SELECT count(*) AS total, count(*) FILTER (m.status = 'complete') AS complete, count(*) FILTER (m.status = 'failed') AS failed, count(*) FILTER (m.status IN ('complete', 'failed')) AS done, count(*) FILTER (m.status = 'running') AS running FROM m""")
def manifest_totals(spark, sf):
    return progress.totals(_manifest(spark, sf))


@query(f"""WITH {_UPDATES} SELECT c_custkey AS key, md5(c_name) AS checksum FROM customer LEFT JOIN m ON key = c_custkey WHERE NOT (m.status = 'complete' AND c_custkey % 11 > 0)""")
def pending_inputs(spark, sf):
    """Inputs to run again: those without a complete row, and those that were changed since."""
    inputs = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.md5(F.col("c_name").cast("binary")).alias("checksum"))
    known = _manifest(spark, sf).join(inputs, "key").withColumn("checksum", F.when(F.col("key") % 11 == 0, "old").otherwise(F.col("checksum")))
    return progress.pending(inputs, known, "key", "checksum")


# one tree: leaves of part 1 to 127, every third a query
@query("""WITH RECURSIVE e AS (SELECT CAST(p_partkey AS INT) AS node, CASE WHEN p_partkey > 1 THEN CAST(p_partkey // 2 AS INT) END AS parent, p_size * 1.0 AS length FROM part WHERE p_partkey BETWEEN 1 AND 127), up AS (SELECT node, node AS a, 0.0::DOUBLE AS d, parent, length FROM e UNION ALL
  SELECT up.node, e.node, up.d + up.length, e.parent, e.length FROM up JOIN e ON e.node = up.parent),
d AS (SELECT x.node AS q, y.node AS r, min(x.d + y.d) AS dist FROM up x JOIN up y USING (a) WHERE x.node >= 64 AND y.node >= 64 AND x.node % 4 = 0 AND y.node % 4 > 0 GROUP BY ALL),
n AS (SELECT q, arg_min(r, {'k': round(dist, 9), 'r': r}) AS r, min(dist) AS dist FROM d GROUP BY q)
SELECT 'L' || lpad(CAST(q AS VARCHAR), 3, '0') AS query, 'L' || lpad(CAST(r AS VARCHAR), 3, '0') AS nn_genome, 'unknown' AS nn_taxonomy, printf('%.6f', dist) AS nn_distance, '' AS clade_id, '' AS clade_members, '' AS clade_mean_dist, '' AS clade_ref_dist FROM n""")
def placement_file(spark, sf):
    """Lone queries' placements as the taxonomy table, written and read back."""
    p = table(spark, sf, "part").where("p_partkey between 1 and 127")
    node = F.col("p_partkey").cast("int")
    leaf = F.when(node >= 64, F.concat(F.lit("L"), F.lpad(node.cast("string"), 3, "0")))
    e = p.select(F.lit("t").alias("tree"), node.alias("node"), F.when(node > 1, F.expr("cast(p_partkey div 2 as int)")).alias("parent"), (F.col("p_size") * 1.0).cast("double").alias("length"), leaf.alias("leaf"))
    asked = e.where("leaf is not null and node % 4 = 0").select("tree", "leaf")
    none = spark.createDataFrame([], "leaf string, taxonomy string")
    path = shared_path(spark, "placements")
    summary.write_table(summary.placement_table(tree.placements(e, asked, none)), path, "\t", "query")
    return summary.read_table(spark, path, "\t")


@query("""WITH c AS (SELECT l_suppkey AS q, l_linenumber AS code, count(*) AS genes, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bases, CAST(count(*) % 5 AS BIGINT) AS hits, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) / 1000.0 AS density FROM lineitem GROUP BY ALL)
SELECT CAST(q AS VARCHAR) AS q, CAST(row_number() OVER (PARTITION BY q ORDER BY hits DESC, bases DESC, code) AS VARCHAR) AS place, CAST(code AS VARCHAR) AS ttable, CAST(genes AS VARCHAR) AS genes, CAST(bases AS VARCHAR) AS bases, printf('%.3f', density) AS density, CAST(hits AS VARCHAR) AS complete FROM c""")
def gene_call_table(spark, sf):
    """Codes of each query, the best first, as a table of text, written and read back."""
    total = F.sum(F.col("l_quantity").cast("long"))
    c = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("q"), F.col("l_linenumber").alias("ttable")).agg(F.count("*").alias("genes"), total.alias("bases"), (F.count("*") % 5).alias("complete"), (total / 1000.0).alias("density"))
    placed = rank.ordinal(c, ["q"], [F.desc("complete"), F.desc("bases"), F.asc("ttable")], "place")
    shown = placed.select("q", "place", "ttable", "genes", "bases", fixed_text(F.col("density"), 3).alias("density"), "complete")
    path = shared_path(spark, "gene-calls")
    summary.write_table(summary.rendered(shown, []), path, "\t", "q")
    return summary.read_table(spark, path, "\t")


@query("""SELECT 'D' || p_partkey AS label, [coalesce(CASE WHEN p_partkey % 3 > 0 THEN p_brand END, ''), p_type, '', '', '', '', ''] AS ranks FROM part""")
def label_store(spark, sf):
    """Labels of the Parquet store as lines, blanks for nulls, written and scanned."""
    p = table(spark, sf, "part").select(F.concat(F.lit("D"), F.col("p_partkey").cast("string")).alias("label"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_brand")).alias("r1"), F.col("p_type").alias("r2"))
    return tables.labels(_file(spark, tables.label_lines(staged(p, "labels"), "label", ["r1", "r2"]), "label-lines"))
