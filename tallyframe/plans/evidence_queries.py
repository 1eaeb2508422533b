"""Contigs judged by their proteins, and labels put in order."""

from pyspark.sql import functions as F

from tallyframe.operators import contigs, harmonize
from tallyframe.plans.base import query, table

# bins are suppliers; proteins carry their contig but in bins of remainder 0 by 4, where each is its own; every third bin has called genes
_DOMAINS = ["BAC", "ARC", "EUK", "PHAGE", "PLV", "NCLDV", "MIRUS"]
_PICK = "['BAC', 'ARC', 'EUK', 'PHAGE', 'PLV', 'NCLDV', 'MIRUS'][{} + 1]"
_ROWS = f"""src AS (SELECT l_suppkey AS bin, l_orderkey * 10 + l_linenumber AS protein, CAST(CASE WHEN l_suppkey % 4 = 0 THEN l_orderkey * 10 + l_linenumber ELSE l_orderkey % 23 END AS VARCHAR) AS contig, p_brand AS model,
  {_PICK.format("CAST(CASE WHEN l_partkey % 29 = 0 THEN l_partkey % 7 ELSE (l_orderkey % 23) % 7 END AS BIGINT)")} AS domain, 'o' || (l_orderkey % 23) % 7 || CASE WHEN l_partkey % 4 = 0 THEN 'x' ELSE '' END AS "order", p_type AS genus,
  50.0 + l_quantity AS identity, l_extendedprice / 100 AS score, l_partkey AS k FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber <= 3 AND l_orderkey % 23 < 15),
hit AS (SELECT bin, protein, domain, "order", identity, score FROM (SELECT *, row_number() OVER (PARTITION BY bin, protein ORDER BY score DESC, identity DESC, domain, "order") AS rn FROM src) WHERE rn = 1),
bearing AS (SELECT DISTINCT bin, protein, contig FROM src), votes AS (SELECT bin, protein, domain, "order", genus FROM src UNION ALL SELECT bin, protein, domain, "order", 'g' FROM src WHERE k % 2 = 0),
lineage AS (SELECT bin, protein, domain, "order" FROM (SELECT *, row_number() OVER (PARTITION BY bin, protein ORDER BY n DESC, domain, "order", genus) AS rn FROM (SELECT bin, protein, domain, "order", genus, count(*) AS n FROM votes GROUP BY ALL)) WHERE rn = 1),
bins AS (SELECT DISTINCT l_suppkey AS bin, CASE WHEN l_suppkey % 3 = 0 THEN 'fna' ELSE 'faa' END AS kind FROM lineitem),
modes AS (SELECT bin, coalesce(n, 0) AS n_proteins, CASE WHEN kind = 'fna' THEN 'fna_gene_calling' WHEN n IS NULL OR (n >= 5 AND d / n >= 0.8) THEN 'faa_weak_per_protein' ELSE 'faa_contig_encoded' END AS mode
  FROM bins LEFT JOIN (SELECT bin, count(*) AS n, count(DISTINCT contig) AS d FROM bearing GROUP BY bin) USING (bin)),
pr AS (SELECT b.bin, b.contig, b.protein, l.domain, l."order", CASE WHEN l.domain IN ('BAC', 'ARC', 'EUK') AND h.domain IN ('BAC', 'ARC', 'EUK') THEN h.identity END AS identity FROM bearing b LEFT JOIN lineage l USING (bin, protein) LEFT JOIN hit h USING (bin, protein)),
tops AS (SELECT bin, contig, max(n) AS top FROM (SELECT bin, contig, domain, "order", count(*) AS n FROM pr WHERE domain IN ('BAC', 'ARC', 'EUK') GROUP BY ALL) GROUP BY ALL),
p0 AS (SELECT bin, contig, count(*) AS n_proteins, count(*) FILTER (domain IN ('PHAGE', 'PLV', 'NCLDV', 'MIRUS')) AS n_viral, count(*) FILTER (domain IN ('BAC', 'ARC', 'EUK')) AS n_cellular, coalesce(median(identity), 0.0) AS median_identity FROM pr GROUP BY ALL),
p1 AS (SELECT p0.*, CASE WHEN n_viral = 0 AND n_cellular >= 3 THEN top / n_cellular ELSE 0.0 END AS purity FROM p0 LEFT JOIN tops USING (bin, contig)),
purity AS (SELECT *, CASE WHEN n_viral >= 1 THEN 'viral_bearing' WHEN n_cellular >= 3 AND purity >= 0.6 AND median_identity >= 70 THEN 'cellular_coherent' ELSE 'ambiguous' END AS class FROM p1)"""


def _evidence(spark, sf):
    items = table(spark, sf, "lineitem").where("l_linenumber <= 3 and l_orderkey % 23 < 15")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    place = F.col("l_orderkey") % 23
    protein = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    pick = F.when(F.col("l_partkey") % 29 == 0, F.col("l_partkey") % 7).otherwise(place % 7)
    src = items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("bin"), protein.alias("protein"), F.when(F.col("l_suppkey") % 4 == 0, protein).otherwise(place).cast("string").alias("contig"), F.col("p_brand").alias("model"),
        F.element_at(F.array(*(F.lit(d) for d in _DOMAINS)), (pick + 1).cast("int")).alias("domain"),
        F.concat(F.lit("o"), (place % 7).cast("string"), F.when(F.col("l_partkey") % 4 == 0, "x").otherwise("")).alias("order"), F.col("p_type").alias("genus"),
        (F.col("l_quantity") + 50.0).alias("identity"), (F.col("l_extendedprice") / 100).alias("score"), F.col("l_partkey").alias("k"),
    )
    hits = contigs.best_hits(src.select("bin", "protein", "domain", "order", "identity", "score"))
    bearing = src.select("bin", "protein", "contig").distinct()
    votes = src.select("bin", "protein", "domain", "order", "genus").unionByName(src.where("k % 2 = 0").select("bin", "protein", "domain", "order", F.lit("g").alias("genus")))
    kind = F.when(F.col("l_suppkey") % 3 == 0, "fna").otherwise("faa")
    bins = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("bin"), kind.alias("kind")).distinct()
    return src, hits, bearing, votes, bins


@query(f"WITH {_ROWS} SELECT bin, contig, n_proteins, n_viral, n_cellular, purity, median_identity, class FROM purity")
def contig_lineage_purity(spark, sf):
    _, hits, bearing, votes, _ = _evidence(spark, sf)
    return contigs.contig_purity(bearing, votes, hits)


@query(f"WITH {_ROWS} SELECT bin, n_proteins, mode FROM modes")
def contig_attribution(spark, sf):
    _, _, bearing, _, bins = _evidence(spark, sf)
    return contigs.attribution(bins, bearing)


# contigs are 1,000 bases and 10 more for each protein; markers' kinds go by model
@query(f"""WITH {_ROWS}, contig AS (SELECT bin, contig, 1000 + 10 * count(*) AS length FROM bearing GROUP BY ALL), own AS (SELECT DISTINCT bin, 'o' || bin % 7 AS "order" FROM bins),
mk AS (SELECT bin, contig, count(*) FILTER (kind = 'c') AS cm, count(*) FILTER (kind = 'p') AS pm, count(*) FILTER (kind = 'v') AS vm FROM (SELECT DISTINCT bin, contig, model, CASE WHEN model IN ('Brand#1', 'Brand#2') THEN 'c' WHEN model IN ('Brand#3', 'Brand#4') THEN 'p' ELSE 'v' END AS kind
  FROM src WHERE k % 5 = 0) GROUP BY ALL),
st AS (SELECT b.bin, contig, count(*) AS strong, count(*) FILTER (domain IN ('BAC', 'ARC', 'EUK')) AS ch, count(*) FILTER (domain IN ('PHAGE', 'PLV')) AS ph, count(*) FILTER (domain IN ('NCLDV', 'MIRUS')) AS vh,
  count(*) FILTER (domain IN ('NCLDV', 'MIRUS') AND h."order" <> own."order") AS fv FROM bearing b JOIN hit h USING (bin, protein) JOIN own USING (bin) WHERE identity >= 60 AND score >= 80 GROUP BY ALL),
j AS (SELECT c.bin, c.contig, length, coalesce(ch, 0) AS ch, coalesce(ph, 0) AS ph, coalesce(vh, 0) AS vh, coalesce(fv, 0) AS fv, coalesce(cm, 0) AS cm, coalesce(pm, 0) AS pm, coalesce(vm, 0) AS vm, coalesce((ch + ph) / nullif(strong, 0), 0) AS nonviral,
  coalesce(fv / nullif(vh, 0), 0) AS fshare, m.mode <> 'faa_weak_per_protein' AND m.n_proteins >= 5 AS act, p.class FROM contig c JOIN modes m USING (bin) LEFT JOIN st USING (bin, contig) LEFT JOIN mk USING (bin, contig) LEFT JOIN purity p USING (bin, contig)),
r AS (SELECT *, CASE WHEN act AND class = 'cellular_coherent' THEN 'cellular_coherent_lineage' WHEN NOT act AND cm >= 2 THEN 'cellular_markers' WHEN NOT act AND ch >= 3 AND nonviral >= 0.5 AND vm <= 1 THEN 'cellular_hits'
  WHEN pm >= 2 AND vm <= 1 THEN 'phage_markers' WHEN ph >= 3 AND nonviral >= 0.5 AND vm <= 1 THEN 'phage_hits' WHEN fv >= 2 AND fshare >= 0.6 AND vm >= 2 THEN 'viral_mixture' END AS reason FROM j),
f AS (SELECT bin, count(*) AS contigs, count(reason) AS suspicious, sum(length) AS bp, coalesce(sum(length) FILTER (reason IS NOT NULL), 0) AS odd, count(*) FILTER (p.class = 'cellular_coherent') AS co, sum(n_proteins) FILTER (p.class = 'cellular_coherent') AS held,
  sum(length) FILTER (p.class = 'cellular_coherent') AS own, median(purity) FILTER (p.class = 'cellular_coherent') AS pur, median(median_identity) FILTER (p.class = 'cellular_coherent' AND median_identity > 0) AS ide, count(*) FILTER (p.class = 'viral_bearing') AS vb
  FROM r LEFT JOIN purity p USING (bin, contig) GROUP BY bin)
SELECT bin, mode, n_proteins, a AS active, coalesce(contigs, 0) AS contigs, coalesce(suspicious, 0) AS suspicious, coalesce(round(odd / bp * 100, 2), 0.0) AS suspicious_bp, CASE WHEN a THEN co ELSE 0 END AS coherent, CASE WHEN a THEN coalesce(round(held / n_proteins * 100, 2), 0.0) ELSE 0.0 END AS coherent_proteins,
  CASE WHEN a THEN coalesce(round(own / bp * 100, 2), 0.0) ELSE 0.0 END AS coherent_bp, CASE WHEN a THEN coalesce(round(pur, 4), 0.0) ELSE 0.0 END AS purity, CASE WHEN a THEN coalesce(round(ide, 2), 0.0) ELSE 0.0 END AS identity, CASE WHEN a THEN vb ELSE 0 END AS viral_bearing
FROM (SELECT *, mode <> 'faa_weak_per_protein' AND n_proteins >= 5 AS a FROM modes) LEFT JOIN f USING (bin)""")
def bin_contig_features(spark, sf):
    src, hits, bearing, votes, bins = _evidence(spark, sf)
    modes, purity = contigs.attribution(bins, bearing), contigs.contig_purity(bearing, votes, hits)
    lengths = bearing.groupBy("bin", "contig").agg((F.count("*") * 10 + 1000).alias("length"))
    kind = F.when(F.col("model").isin("Brand#1", "Brand#2"), "cellular").when(F.col("model").isin("Brand#3", "Brand#4"), "phage").otherwise("viral")
    markers = src.where("k % 5 = 0").select("bin", "contig", "model", kind.alias("kind"))
    primary = bins.select("bin", F.concat(F.lit("o"), (F.col("bin") % 7).cast("string")).alias("order"))
    judged = contigs.suspicious(contigs.contig_evidence(lengths, bearing, hits, markers, primary), purity, modes)
    return contigs.bin_features(modes, purity, judged)


# labels of parts: a domain by key, ranks by key and place, evidence by size
_LABEL_DOMAINS = ["MIRUS", "NCLDV", "PLV", "VP", "EUK", "PHAGE"]
_CHOICE = """CASE (p_partkey // 6 + {i} * 5) % 9 WHEN 0 THEN d WHEN 1 THEN 'unclassified' WHEN 2 THEN 'MCP in ' || p_name WHEN 3 THEN d || '_unclassified' WHEN 4 THEN ' NA ' WHEN 5 THEN 'unclassified ' || p_name WHEN 6 THEN d || '__' || p_brand ELSE p_brand END"""
_LABELS = f"""src AS (SELECT *, CASE WHEN p_partkey % 6 = 5 OR p_partkey % 60 = 2 THEN 'GCA-' || p_partkey // 6 ELSE CAST(p_partkey AS VARCHAR) END AS x, ['MIRUS', 'NCLDV', 'PLV', 'VP', 'EUK', 'PHAGE'][p_partkey % 6 + 1] AS d FROM part),
lab AS (SELECT d || '__' || x AS label, d, x, p_size >= 20 AS ev, [d, {_CHOICE.format(i=1)}, {_CHOICE.format(i=2)}, {_CHOICE.format(i=3)}, {_CHOICE.format(i=4)}, {_CHOICE.format(i=5)}, CASE WHEN p_partkey % 5 = 0 THEN d WHEN p_partkey % 11 = 0 THEN 'MCP in ' || p_type
  WHEN p_partkey % 7 = 0 THEN 'Unknown' ELSE p_name END] AS r FROM src),
formal AS (SELECT p_name AS species, ['Phylum ' || p_name, '', min(p_brand), 'f', 'g', p_name] AS ranks, CAST(min(p_partkey) AS VARCHAR) AS taxid FROM part GROUP BY p_name HAVING min(p_partkey) % 2 = 0)"""
_BARE = "(u[{i}] IN (d, 'unclassified', d || '_unclassified') OR (starts_with(u[{i}], 'MCP in ') AND d <> 'NCLDV'))"
_T = "trim(up[{i}])"
_EMPTY = f"(lower({_T}) IN ('', 'na', 'unknown', 'unclassified') OR {_T} = d)"
_OTHER = f"(starts_with(lower({_T}), 'unclassified ') OR starts_with({_T}, d || '__') OR starts_with({_T}, 'MCP in '))"
_MID = ", ".join(f"CASE WHEN {_EMPTY} OR {_OTHER} THEN d || '_unclassified' ELSE {_T} END".format(i=i) for i in range(2, 7))
_NOTES = " UNION ALL ".join(f"SELECT label, 'context', {_T}, '{harmonize.RANKS[i - 1]}' FROM a2 WHERE {_OTHER} AND NOT {_EMPTY}".format(i=i) for i in range(2, 7))


@query(f"""WITH {_LABELS}, br AS (SELECT p.label AS pl, v.label AS vl, 'VP__' || p.x AS c, p.r AS pr, v.r AS vr FROM lab p JOIN lab v ON p.x = v.x AND p.d = 'PHAGE' AND v.d = 'PLV' AND starts_with(p.x, 'GCA-') WHERE p.ev),
gone AS (SELECT pl AS label FROM br UNION SELECT vl FROM br),
al AS (SELECT label, a FROM lab JOIN (SELECT r, count(*) FILTER (ev) AS n, max(label) FILTER (ev) AS a FROM lab GROUP BY r) t USING (r) WHERE NOT ev AND n = 1 AND label NOT IN (SELECT label FROM gone) AND a NOT IN (SELECT label FROM gone)),
a0 AS (SELECT label, d, x, r, f.taxid, f.ranks IS NOT NULL AND list_concat(['EUK'], list_transform(f.ranks, lambda z: CASE WHEN z = '' THEN 'EUK_unclassified' ELSE z END)) <> r AS swap,
  CASE WHEN f.ranks IS NOT NULL THEN list_concat(['EUK'], list_transform(f.ranks, lambda z: CASE WHEN z = '' THEN 'EUK_unclassified' ELSE z END)) ELSE r END AS u FROM lab LEFT JOIN formal f ON d = 'EUK' AND f.species = r[7] WHERE ev AND label NOT IN (SELECT label FROM gone)),
a2 AS (SELECT *, [d, CASE WHEN {_BARE.format(i=2)} AND d IN ('MIRUS', 'NCLDV', 'PLV', 'VP') THEN CASE d WHEN 'MIRUS' THEN 'Mirusviricota' WHEN 'NCLDV' THEN 'Nucleocytoviricota' ELSE 'Preplasmiviricota' END ELSE u[2] END,
  CASE WHEN {_BARE.format(i=3)} AND d IN ('PLV', 'VP') THEN CASE d WHEN 'PLV' THEN 'Polintoviricetes' ELSE 'Maveriviricetes' END ELSE u[3] END, u[4], u[5], u[6], u[7]] AS up FROM a0),
a3 AS (SELECT label, [d, {_MID}, CASE WHEN starts_with(u[7], 'MCP in ') THEN x WHEN u[7] = d OR lower(u[7]) IN ('', 'na', 'unknown', 'unclassified') THEN d || '_unclassified' ELSE u[7] END] AS ranks FROM a2)
SELECT label, 'active' AS kind, array_to_string(ranks, '|') AS value, '' AS detail FROM a3 UNION ALL {_NOTES}
UNION ALL SELECT label, 'context', u[2], 'phylum' FROM a2 WHERE starts_with(u[2], 'MCP in ') AND u[2] <> up[2] UNION ALL SELECT label, 'context', u[3], 'class' FROM a2 WHERE starts_with(u[3], 'MCP in ') AND u[3] <> up[3]
UNION ALL SELECT label, 'context', u[7], 'species' FROM a2 WHERE starts_with(u[7], 'MCP in ')
UNION ALL SELECT label, 'context', array_to_string(r, '|'), 'original_taxonomy' FROM a2 WHERE swap UNION ALL SELECT label, 'context', taxid, 'ncbi_taxid' FROM a2 WHERE swap UNION ALL SELECT label, 'context', 'species', 'ncbi_terminal_rank' FROM a2 WHERE swap
UNION ALL SELECT label, 'alias', a, 'duplicate_taxonomy_without_faa' FROM al UNION ALL SELECT label, 'inactive', array_to_string(r, '|'), 'no_faa_evidence' FROM lab WHERE NOT ev AND label NOT IN (SELECT label FROM gone) AND label NOT IN (SELECT label FROM al)
UNION ALL SELECT pl, 'alias', c, 'phage_virophage_relabel' FROM br UNION ALL SELECT vl, 'alias', c, 'plv_virophage_alias' FROM br
UNION ALL SELECT c, 'context', array_to_string(pr, '|'), 'original_phage_taxonomy' FROM br UNION ALL SELECT c, 'context', array_to_string(vr, '|'), 'original_plv_taxonomy' FROM br
UNION ALL SELECT DISTINCT c, 'active', array_to_string(CASE WHEN vr[2] = 'Preplasmiviricota' AND vr[3] = 'Maveriviricetes' THEN list_concat(['VP'], vr[2:]) ELSE ['VP', 'Preplasmiviricota', 'Maveriviricetes', 'VP_unclassified', 'VP_unclassified', 'VP_unclassified', regexp_replace(pr[7], '^PHAGE__', '')] END, '|'), '' FROM br""")
def harmonized_labels(spark, sf):
    p = table(spark, sf, "part")
    k, sixth = F.col("p_partkey"), F.expr("p_partkey div 6")
    d = F.element_at(F.array(*(F.lit(x) for x in _LABEL_DOMAINS)), (k % 6 + 1).cast("int"))
    x = F.when((k % 6 == 5) | (k % 60 == 2), F.concat(F.lit("GCA-"), sixth.cast("string"))).otherwise(k.cast("string"))

    def rank(i):
        pick = (sixth + 5 * i) % 9
        return (
            F.when(pick == 0, d).when(pick == 1, "unclassified").when(pick == 2, F.concat(F.lit("MCP in "), "p_name")).when(pick == 3, F.concat(d, F.lit("_unclassified"))).when(pick == 4, " NA ")
            .when(pick == 5, F.concat(F.lit("unclassified "), "p_name")).when(pick == 6, F.concat_ws("__", d, "p_brand")).otherwise(F.col("p_brand"))
        )

    species = F.when(k % 5 == 0, d).when(k % 11 == 0, F.concat(F.lit("MCP in "), "p_type")).when(k % 7 == 0, "Unknown").otherwise(F.col("p_name"))
    told = p.select(F.concat_ws("__", d, x).alias("label"), F.array(d, *(rank(i) for i in range(1, 6)), species).alias("ranks"), "p_size")
    names = p.groupBy(F.col("p_name").alias("species")).agg(F.min("p_brand").alias("b"), F.min("p_partkey").alias("k")).where("k % 2 = 0")
    formal = names.select("species", F.array(F.concat(F.lit("Phylum "), "species"), F.lit(""), "b", F.lit("f"), F.lit("g"), "species").alias("ranks"), F.col("k").cast("string").alias("taxid"), F.lit("species").alias("terminal_rank"))
    return harmonize.bundle(told.select("label", "ranks"), told.where("p_size >= 20").select("label"), formal)
