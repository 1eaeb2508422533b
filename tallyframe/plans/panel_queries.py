"""Queries of panel completeness, dominant lineages, ranked subjects and aliases."""

from pyspark.sql import functions as F

from tallyframe.operators import filters, panels
from tallyframe.plans.base import HITS, PLACEMENTS, hits, placements, query, table

_CATEGORIES = {"MCP": "Brand#1", "Penton": "Brand#2", "ATPase": "Brand#3", "Protease": "Brand#4"}
_VALUES = ", ".join(f"('{c}', '{p}')" for c, p in _CATEGORIES.items())


@query(f"""WITH {HITS}, dom AS (SELECT o_orderkey AS protein, r_name AS domain FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey WHERE o_orderkey % 4 > 0),
c AS (SELECT DISTINCT query, cat, protein FROM hits JOIN (VALUES {_VALUES}) v(cat, prefix) ON starts_with(model, prefix) WHERE dom_score >= 50),
k AS (SELECT query, cat, count(*) AS n, bool_or(domain IS NULL OR domain = 'ASIA') AS ok FROM c LEFT JOIN dom USING (protein) GROUP BY ALL)
SELECT query, count(*) FILTER (ok) || '/4' AS completeness, CAST(coalesce(sum(n) FILTER (cat = 'MCP'), 0) AS BIGINT) AS counted_items, CAST(coalesce(sum(n), 0) AS BIGINT) AS total, coalesce(sum(n), 0) / 4.0 AS duplication
FROM (SELECT DISTINCT query FROM hits WHERE dom_score >= 50) LEFT JOIN k USING (query) GROUP BY query""")
def category_completeness(spark, sf):
    t = lambda name: table(spark, sf, name)
    placed = (
        t("orders").where("o_orderkey % 4 > 0").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("o_orderkey").alias("protein"), F.col("r_name").alias("domain"))
    )
    return panels.category_completeness(hits(spark, sf).where("dom_score >= 50"), "query", "model", "protein", _CATEGORIES, placed, "ASIA", "MCP")


@query(f"""WITH {PLACEMENTS} SELECT query, r1, r2, r3, n FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY n DESC, r1, r2, r3) AS k FROM (
  SELECT query, r1, r2, r3, count(*) AS n FROM placements GROUP BY ALL)) WHERE k = 1""")
def dominant_lineage(spark, sf):
    return panels.dominant_lineage(placements(spark, sf), ["query"], ["r1", "r2", "r3"])


@query(f"""WITH {HITS} SELECT model, protein, seq_score, place FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY seq_score DESC, protein) AS place FROM (
  SELECT model, protein, max(seq_score) AS seq_score FROM hits WHERE dom_score >= 30 GROUP BY ALL)) WHERE place <= 300""")
def ranked_subjects(spark, sf):
    return panels.ranked_subjects(hits(spark, sf).where("dom_score >= 30"), ["model"], "protein", "seq_score", 300)


@query("""WITH l AS (SELECT p_partkey AS label, p_name || '|' || p_type || '|' || p_brand AS tax, p_size >= 40 AS active FROM part),
o AS (SELECT tax, max(label) FILTER (active) AS alias FROM l GROUP BY tax HAVING count(*) FILTER (active) = 1)
SELECT label, alias FROM l JOIN o USING (tax) WHERE NOT active""")
def taxonomy_aliases(spark, sf):
    p = table(spark, sf, "part")
    labels = p.select(F.col("p_partkey").alias("label"), F.concat_ws("|", "p_name", "p_type", "p_brand").alias("tax"), (F.col("p_size") >= 40).alias("active"))
    return panels.taxonomy_aliases(labels, "label", "tax", "active")


_PANELS = {"gvog4": [f"Brand#{i}" for i in (1, 2, 3, 4)], "gvog8": [f"Brand#{i}" for i in range(5, 13)], "busco": ["Brand#13", "Brand#14", "Brand#99"], "cog": ["Brand#15", "Brand#16"], "mrya": ["Brand#17", "Brand#18", "Brand#19"], "phage": ["Brand#20"]}
#: Panels of which an item counts only if its best model in the group is the panel's.
_GROUPED = ("cog", "mrya")
# models whose numbers are alike by 6 are a group, but for the remainder 5
_IN_PANEL = {n: ", ".join(f"'{m}'" for m in ms) for n, ms in _PANELS.items()}
_STRONG = f"""{HITS}, h AS (SELECT query, protein, model, max(seq_score) AS s FROM hits WHERE dom_score >= 44 GROUP BY ALL),
g AS (SELECT DISTINCT p_brand AS model, CAST(substr(p_brand, 7) AS INT) % 6 AS grp FROM part WHERE CAST(substr(p_brand, 7) AS INT) % 6 < 5),
own AS (SELECT query, protein, model FROM (SELECT h.*, grp, max(s) OVER (PARTITION BY query, protein, grp) AS top FROM h LEFT JOIN g USING (model)) WHERE grp IS NULL OR s >= top)"""


def _panel_parts(name):
    t = "own" if name in _GROUPED else "h"
    return f"""(SELECT query, count(DISTINCT model) || '/{len(_PANELS[name])}' AS {name}_completeness, coalesce(count(DISTINCT (protein, model)) / nullif(count(DISTINCT model), 0), 0.0) AS {name}_dup, count(DISTINCT model) AS {name}_unique,
  count(DISTINCT protein) AS {name}_total FROM {t} WHERE model IN ({_IN_PANEL[name]}) GROUP BY query) p_{name} USING (query)"""


def _panel_columns(name):
    return f"coalesce({name}_completeness, '0/{len(_PANELS[name])}') AS {name}_completeness, coalesce({name}_dup, 0.0) AS {name}_dup, coalesce({name}_unique, 0) AS {name}_unique, coalesce({name}_total, 0) AS {name}_total"


def _strong(spark, sf):
    return hits(spark, sf).where("dom_score >= 44")


def _model_groups(spark, sf):
    number = F.substring("p_brand", 7, 9).cast("int") % 6
    return table(spark, sf, "part").select(F.col("p_brand").alias("model"), number.alias("group")).distinct().where("group < 5")


@query(f"""WITH {_STRONG} SELECT s_suppkey AS query, {", ".join(map(_panel_columns, _PANELS))} FROM supplier LEFT JOIN (SELECT DISTINCT query FROM h) q ON query = s_suppkey LEFT JOIN {" LEFT JOIN ".join(map(_panel_parts, _PANELS))}""")
def panel_report(spark, sf):
    strong = _strong(spark, sf)
    asked = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("query"))
    plain = panels.panel_table(asked, strong, ["query"], "protein", "model", {n: m for n, m in _PANELS.items() if n not in _GROUPED})
    own = panels.consolidated(strong, ["query"], "protein", "model", "seq_score", _model_groups(spark, sf))
    return plain.join(panels.panel_table(asked, own, ["query"], "protein", "model", {n: _PANELS[n] for n in _GROUPED}), "query")


_CORE = {"MCP": ["Brand#1", "Brand#2"], "ATPase": ["Brand#3", "Brand#4"], "Portal": ["Brand#5"], "Triplex": ["Brand#6", "Brand#99"]}
_CORE_VALUES = ", ".join(f"('{c}', '{m}')" for c, ms in _CORE.items() for m in ms)
_PLACED = """dom AS (SELECT DISTINCT l_suppkey AS query, o_orderkey AS protein, r_name AS domain FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderkey % 4 > 0)"""


def _domains(spark, sf):
    t = lambda name: table(spark, sf, name)
    placed = t("orders").where("o_orderkey % 4 > 0").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    items = t("lineitem").select(F.col("l_suppkey").alias("query"), F.col("l_orderkey").alias("protein")).distinct()
    return items.join(placed.select(F.col("o_orderkey").alias("protein"), F.col("r_name").alias("domain")), "protein")


@query(f"""WITH {HITS}, {_PLACED}, c AS (SELECT DISTINCT query, cat, protein FROM hits JOIN (VALUES {_CORE_VALUES}) v(cat, model) USING (model) WHERE dom_score >= 47),
k AS (SELECT query, cat, count(*) AS n, bool_or(domain IS NULL OR domain = 'ASIA') AS ok FROM c LEFT JOIN dom USING (query, protein) GROUP BY ALL)
SELECT s_suppkey AS query, count(*) FILTER (ok) || '/4' AS completeness, coalesce(sum(n), 0) / 4.0 AS duplication, CAST(coalesce(sum(n), 0) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (cat = 'MCP'), 0) AS BIGINT) AS counted FROM supplier LEFT JOIN k ON query = s_suppkey GROUP BY s_suppkey""")
def core_categories(spark, sf):
    asked = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("query"))
    return panels.category_table(asked, hits(spark, sf).where("dom_score >= 47"), ["query"], "protein", "model", _CORE, "ASIA", _domains(spark, sf), "MCP")


@query(f"""WITH {HITS}, n AS (SELECT query, model, count(*) - 1 AS n FROM hits WHERE dom_score >= 47 GROUP BY ALL), k AS (SELECT query, cat, sum(n) AS n FROM n JOIN (VALUES {_VALUES}) v(cat, prefix) ON starts_with(model, prefix) WHERE n > 0 GROUP BY ALL)
SELECT s_suppkey AS query, count(cat) || '/4' AS completeness, coalesce(sum(n), 0) / 4.0 AS duplication, CAST(coalesce(sum(n), 0) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (cat = 'MCP'), 0) AS BIGINT) AS counted FROM supplier LEFT JOIN k ON query = s_suppkey GROUP BY s_suppkey""")
def category_counts_only(spark, sf):
    asked = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("query"))
    counts = hits(spark, sf).where("dom_score >= 47").groupBy("query", "model").agg((F.count("*") - 1).alias("n"))
    return panels.category_counts(asked, counts, ["query"], "model", "n", {c: [p] for c, p in _CATEGORIES.items()}, "MCP", prefix=True)


@query(f"""WITH {PLACEMENTS}, {HITS}, near AS (SELECT query, marker, protein, arg_min(r1, {{'d': distance, 'n': neighbor}}) AS domain FROM placements GROUP BY ALL),
x AS (SELECT h.query, count(DISTINCT h.protein) AS n FROM hits h JOIN near ON near.query = h.query AND near.marker = h.model AND near.protein = h.protein AND domain = 'ASIA' WHERE starts_with(h.model, 'Brand#1') GROUP BY h.query)
SELECT s_suppkey AS query, coalesce(n, 0) AS n FROM supplier LEFT JOIN x ON query = s_suppkey""")
def placed_hits(spark, sf):
    near = placements(spark, sf).groupBy("query", F.col("marker").alias("model"), "protein").agg(F.min_by("r1", F.struct("distance", "neighbor")).alias("domain"))
    asked = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("query"))
    return panels.placed_items(asked, hits(spark, sf), ["query"], "protein", "model", "Brand#1", "ASIA", near)


# items are hit by several models of groups; suppliers of remainder 0 by 3 have counts alone
@query(f"""WITH {HITS}, src AS (SELECT l_suppkey AS query, l_orderkey % 97 AS protein, p_brand AS model FROM lineitem JOIN part ON l_partkey = p_partkey), g AS (SELECT DISTINCT p_brand AS model, 'g' || CAST(substr(p_brand, 7) AS INT) % 6 AS grp FROM part WHERE CAST(substr(p_brand, 7) AS INT) % 6 < 5),
v AS (SELECT query, protein, grp, count(*) AS v FROM (SELECT DISTINCT * FROM src WHERE query % 3 > 0) JOIN g USING (model) GROUP BY ALL), w AS (SELECT query, protein, min(grp) AS grp FROM (SELECT *, max(v) OVER (PARTITION BY query, protein) AS t FROM v) WHERE v = t GROUP BY ALL HAVING count(*) = 1),
b AS (SELECT query, grp, count(*) AS v FROM w GROUP BY ALL), c AS (SELECT query, grp, sum(n) AS v FROM (SELECT query, model, count(*) % 5 AS n FROM src GROUP BY ALL) JOIN g USING (model) WHERE n > 0 GROUP BY ALL),
a AS (SELECT * FROM b UNION ALL SELECT * FROM c WHERE query NOT IN (SELECT query FROM b)), f AS (SELECT query, min(grp) AS grp FROM (SELECT *, max(v) OVER (PARTITION BY query) AS t FROM a) WHERE v = t GROUP BY query HAVING count(*) = 1)
SELECT s_suppkey AS query, coalesce(grp, '') AS "group" FROM supplier LEFT JOIN f ON query = s_suppkey""")
def dominant_model_group(spark, sf):
    src = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").alias("query"), (F.col("l_orderkey") % 97).alias("protein"), F.col("p_brand").alias("model"))
    counts = src.groupBy("query", "model").agg((F.count("*") % 5).alias("n"))
    groups = _model_groups(spark, sf).select("model", F.concat(F.lit("g"), F.col("group").cast("string")).alias("group"))
    asked = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("query"))
    return panels.dominant_group(asked, src.where("query % 3 > 0"), counts, ["query"], "protein", "model", "n", groups)


# the profile's length is 60, its covered part the quantity and 10 more
@query("""WITH h AS (SELECT l_suppkey AS query, l_orderkey AS item, p_brand AS model, CAST(l_extendedprice * 100 AS BIGINT) AS score, CAST(l_tax * 100 AS BIGINT) AS hit, CAST(l_quantity AS INT) AS q, l_orderkey * 10 + l_linenumber AS place FROM lineitem JOIN part ON l_partkey = p_partkey),
e AS (SELECT query, item, max(score) AS s, max(hit) AS b, arg_min((q + 10) / 60, {'o': -hit, 'p': place, 'c': q}) AS c, count(DISTINCT model) AS m FROM h GROUP BY ALL), p AS (SELECT query, count(DISTINCT model) AS profiles FROM h GROUP BY ALL)
SELECT query, count(*) AS hits, CAST(round(CAST(avg(s) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS mean_score, any_value(profiles) AS profiles, CAST(round(CAST(avg(b) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS mean_best, CAST(round(CAST(avg(c) AS DECIMAL(28, 9)), 3) AS DOUBLE) AS mean_coverage, count(*) FILTER (c > 0.66) AS complete, CAST(round(CAST(coalesce(avg(b) FILTER (c > 0.66), 0.0) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS mean_complete,
  CAST(round(CAST(sum(m) / any_value(profiles) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS items_per_profile FROM e JOIN p USING (query) GROUP BY query""")
def best_hit_statistics(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("query"), F.col("l_orderkey").alias("item"), F.col("p_brand").alias("model"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("score"), F.round(F.col("l_tax") * 100).cast("long").alias("hit"),
        F.lit(60).alias("length"), F.lit(1).alias("a"), (F.col("l_quantity").cast("int") + 10).alias("b"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("place"),
    )
    return panels.best_hit_stats(rows, ["query"], "item", "model", "score", "hit", "length", "a", "b", "place")


@query(f"""WITH {HITS} SELECT query, model, count(DISTINCT protein) AS n FROM hits WHERE NOT starts_with(model, 'Brand#2') AND dom_score >= 30 GROUP BY ALL HAVING count(DISTINCT protein) >= 12""")
def kept_models(spark, sf):
    return filters.kept_models(hits(spark, sf).where("dom_score >= 30"), ["query"], "model", "protein", 12, ["Brand#2"])


@query(f"""WITH {PLACEMENTS} SELECT query, marker, protein, neighbor, r1, r2, r3 FROM placements WHERE r1 = 'ASIA' AND r3 LIKE '%' AND (starts_with(marker, 'Brand#1') OR starts_with(marker, 'Brand#7')) AND distance <= 0.05""")
def gated_placements(spark, sf):
    rows = filters.below_evalue(filters.in_lineage(placements(spark, sf), ["r1", "r2", "r3"], ["ASIA"]), "distance", 0.05)
    return rows.where(filters.starts_with_any(F.col("marker"), ["Brand#1", "Brand#7"])).select("query", "marker", "protein", "neighbor", "r1", "r2", "r3")


@query("""WITH t AS (SELECT o_custkey, string_agg(s || ':' || n, ',' ORDER BY n DESC, s) AS tally FROM (SELECT o_custkey, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_custkey)
SELECT o_custkey, tally, CAST(coalesce(nullif(regexp_extract(tally, 'F:([0-9]+)', 1), ''), '0') AS INT) AS n FROM t WHERE CAST(coalesce(nullif(regexp_extract(tally, 'F:([0-9]+)', 1), ''), '0') AS INT) >= 4""")
def candidates_by_tally(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_custkey", F.col("o_orderstatus").alias("s")).agg(F.count("*").alias("n"))
    parts = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "s")))
    tally = counts.groupBy("o_custkey").agg(F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x["s"], (-x["o"]).cast("string"))), ",").alias("tally"))
    return tally.withColumn("n", filters.counted_in_text(F.col("tally"), "F")).where("n >= 4")


@query("""SELECT p_brand, p_partkey, p_name, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS k FROM part WHERE p_brand IN ('Brand#1', 'Brand#5', 'Brand#9') AND p_size BETWEEN 5 AND 40) WHERE k <= 2""")
def base_genomes(spark, sf):
    return filters.base_rows(table(spark, sf, "part"), "p_brand", ["Brand#1", "Brand#5", "Brand#9"], "p_size", "p_partkey", 5, 40).select("p_brand", "p_partkey", "p_name", "p_size")
