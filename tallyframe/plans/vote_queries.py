"""Vote and consensus queries."""

from pyspark.sql import functions as F

from tallyframe.operators import vote
from tallyframe.plans.base import PLACEMENTS, RANKS, placements, query, tasks

_LEVELS = list(vote.LEVELS)
_RANK_LIST = ", ".join(RANKS)

_VOTES = f"""WITH {PLACEMENTS},
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query, protein ORDER BY distance, marker, neighbor) AS rn FROM placements WHERE r1 <> '') WHERE rn = 1),
a0 AS (SELECT query, marker, {_RANK_LIST}, count(*) AS n FROM one GROUP BY ALL)"""


def _consensus_sql(fast: bool) -> str:
    """The twin, rank by rank."""
    needed, usual, parts = vote.floors(fast), vote.floors(False), [_VOTES]
    for i, r in enumerate(RANKS):
        parts.append(f"""c{i} AS (SELECT query, marker, {r} AS v, sum(n) AS n FROM a{i} WHERE trim({r}) <> '' GROUP BY ALL),
p{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query, marker ORDER BY n DESC, v) AS k FROM c{i}) WHERE k = 1),
w{i} AS (SELECT query, v, count(*) AS s FROM p{i} GROUP BY ALL), t{i} AS (SELECT query, count(*) AS t FROM p{i} GROUP BY ALL), d{i} AS (SELECT query, count(DISTINCT v) AS d FROM c{i} GROUP BY ALL),
s{i} AS (SELECT query, v, s, t, d FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY s DESC, v) AS k FROM w{i}) JOIN t{i} USING (query) JOIN d{i} USING (query) WHERE k = 1),
a{i + 1} AS (SELECT a{i}.* FROM a{i} JOIN s{i} ON a{i}.query = s{i}.query AND a{i}.{r} = s{i}.v AND s{i}.s >= {needed[i]})""")
    ok = [f"coalesce(s{i}.s >= {needed[i]}, false)" for i in range(7)]
    lab = lambda i: f"'{_LEVELS[i][0]}_' || s{i}.v"
    major = " || ';' || ".join(f"CASE WHEN {ok[i]} THEN {lab(i)} ELSE '{_LEVELS[i][0]}_' END" for i in range(7))
    strict = " || ';' || ".join(
        f"CASE WHEN {' AND '.join(f'{ok[j]} AND s{j}.d = 1' for j in range(i + 1))} THEN {lab(i)} ELSE '{_LEVELS[i][0]}_' END" for i in range(7)
    )
    low = " OR ".join(f"(NOT {ok[i]} AND coalesce(s{i}.t, 0) > 0)" for i in range(7))
    reduced = " OR ".join(f"({ok[i]} AND s{i}.s < {usual[i]})" for i in range(7) if needed[i] < usual[i]) or "false"
    flags = f"concat_ws(',', CASE WHEN coalesce(s0.t, 0) = 0 THEN 'no_support' END, CASE WHEN {low} THEN 'low_support' END, CASE WHEN {reduced} THEN 'reduced_fastmode' END)"
    joins = " ".join(f"LEFT JOIN s{i} ON q.query = s{i}.query" for i in range(7))
    return ",\n".join(parts) + f"\nSELECT q.query, {major} AS majority, {strict} AS strict, coalesce(nullif({flags}, ''), 'high') AS confidence FROM (SELECT DISTINCT query FROM a0) q {joins}"


def _votes(spark, sf):
    one = vote.one_vote(placements(spark, sf), "query", "protein", "marker", "neighbor", "distance", RANKS)
    # a query's votes in one task are only aggregated there, and all later groups by query need no other shuffle
    return vote.lineage_votes(one.repartition(tasks(spark, sf), "query"), "query", "marker", RANKS)


@query(_consensus_sql(False))
def hierarchical_consensus(spark, sf):
    return vote.hierarchical_consensus(_votes(spark, sf), "query", "marker", RANKS)


@query(_consensus_sql(True))
def hierarchical_consensus_fast(spark, sf):
    return vote.hierarchical_consensus(_votes(spark, sf), "query", "marker", RANKS, fast=True)


_FLAT = " UNION ALL ".join(
    f"""SELECT query, '{level}' AS level, v AS value, s AS supporting, t AS total, s >= {need} AS ok FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY s DESC, v) AS k2, sum(s) OVER (PARTITION BY query) AS t FROM (
    SELECT query, v, count(*) AS s FROM (SELECT *, row_number() OVER (PARTITION BY query, marker ORDER BY n DESC, v) AS k FROM (
      SELECT query, marker, {r} AS v, sum(n) AS n FROM a0 WHERE trim({r}) <> '' GROUP BY ALL)) WHERE k = 1 GROUP BY ALL)) WHERE k2 = 1"""
    for level, r, need in zip(_LEVELS, RANKS, vote.floors(False), strict=True)
)


@query(f"{_VOTES} SELECT query, level, value, supporting, CAST(total AS BIGINT) AS total, ok FROM ({_FLAT})")
def flat_consensus(spark, sf):
    return vote.flat_consensus(_votes(spark, sf), "query", "marker", RANKS)


_COUNTS = f"{_VOTES}, counts AS (" + " UNION ALL ".join(
    f"SELECT query, '{level}' AS level, {'r1' if r == 'r1' else f'''r1 || '__' || {r}'''} AS taxon, CAST(sum(n) AS BIGINT) AS n FROM a0 WHERE trim({r}) <> '' GROUP BY ALL"
    for level, r in zip(_LEVELS, RANKS, strict=True)
) + ")"


@query(f"{_COUNTS} SELECT * FROM counts")
def taxon_counts(spark, sf):
    return vote.rank_counts(_votes(spark, sf), "query", RANKS)


@query(f"""{_COUNTS}, f AS (SELECT query, level, n, sum(n) OVER (PARTITION BY query, level) AS t,
  CASE WHEN level <> 'domain' AND n * 100 <= 5 * sum(n) OVER (PARTITION BY query, level) THEN CASE WHEN contains(taxon, '__') THEN split_part(taxon, '__', 1) || '__other' WHEN contains(taxon, '_') THEN split_part(taxon, '_', 1) || '__other' ELSE taxon || '_other' END ELSE taxon END AS taxon FROM counts),
g AS (SELECT query, level, taxon, sum(n) AS n, max(t) AS t FROM f GROUP BY ALL)
SELECT query, level, string_agg(taxon || ':' || n || '(' || CAST(round(CAST(n * 100 AS DECIMAL(20, 10)) / CAST(t AS DECIMAL(12, 0)), 2) AS DECIMAL(20, 2)) || '%)', ',' ORDER BY n DESC, taxon) AS tally FROM g GROUP BY ALL""")
def taxon_tally(spark, sf):
    return vote.tally(vote.rank_counts(_votes(spark, sf), "query", RANKS), ["query", "level"], "taxon", level="level")


@query(f"""{_COUNTS}, t AS (SELECT query, level, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY ALL)
SELECT query, level, taxon, n, total, n * 2 > total AS majority, n = total AS strict FROM (
  SELECT *, row_number() OVER (PARTITION BY query, level ORDER BY n DESC, taxon) AS k FROM counts) JOIN t USING (query, level) WHERE k = 1""")
def taxon_majority(spark, sf):
    return vote.majority_and_strict(vote.rank_counts(_votes(spark, sf), "query", RANKS), ["query", "level"], "taxon")


@query(f"""{_COUNTS} SELECT query, level, CAST(max(CASE WHEN k = 1 THEN n ELSE 0 END) AS BIGINT) AS top_n, CAST(max(CASE WHEN k = 2 THEN n ELSE 0 END) AS BIGINT) AS second_n, CAST(sum(n) AS BIGINT) AS total
FROM (SELECT *, row_number() OVER (PARTITION BY query, level ORDER BY n DESC, taxon) AS k FROM counts) GROUP BY ALL""")
def top_two_taxa(spark, sf):
    return vote.top_two_shares(vote.rank_counts(_votes(spark, sf), "query", RANKS), ["query", "level"], "taxon")


@query(f"""{_VOTES} SELECT query, marker, r1, r2, r3, r4, n FROM a0 WHERE r1 = 'ASIA'""")
def lineage_counts_in_domain(spark, sf):
    return _votes(spark, sf).where(F.col("r1") == "ASIA").select("query", "marker", "r1", "r2", "r3", "r4", "n")
