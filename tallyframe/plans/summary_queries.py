"""The summary: one row for each query, put together from consensus, panels, capsid types, hits and contigs, as text."""

from pyspark.sql import functions as F

from tallyframe.operators import summary
from tallyframe.operators.staging import shared_path, staged
from tallyframe.plans import evidence_queries, misc_queries, panel_queries, vote_queries
from tallyframe.plans.base import ORACLES, query, table

_PANELS = ("gvog4", "gvog8", "busco", "cog", "mrya", "phage")
#: Columns in the table's order; those of the species tree, which none of these queries has, say so.
_COLUMNS = [
    "query", "taxonomy_majority", "species_tree_nn_taxonomy", "taxonomy_confidence", "capsid_group", *(f"{p}_{c}" for p in _PANELS for c in ("completeness", "dup")), "hits", "mean_best", "contigs", "suspicious_bp", "attribution",
]
_TWO = [f"{p}_dup" for p in _PANELS] + ["mean_best", "suspicious_bp"]
#: The legacy table's names of the same columns, in its order.
_LEGACY = {"query": "query", "contigs": "contigs", "hits": "genecount", "taxonomy_majority": "taxonomy_majority", **{f"{p}_completeness": f"{p.upper()}_unique_of_total" for p in _PANELS}, **{f"{p}_dup": f"{p.upper()}_df" for p in _PANELS}}

_SQL = f"""SELECT CAST(s_suppkey AS VARCHAR) AS query, coalesce(majority, '') AS taxonomy_majority, 'nd' AS species_tree_nn_taxonomy, coalesce(confidence, '') AS taxonomy_confidence, coalesce(tally, '') AS capsid_group,
  {", ".join(f"{p}_completeness, printf('%.2f', {p}_dup) AS {p}_dup" for p in _PANELS)}, CAST(coalesce(hits, 0) AS VARCHAR) AS hits, printf('%.2f', coalesce(mean_best, 0.0)) AS mean_best, CAST(coalesce(contigs, 0) AS VARCHAR) AS contigs,
  printf('%.2f', coalesce(suspicious_bp, 0.0)) AS suspicious_bp, coalesce(f.mode, '') AS attribution
FROM supplier LEFT JOIN ({ORACLES["hierarchical_consensus"]}) c ON c.query = s_suppkey JOIN ({ORACLES["panel_report"]}) p ON p.query = s_suppkey LEFT JOIN ({ORACLES["capsid_types"]}) t ON t.query = s_suppkey
LEFT JOIN ({ORACLES["best_hit_statistics"]}) b ON b.query = s_suppkey LEFT JOIN ({ORACLES["bin_contig_features"]}) f ON f.bin = s_suppkey"""


def _rows(spark, sf):
    base = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("query"), F.lit(None).cast("string").alias("species_tree_nn_taxonomy"))
    consensus = vote_queries.hierarchical_consensus(spark, sf).select("query", F.col("majority").alias("taxonomy_majority"), F.col("confidence").alias("taxonomy_confidence"))
    capsids = misc_queries.capsid_types(spark, sf).withColumnRenamed("tally", "capsid_group")
    hits = panel_queries.best_hit_statistics(spark, sf).select("query", "hits", "mean_best")
    contigs = evidence_queries.bin_contig_features(spark, sf).select(F.col("bin").alias("query"), "contigs", "suspicious_bp", F.col("mode").alias("attribution"))
    whole = summary.assemble(base, "query", [consensus, panel_queries.panel_report(spark, sf), capsids, hits, contigs], {"hits": 0, "mean_best": 0.0, "contigs": 0, "suspicious_bp": 0.0})
    return summary.rendered(whole.select(_COLUMNS), _TWO, {"species_tree_nn_taxonomy": "nd"})


@query(_SQL)
def summary_table(spark, sf):
    """The summary as a table of tabs, sorted by query, written and read back."""
    path = shared_path(spark, "summary-table")
    rows = staged(_rows(spark, sf), "summary-rows")  # sorting by ranges looks at its input twice
    summary.write_table(rows, path, "\t", "query")
    return summary.read_table(spark, path, "\t")


@query(f"SELECT {', '.join(f'{a} AS {b}' for a, b in _LEGACY.items())} FROM ({_SQL})")
def legacy_table(spark, sf):
    """The summary under the legacy names."""
    return summary.renamed(_rows(spark, sf), _LEGACY)


_EXTENDED = {"bin": "query", "coherent": "cellular_coherent_contig_count", "coherent_proteins": "cellular_coherent_protein_fraction", "coherent_bp": "cellular_coherent_bp_fraction", "purity": "cellular_lineage_purity_median", "identity": "cellular_hit_identity_median", "viral_bearing": "viral_bearing_contig_count", "mode": "contig_attribution_mode"}


@query(f"""SELECT {", ".join(f"printf('%.2f', {a}) AS {b}" if a in ("coherent_proteins", "coherent_bp", "purity", "identity") else f"CAST({a} AS VARCHAR) AS {b}" for a, b in _EXTENDED.items())} FROM ({ORACLES["bin_contig_features"]})""")
def extended_table(spark, sf):
    """The diagnostics beside the summary, as a table of commas, written and read back."""
    rows = summary.renamed(evidence_queries.bin_contig_features(spark, sf), _EXTENDED)
    path = shared_path(spark, "summary-extended")
    summary.write_table(summary.rendered(rows, [b for a, b in _EXTENDED.items() if a in ("coherent_proteins", "coherent_bp", "purity", "identity")]), path, ",", "query")
    return summary.read_table(spark, path, ",")
