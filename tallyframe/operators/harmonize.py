"""Harmonising ranked labels: scaffolds and placeholders fill the ranks, what they displace is kept as context, labels without evidence become aliases."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.scalars import domain_of
from tallyframe.operators.panels import taxonomy_aliases

# Ranks, texts that stand for nothing, and the names that a domain's upper ranks have.
RANKS = ("domain", "phylum", "class", "order", "family", "genus", "species")
NOTHING = ("", "na", "unknown", "unclassified")
PHYLA = {"MIRUS": "Mirusviricota", "NCLDV": "Nucleocytoviricota", "PLV": "Preplasmiviricota", "VP": "Preplasmiviricota"}
CLASSES = {"PLV": "Polintoviricetes", "VP": "Maveriviricetes"}
HOST = "MCP in "


def placeholder(domain: Column) -> Column:
    return F.concat(domain, F.lit("_unclassified"))


def without_placeholder(value: Column, domain: Column) -> Column:
    """struct(value, context): texts that name no taxon become the domain's placeholder; those that say something else are kept as context."""
    text = F.regexp_replace(value, r"^\s+|\s+$", "")
    nothing = F.lower(text).isin(*NOTHING) | (text == domain)
    other = F.startswith(F.lower(text), F.lit("unclassified ")) | F.startswith(text, F.concat(domain, F.lit("__"))) | F.startswith(text, F.lit(HOST))
    return F.struct(F.when(nothing | other, placeholder(domain)).otherwise(text).alias("value"), F.when(other & ~nothing, text).alias("context"))


def _scaffold(value: Column, domain: Column, names: dict[str, str]) -> Column:
    """The domain's name for a rank that only repeats the domain, says nothing or names a host."""
    known = F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), domain)
    bare = value.isin("unclassified") | (value == domain) | (value == placeholder(domain))
    host = F.startswith(value, F.lit(HOST)) & (domain != "NCLDV")
    return F.when(known.isNotNull() & (bare | host), known).otherwise(value)


def harmonized(labels: DataFrame, formal: DataFrame) -> DataFrame:
    """(label, ranks, contexts array<struct<type, value>>) from labels(label, ranks array of 7).

    formal(species, ranks array of 6, taxid, terminal_rank), one row a species, replaces the ranks of EUK labels of that species; what stood there is context.
    """
    rows = labels.select("label", F.col("ranks").alias("_old"), domain_of(F.col("label"), F.lit("NO_PREFIX")).alias("_d"))
    known = formal.select(F.col("species").alias("_s"), F.col("ranks").alias("_formal"), "taxid", "terminal_rank")
    met = rows.join(known, (F.col("_old")[6] == F.col("_s")) & (F.col("_d") == "EUK"), "left")
    filled = F.concat(F.array(F.lit("EUK")), F.transform("_formal", lambda x: F.when(x.isNotNull() & (x != ""), x).otherwise("EUK_unclassified")))
    swap = F.col("_formal").isNotNull() & (filled != F.col("_old"))
    told = met.withColumn("_swap", swap).withColumn("_r", F.when(swap, filled).otherwise(F.col("_old")))
    d, r = F.col("_d"), F.col("_r")
    told = told.withColumn("_up", F.array(d, _scaffold(r[1], d, PHYLA), _scaffold(r[2], d, CLASSES), *(r[i] for i in range(3, 7))))
    told = told.withColumn("_mid", F.array(*(without_placeholder(F.col("_up")[i], d) for i in range(1, 6))))
    last = F.col("_up")[6]
    host = F.startswith(last, F.lit(HOST))
    bare = (last == d) | F.lower(last).isin(*NOTHING)
    suffix = F.when(F.instr("label", "__") > 0, F.regexp_replace("label", "^.*?__", "")).otherwise(F.col("label"))
    species = F.when(host, suffix).when(bare, placeholder(d)).otherwise(last)
    note = lambda when, kind, value: F.when(when, F.struct(F.lit(kind).alias("type"), value.alias("value")))
    notes = [note(F.col("_swap"), "original_taxonomy", F.array_join("_old", "|")), note(F.col("_swap"), "ncbi_taxid", F.col("taxid")), note(F.col("_swap"), "ncbi_terminal_rank", F.col("terminal_rank"))]
    notes += [note((r[i] != F.col("_up")[i]) & F.startswith(r[i], F.lit(HOST)), RANKS[i], r[i]) for i in (1, 2)]
    notes += [note(F.col("_mid")[i - 1]["context"].isNotNull(), RANKS[i], F.col("_mid")[i - 1]["context"]) for i in range(1, 6)]
    notes.append(note(host, "species", last))
    ranks = F.concat(F.array(d), F.transform("_mid", lambda m: m["value"]), F.array(species))
    return told.select("label", ranks.alias("ranks"), F.array_compact(F.array(*notes)).alias("contexts"))


def bridged(labels: DataFrame, evidence: DataFrame) -> DataFrame:
    """(label, canonical, reason, ranks, original, source): PHAGE labels of assemblies with evidence and a PLV label of the same suffix are virophages.

    Both become aliases of the VP label of that suffix, whose ranks are the PLV label's if these are a virophage's, else the VP scaffold.
    """
    suffix = F.regexp_replace("label", "^.*?__", "")
    phage = labels.where(F.startswith(F.col("label"), F.lit("PHAGE__GCA-"))).join(evidence.select("label").distinct(), "label", "left_semi")
    pairs = phage.select(F.col("label").alias("phage"), F.col("ranks").alias("_p"), suffix.alias("_x")).join(
        labels.where(F.startswith(F.col("label"), F.lit("PLV__"))).select(F.col("label").alias("plv"), F.col("ranks").alias("_v"), suffix.alias("_x")), "_x"
    )
    virophage = (F.col("_v")[1] == PHYLA["VP"]) & (F.col("_v")[2] == CLASSES["VP"])
    own = F.regexp_replace(F.col("_p")[6], "^PHAGE__", "")
    scaffold = F.array(F.lit("VP"), F.lit(PHYLA["VP"]), F.lit(CLASSES["VP"]), *[F.lit("VP_unclassified")] * 3, F.when(own != "", own).otherwise(F.col("_v")[6]))
    ranks = F.when(virophage, F.concat(F.array(F.lit("VP")), F.slice("_v", 2, 6))).otherwise(scaffold)
    both = F.array(
        F.struct(F.col("phage").alias("label"), F.lit("phage_virophage_relabel").alias("reason"), F.lit("original_phage_taxonomy").alias("original"), F.array_join("_p", "|").alias("source")),
        F.struct(F.col("plv").alias("label"), F.lit("plv_virophage_alias").alias("reason"), F.lit("original_plv_taxonomy").alias("original"), F.array_join("_v", "|").alias("source")),
    )
    rows = pairs.select(F.concat(F.lit("VP__"), F.col("_x")).alias("canonical"), ranks.alias("ranks"), F.explode(both).alias("b"))
    return rows.select("b.label", "canonical", "b.reason", "ranks", "b.original", "b.source")


def bundle(labels: DataFrame, evidence: DataFrame, formal: DataFrame, relabels: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """(label, kind, value, detail): what becomes of labels(label, ranks): 'active' with ranks, 'alias' with target and reason, 'context' with type and
    value, 'inactive' with taxonomy and reason.

    Virophages are bridged first; then relabels(label, canonical, ranks, reason) apply; excluded(label) go; a label without evidence(label) is
    an alias of the one label with evidence that has the same taxonomy, unless that is an alias itself, else it is inactive; the rest are harmonised.
    Canonical labels of one name should have one taxonomy.
    """
    moved = bridged(labels, evidence)
    if relabels is not None:
        more = relabels.join(moved.select("label"), "label", "left_anti").join(labels.select("label", F.array_join("ranks", "|").alias("source")), "label")
        moved = moved.unionByName(more.select("label", "canonical", "reason", "ranks", F.lit("original_taxonomy").alias("original"), "source"))
    rest = labels.join(moved.select("label"), "label", "left_anti")
    gone = None
    if excluded is not None:
        gone = rest.join(excluded.select("label"), "label", "left_semi").select("label", F.array_join("ranks", "|").alias("value"), F.lit("excluded").alias("detail"))
        rest = rest.join(excluded.select("label"), "label", "left_anti")
    known = evidence.select("label").distinct()
    # aliases are sought among all labels, as they were
    told = labels.join(known.withColumn("_e", F.lit(True)), "label", "left").select("label", F.array_join("ranks", "|").alias("tax"), F.coalesce("_e", F.lit(False)).alias("active"))
    targets = taxonomy_aliases(told, "label", "tax", "active").join(moved.select(F.col("label").alias("alias")), "alias", "left_anti")
    without = rest.join(known, "label", "left_anti")
    same = without.join(targets, "label").select("label", "alias")
    kept = harmonized(rest.join(known, "label", "left_semi"), formal)
    out = [
        moved.select(F.col("canonical").alias("label"), F.lit("active").alias("kind"), F.array_join("ranks", "|").alias("value"), F.lit("").alias("detail")).distinct(),
        moved.select("label", F.lit("alias").alias("kind"), F.col("canonical").alias("value"), F.col("reason").alias("detail")),
        moved.select(F.col("canonical").alias("label"), F.lit("context").alias("kind"), F.col("source").alias("value"), F.col("original").alias("detail")),
        same.select("label", F.lit("alias").alias("kind"), F.col("alias").alias("value"), F.lit("duplicate_taxonomy_without_faa").alias("detail")),
        without.join(same, "label", "left_anti").select("label", F.lit("inactive").alias("kind"), F.array_join("ranks", "|").alias("value"), F.lit("no_faa_evidence").alias("detail")),
        kept.select("label", F.lit("active").alias("kind"), F.array_join("ranks", "|").alias("value"), F.lit("").alias("detail")),
        kept.select("label", F.lit("context").alias("kind"), F.explode("contexts").alias("c")).select("label", "kind", F.col("c.value").alias("value"), F.col("c.type").alias("detail")),
    ]
    if gone is not None:
        out.append(gone.select("label", F.lit("inactive").alias("kind"), "value", "detail"))
    return functools.reduce(DataFrame.unionByName, out)
