"""Attribution of contigs, harmonised labels and configurations: cases worked out by hand."""

import pytest

from tallyframe.operators import contigs, grid, harmonize
from tallyframe.plans import base, registry

BEARING = "bin string, protein string, contig string"


def modes(spark, kinds, rows):
    bins = spark.createDataFrame(kinds, "bin string, kind string")
    return {r.bin: (r.n_proteins, r.mode) for r in contigs.attribution(bins, spark.createDataFrame(rows, BEARING)).collect()}


def test_attribution_modes(spark):
    rows = [("fna", f"p{i}", f"c{i}") for i in range(10)] + [("two", f"p{i}", f"c{i % 2}") for i in range(10)] + [("own", f"p{i}", f"c{i}") for i in range(20)] + [("few", f"p{i}", f"c{i}") for i in range(4)]
    got = modes(spark, [("fna", "fna"), ("two", "faa"), ("own", "faa"), ("few", "faa"), ("none", "faa"), ("empty", "fna")], rows)
    assert got == {
        "fna": (10, "fna_gene_calling"), "two": (10, "faa_contig_encoded"), "own": (20, "faa_weak_per_protein"), "few": (4, "faa_contig_encoded"),
        "none": (0, "faa_weak_per_protein"), "empty": (0, "fna_gene_calling"),
    }


def test_contigs_and_bins(spark):
    """c is coherent by 3 of 4 cellular proteins, v has one viral protein, low falls short of the identity, few of the number."""
    lineage = {"c": ["BAC/o1"] * 3 + ["BAC/o2"], "v": ["BAC/o1"] * 3 + ["NCLDV/x"], "low": ["EUK/o"] * 3, "few": ["ARC/o"] * 2}
    bearing, votes, hits = [], [], []
    for contig, found in lineage.items():
        for i, told in enumerate(found):
            p, (domain, order) = f"{contig}{i}", told.split("/")
            bearing.append(("b", p, contig))
            votes += [("b", p, domain, order, "g")] * 2 + [("b", p, "PHAGE", "z", "g")]
            hits.append(("b", p, domain, order, 60.0 if contig == "low" else 80.0 + i, 100.0))
    bearing = spark.createDataFrame(bearing, BEARING)
    votes = spark.createDataFrame(votes, "bin string, protein string, domain string, order string, genus string")
    hits = spark.createDataFrame(hits, "bin string, protein string, domain string, order string, identity double, score double")
    purity = contigs.contig_purity(bearing, votes, contigs.best_hits(hits))
    assert {r.contig: (r.n_viral, r.n_cellular, r.purity, r.median_identity, r["class"]) for r in purity.collect()} == {
        "c": (0, 4, 0.75, 81.5, "cellular_coherent"), "v": (1, 3, 0.0, 81.0, "viral_bearing"), "low": (0, 3, 1.0, 60.0, "ambiguous"), "few": (0, 2, 0.0, 80.5, "ambiguous"),
    }
    lengths = spark.createDataFrame([("b", "c", 300), ("b", "v", 200), ("b", "low", 400), ("b", "few", 50), ("b", "bare", 50), ("nil", "x", 0)], "bin string, contig string, length long")
    markers = spark.createDataFrame([("b", "few", "m1", "cellular"), ("b", "few", "m2", "cellular"), ("b", "bare", "p1", "phage"), ("b", "bare", "p2", "phage")], "bin string, contig string, model string, kind string")
    primary = spark.createDataFrame([("b", "q")], "bin string, order string")

    def features(kind):
        told = contigs.attribution(spark.createDataFrame([("b", kind), ("nil", "faa")], "bin string, kind string"), bearing)
        judged = contigs.suspicious(contigs.contig_evidence(lengths, bearing, contigs.best_hits(hits), markers, primary), purity, told)
        reasons = {r.contig: r.reason for r in judged.collect() if r.reason}
        return reasons, {r.bin: r for r in contigs.bin_features(told, purity, judged).collect()}

    reasons, rows = features("fna")
    assert reasons == {"c": "cellular_coherent_lineage", "bare": "phage_markers"}
    b = rows["b"]
    assert (b.active, b.contigs, b.suspicious, b.suspicious_bp, b.coherent, b.coherent_proteins, b.coherent_bp, b.purity, b.identity, b.viral_bearing) == (True, 5, 2, 35.0, 1, 30.77, 30.0, 0.75, 81.5, 1)
    assert (rows["nil"].active, rows["nil"].suspicious_bp, rows["nil"].coherent) == (False, 0.0, 0)


def harmonize_one(spark, label, text, formal=()):
    rows = spark.createDataFrame([(label, text.split("|"))], "label string, ranks array<string>")
    known = spark.createDataFrame(list(formal), "species string, ranks array<string>, taxid string, terminal_rank string")
    r = harmonize.harmonized(rows, known).first()
    return "|".join(r.ranks), sorted((c.type, c.value) for c in r.contexts)


def test_scaffolds_and_contexts(spark):
    u = "MIRUS_unclassified"
    assert harmonize_one(spark, "MIRUS__TARA_1", "MIRUS|MIRUS|MIRUS|MIRUS|MIRUS|MIRUS|TARA_1") == (f"MIRUS|Mirusviricota|{u}|{u}|{u}|{u}|TARA_1", [])
    hosts = "MIRUS|MCP in A|MCP in B|MCP in C|MCP in D|MCP in E|MCP in E f"
    ranks, contexts = harmonize_one(spark, "MIRUS__EP00178", hosts)
    assert ranks == f"MIRUS|Mirusviricota|{u}|{u}|{u}|{u}|EP00178"
    assert contexts == sorted([("phylum", "MCP in A"), ("class", "MCP in B"), ("order", "MCP in C"), ("family", "MCP in D"), ("genus", "MCP in E"), ("species", "MCP in E f")])
    lineage = [("Rhincodon typus", ["Chordata", "Chondrichthyes", "", "Rhincodontidae", "Rhincodon", "Rhincodon typus"], "259920", "species")]
    old = "EUK|Metazoa|Vertebrata|unclassified|Rhincodontidae|Rhincodon|Rhincodon typus"
    ranks, contexts = harmonize_one(spark, "EUK__GCA-1", old, lineage)
    assert ranks == "EUK|Chordata|Chondrichthyes|EUK_unclassified|Rhincodontidae|Rhincodon|Rhincodon typus"
    assert contexts == [("ncbi_taxid", "259920"), ("ncbi_terminal_rank", "species"), ("original_taxonomy", old)]
    assert harmonize_one(spark, "NCLDV__x", "NCLDV|MCP in A|na| c |unclassified Q|NCLDV__z|Unknown")[0] == "NCLDV|NCLDV_unclassified|NCLDV_unclassified|c|NCLDV_unclassified|NCLDV_unclassified|NCLDV_unclassified"


def test_bundles_of_labels(spark):
    zam = "PHAGE|PHAGE__Z|PHAGE__Z|PHAGE__Z|PHAGE__Z|PHAGE__Z|PHAGE__Zamilon virus"
    plv = "PLV|Preplasmiviricota|Maveriviricetes|Priklausovirales|Lavidaviridae|M|Zamilon virus"
    tax = "MIRUS|Mirusviricota|Class_01|O|F|G|s"
    labels = {"PHAGE__GCA-1": zam, "PLV__GCA-1": plv, "MIRUS__a": tax, "MIRUS__b": tax, "BAC__lone": "BAC|p|c|o|f|g|s", "BAC__x": "BAC|p|c|o|f|g|x", "PHAGE__GCA-2": zam, "PLV__GCA-3": plv.replace("Maveri", "Other"), "PHAGE__GCA-3": zam}
    rows = spark.createDataFrame([(k, v.split("|")) for k, v in labels.items()], "label string, ranks array<string>")
    evidence = spark.createDataFrame([("PHAGE__GCA-1",), ("MIRUS__b",), ("BAC__x",), ("PHAGE__GCA-3",)], "label string")
    formal = spark.createDataFrame([], "species string, ranks array<string>, taxid string, terminal_rank string")
    excluded = spark.createDataFrame([("BAC__x",)], "label string")
    got = {(r.label, r.kind, r.detail): r.value for r in harmonize.bundle(rows, evidence, formal, excluded=excluded).collect()}
    assert got[("VP__GCA-1", "active", "")] == "VP" + plv[3:]
    assert got[("VP__GCA-3", "active", "")] == "VP|Preplasmiviricota|Maveriviricetes|VP_unclassified|VP_unclassified|VP_unclassified|Zamilon virus"
    assert got[("PHAGE__GCA-1", "alias", "phage_virophage_relabel")] == got[("PLV__GCA-1", "alias", "plv_virophage_alias")] == "VP__GCA-1"
    assert got[("VP__GCA-1", "context", "original_phage_taxonomy")] == zam and got[("VP__GCA-1", "context", "original_plv_taxonomy")] == plv
    assert got[("MIRUS__a", "alias", "duplicate_taxonomy_without_faa")] == "MIRUS__b" and got[("MIRUS__b", "active", "")] == tax
    assert got[("BAC__lone", "inactive", "no_faa_evidence")] == labels["BAC__lone"] and got[("PHAGE__GCA-2", "inactive", "no_faa_evidence")] == zam
    assert got[("BAC__x", "inactive", "excluded")] == labels["BAC__x"]
    assert len(got) == 15


def test_grid_is_whole():
    configs = grid.config_grid()
    assert len(configs) == 384 and configs[0].name == "cfg_001" and configs[-1].name == "cfg_384"
    assert (configs[0].core, configs[0].w_core, configs[2].w_accessory) == (0.85, 0.7, 0.2)


def test_names_are_taken_once():
    with pytest.raises(ValueError):
        base.query()(registry.QUERIES["panel_completeness"])
    decorated = 0
    import pathlib

    for path in pathlib.Path(base.__file__).parent.glob("*_queries.py"):
        decorated += sum(line.startswith("@query(") for line in path.read_text().splitlines())
    assert len(registry.QUERIES) == decorated
