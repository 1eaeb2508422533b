"""Rerooting, placements, prefix joins, sequence indexes, fragments: cases worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import fragments, joins, rank, tree
from tallyframe.sources import fasta_index


def trees(spark, **texts):
    return tree.edges_of(spark.createDataFrame(list(texts.items()), "name string, newick string"), "name", "newick")


def distances(spark, edges):
    leaves = edges.where("leaf is not null").select("tree", "leaf")
    return {(r.tree, r.a, r.b): round(r.dist, 9) for r in tree.patristic(edges, leaves, leaves).collect()}


def test_open_brackets_give_no_tree(spark):
    assert {r.tree for r in trees(spark, a="(x:1,y:2);", b="(x,y", c="((x,y);", d="x,y);", e="").where("leaf is not null").collect()} <= {"a", "e"}


def test_rerooting_keeps_distances(spark):
    e = trees(spark, t="((a:1,b:2):3,(c:4,(d:5,e:6):7):8);", u="(a:1,b:2,(c:3,d:4):5);", v="(a:1,(b:2,c:3):4);")
    before = distances(spark, e)
    for leaf in "abc":
        turned = tree.rerooted(e, spark.createDataFrame([("t", leaf), ("u", leaf), ("v", leaf)], "tree string, leaf string"))
        assert distances(spark, turned) == before
        rows = turned.collect()
        for name in "tuv":
            mine = [r for r in rows if r.tree == name]
            root = [r for r in mine if r.parent is None]
            assert len(root) == 1
            under = [r for r in mine if r.parent == root[0].node]
            assert len(under) == 2 and leaf in [r.leaf for r in under] and under[0].length == under[1].length or name == "v"
            children = {}
            for r in mine:
                children.setdefault(r.parent, []).append(r.node)
            assert all(len(c) >= 2 for p, c in children.items() if p is not None)


def test_placements_by_hand(spark):
    """q1 and q2 are a clade however the tree is rooted; q3 is alone. Rooted as written, q1 and q2 look split by the root."""
    e = trees(spark, t="(q1:1,(q2:1,((r1:1,q3:2):1,(r2:2,r3:2):1):3):1);", none="(q1:1,q2:1);", refs="(r1:1,r2:1);")
    asked = spark.createDataFrame([(t, q) for t in ("t", "none") for q in ("q1", "q2", "q3")], "tree string, leaf string")
    labels = spark.createDataFrame([("r1", "d_X")], "leaf string, taxonomy string")
    got = {r.query: r for r in tree.placements(e, asked, labels).collect()}
    assert set(got) == {"q1", "q2", "q3"}
    assert {r.tree for r in got.values()} == {"t"}
    assert (got["q3"].nn_genome, got["q3"].nn_taxonomy, got["q3"].nn_distance, got["q3"].clade_id, got["q3"].clade_mean_dist) == ("r1", "d_X", 3.0, "", None)
    for q, d in (("q1", 7.0), ("q2", 6.0)):
        r = got[q]
        assert (r.nn_genome, r.nn_distance, r.clade_id, r.clade_members, r.clade_mean_dist, r.clade_ref_dist) == ("r1", d, "q1", "q1;q2", 3.0, 6.0)


def test_prefixes_of_any_length(spark):
    names = spark.createDataFrame([("abc",), ("ab",), ("xyz",), ("",), (None,)], "name string")
    prefixes = spark.createDataFrame([("a",), ("abc",), ("b",), (None,), ("",)], "prefix string")
    got = sorted((r.name, r.prefix) for r in joins.prefix_join(names, "name", prefixes, "prefix").collect())
    assert got == [("", ""), ("ab", ""), ("ab", "a"), ("abc", ""), ("abc", "a"), ("abc", "abc"), ("xyz", "")]
    plan = joins.prefix_join(names, "name", prefixes, "prefix")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert joins.prefix_join(names, "name", prefixes.limit(0), "prefix").count() == 0


def test_index_over_splits_reads_ranges(spark, tmp_path):
    """Splits of a few bytes, multi-byte letters, records without sequence; records nobody asks for are never read."""
    records = [(f"s{i}", f"s{i} é note {i}", "ACGT" * (i % 7)) for i in range(200)]
    text = "".join(f">{d}\n" + "".join(s[j : j + 10] + "\n" for j in range(0, len(s), 10)) for _, d, s in records)
    (tmp_path / "a.faa").write_text(text)
    (tmp_path / "b.faa").write_text(">s3 again\nTTTT\n>lone\nGG")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        index = fasta_index.build_index(spark, str(tmp_path)).cache()
        assert index.count() == 202
        data = {"a.faa": text.encode(), "b.faa": b">s3 again\nTTTT\n>lone\nGG"}
        for r in index.collect():
            part = data[r.path.rsplit("/", 1)[1]][r.start : r.start + r.length]
            assert part.startswith(f">{r.description}".encode()) and part.count(b">") == 1
        asked = spark.createDataFrame([("s5",), ("s7 é note 7",), ("s3",), ("lone",), ("absent",), ("s0",)], "name string")
        got = {r.name: (r.how, r.seq) for r in fasta_index.fetch(index, asked, "name").collect()}
        assert got == {"s5": ("id", "ACGT" * 5), "s7 é note 7": ("description", ""), "s3": ("id", "TTTT"), "lone": ("id", "GG"), "s0": ("id", "")}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fragments_tile_their_contigs(spark):
    rule = fragments.Lengths(mean=1000, sigma=0.8, least=300, most=4000, long=1500)
    sizes = [0, 1, 299, 300, 301, 1499, 1500, 2600, 9999, 50_000, 333_333]
    contigs = spark.createDataFrame([(f"c{n}", n) for n in sizes], "id string, n int")
    got = {}
    for r in fragments.fragments(contigs, "id", "n", rule).collect():
        got.setdefault(r.id, []).append((r.fragment, r.start, r.length))
    assert "c0" not in got
    for n in sizes[1:]:
        cut = sorted(got[f"c{n}"])
        assert sum(x for _, _, x in cut) == n and [s for _, s, _ in cut] == [sum(x for _, _, x in cut[:i]) for i in range(len(cut))]
        assert min(x for _, _, x in cut) >= min(n, 300)
        assert n < 1500 or max(x for _, _, x in cut) >= 1500
    again = fragments.fragments(contigs.repartition(7), "id", "n", rule)
    assert sorted((r.id, r.fragment, r.start, r.length) for r in again.collect()) == sorted((k, *f) for k, v in got.items() for f in v)
    assert len(got["c333333"]) > 100
    with pytest.raises(ValueError):
        fragments.Lengths(mean=10, sigma=1, least=5, most=5, long=6)


def test_order_decides_between_codes(spark):
    rows = [("g", "meta", 5, 1.0, 80.0), ("g", "c1", 5, 1.0, 82.0), ("g", "c4", 5, 1.0, 81.5), ("h", "meta", 5, 1.0, 80.0), ("h", "c4", 5, 1.0, 81.7), ("h", "c1", 6, 0.1, 1.0), ("z", "meta", 0, 0.0, 0.0), ("z", "c1", 9, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "g string, code string, hits int, score double, density double")
    got = {r.g: r.best for r in rank.override_in_order(df, ["g"], "code", ["meta", "c1", "c4"], "hits", "score", "density").collect()}
    assert got == {"g": "c1", "h": "c1", "z": "meta"}
    assert rank.override_in_order(df.where(F.col("code") != "meta"), ["g"], "code", ["meta", "c1"], "hits", "score", "density").count() == 0
