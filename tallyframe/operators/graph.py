"""Connected components and their curation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.staging import staged


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node reachable. Labels travel along edges and then along labels, so long chains halve each round.

    Every round's labels are a table in the shared folder.
    """
    ways = F.array(F.struct(F.col(a).alias("u"), F.col(b).alias("v")), F.struct(F.col(b).alias("u"), F.col(a).alias("v")))
    both = edges.select(F.explode(ways).alias("_e")).select("_e.*").where("u <> v").distinct()
    both = staged(both, "component-edges")
    labels = both.select(F.col("u").alias("node")).distinct().withColumn("component", F.col("node"))
    while True:
        named = labels.select(F.col("node").alias("v"), "component")
        near = both.join(named, "v").groupBy("u").agg(F.min("component").alias("seen"))
        lower = labels.join(near, labels["node"] == near["u"]).select("node", F.least("component", "seen").alias("component"), F.col("component").alias("was"))
        point = lower.select(F.col("node").alias("component"), F.col("component").alias("root"))
        jumped = staged(lower.join(point, "component").select("node", F.col("root").alias("component"), "was"), "component-labels")
        changed = not jumped.where("component <> was").isEmpty()
        labels = jumped.select("node", "component")
        if not changed:
            return labels


def overlap_groups(pairs: DataFrame, least_overlap: float, least_shared: int) -> DataFrame:
    """Components over the pairs(a, b, shared, overlap) that reach both floors."""
    return connected_components(pairs.where((F.col("overlap") >= least_overlap) & (F.col("shared") >= least_shared)), "a", "b")


def curate(groups: DataFrame, drop: DataFrame | None = None, force: DataFrame | None = None) -> DataFrame:
    """groups(node, component) without drop(node), and with force(node, component) in place of what was found."""
    out = groups
    if drop is not None:
        out = out.join(drop.select("node"), "node", "left_anti")
    if force is not None:
        out = out.join(force.select("node"), "node", "left_anti").unionByName(force.select("node", "component"))
    return out


def group_flags(groups: DataFrame, notes: DataFrame) -> DataFrame:
    """(component, n_members, annotated, coherence, dominant, flag) from groups(node, component) and notes(node, note)."""
    joined = groups.join(notes, "node", "left").withColumn("note", F.when(F.trim("note") != "", F.col("note")))
    sizes = joined.groupBy("component").agg(F.count("*").alias("n_members"), F.count("note").alias("annotated"))
    tops = joined.where("note is not null").groupBy("component", "note").agg(F.count("*").alias("n"))
    lead = tops.groupBy("component").agg(F.min(F.struct((-F.col("n")).alias("o"), F.col("note").alias("v"))).alias("t"))
    out = sizes.join(lead, "component", "left").select("component", "n_members", "annotated", F.coalesce(-F.col("t.o"), F.lit(0)).alias("n_top"), F.col("t.v").alias("dominant"))
    coherence = F.coalesce(F.try_divide(F.col("n_top") * 1.0, F.col("annotated")), F.lit(0.0))
    flag = F.when(F.col("annotated") == 0, "no_annotation").when((F.col("annotated") >= 3) & (coherence < 0.6), "REVIEW_mixed").otherwise("ok")
    return out.select("component", "n_members", "annotated", coherence.alias("coherence"), "dominant", flag.alias("flag"))


def recut(groups: DataFrame, drop: DataFrame, dissolve: DataFrame, splits: DataFrame, force: DataFrame) -> DataFrame:
    """(node, component, forced): groups(node, component) after expert corrections; only groups of two or more are left.

    A component with a node of dissolve(node) goes. One with the seed of splits(seed, piece, node) is replaced by that seed's pieces, of its
    own nodes only, named `component/piece`; the first seed by name counts. From the others the nodes of drop(node) go; they are forced if a
    node of force(node) was in them.
    """
    has = lambda nodes: groups.join(nodes.select("node"), "node", "left_semi").select("component").distinct()
    open_ = groups.join(has(dissolve), "component", "left_anti")
    seeds = splits.select(F.col("seed").alias("node")).distinct()
    split = open_.join(seeds, "node").groupBy("component").agg(F.min("node").alias("seed"))
    pieces = open_.join(split, "component").join(splits.select("seed", "piece", "node"), ["seed", "node"])
    cut = pieces.select("node", F.concat_ws("/", F.col("component").cast("string"), F.col("piece").cast("string")).alias("component"), F.lit(False).alias("forced"))
    forced = has(force).withColumn("forced", F.lit(True))
    rest = open_.join(split.select("component"), "component", "left_anti").join(drop.select("node"), "node", "left_anti").join(forced, "component", "left")
    out = rest.select("node", F.col("component").cast("string").alias("component"), F.coalesce("forced", F.lit(False)).alias("forced")).unionByName(cut)
    whole = out.groupBy("component").agg(F.count("*").alias("_n")).where("_n >= 2").select("component")
    return out.join(whole, "component", "left_semi").select("node", "component", "forced")
