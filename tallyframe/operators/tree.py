"""Operators over trees held as edge tables (tree, node, parent, length, leaf): leaf names a leaf and is null elsewhere; the root's parent is null."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.joins import prefix_join
from tallyframe.operators.rank import best, top_n
from tallyframe.operators.staging import staged, tasks_for

#: Pairs of node and ancestor that one task joins.
PAIRS_PER_TASK = 250_000
EDGE_SCHEMA = "tree string, node int, parent int, length double, leaf string"


def parse_newick(text: str) -> list[tuple[int, int | None, float, str | None]]:
    """(node, parent, length, leaf) in order of appearance."""
    nodes: list[list] = [[0, None, 0.0, None]]
    at, i, parents = 0, 0, set()
    while i < len(text) and text[i] != ";":
        c = text[i]
        if c in "(,":
            parent = at if c == "(" else nodes[at][1]
            if parent is None:
                raise ValueError(f"a comma outside brackets at {i}")
            parents.add(parent)
            nodes.append([len(nodes), parent, 0.0, None])
            at, i = len(nodes) - 1, i + 1
        elif c == ")":
            at, i = nodes[at][1], i + 1
            if at is None:
                raise ValueError(f"an unmatched bracket at {i}")
        elif c.isspace():
            i += 1
        else:
            end = i
            if c == "'":
                end = text.index("'", i + 1) + 1
            while end < len(text) and text[end] not in "(),;":
                end += 1
            name, _, length = text[i:end].strip().rpartition(":") if ":" in text[i:end] else (text[i:end].strip(), "", "")
            nodes[at][3] = name.strip("'") or nodes[at][3]
            nodes[at][2] = float(length) if length else 0.0
            i = end
    if nodes[at][1] is not None:
        raise ValueError("an unclosed bracket")
    return [(n, p, d, None if n in parents else leaf) for n, p, d, leaf in nodes]


def edges_of(trees: DataFrame, tree: str, newick: str) -> DataFrame:
    """Edge rows of trees in Newick text; unreadable trees give none."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for name, text in zip(f[tree], f[newick], strict=True):
                try:
                    rows += [(str(name), *r) for r in parse_newick(text or ";")]
                except ValueError:
                    continue
            out = pd.DataFrame(rows, columns=["tree", "node", "parent", "length", "leaf"])
            yield out.astype({"parent": "Int32"})

    return trees.select(tree, newick).mapInPandas(parse, EDGE_SCHEMA)


def ancestors(edges: DataFrame) -> DataFrame:
    """(tree, node, ancestor, dist, hops): every node with itself and all above it, in as many joins as the log of the depth.

    Each round doubles the reach and is a table of its own, so no round is computed twice. The rows are dealt by node to as many tasks as
    their number asks for, and joins here are merges: a tree's tables are narrow, and what is few bytes when shuffled is many when every task
    and the driver hold it as a map.
    """
    none = edges.select("tree", "node", F.col("node").alias("ancestor"), F.lit(0.0).alias("dist"), F.lit(0).alias("hops"))
    one = edges.where("parent is not null").select("tree", "node", F.col("parent").alias("ancestor"), F.col("length").alias("dist"), F.lit(1).alias("hops"))
    reach, far = staged(one, "tree-reach"), 1
    rounds = [none, reach]
    while True:
        up = rounds[-1].where(F.col("hops") == far)
        if up.isEmpty():
            n = sum(r.count() for r in rounds[1:])
            return functools.reduce(DataFrame.unionByName, rounds).repartition(tasks_for(edges.sparkSession, n, PAIRS_PER_TASK), "tree", "node").hint("merge")
        up = up.select("tree", F.col("node").alias("ancestor"), F.col("ancestor").alias("_top"), F.col("dist").alias("_more"))
        both = F.col("dist") + F.col("_more")
        new = reach.join(up.hint("merge"), ["tree", "ancestor"]).select("tree", "node", F.col("_top").alias("ancestor"), both.alias("dist"), (F.col("hops") + far).alias("hops"))
        rounds.append(staged(new, "tree-reach"))
        reach, far = reach.unionByName(rounds[-1]), 2 * far


def patristic(edges: DataFrame, left: DataFrame, right: DataFrame, up: DataFrame | None = None) -> DataFrame:
    """(tree, a, b, dist) for leaves left(tree, leaf) and right(tree, leaf). up: what ancestors(edges) gave.

    Two leaves meet at the one node which they reach over different children, so each pair is made once.
    """
    leaves = edges.where("leaf is not null").select("tree", "node", "leaf")
    step = edges.where("parent is not null").select("tree", F.col("node").alias("via"), F.col("parent").alias("meet"), "length")
    below = (ancestors(edges) if up is None else up).select("tree", "node", F.col("ancestor").alias("via"), "dist")

    def side(who: DataFrame, name: str) -> DataFrame:
        mine = leaves.join(who.select("tree", "leaf").hint("merge"), ["tree", "leaf"])
        climbed = below.join(mine, ["tree", "node"]).join(step.hint("merge"), ["tree", "via"])
        return climbed.select("tree", "meet", F.col("via").alias(f"v_{name}"), F.col("leaf").alias(name), (F.col("dist") + F.col("length")).alias(f"d_{name}"))

    met = side(left, "a").join(side(right, "b").hint("merge"), ["tree", "meet"]).where("v_a <> v_b")
    return met.select("tree", "a", "b", (F.col("d_a") + F.col("d_b")).alias("dist"))


def pair_distances(pairs: DataFrame, edges: DataFrame, up: DataFrame) -> DataFrame:
    """pairs(tree, a, b, ...) of leaves with dist: the least over the nodes above both, so no other pair is made."""
    climbed = up.join(edges.where("leaf is not null").select("tree", "node", "leaf"), ["tree", "node"]).select("tree", "leaf", "ancestor", "dist")
    a = climbed.select("tree", F.col("leaf").alias("a"), "ancestor", F.col("dist").alias("_a"))
    b = climbed.select("tree", F.col("leaf").alias("b"), "ancestor", F.col("dist").alias("_b"))
    keys = pairs.select("tree", "a", "b").distinct()
    met = keys.join(a.hint("merge"), ["tree", "a"]).join(b.hint("merge"), ["tree", "b", "ancestor"]).groupBy("tree", "a", "b").agg(F.min(F.col("_a") + F.col("_b")).alias("dist"))
    return pairs.join(met.hint("merge"), ["tree", "a", "b"])


def nearest_reference(distances: DataFrame) -> DataFrame:
    """(tree, a, b, dist): each leaf's nearest, distances alike to nine digits being tied and the name deciding."""
    rounded = distances.withColumn("key", F.round("dist", 9))
    return best(rounded, ["tree", "a"], ["key", "b"], carry=["dist"]).select("tree", "a", "b", "dist")


def nearest_genomes(distances: DataFrame, genome: str, k: int) -> DataFrame:
    """(tree, a, genome, b, dist, rank): the nearest leaf of each genome, then the k nearest genomes."""
    one = best(distances, ["tree", "a", genome], ["dist", "b"])
    return top_n(one, ["tree", "a"], [F.col("dist").asc(), F.col(genome).asc()], k, "rank")


def nearest_below(edges: DataFrame, queries: DataFrame, references: DataFrame, up: DataFrame) -> DataFrame:
    """(tree, a, b, dist): for each of queries(tree, leaf) the nearest of references(tree, leaf); ties to nine digits go by name.

    Each node keeps the nearest reference below it, each query looks at the nodes above it: no pairs of queries and references.
    """
    leaves = edges.where("leaf is not null").select("tree", "node", "leaf")
    climbed = lambda who: up.join(leaves.join(who.select("tree", "leaf").hint("merge"), ["tree", "leaf"]), ["tree", "node"])
    order = lambda d, name: F.struct(F.round(d, 9).alias("key"), name.alias("name"), d.alias("dist"))
    best_below = climbed(references).groupBy("tree", "ancestor").agg(F.min(order(F.col("dist"), F.col("leaf"))).alias("n"))
    seen = climbed(queries).join(best_below.hint("merge"), ["tree", "ancestor"])
    one = seen.groupBy("tree", F.col("leaf").alias("a")).agg(F.min(order(F.col("dist") + F.col("n.dist"), F.col("n.name"))).alias("n"))
    return one.select("tree", "a", F.col("n.name").alias("b"), F.col("n.dist").alias("dist"))


def top_k_neighbors(edges: DataFrame, queries: DataFrame, prefixes: DataFrame, genome: Column, k: int) -> DataFrame:
    """(tree, query, genome, leaf, dist, rank): for each of queries(tree, query) the k genomes whose leaves are nearest to its own.

    A query's leaves start with its name; neighbours start with one of prefixes(prefix) and are not the query's. genome is an expression of
    leaf. A genome counts by its nearest leaf, the first by name among equals; equal genomes go by name.
    """
    each = queries.select("tree", "query").distinct()
    copies = edges.join(each, "tree").withColumn("_t", F.concat_ws("\x1f", "tree", "query"))  # a tree with several queries is searched for each
    leaves = copies.where("leaf is not null").select("_t", "query", "leaf")
    own = F.startswith(F.col("leaf"), F.col("query"))
    asked = leaves.where(own).select(F.col("_t").alias("tree"), "leaf")
    kept = prefix_join(leaves.where(~own).select(F.col("_t").alias("tree"), "leaf"), "leaf", prefixes.select("prefix").distinct(), "prefix").select("tree", "leaf").distinct()
    alone = copies.select(F.col("_t").alias("tree"), "node", "parent", "length", "leaf")
    near = nearest_below(alone, kept, asked, ancestors(alone)).select("tree", F.col("a").alias("leaf"), "dist")
    named = near.withColumn("genome", genome)
    one = best(named, ["tree", "genome"], ["dist", "leaf"])
    ranked = top_n(one, ["tree"], [F.col("dist").asc(), F.col("genome").asc()], k, "rank")
    told = each.withColumn("_t", F.concat_ws("\x1f", "tree", "query"))
    return ranked.withColumnRenamed("tree", "_t").join(told, "_t").select("tree", "query", "genome", "leaf", "dist", F.col("rank").cast("int").alias("rank"))


def query_clades(edges: DataFrame, queries: DataFrame, up: DataFrame | None = None) -> DataFrame:
    """(tree, node, members, size): the maximal clades whose leaves are all queries(tree, leaf)."""
    members = _clade_members(edges, queries, ancestors(edges) if up is None else up)
    return members.groupBy("tree", "node").agg(F.array_join(F.array_sort(F.collect_list("leaf")), ";").alias("members"), F.count("*").cast("int").alias("size"))


def _clade_members(edges: DataFrame, queries: DataFrame, up: DataFrame) -> DataFrame:
    """(tree, node, leaf, at) of the maximal clades of queries: at is the leaf's own node. Names are only moved for these clades."""
    leaves = edges.where("leaf is not null").select("tree", "node", "leaf")
    marked = leaves.join(queries.select("tree", "leaf", F.lit(True).alias("q")).hint("merge"), ["tree", "leaf"], "left").withColumn("q", F.coalesce("q", F.lit(False)))
    pure = up.join(marked.select("tree", "node", "q"), ["tree", "node"]).groupBy("tree", F.col("ancestor").alias("node")).agg(F.bool_and("q").alias("pure")).where("pure")
    pure = staged(pure.select("tree", "node"), "tree-clades")
    above = pure.select("tree", F.col("node").alias("parent"))
    top = edges.select("tree", "node", F.coalesce("parent", F.lit(-1)).alias("parent")).join(pure.hint("merge"), ["tree", "node"], "left_semi").join(above.hint("merge"), ["tree", "parent"], "left_anti")
    inside = up.join(top.select("tree", F.col("node").alias("ancestor")), ["tree", "ancestor"])
    return staged(inside.join(leaves.hint("merge"), ["tree", "node"]).select("tree", F.col("ancestor").alias("node"), "leaf", F.col("node").alias("at")), "tree-members")


def clade_spread(edges: DataFrame, queries: DataFrame, up: DataFrame | None = None, members: DataFrame | None = None) -> DataFrame:
    """(tree, node, mean_dist, pairs): the mean distance between the members of each maximal clade of queries, 0 for a lone member.

    An edge with k of a clade's m leaves below it lies on the paths of k * (m - k) pairs, so no pair is made.
    """
    up = ancestors(edges) if up is None else up
    members = _clade_members(edges, queries, up) if members is None else members
    sizes = members.groupBy("tree", "node").agg(F.count("*").alias("m"))
    below = up.select("tree", F.col("node").alias("at"), F.col("ancestor").alias("edge"))
    parts = members.join(below, ["tree", "at"]).groupBy("tree", "node", "edge").agg(F.count("*").alias("k"))
    lengths = edges.select("tree", F.col("node").alias("edge"), F.coalesce("length", F.lit(0.0)).alias("length"))
    # edges at or above the clade's node have all leaves below them and add nothing
    sums = parts.join(sizes.hint("merge"), ["tree", "node"]).where("k < m").join(lengths.hint("merge"), ["tree", "edge"]).groupBy("tree", "node").agg(F.sum(F.col("length") * F.col("k") * (F.col("m") - F.col("k"))).alias("sum"))
    pairs = F.expr("m * (m - 1) div 2")
    return sizes.join(sums.hint("merge"), ["tree", "node"], "left").select("tree", "node", F.coalesce(F.try_divide(F.coalesce("sum", F.lit(0.0)), pairs), F.lit(0.0)).alias("mean_dist"), pairs.alias("pairs"))


def rerooted(edges: DataFrame, outgroups: DataFrame, up: DataFrame | None = None) -> DataFrame:
    """edges with the root in the middle of the edge above outgroups(tree, leaf), one leaf a tree; trees without one stay as they are.

    The edges from the leaf up to the old root are reversed: each node on that path hangs below the one that it carried. The new root
    has the number after the tree's largest; the old one is left out if it now only continues one edge, as are distances unchanged.
    """
    up = ancestors(edges) if up is None else up
    leaf = edges.where("leaf is not null and parent is not null").join(outgroups.select("tree", "leaf"), ["tree", "leaf"])
    path = staged(up.join(leaf.select("tree", "node"), ["tree", "node"]).select("tree", F.col("ancestor").alias("node"), "hops"), "tree-path")
    new_root = edges.groupBy("tree").agg((F.max("node") + 1).alias("new")).join(leaf.select("tree", (F.col("length") / 2).alias("half")), "tree")
    here = path.join(edges.select("tree", "node", "length", "leaf").hint("merge"), ["tree", "node"])
    carried = here.select("tree", (F.col("hops") + 1).alias("hops"), F.col("node").alias("below"), F.col("length").alias("was"))
    turned = here.join(carried, ["tree", "hops"], "left").join(new_root, "tree")
    ends = F.col("hops") <= 1  # the outgroup and the node above it
    turned = turned.select("tree", "node", F.when(ends, F.col("new")).otherwise(F.col("below")).alias("parent"), F.when(ends, F.col("half")).otherwise(F.col("was")).alias("length"), "leaf")
    rest = edges.select("tree", "node", "parent", "length", "leaf").join(path.select("tree", "node").hint("merge"), ["tree", "node"], "left_anti")
    tops = new_root.select("tree", F.col("new").alias("node"), F.lit(None).cast("int").alias("parent"), F.lit(0.0).alias("length"), F.lit(None).cast("string").alias("leaf"))
    made = staged(rest.unionByName(turned).unionByName(tops), "tree-turned")
    # the old root, if one child is left to it, is spliced out
    old = edges.where("parent is null").join(leaf.select("tree"), "tree", "left_semi").select("tree", "node")
    held = made.join(old.select("tree", F.col("node").alias("parent")), ["tree", "parent"]).groupBy("tree", F.col("parent").alias("node")).agg(F.count("*").alias("n"))
    gone = made.join(held.where("n = 1").select("tree", "node"), ["tree", "node"]).select("tree", F.col("node").alias("parent"), F.col("parent").alias("_to"), F.col("length").alias("_more"))
    kept = made.join(gone.select("tree", F.col("parent").alias("node")), ["tree", "node"], "left_anti").join(gone, ["tree", "parent"], "left")
    out = kept.select("tree", "node", F.coalesce("_to", "parent").cast("int").alias("parent"), (F.col("length") + F.coalesce("_more", F.lit(0.0))).alias("length"), "leaf")
    return staged(out, "tree-rooted")


def placements(edges: DataFrame, queries: DataFrame, labels: DataFrame) -> DataFrame:
    """(tree, query, nn_genome, nn_taxonomy, nn_distance, clade_id, clade_members, clade_mean_dist, clade_ref_dist) for queries(tree, leaf).

    Trees are rooted on their first reference by name, so that clades of queries do not depend on how a tree was rooted. A query that
    is alone in its clade gets its own nearest reference and blank clade columns; members of a clade share the reference that is
    nearest to any of them. labels(leaf, taxonomy): unlabelled references are 'unknown'. Trees without a query or without a reference give no rows.
    """
    leaves = edges.where("leaf is not null").select("tree", "leaf")
    asked = leaves.join(queries.select("tree", "leaf").distinct(), ["tree", "leaf"], "left_semi")
    references = leaves.join(queries.select("tree", "leaf"), ["tree", "leaf"], "left_anti")
    rooted = rerooted(edges, references.groupBy("tree").agg(F.min("leaf").alias("leaf")))
    up = ancestors(rooted)
    members = _clade_members(rooted, asked, up)
    near = staged(nearest_below(rooted, asked, references, up), "tree-near")
    first = F.min(F.struct(F.round("dist", 9).alias("key"), F.col("b").alias("name"), "dist"))
    clades = members.join(near.withColumnRenamed("a", "leaf").hint("merge"), ["tree", "leaf"]).groupBy("tree", "node").agg(
        F.array_sort(F.collect_list("leaf")).alias("names"), first.alias("n"), F.count("*").alias("size")
    )
    spread = clade_spread(rooted, asked, up, members).select("tree", "node", "mean_dist")
    told = members.select("tree", "node", "leaf").join(clades.join(spread.hint("merge"), ["tree", "node"]).hint("merge"), ["tree", "node"])
    pairs = told.select("tree", F.col("leaf").alias("a"), F.col("n.name").alias("b"), "names", "size", "mean_dist", F.col("n.dist").alias("ref_dist"))
    placed = pair_distances(staged(pairs, "tree-pairs"), rooted, up).join(labels.select(F.col("leaf").alias("b"), "taxonomy"), "b", "left")
    clade = F.col("size") >= 2
    return placed.select(
        "tree", F.col("a").alias("query"), F.col("b").alias("nn_genome"), F.coalesce("taxonomy", F.lit("unknown")).alias("nn_taxonomy"), F.col("dist").alias("nn_distance"),
        F.when(clade, F.element_at("names", 1)).otherwise("").alias("clade_id"), F.when(clade, F.array_join("names", ";")).otherwise("").alias("clade_members"),
        F.when(clade, F.col("mean_dist")).alias("clade_mean_dist"), F.when(clade, F.col("ref_dist")).alias("clade_ref_dist"),
    )


def mean_pairwise(distances: DataFrame, keys: list[str]) -> DataFrame:
    return distances.where("a < b").groupBy(*keys).agg(F.avg("dist").alias("mean_dist"), F.count("*").alias("pairs"))
