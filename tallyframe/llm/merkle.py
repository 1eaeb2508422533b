"""Merkle manifest of a dataset: a tree of digests for each group of rows, and one over the groups' roots.

Every ARITY consecutive nodes of a level, the last run fewer, become one: H of their digests. What remains of a group is its subroot;
the subroots, in order of group, likewise give the root.

The tree is built by events, as a combineByKey over parents. A task takes nodes in whatever order they come: a partial parent
accumulates its children's digests by their place until its arity, which follows from the group's size, is met; then the parent is an
event itself, and so on to the root. Parents that a task can't complete are its frontier: their children are dealt by the ancestor
ROUND levels further up and met again, so a group of n rows takes about log(n) / ROUND rounds. Rows are read in order, so the first
round already leaves few open nodes. Proofs go down the reverse links: blocks of ARITY ** ROUND nodes pass each node's
siblings, level by level, on to its children. No task holds more than a block of nodes besides its own split.

Defined cases: a null group is a group of its own, first of all; a null key comes before all others; ties in the key are ordered by
digest; repeated rows are leaves of their own; any text is hashed whole; an empty table has no leaves and no root; extra columns
take no part and names that clash with the columns made here are of no matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from tallyframe.llm.common import materialize, numbered

ARITY = 2
#: Levels that one round of shuffling closes: blocks of 4,096 nodes.
ROUND = 12

_NODE = "tree string, level int, idx long, digest string, size long, open boolean"


def encoded(*values: Column) -> Column:
    """Each value as its length in UTF-8 bytes, a colon and its text; null as a hyphen."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def leaf_digest(*values: Column) -> Column:
    return F.sha2(encoded(*values), 256)


def node_digest(children: Sequence[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def widths(size: int) -> list[int]:
    """Nodes of each level, from the leaves up to one."""
    out = [size]
    while out[-1] > 1:
        out.append(-(-out[-1] // ARITY))
    return out


def _index(leaves: DataFrame, order: Sequence[Column]) -> DataFrame:
    """leaves(tree, digest, ...) with idx, the place within tree by order, then digest, and size, the tree's leaves."""
    placed = numbered(leaves, "tree", [*order, F.col("digest").asc()], "merkle-index")
    return placed.withColumnsRenamed({"_place": "idx", "_size": "size"})


def _climb(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Nodes that complete here, and with open the children of parents that don't."""
    waiting: dict[tuple[str, int, int], dict[int, str]] = {}
    sizes: dict[str, list[int]] = {}
    out: list[tuple] = []
    for f in frames:
        for tree, level, idx, digest, size in zip(f["tree"], f["level"], f["idx"], f["digest"], f["size"], strict=True):
            level, idx, size = int(level), int(idx), int(size)
            if tree not in sizes:
                sizes[tree] = widths(size)
            wide = sizes[tree]
            while wide[level] > 1:
                parent = (tree, level + 1, idx // ARITY)
                arity = min(ARITY, wide[level] - ARITY * parent[2])
                if arity > 1:
                    met = waiting.setdefault(parent, {})
                    met[idx % ARITY] = digest
                    if len(met) < arity:
                        break
                    del waiting[parent]
                    digest = node_digest([met[k] for k in range(arity)])
                else:
                    digest = node_digest([digest])
                level, idx = level + 1, parent[2]
                out.append((tree, level, idx, digest, size, False))
        if len(out) >= 50_000:
            yield pd.DataFrame(out, columns=["tree", "level", "idx", "digest", "size", "open"])
            out = []
    for (tree, level, idx), met in waiting.items():
        out += [(tree, level - 1, idx * ARITY + k, d, sizes[tree][0], True) for k, d in met.items()]
    yield pd.DataFrame(out, columns=["tree", "level", "idx", "digest", "size", "open"])


def nodes_of(index: DataFrame) -> DataFrame:
    """(tree, level, idx, digest, size) of all nodes above the leaves of index(tree, idx, size, digest)."""
    done, at = [], index.select("tree", F.lit(0).alias("level"), "idx", "digest", "size")
    top = ROUND
    while True:
        met = materialize(at.mapInPandas(_climb, _NODE), "merkle-nodes")
        done.append(met.where("not open").drop("open"))
        left = met.where("open").drop("open")
        if left.isEmpty():
            break
        # all open nodes below one node of level `top` meet; those at or above it go on by themselves
        up = F.greatest(F.lit(top) - F.col("level"), F.lit(0))
        at = left.repartition("tree", F.greatest(F.col("level"), F.lit(top)), F.floor(F.col("idx") / F.pow(F.lit(float(ARITY)), up)))
        top += ROUND
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _block_proofs(own: pa.Table, inner: pa.Table, base: int, end: int) -> pa.Table:
    """own(tree, block, idx, size, digest, ...), the nodes of level base in one block that reaches up to level end, with their proofs.

    inner(tree, block, level, idx, digest, above): the block's nodes of higher levels, and at level -1 the block's own proof.
    """
    wide = widths(own["size"][0].as_py())
    top = min(end, len(wide) - 1)
    places = own["idx"].to_pylist()
    digest = {(base, i): d for i, d in zip(places, own["digest"].to_pylist(), strict=True)}
    above: list[str] = []
    for level, idx, d, proof in zip(*(inner[c].to_pylist() for c in ("level", "idx", "digest", "above")), strict=True):
        if level < 0:
            above = proof
        else:
            digest[level, idx] = d
    proofs = {places[0] // ARITY ** (top - base): above}
    for level in range(top - 1, base - 1, -1):
        below = {}
        for idx, proof in proofs.items():
            run = range(idx * ARITY, min(idx * ARITY + ARITY, wide[level]))
            for child in run:
                # L and R: on which side a sibling stands; a node without siblings has an entry as well
                beside = [("L" if s < child else "R") + digest[level, s] for s in run if s != child]
                below[child] = [*(beside or [""]), *proof]
        proofs = below
    kept = own.drop_columns(["block"])
    return kept.append_column("proof", pa.array([proofs[i] for i in places], pa.list_(pa.string())))


def _at_level(base: int, end: int):
    return lambda own, inner: _block_proofs(own, inner, base, end)


def _proofs(index: DataFrame, nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """index's columns and proof array<string>: siblings from the leaf up, each with its side, '' at levels without any.

    above(tree, above): the proof of a tree's root, which follows its leaves' own.
    """
    none = F.array().cast("array<string>")
    most = index.agg(F.max("size")).first()[0]
    if most is None:
        return index.withColumn("proof", none)
    tops = len(widths(most)) - 1
    roots = index.where("idx = 0").select("tree", "size")
    if above is not None:
        roots = roots.join(above, "tree", "left")
    else:
        roots = roots.withColumn("above", none)
    height = F.aggregate(F.sequence(F.lit(0), F.lit(tops)), F.struct(F.col("size").alias("n"), F.lit(0).alias("h")), _shrink, lambda a: a["h"])
    roots = materialize(roots.select("tree", "size", F.coalesce("above", none).alias("above"), height.alias("height")), "merkle-roots")
    passed: DataFrame | None = None
    for base in range(ROUND * (max(tops - 1, 0) // ROUND), -1, -ROUND):
        end = base + ROUND
        part = lambda level: F.floor(F.col("idx") / F.pow(F.lit(float(ARITY)), F.lit(end) - level)).cast("long").alias("block")  # noqa: B023, E731
        # block proofs: of the trees that end in this round, and what the round above has handed down
        here = (F.col("height") > base) & (F.col("height") <= end) if base else F.col("height") <= end
        heads = roots.where(here).select("tree", F.lit(0).cast("long").alias("block"), "above")
        if passed is not None:
            heads = heads.unionByName(passed.select("tree", F.col("idx").alias("block"), F.col("proof").alias("above")))
        own = index if not base else nodes.where(F.col("level") == base).join(roots.where(F.col("height") > base).select("tree"), "tree", "left_semi")
        own = own.select("tree", part(F.lit(base)), "size", "digest", "idx", *(c for c in index.columns if not base and c not in ("tree", "size", "digest", "idx")))
        own = own.toDF(*own.columns)  # own and inner may come from the same table
        inner = nodes.where((F.col("level") > base) & (F.col("level") < end)).select("tree", part(F.col("level")), "level", "idx", "digest", none.alias("above"))
        told = heads.select("tree", "block", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("idx"), F.lit("").alias("digest"), "above")
        schema = StructType([f for f in own.schema.fields if f.name != "block"]).add("proof", ArrayType(StringType()))
        down = own.groupBy("tree", "block").cogroup(inner.unionByName(told).groupBy("tree", "block"))
        passed = down.applyInArrow(_at_level(base, end), schema)
        if base:
            passed = materialize(passed.select("tree", "idx", "proof"), "merkle-proofs")
    return passed


def _shrink(acc: Column, _: Column) -> Column:
    grows = acc["n"] > 1
    return F.struct(F.when(grows, F.ceil(acc["n"] / ARITY)).otherwise(acc["n"]).alias("n"), F.when(grows, acc["h"] + 1).otherwise(acc["h"]).alias("h"))


@dataclass(frozen=True)
class Manifest:
    """What manifest() found: leaves(tree, idx, size, digest, ...), nodes above them, subroots(tree, subroot) and their own tree."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    over: DataFrame
    over_nodes: DataFrame

    def root(self) -> str | None:
        """The root; None for an empty table."""
        top = self.over_nodes.orderBy(F.desc("level")).select("digest").limit(1).union(self.over.select("digest").limit(1)).head()
        return top["digest"] if top else None

    def proofs(self) -> DataFrame:
        """The leaves with subroot and proof: each leaf's siblings up to the root. folded(digest, proof) is the root, unless something was changed."""
        top = _proofs(self.over, self.over_nodes, None)
        above = materialize(top.join(self.over.select("idx", F.col("of").alias("_of")), "idx").select(F.col("_of").alias("tree"), F.col("proof").alias("above")), "merkle-above")
        return _proofs(self.leaves.join(self.subroots, "tree"), self.nodes, above)


def manifest(docs: DataFrame, fields: Sequence[str], group: str = "lang", key: str = "doc_id", **carry: Column) -> Manifest:
    """The manifest of docs: a leaf of the given fields for each row, a tree for each group, leaves in order of key. carry: further columns of leaves."""
    named = F.col(f"`{group}`").cast("string")
    tree = F.coalesce(F.concat(F.lit("="), named), F.lit(""))  # null first, then by bytes
    rows = docs.select(
        tree.alias("tree"), leaf_digest(*(F.col(f"`{c}`") for c in fields)).alias("digest"), F.col(f"`{key}`").alias("_key"), *(c.alias(n) for n, c in carry.items())
    )
    leaves = _index(rows, [F.col("_key").asc_nulls_first()])
    nodes = nodes_of(leaves)
    lone = leaves.where("size = 1").select("tree", F.col("digest").alias("subroot"))
    tops = nodes.groupBy("tree").agg(F.max_by("digest", "level").alias("subroot"))
    subroots = materialize(lone.unionByName(tops), "merkle-subroots")
    over = _index(subroots.select(F.lit("over").alias("tree"), F.col("subroot").alias("digest"), F.col("tree").alias("of")), [F.col("of").asc()])
    return Manifest(leaves, nodes, subroots, over, nodes_of(over))


def siblings_digest(proof: Column) -> Column:
    """H of a proof's digests, from the leaf's level up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.substring(s, 2, 64)), ""), 256)


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to. Arity 2."""
    other = lambda s: F.substring(s, 2, 64)
    join = lambda d, s: F.when(s.startswith("L"), F.concat(other(s), d)).when(s.startswith("R"), F.concat(d, other(s))).otherwise(d)
    return F.aggregate(proof, digest, lambda d, s: F.sha2(join(d, s), 256))

