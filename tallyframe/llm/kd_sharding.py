"""K-d tree sharding: near equal bytes, with rows that are alike in their metadata side by side.

A tree over numeric metadata dimensions is grown level by level. Each open node is split along its widest dimension, in units of
that dimension's whole range, at a weighted quantile: the median if its two sides get as many shards. The quantile is found by
distributed histograms that narrow the interval in which it lies; ties on a dimension are told apart by a hash of the text, so the
split is as even as the rows allow. Rows with equal text have one place in every dimension, so they share a shard. The driver keeps one
row for each of at most MOST_NODES nodes; nodes that still hold several shards then are split further by running sums within each,
without the driver.

Sizes are UTF-8 bytes of the text plus 1. Slots number a shard's rows without gaps: rows are ordered within hashed
buckets of bounded size, and the buckets' counts are summed up.

Defined cases: null text has size 1; null metadata counts as the least value; repeated rows each have a slot of their own; an empty table
gives no rows; a text with more than a shard's bytes stays whole; points equal on all metadata are told apart by a hash of the text;
extra columns are kept by shard(), whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyframe.llm.common import materialize, packed, unpacked

#: Parts of a histogram.
PARTS = 256
#: The share of a node's bytes by which a split may miss.
MISS = 0.0005
#: Nodes of which the driver keeps a row. Below them each node's points, not texts, are sorted in one task.
MOST_NODES = 4_096
#: Texts that more than one row in HOT has, fewer than HOT of them, are placed by broadcast.
HOT = 1_000
#: Rows of a bucket for slots, about.
BUCKET_ROWS = 20_000
_KEY_BITS = 31


@dataclass
class Node:
    """Shards first .. first + shards - 1; dim and at say where it is split, if it is."""

    first: int
    shards: int
    dim: int | None = None
    at: int | None = None
    low: float = 0.0
    high: float = 0.0


def _place(low, high, value, tie):
    """A row's place along a dimension as one integer: the value scaled to 31 bits, then 31 bits of the hash."""
    scaled = F.when(high > low, F.floor((F.coalesce(value, low) - low) / (high - low) * F.lit(float((1 << _KEY_BITS) - 1)))).otherwise(F.lit(0)).cast("long")
    return F.shiftleft(scaled, _KEY_BITS) + tie


def assign(points: DataFrame, dims: list[str], shards: int) -> DataFrame:
    """points(key, tie, weight, *dims) with their shard. Points are distinct by key."""
    if shards < 1:
        raise ValueError("at least one shard")
    spark = points.sparkSession
    whole = points.agg(*(F.min(d) for d in dims), *(F.max(d) for d in dims)).first()
    span = [(whole[len(dims) + i] or 0) - (whole[i] or 0) for i in range(len(dims))]
    now = points.withColumn("node", F.lit(0))
    open_nodes, done = {0: Node(0, shards)}, shards == 1 or whole[0] is None
    while not done:
        stats = now.groupBy("node").agg(
            F.sum("weight").alias("weight"), *(F.min(d).alias(f"lo{i}") for i, d in enumerate(dims)), *(F.max(d).alias(f"hi{i}") for i, d in enumerate(dims))
        ).collect()
        search = {}
        for r in stats:
            node = open_nodes[r["node"]]
            if node.shards == 1:
                continue
            width = [(r[f"hi{i}"] - r[f"lo{i}"]) / span[i] if span[i] else 0.0 for i in range(len(dims))]
            node.dim = width.index(max(width))
            node.low, node.high = float(r[f"lo{node.dim}"]), float(r[f"hi{node.dim}"])
            goal = r["weight"] * (node.shards // 2) / node.shards
            search[r["node"]] = [0, 1 << (2 * _KEY_BITS), 0, goal, r["weight"]]  # from, to, weight below, goal, all
        if not search:
            break
        told = [(k, open_nodes[k].dim, open_nodes[k].low, open_nodes[k].high) for k in search]
        table = F.broadcast(spark.createDataFrame(told, "node int, dim int, low double, high double"))
        value = F.coalesce(*(F.when(F.col("dim") == i, F.col(d).cast("double")) for i, d in enumerate(dims)))
        placed = materialize(now.join(table, "node").select("node", "weight", _place(F.col("low"), F.col("high"), value, F.col("tie")).alias("place")), "kd-places")
        ready: dict[int, int] = {}
        while len(ready) < len(search):
            left = [(k, s[0], s[1]) for k, s in search.items() if k not in ready]
            ends = F.broadcast(spark.createDataFrame(left, "node int, a long, b long"))
            part = F.expr(f"least((place - a) div greatest((b - a + {PARTS - 1}) div {PARTS}, 1), {PARTS - 1})")
            inside = placed.join(ends, "node").where("place >= a and place < b").select("node", part.alias("part"), "weight")
            sums: dict[int, dict[int, int]] = {}
            for r in inside.groupBy("node", "part").agg(F.sum("weight").alias("w")).collect():
                sums.setdefault(r["node"], {})[r["part"]] = r["w"]
            for k, a, b in left:
                s, step = search[k], max(-(-(b - a) // PARTS), 1)
                below = s[2]
                ready[k] = b  # nothing left to tell apart
                for p in sorted(sums.get(k, {})):
                    w = sums[k][p]
                    if below + w >= s[3]:
                        lo, hi = a + p * step, min(a + (p + 1) * step, b)
                        near = s[3] - below <= below + w - s[3]
                        if step == 1 or min(s[3] - below, below + w - s[3]) <= MISS * s[4]:
                            ready[k] = lo if near else hi
                        else:
                            del ready[k]
                            s[0], s[1], s[2] = lo, hi, below
                        break
                    below += w
        nodes, split = {}, []
        for k, node in open_nodes.items():
            if k not in search:
                nodes[2 * k + 1] = Node(node.first, node.shards)
                split.append((k, 0, 0.0, 0.0, -1))
                continue
            half = node.shards // 2
            nodes[2 * k + 1], nodes[2 * k + 2] = Node(node.first, half), Node(node.first + half, node.shards - half)
            split.append((k, node.dim, node.low, node.high, ready[k]))
        cuts = F.broadcast(spark.createDataFrame(split, "node int, dim int, low double, high double, at long"))
        right = (F.col("at") >= 0) & (_place(F.col("low"), F.col("high"), value, F.col("tie")) >= F.col("at"))
        now = materialize(
            now.join(cuts, "node").select("key", "tie", "weight", *dims, (F.col("node") * 2 + 1 + right.cast("int")).alias("node")), "kd-nodes"
        )
        open_nodes = nodes
        done = all(n.shards == 1 for n in nodes.values()) or len(nodes) >= MOST_NODES
    leaves = F.broadcast(spark.createDataFrame([(k, n.first, n.shards) for k, n in open_nodes.items()], "node int, shard int, shards int"))
    placed, most = now.join(leaves, "node").drop("node"), max(n.shards for n in open_nodes.values())
    while most > 1 and whole[0] is not None:
        placed, most = materialize(_halved(placed, dims, span), "kd-halves"), most - most // 2
    return placed.drop("shards")


def _halved(now: DataFrame, dims: list[str], span: list[float]) -> DataFrame:
    """points(key, tie, weight, *dims, shard, shards) with each node of several shards split in two along its widest dimension."""
    node = W.partitionBy("shard")
    width = [(F.max(d).over(node) - F.min(d).over(node)) / F.lit(float(w)) if w else F.lit(0.0) for d, w in zip(dims, span, strict=True)]
    marked = now.withColumn("_w", F.array(*width)).withColumn("_dim", F.array_position("_w", F.array_max("_w")))
    value = F.element_at(F.array(*(F.col(d).cast("double") for d in dims)), F.col("_dim").cast("int"))
    before = F.coalesce(F.sum("weight").over(node.orderBy("_v", "tie", "key").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    half = F.floor(F.col("shards") / 2).cast("int")
    middle = marked.withColumn("_v", value).withColumns({"_m": before + F.col("weight") / 2, "_all": F.sum("weight").over(node)})
    right = (F.col("shards") > 1) & (F.col("_m") * F.col("shards") > F.col("_all") * half)
    left = (F.col("shards") > 1) & ~right
    return middle.select("key", "tie", "weight", *dims, F.when(right, F.col("shard") + half).otherwise(F.col("shard")).alias("shard"), F.when(left, half).otherwise(F.col("shards") - F.when(right, half).otherwise(0)).alias("shards"))


def _metadata(docs: DataFrame, text_col: str, source_col: str | None, lang_col: str | None) -> DataFrame:
    """Rows' key, size and numeric dimensions. Names are placed by a hash, which keeps a name's rows together."""
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    name = lambda c: F.pmod(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(1009)).cast("double") if c else F.lit(0.0)
    return docs.select(
        F.coalesce(F.sha2(text, 256), F.lit("")).alias("key"), size.alias("size"),
        F.log2(size.cast("double")).alias("by_size"), name(source_col).alias("by_source"), name(lang_col).alias("by_lang"),
    )


DIMS = ["by_size", "by_source", "by_lang"]


def text_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, text_col="text", source_col="source", lang_col="lang") -> DataFrame:
    """(key, shard, n): the shard of each distinct text and its rows, key as in _metadata. Copies lie where the copy with the least
    metadata lies."""
    rows = _metadata(docs, text_col, source_col, lang_col)
    points = rows.groupBy("key").agg(F.sum("size").alias("weight"), F.min("size").alias("size"), *(F.min(d).alias(d) for d in DIMS))
    tie = F.pmod(F.xxhash64("key"), F.lit(1 << _KEY_BITS))
    points = materialize(points.withColumn("tie", tie), "kd-points")
    if shards is None:
        total = points.agg(F.sum("weight")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    return assign(points.drop("size"), DIMS, shards).join(points.select("key", F.expr("weight div size").alias("n")), "key").select("key", "shard", "n")


def shard(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col="doc_id", text_col="text", source_col="source", lang_col="lang"
) -> DataFrame:
    """docs' columns and _size, _shard, _slot, which replace columns of these names."""
    placed, n = materialize(text_shards(docs, shards, target_bytes, text_col, source_col, lang_col), "kd-texts"), docs.count()
    text = F.col(text_col).cast("string")
    key = F.coalesce(F.sha2(text, 256), F.lit(""))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    hot = placed.where(F.col("n") * HOT > n).select(F.col("key").alias("_tf_hot"), F.col("shard").alias("_tf_hot_shard"))
    tagged = packed(docs, _size=size, _tf_key=key, _tf_id=F.coalesce(F.col(id_col).cast("string"), F.lit(""))).join(F.broadcast(hot), F.col("_tf_key") == F.col("_tf_hot"), "left")
    # rows of hot texts have their shard already: they go where their id sends them and meet nothing
    apart = F.concat(F.lit("#"), F.xxhash64("_tf_id").cast("string"))
    met = tagged.withColumn("_tf_join", F.when(F.col("_tf_hot").isNull(), F.col("_tf_key")).otherwise(apart))
    met = met.join(placed.select(F.col("key").alias("_tf_join"), F.col("shard").alias("_tf_shard")), "_tf_join", "left")
    rows = met.withColumn("_shard", F.coalesce("_tf_hot_shard", "_tf_shard"))
    return _slots(rows, unpacked(docs, ("_size", "_shard", "_slot")), n)


def _slots(rows: DataFrame, columns: list[Column], n: int) -> DataFrame:
    buckets = max(1, n // BUCKET_ROWS)
    own = F.xxhash64("_tf_id", "_tf_key")
    rows = rows.withColumns({"_tf_own": own, "_tf_bucket": F.pmod(own, F.lit(buckets)).cast("int")})
    counts = rows.groupBy("_shard", "_tf_bucket").agg(F.count("*").alias("_tf_n"))
    before = W.partitionBy("_shard").orderBy("_tf_bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("_shard", "_tf_bucket", F.coalesce(F.sum("_tf_n").over(before), F.lit(0)).alias("_tf_base"))
    numbered = rows.withColumn("_tf_rn", F.row_number().over(W.partitionBy("_shard", "_tf_bucket").orderBy("_tf_own")) - 1)
    joined = numbered.join(bases, ["_shard", "_tf_bucket"])
    return joined.select(*columns, "_size", "_shard", (F.col("_tf_base") + F.col("_tf_rn")).alias("_slot"))
