"""N-gram Jaccard join with prefix filters under several global token orders.

A document is its set of distinct k-word shingles. Under any global order of tokens, two sets whose Jaccard
similarity reaches the threshold share a token among their first n - ceil(t * n) + 1. The first order puts tokens
that the corpus repeats last, so that prefixes hold rare tokens; the others are independent permutations. A
candidate shares a prefix token under the first order at positions that still allow the needed overlap; the
prefixes under every order then bound the overlap from above, and a pair must pass all bounds before its whole sets
are compared.

Equal sets are one class from the start. The classes' links are found in rounds, so that no block of many
similar documents is expanded into all pairs: in each of the first rounds every member of a block meets one leader of the
block, and components of verified links are formed; in the last round only pairs of one block that lie in different
components are compared. Every linking pair shares a block, so after the last round the components are exact.

In a block two rows are a pair only if their positions leave room for the overlap and if their parity sketches allow it: each token
flips one of 128 bits, so the bits in which two sketches differ are no more than the tokens that only one of the sets has.

Rows of very frequent tokens are dealt over salted tasks when repeated tokens are told from single ones; a block's leader comes
from an aggregation, and the rows join it.

Defined cases: null or blank text has no shingles and links with nothing; repeated rows and copies are one class;
a row without id shares its copies' component but no text is fetched by it: a class of such rows alone stays apart, its component null;
texts of any length count whole; tokens equally frequent are ordered by their hash; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import discard, materialize, mix, shingle_hashes

#: The most repeated tokens that are kept apart, a bound on what is broadcast (16 bytes each).
FREQUENT = 50_000
#: A frequent token's rows are dealt over sub-blocks of about this many.
BLOCK_ROWS = 20_000
#: Rounds in which the members of a block meet its leader, before the pairs left are compared.
TURNS = 2
_SEEDS = (0x1B873593, 0x5BD1E995)


def _frequent_tokens(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that stand out as repeated, and about how often: sums of each task's own counts of 5 or more.

    They only shape the order of tokens, so missing some costs time, never a link.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def tally() -> pd.DataFrame:
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= 5
            tokens, n = tokens[many], n[many]
            if len(n) > FREQUENT:
                top = np.argpartition(-n, FREQUENT)[:FREQUENT]
                tokens, n = tokens[top], n[top]
            return pd.DataFrame({"token": tokens.view(np.int64), "n": n.astype(np.int64)})

        for frame in frames:
            for text in frame["text"]:
                found = shingle_hashes(text, k)
                if len(found):
                    held.append(found)
                    size += len(found)
                if size > 8_000_000:
                    yield tally()
                    held, size = [], 0
        if held:
            yield tally()

    top = (
        docs.select("text").mapInPandas(count, "token long, n long")
        .groupBy("token").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas()
    )
    top = top.sort_values("token")
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["n"].to_numpy(np.int64)[order]


def _class_of(shingles: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(shingles, digest_size=8).digest(), "little", signed=True)


def _sketch(s: np.ndarray) -> tuple[int, int]:
    """128 parity bits: each token flips the bit that its seven lowest bits name."""
    odd = (np.bincount((s & np.uint64(127)).astype(np.int64), minlength=128) & 1).astype(np.uint8)
    return tuple(np.packbits(odd).view(np.int64).tolist())


def _needed(nx, ny, num: int, den: int):
    """The smallest overlap with which sets of these sizes link."""
    return -(-(num * (nx + ny)) // (num + den))


def _bound(px: np.ndarray, py: np.ndarray, nx: int, ny: int) -> int:
    """At most how many tokens two sets of these sizes share, by their sorted prefixes under one order.

    Keys may repeat, and a key equal to a prefix's last may lie outside it too, so only keys below the last ones are matched.
    """
    limits = ([px[-1]] if len(px) < nx else []) + ([py[-1]] if len(py) < ny else [])
    if limits:
        px, py = px[px < min(limits)], py[py < min(limits)]
    x, y = np.unique(px), np.unique(py)
    return len(np.intersect1d(x, y, assume_unique=True)) + min(len(px) - len(x), len(py) - len(y)) + min(nx - len(px), ny - len(py))


def _prefixes(docs: DataFrame, k: int, num: int, den: int, tokens: np.ndarray, counts: np.ndarray) -> DataFrame:
    """For each row: size, class (a hash of the set) and the prefix under each order; p1 with its rows' salts."""
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast((tokens, np.argsort(np.argsort(counts, kind="stable"), kind="stable").astype(np.uint64), counts))

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, rank, often = common.value
        top = np.uint64(1 << 62)
        for frame in frames:
            rows = []
            for text in frame["text"]:
                s = shingle_hashes(text, k)
                n = len(s)
                if not n:
                    rows.append((0, None, None, None, None, None, None, None))
                    continue
                cls = _class_of(s.tobytes())
                size = n - -(-num * n // den) + 1
                at = np.searchsorted(known, s) if len(known) else np.zeros(n, np.int64)
                at[at == len(known)] = 0
                heavy = known[at] == s if len(known) else np.zeros(n, bool)
                first = s >> np.uint64(2)
                first[heavy] = top + rank[at[heavy]]
                order = np.argsort(first)[:size]
                split = np.ones(size, np.int64)
                split[heavy[order]] = -(-often[at[order][heavy[order]]] // BLOCK_ROWS)
                salts = np.where(split > 1, 1 + np.abs(np.int64(cls >> 3)) % split, 0).astype(np.int32)  # 0: not salted
                others = []
                for seed in _SEEDS:
                    key = mix(s ^ np.uint64(seed)) >> np.uint64(34)
                    key[heavy] |= np.uint64(1 << 30)
                    others.append(np.sort(np.partition(key, size - 1)[:size]).astype(np.int32))
                rows.append((n, cls, *_sketch(s), first[order].astype(np.int64), salts if split.max() > 1 else None, *others))
            columns = dict(zip(["n", "cls", "b1", "b2", "p1", "salts", "p2", "p3"], zip(*rows, strict=True), strict=True)) if rows else {}
            for c in ("cls", "b1", "b2"):  # a frame would make floats of integers beside nulls
                columns[c] = pd.array(columns.get(c, []), dtype="Int64")
            yield pd.DataFrame({"id": frame["id"], "no_id": frame["no_id"], **columns})

    given = docs.select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("no_id"), "text")
    built = given.mapInPandas(build, "id long, no_id boolean, n int, cls long, b1 long, b2 long, p1 array<long>, salts array<int>, p2 array<int>, p3 array<int>")
    return built.withColumn("id", F.when(~F.col("no_id"), F.col("id"))).drop("no_id")


def _scan_repeats(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by token, salt, n, pos, cls: those of tokens that two classes have, each class once. A salted token is
    frequent, so its rows all stay. Holds a batch and a row, however many rows a token has."""
    names = ["token", "salt", "n", "pos", "cls"]
    held: list[np.ndarray] | None = None
    before = False  # whether the held row's token has another class before it
    for frame in frames:
        a = [frame[c].to_numpy() for c in names]
        if held is not None:
            a = [np.concatenate((x, y)) for x, y in zip(held, a, strict=True)]
        token = (a[0][1:] == a[0][:-1]) & (a[1][1:] == a[1][:-1])
        fresh = np.concatenate(([True], ~(token & (a[4][1:] == a[4][:-1]))))
        a, token = [x[fresh] for x in a], token[fresh[1:]]
        keep = np.concatenate(([before], token)) | np.concatenate((token, [False])) | (a[1] > 0)
        held, before = [x[-1:] for x in a], bool(token[-1]) if len(token) else before
        yield pd.DataFrame({c: x[:-1][keep[:-1]] for c, x in zip(names, a, strict=True)})
    if held is not None and (before or held[1][0] > 0):
        yield pd.DataFrame(dict(zip(names, held, strict=True)))


def _repeated(rows: DataFrame) -> DataFrame:
    keys = ["token", "salt"]
    sorted_rows = rows.repartition(*keys).sortWithinPartitions(*keys, "n", "pos", "cls")
    return sorted_rows.mapInPandas(_scan_repeats, "token long, salt int, n int, pos int, cls long")


def _admissible(num: int, den: int) -> Column:
    """Whether rows a and b of one block may be a pair: different components, room for the overlap, sketches near enough."""
    need = F.expr(f"((n_a + n_b) * {num} + {num + den - 1}) div {num + den}")
    apart = F.bit_count(F.col("b1_a").bitwiseXOR(F.col("b1_b"))) + F.bit_count(F.col("b2_a").bitwiseXOR(F.col("b2_b")))
    room = (F.col("n_a") - F.col("pos_a") >= need) & (F.col("n_b") - F.col("pos_b") >= need)
    return (F.col("comp_a") != F.col("comp_b")) & room & (apart <= F.col("n_a") + F.col("n_b") - 2 * need)


_ROW = ["n", "pos", "cls", "comp", "b1", "b2"]


def _side(rows: DataFrame, at: str) -> DataFrame:
    return rows.select("token", *(F.col(c).alias(f"{c}_{at}") for c in _ROW))


def _led_pairs(rows: DataFrame, num: int, den: int, turn: int) -> DataFrame:
    """Pairs of each block's leader and its other members. First the row nearest to the block's beginning leads, later a random one."""
    first = F.col("pos") if turn == 0 else F.xxhash64(F.lit(turn), "cls").cast("long")
    leads = rows.groupBy("token").agg(F.min(F.struct(first.alias("o"), *_ROW)).alias("lead")).select("token", *(F.col(f"lead.{c}").alias(f"{c}_a") for c in _ROW))
    met = _side(rows, "b").join(leads, "token").where(_admissible(num, den))
    return met.select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")).distinct()


def _open_pairs(rows: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs of one block that lie in different components."""
    met = _side(rows, "a").join(_side(rows, "b"), "token").where(F.col("cls_a") < F.col("cls_b")).where(_admissible(num, den))
    return met.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct()


def _verified(pairs: DataFrame, table: DataFrame, reps: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs that pass the prefix bounds of all orders and then the comparison of whole sets, as a written table of edges of ids."""
    prefix = ["n", "p1", "p2", "p3"]
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(reps, "cls")
    have = table.join(nodes.select(F.col("rep").alias("id"), "cls"), ["id", "cls"], "left_semi").dropDuplicates(["cls"])
    side = lambda at: have.select(F.col("cls").alias(at), *(F.col(c).alias(f"{c}_{at}") for c in prefix))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def admit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ok = np.zeros(len(f), bool)
            for r, (nx, ny, *arrays) in enumerate(zip(*(f[f"{c}_{at}"] for c in prefix for at in "ab"), strict=True)):
                need = _needed(nx, ny, num, den)
                ok[r] = den * min(nx, ny) >= num * max(nx, ny) and all(
                    _bound(x, y, nx, ny) >= need for x, y in zip(arrays[::2], arrays[1::2], strict=True)
                )
            yield f.loc[ok, ["a", "b"]]

    left = materialize(joined.mapInPandas(admit, "a long, b long"), "jaccard-candidates")
    wanted = left.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(reps, "cls").select(F.col("rep").alias("id"), "cls")

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = pd.DataFrame({"id": f["id"], "cls": f["cls"], "s": [shingle_hashes(t, k).tobytes() for t in f["text"]]})
            yield out[[_class_of(s) == c for s, c in zip(out["s"], out["cls"], strict=True)]]  # an id may have several texts

    found = wanted.join(docs, "id").mapInPandas(sets, "id long, cls long, s binary")
    whole = materialize(found.dropDuplicates(["cls"]), "jaccard-sets")
    side = lambda at: whole.select(F.col("cls").alias(at), F.col("id").alias(f"id_{at}"), F.col("s").alias(f"s_{at}"))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ok = np.zeros(len(f), bool)
            for r, (x, y) in enumerate(zip(f["s_a"], f["s_b"], strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                ok[r] = den * shared >= num * (len(x) + len(y) - shared)
            yield f.loc[ok, ["id_a", "id_b"]].set_axis(["u", "v"], axis=1)

    links = materialize(left.join(side("a"), "a").join(side("b"), "b").mapInPandas(compare, "u long, v long"), "jaccard-links")
    discard(left, whole)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of edges(u, v); comp is the smallest node reachable.

    Alternates large and small stars: each round links a node's larger, then smaller neighbours to its least one.
    Every round is a written table, so a lost executor costs one round at most.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        far = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        least = far.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        met = far.join(least, "u")
        if large:
            return met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        return met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
            least.select("u", F.col("m").alias("v")).where("u <> v")
        )

    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, seen = materialize(ordered, "components"), None
    while True:
        mark = now.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) % 1000000007 as bigint))")).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        seen, before = mark, now
        now = materialize(star(star(before, True).distinct(), False).distinct(), "components")
        discard(before)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """One row for each row of docs: id_col, n_shingles, component_id (the smallest id reachable by links).

    Two rows link when den * |intersection| >= num * |union| of their distinct k-word shingles, A-Z as a-z.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    tokens, counts = _frequent_tokens(docs, k)
    table = materialize(_prefixes(docs, k, num, den, tokens, counts), "jaccard-prefixes")
    whole = table.where("n > 0")
    reps = materialize(whole.groupBy("cls").agg(F.min("id").alias("rep"), F.min("b1").alias("b1"), F.min("b2").alias("b2")), "jaccard-classes")

    posted = whole.select("n", "cls", F.posexplode(F.expr("arrays_zip(p1, coalesce(salts, array_repeat(0, size(p1))))")).alias("pos", "t"))
    rows = posted.select(F.col("t.p1").alias("token"), F.col("t.1").alias("salt"), "n", "pos", "cls")
    repeated = _repeated(rows).drop("salt")
    open_rows = materialize(repeated.join(reps, "cls").where("rep is not null").withColumn("comp", F.col("rep")), "jaccard-rows")

    linked: list[DataFrame] = []
    for turn in range(TURNS + 1):
        last = turn == TURNS
        pairs = materialize(_open_pairs(open_rows, num, den) if last else _led_pairs(open_rows, num, den, turn), "jaccard-pairs")
        linked.append(_verified(pairs, table, reps, docs, k, num, den))
        discard(pairs)
        named = components(functools.reduce(DataFrame.unionByName, linked))
        if not last:  # only tokens whose rows lie in several components stay open
            moved = open_rows.join(named, open_rows["rep"] == named["node"], "left")
            now = moved.select("token", "n", "pos", "cls", "rep", "b1", "b2", F.coalesce(named["comp"], "rep").alias("comp"))
            split = now.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
            before, open_rows = open_rows, materialize(now.join(split, "token", "left_semi"), "jaccard-rows")
            discard(before)
    discard(open_rows, *linked)
    final = reps.join(named, reps["rep"] == named["node"], "left").select("cls", F.coalesce("comp", "rep").alias("comp"))
    return table.select("id", "n", "cls").join(final, "cls", "left").select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.coalesce("comp", "id").alias("component_id")
    )
