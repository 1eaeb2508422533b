"""Benchmark decontamination by a distributed positional inverted index, in DataFrame functions only.

The index has postings (term, doc, pos) of the training text for the terms that matter: of each benchmark window the
rarest terms, by their count in the training text. A window's occurrences are found by intersecting the posting
lists of its rarest terms, each shifted by the term's offset in the window; the few survivors are then compared with
the window word by word, which makes phrase matches exact. Proximity matches use the same postings.

Words are runs of characters outside the ASCII non-alphanumerics, with A-Z as a-z. A window is `width` consecutive words
of an item; an item of fewer words, but some, is one window.

Defined cases: null or wordless text has no words and is clean; repeated rows and repeated ids are judged by id (an id's
rows are told apart by a hash of their text); an empty benchmark hits nothing; null item ids are left out of items_sha256;
extra columns are ignored, or kept by drop_contaminated, whatever their names; texts of any length count whole; windows equally
rare are taken in order of place.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import materialize, packed, unpacked

#: Rows of a table from the benchmark up to which it may be broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 100_000
ANCHORS = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, in order."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _GAP), "")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of a counted size only."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def windows(items: DataFrame, width: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(window, w array<string>) without repeats, and (window, item): window names the words by their SHA-256."""
    w = F.col("w")
    n = F.size(w)
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n - F.lit(width) + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    cut = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).select("item", "w", F.explode(starts).alias("i"))
    named = cut.select("item", F.expr(f"slice(w, i, {width})").alias("w")).withColumn("window", F.sha2(F.concat_ws(" ", "w"), 256))
    named = materialize(named.select("window", "item", "w"), "windows")
    return named.select("window", "w").dropDuplicates(["window"]), named.select("window", "item").distinct()


class PositionalIndex:
    """Postings of training text. key is the row's (id, hash of text)."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        self.docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def counts(self, terms: DataFrame, n_terms: int) -> DataFrame:
        """How often each of terms(term) occurs in the training text; terms that never occur are left out."""
        every = self.docs.select(F.explode(words(F.col("text"))).alias("term"))
        if n_terms <= BROADCAST_ROWS:
            return every.join(F.broadcast(terms), "term").groupBy("term").agg(F.count("*").alias("cf"))
        return every.groupBy("term").agg(F.count("*").alias("cf")).join(terms, "term")  # each task counts first, so common words are few rows

    def postings(self, terms: DataFrame, n_terms: int) -> DataFrame:
        """(term, id, hash, pos) of the given terms."""
        every = self.docs.select("id", F.xxhash64("text").alias("hash"), F.posexplode(words(F.col("text"))).alias("pos", "term"))
        parts = -(-n_terms // BROADCAST_ROWS) or 1
        # beyond a broadcast's size the terms go in parts, each met where the words are: words are never shuffled
        met = (every.join(F.broadcast(terms.where(F.pmod(F.xxhash64("term"), F.lit(parts)) == i) if parts > 1 else terms), "term") for i in range(parts))
        return functools.reduce(DataFrame.unionByName, met)


def phrase_matches(docs: DataFrame, found_windows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, hash, window, start, stop) of every exact occurrence of found_windows(window, w) in docs, positions in words."""
    index = PositionalIndex(docs, id_col, text_col)
    at = found_windows.select("window", F.posexplode("w").alias("off", "term"))
    terms = at.select("term").distinct()
    counted = materialize(index.counts(terms, terms.count()), "term-counts")
    rated = at.join(counted, "term", "left")
    # a window with a term that training text lacks occurs nowhere
    alive = rated.groupBy("window").agg(
        F.min(F.coalesce("cf", F.lit(0))).alias("least"), F.max("off").alias("last"),
        F.sort_array(F.collect_list(F.struct("cf", "off", "term"))).alias("by_rarity"),
    ).where("least > 0")
    anchors = materialize(
        alive.select("window", F.least(F.col("last") + 1, F.lit(ANCHORS)).alias("k"), F.explode(F.slice("by_rarity", 1, ANCHORS)).alias("a"))
        .select("window", "k", "a.term", "a.off"),
        "anchors",
    )
    rare = anchors.select("term").distinct()
    posted = materialize(index.postings(rare, rare.count()), "postings")
    n_anchors = anchors.count()
    shifted = posted.join(_small(anchors, n_anchors), "term").select("window", "k", "id", "hash", (F.col("pos") - F.col("off")).alias("start"), "off")
    met = shifted.where("start >= 0").groupBy("window", "id", "hash", "start").agg(F.count("*").alias("n"), F.first("k").alias("k")).where("n >= k")
    # repeated rows add equal postings, which only lets more through to the comparison
    spots = met.select("window", "id", "hash", "start").join(_small(found_windows, found_windows.count()), "window")
    asked = materialize(spots.groupBy("id", "hash").agg(F.collect_list(F.struct("window", "start", "w")).alias("spots")), "spots")
    n_spots = asked.agg(F.sum(F.size("spots"))).first()[0] or 0
    keyed = index.docs.withColumn("hash", F.xxhash64("text"))
    same = F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.hash") == F.col("s.hash"))
    held = keyed.alias("d").join(_small(asked, n_spots).alias("s"), same).select("s.id", "s.hash", words(F.col("d.text")).alias("d"), "s.spots")
    true = held.select("id", "hash", F.explode(F.filter("spots", lambda s: F.slice(F.col("d"), s["start"] + 1, F.size(s["w"])) == s["w"])).alias("s"))
    return true.select("id", "hash", "s.window", "s.start", (F.col("s.start") + F.size("s.w")).alias("stop")).distinct()


def proximity_matches(docs: DataFrame, term_lists: DataFrame, slop: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(list, id, start, stop): the spans of at most `slop` words in which all terms of term_lists(list, terms) occur in any order.

    Reported once for each place of the rarest term that has every other term within reach.
    """
    index = PositionalIndex(docs, id_col, text_col)
    at = term_lists.select("list", F.explode(F.array_distinct("terms")).alias("term"))
    terms = at.select("term").distinct()
    n = terms.count()
    counted = index.counts(terms, n)
    rated = at.join(counted, "term", "left").groupBy("list").agg(
        F.min(F.coalesce("cf", F.lit(0))).alias("least"), F.min(F.struct("cf", "term")).alias("rarest"), F.count("*").alias("k")
    ).where("least > 0")
    posted = materialize(index.postings(terms, n).distinct(), "postings").join(at, "term")
    lead = posted.join(rated, "list").where(F.col("term") == F.col("rarest.term")).select("list", "k", "id", "hash", F.col("pos").alias("lead"))
    near = lead.join(posted, ["list", "id", "hash"]).where(F.abs(F.col("pos") - F.col("lead")) < slop)
    per_term = near.groupBy("list", "k", "id", "hash", "lead", "term").agg(F.collect_set("pos").alias("places"))
    joined = per_term.groupBy("list", "k", "id", "hash", "lead").agg(F.count("*").alias("n"), F.collect_list("places").alias("places")).where("n = k")
    # the span from some first place s on needs, of each term, a place in [s, s + slop)
    first = F.filter(
        F.sequence(F.col("lead") - slop + 1, F.col("lead")),
        lambda s: F.forall("places", lambda p: F.exists(p, lambda x: (x >= s) & (x < s + slop))),
    )
    return joined.select("list", "id", F.try_element_at(first, F.lit(-1)).alias("start")).where("start is not null").select(
        "list", F.col("id").alias(id_col), "start", (F.col("start") + slop).alias("stop")
    ).distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row for each row of docs: id_col, hash, n_words, n_hit, n_items, items_sha256, contaminated (n_hit > 0 and 20 n_hit >= n_words)."""
    distinct, owners = windows(benchmark, width, item_col, item_text_col)
    found = materialize(phrase_matches(docs, distinct, id_col, text_col), "matches")
    spans = found.select("id", "hash", "start", "stop").distinct().groupBy("id", "hash").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    hit = F.aggregate(
        "spans", zero,
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["stop"]).alias("upto"),
            (acc["n"] + F.greatest(s["stop"] - F.greatest(acc["upto"], s["start"]), F.lit(0))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    items = found.select("id", "hash", "window").distinct().join(owners, "window").groupBy("id", "hash").agg(F.array_sort(F.collect_set("item")).alias("items"))
    marks = spans.select("id", "hash", hit.alias("n_hit")).alias("m").join(
        items.alias("i"), F.col("m.id").eqNullSafe(F.col("i.id")) & (F.col("m.hash") == F.col("i.hash")), "left"
    ).select("m.id", "m.hash", "n_hit", "items")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    counted = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), F.size(words(text)).cast("long").alias("n_words"))
    same = F.col("c.id").eqNullSafe(F.col("k.id")) & (F.col("c.hash") == F.col("k.hash"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    none = F.array().cast("array<string>")
    return counted.alias("c").join(marks.alias("k"), same, "left").select(
        F.col("c.id").alias(id_col), F.col("c.hash").alias("hash"), "n_words", n_hit.alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the contaminated rows, same columns."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    judged = contamination(docs, benchmark, **options).where("contaminated").select(F.col(id_col).alias("id"), "hash").distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = packed(docs, id=F.col(id_col), hash=F.xxhash64(text))
    same = F.col("r.id").eqNullSafe(F.col("j.id")) & (F.col("r.hash") == F.col("j.hash"))
    return rows.alias("r").join(judged.alias("j"), same, "left_anti").select(unpacked(docs))
