"""A training corpus from documents, in five stages. Each stage gets what its predecessor kept, as a table.

In every stage null text counts as empty, texts of any length count whole, repeated rows are rows of their own unless a stage says
otherwise, an empty table gives an empty table, and columns beyond those that a stage reads are kept, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate, jaccard_join, kd_sharding, mixing, quality
from tallyframe.llm.common import materialize, packed, scratch, unpacked
from tallyframe.llm.queries import MIX, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects.

    Null and empty texts have no features and are judged by the thresholds alone; equal texts are judged alike, so a tie at KEEP stays
    for all of them; without labels of two grades all rows stay.
    """
    return quality.select_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component linked at 0.8 over five-word shingles: the one with the smallest id, rows without id last.

    Texts are linked by a hash of the text, not by id, so an id's several texts are judged apart and rows without id link too. Rows
    without shingles link with nothing and stay, but for repeats of one id and text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    rows = packed(docs, key=F.xxhash64(text), id=F.col("doc_id"), at=named, blank=F.translate(text, " \t\n\x0b\f\r", "") == "")
    found = jaccard_join.jaccard_components(docs.select(F.xxhash64(text).alias("key"), text.alias("text")), "key", k=5, num=80, den=100).distinct()
    firsts = rows.groupBy("key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at")).alias("first"))
    linked = found.where("n_shingles > 0").join(firsts, "key")
    best = linked.groupBy("component_id").agg(F.min(F.struct("first.none", "first.id", "key", "first.at")).alias("b"))
    chosen = materialize(best.select("b.key", "b.at"), "near-copies")
    # rows meet the choice by text and id, so copies of one text do not meet in one task; rows equal in both are one
    worded = rows.where("not blank").join(chosen, ["key", "at"], "left_semi").dropDuplicates(["key", "at"])
    bare = rows.where("blank and at <> ''").dropDuplicates(["key", "at"])
    parts = (worded, bare, rows.where("blank and at = ''"))
    return functools.reduce(DataFrame.unionByName, (p.select(unpacked(docs)) for p in parts))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that benchmark passages contaminate.

    Rows without words, null texts among them, stay; equal texts stay or go together; a row whose hit words are exactly a twentieth goes.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tempered mixture: every document at least once, a source's documents at most twice.

    Null sources are one source; rows without words stay once; rows equal in id and text are taken together; the row that crosses a
    source's quota is taken.
    """
    return mixing.temperature_mix(docs, MIX).select(docs.columns)


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with size, shard and slot, which replace columns of these names: 8 shards of near equal bytes.

    Equal texts share a shard; ties on all metadata are told apart by a hash of the text; a text larger than a shard stays whole.
    """
    placed = kd_sharding.shard(docs, shards=8)
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("size", "shard", "slot")]
    return placed.select(*own, F.col("_size").alias("size"), F.col("_shard").alias("shard"), F.col("_slot").cast("long").alias("slot"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_quality),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("kd_sharding", into_shards),
]

#: The classifier is not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
