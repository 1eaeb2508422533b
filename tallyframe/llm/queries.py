"""The operators as registered queries: thin bindings that give the columns fixed for each result."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import conversation_repair, decontaminate, jaccard_join, kd_sharding, media_columns, merkle, mixing, preference_chat, quality, quality_rules, secret_scan, token_store, twins, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def op1_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write pages to archives, read them back."""
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents through a fresh ledger."""
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op3_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as shards and read back through the index."""
    read = token_store.keyed_read(table(spark, sf_dir, "documents"), tokenizer_path())
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc").alias("ids_crc32"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at 0.9 over three-word shingles."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of all documents."""
    docs = table(spark, sf_dir, "documents")
    rated = quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return rated.select(
        "doc_id", F.col("_expected_grade").alias("expected_grade"), F.col("_p_low").alias("p_low"), F.col("_p_good").alias("p_good"),
        (F.col("_p_good") >= quality.KEEP).alias("keep"),
    )


def op6_media_sniffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as stored media, sniffed and read back."""
    return media_columns.media_features(media_columns.media_column(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of all documents by windows of 13 words."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hash")


def op8_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) as prompt and masked completions."""
    made = preference_chat.preference_pairs(table(spark, sf_dir, "conversations"))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return made.select("pair_id", "n_common", "prompt", "chosen", "rejected", text("chosen_mask").alias("chosen_mask"), text("rejected_mask").alias("rejected_mask"))


def op9_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    placed = kd_sharding.shard(docs.withColumn("text_crc32", crc), shards=8)
    return placed.select(
        "doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), F.col("_shard").alias("shard"),
        F.col("_slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


#: The mixture of the query and of the pipeline: every source at least once, none more than twice.
MIX = mixing.Mix(repetition=2.0)


def op10_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture's rows: each document as often as it is taken, with its place."""
    mixed = mixing.temperature_mix(table(spark, sf_dir, "documents"), MIX)
    return mixed.select("doc_id", "source", F.col("_tokens").alias("tokens"), F.col("_epoch").alias("epoch"), F.col("_block").alias("block"), F.col("_slot").alias("slot"))


#: The fields of a document's leaf, in their order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents; leaves whose id the sample of changed rows holds are checked with n_chars one too high."""
    docs = table(spark, sf_dir, "documents")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(21,0)")
    changed = merkle.leaf_digest(*(more if c == "n_chars" else F.col(c) for c in LEAF))
    touched = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    made = merkle.manifest(docs, LEAF, doc_id=F.col("doc_id"), changed=F.when(touched, changed))
    root = F.lit(made.root()).cast("string")
    again = merkle.folded(F.coalesce("changed", "digest"), F.col("proof"))
    told = made.proofs().select("doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), merkle.siblings_digest(F.col("proof")).alias("proof_sha256"), again.alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by its hashes, with its faults and its repair."""
    turns = table(spark, sf_dir, "conversations")
    found = conversation_repair.audited(conversation_repair.damaged(turns))
    every = turns.select("conv_id").distinct().withColumn("conv", conversation_repair.Repair.key("conv_id"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return every.join(found, "conv", "left").select(
        "conv_id", *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict of weak supervision on all documents."""
    told = quality_rules.judged(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return told.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("p_good", 6).alias("p_good"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_zstd, op2_secret_scan, op3_token_index, op4_jaccard_join, op5_quality_classifier, op6_media_sniffing, op7_decontamination,
        op8_preference_chat, op9_kd_sharding, op10_temperature_mix, op11_merkle_manifest, op12_conversation_repair,
        op13_quality_rules,
    )
}

_PAIRS_SQL = """WITH turns AS (
  SELECT conv_id // 2 AS pair, conv_id % 2 AS side, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY CAST(turn AS BIGINT) NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
drawn AS (SELECT *, '<|' || role || '|>' || chr(10) AS head, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS body FROM turns),
placed AS (SELECT *, CAST(coalesce(sum(length(body)) OVER (PARTITION BY pair, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM drawn),
common AS (
  SELECT pair, coalesce(min(i) FILTER (sides < 2 OR kinds > 1), max(i) + 1) - 1 AS n
  FROM (SELECT pair, i, count(*) AS sides, count(DISTINCT (role, text)) AS kinds FROM turns GROUP BY pair, i) GROUP BY pair),
cut AS (
  SELECT pair, side, n, coalesce(string_agg(body, '' ORDER BY i) FILTER (i <= n), '') AS prompt, coalesce(string_agg(body, '' ORDER BY i) FILTER (i > n), '') AS rest,
         coalesce(string_agg((off + length(head)) || ':' || (off + length(body)), ',' ORDER BY i) FILTER (i > n AND role = 'assistant'), '') AS mask
  FROM placed JOIN common USING (pair) GROUP BY pair, side, n)
SELECT pair AS pair_id, n AS n_common, max(prompt) AS prompt, max(rest) FILTER (side = 0) AS chosen, max(rest) FILTER (side = 1) AS rejected,
       max(mask) FILTER (side = 0) AS chosen_mask, max(mask) FILTER (side = 1) AS rejected_mask
FROM cut GROUP BY pair, n"""

#: Tokens, media, spans beyond the base, the classifier, shards and mixtures are not expressible in SQL.
ORACLES: dict[str, str] = {
    "op1_warc_zstd": twins.WARC, "op4_jaccard_join": twins.JACCARD, "op7_decontamination": twins.CONTAMINATION, "op8_preference_chat": _PAIRS_SQL,
    "op11_merkle_manifest": twins.MERKLE, "op12_conversation_repair": twins.REPAIR, "op13_quality_rules": twins.RULES,
}
