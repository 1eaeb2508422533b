"""Progress events and incremental runs, as batches or streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVENT_SCHEMA = "timestamp string, event string, query string, progress double, stage string, marker string, completed_markers int, total_markers int"


def parse_events(lines: DataFrame, prefix: str = "") -> DataFrame:
    """Events from lines(value) of prefixed JSON; other lines are dropped. Works on streams."""
    kept = lines.where(F.startswith(F.col("value"), F.lit(prefix))).select(F.from_json(F.substr(F.col("value"), F.lit(len(prefix) + 1)), EVENT_SCHEMA).alias("e"))
    return kept.where("e.query is not null").select("e.*").withColumn("at", F.try_to_timestamp("timestamp"))


def fold(events: DataFrame) -> DataFrame:
    """(query, progress, stage, done, failed): the highest progress, the last stage, and whether the query ended. One aggregation, so a
    stream in update mode keeps one row for each query as state."""
    return events.groupBy("query").agg(
        F.max("progress").alias("progress"), F.max_by("stage", F.struct("at", "progress", "stage")).alias("stage"),
        F.bool_or(F.col("event") == "query_complete").alias("done"), F.bool_or(F.col("event") == "query_failed").alias("failed"),
    )


def overall(folded: DataFrame, total: int) -> DataFrame:
    """(percent, done, failed): ended queries count as whole."""
    ended = F.col("done") | F.col("failed")
    share = F.sum(F.when(ended, 100.0).otherwise(F.least(F.coalesce("progress", F.lit(0.0)), F.lit(100.0))))
    return folded.agg((F.coalesce(share, F.lit(0.0)) / total).alias("percent"), F.count_if("done").alias("done"), F.count_if("failed").alias("failed"))


def windowed(events: DataFrame, ts: str, key: str, size: str, late: str) -> DataFrame:
    """(start, key, n): events by tumbling window; a stream drops what comes later than the watermark."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, size).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def pending(inputs: DataFrame, manifest: DataFrame, key: str, checksum: str) -> DataFrame:
    """Inputs that the manifest does not list as complete with the same checksum."""
    ready = manifest.where("status = 'complete'").select(key, checksum)
    return inputs.join(ready, [key, checksum], "left_anti")


def advance(manifest: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The manifest after updates(key, status, at): each key's last update, never backwards from an end to pending or running."""
    order = F.when(F.col("status").isin("complete", "failed"), 2).when(F.col("status") == "running", 1).otherwise(0)
    every = manifest.unionByName(updates, allowMissingColumns=True).withColumn("_o", order)
    return every.groupBy(key).agg(F.max(F.struct("_o", "at", *(c for c in manifest.columns if c not in (key, "at")))).alias("_m")).select(key, *(F.col(f"_m.{c}").alias(c) for c in manifest.columns if c != key))


def totals(manifest: DataFrame) -> DataFrame:
    is_ = lambda s: F.count_if(F.col("status") == s)
    return manifest.agg(F.count("*").alias("total"), is_("complete").alias("complete"), is_("failed").alias("failed"), (is_("complete") + is_("failed")).alias("done"), is_("running").alias("running"))
