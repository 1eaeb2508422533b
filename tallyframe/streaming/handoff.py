"""Handing results of a stream over: events as lines, and batches that readers trust only once their marker is there."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

#: What an event's line begins with; lines of other programs go through the same channel.
PREFIX = "TALLY_PROGRESS "


def event_lines(events: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """(value): each row of events as the prefix and JSON with its keys in order; nulls are left out. progress.parse_events() reads them back."""
    return events.select(F.concat(F.lit(prefix), F.to_json(F.struct(*sorted(events.columns)))).alias("value"))


def publish(rows: DataFrame, folder: str, checkpoint: str, mode: str = "append", before_marker: Callable[[int], None] | None = None) -> StreamingQuery:
    """Start writing a stream's batches below folder, until all that is there now is done.

    A batch is written whole, over what an attempt that was lost has left; only then its marker with the number of its rows. The
    stream repeats a batch under its number until it is recorded as done, so a stop at any point neither loses nor doubles a row for readers of published().
    """

    def hand_over(batch: DataFrame, number: int) -> None:
        place = f"{folder}/batches/batch={number}"
        batch.write.mode("overwrite").parquet(place)
        if before_marker is not None:
            before_marker(number)
        spark = batch.sparkSession
        rows_there = spark.read.schema(batch.schema).parquet(place).agg(F.count("*").alias("rows"))
        rows_there.select(F.lit(number).cast("long").alias("batch"), "rows").coalesce(1).write.mode("overwrite").parquet(f"{folder}/done/{number}")

    return rows.writeStream.foreachBatch(hand_over).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def published(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of batches that have their marker, with the batch's number; schema is that of the rows.

    Raises if a batch has not the rows that its marker states. Batches without marker are not there for readers.
    """
    done = spark.read.schema("batch long, rows long").option("recursiveFileLookup", True).parquet(f"{folder}/done")
    rows = spark.read.schema(f"{schema}, batch long").option("basePath", f"{folder}/batches").parquet(f"{folder}/batches")
    held = rows.groupBy("batch").agg(F.count("*").alias("_n"))
    short = done.join(held, "batch", "left").where(F.coalesce("_n", F.lit(0)) != F.col("rows"))
    if not short.isEmpty():
        raise ValueError("a batch differs from its marker")
    return rows.join(done.select("batch"), "batch", "left_semi")


def latest(rows: DataFrame, keys: Sequence[str], number: str = "batch") -> DataFrame:
    """Of each key the row of its last batch: what an update-mode stream stands at."""
    rest = [c for c in rows.columns if c not in (*keys, number)]
    last: Column = F.max_by(F.struct(*rest), F.col(number))
    return rows.groupBy(*keys).agg(last.alias("_r")).select(*keys, "_r.*")
