"""Tables written in the folder that driver and executors share, where a plan would otherwise compute its input again and again."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below spark.checkpoint.dir; only local mode may go on without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file:///tmp/checkpoints/tallyframe"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession, rows: float, each: int) -> int:
    """Into how many tasks a shuffle of so many rows is dealt, so that a task's memory does not grow with the table.

    Always more than the session's number: an equal one is merged with the exchange below it, whose tasks are then joined by bytes, not rows.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")) + 1, math.ceil(rows / each))
