"""Random access to sequences: an index of byte offsets over FASTA files of any size, and reads of the asked ranges alone."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def build_index(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, id, description, start, length): where each record's bytes are, its mark '>' included.

    Files are read in splits, a row for each record. Within a split the bytes before a record are summed up, then those of the splits
    before it, so neither a file nor its records pass through one task.
    """
    raw = spark.read.option("lineSep", "\n>").text(list(paths))
    place = raw.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"),
        F.octet_length("value").cast("long").alias("_bytes"), F.substring_index("value", "\n", 1).alias("_head"),
    )
    before = lambda *by: W.partitionBy(*by).rowsBetween(W.unboundedPreceding, -1)
    inside = place.withColumn("_at", F.coalesce(F.sum(F.col("_bytes") + 2).over(before("path", "_block").orderBy("_row")), F.lit(0)))
    blocks = place.groupBy("path", "_block").agg(F.sum(F.col("_bytes") + 2).alias("_held"))
    offsets = blocks.select("path", "_block", F.coalesce(F.sum("_held").over(before("path").orderBy("_block")), F.lit(0)).alias("_before"))
    told = inside.join(offsets, ["path", "_block"]).withColumn("_at", F.col("_at") + F.col("_before"))
    marked = F.when(F.col("_at") > 0, 1).otherwise(0)  # '>' ends the separator, but for a file's first record
    name = F.trim(F.regexp_replace("_head", "^>", ""))
    rows = told.where((F.col("_at") > 0) | F.startswith(F.col("_head"), F.lit(">")))
    return rows.select("path", F.regexp_extract(name, r"^(\S+)", 1).alias("id"), name.alias("description"), (F.col("_at") - marked).alias("start"), (F.col("_bytes") + marked).alias("length"))


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    held, file = None, None
    for f in frames:
        out = []
        for path, start, length in zip(f["path"], f["start"], f["length"], strict=True):
            if path != held:
                system, name = fs.FileSystem.from_uri(path)
                held, file = path, system.open_input_file(name)
            data = file.read_at(int(length), int(start))
            if len(data) != length or data[:1] != b">":
                raise ValueError(f"no record at {start} of {path}: the file was changed after it was indexed")
            out.append("".join(data.decode().split("\n", 1)[1].split()) if b"\n" in data else "")
        yield f.assign(seq=out)


def fetch(index: DataFrame, asked: DataFrame, name: str) -> DataFrame:
    """asked with path, id, how and seq of its record: by id, else by its whole description; names that neither has are left out.

    Of several records with one id or description the last one is taken. Only the ranges of asked records are read, by file and place.
    """
    last = lambda by: index.groupBy(by).agg(F.max(F.struct("path", "start", "length", F.col("id").alias("of"))).alias("r"))
    names = asked.select(F.col(name).alias("_name")).distinct()
    by_id = names.join(last("id"), F.col("_name") == F.col("id")).select("_name", "r", F.lit("id").alias("how"))
    rest = names.join(by_id.select("_name"), "_name", "left_anti")
    by_text = rest.join(last("description"), F.col("_name") == F.col("description")).select("_name", "r", F.lit("description").alias("how"))
    found = by_id.unionByName(by_text).select("_name", "how", "r.path", "r.start", "r.length", F.col("r.of").alias("id"))
    places = found.select("path", "start", "length").distinct().repartitionByRange("path", "start").sortWithinPartitions("path", "start")
    read = places.mapInPandas(_read, "path string, start long, length long, seq string")
    told = found.join(read.drop("length"), ["path", "start"])
    return asked.join(told.select(F.col("_name").alias(name), "path", "id", "how", "seq"), name)
