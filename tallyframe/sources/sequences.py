"""Sequence and tree files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.scalars import wrapped


def read_fasta(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, id, description, seq). Records are split at line starts with '>', so a file is read by many tasks."""
    raw = spark.read.option("lineSep", "\n>").text(list(paths)).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^>", "").alias("r"))
    head = F.substring_index("r", "\n", 1)
    body = F.when(F.instr("r", "\n") > 0, F.regexp_replace("r", r"^[^\n]*\n", "")).otherwise("")
    rows = raw.select("path", F.trim(head).alias("description"), F.regexp_replace(body, r"\s", "").alias("seq")).where("description <> ''")
    return rows.select("path", F.regexp_extract("description", r"^(\S+)", 1).alias("id"), "description", "seq")


def read_headers(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, id) without the sequences."""
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), "value").where(F.startswith(F.col("value"), F.lit(">")))
    return lines.select("path", F.regexp_extract("value", r"^>\s*(\S+)", 1).alias("id"))


def write_fasta(df: DataFrame, path: str, id_col: str, seq_col: str, width: int = 80) -> None:
    df.select(F.concat(F.lit(">"), F.col(id_col), F.lit("\n"), wrapped(F.col(seq_col), width)).alias("value")).write.mode("overwrite").text(path)


def stems(files: DataFrame) -> DataFrame:
    """(stem, n) of path column: names without folder and extension that several files share."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), "path").distinct().groupBy("stem").agg(F.count("*").alias("n")).where("n > 1")


def validate(records: DataFrame, least_length: int, alphabet: str) -> DataFrame:
    """(id, problem): records that are too short or have characters outside the alphabet; ids used twice."""
    dup = records.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit("duplicate id").alias("problem"))
    short = records.where(F.length("seq") < least_length).select("id", F.lit("too short").alias("problem"))
    odd = records.where(F.col("seq").rlike(f"(?i)[^{alphabet}]")).select("id", F.lit("unexpected character").alias("problem"))
    return dup.unionByName(short).unionByName(odd)


def read_newick(spark: SparkSession, *paths: str) -> DataFrame:
    """(tree, newick): one tree for each file."""
    raw = spark.read.option("wholetext", True).text(list(paths)).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("newick"))
    return raw.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "").alias("tree"), "newick")


def read_markers(spark: SparkSession, path: str, *markers: str) -> DataFrame:
    """Sequences of some markers from the Parquet store; the filter and the columns reach the scan."""
    names = [*markers, *(f"{m}.faa" for m in markers)]
    return spark.read.parquet(path).where(F.col("marker").isin(names)).select("marker", "seq_id", "sequence")


def reformat_ids(df: DataFrame, id_col: str, stem: str) -> DataFrame:
    """Ids as stem|id, colons as two underscores, the last bar's part alone."""
    last = F.element_at(F.split(id_col, "[|]"), -1)
    return df.withColumn(id_col, F.concat(F.lit(f"{stem}|"), F.replace(last, F.lit(":"), F.lit("__"))))
