"""Helpers that the corpus operators share: scratch tables and word hashing."""

from __future__ import annotations

import contextlib
import uuid
import weakref
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

#: Only used where spark.checkpoint.dir is unset, in local mode.
LOCAL_SHARED = "file:///tmp/checkpoints/tallyframe"

_CHUNK = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in spark.checkpoint.dir; without that setting only local mode may go on.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return LOCAL_SHARED


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Paths of the tables that materialize() wrote, for discard().
_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """While it lasts, the session's setting has that value."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)


def materialize(df: DataFrame, label: str, **options) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: lineage ends at replicated files.

    The shuffle files behind it go as soon as the table is committed; until then a lost executor's are made again.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.options(**options).parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[written] = path
    return written


def discard(*tables: DataFrame) -> None:
    """Remove tables of materialize(). Only for those that no plan still to be run reads."""
    for written in tables:
        path = _WRITTEN.pop(written)
        where = written.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(written.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def numbered(rows: DataFrame, group: str, order: Sequence[Column], label: str) -> DataFrame:
    """rows, written, with _place, the row's place within its group by order, and _size, the group's rows. group is a string, never null.

    Rows are sorted by ranges over all groups, so a group may span any number of tasks; rows equal in order are told apart by their place
    in the written table and may span tasks as well.
    """
    told = materialize(rows.withColumn("_at", F.monotonically_increasing_id()), label)
    by = [F.col(group).asc(), *order, F.col("_at").asc()]

    def count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            groups = b.column(group).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
            pos = np.arange(len(groups)) - np.repeat(starts, np.diff(np.append(starts, len(groups))))
            if groups[0] == last:
                pos[: starts[1] if len(starts) > 1 else len(pos)] += seen
            last, seen = groups[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(pos), part)), pa.array(pos)], [*b.schema.names, "_part", "_pos"])

    ranged = told.repartitionByRange(*by).sortWithinPartitions(*by).drop("_at")
    schema = StructType(ranged.schema.fields[:]).add("_part", LongType()).add("_pos", LongType())
    placed = materialize(ranged.mapInArrow(count_up, schema), label)
    counts = placed.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # as many rows as tasks
    offsets = counts.select(group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    sizes = counts.groupBy(group).agg(F.sum("_n").alias("_size"))
    joined = placed.join(offsets.join(sizes, group), [group, "_part"]).withColumn("_place", F.col("_pos") + F.col("_before"))
    out = materialize(joined.select(*rows.columns, "_place", "_size"), label)
    discard(told, placed)
    return out


def arrow_batches(spark: SparkSession, most: int) -> contextlib.AbstractContextManager[None]:
    """While it lasts, jobs hand rows to Python workers in batches of at most about that many bytes. A row is never split."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, a bijection of uint64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = mix(np.arange(4096, dtype=np.uint64)) | np.uint64(1)


def _hash_words(a: np.ndarray) -> np.ndarray:
    """One hash for each run of bytes outside the six blanks, A-Z as a-z."""
    word = ~_SPACE[a]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False]))))
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    at = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
    longest = int(lengths.max())
    powers = _POWERS if longest <= len(_POWERS) else mix(np.arange(longest, dtype=np.uint64)) | np.uint64(1)
    sums = np.add.reduceat((_LOWER[a[word]].astype(np.uint64) + np.uint64(1)) * powers[place], at)
    return mix(sums ^ (lengths.astype(np.uint64) << np.uint64(48)))


def run_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs of bytes between blanks, in order; works through long texts a megabyte at a time."""
    if len(data) <= _CHUNK:
        return _hash_words(data)
    parts, start = [], 0
    while start < len(data):
        end = min(start + _CHUNK, len(data))
        while end < len(data) and not _SPACE[data[end]]:  # to the end of a word
            ahead = np.flatnonzero(_SPACE[data[end : end + _CHUNK]])
            end = end + int(ahead[0]) if len(ahead) else min(end + _CHUNK, len(data))
        parts.append(_hash_words(data[start:end]))
        start = end
    return np.concatenate(parts)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the blank-separated words, in order."""
    return run_hashes(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8))


def fresh(df: DataFrame, name: str) -> str:
    """name, lengthened until it is none of df's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """df's rows as one struct column _row, with further columns: whatever names df has, none can clash with them."""
    row = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)))
    return df.select(row.alias("_row"), *(c.alias(n) for n, c in more.items()))


def unpacked(df: DataFrame, drop: Sequence[str] = ()) -> list[Column]:
    """df's own columns, but for those in drop, out of packed(df)."""
    return [F.col(f"_row.c{i}").alias(c) for i, c in enumerate(df.columns) if c not in drop]


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """Distinct hashes of k consecutive words, sorted; of fewer words, their whole sequence as one."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(k, len(words))
    rows = len(words) - width + 1
    total = np.zeros(rows, np.uint64)
    for i in range(width):
        total = mix(total ^ words[i : i + rows]) * np.uint64(2 * i + 3)
    return np.unique(mix(total + np.uint64(width)))
