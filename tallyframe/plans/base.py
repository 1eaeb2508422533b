"""Registration of queries and the bindings of roles to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.staging import tasks_for

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name, with its SQL twin."""

    def put(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries are named {f.__name__}")
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RANKS = ["r1", "r2", "r3", "r4", "r5", "r6", "r7"]

#: query, marker, protein, neighbor, distance and a lineage of four filled ranks
PLACEMENTS = """placements AS (
  SELECT l_suppkey AS query, p_brand AS marker, l_orderkey AS protein, l_partkey AS neighbor, l_discount AS distance,
         r_name AS r1, n_name AS r2, c_mktsegment AS r3, o_orderpriority AS r4, '' AS r5, '' AS r6, '' AS r7
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


#: Rows of lineitem that one task sorts or groups where a query keeps most of them.
ROWS_PER_TASK = 200_000


def tasks(spark: SparkSession, sf_dir: str) -> int:
    """Into how many tasks rows that grow as lineitem does are dealt; its rows are counted in the files' footers."""
    return tasks_for(spark, table(spark, sf_dir, "lineitem").count(), ROWS_PER_TASK)


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt by protein at the end, so that votes of one protein need no other shuffle."""
    t = lambda name: table(spark, sf_dir, name)
    lineage = (
        t("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        .join(t("customer").select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", "r_name", "n_name", "c_mktsegment", "o_orderpriority")
    )
    items = t("lineitem").select("l_suppkey", "l_orderkey", "l_partkey", "l_discount").join(t("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    joined = items.repartition(tasks(spark, sf_dir), "l_orderkey").join(lineage, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("l_suppkey").alias("query"), F.col("p_brand").alias("marker"), F.col("l_orderkey").alias("protein"), F.col("l_partkey").alias("neighbor"),
        F.col("l_discount").alias("distance"), F.col("r_name").alias("r1"), F.col("n_name").alias("r2"), F.col("c_mktsegment").alias("r3"),
        F.col("o_orderpriority").alias("r4"), *(F.lit("").alias(r) for r in RANKS[4:]),
    )


#: protein, model, seq_score, dom_score in cents and units, seq: the row's place in its file
HITS = """hits AS (
  SELECT l_orderkey AS protein, p_brand AS model, CAST(round(l_extendedprice * 100) AS BIGINT) AS seq_score,
         CAST(l_quantity AS BIGINT) AS dom_score, l_linenumber AS seq, l_suppkey AS query, p_type AS ptype
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_linenumber", "l_suppkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("protein"), F.col("p_brand").alias("model"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("seq_score"),
        F.col("l_quantity").cast("long").alias("dom_score"), F.col("l_linenumber").alias("seq"), F.col("l_suppkey").alias("query"), F.col("p_type").alias("ptype"),
    )
