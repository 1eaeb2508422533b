"""Assembly and rendering of the wide summary, and its sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.scalars import fixed_text


def assemble(base: DataFrame, key: str, parts: Sequence[DataFrame], defaults: dict | None = None) -> DataFrame:
    """base with the columns of every part by key; defaults fill what a part lacks."""
    out = base
    for part in parts:
        out = out.join(part, key, "left")
    return out.fillna(defaults or {})


def rendered(df: DataFrame, two_digits: Sequence[str], sentinel: dict[str, str] | None = None) -> DataFrame:
    """All columns as text: the named ones with two digits, other fractions with none, NaN as NaN, null as blank or the column's sentinel."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        numeric = kind in ("double", "float") or kind.startswith("decimal")
        text = fixed_text(c, 2 if name in two_digits else 0) if numeric else F.coalesce(c.cast("string"), F.lit(""))
        out.append(F.when(c.isNull(), (sentinel or {}).get(name, "")).otherwise(text).alias(name))
    return df.select(*out)


def split_failed(df: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """(complete, failed) rows."""
    ok = F.coalesce(F.col(status) == "complete", F.lit(False))
    return df.where(ok), df.where(~ok)


def write_table(df: DataFrame, path: str, sep: str, order: str) -> None:
    """One sorted table with a header: sorted by range, so that no task holds it all; the files are in order."""
    df.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def combine(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows, by name; columns that a table lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*(F.col(a).alias(b) for a, b in names.items()))


def candidate_table(contigs: DataFrame, bins: DataFrame, key: str = "bin") -> DataFrame:
    """contigs with a reason, in bins(key, type, estimate) that are called contaminated: clean and uncertain bins have no candidates.

    What a bin had before is gone when the table is written anew, so nothing stale stays.
    """
    called = bins.where(~F.col("type").isin("clean", "uncertain", "uncertain_sensitive_mode"))
    return contigs.where("reason is not null").join(called.select(key, "type", "estimate"), key)


def placement_table(rows: DataFrame) -> DataFrame:
    """tree.placements() as text: six decimals, null as blank, sorted columns of the taxonomy table."""
    six = lambda c: F.coalesce(F.format_string("%.6f", F.col(c)), F.lit(""))
    show = lambda c: F.when(F.col(c).isNull(), "").otherwise(six(c)).alias(c)
    return rows.select("query", "nn_genome", "nn_taxonomy", show("nn_distance"), "clade_id", "clade_members", show("clade_mean_dist"), show("clade_ref_dist"))


def read_table(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """What write_table() wrote: every column as text, blank for nothing."""
    return spark.read.option("header", True).option("sep", sep).option("nullValue", "\u0000").option("emptyValue", "").csv(path).na.fill("")
