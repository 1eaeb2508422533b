"""Scans of the text tables: labels, domain hits, similarity hits, counts, cutoffs and statistics, with audits of bad lines.

Every parser takes lines(value), so a file scan is parser(spark.read.text(path)) and a stream works alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.scalars import padded_lineage

# Column names of the two hit formats, in order.
DOMAIN_COLUMNS = (
    "target", "target_acc", "target_len", "model", "model_acc", "model_len", "evalue", "score", "bias", "idx", "of", "c_evalue", "i_evalue", "dom_score", "dom_bias",
    "model_from", "model_to", "ali_from", "ali_to", "env_from", "env_to", "acc",
)
SIMILARITY_COLUMNS = ("query", "subject", "identity", "length", "mismatches", "gaps", "q_start", "q_end", "s_start", "s_end", "evalue", "score")


def scan(spark: SparkSession, *paths: str, glob: str | None = None) -> DataFrame:
    """Lines of text files with their file: (value, path)."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return reader.text(list(paths)).select("value", F.col("_metadata.file_path").alias("path"))


def fields(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """Lines that are neither blank nor comments, as an array f."""
    kept = lines.where(~F.startswith(F.col("value"), F.lit("#")) & (F.trim("value") != ""))
    return kept.withColumn("f", F.split("value", sep))


def at(i: int, kind: str = "string") -> Column:
    value = F.get("f", F.lit(i))
    return value if kind == "string" else value.try_cast(kind)


def labels(lines: DataFrame) -> DataFrame:
    """(label, ranks array of 7)."""
    return fields(lines).where(F.size("f") >= 2).select(at(0).alias("label"), padded_lineage(at(1)).alias("ranks"))


def domain_hits(lines: DataFrame) -> DataFrame:
    """Rows with all 22 columns whose scores are numbers; others are dropped."""
    kinds = {"target_len": "int", "model_len": "int", "idx": "int", "of": "int"} | {c: "double" for c in ("evalue", "score", "bias", "c_evalue", "i_evalue", "dom_score", "dom_bias", "acc")}
    kinds |= {c: "int" for c in ("model_from", "model_to", "ali_from", "ali_to", "env_from", "env_to")}
    rows = fields(lines).where(F.size("f") == 22)
    return rows.select(*(at(i, kinds.get(c, "string")).alias(c) for i, c in enumerate(DOMAIN_COLUMNS))).where("score is not null and dom_score is not null")


def similarity_hits(lines: DataFrame, least_identity: float = 30.0) -> DataFrame:
    """Rows whose identity and score parse, with 0 <= identity <= 100 and at least the floor; other numbers may be missing. A row's place in its file is not kept."""
    kinds = ["string", "string", "double", *["int"] * 7, "double", "double"]
    rows = fields(lines).where(F.size("f") >= 12)
    parsed = rows.select(*(at(i, k).alias(c) for i, (c, k) in enumerate(zip(SIMILARITY_COLUMNS, kinds, strict=True))))
    return parsed.where("identity between 0 and 100 and score is not null").where(F.col("identity") >= least_identity)


def similarity_audit(lines: DataFrame) -> DataFrame:
    """(lines, short, not_numeric, out_of_range)."""
    rows, identity = fields(lines), at(2, "double")
    long = F.size("f") >= 12
    return rows.agg(
        F.count("*").alias("lines"), F.count_if(~long).alias("short"), F.count_if(long & (identity.isNull() | at(11, "double").isNull())).alias("not_numeric"),
        F.count_if(long & identity.isNotNull() & ~identity.between(0, 100)).alias("out_of_range"),
    )


def marker_counts(lines: DataFrame) -> DataFrame:
    """(model, n), malformed counts dropped."""
    return fields(lines).where(F.size("f") >= 2).select(at(0).alias("model"), at(1, "int").alias("n")).where("n is not null")


def cutoffs(lines: DataFrame) -> DataFrame:
    """(model, score, length); length null where the file has none."""
    return fields(lines).where(F.size("f") >= 2).select(at(0).alias("model"), at(1, "double").alias("score"), at(2, "int").alias("length")).where("score is not null")


def profile_cutoffs(lines: DataFrame) -> DataFrame:
    """(model, cutoff) from profile headers (path, value): the gathering cutoff, else the trusted, else the noise cutoff.

    A model's lines are told by its NAME line: files hold one profile each.
    """
    word = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    keyed = lines.select("path", F.get(word, F.lit(0)).alias("k"), F.rtrim(F.get(word, F.lit(1)), F.lit(";")).alias("v")).where(F.col("k").isin("NAME", "GA", "TC", "NC"))
    pick = lambda k: F.max(F.when(F.col("k") == k, F.col("v")))
    one = keyed.groupBy("path").agg(pick("NAME").alias("model"), *(pick(k).try_cast("double").alias(k) for k in ("GA", "TC", "NC")))
    return one.select("model", F.coalesce("GA", "TC", "NC").alias("cutoff"))


def statistics(table_lines: DataFrame, pair_lines: DataFrame) -> DataFrame:
    """(query, key, value): the first table's columns overlaid by key/value pairs. Both have a query column."""
    pairs = fields(pair_lines).where(F.size("f") >= 2).select("query", at(0).alias("key"), at(1).alias("value"), F.lit(0).alias("p"))
    rows = fields(table_lines).select("query", "f")
    head = rows.where(at(0) == "query").select("query", F.col("f").alias("names"))
    body = rows.where(at(0) != "query").join(head, "query").select("query", F.explode(F.arrays_zip("names", "f")).alias("z"))
    both = pairs.unionByName(body.select("query", F.col("z.names").alias("key"), F.col("z.f").alias("value"), F.lit(1).alias("p")))
    return both.groupBy("query", "key").agg(F.min(F.struct("p", "value")).alias("b")).select("query", "key", "b.value")


def best_source(sources: list[DataFrame], key: str) -> DataFrame:
    """Each key's rows from the first source that has it."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s.join(out.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)
    return out


def neighbours(lines: DataFrame) -> DataFrame:
    """(marker, protein, neighbor, distance) of tree neighbour tables: the header and rows whose distance is no number are passed over.

    Of a neighbour's several distances in one file format the last line counts where lines have their place as column `row`, else the largest.
    """
    rows = fields(lines).where((F.size("f") >= 4) & (at(0) != "marker"))
    place = "row" if "row" in lines.columns else None
    told = rows.select(at(0).alias("marker"), at(1).alias("protein"), at(2).alias("neighbor"), at(3, "double").alias("distance"), *([place] if place else [])).where("distance is not null")
    last = F.max_by("distance", F.struct("row", "distance")) if place else F.max("distance")
    return told.groupBy("marker", "protein", "neighbor").agg(last.alias("distance"))


def marker_groups(lines: DataFrame, flags: list[str]) -> DataFrame:
    """(group, model) of lookups with name, six columns, flag at the seventh and members at the eighth place: groups of the flags with two members or more."""
    rows = fields(lines).where((F.size("f") >= 8) & (at(0) != "group_name") & at(6).isin(*flags))
    members = F.filter(F.split(at(7), ";"), lambda m: m != "")
    return rows.select(at(0).alias("group"), members.alias("m")).where(F.size("m") >= 2).select("group", F.explode("m").alias("model"))


def json_files(spark: SparkSession, schema: str, *paths: str) -> DataFrame:
    """(path, columns of schema): one object for each file; files that are not read as one are left out."""
    raw = spark.read.option("wholetext", True).text(list(paths)).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("j"))
    return raw.where("j is not null and j._bad is null").select("path", "j.*").drop("_bad")


def long_hits(lines: DataFrame, least: int = 16) -> DataFrame:
    """(target, model, model_len, score, dom_score, model_from, model_to) of domain tables with at least so many fields between blanks."""
    rows = lines.where(~F.startswith(F.col("value"), F.lit("#"))).withColumn("f", F.split(F.trim("value"), r"\s+")).where(F.size("f") >= least)
    places = {"target": (0, "string"), "model": (3, "string"), "model_len": (5, "int"), "score": (7, "double"), "dom_score": (13, "double"), "model_from": (15, "int"), "model_to": (16, "int")}
    return rows.select(*(at(i, kind).alias(c) for c, (i, kind) in places.items())).where("score is not null and dom_score is not null")


def label_lines(store: DataFrame, label: str, ranks: list[str]) -> DataFrame:
    """(value) lines of a label file from the typed store: a tab behind the label, bars between ranks, nothing for null."""
    return store.select(F.concat(F.col(label), F.lit("\t"), F.concat_ws("|", *(F.coalesce(F.col(r), F.lit("")) for r in ranks))).alias("value"))
