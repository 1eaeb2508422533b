"""Incremental secret scanning over a ledger of content-addressed blobs, in DataFrame functions only.

Each distinct text is a blob, named by its SHA-256. The ledger has a row for each pair of blob and rule version that was
scanned, findings or not. A scan takes every version of every path, keeps the pairs that the ledger lacks, scans one
text for each, appends the pairs, and joins findings back to all paths by blob.

Defined cases: null text is the empty blob; repeated rows and copies are scanned once and reported for each row; a path
may be null; texts of any length are scanned whole; spans that start at one place are ordered by the rules' rank; extra columns are
ignored; an empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import scratch

#: Paths of one blob are dealt over this many join keys.
SALTS = 16


@dataclass(frozen=True)
class Rule:
    """pattern finds leftmost non-overlapping matches; a match counts if what remains without head is long enough."""

    kind: str
    version: int
    pattern: str
    head: str | None = None
    least: int = 0


# The base rules, in the order in which kinds are listed.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
# Rules that came later; scanning with them adds spans for blobs already in the ledger.
LATER_RULES = (
    Rule("private_key", 1, r"-----BEGIN(?: [A-Z0-9]+)* PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def spans_of(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of the rule's matches, in code points, end exclusive.

    Splitting at the matches gives the gaps, extracting gives the matches, and their lengths give the places.
    """
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, rule.pattern, -1)
    body = lambda m: F.regexp_replace(m, rule.head, "") if rule.head else m
    step = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)), found,
        lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"), F.length(body(m)).alias("body")),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    placed = F.aggregate(
        step,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.when(
                x["body"] >= rule.least,
                F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["len"]).alias("end")))),
            ).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(text.rlike(rule.pattern), placed).otherwise(none)


class BlobLedger:
    """The pairs of blob and rule version already scanned, as Parquet in the shared folder.

    A ledger opened at a path goes on from the batches committed there; one that a broken scan left unfinished is passed over.
    """

    def __init__(self, spark, path: str | None = None):
        self.spark, self.path = spark, path or scratch(spark, "blob-ledger")
        jvm = spark._jvm.org.apache.hadoop.fs
        folder = jvm.Path(self.path)
        fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        found = sorted(int(n[6:]) for n in names if n.startswith("batch-") and n[6:].isdecimal())
        self.batches = [b for b in map(self._batch, found) if fs.exists(jvm.Path(f"{b}/_SUCCESS"))]
        self._next = found[-1] + 1 if found else 0

    def _batch(self, number: int) -> str:
        return f"{self.path}/batch-{number}"

    def table(self) -> DataFrame | None:
        return self.spark.read.parquet(*self.batches) if self.batches else None

    def scan(self, versions: DataFrame, rules=BASE_RULES, path_col: str = "path", text_col: str = "text") -> DataFrame:
        """Scan what is unseen; return versions' (path_col, blob) with spans: array<struct<kind, rank, start, end>> of all rules."""
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        paths = versions.select(F.col(path_col).alias("path"), F.sha2(text, 256).alias("blob"))
        wanted = {r.kind: (f"{r.kind}@{r.version}", rank, r) for rank, r in enumerate(rules)}
        known = self.table()
        # one row for each blob, with the rule versions that it lacks
        blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
        every = F.array(*(F.lit(v) for v, _, _ in wanted.values()))
        if known is None:
            due = blobs.withColumn("lacks", every)
        else:
            seen = known.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
            due = blobs.join(seen, "blob", "left").withColumn(
                "lacks", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
            ).where(F.size("lacks") > 0).drop("seen")
        texts = versions.select(F.col(path_col).alias("path"), text.alias("text")).withColumn("blob", F.sha2("text", 256))
        # a blob's first path, null told apart; rows equal in both meet in one task and are scanned once
        named = lambda df: df.withColumn("at", F.coalesce(F.concat(F.lit("="), F.col("path").cast("string")), F.lit(""))).drop("path")
        fresh = named(texts).join(named(due).hint("shuffle_hash"), ["blob", "at"]).dropDuplicates(["blob", "at"]).select("blob", "text", "lacks")
        found = F.array(*(
            F.struct(
                F.lit(version).alias("rule"), F.lit(kind).alias("kind"), F.lit(rank).alias("rank"),
                F.when(F.array_contains("lacks", version), spans_of(F.col("text"), rule)).alias("spans"),
            )
            for kind, (version, rank, rule) in wanted.items()
        ))
        rows = fresh.select("blob", F.explode(found).alias("f")).where("f.spans is not null").select("blob", "f.*")
        batch = self._batch(self._next)
        self._next += 1
        rows.write.parquet(batch)
        self.batches.append(batch)

        findings = self.table().where(F.col("rule").isin([v for v, _, _ in wanted.values()]) & (F.size("spans") > 0))
        flat = findings.select("blob", F.explode("spans").alias("s"), "kind", "rank").select("blob", "s.start", "s.end", "kind", "rank").distinct()
        folded = flat.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("spans"))
        salted = folded.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        paths = paths.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
        none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
        joined = paths.join(salted, ["blob", "salt"], "left").select("path", "blob", F.coalesce("spans", none).alias("spans"))
        return joined.withColumnRenamed("path", path_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the hash of the base spans, and all spans as text."""
    base = {r.kind for r in BASE_RULES}
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        id_col,
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(text(of(*base)), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A fresh ledger: the base rules, then the later ones, each blob and rule version scanned once."""
    ledger = BlobLedger(docs.sparkSession)
    ledger.scan(docs, BASE_RULES, id_col, text_col)
    return digest(ledger.scan(docs, BASE_RULES + LATER_RULES, id_col, text_col), id_col)


__all__ = ["BASE_RULES", "LATER_RULES", "BlobLedger", "Rule", "digest", "scan_documents", "spans_of"]
