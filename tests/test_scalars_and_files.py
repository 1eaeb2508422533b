"""Scalar functions, text tables, sequence files, summary sinks, model helpers and progress streams on small fixtures."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.functions import scalars as S
from tallyframe.operators import aggregate, ml, summary
from tallyframe.sources import sequences, tables
from tallyframe.streaming import progress


def values(spark, column, kind, *given_values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given_values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_identifiers(spark):
    assert values(spark, S.without_number, "string", "a_12", "a_b", None) == ["a", "a_b", None]
    assert values(spark, S.before_bar, "string", "g|p|q", "g") == ["g", "g"]
    assert values(spark, S.after_bar, "string", "g|p|q", "g") == ["q", "g"]
    assert values(spark, lambda x: S.domain_of(x, F.lit("NA")), "string", "NCLDV__x", "plain") == ["NCLDV", "NA"]
    assert values(spark, S.normal_placeholder, "string", "A__A_unclassified", "A__A_other", "A__b") == ["A__unclassified", "A__other", "A__b"]
    assert values(spark, S.safe_name, "string", "a b/c", "..", "x__y") == ["a_b_c", "unnamed", "x_y"]
    assert values(spark, S.accession, "string", "GCA_000123.4", "GCF-99-1", "other") == ["000123.4", "99.1", None]
    assert values(spark, S.version_parts, "string", "v1.2.10", "1.x") == [[1, 2, 10], None]
    assert values(spark, S.padded_lineage, "string", "a|b") == [["a", "b", "", "", "", "", ""]]


def test_sequences_and_coordinates(spark):
    assert values(spark, S.gc_percent, "string", "GGcc", "AT", "", "ßG") == [100.0, 0.0, 0.0, 50.0]
    assert values(spark, S.stops_as_gaps, "string", "M*A") == ["M-A"]
    assert values(spark, S.wrapped, "string", "abcdef", "a" * 161) == ["abcdef", "a" * 80 + "\n" + "a" * 80 + "\na"]
    assert [tuple(v) for v in values(spark, lambda x: S.to_zero_based(x, x + 4), "int", 1)] == [(0, 5)]
    assert values(spark, lambda x: S.to_zero_based(x, x - 1), "int", 3) == [None]
    assert values(spark, S.phase, "int", 0, 1, 2, 3) == [0, 2, 1, 0]
    both = spark.createDataFrame([("AC-GT", "ACCGA")], "a string, b string").select(S.identity(F.col("a"), F.col("b")).alias("i")).first()["i"]
    assert tuple(both) == (3, 1, 1)


def test_sequence_stats_counts_characters_as_written(spark):
    df = spark.createDataFrame([("de", "Straße Gc"), ("de", None), ("en", "ŉ GGcc"), (None, "ﬁg")], "lang string, text string")
    got = {r.lang: (r.contigs, r.bases, r.gc) for r in aggregate.sequence_stats(df, ["lang"], "text").collect()}
    assert got == {"de": (2, 9, 2), "en": (1, 6, 4), None: (1, 2, 1)}


def test_fixed_text(spark):
    assert values(spark, lambda x: S.fixed_text(x, 1), "double", 8918.05, 0.25, 0.75, -0.04, None, float("nan"), 9.96, 1e15 + 0.5) == [
        "8918.0", "0.2", "0.8", "-0.0", "", "NaN", "10.0", "1000000000000000.5",
    ]
    assert values(spark, lambda x: S.fixed_text(x, 0), "double", 0.5, 1.5, 2.5, 99.6) == ["0", "2", "2", "100"]
    with pytest.raises(ValueError):
        S.fixed_text(F.lit(1.0), 4)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9).filter(lambda v: v == 0 or abs(v) >= 1), min_size=1, max_size=40))
def test_fixed_text_like_format(spark, numbers):
    got = values(spark, lambda x: S.fixed_text(x, 2), "double", *numbers)
    assert [g.replace("-0.00", "0.00") for g in got] == [f"{v:.2f}".replace("-0.00", "0.00") for v in numbers]


def lines(spark, *text):
    return spark.createDataFrame([(t,) for t in text], "value string")


def test_text_tables(spark):
    got = tables.labels(lines(spark, "# note", "", "g1\td|p", "alone")).collect()
    assert [(r["label"], r["ranks"]) for r in got] == [("g1", ["d", "p", "", "", "", "", ""])]
    good = "q\ts\t55.5\t10\t1\t0\t1\t10\t1\t10\t1e-9\t80"
    bad = [good.replace("55.5", "12"), good.replace("55.5", "101"), good.replace("55.5", "x"), "q\ts\t50"]
    assert [(r["query"], r["identity"], r["score"]) for r in tables.similarity_hits(lines(spark, good, *bad)).collect()] == [("q", 55.5, 80.0)]
    assert tuple(tables.similarity_audit(lines(spark, good, *bad)).first()) == (5, 1, 1, 1)
    row = "\t".join(["t", "-", "100", "m", "-", "90", "1e-5", "50.5", "0", "1", "1", "1", "1", "40", "0", *["1"] * 6, "0.9"])
    assert [(r["target"], r["model"], r["score"]) for r in tables.domain_hits(lines(spark, row, row + "\textra", "short")).collect()] == [("t", "m", 50.5)]
    assert [tuple(r) for r in tables.marker_counts(lines(spark, "m\t3", "m2\tx")).collect()] == [("m", 3)]
    assert [tuple(r) for r in tables.cutoffs(lines(spark, "m\t3.5\t20", "m2\t1")).orderBy("model").collect()] == [("m", 3.5, 20), ("m2", 1.0, None)]


def test_profile_cutoffs_and_best_source(spark):
    rows = [("f", "NAME  m1"), ("f", "TC    20.5 20.1;"), ("f", "NC    10 9;"), ("g", "NAME m2"), ("g", "GA 30.0 30.0;"), ("g", "TC 1 1;")]
    got = tables.profile_cutoffs(spark.createDataFrame(rows, "path string, value string")).orderBy("model").collect()
    assert [tuple(r) for r in got] == [("m1", 20.5), ("m2", 30.0)]
    first = spark.createDataFrame([("a", 1)], "k string, v int")
    second = spark.createDataFrame([("a", 9), ("b", 2)], "k string, v int")
    assert sorted(tuple(r) for r in tables.best_source([first, second], "k").collect()) == [("a", 1), ("b", 2)]


def test_fasta_round_trip(spark, tmp_path):
    rows = [("s1", "ACGT" * 50), ("s2", "GG"), ("s3", "A" * 80)]
    sequences.write_fasta(spark.createDataFrame(rows, "id string, seq string"), str(tmp_path / "out"), "id", "seq")
    got = sequences.read_fasta(spark, str(tmp_path / "out"))
    assert sorted((r["id"], r["seq"]) for r in got.collect()) == rows
    assert sorted(r["id"] for r in sequences.read_headers(spark, str(tmp_path / "out")).collect()) == ["s1", "s2", "s3"]


def test_sequence_checks(spark):
    rows = spark.createDataFrame([("a", "ACGT"), ("a", "ACGT"), ("b", "A"), ("c", "AC1T")], "id string, seq string")
    assert sorted(tuple(r) for r in sequences.validate(rows, 2, "ACGTN").collect()) == [("a", "duplicate id"), ("b", "too short"), ("c", "unexpected character")]
    files = spark.createDataFrame([("/x/a.fna",), ("/y/a.faa",), ("/x/b.fna",)], "path string")
    assert [tuple(r) for r in sequences.stems(files).collect()] == [("a", 2)]


def test_summary(spark, tmp_path):
    base = spark.createDataFrame([("q2",), ("q1",)], "query string")
    part = spark.createDataFrame([("q1", 1.005, 7)], "query string, score double, n int")
    whole = summary.assemble(base, "query", [part], {"n": 0})
    got = {r["query"]: (r["score"], r["n"]) for r in summary.rendered(whole, ["score"]).collect()}
    assert got == {"q1": (f"{1.005:.2f}", "7"), "q2": ("", "0")}
    summary.write_table(whole, str(tmp_path / "t"), "\t", "query")
    assert spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "t")).count() == 2
    done, failed = summary.split_failed(spark.createDataFrame([("complete",), ("failed",), (None,)], "status string"))
    assert (done.count(), failed.count()) == (1, 2)
    assert summary.combine([base, part]).count() == 3


def test_simulated_subsets_and_folds(spark):
    sets = spark.createDataFrame([("g", f"m{i}") for i in range(10)] * 2, "k string, m string")
    sizes = {(r["level"], r["repeat"]): r["count"] for r in ml.simulated_subsets(sets, "k", "m", [0.05, 0.5], 2).groupBy("level", "repeat").count().collect()}
    assert sizes == {(0.05, 0): 1, (0.05, 1): 1, (0.5, 0): 5, (0.5, 1): 5}
    assert ml.capped_sample(sets.distinct(), "k", 3, ["m"]).count() == 3
    spread = ml.folds(sets, "m", 3).groupBy("m").agg(F.count_distinct("fold").alias("n"))
    assert spread.where("n > 1").count() == 0


def test_outliers_are_damped(spark):
    rows = [("g", float(v)) for v in [*range(10, 22), 1000]]
    got = {r["v"]: r["damped"] for r in ml.damp_outliers(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()}
    assert got[1000.0] == 500.0 and all(k == v for k, v in got.items() if k < 1000)


def event(query, kind, share, at):
    return json.dumps({"timestamp": f"2024-01-01T00:00:{at:02d}", "event": kind, "query": query, "progress": share, "stage": f"s{at}"})


EVENTS = [event("a", "stage", 10.0, 1), event("a", "stage", 5.0, 2), event("b", "query_complete", 50.0, 3), "noise"]


def test_progress_fold(spark):
    folded = progress.fold(progress.parse_events(lines(spark, *EVENTS)))
    got = {r["query"]: (r["progress"], r["stage"], r["done"]) for r in folded.collect()}
    assert got == {"a": (10.0, "s2", False), "b": (50.0, "s3", True)}
    assert tuple(progress.overall(folded, 2).first()) == (55.0, 1, 0)


def test_progress_as_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.txt").write_text("\n".join(EVENTS[:2]))
    (source / "two.txt").write_text("\n".join(EVENTS[2:]))
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))
    writer = progress.fold(progress.parse_events(stream)).writeStream.outputMode("complete").format("memory").queryName("progress_test")
    run = writer.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    assert run.awaitTermination(120)
    assert {r["query"]: r["progress"] for r in spark.table("progress_test").collect()} == {"a": 10.0, "b": 50.0}


def test_manifest(spark):
    kind = "q string, status string, at int, sum string"
    now = spark.createDataFrame([("a", "complete", 1, "x"), ("b", "running", 1, "y")], kind)
    later = progress.advance(now, spark.createDataFrame([("a", "running", 2, "x"), ("b", "failed", 2, "y")], kind), "q")
    assert {r["q"]: r["status"] for r in later.collect()} == {"a": "complete", "b": "failed"}
    inputs = spark.createDataFrame([("a", "x"), ("a2", "x"), ("b", "y")], "q string, sum string")
    assert sorted(r["q"] for r in progress.pending(inputs, later, "q", "sum").collect()) == ["a2", "b"]
    assert tuple(progress.totals(later).select("total", "complete", "failed", "done").first()) == (2, 1, 1, 2)
