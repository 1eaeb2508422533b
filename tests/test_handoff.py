"""Streams that are stopped and go on, and archives: what readers see."""

import io
import tarfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallyframe.sources import archives
from tallyframe.streaming import handoff, progress


def test_a_stopped_stream_loses_and_doubles_nothing(spark, tmp_path):
    source, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    for i in range(4):
        spark.createDataFrame([(f"q{i}", float(j)) for j in range(5)], "query string, progress double").coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema("query string, progress double").option("maxFilesPerTrigger", 1).parquet(source)
    seen = []

    def fail(number):
        seen.append(number)
        if number == 2 and seen.count(2) < 3:
            raise RuntimeError("stopped between a batch and its marker")

    read = lambda: sorted((r.query, r.progress) for r in handoff.published(spark, out, "query string, progress double").collect())
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            handoff.publish(stream(), out, check, before_marker=fail).awaitTermination()
        assert len(read()) == 10  # the third batch is written, but not trusted
    handoff.publish(stream(), out, check, before_marker=fail).awaitTermination()
    assert read() == sorted((f"q{i}", float(j)) for i in range(4) for j in range(5))
    handoff.publish(stream(), out, check, before_marker=fail).awaitTermination()
    assert len(read()) == 20 and seen.count(3) == 1


def test_a_batch_that_differs_from_its_marker_is_refused(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "a long")
    rows.write.parquet(f"{tmp_path}/batches/batch=0")
    spark.createDataFrame([(0, 2)], "batch long, rows long").write.parquet(f"{tmp_path}/done/0")
    with pytest.raises(ValueError):
        handoff.published(spark, str(tmp_path), "a long")


def test_event_lines_are_read_back(spark):
    rows = [("2024-01-01T00:00:00", "progress", "q", 5.0), ("2024-01-01T00:00:01", "query_complete", "q", None)]
    events = spark.createDataFrame(rows, "timestamp string, event string, query string, progress double")
    lines = handoff.event_lines(events)
    assert lines.first().value == handoff.PREFIX + '{"event":"progress","progress":5.0,"query":"q","timestamp":"2024-01-01T00:00:00"}'
    other = spark.createDataFrame([("noise",), ('{"query": "x"}',)], "value string")
    back = progress.parse_events(lines.unionByName(other), handoff.PREFIX)
    assert sorted((r.timestamp, r.event, r.query, r.progress) for r in back.collect()) == rows


def test_members_of_archives(spark, tmp_path):
    def add(tar, name, data):
        info = tarfile.TarInfo(name)
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))

    with tarfile.open(tmp_path / "a.tar", "w") as tar:
        for i in range(9):
            add(tar, f"d/{i}.tsv", f"x\ty\n{i}\t{'é' * i}\n".encode())
        add(tar, "other", b"1")
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as tar:
        add(tar, "z.tsv", b"x\ty\nz")
        add(tar, "empty.tsv", b"")
    spark.dataSource.register(archives.TarMembers)
    load = spark.read.format("tar_members").option("suffix", ".tsv").option("rangeBytes", "20").load(f"file://{tmp_path}")
    assert load.rdd.getNumPartitions() > 5
    assert {r.member: bytes(r.content) for r in load.collect()} == {f"d/{i}.tsv": f"x\ty\n{i}\t{'é' * i}\n".encode() for i in range(9)} | {"z.tsv": b"x\ty\nz", "empty.tsv": b""}
    rows = {r.member: r.row for r in archives.first_rows(load).collect()}
    assert rows["d/3.tsv"] == {"x": "3", "y": "ééé"} and rows["z.tsv"] == {"x": "z"} and "empty.tsv" not in rows
    one = spark.read.format("tar_members").load(f"file://{tmp_path}/a.tar")
    assert one.where(F.col("member") == "other").count() == 1
