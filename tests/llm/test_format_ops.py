"""WARC, token ids, media and preference formatting: round trips and broken inputs."""

import hashlib
import io
import struct
import zipfile
import zlib

import brute
import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.llm import media_columns, preference_chat, queries, token_store, warc


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, salt string")


def test_warc_round_trip(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()}
    assert got == brute.warc([(r.page_id, r.html) for r in pages.collect()])


def test_warc_revisits_and_odd_rows(spark):
    long = "é" * 700
    rows = [(1, "http://a/\r\nX: y", long), (2, None, long), (3, "u", long), (3, "u", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (None, "u", long)]
    got = warc.round_trip(pages_of(spark, rows))
    seen = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got.collect())
    assert seen == sorted([(1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None), (0, "revisit", 3)], key=lambda x: (x[0], x[1]))
    assert {r.payload_bytes for r in got.where("refers_to is not null").collect()} == {1400}
    kept = got.where("page_id = 3").first()
    assert bytes(kept.payload) == long.encode() and kept.payload_digest == hashlib.sha1(long.encode()).hexdigest()


def test_warc_of_nothing(spark):
    assert warc.round_trip(pages_of(spark, [(1, "u", "x")]).limit(0)).count() == 0


def test_small_archives_each_have_the_dictionary(spark, sf, monkeypatch):
    from tallyframe.llm.common import scratch

    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    path = scratch(spark, "warc-test")
    warc.write_archives(spark.read.parquet(f"{sf}/pages.parquet").coalesce(1), path)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert len(files) > 1
    for data in files:
        assert struct.unpack("<I", data[:4])[0] == warc.DICTIONARY_MAGIC
        assert all(warc.parse_record(r) for r in warc.records(data))


def _archive(record: bytes, dictionary=b"") -> bytes:
    return zstandard.ZstdCompressor(write_checksum=True).compress(record)


RECORD = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:1>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: 21\r\n\r\nHTTP/1.1 200 OK\r\n\r\nhi\r\n\r\n"


def test_frames_and_skippable_frames():
    data = _archive(RECORD) + warc.PADDING.encode("latin-1") + _archive(RECORD)
    assert [warc.parse_record(r)[1] for r in warc.records(data)] == [b"hi", b"hi"]


@pytest.mark.parametrize("bad", [_archive(RECORD)[:-3], _archive(RECORD) + b"junk", _archive(RECORD) + b"junk-that-is-long", b"\x5d\x2a\x4d\x18\xff\xff\x00\x00abc", _archive(RECORD)[:-1] + b"\x00"])
def test_broken_archives_are_refused(bad):
    with pytest.raises(warc.WarcError):
        list(warc.records(bad))


@pytest.mark.parametrize("bad", [RECORD.replace(b"21", b"22"), RECORD.replace(b"WARC/1.1", b"WARC/9"), RECORD.replace(b"WARC-Date", b"X-Date"), RECORD[:-2], RECORD.replace(b": response", b" response"), RECORD.replace(b"21", b"xx")])
def test_broken_records_are_refused(bad):
    with pytest.raises(warc.WarcError):
        warc.parse_record(bad)


def _reference_tokens(rows, path):
    from tokenizers import Tokenizer

    t, at, out = Tokenizer.from_file(path), 0, []
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_token_shards_through_the_index(spark, sf, monkeypatch, broadcast):
    monkeypatch.setattr(token_store, "BROADCAST_KEYS", 10**6 if broadcast else 0)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path = queries.tokenizer_path()
    got = sorted((r.id, r.start, r.n_tokens, r.crc) for r in token_store.keyed_read(docs, path, shard_tokens=5_000).collect())
    assert got == _reference_tokens(sorted((r.doc_id, r.text) for r in docs.collect()), path)


def test_tampered_indexes_and_shards_raise(spark, sf):
    from tallyframe.llm.common import scratch

    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(50)
    shards, index = scratch(spark, "t-shards"), [scratch(spark, "t-index") for _ in range(4)]
    contents = token_store.write_shards(docs, shards, queries.tokenizer_path(), shard_tokens=5_000)
    keys = contents.select("id", "ordinal")
    read = lambda path, n: token_store.read_payloads(token_store.lookup(keys, path, n, strict=True), shards, 50).collect()
    assert len(read(index[0], token_store.build_index(contents, index[0]))) == 50
    wrong = {
        "not in the index": contents.where("id <> 7"),
        "other documents": contents.withColumn("place", F.when(F.col("id") == 7, F.col("place") + 1).otherwise(F.col("place"))),
        "than the index": contents.withColumn("n_tokens", F.when(F.col("id") == 7, F.col("n_tokens") + 1).otherwise(F.col("n_tokens"))),
    }
    for path, (message, told) in zip(index[1:], wrong.items(), strict=True):
        n = token_store.build_index(told, path)
        with pytest.raises(Exception, match=message):
            read(path, n)
    with pytest.raises(Exception, match="stored twice"):
        token_store.build_index(contents.unionAll(contents.where("id = 7")), scratch(spark, "t-index"))


def test_a_lost_shard_raises(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(50)
    monkeypatch.setattr(token_store, "read_payloads", lambda found, path, n, f=token_store.read_payloads: f(found.where("id <> 7"), path, n))
    with pytest.raises(ValueError, match="50 documents were written, 49 read"):
        token_store.keyed_read(docs, queries.tokenizer_path())


def test_token_shards_of_odd_rows(spark, odd_docs, odd_rows):
    path = queries.tokenizer_path()
    more = spark.createDataFrame([(None, "no id"), (20, "<|endoftext|> a  b \n c")], "doc_id long, text string")
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    got = sorted((-1 if r.id is None else r.id, r.start, r.n_tokens, r.crc) for r in token_store.keyed_read(docs, path).collect())
    rows = sorted([*odd_rows, (-1, "no id"), (20, "<|endoftext|> a  b \n c")], key=lambda r: (r[0], r[1] or ""))
    assert got == sorted(_reference_tokens(rows, path))


def test_token_shards_of_nothing(spark, odd_docs):
    assert token_store.keyed_read(odd_docs.limit(0), queries.tokenizer_path()).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 57, 5_000])
def test_perfect_hash_is_minimal(n):
    h = token_store.mix(np.arange(n, dtype=np.uint64))
    h[-1] = h[0]  # two keys with one first hash are told apart by the second
    g = token_store.mix(np.arange(n, dtype=np.uint64) + np.uint64(n)) | np.uint64(1)
    d = token_store._perfect(h, g)
    assert sorted(token_store._slots(h, g, d[token_store._group(h, len(d))], n)) == list(range(n))


def test_unknown_keys_are_told_by_fingerprint(spark, tmp_path):
    rows = [(i, 0, 0, 0, i * 10, 10) for i in range(500)]
    contents = spark.createDataFrame(rows, "id long, ordinal long, part int, shard int, place long, n_tokens long")
    buckets = token_store.build_index(contents, f"file://{tmp_path}/index")
    keys = spark.createDataFrame([(i, 0) for i in range(480, 1500)], "id long, ordinal long")
    got = token_store.lookup(keys, f"file://{tmp_path}/index", buckets).collect()
    assert sorted((r.id, r.place) for r in got) == [(i, i * 10) for i in range(480, 500)]


def test_encoder_matches_whole_texts():
    e = token_store.Encoder(queries.tokenizer_path())
    for t in ["", " ", "  a", "a  b ", "a\n b", "x<|endoftext|>y z", "don't stop, it's.", "é.ç ñandú ß! ...", "tab\t x", "日本 語。 ok", "12a b3, 4.5", "end.  ", "a  b", "x   y", ".. , ?"]:
        assert np.frombuffer(e(t), e.kind).tolist() == e.whole.encode(t, add_special_tokens=False).ids, t


@given(st.lists(st.sampled_from(["a", "Foo", "é", "ß9", "7", " ", " ", "\n", ".", ",", "!", ")", "'s", "\t", "\u00a0", "\r", "_", "%%", "\0", "<|endoftext|>", "日", "\u0301"]), max_size=14), st.integers(0, 1))
@settings(max_examples=3000, deadline=None)
def test_encoder_matches_any_text(encoder, parts, warm):
    text = "".join(parts)
    if warm:
        encoder(text)
    assert np.frombuffer(encoder(text), encoder.kind).tolist() == encoder.whole.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return token_store.Encoder(queries.tokenizer_path())


def test_media_round_trip(spark, odd_docs, odd_rows):
    got = media_columns.media_features(media_columns.media_column(odd_docs)).collect()
    assert len(got) == len(odd_rows)
    want = {i: brute.media(t) for i, t in odd_rows}
    for r in got:
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == want[r.id]
        assert r.feature.startswith("audio/wav;corrected=1")
    assert media_columns.media_features(media_columns.media_column(odd_docs.limit(0))).count() == 0


def _png():
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")


GIF = b"GIF89a\x01\x00\x01\x00\x00\x00\x00,\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00;"


def test_sniffing_corrects_and_carves(spark):
    import gzip

    inner = gzip.compress(b"hello", mtime=0)
    blobs = [("image/gif", _png()), ("image/png", GIF), ("text/plain", b"text " + _png() + b" more " + inner + b"tail"), ("text/plain", b"\x89PNG\r\n\x1a\nbroken"), ("x/y", media_columns.wav(_png())), ("image/png", None), ("image/png", _png()[:-1])]
    df = spark.createDataFrame([(i, d, bytearray(b) if b is not None else None) for i, (d, b) in enumerate(blobs)], "k int, declared string, media binary")
    found = media_columns.corrected(df)
    assert {r.k: r.sniffed for r in found.collect()} == {0: "image/png", 1: "image/gif", 2: "text/plain", 3: "text/plain", 4: "audio/wav", 5: "image/png", 6: "image/png"}
    carved = {(r.k, r.type): bytes(r.carved) for r in media_columns.carve(found).collect()}
    assert carved == {(2, "image/png"): _png(), (2, "application/gzip"): inner, (4, "image/png"): _png()}


def test_carving_takes_whole_pdfs_and_zips():
    automaton = media_columns._automaton()
    first, update = b"%PDF-1.7 a startxref 0 %%EOF", b" b startxref 9 %%EOF"
    assert media_columns.sniff(b"x" + first + update + b"y" + first, automaton) == [("application/pdf", 1, 49), ("application/pdf", 50, 78)]
    assert media_columns.sniff(b"%PDF-1.7 " + first, automaton) == [("application/pdf", 0, 37), ("application/pdf", 9, 37)]
    inner, outer = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("a", "text")
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("b.zip", inner.getvalue())
    whole, start = outer.getvalue(), outer.getvalue().index(inner.getvalue())
    found = media_columns.sniff(b"xx" + whole + b"yy", automaton)
    assert found == [("application/zip", 2, 2 + len(whole)), ("application/zip", 2 + start, 2 + start + len(inner.getvalue()))]


def test_media_of_odd_rows(spark):
    rows = [(1, "image/png", 5, None, "a", "b"), (2, "x/y", 3, bytearray(GIF + _png()), "a", "b"), (3, None, 0, bytearray(b""), "a", "b")]
    df = spark.createDataFrame(rows, "id long, declared string, n_bytes long, media binary, sniffed string, type string")
    found = media_columns.corrected(df)
    assert found.columns == ["id", "declared", "n_bytes", "media", "type", "sniffed", "embedded"]
    assert {r.id: r.sniffed for r in found.collect()} == {1: "image/png", 2: "image/gif", 3: None}
    assert [(r.id, r.type, bytes(r.carved)) for r in media_columns.carve(found).collect()] == [(2, "image/png", _png())]
    stored = spark.createDataFrame([(1, "image/png", 5, None), (2, "x/y", 3, bytearray(media_columns.wav(b"ab")))], "id long, declared string, n_bytes long, media binary")
    got = {r.id: r for r in media_columns.media_features(stored).collect()}
    assert (got[1].payload_bytes, got[1].media_sha256, got[1].feature) == (None, None, "image/png;corrected=0;embedded=")
    assert got[2].payload_bytes == 2


@pytest.mark.parametrize("unit", [b"PK\x03\x04 x", b"%PDF-1 startxref ", b"GIF89a.......!abcde", b"OggS\0\0" + bytes(20) + b"\1\2xy", b"RIFF    WAVEdata    ", b"PK\x05\x06" + bytes(30)])
def test_magic_bytes_without_end_cost_one_pass(unit):
    import time

    automaton, began = media_columns._automaton(), time.process_time()
    found = media_columns.sniff(unit * (2_000_000 // len(unit)), automaton)
    assert time.process_time() - began < 5 and len(found) <= 1


def test_preference_pairs(spark):
    rows = [
        (0, 0, "system", "be kind"), (0, 1, "user", "hi"), (0, 2, "assistant", "hello"), (0, 3, "user", "bye"), (0, 4, "assistant", "so long"),
        (1, 1, "user", "hi"), (1, 0, "system", "be kind"), (1, 2, "assistant", "what"), (4, 0, None, None), (7, 0, "user", "alone"), (None, 0, "user", "lost"),
        (8, 0, "user", "same"), (9, 0, "user", "same"), (10, None, "assistant", "x"), (10, 1, "assistant", "y"), (10, 1, "assistant", "y"),
    ]
    turns = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, pair int")
    got = {r.pair_id: r for r in preference_chat.preference_pairs(turns).collect()}
    assert set(got) == {0, 2, 3, 4, 5}
    p = got[0]
    assert p.n_common == 2 and p.prompt == "<|system|>\nbe kind<|end|>\n<|user|>\nhi<|end|>\n"
    whole = p.prompt + p.chosen
    assert [whole[s.start : s.end] for s in p.chosen_mask] == ["hello<|end|>\n", "so long<|end|>\n"]
    assert [(p.prompt + p.rejected)[s.start : s.end] for s in p.rejected_mask] == ["what<|end|>\n"]
    assert (got[2].chosen, got[2].rejected, got[2].chosen_mask) == ("<|user|>\n<|end|>\n", None, [])
    assert got[3].chosen is None and got[3].rejected == "<|user|>\nalone<|end|>\n"
    assert (got[4].n_common, got[4].chosen, got[4].rejected) == (1, "", "")
    assert len(got[5].chosen_mask) == 3
    assert preference_chat.preference_pairs(turns.limit(0)).count() == 0
