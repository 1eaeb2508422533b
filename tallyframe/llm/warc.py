"""WARC archives in Zstandard: a dictionary in the leading skippable frame, then one frame for each record.

Archives are written by Spark's own text writer, so its commit protocol covers lost and repeated tasks and any file system that
Spark writes to will do. A task builds archives of bounded size, one row each; the writer puts each row in a file
of its own and ends it with the line separator, which is chosen to be an empty skippable frame. Every file is thus whole
Zstandard data. Reading goes through Spark's binaryFile source.

Records with equal payloads of at least `least` bytes are written once: the one with the largest id is the response, the
others are revisits that refer to it and have no payload.

Defined cases: null payload is empty; a null id is left out of the record's headers and never is the largest; repeated rows
with the largest id are responses each; a null url is left out, control characters in it are percent-encoded; an empty
table gives no archives; a payload of any length is one record of its own frame; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import scratch

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
#: An empty skippable frame (magic 0x184D2A50, length 0) as text: the writer's line separator.
PADDING = "P*M\x18\x00\x00\x00\x00"

ARCHIVE_BYTES = 4 << 20
#: Payloads sampled for the dictionary, and bytes taken of each: the bound of what the driver holds.
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 8_192, 64 << 10
#: Rows that share a payload are dealt over this many join keys.
SALTS = 8
LEVEL = 3


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def train_dictionary(pages: DataFrame, payload_col: str) -> bytes:
    """A dictionary from a bounded sample; empty if the sample is too small to train on."""
    rows = pages.where(F.length(payload_col) > 0).select(F.substring(payload_col, 1, SAMPLE_BYTES).alias("p")).limit(SAMPLE_ROWS).collect()
    samples = [r["p"].encode("utf-8", "surrogatepass") for r in rows]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _record(record_id: str | None, url: str | None, payload: bytes, sha1: str, refers: str | None, date: str) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    head = [f"WARC-Type: {'revisit' if refers else 'response'}"]
    head.append(f"WARC-Record-ID: <urn:record:{record_id}>" if record_id is not None else f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url}/{sha1}')}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if refers:
        head += [f"WARC-Refers-To: <urn:record:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 1000, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Write a record for each row of pages to archives below path."""
    dictionary = train_dictionary(pages, payload_col)
    text = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), text.alias("payload"), F.sha1(text.cast("binary")).alias("sha1"))
    long = F.octet_length("payload") >= least
    groups = rows.where(long).groupBy("sha1").agg(F.max("id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
    keepers = groups.select("sha1", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
    refers = F.when(long & F.col("keeper").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("keeper"))), F.col("keeper"))
    told = rows.join(keepers, ["sha1", "salt"], "left").select(F.col("id").cast("string").alias("id"), "url", "payload", "sha1", refers.cast("string").alias("refers"))

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead, options = b"", {}
        if dictionary:
            lead = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary
            options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)}
        packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True, **options)
        held, size = [], 0
        for f in frames:
            for i, url, payload, sha1, to in zip(f["id"], f["url"], f["payload"], f["sha1"], f["refers"], strict=True):
                frame = packer.compress(_record(i, url, payload.encode("utf-8", "surrogatepass"), sha1, to, date))
                if size and size + len(frame) > ARCHIVE_BYTES:
                    yield pd.DataFrame({"archive": [lead + b"".join(held)]})
                    held, size = [], 0
                held.append(frame)
                size += len(frame)
        if held:
            yield pd.DataFrame({"archive": [lead + b"".join(held)]})

    archives = told.mapInPandas(pack, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", PADDING).option("maxRecordsPerFile", 1).text(path)


def frame_length(data: memoryview, at: int) -> int:
    """Bytes of the Zstandard frame that starts at `at`, from its block headers alone."""
    try:
        head = zstandard.frame_header_size(data[at : at + 18])
        checked = zstandard.get_frame_parameters(data[at : at + 18]).has_checksum
    except zstandard.ZstdError as e:
        raise WarcError(f"no frame at {at}: {e}") from e
    end = at + head
    while True:
        if end + 3 > len(data):
            raise WarcError(f"frame at {at} is cut off")
        block = int.from_bytes(data[end : end + 3], "little")
        end += 3 + (1 if (block >> 1) & 3 == 1 else block >> 3)
        if block & 1:
            end += 4 * checked
            if end > len(data):
                raise WarcError(f"frame at {at} is cut off")
            return end - at


def records(data: bytes) -> Iterator[bytes]:
    """The records of one archive, each from a frame of its own."""
    view, at, options = memoryview(data), 0, {}
    while at < len(view):
        if at + 8 > len(view):
            raise WarcError(f"{len(view) - at} bytes after the last frame")
        magic, length = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if at + 8 + length > len(view):
                raise WarcError(f"skippable frame at {at} is cut off")
            if magic == DICTIONARY_MAGIC and at == 0:
                body = bytes(view[8 : 8 + length])
                if body[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may itself be compressed
                    body = zstandard.ZstdDecompressor().decompress(body)
                options = {"dict_data": zstandard.ZstdCompressionDict(body)}
            at += 8 + length
            continue
        size = frame_length(view, at)
        try:
            out = zstandard.ZstdDecompressor(**options).decompressobj().decompress(view[at : at + size])
        except zstandard.ZstdError as e:
            raise WarcError(f"frame at {at}: {e}") from e
        yield out
        at += size


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers, names in lower case, and its payload; raises WarcError where a length or header is wrong."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise WarcError("no WARC version line")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise WarcError(f"not a header: {line[:60]!r}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"no {name}")
    if not headers["content-length"].isdigit():
        raise WarcError("content-length is no number")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"content-length is {n}, the block has {len(rest) - 4} bytes")
    if headers["warc-type"] not in ("response", "revisit"):
        return headers, rest[:n]
    status, gap, payload = rest[:n].partition(b"\r\n\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise WarcError("no HTTP head")
    if headers["warc-type"] == "response":
        said = headers.get("warc-payload-digest", "")
        if said.startswith("sha1:") and base64.b32decode(said[5:]) != hashlib.sha1(payload).digest():
            raise WarcError("the payload's digest differs")
    return headers, payload


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload): a row for each record below path."""

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = lambda v: int(v.removeprefix("<urn:record:").removesuffix(">")) if v and v.startswith("<urn:record:") else None
        for f in frames:
            for content in f["content"]:
                out = []
                for record in records(content):
                    h, payload = parse_record(record)
                    n = int(h.get("x-payload-length", len(payload)))
                    if h["warc-type"] == "response" and n != len(payload):
                        raise WarcError(f"payload length is {n}, the payload has {len(payload)} bytes")
                    digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                    out.append((number(h["warc-record-id"]), h.get("warc-target-uri"), n, digest, h["warc-type"], number(h.get("warc-refers-to")), payload))
                columns = dict(zip(names, zip(*out, strict=True), strict=True)) if out else {c: [] for c in names}
                for c in ("page_id", "refers_to"):  # a frame would make floats of integers beside nulls
                    columns[c] = pd.array(columns[c], dtype="Int64")
                yield pd.DataFrame(columns)

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(unpack, schema)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write pages to new archives in the shared folder and read them back."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    return read_archives(pages.sparkSession, path)
