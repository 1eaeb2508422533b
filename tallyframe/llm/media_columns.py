"""Media columns: signature sniffing of stored media bytes.

An Aho-Corasick automaton locates the magic bytes of known formats anywhere in a payload; a format's validator then walks its
structure and lengths from there. A valid format at the first byte corrects the declared type; valid ones inside are embedded media,
which carve() cuts out.

media_column() stores each text as 8-bit mono PCM in a WAV file in a binary column, under whatever type was declared.

What one validator learns of a payload (where marks lie, where a walk from a position ends) is kept for the next, so payloads full of
magic bytes of texts, archives and pages are still read in about one pass.

Defined cases: null text is empty; an empty payload is padded like any other; null media sniffs as no type, keeps its declared type and
has null digests; a very long text is one payload; repeated rows and equal texts give equal values, and formats that start at one place are
listed widest first; media_column() ignores extra columns, corrected() and carve() keep them but for those of the names that they add; an
empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
import zlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.llm.common import fresh, materialize

BLOCK = 64
SAMPLE_RATE = 8_000


class Payload:
    """Bytes under inspection, with what validators keep of them."""

    def __init__(self, data: bytes):
        self.data = data
        self.marks: dict[bytes, list[int]] = {}
        self.ends: dict[tuple[str, int], int | None] = {}

    def all(self, mark: bytes) -> list[int]:
        """Every place of a mark."""
        if mark not in self.marks:
            found, at = [], self.data.find(mark)
            while at >= 0:
                found.append(at)
                at = self.data.find(mark, at + 1)
            self.marks[mark] = found
        return self.marks[mark]

    def next(self, mark: bytes, at: int, end: int | None = None) -> int:
        """The first place of a mark from `at` on and before `end`, or -1."""
        places = self.all(mark)
        i = bisect.bisect_left(places, at)
        return places[i] if i < len(places) and (end is None or places[i] < end) else -1

    def last(self, mark: bytes, at: int, end: int) -> int:
        places = self.all(mark)
        i = bisect.bisect_left(places, end) - 1
        return places[i] if i >= 0 and places[i] >= at else -1

    def walk(self, kind: str, at: int, step) -> int | None:
        """Where a walk ends: step(place) gives (next place, done); a place that was passed before ends where it ended then."""
        path, p, out = [], at, None
        while p is not None:
            if (kind, p) in self.ends:
                out = self.ends[kind, p]
                break
            path.append(p)
            p, done = step(p)
            if done:
                out = p
                break
        for q in path:
            self.ends[kind, q] = out
        return out


# ---- validators: the end of the format that starts at `at`, or None ----
def _png(m: Payload, at: int) -> int | None:
    b, p = m.data, at + 8
    if b[p : p + 8] != b"\0\0\0\rIHDR":
        return None
    while p + 12 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, p)
        if p + 12 + n > len(b) or zlib.crc32(b[p + 4 : p + 8 + n]) != struct.unpack_from(">I", b, p + 8 + n)[0]:
            return None
        p += 12 + n
        if kind == b"IEND":
            return p
    return None


def _gif(m: Payload, at: int) -> int | None:
    b = m.data

    def block(p: int) -> tuple[int | None, bool]:
        return (None, False) if p >= len(b) else (p + 1, True) if not b[p] else (p + 1 + b[p], False)

    def part(p: int) -> tuple[int | None, bool]:
        if p < len(b) and b[p] == 0x3B:
            return p + 1, True
        if p < len(b) and b[p] == 0x21:
            return m.walk("gif blocks", p + 2, block), False
        if p + 10 <= len(b) and b[p] == 0x2C:
            return m.walk("gif blocks", p + 11 + (3 << ((b[p + 9] & 7) + 1) if b[p + 9] & 0x80 else 0), block), False
        return None, False

    if at + 13 > len(b):
        return None
    return m.walk("gif", at + 13 + (3 << ((b[at + 10] & 7) + 1) if b[at + 10] & 0x80 else 0), part)


def _jpeg(m: Payload, at: int) -> int | None:
    b = m.data
    p, seen = at + 2, False
    while p + 4 <= len(b):
        if b[p] != 0xFF:
            return None
        kind = b[p + 1]
        if kind == 0xD9:
            return p + 2 if seen else None
        (n,) = struct.unpack_from(">H", b, p + 2)
        p += 2 + n
        if kind == 0xDA:  # entropy-coded data up to the next marker that is no restart
            seen = True
            while True:
                p = b.find(b"\xff", p)
                if p < 0 or p + 1 >= len(b):
                    return None
                if b[p + 1] and not 0xD0 <= b[p + 1] <= 0xD7:
                    if b[p + 1] == 0xD9:
                        return p + 2
                    break
                p += 2
    return None


def _wav(m: Payload, at: int) -> int | None:
    b = m.data
    if at + 12 > len(b) or b[at + 8 : at + 12] != b"WAVE":
        return None
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    if end > len(b):
        return None
    p, seen = at + 12, set()
    while p + 8 <= end:
        kind, n = struct.unpack_from("<4sI", b, p)
        if p + 8 + n > end:
            return None
        seen.add(kind)
        p += 8 + n + (n & 1)
    return end if {b"fmt ", b"data"} <= seen and p in (end, end + 1) else None


def _gzip(m: Payload, at: int) -> int | None:
    b = m.data
    d = zlib.decompressobj(31)
    try:
        p = at
        while p < len(b) and not d.eof:
            d.decompress(b[p : p + 65_536])
            p += 65_536
    except zlib.error:
        return None
    return min(p, len(b)) - len(d.unused_data) if d.eof else None


def _pdf(m: Payload, at: int) -> int | None:
    """To the last end mark before the next header, as updates append sections; to the first one if the next header comes before any."""
    header = m.next(b"%PDF-", at + 5)
    end = m.last(b"%%EOF", at, header if header >= 0 else len(m.data))
    if end < 0:
        end = m.next(b"%%EOF", at)
    return end + 5 if end >= 0 and m.next(b"startxref", at, end) >= 0 else None


def _zip(m: Payload, at: int) -> int | None:
    """To the first end-of-directory record that points back to `at` and to a directory of as many entries as it says."""
    if ("zip", -1) not in m.ends:
        m.ends["zip", -1] = None
        for end in m.all(b"PK\x05\x06"):
            if end + 22 > len(m.data):
                continue
            n, size, offset, note = struct.unpack_from("<HIIH", m.data, end + 10)
            start = end - size - offset
            listed = n == 0 and size == 0 or size >= 46 * n > 0 and m.data[end - size : end - size + 4] == b"PK\x01\x02"
            if start >= 0 and listed and end + 22 + note <= len(m.data):
                m.ends.setdefault(("zip", start), end + 22 + note)
    return m.ends.get(("zip", at))


def _ogg(m: Payload, at: int) -> int | None:
    b = m.data

    def page(p: int) -> tuple[int | None, bool]:
        if p + 27 > len(b) or b[p : p + 4] != b"OggS" or b[p + 4]:
            return None, False
        n = b[p + 26]
        end = p + 27 + n + sum(b[p + 27 : p + 27 + n])
        return (None, False) if end > len(b) else (end, bool(b[p + 5] & 4))

    return m.walk("ogg", at, page)


# Magic bytes, type, validator.
SIGNATURES = (
    (b"\x89PNG\r\n\x1a\n", "image/png", _png),
    (b"GIF87a", "image/gif", _gif),
    (b"GIF89a", "image/gif", _gif),
    (b"\xff\xd8\xff", "image/jpeg", _jpeg),
    (b"RIFF", "audio/wav", _wav),
    (b"\x1f\x8b\x08", "application/gzip", _gzip),
    (b"%PDF-", "application/pdf", _pdf),
    (b"PK\x03\x04", "application/zip", _zip),
    (b"OggS", "audio/ogg", _ogg),
)


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for i, (magic, _, _) in enumerate(SIGNATURES):
        found.add_word(magic.decode("latin-1"), i)
    found.make_automaton()
    return found


def sniff(b: bytes, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(type, start, end) of the valid formats in b by start; what lies inside a wider one is listed too."""
    out, seen = [], Payload(b)
    for last, i in automaton.iter(b.decode("latin-1")):
        magic, kind, validator = SIGNATURES[i]
        start = last - len(magic) + 1
        end = validator(seen, start)
        if end is not None:
            out.append((kind, start, end))
    return sorted(out, key=lambda x: (x[1], -x[2]))


def wav(samples: bytes) -> bytes:
    """8-bit mono PCM in a WAV file."""
    pad = b"\x00" * (len(samples) & 1)
    fmt = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, SAMPLE_RATE, SAMPLE_RATE, 1, 8)
    return struct.pack("<4sI4s", b"RIFF", 28 + 8 + len(samples) + len(pad), b"WAVE") + fmt + struct.pack("<4sI", b"data", len(samples)) + samples + pad


def samples_of(b: bytes) -> bytes:
    """The samples of a WAV file's data chunk."""
    p = 12
    while p + 8 <= len(b):
        kind, n = struct.unpack_from("<4sI", b, p)
        if kind == b"data":
            return b[p + 8 : p + 8 + n]
        p += 8 + n + (n & 1)
    raise ValueError("no data chunk")


def padded(raw: bytes) -> bytes:
    return raw + b"\x00" * (-len(raw) % BLOCK if raw else BLOCK)


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared: str = "application/octet-stream") -> DataFrame:
    """(id, declared, n_bytes, media): texts as WAV files in a column, written to the shared folder."""

    def store(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in f["text"]]
            yield pd.DataFrame({"id": f["id"], "declared": declared, "n_bytes": [len(r) for r in raw], "media": [wav(padded(r)) for r in raw]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return materialize(rows.mapInPandas(store, "id long, declared string, n_bytes long, media binary"), "media", compression="zstd")


def corrected(media: DataFrame, media_col: str = "media", declared_col: str = "declared") -> DataFrame:
    """media's columns and sniffed (the corrected type; the declared one where no format starts the bytes) and
    embedded: array<struct<type, start, end>> of the valid formats further in. Columns of these two names are replaced."""
    kept = [c for c in media.columns if c.lower() not in ("sniffed", "embedded")]

    def look(batches):
        import pyarrow as pa

        automaton = _automaton()
        for batch in batches:
            types, inside = [], []
            for b, said in zip(batch.column(media_col).to_pylist(), batch.column(declared_col).to_pylist(), strict=True):
                found = sniff(b, automaton) if b else []
                head = next((k for k, start, _ in found if start == 0), None)
                types.append(head or said)
                inside.append([{"type": k, "start": s, "end": e} for k, s, e in found if s > 0])
            struct_type = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(types, pa.string()), pa.array(inside, struct_type)], [*batch.schema.names, "sniffed", "embedded"])

    rows = media.select(*(F.col(f"`{c}`") for c in kept))
    schema = StructType([*rows.schema.fields, *StructType.fromDDL("sniffed string, embedded array<struct<type:string,start:bigint,end:bigint>>").fields])
    return rows.mapInArrow(look, schema)


def carve(found: DataFrame, media_col: str = "media") -> DataFrame:
    """A row for each embedded medium of corrected()'s result: its columns but media, with type, start and carved bytes, which replace
    columns of these names."""
    e = fresh(found, "_tf_e")
    each = found.withColumn(e, F.explode("embedded"))
    rest = [F.col(f"`{c}`") for c in found.columns if c not in (media_col, "embedded") and c.lower() not in ("type", "start", "carved")]
    at, end = F.col(e)["start"], F.col(e)["end"]
    return each.select(*rest, F.col(e)["type"].alias("type"), at.alias("start"), F.substring(F.col(media_col), (at + 1).cast("int"), (end - at).cast("int")).alias("carved"))


def media_features(media: DataFrame) -> DataFrame:
    """Digests of media_column()'s rows, read back and sniffed."""

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = _automaton()
        for f in frames:
            out = []
            for i, said, n, b in zip(f["id"], f["declared"], f["n_bytes"], f["media"], strict=True):
                if b is None:
                    out.append((i, n, None, None, None, None, None, f"{said};corrected=0;embedded="))
                    continue
                found = sniff(b, automaton)
                kind = next((k for k, start, _ in found if start == 0), said)
                payload = samples_of(b)
                inside = ",".join(f"{k}@{s}-{e}" for k, s, e in found if s > 0)
                out.append((i, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(b), hashlib.sha256(b).hexdigest(), f"{kind};corrected={int(kind != said)};embedded={inside}"))
            yield pd.DataFrame(out, columns=names).astype(whole)

    schema = "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    names = [c.split()[0] for c in schema.split(", ")]
    whole = {c.split()[0]: "Int64" for c in schema.split(", ") if c.endswith(" long")}
    return media.mapInPandas(digest, schema)
