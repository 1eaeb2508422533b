"""Token-id shards with a minimal perfect hash index from document keys to places in the shards.

Shards are binary files: a header, the documents' token counts and keys, and the raw ids as little-endian unsigned integers of 16 bits
where the vocabulary fits them, else of 32.
Documents are dealt by ranges of their id, so shards in order of number hold documents in ascending order of id. A task writes
shards of bounded size through Spark's text writer, one row and so one file each, ended by a line separator that readers drop. Before
each shard goes a small file with its table alone, from which the index is built.

The index divides keys into buckets by a hash. A bucket's minimal perfect hash has a displacement for each of its small groups of
keys, chosen so that all keys fall on different slots; a slot stores a fingerprint of its key, the shard, the place in it and the
length. Looking a key up takes two hashes and one slot, however many keys there are, and a key that was never stored is
told by its fingerprint but for 1 in 2 ** 32; read_payloads() then compares the key that the shard itself stores at that place. The
places found are brought to their shards, one row a shard (broadcast up to BROADCAST_KEYS of them, else both sides are dealt by
shard), and each payload is cut out at its place. A key, file or payload that is missing or differs raises.

Defined cases: null text is empty, its document is the end id alone; null ids come first; of repeated ids, the rows are ordered by
text and keyed by id and ordinal, and one task encodes them; a text longer than a shard has a shard of its own; an empty table gives no
shards; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyframe.llm.common import arrow_batches, materialize, mix, scratch

MAGIC, TABLE_MAGIC = b"TOKS", b"TOKT"
SHARD_TOKENS = 1 << 22
#: Rows of one task's range, at most about; the session's number of shuffle partitions holds where it gives smaller ranges.
RANGE_ROWS = 50_000
#: Bytes that go to a Python worker at a time, about.
BATCH_BYTES = 4 << 20
#: So many keys' places, 32 bytes each, are broadcast to the tasks that read shards.
BROADCAST_KEYS = 2_000_000
#: Keys of an index bucket, about, and of a displacement group, on average.
BUCKET_KEYS, GROUP_KEYS = 20_000, 3
#: Pieces of text whose ids a worker remembers.
REMEMBERED = 800_000
_APART = "\0"
_MARKS = (_APART + ".", _APART + ",")
_LINE = _APART + "\n"
_TWO_MARKS = ("..", ".,", ",.", ",,")
_ENDS_PLAIN = re.compile(r"[A-Za-z0-9\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]\Z").search
_encoder: dict = {}


class Encoder:
    """The tokenizer over whole texts. Its pre-tokenizer never joins text across a single blank, nor a letter or digit with a mark
    after it, so the pieces between blanks, with marks and line ends as pieces of their own, are encoded once and remembered. Texts
    that open with a blank or mark, or have blanks in a row, a mark after anything but a letter or digit, or a special token's string,
    are encoded as a whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.kind = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.model = self.whole.model
        # letters up to U+024F as the pre-tokenizer writes their bytes
        written = lambda c: self.whole.pre_tokenizer.pre_tokenize_str(c)[0][0]
        self.shown = {c: written(chr(c)) for c in range(65, 0x250) if chr(c).isalpha()}
        self.space, self.line = written(" "), self._encode("\n")
        self.known: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}  # pieces that end in a sign

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _piece(self, piece: str) -> bytes:
        """The ids of a piece: a word after a blank, or what follows _APART. Runs of letters need no pre-tokenizer."""
        lead, ids, body = self.space, b"", piece
        if piece[:1] == _APART:
            lead, body = "", piece[1:]
            if body[:1] == "\n":
                ids, body = self.line, body[1:]
        if body.isalpha() and max(body) < "\u0250":
            return ids + array(self.code, [t.id for t in self.model.tokenize(lead + body.translate(self.shown))]).tobytes()
        return self._encode(f" {piece}" if lead else piece[1:])

    def _rest(self, pieces: list[str]) -> list[bytes] | None:
        """The ids of each piece; None if two of them cannot be told apart. Pieces with anything that matters to that are never in
        `known`, so texts of known pieces alone need no look at each."""
        known, odd = self.known, self.odd
        out = [*map(known.get, pieces)]
        if None in out:
            if len(known) + len(odd) >= REMEMBERED:
                known.clear()
                odd.clear()
            for i, ids in enumerate(out):
                if ids is None:
                    piece = pieces[i]
                    if piece == _LINE and i + 1 == len(pieces):
                        out[i] = self.line
                        continue
                    out[i] = odd.get(piece)
                    if out[i] is not None and (i + 1 == len(pieces) or pieces[i + 1][:2] not in _MARKS):
                        continue
                    body = piece[1:] if piece[:1] == _APART else piece
                    if not body or body[-1].isspace() or body[0].isspace() and body[0] != "\n":
                        return None  # blanks in a row
                    if _ENDS_PLAIN(piece) or piece in _MARKS:
                        out[i] = known[piece] = known.get(piece) or self._piece(piece)
                    elif i + 1 < len(pieces) and pieces[i + 1][:2] in _MARKS:
                        return None  # a mark after a sign
                    else:
                        out[i] = odd[piece] = self._piece(piece)
        return out

    def __call__(self, text: str) -> bytes:
        if _APART in text or any(s in text for s in self.special) or any(two in text for two in _TWO_MARKS):
            return self._encode(text)
        split = text
        for mark in ".,\n":
            split = split.replace(mark, f" {_APART}{mark}")
        first, *pieces = split.split(" ")
        bare = not first or first[-1].isspace() or pieces and not _ENDS_PLAIN(first) and pieces[0][:2] in _MARKS
        ids = None if bare else self._rest(pieces)
        return self._encode(text) if ids is None else self._encode(first) + b"".join(ids)


def _encoder_for(path: str) -> Encoder:
    if path not in _encoder:
        _encoder[path] = Encoder(path)
    return _encoder[path]


_KEY = np.dtype([("id", "<i8"), ("null", "u1"), ("ordinal", "<u4")])


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write docs' ids below path; return (id, ordinal, part, shard, place, n_tokens) of each document: shard numbers within the
    range `part`, place in tokens within the shard."""
    spark = docs.sparkSession
    key = F.col(id_col).cast("long")
    rows = docs.select(key.alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    order = F.col("id").asc_nulls_first()
    ranged = rows.repartitionByRange(parts, order).sortWithinPartitions(order, "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = _encoder_for(tokenizer), TaskContext.get().partitionId()
        width = encoder.kind.itemsize
        end = np.array([end_id], encoder.kind).tobytes()
        held, ids, size, shard, last, ordinal = [], [], 0, 0, (), 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(x) // width for x in held], "<u4")
            keys = np.array([(0 if i is None else i, i is None, o) for i, o in ids], _KEY)
            table = b"".join((struct.pack("<IIII", width, part, shard, len(held)), lengths.tobytes(), keys.tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([TABLE_MAGIC + table, b"".join((MAGIC, table, *held))], pa.binary())], ["shard"])

        for b in batches:
            for i, text in zip(b.column(0), b.column(1), strict=True):
                i = i.as_py()
                ordinal = ordinal + 1 if (i,) == last else 0
                last = (i,)
                held.append(encoder(text.as_py()) + end)
                ids.append((i, ordinal))
                size += len(held[-1]) // width
                if size >= shard_tokens:
                    yield flush()
                    held, ids, size, shard = [], [], 0, shard + 1
        if held:
            yield flush()

    shards = ranged.mapInArrow(encode, "shard binary").select(F.col("shard").cast("string").alias("value"))
    with arrow_batches(spark, BATCH_BYTES):
        shards.write.option("maxRecordsPerFile", 1).text(path)
    return shard_contents(spark, path)


def _table(data: memoryview, magic: bytes) -> tuple[int, int, int, np.ndarray, np.ndarray, int]:
    """width, part, shard, token counts, keys and the end of a shard's table."""
    if bytes(data[:4]) != magic or len(data) < 20:
        raise ValueError("not a shard of token ids")
    width, part, shard, n = struct.unpack_from("<IIII", data, 4)
    end = 20 + (4 + _KEY.itemsize) * n
    if width not in (2, 4) or len(data) < end:
        raise ValueError(f"shard {part}/{shard} is cut off")
    return width, part, shard, np.frombuffer(data, "<u4", n, 20), np.frombuffer(data, _KEY, n, 20 + 4 * n), end


def _parse(data: memoryview) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """part, shard, token counts, keys and ids of a shard file; checks its magic and its length."""
    width, part, shard, lengths, keys, at = _table(data, MAGIC)
    total = int(lengths.sum())
    if len(data) != at + width * total + 1:
        raise ValueError(f"shard {part}/{shard} has {len(data)} bytes; {at + width * total + 1} expected")
    return part, shard, lengths, keys, np.frombuffer(data, f"<u{width}", total, at)


def _files(spark: SparkSession, path: str, tables: bool = False) -> DataFrame:
    """(content, part, shard) of the shard files, or of the tables before them; Spark's writer numbers files by task and by row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"part-*-c*[{'02468' if tables else '13579'}].*").load(path)
    number = lambda pattern: F.regexp_extract(F.element_at(F.split("path", "/"), -1), pattern, 1).cast("int")
    row = number(r"-c(\d+)\.[a-z]+$")
    return files.select("content", number(r"^part-(\d+)-").alias("part"), F.floor(row / 2).cast("int").alias("shard"))


_PLACES = "id long, ordinal long, part int, shard int, place long, n_tokens long"


def shard_contents(spark: SparkSession, path: str) -> DataFrame:
    """(id, ordinal, part, shard, place, n_tokens) of all documents, from the shards' tables."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                _, part, shard, lengths, keys, _ = _table(memoryview(content.as_buffer()), TABLE_MAGIC)
                n = len(lengths)
                place = np.cumsum(lengths, dtype=np.int64) - lengths
                columns = [pa.array(keys["id"], mask=keys["null"] == 1), keys["ordinal"].astype(np.int64), np.full(n, part, np.int32), np.full(n, shard, np.int32), place, lengths.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "ordinal", "part", "shard", "place", "n_tokens"])

    return _files(spark, path, tables=True).select("content").mapInArrow(read, _PLACES)


def read_payloads(found: DataFrame, path: str, n_keys: int) -> DataFrame:
    """(id, ordinal, part, shard, place, n_tokens, crc) of n_keys found places (as of lookup), each payload cut out of its shard.

    Raises if a shard's own table has another key or length there. crc is over the ids as 32-bit integers.
    """
    spark = found.sparkSession
    asked = found.groupBy("part", "shard").agg(F.collect_list(F.struct("place", "n_tokens", "id", "ordinal")).alias("asked"))
    if n_keys <= BROADCAST_KEYS:
        asked = F.broadcast(asked)
    met = _files(spark, path).join(asked, ["part", "shard"]).select("content", "asked")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content, asked in zip(b.column(0), b.column(1), strict=True):
                part, shard, lengths, keys, ids = _parse(memoryview(content.as_buffer()))
                rows = asked.values
                place, n_tokens, key, ordinal = (rows.field(i) for i in range(4))
                at, n, none = place.to_numpy(), n_tokens.to_numpy(), key.is_null().to_numpy(zero_copy_only=False)
                number, o = key.fill_null(0).to_numpy(), ordinal.to_numpy()
                starts = np.cumsum(lengths, dtype=np.int64) - lengths
                doc = np.minimum(np.searchsorted(starts, at), len(starts) - 1)
                own = keys[doc]
                if ((starts[doc] != at) | (lengths[doc] != n) | (own["id"] != number) | ((own["null"] == 1) != none) | (own["ordinal"] != o)).any():
                    raise ValueError(f"shard {part}/{shard} has other documents than the index says")
                crc = [zlib.crc32(ids[a : a + k].astype("<u4")) for a, k in zip(at.tolist(), n.tolist(), strict=True)]
                same = np.full(len(at), part, np.int32), np.full(len(at), shard, np.int32)
                yield pa.RecordBatch.from_arrays([key, ordinal, *map(pa.array, same), place, n_tokens, pa.array(crc, pa.int64())], ["id", "ordinal", "part", "shard", "place", "n_tokens", "crc"])

    return met.mapInArrow(read, f"{_PLACES}, crc long")


def _key_hash(keys: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each key: together they tell any number of keys apart."""
    raw, ordinals = (keys[c].to_numpy(np.int64).view(np.uint64) for c in ("id", "ordinal"))
    one = mix(mix(raw ^ mix(ordinals)) + keys["no_id"].to_numpy(bool).astype(np.uint64))
    return one, mix(one ^ mix(raw + mix(ordinals + np.uint64(1)))) | np.uint64(1)


def _whole(keys: DataFrame, *rest: str) -> DataFrame:
    """Keys without nulls, as pandas would make floats of integers beside them."""
    return keys.select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("no_id"), "ordinal", *rest)


def _slots(h: np.ndarray, g: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """Slots of keys of hashes h and g under a displacement; a negative one is ~slot, of a group of one key."""
    mixed = (mix(h + g * mix(displacement.astype(np.uint64))) % np.uint64(n)).astype(np.int64)
    return np.where(displacement < 0, ~displacement.astype(np.int64), mixed)


def _group(h: np.ndarray, groups: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)


def _perfect(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """A displacement for each group of keys such that all keys, of distinct pairs of hashes, fall on different slots of len(h).

    Large groups come first. All groups of a size try one displacement at a time; those that fall on free slots, and on no slot of
    an earlier group, keep it. Groups of one key take the slots left over.
    """
    n = len(h)
    groups = max(1, -(-n // GROUP_KEYS))
    group = _group(h, groups)
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(groups + 1))
    sizes = np.diff(starts)
    taken, out, owner = np.zeros(n, bool), np.zeros(groups, np.int32), np.empty(n, np.int64)
    for size in np.unique(sizes[sizes > 1])[::-1].tolist():
        waiting, tried = np.flatnonzero(sizes == size), 0
        own = order[starts[waiting][:, None] + np.arange(size)]
        while len(waiting):
            at = _slots(h[own], g[own], np.array([tried]), n)
            ranked = np.sort(at, axis=1)
            able = np.flatnonzero(~taken[at].any(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1))
            if len(able):
                number = np.arange(len(able))
                owner[at[able]] = len(able)
                np.minimum.at(owner, at[able], number[:, None])
                won = able[(owner[at[able]] == number[:, None]).all(axis=1)]
                taken[at[won]] = True
                out[waiting[won]] = tried
                waiting, own = np.delete(waiting, won), np.delete(own, won, axis=0)
            tried += 1
    single = np.flatnonzero(sizes == 1)
    out[single] = ~np.flatnonzero(~taken).astype(np.int32)
    return out


_INDEX = "bucket int, displacements binary, fingerprints binary, part binary, shard binary, place binary, n_tokens binary"


def build_index(contents: DataFrame, path: str) -> int:
    """Write the index over contents (as of shard_contents) below path; return the number of buckets."""
    n = contents.count()
    buckets = max(1, -(-n // BUCKET_KEYS))

    def tag(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            h, g = _key_hash(f)
            yield f.assign(h=h.view(np.int64), g=g.view(np.int64), bucket=(h % np.uint64(buckets)).astype(np.int32)).drop(columns=["id", "no_id", "ordinal"])

    def build(f: pd.DataFrame) -> pd.DataFrame:
        h, g = (f[c].to_numpy(np.int64).view(np.uint64) for c in ("h", "g"))
        if f.duplicated(["h", "g"]).any():
            raise ValueError("a key is stored twice")
        d = _perfect(h, g)
        at = _slots(h, g, d[_group(h, len(d))], len(h))
        put = lambda values, kind: np.asarray(values)[np.argsort(at)].astype(kind).tobytes()
        columns = {"fingerprints": put(mix(h ^ g) >> np.uint64(32), "<u4"), "part": put(f["part"], "<i4"), "shard": put(f["shard"], "<i4"), "place": put(f["place"], "<i8"), "n_tokens": put(f["n_tokens"], "<i8")}
        return pd.DataFrame([{"bucket": int(f["bucket"].iloc[0]), "displacements": d.tobytes(), **columns}])

    tagged = _whole(contents, "part", "shard", "place", "n_tokens").mapInPandas(tag, "part int, shard int, place long, n_tokens long, h long, g long, bucket int")
    tagged.groupBy("bucket").applyInPandas(build, _INDEX).write.parquet(path)
    return buckets


def lookup(keys: DataFrame, path: str, buckets: int, strict: bool = False) -> DataFrame:
    """keys(id, ordinal) with part, shard, place, n_tokens; keys whose fingerprint differs are left out, or raise if strict."""
    index = keys.sparkSession.read.schema(_INDEX).parquet(path)
    found = "id long, no_id boolean, ordinal long, part int, shard int, place long, n_tokens long"

    def tag(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(bucket=(_key_hash(f)[0] % np.uint64(buckets)).astype(np.int32))

    def find(key: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if strict and len(asked) and not len(held):
            raise ValueError(f"the index has no bucket {key[0]}")
        if not len(asked) or not len(held):
            return pd.DataFrame({c.split()[0]: [] for c in found.split(", ")})
        row = held.iloc[0]
        d, prints = np.frombuffer(row["displacements"], "<i4"), np.frombuffer(row["fingerprints"], "<u4")
        h, g = _key_hash(asked)
        at = _slots(h, g, d[_group(h, len(d))], len(prints))
        known = prints[at] == (mix(h ^ g) >> np.uint64(32)).astype(np.uint32)
        if strict and not known.all():
            raise ValueError(f"{int((~known).sum())} keys are not in the index")
        at = at[known]
        out = asked.loc[known, ["id", "no_id", "ordinal"]]
        for c, kind in (("part", "<i4"), ("shard", "<i4"), ("place", "<i8"), ("n_tokens", "<i8")):
            out[c] = np.frombuffer(row[c], kind)[at]
        return out

    tagged = _whole(keys).mapInPandas(tag, "id long, no_id boolean, ordinal long, bucket int")
    met = tagged.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(find, found)
    return met.withColumn("id", F.when(~F.col("no_id"), F.col("id"))).drop("no_id")


def keyed_read(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write docs' shards and index, then read every document back by its key: (id, start, n_tokens, crc)."""
    spark = docs.sparkSession
    shards, index = scratch(spark, "token-shards"), scratch(spark, "token-index")
    contents = write_shards(docs, shards, tokenizer, end_id, id_col, text_col, shard_tokens)
    with arrow_batches(spark, BATCH_BYTES):
        contents = materialize(contents, "token-contents")
    buckets = build_index(contents, index)
    order = W.partitionBy("id").orderBy("id")
    keys = docs.select(F.col(id_col).cast("long").alias("id")).withColumn("ordinal", F.row_number().over(order).cast("long") - 1)
    n_keys = docs.count()
    with arrow_batches(spark, BATCH_BYTES):
        read = materialize(read_payloads(lookup(keys, index, buckets, strict=True), shards, n_keys), "token-payloads")
    if (n_read := read.count()) != n_keys:
        raise ValueError(f"{n_keys} documents were written, {n_read} read")
    per_shard = contents.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    # shards of a range are summed within it, ranges over all: as many rows as there are ranges
    per_part = per_shard.groupBy("part").agg(F.sum("n").alias("n"))
    before = lambda *by: W.partitionBy(*by).rowsBetween(W.unboundedPreceding, -1)
    parts = per_part.select("part", F.coalesce(F.sum("n").over(before(F.lit(0)).orderBy("part")), F.lit(0)).alias("base"))
    inner = per_shard.select("part", "shard", F.coalesce(F.sum("n").over(before("part").orderBy("shard")), F.lit(0)).alias("within"))
    bases = inner.join(parts, "part").select("part", "shard", (F.col("base") + F.col("within")).alias("base"))
    return read.join(bases, ["part", "shard"]).select("id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "crc")
