"""Operator 13: web archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each of whole WARC records, closed by a seek
table: a skippable frame that lists for every frame its compressed and its plain size and a checksum,
with the number of frames at the very end. Any Zstandard tool reads a bundle as one stream. The index, a
Parquet table beside the bundles, maps record ids to bundle, frame and offset inside the plain
frame, so a record costs one seek and one small frame.

Of records with one payload of ``min_bytes`` or more, the one with the greatest key carries it as a
``response``; the others are ``revisit`` records that name it, with the payload's digest and with
the HTTP head, whose Content-Length tells its size, but without the payload.

Every task writes bundles of its own from the rows it has; no payload is shuffled to be written. Files get names no
other attempt uses, and only those that the index names, which is written with Spark's commit, belong to
the archive: a lost executor leaves files behind that nobody reads. Which record leads its copies is
a maximum per digest, combined before the shuffle; the leaders are sent to the tasks if they are
few, else joined with a salt, so that copies of one payload spread over tasks.

Defined cases: a null payload is an empty one; a null key is smaller than all others, and if all copies lack
a key, each is a response; rows that share the greatest key are all responses; a null url leaves the
header out; characters that would break a header line are percent-coded; a payload longer than a frame makes
a frame of its own; an empty table makes an archive without bundles; other columns are passed by.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO, NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from stagecheck.storage import delete_path, path_exists

MIN_BYTES = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 30
#: Leaders sent to the tasks instead of being joined by shuffle: 28 bytes each, 64 MB in tasks at most.
MOST_SENT = 400_000
SALTS = 32
DATE = "2020-01-01T00:00:00Z"

# Fixed values of the seekable Zstandard format and of WARC 1.1.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUM = 0x80
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<III")
SKIP_HEAD = struct.Struct("<II")
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RESPONSE, REVISIT = "response", "revisit"
#: Header fields of our own: the key of the row, and that of the response a revisit stands for.
KEY_FIELD, LEADER_FIELD = "X-Row-Key", "X-Refers-To-Row-Key"
_IDS = uuid.UUID("6f3c1b52-8a0e-4d43-9c6a-0d8f3b7a5e21")


class Frame(NamedTuple):
    """Where a frame lies in its bundle, and what it holds when plain."""

    number: int
    start: int
    size: int
    plain_size: int
    checksum: int


class BundleWriter:
    """Groups records into frames of about ``frame_bytes`` and closes the bundle with its seek table."""

    def __init__(self, file: BinaryIO, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.file, self.frame_bytes = file, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset inside the plain frame) of the record."""
        if self.filled and self.filled + len(record) > self.frame_bytes:
            self._end_frame()
        at = len(self.entries), self.filled
        self.open.append(record)
        self.filled += len(record)
        return at

    def _end_frame(self) -> None:
        plain = b"".join(self.open)
        packed = self.packer.compress(plain)
        self.file.write(packed)
        self.entries.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.written += len(packed)
        self.open, self.filled = [], 0

    def close(self) -> None:
        if self.filled:
            self._end_frame()
        table = b"".join(ENTRY.pack(*e) for e in self.entries) + FOOTER.pack(len(self.entries), HAS_CHECKSUM, SEEKABLE_MAGIC)
        self.file.write(SKIP_HEAD.pack(SKIPPABLE_MAGIC, len(table)) + table)
        self.file.close()


def seek_table(file: BinaryIO) -> list[Frame]:
    """The frames of a bundle, from the table at its end; ValueError if it is none."""
    size = file.seek(0, 2)
    if size < SKIP_HEAD.size + FOOTER.size:
        raise ValueError("too short for a seekable bundle")
    file.seek(size - FOOTER.size)
    count, flags, magic = FOOTER.unpack(file.read(FOOTER.size))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end")
    width = ENTRY.size if flags & HAS_CHECKSUM else ENTRY.size - 4
    length = SKIP_HEAD.size + count * width + FOOTER.size
    if length > size:
        raise ValueError("seek table is cut off")
    file.seek(size - length)
    raw = file.read(length)
    if SKIP_HEAD.unpack_from(raw) != (SKIPPABLE_MAGIC, length - SKIP_HEAD.size):
        raise ValueError("seek table has no head of its own")
    frames, start = [], 0
    for number in range(count):
        packed, plain, *checksum = struct.unpack_from("<III" if flags & HAS_CHECKSUM else "<II", raw, SKIP_HEAD.size + number * width)
        frames.append(Frame(number, start, packed, plain, checksum[0] if checksum else -1))
        start += packed
    return frames


def read_frame(file: BinaryIO, frame: Frame) -> bytes:
    """The plain bytes of one frame, checked."""
    file.seek(frame.start)
    plain = zstandard.ZstdDecompressor().decompress(file.read(frame.size), max_output_size=max(1, frame.plain_size))
    if len(plain) != frame.plain_size or frame.checksum not in (-1, xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF):
        raise ValueError(f"frame {frame.number} is damaged")
    return plain


def _safe(text: str) -> str:
    """A header value on one line, as ASCII; what is so already stays as it is."""
    return quote(text, safe="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def record_id(key: str | None, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{key} {digest.hex()}')}>"


def build_record(key: str | None, url: str | None, payload: bytes, digest: bytes, leader: str | None, date: str = DATE) -> bytes:
    """A response, or a revisit of the response with key ``leader``."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if leader is None else head
    fields = [("WARC-Type", RESPONSE if leader is None else REVISIT), ("WARC-Record-ID", record_id(key, digest)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _safe(url)))
    fields.append(("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest).decode()}"))
    if key is not None:
        fields.append((KEY_FIELD, quote(key, safe="")))
    if leader is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(leader, digest)), (LEADER_FIELD, quote(leader, safe=""))]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


class Record(NamedTuple):
    fields: dict[str, str]
    payload: bytes
    payload_bytes: int  # of the payload it carries or stands for


def parse_record(data: bytes, at: int = 0) -> tuple[Record, int]:
    """The record that begins at ``at`` and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if version.encode() != VERSION:
        raise ValueError(f"no record begins at {at}")
    fields = dict(line.split(": ", 1) for line in lines)
    begin = end + 4
    stop = begin + int(fields["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} does not end where it says")
    split = data.index(b"\r\n\r\n", begin, stop) + 4
    head = dict(line.split(": ", 1) for line in data[begin : split - 4].decode().split("\r\n")[1:])
    return Record(fields, data[split:stop], int(head["Content-Length"])), stop + 4


def parse_records(data: bytes) -> Iterator[tuple[int, Record]]:
    at = 0
    while at < len(data):
        record, after = parse_record(data, at)
        yield at, record
        at = after


def _store(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as tasks can open it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def _opener(root: str) -> tuple[fs.FileSystem, str]:
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[5:].lstrip("/")
    return fs.FileSystem.from_uri(root)


def leaders(rows: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(_digest, _leader) of the payloads that several ``rows`` (_key, _digest, _size) have."""
    copies = rows.where(F.col("_size") >= min_bytes).groupBy("_digest").agg(F.max("_key").alias("_leader"), F.count("*").alias("_copies"))
    return copies.where((F.col("_copies") > 1) & F.col("_leader").isNotNull()).drop("_copies")


def _led(rows: DataFrame, min_bytes: int) -> DataFrame:
    """``rows`` with ``_leader``: the key of the response that a row revisits, else null."""
    found = leaders(rows.select("_key", "_digest", "_size"), min_bytes)
    if len(found.limit(MOST_SENT + 1).take(MOST_SENT + 1)) <= MOST_SENT:
        joined = rows.join(F.broadcast(found), "_digest", "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_key", "_url"), F.lit(SALTS)).cast("int"))
        joined = salted.join(found.withColumn("_salt", salts), ["_digest", "_salt"], "left")
    return joined.withColumn("_leader", F.when(~F.col("_leader").eqNullSafe(F.col("_key")), F.col("_leader")))


def write_archive(
    df: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
    min_bytes: int = MIN_BYTES, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = DATE,
) -> DataFrame:
    """Write a record for each row below ``path`` and return the index: record_id, key, record_type, bundle, frame, offset, length.

    ``payload`` is a text, archived as UTF-8, or binary. ``path`` must hold no archive yet.
    """
    spark = df.sparkSession
    root = _store(spark, path.rstrip("/"))
    if path_exists(spark, f"{root}/index"):
        raise ValueError(f"{path} holds an archive already")
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = df.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("_url"), body.alias("_payload")).withColumns(
        {"_digest": F.unhex(F.sha1("_payload")), "_size": F.octet_length("_payload")})
    own = _led(rows, min_bytes).select(
        F.col("_key").cast("string"), "_url", "_payload", "_digest", F.col("_leader").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _opener(root)
        store.create_dir(folder, recursive=True)
        name, writer = "", None
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    name = f"bundle-{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(store.open_output_stream(f"{folder}/{name}", compression=None), frame_bytes)
                record = build_record(*row, date=date)
                frame, offset = writer.add(record)
                out.append((record_id(row[0], row[3]), row[0], RESPONSE if row[4] is None else REVISIT, name, frame, offset, len(record)))
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_pylist([dict(zip(_INDEX.names, o, strict=True)) for o in out], schema=_INDEX)
        if writer is not None:
            writer.close()

    index = own.mapInArrow(run, _INDEX_COLUMNS).withColumn("key", F.col("key").cast(df.schema[key].dataType))
    index.write.option("compression", "zstd").parquet(f"{root}/index")
    return read_index(spark, path)


_INDEX = pa.schema([
    ("record_id", pa.string()), ("key", pa.string()), ("record_type", pa.string()), ("bundle", pa.string()),
    ("frame", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
_INDEX_COLUMNS = "record_id string, key string, record_type string, bundle string, frame bigint, offset bigint, length bigint"


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/index")


def drop_strays(spark: SparkSession, path: str) -> int:
    """Delete the bundles that the index does not name, left by lost tasks, once no job writes; returns their number."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "bundle-*.warc.zst").load(path).select("path")
    files = files.withColumn("bundle", F.element_at(F.split("path", "/"), -1))
    strays = files.join(read_index(spark, path).select("bundle").distinct(), "bundle", "left_anti")
    return sum(delete_path(spark, row.path) for row in strays.toLocalIterator())


def frames_of(spark: SparkSession, path: str, bundles: DataFrame) -> DataFrame:
    """(bundle, number, start, size, plain_size, checksum) of every frame, from the seek tables of ``bundles`` (bundle)."""
    root = _store(spark, path.rstrip("/"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _opener(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{folder}/{name}") as file:
                    frames = seek_table(file)
                yield pa.RecordBatch.from_pylist([{"bundle": name, **f._asdict()} for f in frames], schema=_FRAMES)

    return bundles.mapInArrow(run, "bundle string, number bigint, start bigint, size bigint, plain_size bigint, checksum bigint")


_FRAMES = pa.schema([("bundle", pa.string()), *((f, pa.int64()) for f in Frame._fields)])


def _map_frames(
    spark: SparkSession, path: str, wanted: DataFrame, made: Callable[[bytes, dict], Iterator[tuple]], columns: Sequence[tuple[str, str]],
) -> DataFrame:
    """Open the frames of ``wanted`` (those of :func:`frames_of`, and more columns), one after the other, and map each."""
    root = _store(spark, path.rstrip("/"))
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _opener(root)
        name, file = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["bundle"] != name:
                    if file is not None:
                        file.close()
                    name, file = row["bundle"], store.open_input_file(f"{folder}/{row['bundle']}")
                plain = read_frame(file, Frame(*(row[f] for f in Frame._fields)))
                rows = list(made(plain, row))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
        if file is not None:
            file.close()

    return wanted.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in columns))


_RECORD_COLUMNS = (
    ("record_id", "string"), ("key", "string"), ("record_type", "string"), ("url", "string"), ("payload_bytes", "bigint"),
    ("payload_digest", "string"), ("refers_to", "string"), ("payload", "binary"))


def _row_of(record: Record, with_payload: bool) -> tuple:
    fields = record.fields
    kind = fields["WARC-Type"]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    if kind == RESPONSE and (hashlib.sha1(record.payload).digest() != digest or len(record.payload) != record.payload_bytes):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what its header says")
    key, leader = (None if fields.get(f) is None else unquote(fields[f]) for f in (KEY_FIELD, LEADER_FIELD))
    return (
        fields["WARC-Record-ID"], key, kind, fields.get("WARC-Target-URI"), record.payload_bytes, digest.hex(), leader,
        record.payload if with_payload and kind == RESPONSE else None)


def read_archive(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Every record: record_id, key, record_type, url, payload_bytes, payload_digest, refers_to (a key), payload.

    All frames are opened, spread over tasks; sizes and digests of payloads are those of the bytes
    found. ``payload`` is null unless asked for, and in revisits.
    """
    index = read_index(spark, path)
    kind = index.schema["key"].dataType
    frames = frames_of(spark, path, index.select("bundle").distinct())
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = frames.repartition(slots, "bundle", F.floor(F.col("number") / 16)).sortWithinPartitions("bundle", "number")

    def made(plain: bytes, _: dict) -> Iterator[tuple]:
        for _, record in parse_records(plain):
            yield _row_of(record, with_payload)

    found = _map_frames(spark, path, spread, made, _RECORD_COLUMNS)
    return found.withColumns({"key": F.col("key").cast(kind), "refers_to": F.col("refers_to").cast(kind)})


def fetch_payloads(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """(record_id, payload) for the distinct ``ids`` (record_id) that the archive has; a revisit gets its response's payload.

    Only frames that hold wanted records are read, each once, and records are parsed at their offsets.
    """
    index = read_index(spark, path)
    asked = index.join(ids.select("record_id").distinct(), "record_id", "left_semi").select("record_id", "bundle", "frame", "offset")
    first = _fetch(spark, path, asked)
    there = first.where(F.col("target").isNull()).select("record_id", "payload")
    revisits = first.where(F.col("target").isNotNull()).select("record_id", "target")
    targets = index.join(revisits.select(F.col("target").alias("record_id")).distinct(), "record_id", "left_semi")
    reached = _fetch(spark, path, targets.select("record_id", "bundle", "frame", "offset"))
    return there.unionByName(revisits.join(
        reached.select(F.col("record_id").alias("target"), "payload").dropDuplicates(["target"]), "target").select("record_id", "payload"))


def _fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    grouped = wanted.groupBy("bundle", F.col("frame").alias("number")).agg(F.collect_set("offset").alias("offsets"))
    frames = frames_of(spark, path, wanted.select("bundle").distinct()).join(grouped, ["bundle", "number"])

    def made(plain: bytes, row: dict) -> Iterator[tuple]:
        for offset in row["offsets"]:
            record, _ = parse_record(plain, offset)
            yield record.fields["WARC-Record-ID"], record.fields.get("WARC-Refers-To"), record.payload

    return _map_frames(spark, path, frames, made, (("record_id", "string"), ("target", "string"), ("payload", "binary")))
