"""Web archives with a Zstandard dictionary of their own, written and read as Spark jobs.

An archive is one binary value of bounded size: a skippable frame with the dictionary, then
one compressed frame per WARC record.  The dictionary is built from the first records of
that archive, so every archive can be read alone.  ``write_archives`` gives the archives as
rows, ready for a table in shared storage; ``export_archives`` puts them into a mounted
folder as ``.warc.zst`` files and ``read_archive_files`` loads such files.

Among records with the same payload, the one with the largest key is a response and the
others revisit it; payloads below ``min_revisit_bytes`` are always responses.

Cases: a null payload is empty.  A null key is smaller than any other; it is read back as
null, and a group with null keys only has responses.  Rows that repeat the largest key of a
group are responses as well.  An empty table gives no archive.  Carriage returns and line
feeds in URLs are percent-encoded; a null URL is left out.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import os
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgrain.session import durable

# Uncompressed bytes of an archive, about; a record is never divided.
ARCHIVE_BYTES = 16 << 20
# The dictionary is trained on the first records of an archive, up to this many bytes.
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3

# Frame marks of the Zstandard format, the profile and layout of WARC 1.1.
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
LINE = "\r\n"
RECORD_FIELDS = "key string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"


def record_id(key: str) -> str:
    return f"<urn:x-page:{key}>"


def key_of(identifier: str | None) -> str | None:
    return (identifier.removeprefix("<urn:x-page:").removesuffix(">") or None) if identifier else None


def record(key: str, url: str | None, payload: bytes, size: int, digest: str, refers_to: str | None) -> bytes:
    """A response with its payload, or a revisit with only the header of the HTTP answer."""
    http = LINE.join(("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {size}", "", "")).encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(key)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return LINE.join(lines).encode("utf-8") + block + b"\r\n\r\n"


def dictionary_of(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; if these are too few, the end of their text is the dictionary."""
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Collects records until the dictionary can be built, then compresses each at once."""

    def __init__(self) -> None:
        self.waiting: list[bytes] = []
        self.raw_bytes = 0
        self.out = io.BytesIO()
        self.compressor: zstandard.ZstdCompressor | None = None

    def add(self, one: bytes) -> None:
        self.raw_bytes += len(one)
        if self.compressor is not None:
            self.out.write(self.compressor.compress(one))
            return
        self.waiting.append(one)
        if self.raw_bytes >= SAMPLE_BYTES:
            self.begin()

    def begin(self) -> None:
        dictionary = dictionary_of(self.waiting)
        raw = dictionary.as_bytes()
        self.out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
        dictionary.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        for one in self.waiting:
            self.out.write(self.compressor.compress(one))
        self.waiting = []

    def close(self) -> bytes:
        if self.compressor is None:
            self.begin()
        return self.out.getvalue()


def records_of(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an archive, in order."""
    start, options = 0, {}
    if archive[:4] == struct.pack("<I", SKIPPABLE):
        (size,) = struct.unpack("<I", archive[4:8])
        start, options = 8 + size, {"dict_data": zstandard.ZstdCompressionDict(archive[8 : 8 + size])}
    stream = zstandard.ZstdDecompressor(**options).stream_reader(io.BytesIO(archive[start:]), read_across_frames=True)
    reader = io.BufferedReader(stream, 1 << 20)
    while line := reader.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        fields: dict[str, str] = {}
        while (line := reader.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
            fields[name.lower()] = value
        block = reader.read(int(fields["content-length"]))
        if reader.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where it says")
        yield fields, block


def planned_records(pages: DataFrame, key: str, url: str, payload: str, min_revisit_bytes: int) -> DataFrame:
    """Rows with digest and, for revisits, the key they refer to.

    Groups are aggregated before the shuffle, so a payload that a third of the rows share is
    one row there; the join with the rows is one that adaptive execution can split.
    """
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload")
    ).withColumns({"digest": F.sha1(F.col("payload").cast("binary")), "size": F.octet_length("payload").cast("long")})
    groups = durable(rows.groupBy("digest", "size").agg(F.max("key").alias("keeper")))
    revisits = (F.col("size") >= min_revisit_bytes) & F.col("keeper").isNotNull() & ~F.col("key").eqNullSafe(F.col("keeper"))
    return rows.join(groups, ["digest", "size"]).select(
        "key", "url", "digest", "size",
        F.when(revisits, F.col("keeper")).alias("refers_to"),
        F.when(revisits, F.lit("")).otherwise(F.col("payload")).alias("payload"),
    )


def write_archives(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """``(archive, data)``: one row per archive.

    A task begins a new archive whenever one is full, so the records are not moved again
    after they have met their group, and no task holds more than one archive.
    """
    planned = planned_records(pages, key, url, payload, min_revisit_bytes)
    placed = planned.select(
        F.coalesce(F.col("key").cast("string"), F.lit("")).alias("key"),
        F.col("refers_to").cast("string").alias("refers_to"),
        "url", "digest", "size", "payload",
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, writer = TaskContext.get().partitionId() << 24, 0, ArchiveWriter()
        for batch in batches:
            for name, refers, link, digest, size, body in zip(*(column.to_pylist() for column in batch.columns)):
                if writer.raw_bytes >= archive_bytes:
                    yield archive_row(base + number, writer.close())
                    number, writer = number + 1, ArchiveWriter()
                base32 = base64.b32encode(bytes.fromhex(digest)).decode()
                writer.add(record(name, link, body.encode("utf-8"), size, base32, refers))
        if writer.raw_bytes:
            yield archive_row(base + number, writer.close())

    return placed.mapInArrow(write, "archive bigint, data binary")


def archive_row(archive: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([archive], pa.int64()), pa.array([data], pa.binary())], ["archive", "data"])


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of archives (column ``data``), digests and sizes of responses measured anew."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for data in batch.column(0):
                rows, held = [], 0
                for fields, block in records_of(data.as_py()):
                    row = parsed(fields, block, with_payload)
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if held > SAMPLE_BYTES or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select("data").mapInArrow(read, RECORD_FIELDS)


def parsed(fields: dict[str, str], block: bytes, with_payload: bool) -> dict:
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response":
        size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} does not fit its digest")
    else:
        size = int(head.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
    return {
        "key": key_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": key_of(fields.get("warc-refers-to")), "payload": payload if with_payload and kind == "response" else None,
    }


def export_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Write each archive as a file into a folder that every executor mounts; gives the paths."""

    def export(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                path = f"{folder}/part-{archive:012d}.warc.zst"
                with open(f"{path}.{uuid.uuid4().hex}", "wb") as file:
                    file.write(data.as_py())
                os.replace(file.name, path)  # a repeated task puts the same bytes in place
                yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    return archives.select("archive", "data").mapInArrow(export, "path string")


def read_archive_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select(F.col("path").alias("archive"), F.col("content").alias("data"))
