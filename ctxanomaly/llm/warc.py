"""WARC archives in Zstandard: writer and reader.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary its records were compressed with, and then has one Zstandard frame
per record.  Payloads seen before are written as ``revisit`` records that
refer to the response with the smallest page_id.

Archives are byte strings of bounded size; they are written through Spark (a
table of path and content in the shared folder), and :func:`read_archives`
reads any such rows, also those of Spark's ``binaryFile`` source.  The reader
checks the dictionary frame, each frame's checksum, the record's version line
and named headers, its Content-Length, the HTTP length and the payload digest.

Defined results: a null html is an empty payload; a null page_id is never the
smallest unless all are null; rows that repeat the smallest page_id are all
responses; a null url is left out; control characters in a url are
percent-encoded; an empty table gives no archive and no rows; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxanomaly.llm.common import arrow_rows, body, cut, prepare

# Fixed values of the formats.
VERSION = b"WARC/1.1"
SKIPPABLE_MAGIC = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Payload-Digest")

ARCHIVE_BYTES = 4 << 20
DICTIONARY_BYTES = 16 << 10
SAMPLES, SAMPLE_BYTES = 64, 4 << 10  # the dictionary is trained on the first records of its archive
_CHUNK = 32 << 10


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None)]
    return b"\r\n".join(lines) + b"\r\n\r\n"


def _clean_url(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit where ``refers_to`` is given."""
    digest = payload_digest(payload)
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = lambda page: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"
    head = _header(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", name(page_id)),
            ("WARC-Date", date),
            ("WARC-Target-URI", _clean_url(url)),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Profile", PROFILE if revisit else None),
            ("WARC-Refers-To", name(refers_to) if revisit else None),
            ("X-Page-Id", page_id),
            ("X-Refers-To-Page-Id", refers_to),
            ("Content-Type", "application/http;msgtype=response"),
            ("Content-Length", len(block)),
        ]
    )
    return head + block + b"\r\n\r\n"


def build_archive(records: list[bytes]) -> bytes:
    """Dictionary frame, then one frame per record."""
    samples = [r[:SAMPLE_BYTES] for r in records[:SAMPLES]]
    try:
        trained = zstd.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstd.ZstdError:  # too little to train on: the first record itself is the dictionary
        trained = records[0][:DICTIONARY_BYTES]
    coder = zstd.ZstdCompressor(dict_data=_dictionary(trained), write_checksum=True)
    return b"".join([struct.pack("<II", SKIPPABLE_MAGIC, len(trained)), trained, *map(coder.compress, records)])


def _dictionary(content: bytes) -> zstd.ZstdCompressionDict:
    full = content[:4] == DICTIONARY_MAGIC
    return zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_FULLDICT if full else zstd.DICT_TYPE_RAWCONTENT)


def frames(archive: bytes) -> Iterator[bytes]:
    """The records' bytes, decoded with the archive's own dictionary."""
    if len(archive) < 8:
        raise ValueError("no dictionary frame")
    magic, size = struct.unpack_from("<II", archive)
    if magic != SKIPPABLE_MAGIC or 8 + size > len(archive):
        raise ValueError("no dictionary frame")
    view, at = memoryview(archive), 8 + size
    content = bytes(view[8:at])
    if content[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary may itself be a frame
        content = zstd.ZstdDecompressor().decompress(content)
    decoder = zstd.ZstdDecompressor(dict_data=_dictionary(content))
    while at < len(archive):
        one, parts = decoder.decompressobj(), []
        while not one.eof:
            if at >= len(archive):
                raise ValueError("a frame is cut off")
            chunk = view[at : at + _CHUNK]
            parts.append(one.decompress(chunk))
            at += len(chunk) - len(one.unused_data)
        yield b"".join(parts)


def parse_record(record: bytes) -> tuple[dict[str, str], int, bytes | None]:
    """Headers, payload length and payload (None in a revisit) of one record."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ValueError(f"not a {VERSION.decode()} record")
    fields = {k: v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:])}
    if missing := [k for k in REQUIRED if k not in fields]:
        raise ValueError(f"headers missing: {missing}")
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {length} does not fit a block of {len(rest) - 4} bytes")
    http, found, payload = rest[:length].partition(b"\r\n\r\n")
    declared = re.search(rb"\r\nContent-Length: (\d+)", http)
    if not found or not declared:
        raise ValueError("no HTTP header in the block")
    size = int(declared[1])
    if fields["WARC-Type"] == "revisit":
        if payload or "WARC-Refers-To" not in fields:
            raise ValueError("a revisit has a payload or refers to nothing")
        return fields, size, None
    if len(payload) != size or fields["WARC-Payload-Digest"] != f"sha1:{payload_digest(payload)}":
        raise ValueError("the payload does not fit its length or digest")
    return fields, size, payload


def with_responses(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``.  Equal payloads are found by
    digest and length with map-side minima; the join splits skewed digests."""
    rows = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), body("html").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = (F.octet_length("payload") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", F.when(again & F.col("first").isNotNull(), F.col("first")).alias("refers_to")
    )


def write_archives(
    pages: DataFrame, min_revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = "2024-01-01T00:00:00Z"
) -> DataFrame:
    """Archives of the pages as rows ``path, content``, written to the shared
    folder.  A task holds one archive at a time."""
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, held = [], 0

        def flush() -> pa.RecordBatch:
            content = build_archive(records)
            path = hashlib.sha1(content).hexdigest() + ".warc.zst"
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([content], pa.binary())], names=["path", "content"])

        for columns in arrow_rows(batches, "page_id", "url", "payload", "refers_to"):
            for page_id, url, payload, refers_to in zip(*columns, strict=True):
                records.append(build_record(page_id, url, payload, refers_to, date))
                held += len(records[-1])
                if held >= archive_bytes:
                    yield flush()
                    records, held = [], 0
        if records:
            yield flush()

    return cut(with_responses(pages, min_revisit_bytes).mapInArrow(run, "path string, content binary"), "archives")


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record of archives given as ``path, content``: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to`` and, if asked for,
    ``url`` and ``payload``.  A faulty archive stops the job with its path."""
    prepare(archives.sparkSession)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema += ", url string, payload binary" if payloads else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in schema.split(", ")]
        number = lambda x: None if x is None else int(x)
        for paths, contents in arrow_rows(batches, "path", "content"):
            for path, content in zip(paths, contents, strict=True):
                rows = []
                for k, record in enumerate(frames(content)):
                    try:
                        fields, size, payload = parse_record(record)
                    except ValueError as e:
                        raise ValueError(f"{path}, record {k}: {e}") from e
                    row = (
                        number(fields.get("X-Page-Id")), size, fields["WARC-Payload-Digest"].partition(":")[2],
                        fields["WARC-Type"], number(fields.get("X-Refers-To-Page-Id")),
                    )
                    rows.append((*row, fields.get("WARC-Target-URI"), payload) if payloads else row)
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=False)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return archives.select("path", "content").mapInArrow(run, schema)
