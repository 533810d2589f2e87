import base64
import hashlib
import struct

import pytest
import zstandard

from ctxanomaly.llm import warc
from ctxanomaly.llm.queries import SQL
from llm.oracle import by_spark, by_sql

PAGE = "<html><body>" + "some words of a page " * 40
ROWS = [
    (1, "http://a.example/x", PAGE),
    (2, "http://b.example/y", PAGE),
    (3, None, None),
    (4, "bad\r\nurl", ""),
    (5, "http://c.example/é", "é" * 3000 + "\r\n\r\nWARC/1.1\r\n"),
    (None, "http://d.example/", PAGE),
    (None, "http://d.example/", "only here"),
    (6, "http://long.example/", "long " * 400_000),
    (1, "http://a.example/x", PAGE),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, "x") for r in ROWS + [(100 + i, f"http://e.example/{i}", f"<p>{i % 50} {PAGE[: i * 3]}") for i in range(300)]]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


def test_equals_sql(pages):
    got = warc.read_archives(warc.write_archives(pages, archive_bytes=50_000))
    assert by_spark(got) == by_sql(SQL["op3_warc"], pages=pages)


def test_payloads_survive_real_files(spark, pages, tmp_path):
    archives = warc.write_archives(pages, archive_bytes=50_000)
    for r in archives.collect():
        (tmp_path / r["path"]).write_bytes(r["content"])
    files = spark.read.format("binaryFile").load(str(tmp_path))
    back = warc.read_archives(files, payloads=True).collect()
    assert len(back) == pages.count()
    by_digest = {r["payload_digest"]: r["payload"] for r in back if r["record_type"] == "response"}
    want = {(p, hashlib.sha1((h or "").encode()).digest()) for p, _, h, _ in pages.collect()}
    assert {(r["page_id"], base64.b32decode(r["payload_digest"])) for r in back} == want
    for r in back:
        payload = by_digest[r["payload_digest"]]
        assert hashlib.sha1(payload).digest() == base64.b32decode(r["payload_digest"])
        assert len(payload) == r["payload_bytes"]
        assert (r["payload"] is None) == (r["record_type"] == "revisit")


def test_small_payloads_are_never_revisits(pages):
    got = warc.read_archives(warc.write_archives(pages, min_revisit_bytes=10**9))
    assert got.filter("record_type = 'revisit'").count() == 0


def _archive():
    return warc.build_archive([warc.build_record(i, "http://x/", b"payload %d" % i, None, "2024-01-01T00:00:00Z") for i in range(5)])


def test_reader_refuses_faults():
    good = _archive()
    assert len(list(warc.frames(good))) == 5
    with pytest.raises(ValueError, match="dictionary"):
        list(warc.frames(good[4:]))
    with pytest.raises(ValueError, match="cut off"):
        list(warc.frames(good[:-3]))
    flipped = bytearray(good)
    flipped[-6] ^= 1
    with pytest.raises(zstandard.ZstdError):
        list(warc.frames(bytes(flipped)))
    record = next(warc.frames(good))
    for bad in (
        record.replace(b"WARC/1.1", b"WARC/9.9"),
        record.replace(b"payload 0", b"payload 1"),
        record.replace(b"WARC-Date", b"X-Date"),
        record + b"x",
    ):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_compressed_dictionary_is_accepted():
    good = _archive()
    size = struct.unpack_from("<I", good, 4)[0]
    packed = zstandard.ZstdCompressor().compress(good[8 : 8 + size])
    again = struct.pack("<II", warc.SKIPPABLE_MAGIC, len(packed)) + packed + good[8 + size :]
    assert list(warc.frames(again)) == list(warc.frames(good))


def test_empty_table(spark, pages):
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0
