import base64
import hashlib
import struct

from textgrain.llm.warc import SKIPPABLE, export_archives, read_archive_files, read_archives, write_archives
from textgrain.session import durable


def brute(rows, least):
    found = []
    for key, _, html in rows:
        raw = (html or "").encode()
        same = [k for k, _, h in rows if (h or "").encode() == raw and k is not None]
        top = max(same, default=None)
        refers = top if len(raw) >= least and top is not None and key != top else None
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        found.append((None if key is None else str(key), len(raw), digest, "response" if refers is None else "revisit", None if refers is None else str(refers)))
    return sorted(found, key=repr)


ROWS = (
    [(i, f"http://a/{i}", f"<p>page {i % 7} é😀\r\n\r\n</p>" * (i % 5)) for i in range(60)]
    + [(70, None, None), (71, "http://x/\r\nWARC-Type: bad", ""), (72, "u", "WARC/1.1\r\n\r\n"), (None, "n", "only null"), (None, "n", "<p>x</p>"), (73, "d", "<p>x</p>"), (73, "d", "<p>x</p>")]
    + [(80, "long", "abc " * 300_000)]
)


def got(df):
    columns = ("key", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_archives_equal_brute_force(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumnsRenamed({}).selectExpr("*", "'x' AS digest", "1 AS size", "2 AS archive")
    for least in (0, 50):
        for size in (1 << 14, 16 << 20):
            archives = durable(write_archives(pages.repartition(3), min_revisit_bytes=least, archive_bytes=size))
            assert got(read_archives(archives)) == brute(ROWS, least)
            assert all(bytes(r.data[:4]) == struct.pack("<I", SKIPPABLE) for r in archives.collect())


def test_payloads_and_files_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    archives = durable(write_archives(pages))
    export_archives(archives, str(tmp_path / "out")).collect()
    read = read_archives(read_archive_files(spark, str(tmp_path / "out")))
    bodies = {bytes(r.payload).decode() for r in read.collect() if r.payload is not None}
    assert bodies == {html or "" for _, _, html in ROWS}


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_archives(durable(write_archives(pages))).count() == 0
