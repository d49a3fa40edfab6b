import hashlib

import pytest
from pyspark.sql import functions as F

from linecheck.llm import warc

PAGES = "page_id long, url string, html string, digest string, payload string"


def pages(spark):
    long, other = "<p>é</p>" * 20, "x" * 100
    rows = [
        (5, "http://a/5", long),
        (3, "http://a/3", long),
        (9, None, long),
        (3, "http://a/3", long),
        (None, "http://a/none", long),
        (1, "http://a/1\r\nWARC-Type: revisit", other),
        (2, "http://a/2", "x" * 99),
        (4, "http://a/4", "x" * 99),
        (6, "http://a/6", None),
        (7, "http://a/7", ""),
        (None, "http://b", "y" * 500),
        (8, "http://a/8", other),
    ]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)


def test_records_are_restored(spark):
    source = pages(spark)
    archive = warc.write(source)
    assert archive.payloads.count() == source.select(F.coalesce("html", F.lit(""))).distinct().count()
    found = warc.records(archive).collect()
    assert len(found) == source.count()
    long = ("<p>é</p>" * 20).encode()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in found if bytes(r.payload) == long)
    assert kinds == [
        (0, "revisit", 3),
        (3, "response", None),
        (3, "response", None),
        (5, "revisit", 3),
        (9, "revisit", 3),
    ]
    by_page = {r.page_id: r for r in found}
    assert (by_page[8].record_type, by_page[8].refers_to) == ("revisit", 1)
    assert {by_page[i].record_type for i in (1, 2, 4, 6, 7)} == {"response"}
    assert by_page[9].url is None
    for r in found:
        assert r.payload_digest == hashlib.sha256(r.payload).hexdigest()
        block = bytes(r.payload) if r.record_type == "response" else b""
        assert bytes(r.record) == bytes(r.header) + block + b"\r\n\r\n"
        assert f"Content-Length: {len(block)}\r\n".encode() in bytes(r.header)
        assert bytes(r.header).startswith(b"WARC/1.1\r\n") and bytes(r.header).endswith(b"\r\n\r\n")


def test_a_damaged_payload_is_an_error(spark):
    archive = warc.write(pages(spark))
    damaged = warc.Archive(archive.payloads.withColumn("payload", F.concat("payload", F.lit(b"!"))), archive.headers)
    with pytest.raises(Exception, match="does not match the digest"):
        warc.records(damaged).collect()


def test_no_pages(spark):
    archive = warc.write(pages(spark).limit(0))
    assert warc.records(archive).count() == 0
