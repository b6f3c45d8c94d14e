"""Archives: written and read back, with magic in payloads and splits smaller than records."""

import base64
import hashlib
import random

import pytest

from plumbline.llm import warc

SCHEMA = "page_id long, url string, html string"
INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def expected(rows, least=0):
    payload = lambda r: (r[2] or "").encode()
    first = {}
    for r in rows:
        if r[0] is not None:
            first[payload(r)] = min(first.get(payload(r), r[0]), r[0])
    out = []
    for r in rows:
        p, leader = payload(r), first.get(payload(r))
        revisit = len(p) >= least and leader is not None and r[0] != leader and sum(payload(x) == p for x in rows) > 1
        out.append((r[0], len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", leader if revisit else None))
    return sorted(out, key=repr)


def read(df, least=0):
    return sorted((tuple(r) for r in warc.round_trip(df, least).collect()), key=repr)


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_magic_in_payloads_and_records_over_splits(spark, small_splits):
    pick = random.Random(1)
    payloads = ["a", "é" * 10, "", None, INNER, INNER * 3 + "WARC/1.", "WARC/1.WARC/1.1\r\n", "\r\n\r\n" + INNER * 20, "x" * 5000, "\r\n\r\n"]
    rows = [(i, f"http://x/{i}", pick.choice(payloads)) for i in range(120)] + [(None, None, "z"), (None, "u v\n", "zz"), (5, "q", "dup"), (5, "q", "dup")]
    # url, page_id and html besides columns that the operator makes itself
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as digest", "1 as bytes", "2 as first", "3 as place")
    assert read(df) == expected(rows)


def test_short_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    assert read(spark.createDataFrame(rows, SCHEMA), 3) == expected(rows, 3)


def test_magic_in_urls(spark, small_splits):
    urls = ["http://x/WARC/1.1/b", "WARC/1.", "http://x/?WARC/1.WARC/1.0\r\nContent-Length: 3\r\n\r\n", "http://x/WARC/2.0", "WARC/1%2E"]
    rows = [(i, urls[i % 5], f"page {i // 3}" + "WARC/1.0" * (i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert read(df) == expected(rows)
    assert warc.records(df).filter(warc.F.substring_index("value", "HTTP/1.1", 1).contains("WARC/1.1/b")).isEmpty()


def test_empty_table(spark):
    assert read(spark.createDataFrame([], SCHEMA)) == []


def test_a_torn_archive_is_refused(spark, tmp_path):
    whole = INNER.replace("Content-Length: 5", "Content-Length: 50")
    (tmp_path / "a.txt").write_bytes(whole.encode())
    with pytest.raises(ValueError, match="do not lead to its end"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_foreign_archive_with_version_1_0(spark, tmp_path):
    record = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:3>\r\nContent-Length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
    (tmp_path / "a.txt").write_bytes((record * 2).encode())
    assert [tuple(r)[:2] for r in warc.read_archives(spark, str(tmp_path)).collect()] == [(3, 4)] * 2
