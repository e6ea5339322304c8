"""Archives against a plain account of their records, and the SQL check."""

import base64
import gzip
import hashlib

import duckdb

from cirrolake.llm import warc
from cirrolake.llm.queries import ORACLE, op6_warc

SCHEMA = "page_id bigint, uri string, payload string, record_type int, refers_to string"


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def plain(rows, least):
    found = []
    for i, _, text in rows:
        text = text or ""
        ids = [j for j, _, t in rows if (t or "") == text and j is not None]
        first = min(ids, default=None)
        again = len(text.encode()) >= least and first is not None and i != first
        found.append((i, len(text.encode()), digest(text), "revisit" if again else "response", first if again else None))
    return sorted(found, key=str)


ROWS = [
    (5, "http://a/1", "same <p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (2, "http://a/2", "same <p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (9, "http://a/ b\r\n", "é漢🙂"), (10, None, "é漢🙂"), (1, "http://e", None), (3, "http://f", ""), (4, "http://g", "x" * 300_000),
    (None, "http://h", "é漢🙂"), (None, "http://i", "alone"), (7, "http://j", "twice"), (7, "http://j", "twice"), (8, "http://k", "\n"),
]


def test_written_and_read_back(spark, path):
    df = spark.createDataFrame([(*r, 0, "x") for r in ROWS], SCHEMA)
    for least in (0, 6):
        place = path(f"least{least}")
        warc.write_archives(df, place, least)
        records = warc.read_archives(spark, place)
        got = warc.resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted(map(tuple, got), key=str) == plain(ROWS, least)
        texts = {(r.page_id, r.payload) for r in records.where("record_type = 'response'").collect()}
        assert (4, "x" * 300_000) in texts and (2, ROWS[1][2]) in texts and (1, "") in texts
        files = spark.read.format("binaryFile").load(place).where("length > 0").collect()
        assert all(gzip.decompress(f.content).startswith(b"WARC/1.1\r\n") for f in files)


def test_rewritten_archives_say_the_same(spark, path):
    df = spark.createDataFrame([(*r, 0, "x") for r in ROWS], SCHEMA)
    warc.write_archives(df, path("a"), 10**9)
    warc.rewrite(spark, path("a"), path("b"))
    warc.rewrite(spark, path("b"), path("c"))
    for place in ("b", "c"):
        got = warc.resolved(warc.read_archives(spark, path(place))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert sorted(map(tuple, got.collect()), key=str) == plain(ROWS, 0)


def test_no_rows(spark, path):
    warc.write_archives(spark.createDataFrame([], SCHEMA), path("none"))
    assert warc.resolved(warc.read_archives(spark, path("none"))).collect() == []


def test_query_and_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    expected = con.sql(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({ORACLE['op6_warc']})").fetchall()
    assert sorted(map(tuple, op6_warc(spark, sf).collect())) == sorted(expected)
