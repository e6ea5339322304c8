"""WARC archives with revisit records: writing, reading back, and resolving revisits.

Payloads are never shuffled to find copies: only heads (id, digest, size) are, by payload digest. Records are texts, so
Spark's text writer lays them out as archives, one gzip stream a file, and its readers bring the files back; a record
is cut out by its Content-Length alone, whatever its payload holds.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrolake.llm.common import written

RECORDS_PER_FILE = 4000
SENT_ROWS = 1_000_000
CRLF = "\r\n"
# Names of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD = (
    "record_type string, record_id string, refers_to_id string, page_id bigint, uri string, payload_digest string, "
    "payload_bytes bigint, payload string"
)


def payload_digest(payload: Column) -> Column:
    """The SHA-1 of a text in UTF-8 as bare upper-case base32: ten hex digits are eight base32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def record_id(page_id: Column, digest: Column) -> Column:
    """A name for a record: the same page and payload get the same one in every run."""
    mixed = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    cut = [F.substring(mixed, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def revisits(heads: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_digest, refers_to): the heads (page_id, payload_digest, payload_bytes) that repeat a payload.

    Of heads with equal payloads of at least `least_bytes`, the smallest page_id is the original; a null one is so only
    if there is no other. Rows equal in id and payload are one page.
    """
    large = heads.where(F.col("payload_bytes") >= least_bytes)
    first = large.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies"))
    again = large.join(first.where("copies > 1"), "payload_digest").where("refers_to is not null and not page_id <=> refers_to")
    return again.select("page_id", "payload_digest", "refers_to").distinct()


def _line(name: str, value: Column) -> Column:
    """A header line; none if there is no value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record for each row of `pages` (page_id, uri, payload) below `path`, a repeated payload as a revisit.

    A null payload is an empty one. `date` is the records' date.
    """
    spark = pages.sparkSession
    full = pages.select(
        "page_id",
        F.regexp_replace("uri", r"[\x00-\x20\x7f]", "%20").alias("uri"),
        F.coalesce("payload", F.lit("")).alias("payload"),
    ).withColumn("payload_digest", payload_digest(F.col("payload")))
    heads = written(full.select("page_id", "payload_digest", F.octet_length("payload").cast("bigint").alias("payload_bytes")), "heads")
    again = written(revisits(heads, least_bytes), "revisits")
    again = again.select(F.col("page_id").alias("id"), F.col("payload_digest").alias("digest"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("payload_digest") == F.col("digest"))
    # Few revisits go to every task; many are joined by shuffle.
    rows = full.join(F.broadcast(again) if again.count() <= SENT_ROWS else again, same, "left")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(CRLF * 2),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    header = F.concat(
        F.lit(VERSION + CRLF),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, record_id(F.col("refers_to"), F.col("payload_digest")))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(CRLF * 2),
    )
    records = rows.withColumn("block", block).select(F.concat(header, "block").alias("value"))
    writer = records.write.option("lineSep", CRLF * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def records_of(content: bytes) -> Iterator[dict]:
    """The records of one archive, gzipped or not, read in turn."""
    stream = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 16)
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"a record begins with {version[:40]!r}")
        fields = {}
        while line := stream.readline().strip():
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("an archive ends inside a record")
        if fields.get("warc-type") in ("response", "revisit"):
            yield {"fields": fields, "payload": block.partition(b"\r\n\r\n")[2]}


def _row(record: dict) -> tuple:
    fields, payload = record["fields"], record["payload"]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    response = fields["warc-type"] == "response"
    if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"{fields.get('warc-record-id')}: the payload does not have its digest")
    page = fields.get("warc-page-id")
    names = (fields["warc-type"], fields.get("warc-record-id"), fields.get("warc-refers-to"))
    head = (*names, None if page is None else int(page), fields.get("warc-target-uri"), digest)
    return (*head, len(payload), payload.decode()) if response else (*head, None, None)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The response and revisit records below `path`; payloads are checked against their digests, then left out if not
    asked for. A file is read by one task, so writers keep files small."""
    schema = pa.schema(
        [(n, pa.int64() if t == "bigint" else pa.string()) for n, t in (x.split() for x in RECORD.split(", "))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for record in records_of(content.as_py()):
                    row = _row(record)
                    rows.append(row if payloads else (*row[:-1], None))
                    size += len(record["payload"]) * payloads + 200
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where("length > 0").select("content").mapInArrow(run, RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """`records` with refers_to and payload_bytes of each revisit, from the response that has its payload digest.

    The smallest page_id answers where several responses have the digest. A revisit without its original keeps nulls.
    """
    heads = records.drop("payload")
    responses = heads.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("bigint"))
    originals = responses.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes"))
    again = heads.where("record_type = 'revisit'").drop("payload_bytes")
    return responses.unionByName(again.join(originals, "payload_digest", "left"))


def rewrite(spark: SparkSession, source: str, target: str, least_bytes: int = 0) -> None:
    """Read the archives below `source`, give every revisit its original's payload again, and write them deduplicated,
    with fresh headers, below `target`. Revisits without their original have nothing to write and are left out."""
    records = written(read_archives(spark, source), "records")
    responses = records.where("record_type = 'response'").select("page_id", "uri", "payload")
    payload = records.where("record_type = 'response'").groupBy("payload_digest").agg(F.min("payload").alias("payload"))
    again = records.where("record_type = 'revisit'").select("page_id", "uri", "payload_digest").join(payload, "payload_digest")
    write_archives(responses.unionByName(again.select("page_id", "uri", "payload")), target, least_bytes)
