"""WARC archives of pages: writing transactions of three records, reading them back, and joining them into captures."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import Run, map_rows

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
#: A file ends once it holds so many compressed bytes, so it is no longer than that and one record.
FILE_BYTES = 1 << 24
#: A gzip member without data. Its last byte is 0, as that of any member of less than 16 MiB is.
EMPTY = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00" + bytes(8)
RECORD = "record_id string, type string, concurrent_to string, refers_to string, target_uri string, payload_digest string, payload_bytes long, fields map<string,string>, payload binary"


def _base32(hexadecimal: Column) -> Column:
    """RFC 4648 base32 of 40 hexadecimal digits: five of them are four letters."""
    groups = [F.lpad(F.conv(F.substring(hexadecimal, i + 1, 5), 16, 32), 4, "0") for i in range(0, 40, 5)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(of: Column) -> Column:
    h = F.md5(of)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _record(kind: str | Column, identity: Column, headers: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind), F.concat(F.lit("WARC-Record-ID: "), identity), F.lit(f"WARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]  # concat_ws leaves out headers without a value
    lines += [F.lit(f"Content-Type: {content_type}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block)


def write(pages: DataFrame, path: str, least: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Writes a request, a response or revisit, and a metadata record of every page into gzipped WARC 1.1 files.

    Of pages with equal payloads (by SHA-1 and length) of at least least bytes, the one with the smallest page_id is
    the response and the others revisit it; pages with that same page_id and payload are responses too. A null page_id
    counts as larger than any; a null html is empty, a null url an empty target. The digests of repeated payloads are
    counted before they meet their pages, so a payload that a third of the pages share stays spread: only groups of
    two pages or more are joined, and Spark splits that join's large partitions.

    A revisit names its response by WARC-Refers-To, its target and its date; where several rows are equally the first,
    by target and date only. Each record is a gzip member of its own, so a reader may start at any record. Files are
    written by Spark's text writer, a file to a row, so they are committed and survive lost executors as any table does;
    files are bounded in bytes, by file_bytes.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.regexp_replace(F.col("url").cast("string"), r"[\x00-\x20]", "%20"), F.lit("")).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"), F.octet_length(html).alias("size"))
    order = F.coalesce(F.col("page_id"), F.lit((1 << 63) - 1))
    kinds = rows.where(F.col("size") >= least).groupBy("sha1", "size", order.alias("order")).agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("url"))
    shared = kinds.groupBy("sha1", "size").agg(F.sum("n").alias("n"), F.min(F.struct("order", F.col("n").alias("rows"), "url")).alias("first")).where("n > 1").drop("n")
    rows = rows.join(shared, ["sha1", "size"], "left")
    revisit = F.coalesce(F.col("first.order") < order, F.lit(False))
    row = F.concat_ws("/", F.col("row").cast("string"), F.col("page_id").cast("string"), "sha1")
    told = lambda page: _uuid(F.concat_ws("/", F.lit("first"), page.cast("string"), "sha1", F.col("size").cast("string")))
    only = F.coalesce(F.col("first.rows") == 1, F.lit(False))
    capture = F.when(only & (F.col("first.order") == order), told(order)).otherwise(_uuid(F.concat(F.lit("capture/"), row)))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).select("*", capture.alias("capture"), revisit.alias("revisit"), F.concat(F.lit("sha1:"), _base32("sha1")).alias("digest"))

    status = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF * 2))
    block = F.when(F.col("revisit"), status).otherwise(F.concat(status, F.col("html")))
    host, target = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1), F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^#]*)", 1)
    request = F.concat(F.lit("GET "), F.when(target == "", F.lit("/")).otherwise(target), F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF * 2))
    notes = F.concat_ws(CRLF, F.concat(F.lit("page-id: "), F.col("page_id").cast("string")), F.concat(F.lit("payload-bytes: "), F.col("size").cast("string")), F.when(F.col("revisit"), F.concat(F.lit("refers-to-page: "), F.col("first.order").cast("string"))), F.lit(""))
    profile = F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    refers = [("WARC-Refers-To", F.when(F.col("revisit") & only, told(F.col("first.order")))), ("WARC-Refers-To-Target-URI", F.when(F.col("revisit"), F.col("first.url"))), ("WARC-Refers-To-Date", F.when(F.col("revisit"), F.lit(DATE)))]
    uri, concurrent = ("WARC-Target-URI", F.col("url")), ("WARC-Concurrent-To", F.col("capture"))
    records = F.array(
        _record("request", _uuid(F.concat(F.lit("request/"), row)), [uri, concurrent], "application/http;msgtype=request", request),
        _record(F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")), F.col("capture"), [uri, ("WARC-Payload-Digest", F.col("digest")), ("WARC-Profile", profile), *refers], "application/http;msgtype=response", block),
        _record("metadata", _uuid(F.concat(F.lit("metadata/"), row)), [uri, concurrent], "application/warc-fields", notes),
    )
    files = map_rows(rows.select(F.explode(records).alias("value")), lambda batches: _bundled(batches, file_bytes), "value binary")
    # the writer ends a row by lineSep, here the 0 that ends a member, so the file is the members and nothing else
    files.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\x00").option("compression", "none").option("maxRecordsPerFile", 1).text(path)


def _bundled(batches: Iterator[pa.RecordBatch], file_bytes: int = FILE_BYTES) -> Iterator[pa.RecordBatch]:
    """Records as gzip members, joined into files of file_bytes or one record more, without their last byte."""
    held: list[bytes] = []
    size = 0

    def file() -> pa.RecordBatch:
        whole = b"".join(held if held[-1][-1] == 0 else [*held, EMPTY])
        return pa.RecordBatch.from_arrays([pa.array([whole[:-1]], pa.binary())], names=["value"])

    for batch in batches:
        for value in batch.column(0):
            press = zlib.compressobj(6, zlib.DEFLATED, 31)
            held.append(press.compress(value.as_py().encode()) + press.compress(b"\r\n\r\n") + press.flush())
            size += len(held[-1])
            if size >= file_bytes:
                yield file()
                held, size = [], 0
    if held:
        yield file()


def _pieces(archive: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """An archive's bytes in pieces of 1 MiB at most, decompressed member by member where it is gzipped."""
    if archive[:2] != b"\x1f\x8b":
        yield from (archive[at : at + step] for at in range(0, len(archive), step))
        return
    at, member = 0, None
    while at < len(archive):
        member = member or zlib.decompressobj(31)
        rest = archive[at : at + step]
        at += len(rest)
        while rest and not member.eof:
            yield member.decompress(rest, 1 << 20)
            rest = member.unconsumed_tail
        while at >= len(archive) and not member.eof and (more := member.decompress(b"", 1 << 20)):
            yield more
        if member.eof:
            at -= len(member.unused_data)
            member = None
    if member is not None:
        raise ValueError("a member is cut off")


def records_of(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, gzipped (a member to a record, or otherwise) or not: headers by lower-case name, and
    the block. Only one record is held decompressed at a time."""
    held, headers, begins, ends = bytearray(), None, 0, 0
    for piece in _pieces(archive):
        held += piece
        while held:
            if headers is None:
                if not b"WARC/".startswith(held[:5]):
                    raise ValueError("no record where one should begin")
                found = held.find(b"\r\n\r\n")
                if found < 0:
                    break
                lines = held[:found].decode().split(CRLF)[1:]
                headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
                begins, ends = found + 4, found + 4 + int(headers["content-length"])
            if len(held) < ends + 4:
                break
            yield headers, bytes(held[begins:ends])
            del held[: ends + 4]
            headers = None
    if held:
        raise ValueError("a record is cut off")


def read(spark, path: str, payload: bool = True) -> DataFrame:
    """One row per record of all archives under path; payload=False leaves payloads out once their digest is known.

    payload_digest (bare upper-case base32 SHA-1) and payload_bytes are those of the payload as read; a digest header
    that differs raises. A revisit has no payload: its digest and payload_bytes are those its headers tell.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                held = 0
                for headers, block in records_of(content.as_py()):
                    kind, digest, size, body, fields = headers["warc-type"], None, None, None, []
                    if kind in ("response", "revisit", "request") and headers.get("content-type", "").startswith("application/http"):
                        head, _, body = block.partition(b"\r\n\r\n")
                        fields = [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split(CRLF)[1:])]
                    elif headers.get("content-type") == "application/warc-fields":
                        fields = [(k.strip().lower(), v.strip()) for k, c, v in (x.partition(":") for x in block.decode("utf-8", "replace").split(CRLF)) if c]
                    told = headers.get("warc-payload-digest", "").partition(":")[2] or None
                    if kind == "response" and body is not None:
                        digest, size = base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)
                        if told and told != digest:
                            raise ValueError(f"{headers['warc-record-id']}: the payload's digest differs")
                    elif kind == "revisit":
                        digest, body = told, None
                        size = int(dict(fields).get("content-length", 0))
                    keep = body if payload and kind == "response" else None
                    rows.append((headers["warc-record-id"], kind, headers.get("warc-concurrent-to"), headers.get("warc-refers-to"), headers.get("warc-target-uri"), digest, size, list(dict(fields).items()), keep))
                    held += len(keep or b"")
                    if len(rows) >= 4096 or held > 1 << 25:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{gz,warc,txt}").load(path)
    return map_rows(files.select("content"), parse, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response (or revisit), requests and metadata, joined by concurrent-to.

    A record's capture is what it is concurrent to, else itself; all of a capture's records meet in one shuffle. A
    capture whose response is missing has a null response; repeated records of one id are kept in the lists.
    """
    kind = F.col("type")
    main = F.struct("record_id", "type", "refers_to", "target_uri", "payload_digest", "payload_bytes", "fields", "payload")
    other = F.struct("record_id", "target_uri", "fields")
    return records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        F.first(F.when(kind.isin("response", "revisit"), main), ignorenulls=True).alias("response"),
        F.collect_list(F.when(kind == "request", other)).alias("requests"),
        F.collect_list(F.when(kind == "metadata", other)).alias("metadata"),
    )


def op6_transaction_assembly(pages: DataFrame, least: int = 0) -> DataFrame:
    """The contract's digest of every page's capture, as assembled from the archives."""
    run = Run(pages.sparkSession, "warc")
    write(pages, f"{run.path}/archives", least)
    notes = lambda name: F.col("metadata")[0]["fields"][name].cast("long")
    found = captures(read(pages.sparkSession, f"{run.path}/archives", payload=False))
    return found.select(
        notes("page-id").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        notes("refers-to-page").alias("refers_to"),
    )


#: The digest of op6_transaction_assembly for pages with distinct ids: base32 of SHA-1, five hexadecimal digits at a time.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS n, sha1(h) AS x FROM p),
b AS (SELECT *, min(page_id) OVER (PARTITION BY x, n) AS first, array_to_string(list_transform(range(1, 41, 5), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(x, i, 5))::BIGINT >> s) % 32 + 1, 1)), '')), '') AS digest FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM b"""
