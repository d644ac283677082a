"""WARC archives written from pages and read back as a table of chunks.

A payload is never handled as one record: it is rows (record, chunk number) of at most
``CHUNK_BYTES``, each with the digest of the payload up to its end, so the last chunk of a record
carries the digest of the whole. In the archive a long payload is a segmented record: its first
segment and ``continuation`` records that follow it in the same file. Of records with equal payloads
(length and two digests) of at least ``REVISIT_BYTES`` the one with the largest page id is the
response, the others are ``revisit`` records without a payload.

Archives are gzip files written by Spark's text writer, and read by its text reader: a file is read
by one task, line by line and in order. The parser goes by ``Content-Length`` and keeps one chunk
in memory; it checks every digest and raises on an archive that does not hold what it declares.

Defined cases: a NULL html is an empty payload. A NULL url has no target URI; white space and
control characters in one are percent-encoded. A NULL page id is smaller than any other, a revisit
of such a page refers to NULL. Repeated rows are records of their own. An empty table gives an empty
archive and result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import FILE, ROW, settings
from stratalake.session import shared_folder, staged

CHUNK_BYTES = 64 * 1024
REVISIT_BYTES = 1000
_DATE = "2024-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.parquet.compression.codec": "zstd",
}
_HANDED_ON = 4 << 20


def _bounds(size: int, chunk_bytes: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the chunks; an empty payload has one."""
    yield 0, min(size, chunk_bytes)
    for start in range(chunk_bytes, size, chunk_bytes):
        yield start, min(size, start + chunk_bytes)


def payload_chunks(
    pages: DataFrame, keys: tuple[str, ...], html_col: str = "html", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Rows (*keys, chunk_no, start, length, digest, check, last, content): the chunks of a payload,
    each with the digests of the payload up to its end, carried from one to the next.

    A payload is cut once, in the task that reads the page, and handed on a few chunks at a time.
    """
    narrow = pages.select(*keys, pages[html_col].cast("string").cast("binary").alias("__html"))
    types = [(f.name, f.dataType.simpleString()) for f in narrow.schema[:-1]]
    schema = ", ".join(f"`{n}` {t}" for n, t in types) + (
        ", chunk_no int, start bigint, length bigint, digest binary, check binary, last boolean, content binary"
    )
    n_keys = len(keys)
    names = [n for n, _ in types] + ["chunk_no", "start", "length", "digest", "check", "last", "content"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.binary()]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows, held = [], [], 0

            def handed_on(batch=batch) -> pa.RecordBatch:
                columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
                return pa.RecordBatch.from_arrays(
                    [batch[i].take(pa.array(at, pa.int64())) for i in range(n_keys)]
                    + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names,
                )

            for i, value in enumerate(batch[n_keys]):
                payload = memoryview(value.as_buffer() or b"") if value.is_valid else memoryview(b"")
                sha1, second = hashlib.sha1(), hashlib.blake2b(digest_size=16)
                for number, (start, end) in enumerate(_bounds(len(payload), chunk_bytes)):
                    content = bytes(payload[start:end])
                    sha1.update(content)
                    second.update(content)
                    at.append(i)
                    last = end == len(payload)
                    rows.append((number, start, end - start, sha1.digest(), second.digest(), last, content))
                    held += end - start
                    if held > _HANDED_ON:
                        yield handed_on()
                        at, rows, held = [], [], 0
            yield handed_on()

    return narrow.mapInArrow(chunks, schema)


def _record_id(*parts) -> Column:
    """A UUID made of the digest of what tells the record apart."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def with_record_types(chunks: DataFrame) -> DataFrame:
    """Rows (file, row, record_type, refers_to, payload_digest, last_no) of the records behind
    ``chunks``."""
    ends = chunks.where("last").select(
        FILE, ROW, "page_id", (F.col("start") + F.col("length")).alias("size"), "digest", "check", "chunk_no"
    )
    payload = ["size", "digest", "check"]
    place = F.struct("page_id", FILE, ROW)
    originals = (
        ends.where(F.col("size") >= REVISIT_BYTES)
        .groupBy(*payload)
        .agg(F.max(place).alias("original"))
    )
    same = (F.col(f"original.{FILE}") == F.col(FILE)) & (F.col(f"original.{ROW}") == F.col(ROW))
    revisit = F.col("original").isNotNull() & ~same
    return ends.join(originals, payload, "left").select(
        FILE,
        ROW,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, _record_id(f"original.{FILE}", f"original.{ROW}")).alias("refers_to"),
        F.col("digest").alias("payload_digest"),
        F.col("chunk_no").alias("last_no"),
    )


def _line(name: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")


def write_archive(pages: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write a record per row of ``pages`` (page_id, url, html; rows of Parquet files)."""
    meta = pages.metadataColumn("_metadata")
    keyed = pages.select(
        pages["page_id"].cast("bigint").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        pages["html"].cast("string").alias("html"),
        meta.getField("file_path").alias(FILE),
        meta.getField("row_index").alias(ROW),
    )
    with settings(pages.sparkSession, _SETTINGS):
        chunks = staged(
            payload_chunks(keyed, ("page_id", "url", FILE, ROW), chunk_bytes=chunk_bytes), "warc-chunks"
        )
    # The type of a record is joined onto its chunks; of a revisit only the last one is needed.
    typed = chunks.join(with_record_types(chunks), [FILE, ROW]).where("record_type = 'response' OR last")
    segments = typed.withColumn("record_id", _record_id(FILE, ROW)).sortWithinPartitions(FILE, ROW, "chunk_no")
    revisit = F.col("record_type") == "revisit"
    first = revisit | (F.col("chunk_no") == 0)
    segmented = ~revisit & (F.col("last_no") > 0)
    http = F.when(~revisit & first, F.lit(_HTTP)).otherwise("")
    content = F.when(revisit, F.lit(b"")).otherwise(F.col("content"))
    header = F.concat(
        F.lit("WARC/1.0\r\n"),
        _line("WARC-Type", F.when(first, F.col("record_type")).otherwise("continuation")),
        _line("WARC-Record-ID", F.when(first, F.col("record_id")).otherwise(_record_id(FILE, ROW, "chunk_no"))),
        _line("WARC-Date", _DATE),
        _line("WARC-Target-URI", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "[\\s\\p{Cntrl}]", "%20")),
        _line("Content-Type", F.when(~revisit & first, F.lit("application/http;msgtype=response"))),
        _line("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.lower(F.hex("payload_digest"))))),
        _line("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        _line("WARC-Refers-To", F.col("refers_to")),
        _line("WARC-Segment-Number", F.when(segmented, F.col("chunk_no") + 1)),
        _line("WARC-Segment-Origin-ID", F.when(~first, F.col("record_id"))),
        _line("WARC-Segment-Total-Length", F.when(segmented & F.col("last"), F.col("start") + F.col("length"))),
        _line("X-Digest-So-Far", F.when(~revisit, F.lower(F.hex("digest")))),
        _line("X-Page-ID", F.col("page_id")),
        _line("Content-Length", F.length(content) + F.octet_length(http)),
        F.lit("\r\n"),
        http,
    )
    # The writer ends every value with a line feed: the last byte of the record.
    record = F.concat(header.cast("binary"), content, F.lit(b"\r\n\r")).cast("string")
    segments.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", "\n").text(folder)


class _Parser:
    """Turns the lines of an archive file into chunks; holds one chunk at most."""

    def __init__(self, chunk_bytes: int):
        self.chunk_bytes = chunk_bytes
        self.headers: dict[str, str] | None = None
        self.left = 0  # content bytes still to come
        self.skipping = False  # in the HTTP header of a response
        self.record: dict | None = None

    def feed(self, line: bytes) -> Iterator[tuple]:
        while line:
            if self.left:
                part, line = line[: self.left], line[self.left :]
                self.left -= len(part)
                yield from self._content(part)
                if not self.left:
                    yield from self._segment_over()
            elif self.headers is None:
                if line.startswith(b"WARC/"):
                    self.headers = {}
                elif line.strip():
                    raise ValueError(f"not the start of a WARC record: {line[:80]!r}")
                return
            else:
                text = line.rstrip(b"\r\n")
                if text:
                    name, _, value = text.decode("utf-8", "replace").partition(":")
                    self.headers[name.strip().lower()] = value.strip()
                else:
                    yield from self._begin()
                return

    def _begin(self) -> Iterator[tuple]:
        headers = self.headers
        self.left = int(headers["content-length"])
        kind = headers["warc-type"]
        if kind == "continuation":
            record = self.record
            if (
                record is None
                or record["record_id"] != headers["warc-segment-origin-id"]
                or record["segment"] + 1 != int(headers["warc-segment-number"])
            ):
                raise ValueError("a continuation does not follow its record")
            record["segment"] += 1
        else:
            if self.record is not None:
                raise ValueError("a segmented record has no end")
            page = headers.get("x-page-id")
            self.record = {
                "record_id": headers["warc-record-id"],
                "page_id": None if page is None else int(page),
                "kind": kind,
                "uri": headers.get("warc-target-uri"),
                "refers_to": headers.get("warc-refers-to"),
                "declared": headers.get("warc-payload-digest"),
                "segment": 1,
                "sha1": hashlib.sha1(),
                "bytes": 0,
                "chunk_no": 0,
                "held": [],
                "held_bytes": 0,
            }
            self.skipping = headers.get("content-type", "").startswith("application/http")
        if not self.left:
            yield from self._segment_over()

    def _content(self, part: bytes) -> Iterator[tuple]:
        if self.skipping:
            if part in (b"\r\n", b"\n"):
                self.skipping = False
            return
        record = self.record
        while part:
            piece = part[: self.chunk_bytes - record["held_bytes"]]
            part = part[len(piece) :]
            record["held"].append(piece)
            record["held_bytes"] += len(piece)
            record["bytes"] += len(piece)
            record["sha1"].update(piece)
            if record["held_bytes"] == self.chunk_bytes:
                yield self._chunk(last=False)

    def _segment_over(self) -> Iterator[tuple]:
        headers, self.headers, self.skipping = self.headers, None, False
        record = self.record
        so_far = headers.get("x-digest-so-far")
        if so_far and so_far != record["sha1"].hexdigest():
            raise ValueError(f"damaged segment of {record['record_id']}")
        total = headers.get("warc-segment-total-length")
        if "warc-segment-number" in headers and total is None:
            return
        if total is not None and int(total) != record["bytes"]:
            raise ValueError(f"{record['record_id']} lacks segments")
        if record["kind"] == "response" and not _same_digest(record["declared"], record["sha1"]):
            raise ValueError(f"payload of {record['record_id']} has another digest")
        yield self._chunk(last=True)
        self.record = None

    def _chunk(self, last: bool) -> tuple:
        record = self.record
        data = b"".join(record["held"])
        record["held"], record["held_bytes"] = [], 0
        number, record["chunk_no"] = record["chunk_no"], record["chunk_no"] + 1
        digest = record["declared"].partition(":")[2] if record["kind"] == "revisit" else record["sha1"].hexdigest()
        return (
            record["record_id"], number, record["page_id"], record["uri"], record["kind"],
            record["refers_to"], data, record["bytes"], digest, last,
        )

    def close(self) -> None:
        if self.record is not None or self.headers is not None:
            raise ValueError("the archive ends inside a record")


def _same_digest(declared: str | None, sha1) -> bool:
    """``sha1:`` and the digest, in hexadecimal or base 32."""
    if declared is None:
        return True
    value = declared.partition(":")[2]
    return value.lower() == sha1.hexdigest() or value == base64.b32encode(sha1.digest()).decode()


_CHUNK = (
    "record_id string, chunk_no int, page_id bigint, url string, record_type string, "
    "refers_to string, data binary, bytes_so_far bigint, digest_so_far string, last boolean"
)


def read_archive(
    spark: SparkSession, folder: str, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True
) -> DataFrame:
    """The chunks of all records: record_id, chunk_no, page_id, url, record_type, refers_to, data,
    bytes_so_far, digest_so_far, last. Joined in the order of their numbers they are the payload.
    A revisit is one empty chunk with the digest that it declares."""
    lines = spark.read.option("lineSep", "\n").text(folder)
    lines = lines.select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("file"))
    names = [part.split()[0] for part in _CHUNK.split(", ")]
    kinds = [
        pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(),
        pa.int64(), pa.string(), pa.bool_(),
    ]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, current, rows, size = _Parser(chunk_bytes), None, [], 0
        for batch in batches:
            for line, file in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                if file != current:
                    parser.close()
                    parser, current = _Parser(chunk_bytes), file
                for row in parser.feed(line + b"\n"):
                    size += len(row[6]) + 200
                    rows.append(row if with_data else (*row[:6], None, *row[7:]))
                    if size > 4_000_000:
                        yield batch_of(rows)
                        rows, size = [], 0
        parser.close()
        yield batch_of(rows)

    return lines.mapInArrow(parse, _CHUNK)


def archived_records(chunks: DataFrame) -> DataFrame:
    """One row per record of ``read_archive``: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to (the page id of the response)."""
    records = staged(chunks.where("last").drop("data", "chunk_no", "last"), "warc-records")
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("original"),
        F.col("bytes_so_far").alias("original_bytes"),
        F.col("digest_so_far").alias("original_digest"),
    )
    revisit = F.col("record_type") == "revisit"
    return records.join(responses, "refers_to", "left").select(
        "page_id",
        "url",
        F.when(revisit, F.col("original_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("original_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        "record_type",
        F.col("original").alias("refers_to"),
    )


def round_trip(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write ``pages`` to an archive in the shared folder and read its records back."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    write_archive(pages, folder, chunk_bytes)
    with settings(spark, _SETTINGS):
        return archived_records(read_archive(spark, folder, with_data=False))


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest
  FROM pages)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM p
"""
