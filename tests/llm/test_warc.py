"""Archives: exact round trip, rows equal to SQL, damage is noticed, odd inputs."""

import gzip
import hashlib
from pathlib import Path

import pytest

from oracle import connect, differences
from pyspark.sql import functions as F

from stratalake.llm import warc
from stratalake.llm.registry import op6_warc

SF = "/root/testdata/sf0.01"


def test_query_gives_the_rows_of_its_sql(spark):
    assert differences(op6_warc(spark, SF), connect(SF), warc.SQL) == []


LONG = "<p>é WARC/1.0\r\nContent-Length: 5\r\n\r\n\n\n" * 9000
ROWS = [
    (1, "http://a/", LONG),
    (2, "http://b/ x\ty\r\nX-Page-ID: 7", "x" * 1000),
    (3, None, "x" * 1000),
    (3, None, "x" * 1000),
    (4, "http://c/", "x" * 999),
    (5, "http://c/", "x" * 999),
    (6, "", None),
    (7, "u", ""),
    (None, "u", "y\n" * 2000),
    (None, "u", "y\n" * 2000),
    (8, "u", "\r\n\r\n"),
    (9, "u", LONG),
    (10, "é", "é" * 70_000),
    (11, "u", "z" * 65_536),
    (12, "u", "z" * 65_536 + "\n"),
]


@pytest.fixture
def pages(spark, tmp_path):
    frame = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    frame = frame.selectExpr("*", "1 AS chunks", "2 AS record_type", "3 AS `file`")
    frame.repartition(3).write.parquet(str(tmp_path / "pages"))
    return spark.read.parquet(str(tmp_path / "pages"))


def _expected():
    out = []
    newest = {}
    for page_id, _, html in ROWS:
        newest.setdefault(html or "", []).append(-1 if page_id is None else page_id)
    for html, ids in newest.items():
        data = html.encode()
        digest = hashlib.sha1(data).hexdigest()
        ids = sorted(ids)
        for at, page_id in enumerate(ids):
            revisit = len(data) >= 1000 and at < len(ids) - 1
            shown, last = (None if i == -1 else i for i in (page_id, ids[-1]))
            out.append((shown, len(data), digest, "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk_bytes", [100, 64 * 1024])
def test_odd_rows(pages, chunk_bytes):
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = [tuple(r) for r in warc.round_trip(pages, chunk_bytes).select(cols).collect()]
    assert sorted(got, key=str) == _expected()


def test_chunks_joined_are_the_payload(spark, pages, tmp_path):
    warc.write_archive(pages, str(tmp_path / "out"), 1000)
    for size in (300, 1000, 10**9):
        chunks = warc.read_archive(spark, str(tmp_path / "out"), size).collect()
        payloads = {}
        for c in sorted(chunks, key=lambda c: (c.record_id, c.chunk_no)):
            assert len(c.data) <= size and c.chunk_no == len(payloads.setdefault(c.record_id, []))
            payloads[c.record_id].append(bytes(c.data))
            so_far = b"".join(payloads[c.record_id])
            assert c.bytes_so_far == len(so_far)
            if c.record_type == "response":
                assert c.digest_so_far == hashlib.sha1(so_far).hexdigest()
        responses = {c.record_id: c.page_id for c in chunks if c.record_type == "response"}
        by_page = {responses[r]: b"".join(p) for r, p in payloads.items() if r in responses}
        html = {page_id: (text or "").encode() for page_id, _, text in ROWS}
        assert all(html[page_id] == data for page_id, data in by_page.items())
        assert {1, 2} & set(by_page) == set()  # 9 and 3 hold their payloads


def test_records_are_plain_warc(pages, tmp_path):
    warc.write_archive(pages, str(tmp_path / "out"), 1000)
    kinds = []
    for path in Path(tmp_path / "out").glob("*.gz"):
        data = gzip.decompress(path.read_bytes())
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            assert lines[0] == "WARC/1.0" and fields["WARC-Record-ID"].startswith("<urn:uuid:")
            length = int(fields["Content-Length"])
            assert data[length : length + 4] == b"\r\n\r\n"
            data = data[length + 4 :]
            kinds.append(fields["WARC-Type"])
    assert kinds.count("response") + kinds.count("revisit") == len(ROWS)
    assert "continuation" in kinds


def test_damage_is_noticed(spark, pages, tmp_path):
    warc.write_archive(pages, str(tmp_path / "out"), 1000)
    for path in Path(tmp_path / "out").glob("*.gz"):
        data = gzip.decompress(path.read_bytes())
        (tmp_path / "bad").mkdir(exist_ok=True)
        (tmp_path / "bad" / path.name).write_bytes(gzip.compress(data.replace(b"zzzz", b"zzzy")))
    with pytest.raises(Exception, match="damaged segment|another digest"):
        warc.read_archive(spark, str(tmp_path / "bad")).collect()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "p"))
    assert warc.round_trip(spark.read.parquet(str(tmp_path / "p"))).collect() == []


def test_an_oversized_payload_is_cut_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "_HANDED_ON", 1 << 20)
    long = "".join(f"é{i}" for i in range(1_500_000))
    rows = [(1, "http://a/", long), (2, "http://a/", "small"), (3, "http://a/", long), (4, None, long + "!")]
    path = str(tmp_path / "pages")
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(path)
    pages = spark.read.parquet(path)
    chunks = warc.payload_chunks(pages, ("page_id",))
    sizes = {}
    for r in chunks.select("page_id", "chunk_no", F.length("content").alias("n"), "length", "last").collect():
        assert r.n == r.length <= warc.CHUNK_BYTES
        sizes[r.page_id] = sizes.get(r.page_id, 0) + r.n
    assert sizes == {i: len(h.encode()) for i, _, h in rows}
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    for i, _, html in rows:
        data = html.encode()
        assert got[i].payload_bytes == len(data) and got[i].payload_digest == hashlib.sha1(data).hexdigest()
    assert [got[i].record_type for i in (1, 2, 3, 4)] == ["revisit", "response", "response", "response"]
    assert got[1].refers_to == 3
