import base64
import gzip
import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from llm_tables import CLASHING
from tickwell.llm import warc

PAGES = "page_id long, url string, html string"
DATE = "2024-01-01T00:00:00Z"
TRAP = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nab\r\n\r\n"
GIVEN = [
    (7, "http://a/1", "<p>one</p>"),
    (3, "http://a/2", "<p>one</p>"),
    (5, "http://a/3", "<p>one</p>"),
    (3, "http://a/2", "<p>one</p>"),
    (1, "http://b/\r\nX: y z\t", "<p>straße 日本</p>"),
    (2, None, None),
    (4, "", ""),
    (None, "http://c", "<p>straße 日本</p>"),
    (None, "http://d", "lone"),
    (None, "http://d", "lone"),
    (8, "http://e", TRAP),
    (9, "http://e", TRAP + "\r\n"),
    (10, "http://f", "\r\n\r\n"),
    (11, "http://g", "long " * 2000),
    (12, "http://g", "\x00\x1f\x8b"),
    (12, "http://g", "another page of twelve"),
]


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, min_bytes=0):
    out, first = [], {}
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = html or ""
        size = len(body.encode())
        if size >= min_bytes and body in first:
            out.append((page, size, sha1(body), "revisit", first[body]))
        else:
            first.setdefault(body, page)
            out.append((page, size, sha1(body), "response", None))
    return sorted(out, key=str)


def resolved(spark, folder):
    rows = warc.resolve_revisits(warc.read_archive(spark, folder, payloads=False))
    return sorted(map(tuple, rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def pages(spark, rows=GIVEN):
    df = spark.createDataFrame(rows, PAGES)
    return df.withColumns({c: F.lit(f"own {c}") for c in (*CLASHING, "row", "sha", "payload_bytes", "class", "value", "record_type")})


@pytest.mark.parametrize(("min_bytes", "compression", "broadcast_rows"), [(0, "gzip", 100), (0, "none", 0), (11, "gzip", 0)])
def test_pages_come_back(spark, scratch, min_bytes, compression, broadcast_rows):
    folder = f"{scratch}/archive"
    warc.write_archive(pages(spark).repartition(3), folder, DATE, min_bytes, compression, broadcast_rows)
    assert resolved(spark, folder) == brute(GIVEN, min_bytes)
    records = warc.read_archive(spark, folder).collect()
    assert len({r.record_id for r in records}) == len(records) == len(GIVEN)
    assert all(uuid.UUID(r.record_id[1:-1]) and r.date == DATE for r in records)
    payloads = {bytes(r.payload).decode() for r in records if r.record_type == "response"}
    assert payloads == {html or "" for *_, html in GIVEN}
    assert all(r.payload_digest == r.found_digest and r.refers_to is None for r in records if r.record_type == "response")
    assert all(r.payload_bytes == 0 for r in records if r.record_type == "revisit")
    assert {r.target_uri for r in records} == {"http://b/%0D%0AX:%20y%20z%09"} | {u for _, u, _ in GIVEN if "\r" not in (u or "")}


def test_sizes_go_to_files_of_their_own(spark, scratch, monkeypatch):
    """A file has no more records than its class allows, and every record is in one."""
    monkeypatch.setattr(warc, "CLASSES", [(1100, 2), (1200, 1)])
    rows = GIVEN + [(100 + i, "http://h", f"page {i} " + "x" * (60 * (i % 4))) for i in range(20)] + [(200 + i, "http://" + "u" * (40 * (i % 3)), "same") for i in range(9)]
    warc.write_archive(pages(spark, rows).coalesce(1), f"{scratch}/a", DATE)
    assert resolved(spark, f"{scratch}/a") == brute(rows)
    files = spark.read.format("binaryFile").load(f"{scratch}/a").collect()
    sizes = [[len(p) for _, p in warc.records_of(bytes(f.content))] for f in files]
    assert max(map(len, sizes)) == 2 and any(s == [10000] for s in sizes)


def test_files_are_plain_warc(spark, scratch):
    warc.write_archive(pages(spark, GIVEN[:3]).coalesce(1), f"{scratch}/a", DATE, compression="none")
    texts = [bytes(r.content) for r in spark.read.format("binaryFile").load(f"{scratch}/a").collect()]
    one = next(t for t in texts if b"WARC-Type: response" in t)
    head, http, body = one.removesuffix(b"\r\n\r\n").split(b"\r\n\r\n")
    assert body == b"<p>one</p>" and head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    length = int(next(line for line in head.split(b"\r\n") if line.startswith(b"Content-Length")).split()[1])
    assert length == len(http) + 4 + len(body) and http.startswith(b"HTTP/1.1 200 OK")


def test_foreign_archive(spark, scratch):
    """A gzip member per record, other types of record, headers in other case, a revisit of nothing."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\ninfo\r\n\r\n"
    lost = b"WARC/1.0\r\nwarc-type: revisit\r\nWARC-Refers-To: <x>\r\nWARC-Payload-Digest: sha1:ABC\r\ncontent-length: 0\r\n\r\n\r\n\r\n"
    with open(f"{scratch}/a.warc.gz", "wb") as out:
        out.write(gzip.compress(info) + gzip.compress(lost))
    found = warc.read_archive(spark, scratch).collect()
    assert [(r.record_type, r.payload_bytes) for r in found] == [("warcinfo", 4), ("revisit", 0)]
    assert resolved(spark, scratch) == [(None, None, "ABC", "revisit", None)]


def test_truncated_files_are_told():
    whole = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort"
    with pytest.raises(ValueError, match="ends early"):
        list(warc.records_of(whole))
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc.records_of(b"something else"))


def test_no_rows(spark, scratch):
    warc.write_archive(pages(spark, []), f"{scratch}/none", DATE)
    assert resolved(spark, f"{scratch}/none") == []
