"""Web archives: pages written as WARC records, equal payloads once, revisits resolved.

A page becomes a ``response`` record with a fresh HTTP header, or, if another record holds
the same payload, a ``revisit`` record that refers to it and has the HTTP header alone.
Which is which follows from headers: one small row per page, grouped by payload digest
without any payload. Responses are what is left of the pages when the rows that revisit are
taken away; revisits are written from their headers. Reading works the other way round:
the records' headers are grouped by payload digest again and each revisit meets the
response it refers to.

Archives are WARC 1.1 files in Spark's shared folder, plain or gzip, written by Spark's own
text writer with the end of a record as its line separator, so nothing but Spark touches
the file system. Payloads are copied byte by byte. Files are read whole by a task and
unpacked as a stream, record by record, by the lengths in the headers; what a payload
contains, WARC headers and blank lines too, does not matter. Archives with a gzip member per
record, as other tools write them, are read too.

Payloads are equal if length, SHA-1 and SHA-256 are; SHA-1 is what the headers name. Pages
that many others repeat, a third of all rows or more, are one row per task before the
shuffle; where each header meets the first of its group, Spark splits the hot key.

Bounds: a file holds as many records as ``CLASSES`` allows for their size, 64 MB of them at
most, or one that is longer; a read task holds packed files and one record unpacked. Rows
that revisit are sent to all tasks if they are ``broadcast_rows`` at most, else both sides
are shuffled.

Edge cases: a null html is an empty payload, an ordinary one. A null page_id comes after all
others and has no Page-Id header. Rows that repeat id and payload are records of their own:
one of them is the response. Control characters and spaces of a url are escaped in the
headers; a null url has no Target-URI. An empty table writes and reads no records. Other
columns are not read.
"""

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.llm.common import stored
from tickwell.sources.files import if_there

#: (bytes of a record up to, records per file); a longer record has a file of its own.
CLASSES = [(1 << 11, 1 << 15), (1 << 16, 1 << 10), (1 << 22, 1 << 4)]
BROADCAST_ROWS = 100_000
#: Fixed values of the format.
VERSION, EOL = "WARC/1.1", "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

RECORD = "record_id string, record_type string, page_id long, target_uri string, date string, payload_digest string, refers_to string, payload binary, payload_bytes long, found_digest string"


def base32(hexadecimal: Column) -> Column:
    """Bare base32 of 20 bytes in hexadecimal."""
    groups = [F.lpad(F.conv(F.substring(hexadecimal, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*groups)), BASE32_HEX, BASE32)


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def _identity() -> list[Column]:
    """What tells payloads apart: digest, payload_bytes, sha."""
    return [base32(F.sha1(_payload())).alias("digest"), F.octet_length(_payload()).cast("long").alias("payload_bytes"), F.unhex(F.sha2(_payload(), 256)).alias("sha")]


KEY = ["digest", "payload_bytes", "sha"]


def headers(pages: DataFrame) -> DataFrame:
    """A row per page without its payload: row, page_id, url, digest, payload_bytes, sha; kept, so ``row`` stays what it is."""
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), *_identity())
    return stored(rows, "headers")


def resolve(heads: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``heads`` with record_type and the first row of each repeated payload: first_id, first_url, first_row, same_rows.

    The first is the smallest page_id, then url, then row; ``same_rows`` rows have its id and url.
    """
    each = heads.where(F.col("payload_bytes") >= min_bytes).groupBy(*KEY, "page_id", "url").agg(F.min("row").alias("row"), F.count("*").alias("n"))
    order = F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url", "row", "n")
    groups = each.groupBy(*KEY).agg(F.min(order).alias("first"), F.sum("n").alias("copies")).where("copies > 1")
    firsts = groups.select(*KEY, F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), F.col("first.row").alias("first_row"), F.col("first.n").alias("same_rows"))
    revisits = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    return heads.join(firsts, KEY, "left").withColumn("record_type", F.when(revisits, "revisit").otherwise("response"))


def _record_id(*told: Column) -> Column:
    """A name for a record that is the same whenever it is worked out again."""
    texts = [F.coalesce(t.cast("string"), F.lit("-")) for t in told]
    h = F.sha2(F.concat_ws("\n", *texts).cast("binary"), 256)
    cut = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("8"), F.substring(h, 13, 3)), F.concat(F.lit("8"), F.substring(h, 17, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _response_id(page_id: str, url: str, min_bytes: int) -> Column:
    """Responses that others may refer to are named by what they are, of which there is one; the rest by chance."""
    named = _record_id(F.hex("sha"), F.col(page_id), F.col(url))
    return F.when(F.col("payload_bytes") >= min_bytes, named).otherwise(F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(EOL)))


def _uri(url: Column) -> Column:
    """A url fit for a header: no control character, no space."""
    escaped = url
    for code in (*range(33), 127):
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), escaped).otherwise(url)


def _record(kind: str, record_id: Column, date: str, more: list[Column], block_bytes: Column) -> Column:
    """A record's headers and the HTTP header its block begins with."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(EOL * 2))
    lines = [
        F.lit(f"{VERSION}{EOL}WARC-Type: {kind}{EOL}"),
        _line("WARC-Record-ID", record_id),
        F.lit(f"WARC-Date: {date}{EOL}"),
        _line("WARC-Target-URI", _uri(F.col("url"))),
        _line("Page-Id", F.col("page_id")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(EOL)),
        F.lit(f"Content-Type: application/http; msgtype=response{EOL}"),
        *more,
        _line("Content-Length", F.octet_length(http) + block_bytes),
    ]
    return F.concat(*lines, F.lit(EOL), http)


def _revisit(date: str, min_bytes: int) -> Column:
    more = [
        F.lit(f"WARC-Profile: {PROFILE}{EOL}WARC-Refers-To-Date: {date}{EOL}"),
        _line("WARC-Refers-To", _response_id("first_id", "first_url", min_bytes)),
        _line("WARC-Refers-To-Target-URI", _uri(F.col("first_url"))),
    ]
    return _record("revisit", _record_id(F.hex("sha"), F.col("page_id"), F.col("url"), F.col("row")), date, more, F.lit(0))


def _response(date: str, min_bytes: int) -> Column:
    head = _record("response", _response_id("page_id", "url", min_bytes), date, [], F.col("payload_bytes"))
    return F.concat(head, F.coalesce(F.col("html"), F.lit("")))


def _class(payload: Column, *urls: Column) -> Column:
    """The class of a record by no fewer bytes than it has: its payload, urls with every byte escaped, the rest of its headers."""
    weight = payload + 1024
    for url in urls:
        weight = weight + 3 * F.coalesce(F.octet_length(url), F.lit(0))
    kind = F.lit(len(CLASSES))
    for i, (limit, _) in reversed(list(enumerate(CLASSES))):
        kind = F.when(weight <= limit, i).otherwise(kind)
    return kind


def write_archive(pages: DataFrame, folder: str, date: str, min_bytes: int = 0, compression: str = "gzip", broadcast_rows: int = BROADCAST_ROWS) -> None:
    """Write a record per page (page_id, url, html) below ``folder``, equal payloads of ``min_bytes`` or more once.

    ``date`` is the WARC-Date of all records, as YYYY-MM-DDThh:mm:ssZ. ``compression`` is gzip or none.
    """
    as_response = _class(F.col("payload_bytes"), F.col("url"))
    as_revisit = _class(F.lit(0), F.col("url"), F.col("first_url"))
    kinds = F.when(F.col("record_type") == "response", as_response).otherwise(as_revisit)
    resolved = stored(resolve(headers(pages), min_bytes).withColumn("class", kinds), "resolved")
    held = {(r.record_type, r["class"]): r for r in resolved.groupBy("record_type", "class").agg(F.count("*").alias("n"), F.max("same_rows").alias("same")).collect()}

    def append(rows: DataFrame, record: Column, kind: str) -> None:
        for c in sorted(c for k, c in held if k == kind):
            per_file = CLASSES[c][1] if c < len(CLASSES) else 1
            writer = rows.where(F.col("class") == c).select(record.alias("value")).write.mode("append")
            writer.option("lineSep", EOL * 2).option("compression", compression).option("maxRecordsPerFile", per_file).text(folder)

    revisits = resolved.where("record_type = 'revisit'")
    append(revisits, _revisit(date, min_bytes), "revisit")

    # Rows that share id and url with the first of their group are the same there: one of them is left.
    first = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    marks = revisits.select("page_id", "url", "sha", "payload_bytes", first.alias("one_stays")).distinct()
    if sum(r.n for (kind, _), r in held.items() if kind == "revisit") <= broadcast_rows:
        marks = F.broadcast(marks)
    wide = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", *_identity())
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"m.{c}")) for c in ("page_id", "url", "sha", "payload_bytes")]
    marked = wide.alias("p").join(marks.alias("m"), same, "left").select("p.*", "m.one_stays").withColumn("class", as_response)
    append(marked.where("one_stays IS NULL"), _response(date, min_bytes), "response")
    if any((r.same or 0) > 1 for r in held.values()):
        append(marked.where("one_stays").dropDuplicates(["page_id", "url", "sha", "payload_bytes"]), _response(date, min_bytes), "response")


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, payload) of each record of an archive file."""
    raw = io.BytesIO(content)
    file = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        found = {}
        while (line := file.readline()).strip():
            name, _, value = line.partition(b":")
            found[name.decode().strip().lower()] = value.decode().strip()
        block = file.read(int(found["content-length"]))
        if len(block) < int(found["content-length"]):
            raise ValueError(f"record {found.get('warc-record-id')} ends early")
        yield found, block.partition(b"\r\n\r\n")[2] if found.get("content-type", "").startswith("application/http") else block


def _unpacked(payloads: bool):
    import pyarrow as pa

    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in RECORD.split(", ")]

    def arrow(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for content in batch.column(0):
                for found, payload in records_of(content.as_py()):
                    page, digest = found.get("page-id"), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    told = [found.get(f"warc-{n}") for n in ("target-uri", "date", "payload-digest", "refers-to")]
                    told[2] = told[2].removeprefix("sha1:") if told[2] else None
                    rows.append((found.get("warc-record-id"), found.get("warc-type"), int(page) if page else None, *told, payload if payloads else None, len(payload), digest))
                    size += len(payload) if payloads else 0
                    if len(rows) >= 1000 or size > 1 << 23:
                        yield arrow(rows)
                        rows, size = [], 0
        if rows:
            yield arrow(rows)

    return unpack


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below ``folder``; ``found_digest`` and ``payload_bytes`` are those of the payload itself."""
    files = if_there(spark, lambda: spark.read.format("binaryFile").load(folder).select("content"), "content binary")
    return files.mapInArrow(_unpacked(payloads), RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Responses and revisits, the latter with the payload's size and digest, and the page, of the response they refer to.

    page_id, target_uri, payload_bytes, payload_digest, record_type, refers_to. What refers to no response has no size.
    """
    originals = records.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("digest"), F.col("record_id").alias("original"))
    originals = originals.agg(F.min("page_id").alias("first_id"), F.min("payload_bytes").alias("size"), F.min("found_digest").alias("true_digest"))
    own = records.where("record_type = 'response'").select("page_id", "target_uri", "payload_bytes", F.col("found_digest").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = records.where("record_type = 'revisit'").join(originals, [F.col("payload_digest") == F.col("digest"), F.col("refers_to") == F.col("original")], "left")
    return own.unionByName(revisits.select("page_id", "target_uri", F.col("size").alias("payload_bytes"), F.coalesce("true_digest", "payload_digest").alias("payload_digest"), "record_type", F.col("first_id").alias("refers_to")))
