"""WARC archives of pages: writing with revisits and segments, reading with reassembly.

Writing stays with Spark's text writer: a record is one row, the line separator is the two empty
lines that end a record, and the bytes of a string column pass unchanged. So the writer's commit
protocol holds, and a lost executor leaves no half-written archive. Blocks of over `segment_bytes`
become a first record and continuation records.

Reading parses whole archive files by Content-Length (files are kept small by `records_per_file`).
Unsegmented records are decoded at once; segments are grouped by origin id, ordered by segment
number, checked against the total length and then decoded.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm.common import materialize

CRLF = "\r\n"
HEX_DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in bare upper-case base32: 160 bits are four times 40 bits, or 8 digits of base 32."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), HEX_DIGITS, BASE32)


def _uri(c: Column) -> Column:
    """Nothing that would end a header line."""
    return F.translate(c, CRLF, "  ")


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0, segment_bytes: int = 16384, chunk_bytes: int = 8192, records_per_file: int = 2000, date: str = "2020-01-01T00:00:00Z") -> None:
    """Writes a record for each row (page_id, url, html) to archive files in path.

    Of rows with equal payloads of at least min_revisit_bytes bytes the one with the smallest page_id
    is a response and the others revisit it; rows that repeat its page_id are responses too, and so
    are rows without page_id where no row of that payload has one. Null html is an empty payload, a
    null url leaves out the target. No rows: no records. Other columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), _uri(F.col("url").cast("string")).alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    first = rows.where(F.length("payload") >= min_revisit_bytes).groupBy("digest").agg(F.count("*").alias("copies"), F.min("page_id").alias("first_id"), F.min_by("url", "page_id").alias("first_url"))
    # written first: where the payloads that repeat are few, Spark sees the size and broadcasts them instead of dealing out all payloads
    rows = rows.join(materialize(first.where("copies > 1").drop("copies")), "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    size = F.length("payload")
    body = F.expr(f"""array_join(concat(
        transform(if(length(payload) > 0, sequence(0, length(payload) - 1, {chunk_bytes}), cast(array() as array<int>)),
                  i -> concat(lower(hex(least({chunk_bytes}L, length(payload) - i))), '\\r\\n', cast(substring(payload, i + 1, {chunk_bytes}) as string), '\\r\\n')),
        array('0\\r\\n\\r\\n')), '')""")
    plain = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}")
    block = F.when(revisit, F.concat(plain, F.lit("Content-Length: "), size.cast("string"), F.lit(CRLF + CRLF))).otherwise(F.concat(plain, F.lit(f"Transfer-Encoding: chunked{CRLF}{CRLF}"), body))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))

    records = rows.select("page_id", "url", "digest", "first_id", "first_url", revisit.alias("revisit"), F.uuid().alias("uuid"), block.cast("binary").alias("block"))
    pieces = records.withColumn("total", F.length("block")).select("*", F.posexplode(F.expr(f"transform(sequence(0, greatest(total - 1, 0), {segment_bytes}), i -> substring(block, i + 1, {segment_bytes}))")).alias("pos", "piece"))
    number = F.col("pos") + 1
    several, later = F.col("total") > segment_bytes, F.col("pos") > 0
    last = number * segment_bytes >= F.col("total")
    own = F.concat(F.lit("<urn:uuid:"), F.col("uuid"), F.when(later, F.concat(F.lit("-"), number.cast("string"))).otherwise(""), F.lit(">"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(later, "continuation").when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", own),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.when(~later, F.concat(F.lit("sha1:"), F.col("digest")))),
        line("WARC-Profile", F.when(F.col("revisit"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Refers-To-Target-URI", F.when(F.col("revisit"), F.col("first_url"))),
        line("X-Page-ID", F.when(~later, F.col("page_id"))),
        line("X-Refers-To-Page-ID", F.when(F.col("revisit"), F.col("first_id"))),
        line("WARC-Segment-Number", F.when(several, number)),
        line("WARC-Segment-Origin-ID", F.when(later, F.concat(F.lit("<urn:uuid:"), F.col("uuid"), F.lit(">")))),
        line("WARC-Segment-Total-Length", F.when(several & last, F.col("total"))),
        F.lit("Content-Type: application/http; msgtype=response" + CRLF),
        line("Content-Length", F.length("piece")),
        F.lit(CRLF),
    )
    out = pieces.select(F.concat(header, F.col("piece").cast("string")).alias("value"))
    out.write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", records_per_file).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record; ValueError where the bytes are no WARC."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at : max(stop, at)].decode("utf-8", "replace").split(CRLF)
        if stop < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start, end = stop + 4, stop + 4 + int(headers["content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end after {headers['content-length']} bytes")
        yield headers, data[start:end]
        at = end + 4


def unchunk(body: bytes) -> bytes:
    """Decodes chunked transfer framing (chunk extensions and trailers are passed over)."""
    out, at = [], 0
    while True:
        stop = body.find(b"\r\n", at)
        if stop < 0:
            raise ValueError("chunked body ends in a size line")
        size = int(body[at:stop].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        at = stop + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        out.append(body[stop + 2 : at])
        at += 2


def http_payload(block: bytes) -> tuple[bytes, int | None]:
    """(decoded body, Content-Length if told) of an HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split(CRLF)[1:])}
    length = int(fields["content-length"]) if "content-length" in fields else None
    return (unchunk(body) if "chunked" in fields.get("transfer-encoding", "").lower() else body), length


RECORD = "record_type string, page_id bigint, refers_to bigint, target_uri string, payload_digest string, payload binary, declared_bytes bigint"
TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64()]
SEGMENT = "origin string, segment int, total bigint, head string, block binary"


def _told(headers: dict[str, str], block: bytes) -> tuple:
    kind = headers["warc-type"]
    payload, length = http_payload(block)
    number = lambda k: int(headers[k]) if k in headers else None
    return kind, number("x-page-id"), number("x-refers-to-page-id"), headers.get("warc-target-uri"), headers.get("warc-payload-digest", "").removeprefix("sha1:") or None, None if kind == "revisit" else payload, length if kind == "revisit" else len(payload)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each response or revisit record of the archives in path.

    payload is the decoded body (null for revisits), declared_bytes its length, for revisits as the
    kept HTTP header tells it. A record that isn't whole, a missing or repeated segment and a wrong
    total length raise ValueError. No archives: no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for h, b in parse(content.as_py()):
                    if "warc-segment-number" not in h:
                        rows.append(_told(h, b))
                    if len(rows) == 256:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for h, b in parse(content.as_py()):
                    if "warc-segment-number" in h:
                        n = int(h["warc-segment-number"])
                        head = "\n".join(f"{k}: {v}" for k, v in h.items()) if n == 1 else None
                        rows.append((h["warc-record-id"] if n == 1 else h["warc-segment-origin-id"], n, int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, head, b))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary()), strict=True)], ["origin", "segment", "total", "head", "block"])

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for origin, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = b"".join(p["block"] for p in parts)
                if [p["segment"] for p in parts] != [*range(1, len(parts) + 1)] or parts[-1]["total"] != len(block):
                    raise ValueError(f"{origin}: segments {[p['segment'] for p in parts]} of {len(block)} bytes; {parts[-1]['total']} bytes were told")
                headers = dict(x.split(": ", 1) for x in parts[0]["head"].split("\n"))
                yield _batch([_told(headers, block)])

    # an origin's group is one record of one page, never more
    parts = files.mapInArrow(segments, SEGMENT).groupBy("origin").agg(F.array_sort(F.collect_list(F.struct("segment", "total", "head", "block"))).alias("parts"))
    return files.mapInArrow(whole, RECORD).unionByName(parts.mapInArrow(reassemble, RECORD))
