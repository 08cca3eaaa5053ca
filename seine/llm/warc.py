"""Web archives: pages to legacy ARC files, ARC to WARC, and WARC back to rows.

Archives are text files that Spark writes and reads itself, compressed, in any shared
store. Reading streams the lines of a file through one task; records are found by
their headers and declared lengths, never by searching for their ends. The converter
reads both versions of ARC headers and makes up what WARC asks for: record identifiers,
time stamps, types and digests. Of records with equal payloads of at least 1000 bytes the
one with the largest page_id is a response, the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import marked, small_batches, text_bytes

LEAST_REVISIT = 1000  # bytes
_ARC_DATE = "20240101000000"
_ARC_FIELDS = {  # fixed values: the two URL record definitions of the format
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_UNSAFE = re.compile(r"[\x00-\x20\x7f%]")


def safe_url(url: str | None, page_id) -> str:
    """A URL without white space or control characters; those and % are escaped."""
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"


def http_head(page_id, length: int) -> bytes:
    own = f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n{own}\r\n".encode()


def write_arc(pages: DataFrame, path: str) -> None:
    """One ARC file per partition of ``pages`` (page_id, url, html); null html is empty.

    Even partitions are written in version 1, odd ones in version 2.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version = 1 + part % 2
        block = f"{version} 0 seine\n{_ARC_FIELDS[version]}\n"
        first = f"filedesc://pages-{part}.arc 0.0.0.0 {_ARC_DATE} text/plain " + ("200 - - 0 - " if version == 2 else "") + f"{len(block)}\n{block}"
        yield pa.RecordBatch.from_arrays([pa.array([first.encode()], pa.binary())], ["value"])
        for batch in batches:
            out = []
            for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                content = http_head(page_id, len(html)) + html
                more = "200 - - 0 - " if version == 2 else ""
                out.append(f"{safe_url(url, page_id)} 0.0.0.0 {_ARC_DATE} text/html {more}{len(content)}\n".encode() + content)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", text_bytes("html"))
    _write(rows.mapInArrow(run, "value binary"), path, "\n")


def _write(records: DataFrame, path: str, separator: str) -> None:
    records.select(F.col("value").cast("string")).write.option("lineSep", separator).option("compression", "gzip").text(path)


class Lines:
    """A byte stream fed with lines, from which lines and counted bytes are taken."""

    def __init__(self, lines: Iterator[bytes]):
        self.lines, self.rest = lines, b""

    def line(self) -> bytes | None:
        """The next line without its end, or None."""
        if self.rest:
            head, _, self.rest = self.rest.partition(b"\n")
            return head
        return next(self.lines, None)

    def take(self, count: int) -> bytes:
        parts, have = [self.rest], len(self.rest)
        while have < count:
            line = next(self.lines, None)
            if line is None:
                raise ValueError(f"an archive ends {count - have} bytes early")
            parts += [line, b"\n"]
            have += len(line) + 1
        whole = b"".join(parts)
        self.rest = whole[count:]
        return whole[:count]


def arc_records(source: Lines) -> Iterator[tuple[str, str, str, bytes]]:
    """URL, IP address, date and content of the records of ARC files laid end to end.

    Every file begins with a version block, which says how the headers after it read.
    """
    fields: list[str] = []
    while (line := source.line()) is not None:
        if not line.strip():
            continue
        values = line.decode("utf-8", "replace").split(" ")
        content = source.take(int(values[-1]))
        if values[0].startswith("filedesc:"):
            said, names = content.decode().split("\n")[:2]
            fields = names.split(" ")
            if said.split(" ")[0] not in ("1", "2") or fields[-1] != "Archive-length":
                raise ValueError(f"unknown archive version: {said}")
            continue
        if len(values) != len(fields):
            raise ValueError(f"a header of {len(values)} fields in an archive of {len(fields)}")
        named = dict(zip(fields, values, strict=True))
        yield named["URL"], named["IP-address"], named["Archive-date"], content


def split_http(content: bytes) -> tuple[bytes, int | None, bytes]:
    """Head with its empty line, page_id and payload of an HTTP response."""
    head, gap, payload = content.partition(b"\r\n\r\n")
    own = re.search(rb"\r\nX-Page-Id: (-?\d+)", head)
    return head + gap, int(own[1]) if own else None, payload


def record_id(page_id, payload: bytes) -> str:
    """An identifier of page and payload: rows that share a page_id, or have none, differ unless their payloads are equal too."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{hashlib.sha1(payload).hexdigest()}')}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(url: str, ip: str, date: str, content: bytes, refers_to: int | None) -> bytes:
    """A WARC record, but for the empty lines that end it, made of an ARC record."""
    head, page_id, payload = split_http(content)
    stamp = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    block = content if refers_to is None else head
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, payload)}", f"WARC-Date: {stamp}",
        f"WARC-Target-URI: {url}", f"WARC-IP-Address: {ip}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: {_sha1(payload)}", f"WARC-Block-Digest: {_sha1(block)}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, payload)}", f"X-Refers-To-Page: {refers_to}",
        ]
    return ("\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of every file as bytes; a compressed file is one task's, in order."""
    small_batches(spark, 4096)
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"))


def _feed(batches: Iterator[pa.RecordBatch]) -> Lines:
    return Lines(line for batch in batches for line in batch.column(0).to_pylist())


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as batches of some 256 rows or ``most`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if len(held) >= 256 or size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def arc_facts(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes and digest of the records of ARC files."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("digest", pa.binary())])

    def run(batches):
        def rows():
            for *_, content in arc_records(_feed(batches)):
                _, page_id, payload = split_http(content)
                yield page_id, len(payload), hashlib.sha1(payload).digest()

        yield from _batches(rows(), schema)

    return _lines(spark, path).mapInArrow(run, "page_id long, payload_bytes long, digest binary")


def convert(spark: SparkSession, arc: str, warc: str) -> None:
    """Rewrite the ARC files below ``arc`` as WARC files below ``warc``.

    The digests that occur more than once are gathered first, without payloads. A map of
    fixed size of their hashes then tells the records that surely are responses, which are
    converted where they lie; only the others meet their group in a join.
    """
    facts = arc_facts(spark, arc).where(F.col("payload_bytes") >= LEAST_REVISIT)
    groups = facts.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 AND last IS NOT NULL")
    groups = cut_lineage(groups.select("digest", "last"), "payload_groups")
    schema = pa.schema([("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("content", pa.binary()), ("page_id", pa.int64()), ("digest", pa.binary())])

    def parse(batches):
        def rows():
            for url, ip, date, content in arc_records(_feed(batches)):
                _, page_id, payload = split_http(content)
                yield url, ip, date, content, page_id, hashlib.sha1(payload).digest() if len(payload) >= LEAST_REVISIT else None

        yield from _batches(rows(), schema)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([warc_record(*row) for row in rows], pa.binary())], ["value"])

    def straight(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = ((warc_record(*r, None),) for r in arc_records(_feed(batches)))
        yield from _batches(records, pa.schema([("value", pa.binary())]))

    if groups.isEmpty():
        out = _lines(spark, arc).mapInArrow(straight, "value binary")
    else:
        records = _lines(spark, arc).mapInArrow(parse, "url string, ip string, date string, content binary, page_id long, digest binary")
        maybe = F.col("digest").isNotNull() & marked(groups, "digest")
        met = records.where(maybe).join(groups, "digest", "left")
        refers = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to")
        columns = ("url", "ip", "date", "content")
        sure = records.where(~maybe).select(*columns, F.lit(None).cast("long").alias("refers_to"))
        out = sure.mapInArrow(emit, "value binary").union(met.select(*columns, refers).mapInArrow(emit, "value binary"))
    _write(out, warc, "\r\n\r\n")


def warc_records(source: Lines) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of the records of WARC files laid end to end."""
    while (line := source.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:80]!r}")
        headers = {}
        while (line := source.line()) is not None and line != b"\r":
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.lower()] = value.strip()
        yield headers, source.take(int(headers["content-length"]))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, html (null in revisits), payload_bytes, payload_digest, record_type and refers_to of WARC files."""
    types = {"page_id": pa.int64(), "url": pa.string(), "html": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}

    def run(batches):
        def rows():
            for headers, block in warc_records(_feed(batches)):
                head, page_id, payload = split_http(block)
                said = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                revisit = headers["warc-type"] == "revisit"
                if not revisit and hashlib.sha1(payload).hexdigest() != said:
                    raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
                size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1]) if revisit else len(payload)
                refers = headers.get("x-refers-to-page")
                yield page_id, headers["warc-target-uri"], None if revisit else payload, size, said, headers["warc-type"], int(refers) if refers else None

        yield from _batches(rows(), pa.schema(list(types.items())))

    return _lines(spark, path).mapInArrow(run, "page_id long, url string, html binary, payload_bytes long, payload_digest string, record_type string, refers_to long")
