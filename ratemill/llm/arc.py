"""Legacy web archives (ARC) converted to WARC (operator 4).

An ARC file begins with a version block that names the version of the header lines below it. A
record is a header line, whose last field declares the length of the content, and the content.
The converter reads by these lengths alone and makes what WARC asks for beyond: record ids from
what identifies the record, ISO times from the 14 digits, record types, and SHA-1 digests of block
and payload. Of records with equal payloads the one with the smallest page id is a response; the
others become revisits without payload.

Archives are written by Spark's text writer, one row per record, with the separator that the
format asks for, so they appear only when their task is committed, on any file system.

Null html is an empty payload. A null page id is never chosen as the response while the group has
another; rows that share the smallest page id are all responses. White space and control
characters in a url are percent-encoded, since header lines are split at blanks; a null url is
``about:blank``. Repeated rows are records of their own. An empty table gives no records. Extra
columns are left out, whatever their names. An archive is read as one row of one task, so it may
have 2 GB at most; a payload of any length below that is taken whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratemill.session import new_scratch, written

# Fields of the header lines by version, separators, profile of revisits.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
ARC_SEPARATOR = "\n"
WARC_SEPARATOR = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_ID = "X-Page-Id"
REFERS_TO_PAGE = "X-Refers-To-Page-Id"
BATCH_BYTES = 1 << 22
READ_BYTES = 1 << 18
RECORD_SCHEMA = (
    "page_id long, url string, ip string, date string, record_id string, head binary, payload binary, "
    "payload_digest string, payload_bytes long"
)


def _plain_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "about:blank")


def _network_doc(page_id: int | None, html: bytes) -> bytes:
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(html)}"]
    if page_id is not None:
        head.append(f"{PAGE_ID}: {page_id}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + html


def _arc_line(version: int, **values: str) -> bytes:
    return " ".join(values.get(name.replace("-", "_"), "-") for name in ARC_FIELDS[version]).encode()


def _in_batches(rows: Iterator[tuple], make: Callable[[list[tuple]], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept, size = [], 0
    for row in rows:
        kept.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes)) + 256
        if size >= BATCH_BYTES:
            yield make(kept)
            kept, size = [], 0
    if kept:
        yield make(kept)


def _raw_rows(rows: list[tuple[bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary())], ["raw"])


def _write_records(rows: DataFrame, separator: str, path: str) -> None:
    text = rows.select(F.col("raw").cast("string").alias("value"))
    text.write.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def write_arc(pages: DataFrame, id_col: str, url_col: str, html_col: str, path: str, date: str = "20240101000000", version: int | None = None) -> None:
    """ARC files of pages, one for each input partition; without ``version`` in turn of either."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        own = version or 1 + part % 2

        def rows() -> Iterator[tuple[bytes]]:
            about = f"{own} 0 ratemill\n{' '.join(ARC_FIELDS[own])}\n".encode()
            common = {"IP_address": "0.0.0.0", "Archive_date": date}
            yield (_arc_line(own, URL=f"filedesc://part-{part}.arc", Content_type="text/plain", Archive_length=str(len(about)), **common) + b"\n" + about,)
            at = 0
            for batch in batches:
                for key, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                    content = _network_doc(key, (html or "").encode())
                    line = _arc_line(own, URL=_plain_url(url), Content_type="text/html", Result_code="200", Offset=str(at), Filename=f"part-{part}.arc", Archive_length=str(len(content)), **common)
                    at += len(line) + len(content) + 2
                    yield (line + b"\n" + content,)

        yield from _in_batches(rows(), _raw_rows)

    plain = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    _write_records(plain.mapInArrow(records, "raw binary"), ARC_SEPARATOR, path)


class _Reader:
    """Bytes of a gzip or plain file, unpacked as they are asked for."""

    def __init__(self, raw: pa.Buffer):
        self.raw, self.at = memoryview(raw), 0
        self.unzip = zlib.decompressobj(31) if bytes(self.raw[:2]) == b"\x1f\x8b" else None
        self.held = bytearray()

    def _more(self) -> bool:
        if self.at >= len(self.raw):
            return False
        part = self.raw[self.at : self.at + READ_BYTES]
        self.at += len(part)
        data = bytes(part)
        if self.unzip is None:
            self.held += data
            return True
        while data:
            self.held += self.unzip.decompress(data)
            data = self.unzip.unused_data
            if self.unzip.eof:  # the next member
                self.unzip = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """The bytes before the next mark, which is passed; None at the end."""
        start = 0
        while (found := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            if not self._more():
                if self.held.strip():
                    raise ValueError("the archive ends inside a header")
                return None
        line = bytes(self.held[:found])
        del self.held[: found + len(mark)]
        return line

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        if len(self.held) < n:
            raise ValueError("the archive ends inside a record")
        data = bytes(self.held[:n])
        del self.held[:n]
        return data


def parse_arc(raw: pa.Buffer) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of the records of an ARC file."""
    reader, version = _Reader(raw), 0
    while (line := reader.until(b"\n")) is not None:
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace")
        names = ARC_FIELDS[version or 1]
        # The url comes first and may hold blanks in old files; the other fields may not.
        values = text.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"not a header line of version {version}: {text[:200]}")
        content = reader.take(int(values[-1]))
        if not version:
            version = int(content.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown version {version}")
            continue
        yield dict(zip(names, values)), content


def _warc_date(digits: str) -> str:
    d = digits.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found.group(1).decode() if found else None


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def read_arc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of ARC files with what a WARC record needs (``RECORD_SCHEMA``)."""
    files = _files(spark, path)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for content in batch.column(0):
                    for fields, network in parse_arc(content.as_buffer()):
                        head, _, payload = network.partition(b"\r\n\r\n")
                        page, digest = _header(head, PAGE_ID), _sha1(payload)
                        name = f"{fields['URL']} {fields['Archive-date']} {digest} {page}"
                        record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"
                        yield (_number(page), fields["URL"], fields["IP-address"], _warc_date(fields["Archive-date"]), record_id, head + b"\r\n\r\n", payload if with_payload else None, digest, len(payload))

        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string(), pa.int64()]
        names = [x.split(" ")[0] for x in RECORD_SCHEMA.split(", ")]
        yield from _in_batches(rows(), lambda kept: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*kept), kinds)], names))

    return files.mapInArrow(records, RECORD_SCHEMA)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0) -> None:
    """WARC files of the records of ARC files. Payloads of less than ``min_bytes`` are never revisits."""
    light = read_arc(spark, arc_path, with_payload=False).select("page_id", "url", "date", "record_id", "payload_digest", "payload_bytes")
    groups = light.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
    one = F.struct("page_id", "record_id", "url", "date")
    # Only payloads that occur again; the table is written, so that Spark knows its size.
    again = groups.agg(F.count("*").alias("n"), F.min(F.when(F.col("page_id").isNotNull(), one)).alias("first"))
    again = written(again.where("n > 1 and first is not null").drop("n"), new_scratch(spark, "payloads"))
    rows = read_arc(spark, arc_path).join(again, ["payload_digest", "payload_bytes"], "left")
    is_revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    rows = rows.select(
        "url",
        "ip",
        "date",
        "record_id",
        "head",
        F.when(~is_revisit, F.col("payload")).alias("payload"),
        "payload_digest",
        F.when(is_revisit, F.col("first.record_id")).alias("refers_to"),
        F.when(is_revisit, F.col("first.url")).alias("refers_url"),
        F.when(is_revisit, F.col("first.date")).alias("refers_date"),
        F.when(is_revisit, F.col("first.page_id")).alias("refers_page"),
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_rows() -> Iterator[tuple[bytes]]:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    yield (_warc_record(*row),)

        yield from _in_batches(all_rows(), _raw_rows)

    _write_records(rows.mapInArrow(records, "raw binary"), WARC_SEPARATOR, warc_path)


def _warc_record(url, ip, date, record_id, head, payload, digest, refers_to, refers_url, refers_date, refers_page) -> bytes:
    block = head + (payload or b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id),
        ("WARC-Target-URI", url),
        ("WARC-Date", date),
        ("WARC-IP-Address", ip),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", refers_to),
            ("WARC-Refers-To-Target-URI", refers_url),
            ("WARC-Refers-To-Date", refers_date),
            (REFERS_TO_PAGE, str(refers_page)),
        ]
    fields.append(("Content-Length", str(len(block))))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block


def parse_warc(raw: pa.Buffer) -> Iterator[tuple[bytes, bytes]]:
    """Header and block of the records of a WARC file."""
    reader = _Reader(raw)
    while (head := reader.until(b"\r\n\r\n")) is not None:
        if not head.startswith(b"WARC/"):
            raise ValueError(f"not a record: {head[:100]!r}")
        block = reader.take(int(_header(head, "Content-Length") or 0))
        if reader.take(4) != WARC_SEPARATOR.encode():
            raise ValueError("a record is longer than it declares")
        yield head, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of the records; digests
    of payloads that are there are computed anew."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for content in batch.column(0):
                    for head, block in parse_warc(content.as_buffer()):
                        kind, digest = _header(head, "WARC-Type"), _header(head, "WARC-Payload-Digest").removeprefix("sha1:")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = _number(_header(http, "Content-Length"))
                        if kind == "response" and (_sha1(payload) != digest or len(payload) != size):
                            raise ValueError(f"the payload does not match its digest: {head[:200]!r}")
                        yield _number(_header(http, PAGE_ID)), size, digest, kind, _number(_header(head, REFERS_TO_PAGE))

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        yield from _in_batches(rows(), lambda kept: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*kept), kinds)], names))

    return _files(spark, path).mapInArrow(records, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
