"""WARC archives of pages: writer, sequential reader, digests (operator 4).

Each writing task appends records to archive files in the shared folder, one gzip member per record, and starts
a new file when one is full. Files are written under a name of their own attempt, and the table of finished files
is stored; files of attempts that were lost are in no table and never read. Readers take whole files: one pass,
decompressing member by member in small pieces, framing by Content-Length, and checking both digests.

Of records with equal payloads the one with the largest page_id is a response, the others are revisits that
carry headers only and name it. Equal payloads are found by SHA-256 from rows without the html, so one very
frequent payload moves as numbers; html moves once, by page_id.

Null html counts as empty. A null url gives a record without a target. Rows with null page_id are never named as
the response: they are revisits where the group has a row with a page_id, else responses. Rows that repeat the
largest page_id of their group are all responses. An empty table gives no record. Other columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.llm.common import arrow_map, slices, store, table
from videonet.llm.registry import query
from videonet.session import scratch_path

ARCHIVE_BYTES = 256 << 20
READ_BYTES = 64 << 10
BATCH_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LEVEL = 6
FIELDS = {
    "page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(),
    "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
}
SCHEMA = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string,"
          " refers_to long")


class BadRecord(ValueError):
    """An archive that is cut off, badly framed, or whose digest does not match."""


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    value = name.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def _escaped(url: str) -> str:
    """Line ends and the escape character itself as %XX, so a header stays one line and can be read back."""
    return url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unescaped(url: str) -> str:
    return url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record: a response with the payload, or a revisit of the page `refers_to` without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _escaped(url)))
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    headers += [
        ("WARC-Payload-Digest", f"sha1:{sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{sha1(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class MemberReader:
    """Bytes of a file of gzip members, decompressed as they are asked for; tells where a member ends."""

    def __init__(self, stream: BinaryIO):
        self._stream = stream
        self._raw = b""
        self._plain = bytearray()
        self._unpacker = None

    def _more(self) -> bool:
        """Decompress another piece of this member; False at its end."""
        while True:
            if self._unpacker.eof:
                return False
            if not self._raw:
                self._raw = self._stream.read(READ_BYTES)
                if not self._raw:
                    raise BadRecord("archive ends inside a record")
            piece = self._unpacker.decompress(self._raw, READ_BYTES)
            self._raw = self._unpacker.unused_data if self._unpacker.eof else self._unpacker.unconsumed_tail
            if piece:
                self._plain += piece
                return True

    def open_member(self) -> bool:
        """Begin the next member; False at the end of the file."""
        if not self._raw:
            self._raw = self._stream.read(READ_BYTES)
        self._unpacker = zlib.decompressobj(31)
        return bool(self._raw)

    def until(self, mark: bytes) -> bytes:
        """The bytes up to a mark, which is skipped."""
        start = 0
        while (at := self._plain.find(mark, start)) < 0:
            start = max(0, len(self._plain) - len(mark) + 1)
            if not self._more():
                raise BadRecord("record without a complete header")
        found = bytes(self._plain[:at])
        del self._plain[:at + len(mark)]
        return found

    def exactly(self, size: int) -> bytes:
        while len(self._plain) < size:
            if not self._more():
                raise BadRecord("record shorter than its Content-Length")
        found = bytes(self._plain[:size])
        del self._plain[:size]
        return found

    def close_member(self) -> None:
        if self.exactly(4) != b"\r\n\r\n" or self._plain or self._more():
            raise BadRecord("record longer than its Content-Length")


def _headers(data: bytes) -> dict[str, str]:
    lines = data.decode().split("\r\n")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def read_archive(stream: BinaryIO) -> Iterator[dict]:
    """The records of one archive in order, as rows of FIELDS; digests and lengths are checked."""
    reader = MemberReader(stream)
    while reader.open_member():
        head = reader.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/1."):
            raise BadRecord("no WARC version line")
        fields = _headers(head)
        block = reader.exactly(int(fields["content-length"]))
        reader.close_member()
        if fields["warc-block-digest"] != f"sha1:{sha1(block)}":
            raise BadRecord(f"block digest of {fields['warc-record-id']}")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(_headers(http)["content-length"])
        revisit = fields["warc-type"] == "revisit"
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        if not revisit and (len(payload) != size or sha1(payload) != digest):
            raise BadRecord(f"payload of {fields['warc-record-id']}")
        url = fields.get("warc-target-uri")
        yield {
            "page_id": page_of(fields["warc-record-id"]),
            "url": None if url is None else _unescaped(url),
            "payload": None if revisit else payload,
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": fields["warc-type"],
            "refers_to": page_of(fields["warc-refers-to"]) if revisit else None,
        }


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _writer(folder: str, archive_bytes: int):
    def work(batches):
        files, folder_path = _place(folder)
        files.create_dir(folder_path, recursive=True)
        out, name, written, records = None, "", 0, 0

        def finished():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [name], "records": [records], "bytes": [written]})

        for batch in slices(batches, "html", BATCH_BYTES):
            for row in batch.to_pylist():
                if out is None:
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, written, records = files.open_output_stream(f"{folder_path}/{name}", compression=None), 0, 0
                payload = (row["html"] or "").encode()
                member = gzip_member(record(row["page_id"], row["url"], payload, row["refers_to"]))
                out.write(member)
                written, records = written + len(member), records + 1
                if written >= archive_bytes:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    return work


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages (page_id, url, html) as records below `folder`, which all executors share.

    Returns the stored table of finished files: path below the folder, records, bytes.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    key = F.sha2(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), 256)
    keyed = store(rows.select("page_id", key.alias("payload_key")), "page-payloads")
    owners = store(
        keyed.groupBy("payload_key").agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND owner IS NOT NULL"),
        "payload-owners",
    )
    # Per page_id and payload, so that repeated ids and null ids find their own owner.
    revisits = (
        keyed.join(owners, "payload_key").filter(~F.col("page_id").eqNullSafe(F.col("owner")))
        .select(F.col("page_id").alias("revisit_id"), F.col("payload_key").alias("revisit_key"), "owner").distinct()
    )
    told = rows.withColumn("payload_key", key).join(
        revisits,
        F.col("page_id").eqNullSafe(F.col("revisit_id")) & (F.col("payload_key") == F.col("revisit_key")),
        "left",
    ).select("page_id", "url", "html", F.col("owner").alias("refers_to"))
    return store(arrow_map(told, _writer(folder, archive_bytes), "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the listed files, one task for each file; without payloads they are null."""

    def work(batches):
        files, folder_path = _place(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{folder_path}/{path}", compression=None) as stream:
                    for row in read_archive(stream):
                        held += len(row["payload"] or b"") + 200
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        if held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, pa.schema(FIELDS))
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, pa.schema(FIELDS))

    # Files are few and large. With a number given, Spark does not merge these small partitions into one task.
    spread = archives.select("path").repartition(max(1, 2 * archives.count()), "path")
    return arrow_map(spread, work, SCHEMA)


SQL = """
WITH bodies AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
bits AS (
  SELECT page_id, body, unhex(sha1(body))::BIT::VARCHAR AS b,
         max(page_id) OVER (PARTITION BY body) AS owner FROM bodies)
SELECT page_id, octet_length(body) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
         + 16 * substr(b, 5 * i + 1, 1)::INT + 8 * substr(b, 5 * i + 2, 1)::INT + 4 * substr(b, 5 * i + 3, 1)::INT
         + 2 * substr(b, 5 * i + 4, 1)::INT + substr(b, 5 * i + 5, 1)::INT AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM bits
"""


@query("op4_warc", SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    archives = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(archives, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
