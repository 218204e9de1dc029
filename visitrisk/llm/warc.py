"""WARC archives: written with one gzip member per record, read back as a sequence of records.

**Write.** Pages are grouped by the SHA-1 of their payload. The page with the smallest id of a group becomes a
response record, the others revisit records that name it and repeat its digest and length. Each task
compresses its records one by one; Spark's text writer puts them into files through its commit protocol, on
any file system, and a lost task leaves no part of a file. A gzip member ends with the top byte of its
size, which is zero below 16 MB, so that zero byte serves as line separator; a larger record is followed
by an empty member, which does end with zero. A task begins a new file after ``bytes_per_file``, so one file
fits a reading task.

**Read.** A reader walks a file with incremental zlib decompression, a chunk at a time, takes the header up to
the blank line, then exactly Content-Length bytes and the two closing line breaks, and checks the block's
digest. Damaged records (header, length or digest) raise an error.

**Archives from elsewhere** (``*.warc.gz`` with one member per record, and ``*.warc`` without compression) are read
as well: records of any type, header lines with or without a blank behind the colon or continued on the next
line, digests of any algorithm that Python has, in base32 or hexadecimal. The payload of an HTTP message is
what follows its head; that of a message with a transfer encoding, whose digest may be of the decoded body, is not
checked. Without a payload digest it is computed, except for revisits and records of a part. Fields that a
record lacks are NULL; ``page_id`` and ``refers_to`` are numbers that this module wrote.

Defined cases: NULL payloads are empty; payloads below ``least_revisit`` bytes are all responses; of rows with
equal payload and equal smallest id all are responses; a NULL id is larger than any other and names no
revisit's response unless all are NULL; extra columns are not carried.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.llm.common import columns

BYTES_PER_FILE = 32 << 20
CHUNK = 1 << 16
_DATE = "1970-01-01T00:00:00Z"

RECORD = columns("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, block_bytes long")


def digest(data: bytes) -> str:
    """Base32 of the SHA-1, without a prefix."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()  # noqa: S324


def member(record: bytes) -> bytes:
    """The record as one gzip member; an empty member follows where the last byte would not be zero."""

    def one(data: bytes) -> bytes:
        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
        return squeeze.compress(data) + squeeze.flush()

    whole = one(record)
    return whole if whole[-1] == 0 else whole + one(b"")


def encoded(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.1 record. Line breaks in the URL, which would end its header line, are percent-encoded."""
    name = "none" if page_id is None else str(page_id)
    block = b"" if revisit else payload
    target = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Payload-Length: {len(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'none' if refers_to is None else refers_to}>"] if revisit else []),
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def planned(pages: DataFrame, least_revisit: int = 0) -> DataFrame:
    """page_id, url, html, revisit and refers_to. Only ids and digests are grouped; a payload moves once, by its digest."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = rows.withColumn("sha", F.sha1("html"))
    order = F.struct(F.isnull("page_id").alias("unnamed"), F.col("page_id").alias("id"))
    firsts = keyed.groupBy("sha").agg(F.min(order).alias("first")).select("sha", "first", F.xxhash64("sha").alias("own"))
    both = keyed.withColumn("own", F.xxhash64("sha")).join(firsts, ["sha", "own"])
    revisit = ~F.col("page_id").eqNullSafe(F.col("first.id")) & (F.octet_length("html") >= least_revisit)
    return both.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("first.id")).alias("refers_to"))


def write(pages: DataFrame, folder: str, least_revisit: int = 0, bytes_per_file: int = BYTES_PER_FILE) -> None:
    """Archives of ``pages`` (page_id, url, html) in ``folder``, which must not exist."""

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                lines, files = [], []
                for r in batch.slice(at, 64).to_pylist():
                    data = member(encoded(r["page_id"], r["url"], r["html"].encode(), r["refers_to"], r["revisit"]))
                    files.append(written // bytes_per_file)
                    written += len(data)
                    lines.append(data[:-1])
                raw = pa.array(lines, pa.binary())
                # A string column for the text writer, which writes its bytes as they are.
                text = pa.Array.from_buffers(pa.string(), len(raw), raw.buffers())
                yield pa.record_batch([text, pa.array(files, pa.int32())], names=["value", "file"])

    rows = planned(pages, least_revisit).mapInArrow(records, "value string, file int")
    rows.write.partitionBy("file").option("lineSep", "\x00").option("compression", "none").text(folder)


def sequence(data: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, decompressed a chunk at a time; memory holds one record."""
    stream = _Stream(data)
    while stream.more():
        head = stream.until(b"\r\n\r\n").decode().split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {head[0][:40]!r}")
        fields: dict[str, str] = {}
        name = ""
        for line in head[1:]:
            if line[:1] in (" ", "\t") and name:
                fields[name] += " " + line.strip()
            else:
                name, colon, value = line.partition(":")
                if not colon:
                    raise ValueError(f"no header line: {line[:40]!r}")
                name = name.strip().lower()
                fields[name] = value.strip(" \t")
        block = stream.take(int(fields["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        if not agrees(fields.get("warc-block-digest"), block):
            raise ValueError(f"wrong digest: {fields.get('warc-record-id')}")
        yield fields, block


def agrees(label: str | None, data: bytes) -> bool:
    """Whether ``algorithm:value`` is the digest of ``data``; so is none, and one of an unknown algorithm."""
    algorithm, _, value = (label or "").partition(":")
    kind = algorithm.lower().replace("-", "")
    if kind not in hashlib.algorithms_guaranteed or kind.startswith("shake"):
        return True
    raw = hashlib.new(kind, data, usedforsecurity=False).digest()
    return value.lower() == raw.hex() or value.upper().rstrip("=") == base64.b32encode(raw).decode().rstrip("=")


def payload_of(fields: dict[str, str], block: bytes) -> tuple[bytes, bool]:
    """The payload of a record, and whether its digest must be that of these bytes."""
    if not fields.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
        return block, True
    head, _, body = block.partition(b"\r\n\r\n")
    return body, b"\ntransfer-encoding:" not in head.lower()


class _Stream:
    """Bytes of consecutive gzip members, or of an archive without compression."""

    def __init__(self, data: bytes | memoryview) -> None:
        self.data, self.at, self.out, self.member = memoryview(data), 0, bytearray(), None
        self.plain = bytes(self.data[:5]) == b"WARC/"

    def grow(self) -> bool:
        """More bytes in ``out``; False at the end."""
        size = len(self.out)
        while len(self.out) == size:
            if self.plain:
                self.out += self.data[self.at : self.at + CHUNK]
                self.at += CHUNK
                return len(self.out) > size
            if self.member is None:
                if self.at >= len(self.data):
                    return False
                self.member = zlib.decompressobj(31)
            chunk = self.data[self.at : self.at + CHUNK]
            if not chunk:
                raise ValueError("the archive ends within a member")
            self.out += self.member.decompress(chunk)
            self.at += len(chunk) - len(self.member.unused_data)
            if self.member.eof:
                self.member = None
        return True

    def more(self) -> bool:
        return bool(self.out) or self.grow()

    def until(self, mark: bytes) -> bytes:
        start = 0
        while (found := self.out.find(mark, start)) < 0:
            start = max(0, len(self.out) - len(mark))
            if not self.grow():
                raise ValueError("the archive ends within a header")
        return self.take(found + len(mark))[: -len(mark)]

    def take(self, n: int) -> bytes:
        while len(self.out) < n:
            if not self.grow():
                raise ValueError("the archive ends within a record")
        taken = bytes(self.out[:n])
        del self.out[:n]
        return taken


def read(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The records of all archives below ``folder`` (files of this module, ``*.warc``, ``*.warc.gz``; others are left):
    RECORD, and ``payload`` (binary) on request.

    Files come as a whole to a task, so archives from elsewhere must be below 2 GB and fit it.
    """
    schema = T.StructType(RECORD.fields + [T.StructField("payload", T.BinaryType())] * payloads)

    def number(urn: str | None) -> int | None:
        name = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(name) if (urn or "").startswith("<urn:page:") and name.lstrip("-").isdigit() else None

    def row(fields: dict[str, str], block: bytes) -> dict:
        kind, named, own = fields.get("warc-type"), fields.get("warc-payload-digest"), fields.get("warc-record-id", "").startswith("<urn:page:")
        payload, certain = payload_of(fields, block)
        whole = kind != "revisit" and "warc-segment-number" not in fields
        if whole and certain and not agrees(named, payload):
            raise ValueError(f"wrong payload digest: {fields.get('warc-record-id')}")
        if named is None and whole:
            named = digest(payload)
        url = fields.get("warc-target-uri")
        if own and url is not None:
            url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        return {"page_id": number(fields.get("warc-record-id")), "url": url, "record_type": kind, "payload_bytes": int(fields.get("warc-payload-length", len(payload))), "payload_digest": named and named.removeprefix("sha1:"), "refers_to": number(fields.get("warc-refers-to")), "block_bytes": len(block), "payload": payload}

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for fields, block in sequence(content.as_buffer()):
                    rows.append(row(fields, block))
                    held += len(block) if payloads else 0
                    if len(rows) == 1000 or held > CHUNK << 6:
                        yield batch_of(rows)
                        rows, held = [], 0
                yield batch_of(rows)

    kinds = {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[f] for r in rows], kinds[k]) for f, k in names], names=[f for f, _ in names])

    names = [(f.name, f.dataType.simpleString()) for f in schema]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "{part-*,*.warc,*.warc.gz}").option("recursiveFileLookup", True).load(folder)
    return files.select("content").mapInArrow(records, schema)


def archived(pages: DataFrame, root: str, least_revisit: int = 0) -> DataFrame:
    """``pages`` written to a new folder below ``root`` and read back."""
    folder = f"{root}/warc-{uuid4().hex}"
    write(pages, folder, least_revisit)
    return read(pages.sparkSession, folder)
