"""WARC archives: a writer and a splittable reader.

Writing is a plain Spark text write: each row is one gzip member (a WARC/1.1
record), so the commit protocol, retries and the target file system are
Spark's. The text writer needs a line separator; the members' own last byte
serves as it. That byte is the top byte of the member's length and zero for
records below 16 MB; a longer record is followed by an empty member, which
ends with zero. The files are therefore ordinary ``.warc.gz`` content.

Reading deals out byte ranges of the files. A task scans its range for gzip
magic, takes a place for a record only if the member there decodes to a WARC
header, owns the records that start inside its range, and reads past its end
to finish the last one. Magic bytes inside compressed data fail the check or
lie inside a record that has been read already.

Files are opened through ``pyarrow.fs`` by their URI, so the archive folder
may be any store that it reaches (local shared folder, HDFS, S3, GCS).

Defined results: a null payload is an empty one; a null URL writes no target
URI; a null page id writes no id and reads back as null; equal payloads (SHA-1)
of at least ``min_revisit`` bytes have the record with the largest page id as
response, the others revisit it; rows that repeat the largest id are responses
all; an empty table writes no record and reads back empty.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES = 8 << 20  # of archive that a task scans
READ_BYTES = 1 << 20
PIECE_BYTES = 8 << 10  # fed to the decoder at a time; what it leaves over is copied
EMPTY_MEMBER = zlib.compressobj(1, zlib.DEFLATED, 31).flush()
DATE = "1970-01-01T00:00:00Z"  # records are dated by the caller's data, of which pages have none
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, payload binary, path string, offset long"
)


UNSAFE = re.compile(r"[\x00-\x1F\x7F-\x9F\u2028\u2029]|^\s+|\s+$")


def _member(page_id, url, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """One record as a gzip member whose last byte is zero."""
    revisit = refers_to is not None
    head = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    ).encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    lines.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    lines.append(f"WARC-Date: {DATE}")
    if url is not None:
        # as it is, in UTF-8; only what would end the line or be trimmed is escaped
        lines.append("WARC-Target-URI: " + UNSAFE.sub(lambda m: quote(m[0]), url))
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    lines.append("Content-Type: application/http; msgtype=response")
    block = head if revisit else head + payload
    lines.append(f"Content-Length: {len(block)}")
    record = ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    member = packer.compress(record) + packer.flush()
    return member if member[-1] == 0 else member + EMPTY_MEMBER


def write(pages: DataFrame, path: str, min_revisit: int = 0, id_col: str = "page_id",
          url_col: str = "url", payload_col: str = "html") -> None:
    """Write one record for each row of ``pages`` to gzip archives in the folder ``path``.

    The responses' ids come from one small aggregation over digests; payloads
    move once, to meet them, in a join that may split a much repeated digest.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    original = rows.groupBy("sha1").agg(F.max("id").alias("original"), F.count("*").alias("n"))
    repeated = original.filter("n > 1").select("sha1", "original")
    revisit = (
        F.col("original").isNotNull()
        & ~F.col("id").eqNullSafe(F.col("original"))
        & (F.octet_length("payload") >= min_revisit)
    )
    ready = rows.join(repeated, "sha1", "left").select(
        "id",
        "url",
        F.when(revisit, F.col("original")).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("size"),
        F.col("sha1"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(batch.num_columns))):
                page_id, url, refers_to, size, sha1, payload = (x.as_py() for x in row)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                member = _member(page_id, url, payload or b"", digest, size, refers_to)
                yield pa.RecordBatch.from_arrays([pa.array([member[:-1]], pa.binary())], names=["member"])

    members = ready.mapInArrow(run, "member binary").select(F.col("member").cast("string").alias("value"))
    members.write.option("lineSep", "\0").text(path)


def ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, start, stop): the byte ranges that the tasks of a read own."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    return files.select("path", "length", starts.alias("start")).select(
        "path", "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("stop")
    )


class _Source:
    """A file with a window of bytes that grows as they are asked for."""

    def __init__(self, file, start: int):
        self.file, self.base, self.data = file, start, b""
        self.ended = False

    def more(self) -> bool:
        if not self.ended:
            self.file.seek(self.base + len(self.data))
            got = self.file.read(READ_BYTES)
            self.ended = not got
            self.data += got
        return not self.ended

    def drop(self, upto: int) -> None:
        """Forget what lies before ``upto``, if that is worth a copy."""
        if upto - self.base >= READ_BYTES:
            self.data, self.base = self.data[upto - self.base :], upto


def _decode(source: _Source, at: int) -> tuple[bytes, int] | None:
    """The member that starts at ``at`` and the place after it, or None if there is none."""
    unpacker, out, place, checked = zlib.decompressobj(31), [], at, False
    while True:
        piece = source.data[place - source.base : place - source.base + PIECE_BYTES]
        if not piece and not unpacker.eof:
            if not source.more():
                return None
            continue
        try:
            out.append(unpacker.decompress(piece))
        except zlib.error:
            return None
        place += len(piece) - len(unpacker.unused_data)
        if not checked and (unpacker.eof or sum(map(len, out)) >= 5):
            if not b"".join(out).startswith(b"WARC/"):
                return None
            checked = True
        if unpacker.eof:
            return b"".join(out), place


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (x.split(":", 1) for x in lines.decode("utf-8", "replace").split("\r\n")[1:] if ":" in x)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _page(uri: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri)
    return int(found[1]) if found else None


def parse(member: bytes) -> dict:
    """A record's fields; size and digest of responses are those of the payload read."""
    head, _, rest = member.partition(b"\r\n\r\n")
    warc = _fields(head)
    block = rest[: int(warc["content-length"])]
    if len(block) < int(warc["content-length"]):
        raise ValueError("record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    kind = warc["warc-type"]
    if kind == "response":
        size = len(payload)
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload digest of {warc['warc-record-id']} does not match")
    else:
        size = int(_fields(http)["content-length"])
    return {
        "page_id": _page(warc["warc-record-id"]),
        "url": warc.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _page(warc.get("warc-refers-to", "")),
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload if kind == "response" else None,
    }


def records(file, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(offset, member) of the records of an open archive that start in [start, stop)."""
    source, at = _Source(file, start), start
    while at < stop:
        found = source.data.find(MAGIC, at - source.base)
        if found < 0:
            at = max(at, source.base + len(source.data) - len(MAGIC) + 1)
            source.drop(at)
            if not source.more():
                return
            continue
        at = source.base + found
        if at >= stop:
            return
        source.drop(at)
        member = _decode(source, at)
        if member is None:
            at += 1
        else:
            yield at, member[0]
            at = member[1]


def read(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, payload: bool = True) -> DataFrame:
    """The records of the archives in folder ``path`` with the columns of ``RECORD``."""
    parts = ranges(spark, path, range_bytes)
    names = [f.split()[0] for f in RECORD.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64()]
    schema = pa.schema(list(zip(names, types)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for part in batch.to_pylist():
                uri = part["path"]
                store, name = fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:/", "file:///", 1))
                rows, held = [], 0
                with store.open_input_file(name) as file:
                    for offset, member in records(file, part["start"], part["stop"]):
                        row = parse(member) | {"path": part["path"], "offset": offset}
                        if not payload:
                            row["payload"] = None
                        held += len(row["payload"] or b"")
                        rows.append(row)
                        if held > READ_BYTES or len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    # one range a task as far as the cluster's parallelism goes: the list is small, the work is in the files
    return parts.repartition(spark.sparkContext.defaultParallelism * 4).mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, min_revisit: int = 0, payload: bool = True) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path, min_revisit)
    return read(pages.sparkSession, path, payload=payload)
