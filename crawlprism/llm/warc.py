"""WARC archives as a chunked record table.

A payload is a series of (record, chunk number, bytes) rows from where it is read on: chunks are shuffled, sorted, written and read
back. Python sees one chunk at a time and carries the digest along, so no record is held whole there. Archives are gzip files
with one member for each record. A manifest of byte ranges says which records were written; a file that a lost
or repeated task left behind is in no manifest.

Of records with the same payload, the one with the largest id is a ``response``; the others are ``revisit``
records that name it. Defined cases: null payload is empty; a null id loses against any other id and, alone, is
a response; rows that share the largest id are all responses; control characters in the URL are escaped; a null URL
is left out; an empty table gives no file and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.llm.common import scratch_path, stored

CHUNK_BYTES = 256 * 1024
SEGMENT_BYTES = 4 * 1024 * 1024
READ_BYTES = 256 * 1024
MIN_REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"

# Names of the format.
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP_TYPE = "application/http; msgtype=response"

_END = b"\r\n\r\n"


def file_system(folder: str):
    """The folder's file system and path, from a plain path or any URI that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def winners(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """The record that others with the same payload refer to, for each digest and size; stored, so that what is joined with it can be split."""
    payload = _payload(payload_col)
    known = pages.select(F.col(id_col).alias("id"), F.sha1(payload).alias("sha1"), F.octet_length(payload).cast("bigint").alias("size"))
    return stored(known.groupBy("sha1", "size").agg(F.max("id").alias("winner")), "warc-winners")


def _payload(payload_col: str):
    return F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))


def chunked(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row for each chunk of each payload, made where the payload is read; an empty payload has one empty chunk.

    ``record`` tells rows apart whose ids are the same or null.
    """
    payload = _payload(payload_col)
    rows = pages.select(
        F.monotonically_increasing_id().alias("record"), F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("sha1"), F.octet_length(payload).cast("bigint").alias("size"),
    )
    n = F.greatest(F.ceil(F.col("size") / chunk_bytes), F.lit(1)).cast("int")
    data = F.substring("payload", F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes))
    return rows.select("*", n.alias("n_chunks"), F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk")).select(
        "record", "id", "url", "sha1", "size", "n_chunks", "chunk", data.alias("data")
    )


def planned_records(chunks: DataFrame, winner: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """The chunk rows to write, with the record that a revisit refers to; of a revisit one empty chunk is left.

    All chunks of a record come from one map task, and a hot payload's partition is split by map tasks, so a record's chunks stay together.
    """
    copy = (F.col("size") >= min_revisit_bytes) & F.col("winner").isNotNull() & ~F.col("id").eqNullSafe(F.col("winner"))
    return (
        chunks.join(winner, ["sha1", "size"])
        .withColumn("refers_to", F.when(copy, F.col("winner").cast("string")))
        .where(F.col("refers_to").isNull() | (F.col("chunk") == 0))
        .select(
            "record", F.col("id").cast("string").alias("id"), "url", "sha1", "size", "refers_to",
            F.when(F.col("refers_to").isNull(), F.col("n_chunks")).otherwise(1).alias("n_chunks"), "chunk",
            F.when(F.col("refers_to").isNull(), F.col("data")).otherwise(F.lit(b"")).alias("data"),
        )
        .sortWithinPartitions("record", "chunk")
        .drop("record")
    )


def _digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _record_id(page: str | None, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}|{sha1}')}>"


def _heads(page, url, sha1: str, size: int, refers_to) -> bytes:
    """The record's header and the HTTP header that begins its block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: {_record_id(page, sha1)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    if page is not None:
        lines.append(f"X-Source-Id: {page}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, sha1)}", f"X-Refers-To-Source-Id: {refers_to}"]
    length = len(http) + (0 if refers_to is not None else size)
    lines += [f"WARC-Payload-Digest: sha1:{_digest(sha1)}", f"Content-Type: {_HTTP_TYPE}", f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + _END + http


def _write(rows: Iterator[tuple], out) -> Iterator[tuple[int, int, int]]:
    """Write chunk rows as gzip members; yields (offset, bytes, records) of each segment."""
    at, begun, records = 0, 0, 0
    packer, running = None, None
    for page, url, sha1, size, refers_to, n_chunks, chunk, data in rows:
        if chunk == 0:
            packer, running = zlib.compressobj(6, zlib.DEFLATED, 31), hashlib.sha1()
            at += out.write(packer.compress(_heads(page, url, sha1, size, refers_to)))
        running.update(data)
        at += out.write(packer.compress(data))
        if chunk == n_chunks - 1:
            if refers_to is None and running.hexdigest() != sha1:
                raise ValueError(f"chunks of record {page} do not add up to its payload")
            at += out.write(packer.compress(_END) + packer.flush())
            records += 1
            if at - begun >= SEGMENT_BYTES:
                yield begun, at - begun, records
                begun, records = at, 0
    if records:
        yield begun, at - begun, records


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write one archive for each task below ``folder``; the manifest (path, offset, length, records) is stored beside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        first = next(rows, None)
        if first is None:
            return
        files.create_dir(root, recursive=True)

        def whole():
            yield first
            yield from rows

        with files.open_output_stream(f"{root}/{name}", compression=None) as out:
            segments = list(_write(whole(), out))
        columns = [pa.array([f"{folder}/{name}"] * len(segments)), *(pa.array([s[i] for s in segments], pa.int64()) for i in range(3))]
        yield pa.RecordBatch.from_arrays(columns, ["path", "offset", "length", "records"])

    return stored(chunks.mapInArrow(run, "path string, offset bigint, length bigint, records bigint"), "warc-manifest")


class _Stream:
    """Bytes of consecutive gzip members, inflated piece by piece."""

    def __init__(self, file, offset: int, length: int):
        self.file, self.left, self.buffer, self.packed = file, length, bytearray(), b""
        self.unzip = zlib.decompressobj(31)
        file.seek(offset)

    def more(self) -> bool:
        while True:
            if self.unzip.eof:
                self.packed = self.unzip.unused_data or self.packed
                self.unzip = zlib.decompressobj(31)
            if not self.packed:
                if not self.left:
                    return False
                self.packed = self.file.read(min(READ_BYTES, self.left))
                if not self.packed:
                    raise ValueError("the archive is shorter than its manifest says")
                self.left -= len(self.packed)
            piece = self.unzip.decompress(self.packed, READ_BYTES)
            self.packed = b"" if self.unzip.eof else self.unzip.unconsumed_tail
            if piece:
                self.buffer += piece
                return True

    def block(self) -> bytes | None:
        """Up to the next empty line, or nothing at the end."""
        seen = 0
        while (at := self.buffer.find(_END, max(0, seen - 3))) < 0:
            seen = len(self.buffer)
            if not self.more():
                if self.buffer:
                    raise ValueError("the archive ends within a record")
                return None
        out = bytes(self.buffer[:at])
        del self.buffer[: at + len(_END)]
        return out

    def pieces(self, n: int, size: int) -> Iterator[bytes]:
        while n:
            want = min(n, size)
            while len(self.buffer) < want:
                if not self.more():
                    raise ValueError("the archive ends within a record")
            yield bytes(self.buffer[:want])
            del self.buffer[:want]
            n -= want


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def _records(stream: _Stream, chunk_bytes: int) -> Iterator[tuple]:
    """Chunk rows of the archive: id, url, type, refers_to, payload size and digest by header, chunk, data, bytes so far, digest at the last chunk."""
    while (head := stream.block()) is not None:
        fields = _fields(head)
        http_head = stream.block()
        http = _fields(http_head)
        size, written = int(http["Content-Length"]), int(fields["Content-Length"]) - len(http_head) - len(_END)
        known = (
            fields.get("X-Source-Id"), fields.get("WARC-Target-URI"), fields["WARC-Type"], fields.get("X-Refers-To-Source-Id"),
            size, fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        )
        running, done, chunk = hashlib.sha1(), 0, 0
        for data in stream.pieces(written, chunk_bytes) if written else [b""]:
            running.update(data)
            done += len(data)
            last = done == written
            yield (*known, chunk, data, done, base64.b32encode(running.digest()).decode() if last else None)
            chunk += 1
        if stream.block() != b"":
            raise ValueError("a record does not end in an empty line")


_RECORD_FIELDS = [
    ("id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("chunk", pa.int64()), ("data", pa.binary()), ("bytes_so_far", pa.int64()), ("digest", pa.string()),
]


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunk table of all records in the manifest. ``digest`` is set on a record's last chunk."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_RECORD_FIELDS)]
        return pa.RecordBatch.from_arrays(columns, [name for name, _ in _RECORD_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for part in batches:
            for path, offset, length in zip(*(c.to_pylist() for c in part.columns)):
                files, place = file_system(path)
                with files.open_input_file(place) as file:
                    for row in _records(_Stream(file, offset, length), chunk_bytes):
                        rows.append(row if with_data else (*row[:7], None, *row[8:]))
                        held += len(rows[-1][7] or b"") + 200
                        if held >= 4 * 1024 * 1024:
                            yield batch(rows)
                            rows, held = [], 0
        if rows:
            yield batch(rows)

    kinds = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary"}
    schema = ", ".join(f"{name} {kinds[kind]}" for name, kind in _RECORD_FIELDS)
    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path", "offset", "length").repartition(spread).mapInArrow(run, schema)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write all rows to archives in the shared folder, read them back, and give one row per record.

    A response's bytes are hashed again on reading and must match its header.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    manifest = write_archives(planned_records(chunked(pages, id_col, url_col, payload_col), winners(pages, id_col, payload_col)), folder)
    kind = pages.schema[id_col].dataType
    last = read_archives(manifest, with_data=False).where(F.col("digest").isNotNull())
    wrong = (F.col("record_type") == "response") & (
        (F.col("digest") != F.col("payload_digest")) | (F.col("bytes_so_far") != F.col("payload_bytes"))
    )
    return last.select(
        F.col("id").cast(kind).alias(id_col),
        "payload_bytes",
        F.when(wrong, F.raise_error(F.lit("an archived payload does not match its digest")).cast("string")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
w AS (SELECT h, max(page_id) AS winner FROM p GROUP BY h),
d AS (
  SELECT h, winner, array_to_string([
    substr('{_BASE32}', ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)
    FOR i IN range(32)], '') AS digest
  FROM w)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN winner IS NULL OR page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM winner THEN winner END AS refers_to
FROM p JOIN d USING (h)
"""
