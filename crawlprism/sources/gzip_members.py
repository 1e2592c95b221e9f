"""Archives of many gzip members, read and written in pieces.

A gzip stream cannot be entered in the middle, but an archive is a row of members, each of which can. A file is dealt out in ranges of
bytes. A range's task looks for the first member that begins in its range: the three bytes that begin every member, followed by data that
inflates to a record's first line, so compressed bytes that happen to look alike are passed over. From there it inflates member after
member until one begins behind the range. No index is built and no file is read twice; a file of one member is read by its first
range's task, whole.

Files are opened with Arrow's file systems, so the folder must be one that Arrow can open (local or shared path, HDFS, S3, GCS).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlprism.session import shuffle_width
from crawlprism.sources.wet import record_separator

RANGE_BYTES = 32 * 1024 * 1024
_READ_BYTES = 1024 * 1024
_PIECE_BYTES = 16 * 1024
_BATCH_BYTES = 4 * 1024 * 1024

# How a gzip member with deflated data begins, and a record.
_MEMBER = b"\x1f\x8b\x08"
_RECORD = b"WARC/1.0"
# A member's header with a name is rarely longer than this, and a record's first line needs few bytes more.
_PROBE_BYTES = 4096


def _open(path: str):
    from pyarrow import fs

    files, place = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return files, place


def archive_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, length) of the files below the paths; their contents are not read."""
    return spark.read.format("binaryFile").load(paths).select("path", "length")


class _Bytes:
    """A window on a file that moves forward."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.at, self.data, self.place = file, size, at, b"", 0
        file.seek(at)

    def peek(self, n: int) -> bytes:
        """The next ``n`` bytes, fewer at the end of the file."""
        while len(self.data) - self.place < n and self.at + len(self.data) - self.place < self.size:
            more = self.file.read(_READ_BYTES)
            if not more:
                break
            self.data, self.place = self.data[self.place :] + more, 0
        return self.data[self.place : self.place + n]

    def skip(self, n: int) -> None:
        self.place += n
        self.at += n


def _begins_record(data: bytes) -> bool:
    try:
        return zlib.decompressobj(31).decompress(data[:_PROBE_BYTES], len(_RECORD)).startswith(_RECORD)
    except zlib.error:
        return False


def _first_member(window: _Bytes, end: int) -> bool:
    """Move to the first member before ``end`` that begins with a record; False when there is none."""
    while window.at < end:
        data = window.peek(_READ_BYTES)
        place = data.find(_MEMBER)
        if place < 0:
            if window.at + len(data) >= window.size:
                return False
            window.skip(max(1, len(data) - len(_MEMBER) + 1))
            continue
        window.skip(place)
        if window.at >= end:
            return False
        if _begins_record(window.peek(_PROBE_BYTES)):
            return True
        window.skip(1)
    return False


def _inflated(window: _Bytes, end: int) -> Iterator[bytes]:
    """The data of the members from here on that belong to the range: up to the first record that begins in a member at or behind ``end``."""
    while (head := window.peek(_PROBE_BYTES)).startswith(_MEMBER):
        if window.at >= end and _begins_record(head):
            return
        unzip = zlib.decompressobj(31)
        while not unzip.eof:
            data = window.peek(_PIECE_BYTES)
            if not data:
                raise ValueError("the archive ends within a member")
            piece = unzip.decompress(data)
            window.skip(len(data) - len(unzip.unused_data))
            if piece:
                yield piece


def _records(pieces: Iterator[bytes], separator: bytes) -> Iterator[bytes]:
    """The records of a stream of bytes, without the lines between them, as the plain text reader gives them."""
    held, first = bytearray(), True
    mark = separator[1:]
    for piece in pieces:
        seen = max(0, len(held) - len(separator))
        held += piece
        if held.find(separator, seen) < 0:
            continue
        *whole, rest = bytes(held).split(separator)
        for record in whole:
            yield record.removeprefix(mark) if first else record
            first = False
        held = bytearray(rest)
    if held:
        yield bytes(held).removeprefix(mark) if first else bytes(held)


def gzip_record_scan(files: DataFrame, newline: str = "\r\n", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row ``value`` per record of the gzip archives (path, length), in as many tasks as there are ranges, up to the shuffle's width.

    Defined cases: an empty file has no records; zero bytes behind the last member are left alone; a record may run over several
    members; bytes are taken as they are; a file that breaks off within a member is an error.
    """
    separator = record_separator(newline).encode()

    def batch(values: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, held = [], 0
        for part in batches:
            for path, length, begin in zip(*(c.to_pylist() for c in part.columns)):
                files, place = _open(path)
                with files.open_input_file(place) as file:
                    window, end = _Bytes(file, length, begin), min(length, begin + range_bytes)
                    # a file whose first member is no record still begins at its beginning
                    if begin == 0 and (head := window.peek(len(_MEMBER))) != _MEMBER:
                        if head:
                            raise ValueError(f"{path} is no gzip file")
                        continue
                    if begin and not _first_member(window, end):
                        continue
                    for record in _records(_inflated(window, end), separator):
                        values.append(record)
                        held += len(record)
                        if held >= _BATCH_BYTES:
                            yield batch(values)
                            values, held = [], 0
        if values:
            yield batch(values)

    begins = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))
    ranges = files.where(F.col("length") > 0).select("path", "length", F.explode(begins).alias("begin"))
    spread = ranges.repartition(shuffle_width(files.sparkSession))
    return spread.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))


def write_archives(records: DataFrame, folder: str, compressed: bool = True, newline: str = "\r\n") -> DataFrame:
    """Write record texts ``value`` to one archive per task below ``folder``; returns the stored list of files (path, length).

    Gzip archives have one member for each record. Files are named by task attempt and only listed ones count, so a
    repeated task leaves a file that nobody reads.
    """
    mark = record_separator(newline).encode()[1:]
    end = newline.encode() * 2
    suffix = ".warc.wet.gz" if compressed else ".warc.wet"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}{suffix}"
        out, length = None, 0
        for part in batches:
            for value in part.column(0).to_pylist():
                if out is None:
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                data = mark + (value or b"") + end
                if compressed:
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = packer.compress(data) + packer.flush()
                length += out.write(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([length], pa.int64())], ["path", "length"])

    written = records.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, "path string, length bigint")
    place = f"{folder}-files"
    written.write.parquet(place)
    return records.sparkSession.read.schema("path string, length bigint").parquet(place)
