"""Token ids as binary files: independent zstandard frames, a document index and a trailing seek table.

A file holds the ids of its documents, in ascending id order, as little-endian unsigned 32-bit integers. Each frame
is compressed on its own and has a checksum in the seek table, which is the one of the seekable zstandard format, so
any reader of that format can use the files. Between the data and the seek table a skippable frame holds the index:
document id, first id and number of ids. A reader decompresses only the frames of the documents it wants.

Defined cases: null text is empty and gives the end id alone; null ids sort first; rows that share an id lie side by
side; an empty table gives no file and an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlprism.llm.common import scratch_path, stored
from crawlprism.llm.pretokens import splitter
from crawlprism.llm.warc import file_system

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
FRAME_BYTES = 1024 * 1024

# Words whose ids a worker remembers; others are encoded each time.
CACHED_WORDS = 500_000

# The seekable format.
_SKIPPABLE_INDEX, _SKIPPABLE_SEEK, _SEEK_MAGIC, _WITH_CHECKSUM = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80


class _Words(dict):
    """The ids of a pre-token as bytes, from the library's model; the frequent ones are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.model = self.library.model
        added = self.library.get_added_tokens_decoder()
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        # leftmost, then longest, as the library finds them
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        # tokens that take more than their own text with them are left to the library
        self.plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        self.whole = None if self.plain else Tokenizer.from_file(path)
        # the byte-level alphabet, from the library's own view of each byte that UTF-8 text can hold
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: spell.pre_tokenize_str(chr(c))[0][0] for c in range(128)}

    def __missing__(self, word: str) -> bytes:
        if word.isascii():
            tokens = self.model.tokenize(word.translate(self.letters))
            ids = np.array([t.id for t in tokens], "<u4").tobytes()
        else:
            ids = np.array(self.library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids


@lru_cache(1)
def _words(path: str) -> _Words:
    return _Words(path)


def encode_text(text: str, path: str, pattern: str = public_tokenizers.PATTERN, special: bool = False) -> bytes:
    """Ids of a text as bytes; each pre-token is encoded by itself, as the library does.

    With ``special``, the added tokens of the file have their own ids where they stand in a text, as in the library's plain
    ``encode``; otherwise they are ordinary text.
    """
    words = _words(path)
    if special and words.split and words.split.search(text):
        if not words.plain:
            return np.array(words.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        parts = words.split.split(text)
        return b"".join(words.added[part] if i % 2 else encode_text(part, path, pattern) for i, part in enumerate(parts))
    return b"".join(map(words.__getitem__, splitter(pattern)(text)))


class _Writer:
    def __init__(self, out):
        self.out, self.buffer, self.seek = out, bytearray(), []
        self.ids, self.starts, self.counts, self.at = [], [], [], 0
        self.packer = zstandard.ZstdCompressor(level=3)

    def add(self, doc_id, data: bytes) -> None:
        self.ids.append(doc_id)
        self.starts.append(self.at)
        self.counts.append(len(data) // 4)
        self.at += len(data) // 4
        self.buffer += data
        while len(self.buffer) >= FRAME_BYTES:
            self._frame(bytes(self.buffer[:FRAME_BYTES]))
            del self.buffer[:FRAME_BYTES]

    def _frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.seek.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self, id_type: pa.DataType) -> None:
        if self.buffer:
            self._frame(bytes(self.buffer))
        index = pa.RecordBatch.from_arrays(
            [pa.array(self.ids, id_type), pa.array(self.starts, pa.int64()), pa.array(self.counts, pa.int64())], ["doc_id", "start", "n_tokens"]
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_batch(index)
        packed = self.packer.compress(sink.getvalue().to_pybytes())
        self.out.write(struct.pack("<II", _SKIPPABLE_INDEX, len(packed)) + packed)
        entries = b"".join(struct.pack("<III", *e) for e in self.seek)
        footer = struct.pack("<IBI", len(self.seek), _WITH_CHECKSUM, _SEEK_MAGIC)
        self.out.write(struct.pack("<II", _SKIPPABLE_SEEK, len(entries) + len(footer)) + entries + footer)
        # the index is found from the end of the frames, which the seek table gives


def write_token_files(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = END_ID,
    special: bool = False,
) -> DataFrame:
    """Encode and write all rows; the manifest (file, path, documents, tokens) is stored beside the files.

    The texts are range-partitioned by id, so the files follow each other in order. Rows of one id are spread by
    their text's hash. A repeated task writes a file of another name; the manifest names the one that counts.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, root = file_system(folder)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.tok.zst"
        out = writer = id_type = None
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if writer is None:
                    files.create_dir(root, recursive=True)
                    out, id_type = files.open_output_stream(f"{root}/{name}", compression=None), batch.column(0).type
                    writer = _Writer(out)
                writer.add(doc_id, encode_text(text, path, special=special) + end)
        if writer is None:
            return
        writer.close(id_type)
        out.close()
        columns = [pa.array([task.partitionId()], pa.int64()), pa.array([f"{folder}/{name}"]), pa.array([len(writer.ids)], pa.int64()), pa.array([writer.at], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["file", "path", "documents", "tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.withColumn("_spread", F.xxhash64("text")).repartitionByRange("doc_id", "_spread").sortWithinPartitions("doc_id", "_spread")
    written = ordered.select("doc_id", "text").mapInArrow(run, "file bigint, path string, documents bigint, tokens bigint")
    return stored(written, "token-manifest")


class TokenFile:
    """Random access to one file: the seek table and the index are read first, frames when a document needs them."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != _SEEK_MAGIC or flags != _WITH_CHECKSUM:
            raise ValueError("not a seekable file with checksums")
        table = self._read(size - 9 - 12 * n - 8, 12 * n + 8)
        entries = np.frombuffer(table, "<u4", 3 * n, 8).reshape(n, 3).astype(np.int64)
        self.packed = np.concatenate(([0], np.cumsum(entries[:, 0])))
        self.plain = np.concatenate(([0], np.cumsum(entries[:, 1])))
        self.checksums = entries[:, 2].tolist()
        kind, length = struct.unpack("<II", self._read(int(self.packed[-1]), 8))
        if kind != _SKIPPABLE_INDEX:
            raise ValueError("the index is missing")
        self.unpacker = zstandard.ZstdDecompressor()
        index = self.unpacker.decompress(self._read(int(self.packed[-1]) + 8, length))
        self.index = pa.ipc.open_stream(index).read_all()
        self.frame_no, self.frame = -1, b""

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def _frame(self, i: int) -> bytes:
        if i != self.frame_no:
            data = self.unpacker.decompress(self._read(int(self.packed[i]), int(self.packed[i + 1] - self.packed[i])))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checksums[i]:
                raise ValueError(f"frame {i} does not match its checksum")
            self.frame_no, self.frame = i, data
        return self.frame

    def tokens(self, start: int, n: int) -> Iterator[bytes]:
        """The ids from ``start`` on, as bytes, frame by frame."""
        at, end = 4 * start, 4 * (start + n)
        while at < end:
            i = int(np.searchsorted(self.plain, at, side="right")) - 1
            stop = min(end, int(self.plain[i + 1]))
            yield self._frame(i)[at - int(self.plain[i]) : stop - int(self.plain[i])]
            at = stop

    def documents(self, wanted: Iterable | None = None) -> Iterator[tuple[object, int, int]]:
        """(doc_id, start, n_tokens) of all or of the wanted documents, from the index alone."""
        some = None if wanted is None else set(wanted)
        for row in zip(*(self.index.column(c).to_pylist() for c in range(3))):
            if some is None or row[0] in some:
                yield row


def read_token_files(manifest: DataFrame, kind: str = "bigint", wanted: list | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files; ``start`` counts the ids of all files before.

    ``wanted`` restricts the documents, and then only their frames are decompressed. The running sum is over one row
    for each file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for path, before in zip(*(c.to_pylist() for c in part.columns)):
                files, place = file_system(path)
                ids, starts, counts, sums = [], [], [], []
                with files.open_input_file(place) as file:
                    tokens = TokenFile(file)
                    for doc_id, start, n in tokens.documents(wanted):
                        crc = 0
                        for piece in tokens.tokens(start, n):
                            crc = zlib.crc32(piece, crc)
                        ids.append(doc_id)
                        starts.append(before + start)
                        counts.append(n)
                        sums.append(crc)
                    id_type = tokens.index.schema.field("doc_id").type
                columns = [pa.array(ids, id_type), *(pa.array(c, pa.int64()) for c in (starts, counts, sums))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    before = F.sum("tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.select("path", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.repartition(spread).mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, special: bool = False) -> DataFrame:
    """Write all rows to token files in the shared folder and read them back. ``special`` is that of encode_text."""
    manifest = write_token_files(docs, scratch_path(docs.sparkSession, "tokens"), id_col, text_col, path, special=special)
    return read_token_files(manifest, docs.schema[id_col].dataType.simpleString())
