"""Byte-level BPE over a global table of distinct words.

Texts are split into pre-tokens. A block of whole documents lists its distinct pre-tokens by rank of frequency and
holds its documents as ranks in order, which are the positions. The words of all blocks are dealt by hash: a
word's rows meet in one bucket, where it is encoded once. The ids go back to the blocks, and each block puts its
documents together by position. Decoding looks ids up in the token-byte table.

A word has one row in a block however often it occurs there, so no word is hot. Words and documents leave the
blocks in one shuffle, which both the encoding and the putting together read. A block depends on its partition's rows
alone, which are sorted first, and its name holds a digest of its words: a repeated task makes the same blocks, and a
block that came out otherwise would be reported, not mixed up.

Defined cases: null text is empty and has no ids. Repeated rows give repeated rows. An empty table gives an empty
result. Other columns are not looked at. The vocabulary is a file of ranks; its path is a parameter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from crawlprism.llm.common import kept
from crawlprism.llm.pretokens import splitter

VOCABULARY = "byte_bpe_50k.tiktoken"

# A block closes at this many characters, or pre-tokens.
BLOCK_CHARS = 8 * 1024 * 1024

# About so much text for each bucket of words, and for each partition of the shuffle.
BUCKET_BYTES = 64 * 1024 * 1024
PARTITION_BYTES = 4 * 1024 * 1024


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    build = lambda: tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})
    return kept(("bpe-encoding", path, pattern), build)


def _token_bytes(path: str) -> list[bytes]:
    def build() -> list[bytes]:
        known = ranks(path)
        table = [b""] * (max(known.values()) + 1)
        for token, rank in known.items():
            table[rank] = token
        return table

    return kept(("bpe-bytes", path), build)


def _pack(*arrays: np.ndarray, tail: bytes = b"") -> bytes:
    head = np.array([a.nbytes for a in arrays], np.uint32).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(a.tobytes() for a in arrays) + tail)


def _unpack(data: bytes, *kinds) -> tuple:
    """The arrays that were packed, then the tail."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, np.uint32, len(kinds))
    at, out = 4 * len(kinds), []
    for kind, size in zip(kinds, sizes.tolist()):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return (*out, raw[at:])


class _Codes(dict):
    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        return code


class _Block:
    """Documents on their way into one block."""

    def __init__(self):
        self.codes, self.parts, self.ids, self.chars = _Codes(), [], [], 0

    def add(self, doc_id, words: list[str], chars: int) -> None:
        self.parts.append(np.fromiter(map(self.codes.__getitem__, words), np.uint32, len(words)))
        self.ids.append(doc_id)
        self.chars += chars

    def rows(self, place: str, n_buckets: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        sequence = np.concatenate(self.parts)
        order = np.argsort(-np.bincount(sequence, minlength=len(self.codes)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        words = [w.encode() for w in self.codes]
        digest = xxhash.xxh3_128(rank.tobytes())
        for w in words:
            digest.update(w + b"\xff")
        block = f"{place}-{digest.hexdigest()}"
        bucket = np.fromiter((xxhash.xxh32_intdigest(w) % n_buckets for w in words), np.int64, len(words))
        by_bucket = np.lexsort((rank, bucket))
        starts = np.flatnonzero(np.concatenate(([True], np.diff(bucket[by_bucket]) > 0))) if words else []
        for part in np.split(by_bucket, starts[1:]) if words else ():
            own = [words[i] for i in part.tolist()]
            payload = _pack(rank[part], np.array([len(w) for w in own], np.uint32), tail=b"".join(own))
            yield _row(f"words-{bucket[part[0]]}", block, payload, None, id_type)
        # ranks are kept as planes of bytes, as high bytes are mostly zero
        ranked = rank[sequence] if len(sequence) else sequence
        planes = [((ranked >> np.uint32(8 * i)) & np.uint32(0xFF)).astype(np.uint8) for i in range(4)]
        payload = _pack(np.array([len(p) for p in self.parts], np.uint32), *planes)
        yield _row(block, block, payload, self.ids, id_type)


def _row(key: str, block: str, payload: bytes, doc_ids: list | None, id_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([key]), pa.array([block]), pa.array([payload], pa.binary()), pa.array([doc_ids], pa.list_(id_type))],
        ["key", "block", "payload", "doc_ids"],
    )


def blocks(docs: DataFrame, id_col: str, text_col: str, n_buckets: int, pattern: str) -> DataFrame:
    """(key, block, payload, doc_ids): under a bucket's key the words of a block, under its own its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, block, n = splitter(pattern), _Block(), 0
        partition = TaskContext.get().partitionId()
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block.add(doc_id, split(text), len(text))
                if block.chars >= BLOCK_CHARS:
                    yield from block.rows(f"{partition}-{n}", n_buckets, id_type)
                    block, n = _Block(), n + 1
        if block.ids:
            yield from block.rows(f"{partition}-{n}", n_buckets, id_type)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.sortWithinPartitions("doc_id", "text").mapInArrow(run, f"key string, block string, payload binary, doc_ids array<{kind}>")


def _encode_words(dealt: DataFrame, path: str, pattern: str) -> DataFrame:
    """(key, ids): to each block the ids of its words. Rows come sorted by key; within a bucket a word is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, at, known = _encoding(path, pattern).encode_ordinary, None, {}
        for batch in batches:
            blocks_, payloads = [], []
            for key, block, payload in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if key == block:
                    continue  # documents
                if key != at:
                    at, known = key, {}
                rank, sizes, text = _unpack(payload, np.uint32, np.uint32)
                ends = np.cumsum(sizes, dtype=np.int64)
                found = []
                for start, end in zip((ends - sizes).tolist(), ends.tolist()):
                    word = text[start:end]
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = np.array(encode(word.decode()), np.uint32).tobytes()
                    found.append(ids)
                counts = np.array([len(ids) // 4 for ids in found], np.uint32)
                blocks_.append(block)
                payloads.append(_pack(rank, counts, tail=b"".join(found)))
            yield pa.RecordBatch.from_arrays([pa.array(blocks_, pa.string()), pa.array(payloads, pa.binary())], ["key", "ids"])
        pa.default_memory_pool().release_unused()

    return dealt.mapInArrow(run, "key string, ids binary")


def _assemble(id_type: pa.DataType):
    """The documents of a block as id lists, from its rows and the ids of its words."""

    def run(rows: pa.Table, encoded: pa.Table) -> pa.Table:
        fields = pa.schema([("doc_id", id_type), ("ids", pa.list_(pa.int32()))])
        if not len(rows) or rows.column("key")[0].as_py() != rows.column("block")[0].as_py():
            return fields.empty_table()  # words
        parts = []
        for payload in encoded.column("ids").to_pylist():
            rank, counts, ids = _unpack(payload, np.uint32, np.uint32)
            parts.append((rank, counts, np.frombuffer(ids, np.uint32)))
        row = {name: rows.column(name)[0] for name in ("payload", "doc_ids")}
        return pa.Table.from_batches(_documents(parts, row["payload"].as_py(), row["doc_ids"].values, id_type), fields)

    return run


# Ids that one Arrow batch of the result holds, and pre-tokens that are counted at once: arrays of eight bytes
# for each do not add up to more than a few MB, however large the block.
OUT_IDS = 250_000
COUNTED = 250_000


def _documents(parts: list, payload: bytes, doc_ids: pa.Array, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    n_words = sum(len(rank) for rank, _, _ in parts)
    if parts and not np.array_equal(np.sort(np.concatenate([rank for rank, _, _ in parts])), np.arange(n_words)):
        raise ValueError("a block does not have the words it was made with")
    counts, starts = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64)
    base = 0
    for rank, own, ids in parts:
        counts[rank] = own
        starts[rank] = base + np.cumsum(own, dtype=np.int64) - own
        base += len(ids)
    table = np.concatenate([ids for _, _, ids in parts]) if parts else np.zeros(0, np.uint32)
    lengths, *planes, _ = _unpack(payload, np.uint32, *[np.uint8] * 4)
    if any(int(_ranks(planes, a, a + COUNTED).max()) >= n_words for a in range(0, len(planes[0]), COUNTED)):
        raise ValueError("a block does not have the words it was made with")
    ends = np.cumsum(lengths, dtype=np.int64)
    total = _ids_until(ends, planes, counts)
    first = 0
    while first < len(lengths):
        begun = int(total[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(total, begun + OUT_IDS, side="right")))
        a, b = int(ends[first - 1]) if first else 0, int(ends[last - 1])
        ranked = _ranks(planes, a, b)
        n, at = counts[ranked], starts[ranked]
        shift = np.repeat(at - (np.cumsum(n) - n), n)
        flat = table[shift + np.arange(len(shift))] if len(shift) else table[:0]
        offsets = np.concatenate(([0], total[first:last] - begun)).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32), pa.int32()))
        yield pa.RecordBatch.from_arrays([doc_ids.slice(first, last - first).cast(id_type), ids], ["doc_id", "ids"])
        first = last


def _ids_until(ends: np.ndarray, planes: list[np.ndarray], counts: np.ndarray) -> np.ndarray:
    """Ids up to the end of each document, from its last pre-token's place."""
    total, before = np.zeros(len(ends), np.int64), 0
    for a in range(0, len(planes[0]), COUNTED):
        until = before + np.cumsum(counts[_ranks(planes, a, a + COUNTED)])
        within = slice(np.searchsorted(ends, a, side="right"), np.searchsorted(ends, a + len(until), side="right"))
        total[within] = until[ends[within] - a - 1]
        before = int(until[-1])
    return total


def _ranks(planes: list[np.ndarray], a: int, b: int) -> np.ndarray:
    out = planes[0][a:b].astype(np.uint32)
    for i in (1, 2, 3):
        out |= planes[i][a:b].astype(np.uint32) << np.uint32(8 * i)
    return out


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """(doc_id, ids) of every row."""
    path = path or public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("bigint"))).first()[0] or 0
    n_buckets, n_partitions = max(width, -(-total // BUCKET_BYTES)), max(width, -(-total // PARTITION_BYTES))
    # one shuffle, read twice: the columns are taken as they are, so that Spark sees the same exchange
    dealt = blocks(docs, id_col, text_col, n_buckets, pattern).repartition(n_partitions, "key")
    encoded = _encode_words(dealt.sortWithinPartitions("key"), path, pattern)
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>"
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    return dealt.groupBy("key").cogroup(encoded.groupBy("key")).applyInArrow(_assemble(id_type), schema)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of the ids, by the token-byte table, which every worker reads from the vocabulary."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _token_bytes(path).__getitem__
        for batch in batches:
            column = batch.column(1)
            offsets = column.offsets.to_pylist()
            flat = column.values.to_numpy()
            # the ids of one document at a time are objects
            decoded = [b"".join(map(lookup, flat[a:b].tolist())) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), column, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])
        pa.default_memory_pool().release_unused()

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
