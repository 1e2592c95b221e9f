"""Byte-pair ids and token files against the libraries."""

import base64
import hashlib
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from common import AWKWARD, awkward, same
from tokenizers import Tokenizer

from crawlprism.llm import bpe
from crawlprism.llm import token_files as T
from crawlprism.llm.common import scratch_path
from crawlprism.llm.pretokens import splitter


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_splitter_agrees_on_every_character():
    split, general = splitter(P.PATTERN), regex.compile(P.PATTERN)
    for base in range(0, 256):
        for shape in ("a{}b", " {}{} 1", "{}", "'{}s {}\n"):
            text = shape.replace("{}", chr(base))
            assert split(text) == general.findall(text)
    wide = "".join(chr(c) + " " for c in range(256, 0x3000, 7))
    assert split(wide) == general.findall(wide)


def test_ids_and_bytes(spark, tik):
    got = bpe.digest(bpe.decode(bpe.encode(awkward(spark)))).collect()
    want = []
    for i, t in AWKWARD:
        ids = tik.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    same(got, want)


def test_small_blocks(spark, tik, monkeypatch):
    monkeypatch.setattr(bpe, "OUT_IDS", 50)
    docs = [(1, None), (2, "the cat"), (3, ""), (4, "the cat sat on the mat. " * 30), (5, "the")]
    parts = [np.array([0, 1], np.uint32), np.array([1, 2, 1], np.uint32)]
    table = [(np.array([0, 1, 2], np.uint32), np.array([1, 2, 1], np.uint32), np.array([7, 8, 9, 10], np.uint32))]
    sequence = np.concatenate([parts[0], np.zeros(0, np.uint32), parts[1]])
    planes = [((sequence >> np.uint32(8 * i)) & np.uint32(0xFF)).astype(np.uint8) for i in range(4)]
    import pyarrow as pa

    payload = bpe._pack(np.array([2, 0, 3], np.uint32), *planes)
    found = [r for b in bpe._documents(table, payload, pa.array([5, 6, None]), pa.int64()) for r in b.to_pylist()]
    assert found == [{"doc_id": 5, "ids": [7, 8, 9]}, {"doc_id": 6, "ids": []}, {"doc_id": None, "ids": [8, 9, 10, 8, 9]}]
    got = {r.doc_id: r.ids for r in bpe.encode(awkward(spark, docs)).collect()}
    assert got == {i: tik.encode_ordinary(t or "") for i, t in docs}


def test_large_blocks_take_little_memory():
    """Beside a block's payload, which takes four bytes for each pre-token, only short arrays are held."""
    import tracemalloc

    import pyarrow as pa

    n, pick = 4_000_000, np.random.default_rng(1)
    sequence = pick.integers(0, 1000, n, dtype=np.uint32)
    planes = [((sequence >> np.uint32(8 * i)) & np.uint32(0xFF)).astype(np.uint8) for i in range(4)]
    lengths = np.full(n // 1000, 1000, np.uint32)
    lengths[0], lengths[7], lengths[-1] = 0, 0, 3000
    words = np.arange(1000, dtype=np.uint32)
    table = [(words, np.full(1000, 1, np.uint32) + words % 2, np.repeat(words, 1 + words % 2).astype(np.uint32))]
    payload, ids = bpe._pack(lengths, *planes), pa.array(range(len(lengths)))
    ends = np.cumsum(lengths, dtype=np.int64)
    want = np.diff(np.concatenate(([0], np.concatenate(([0], np.cumsum(1 + sequence % 2)))[ends])))
    tracemalloc.start()
    try:
        sizes = [np.diff(b.column(1).offsets.to_numpy()) for b in bpe._documents(table, payload, ids, pa.int64())]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.concatenate(sizes).tolist() == want.tolist()
    assert peak < 16 * n


def test_empty_tables(spark):
    assert bpe.digest(bpe.decode(bpe.encode(awkward(spark, [])))).collect() == []
    assert T.token_round_trip(awkward(spark, [])).collect() == []


def test_token_files(spark, library):
    docs = [(i, t) for i, t in AWKWARD if i is not None]
    got = sorted(T.token_round_trip(awkward(spark, docs)).collect(), key=lambda r: r.start)
    ids = {}
    for i, t in docs:
        ids.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [0])
    at = 0
    assert [r.doc_id for r in got] == sorted(i for i, _ in docs)
    for r in got:
        own = ids[r.doc_id][0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        at += len(own)


SPECIAL = [(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>x"), (3, "it's<|endoftext|>'s  <|endoftext|>  "), (4, "<|endoftext|"), (5, None), (6, "é  中<|endoftext|>")]


def test_special_strings_as_the_unchanged_library(spark, tmp_path):
    from crawlprism.llm.queries import registry

    awkward(spark, SPECIAL).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in registry["op6_token_files"].build(spark, str(tmp_path)).collect()}
    unchanged, at = Tokenizer.from_file(P.path("byte_bpe_50k.json")), 0
    for i, t in SPECIAL:
        own = unchanged.encode(t or "", add_special_tokens=False).ids + [0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())), t
        at += len(own)


def test_null_ids_sort_first(spark):
    got = sorted(T.token_round_trip(awkward(spark)).collect(), key=lambda r: r.start)
    assert len(got) == len(AWKWARD) and got[0].doc_id is None and got[1].doc_id is None


def test_only_wanted_frames_are_read(spark, library, monkeypatch):
    monkeypatch.setattr(T, "FRAME_BYTES", 4000)
    folder = scratch_path(spark, "tokens-test")
    docs = [(i, t) for i, t in AWKWARD if i is not None]
    manifest = T.write_token_files(awkward(spark, docs).coalesce(1), folder)
    texts = dict(docs)
    for row in manifest.collect():
        files, place = T.file_system(row.path)
        with files.open_input_file(place) as file:
            one = T.TokenFile(file)
            for doc_id, start, n in one.documents():
                one.frame_no, read = -1, []
                whole = one._frame
                one._frame = lambda i: read.append(i) or whole(i)
                data = b"".join(one.tokens(start, n))
                one._frame = whole
                assert np.frombuffer(data, "<u4").tolist() == library.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0]
                first, last = (np.searchsorted(one.plain, at, side="right") - 1 for at in (4 * start, 4 * (start + n) - 1))
                assert read == list(range(first, last + 1))
    some = T.read_token_files(manifest, wanted=[14, 20]).collect()
    assert sorted(r.doc_id for r in some) == [14, 20]


def test_a_damaged_frame_is_reported(tmp_path):
    place = tmp_path / "x"
    with place.open("wb") as out:
        writer = T._Writer(out)
        writer.add(1, struct.pack("<5I", *range(5)))
        import pyarrow as pa

        writer.close(pa.int64())
    from pyarrow import fs

    with fs.LocalFileSystem().open_input_file(str(place)) as file:
        one = T.TokenFile(file)
        one.checksums[0] ^= 1
        with pytest.raises(ValueError):
            one._frame(0)


def test_vocabulary_is_read_from_its_file():
    path = P.path("byte_bpe_50k.tiktoken")
    first = open(path, "rb").readline().split()
    assert bpe.ranks(path)[base64.b64decode(first[0])] == int(first[1])
