"""Repeated byte strings against a plain removal, and the sorts by themselves."""

import hashlib
import random

import numpy as np
from common import AWKWARD, PASSAGE, awkward, prose, rows, same

from crawlprism.llm import suffix_dedup as S


def plain(docs):
    where = {}
    for doc_id, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - 49):
            if doc_id is not None:
                s = data[i : i + 50]
                where[s] = min(doc_id, where.get(s, doc_id))
    out = []
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if doc_id is not None and where[data[i : i + 50]] < doc_id:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), len([r for r in bytes(gone).split(b"\0") if r]), hashlib.sha256(kept).hexdigest()))
    return out


def pieces(seed, n):
    """Texts that share passages of about the width, cut at every place."""
    pick = random.Random(seed)
    source = prose(seed, 400)
    out = []
    for i in range(n):
        at, size = pick.randrange(1500), pick.choice([40, 48, 49, 50, 51, 52, 60, 73, 74, 75, 120])
        out.append(prose(1000 + seed + i, 10) + source[at : at + size] + prose(2000 + seed + i, 10) + PASSAGE[: pick.randrange(120)])
    return out


def test_awkward_rows(spark):
    same(S.digest(S.without_repeats(awkward(spark))).collect(), plain(AWKWARD))


def test_passages_at_every_offset(spark):
    docs = [(i * 3 % 97, t) for i, t in enumerate(pieces(50, 90))] + [(200 + i, "ab" * (24 + i) + str(i)) for i in range(6)]
    got = S.without_repeats(awkward(spark, docs), block_bytes=2000, bucket_bytes=3000)
    same(S.digest(got).collect(), plain(docs))
    for r in got.collect():
        text = dict(docs)[r.doc_id].encode()
        assert bytes(r.kept) == b"".join(text[a:b] for a, b in zip([0, *(s["end"] for s in r.removed)], [*(s["start"] for s in r.removed), len(text)]))


def test_empty_table(spark):
    assert S.without_repeats(awkward(spark, [])).collect() == []


def test_slices_give_the_same_anchors(monkeypatch):
    text = prose(8, 3000).encode() + b"a" * 500
    whole = S.minimizers(text)
    monkeypatch.setattr(S, "SLICE", 777)
    assert S.minimizers(text).tolist() == whole.tolist()


def test_every_string_has_an_anchor():
    text = prose(12, 500).encode()
    places = S.minimizers(text)
    for i in range(len(text) - S.WIDTH + 1):
        assert ((places >= i) & (places <= i + S.REACH)).any()


def test_sorts():
    pick = random.Random(4)
    for _ in range(200):
        n, width, letters = pick.randint(1, 50), pick.randint(9, 50), pick.choice([b"a", b"ab", b"\0\xff", bytes(range(256))])
        stem = bytes(pick.choice(letters) for _ in range(width))
        strings = [stem[: (k := pick.randint(0, width))] + bytes(pick.choice(letters) for _ in range(width - k)) for _ in range(n)]
        grid = np.frombuffer(b"".join(strings), np.uint8).reshape(n, width)
        order, common = S.deep_shallow(grid, pick.choice([8, 16, 32, 48]))
        ranked = [strings[i] for i in order]
        assert ranked == sorted(strings) and sorted(order.tolist()) == list(range(n))
        for a, b, c in zip(ranked, ranked[1:], common[1:]):
            assert c == next((i for i in range(width) if a[i] != b[i]), width)
        assert [strings[i] for i in S.blind_order(strings)] == sorted(strings)


def test_supplied_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in rows("documents")]
    same(S.digest(S.without_repeats(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))).collect(), plain(docs))
