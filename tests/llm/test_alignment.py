"""Alignment of two tokenizers against a plain version over all links."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from common import AWKWARD, awkward, rows, same

from crawlprism.llm import alignment
from crawlprism.llm.common import bound_batches

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = alignment.byte_letters()
    spelled = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}

    def tokens(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        parts_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) and b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        return ids_a, [spelled[i] for i in ids_a], ids_b, parts_b

    return tokens


def plain(tokens, documents):
    """All links of all documents, held at once."""
    out, counts = [], Counter()
    for doc_id, text in documents:
        data = (" " + (text or "")).encode()
        a, parts_a, b, parts_b = tokens(text) if text else ([], [], [], [])
        if not text or b"".join(parts_a) != data or b"".join(parts_b) != data:
            out.append((doc_id, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(p) for p in parts_a]).tolist(), np.cumsum([len(p) for p in parts_b]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        group_a, group_b = np.searchsorted(common, ends_a).tolist(), np.searchsorted(common, ends_b).tolist()
        said_a, said_b = [[] for _ in common], [[] for _ in common]
        for i, g in zip(a, group_a):
            said_a[g].append(str(i))
        for i, g in zip(b, group_b):
            said_b[g].append(str(i))
        said = [",".join(x) + "|" + ",".join(y) for x, y in zip(said_a, said_b)]
        links = []
        j = 0
        for i, e in enumerate(ends_a):
            start = e - len(parts_a[i])
            while ends_b[j] <= start:
                j += 1
            k = j
            while k < len(b) and ends_b[k] - len(parts_b[k]) < e:
                links.append((a[i], b[k]))
                k += 1
        counts.update(links)
        out.append((doc_id, len(a), len(b), len(common), links, hashlib.sha256(";".join(said).encode()).hexdigest()))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [
        (doc_id, n_a, n_b, n_groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha)
        for doc_id, n_a, n_b, n_groups, links, sha in out
    ]


WORDS = ["the", "l'été", "don't", "naïve", "中文", "\U0001f600", "x" * 30, "1234", "a.b", "--", " ", "　", "\x85", "\x1c", "\t", "_", "ﬁ", "é"]
GAPS = [" ", "  ", "\n", "\n\n", " \n ", "\t", " \t ", "\r\n", "  ", "\x1c ", ""]


def odd(seed: int) -> str:
    pick = random.Random(seed)
    return "".join(pick.choice(WORDS) + pick.choice(GAPS) for _ in range(pick.randrange(1, 40)))


def test_odd_texts(spark, libraries):
    texts = [(i, odd(i)) for i in range(400)]
    texts += [(1000 + i, t) for i, t in enumerate([" ", "  ", "\n", " x", "x ", "x  ", "\nx", "x\n", "\n x", "▁", "a▁b", "<s> </s>", "<|endoftext|>", "<0x41>", "a \n", " \n"])]
    bound_batches(spark)
    got = alignment.digest(alignment.aligned(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)))
    same([[r[c] for c in COLUMNS] for r in got.collect()], plain(libraries, texts))


def test_awkward_rows(spark, libraries):
    bound_batches(spark)
    got = alignment.digest(alignment.aligned(awkward(spark)))
    same([[r[c] for c in COLUMNS] for r in got.collect()], plain(libraries, AWKWARD))


def test_documents(spark, libraries):
    documents = [(r["doc_id"], r["text"]) for r in rows("documents")]
    want = plain(libraries, documents)
    df = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(3)
    bound_batches(spark)
    got = alignment.digest(alignment.aligned(df))
    same([[r[c] for c in COLUMNS] for r in got.collect()], want)


@pytest.fixture(scope="module")
def aligner():
    return alignment._Aligner(public_tokenizers.path(alignment.VOCABULARY_A), public_tokenizers.path(alignment.VOCABULARY_B))


def test_pieces_cover_the_text_in_windows(aligner, monkeypatch):
    assert aligner.cuts
    plain_words = "One word, and another. A line\nand\u00e9, more:\nEnd."
    for text in [plain_words, plain_words * 5, *map(odd, range(60))]:
        for size in (3, 50, 10**6):
            monkeypatch.setattr(alignment, "WINDOW_CHARS", size)
            assert "".join(aligner.spelled(k) for w in aligner.keys(text) for k in w) == " " + text
    assert "another" in [k for w in aligner.keys(plain_words) for k in w]


def test_a_full_memory_keeps_the_frequent_pieces(aligner, monkeypatch):
    texts = [" ".join(f"w{i * k % 97}" for i in range(50)) + " often often" for k in range(1, 30)]
    want = []
    for t in texts:
        codes = np.array([c for w in aligner.keys(t) for c in aligner.numbers(w)])
        aligner.met(np.unique(codes))
        want.append((aligner.sums(aligner.n_a, [codes])[0], aligner.sums(aligner.n_b, [codes])[0], ";".join(aligner.groups[c] for c in codes)))
    monkeypatch.setattr(alignment, "KNOWN_PIECES", 20)
    for t, w in zip(texts, want):
        aligner.make_room()
        assert len(aligner.codes) <= 20
        codes = np.array([c for part in aligner.keys(t) for c in aligner.numbers(part)])
        aligner.met(np.unique(codes))
        assert (aligner.sums(aligner.n_a, [codes])[0], aligner.sums(aligner.n_b, [codes])[0], ";".join(aligner.groups[c] for c in codes)) == w
        pairs = {aligner.codes[k]: aligner.pairs[aligner.ends[aligner.codes[k]] : aligner.ends[aligner.codes[k] + 1]] for k in aligner.codes}
        assert all(len(pairs[c]) == aligner.n_a[c] + aligner.n_b[c] - aligner.n_groups[c] for c in pairs)
    assert "often" in aligner.codes


def test_planes():
    pick = np.random.default_rng(1)
    for n in (1, 5, 4095, 4096, 60_000):
        low = np.sort(pick.choice(alignment.RANGE_DOCUMENTS, n, replace=False))
        times = pick.integers(1, 9, n)
        found = list(alignment.plane_documents(alignment.planes(low, times)))
        back = np.zeros(alignment.RANGE_DOCUMENTS, np.int64)
        for bit, documents in enumerate(found):
            back[documents] += 1 << bit
        assert (back[low] == times).all() and back.sum() == times.sum()
        assert len(set(np.concatenate(found).tolist())) == n


def test_postings_of_several_additions(aligner):
    texts = ["the cat", "the the the dog", "", "a cat and the dog"]
    codes = [np.array([c for w in aligner.keys(t) for c in aligner.numbers(w)], np.int64) if t else np.zeros(0, np.int64) for t in texts]
    one, two = alignment._Range(), alignment._Range()
    one.add(aligner, codes, [bool(t) for t in texts])
    two.add(aligner, codes[:2], [True, True])
    two.add(aligner, codes[2:], [False, True])
    a, b = one.postings(), two.postings()
    assert all((np.array(x) == np.array(y)).all() for x, y in zip(a, b))
    of = {(x, y): (p, d, n) for x, y, p, d, n in zip(*[list(c) for c in a])}
    data, documents, links = max(of.values(), key=lambda v: v[2])
    assert documents == 3 and links == 5 and [d.tolist() for d in alignment.plane_documents(data)] == [[0, 1, 3], [1]]


def test_groups_and_pairs(spark):
    bound_batches(spark)
    df = spark.createDataFrame([(1, "hello hello"), (2, None), (3, "hello")], "doc_id int, text string")
    found = alignment.aligned(df, with_groups=True)
    groups = {r["id"]: r["groups"] for r in found.where("kind = 0").collect()}
    assert groups[2] == "" and groups[1] == groups[3] + ";" + groups[3]
    pairs = alignment.pair_counts(found).collect()
    assert all((r["docs"], r["links"]) == (2, 3) for r in pairs) and pairs
    assert dict(alignment.digest(found).dtypes)["doc_id"] == "int"


def test_empty(spark):
    bound_batches(spark)
    assert alignment.digest(alignment.aligned(spark.createDataFrame([], "doc_id bigint, text string"))).collect() == []
