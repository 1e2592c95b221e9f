"""Alignment of two tokenizers over inverted pair bitmaps.

Both tokenizers cut the same bytes. Where tokens of both end, a group ends; two tokens are linked where their byte ranges overlap. For
each pair of linked ids an inverted index holds the documents, as bitmaps over the documents' numbers: plane j has the documents
that link the pair a number of times with bit j set. The union of a pair's planes, popcounted, is its number of documents; the planes,
popcounted and weighted by their bits, are its number of links. Both add up over the ranges of documents, so a pair that all documents
hold is a row for each range and no range is large. Then the postings return the scores: each bitmap, with its pair's count, goes
to its range of documents and adds the count to every document it holds. Links are never rows.

A range is at most 65,536 consecutive documents of one task, and ends sooner when the task has gathered ``ENTRIES`` postings. Within a
range bitmaps of sparse pairs are sorted 16-bit numbers, others are bits. A worker encodes each distinct piece of text once and
remembers the frequent ones: texts are cut before a space or line end that follows another character, and between a letter and a
stop, where neither tokenizer has a token across (the vocabulary is looked through for such pieces; if there are any, texts stay
whole). Long texts go through in windows.

Defined cases: a text that is null or empty, or whose joined tokens differ from it, has no tokens: zeros, empty groups; a null id is kept;
repeated rows are documents of their own; ties for the best count of an id all count; an empty table gives an empty result; other
columns are not looked at, whatever their names. Special tokens' strings within texts are plain text.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from crawlprism.llm.common import kept, stored
from crawlprism.session import shuffle_width

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"

RANGE_DOCUMENTS = 1 << 16
# Postings that a task gathers before it writes them.
ENTRIES = 2_000_000
WINDOW_CHARS = 1_000_000
# Distinct pieces of text, and characters of them, that a worker knows at a time; half of them outlasts a clearing.
KNOWN_PIECES = 600_000
KNOWN_CHARS = 32_000_000

_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_STOPS = ",.;:!?"
_STOP = re.compile(rf"[{_STOPS}](?<=[{_LETTERS}].)(?=[ \n]|\Z)")
_OTHER_SPACE = re.compile(r"[^\S \n]|\x00")
# Stands for "no space before" at the end of a stop's key, and for "as written" before any other piece's.
_MARK = "\x00"
_BITMAP_BYTES = RANGE_DOCUMENTS // 8


def byte_letters() -> dict[str, int]:
    """The letters of a byte-level vocabulary and their bytes: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Codes(dict):
    """Codes of keys; a new key gets the next one and is noted."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        code = self[key] = len(self)
        self.new.append(key)
        return code


class _Aligner:
    """Groups and links of pieces of text, each worked out once."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        letters = byte_letters()
        self.library = Tokenizer.from_file(path_a)
        self.library.encode_special_tokens = True
        self.bytes_a = {i: bytes(letters[c] for c in token) for token, i in self.library.get_vocab(with_added_tokens=False).items()}
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) or self.model.is_unknown(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.space = self.model.piece_to_id("▁")
        across = re.compile(rf"[^▁]▁|\n| |[{_LETTERS}][{_STOPS}]")
        self.cuts = self.model.encode("\na")[:2] == [self.space, self.model.piece_to_id("<0x0A>")] and not any(map(across.search, pieces))
        if max(self.bytes_a) >= 1 << 23 or len(pieces) >= 1 << 24:
            raise ValueError("a vocabulary is too large for the pair keys")
        self.names = [str(i) for i in range(max(max(self.bytes_a) + 1, len(pieces)))]
        self._clear()

    def _clear(self) -> None:
        self.codes, self.chars, self.hits = _Codes(), 0, np.zeros(0, np.int64)
        self.n_a, self.n_b, self.n_groups, self.good = array("q"), array("q"), array("q"), array("b")
        self.groups: list[str] = []
        self.pairs, self.ends = array("q"), array("q", [0])

    def make_room(self) -> None:
        """Forget the pieces that were met least, when there are too many. Codes given out before do not hold after it."""
        if len(self.codes) <= KNOWN_PIECES and self.chars <= KNOWN_CHARS:
            return
        names, kept_hits = list(self.codes), self.hits
        often = np.argsort(-kept_hits, kind="stable")[: KNOWN_PIECES // 2].tolist()
        often = [i for i in often if len(names[i]) <= 64]
        old = (self.n_a, self.n_b, self.n_groups, self.good, self.groups, self.pairs, self.ends)
        self._clear()
        for i in often:
            self.codes[names[i]] = len(self.codes)
            self.chars += len(names[i])
            for new, known in zip((self.n_a, self.n_b, self.n_groups, self.good, self.groups), old):
                new.append(known[i])
            self.pairs.extend(old[5][old[6][i] : old[6][i + 1]])
            self.ends.append(len(self.pairs))
        self.hits = kept_hits[often] // 2

    def keys(self, text: str) -> Iterator[list[str]]:
        """The text behind a space as keys of pieces, a window at a time."""
        text = " " + text
        if not self.cuts:
            yield [_MARK + text]
            return
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > WINDOW_CHARS:
                cut = _CUT.search(text, at + WINDOW_CHARS)
                end = cut.start() if cut else end
            window = text[at:end]
            yield self._plain_keys(window) or [_MARK + piece for piece in _CUT.split(window)]
            at = end

    @staticmethod
    def _plain_keys(window: str) -> list[str] | None:
        """Keys of a window whose words stand one space or line end apart: the word itself behind a space, or with its line end."""
        body = window[1:] if window[0] == " " else window
        if not body or (window[0] == " " and body[0] in " \n") or body[-1] in " \n" or any(x in body for x in ("  ", "\n\n", " \n", "\n ")) or _OTHER_SPACE.search(body):
            return None
        lines = _STOP.sub(rf" \g<0>{_MARK}", body).split("\n")
        out = lines[0].split(" ") if lines[0] else []
        for line in lines[1:]:
            words = line.split(" ")
            words[0] = "\n" + words[0]
            out += words
        return out

    @staticmethod
    def spelled(key: str) -> str:
        """The piece of text of a key."""
        if key[0] == _MARK:
            return key[1:]
        if key[-1] == _MARK:
            return key[:-1]
        return key if key[0] == "\n" else " " + key

    def numbers(self, keys: list[str]) -> list[int]:
        """A code for each key; those not known are worked out together."""
        out = list(map(self.codes.__getitem__, keys))
        if new := self.codes.new:
            self._work_out(new)
            self.chars += sum(map(len, new))
            self.codes.new = []
        return out

    def met(self, codes: np.ndarray) -> None:
        if len(self.hits) < len(self.codes):
            self.hits = np.concatenate([self.hits, np.zeros(len(self.codes) - len(self.hits), np.int64)])
        self.hits += np.bincount(codes, minlength=len(self.hits))

    @staticmethod
    def sums(known: array, codes: list[np.ndarray]) -> np.ndarray:
        """The sum over each document's pieces."""
        table = np.frombuffer(known, np.int64)
        return np.array([int(table[c].sum()) if len(c) else 0 for c in codes], np.int64)

    def _ids_b(self, pieces: list[str]) -> list[list[int]]:
        """The model puts a space before what it encodes. Where there is none, a line end shields the piece from it, as its
        byte is never merged, and both are taken off again."""
        texts = [p[1:] if p[0] == " " else p if p[0] == "\n" else "\n" + p for p in pieces]
        off = [0 if p[0] == " " else 1 if p[0] == "\n" else 2 for p in pieces]
        return [[self.space] if p == " " else ids[n:] for p, n, ids in zip(pieces, off, self.model.encode(texts, num_threads=1))]

    def _work_out(self, keys: list[str]) -> None:
        pieces = list(map(self.spelled, keys))
        encoded = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        names = self.names
        for piece, found, b in zip(pieces, encoded, self._ids_b(pieces)):
            a, data = found.ids, piece.encode()
            parts_a, parts_b = [self.bytes_a.get(i, b"") for i in a], [self.bytes_b[i] for i in b]
            good = b"".join(parts_a) == data == b"".join(parts_b) and all(parts_a) and all(parts_b)
            groups = []
            if good:
                i = j = first_a = first_b = 0
                end_a, end_b = len(parts_a[0]), len(parts_b[0])
                while True:
                    self.pairs.append(a[i] << 40 | b[j] << 16)
                    if end_a == end_b:
                        i, j = i + 1, j + 1
                        groups.append(",".join([names[x] for x in a[first_a:i]]) + "|" + ",".join([names[x] for x in b[first_b:j]]))
                        if i == len(a):
                            break
                        first_a, first_b = i, j
                        end_a, end_b = end_a + len(parts_a[i]), end_b + len(parts_b[j])
                    elif end_a < end_b:
                        i += 1
                        end_a += len(parts_a[i])
                    else:
                        j += 1
                        end_b += len(parts_b[j])
            self.good.append(good)
            self.ends.append(len(self.pairs))
            self.n_a.append(len(a))
            self.n_b.append(len(b))
            self.n_groups.append(len(groups))
            self.groups.append(";".join(groups))


def planes(low: np.ndarray, times: np.ndarray) -> bytes:
    """The planes of a pair's documents: for each bit of ``times`` a number of documents, then these as 16-bit numbers or as bits."""
    out, left = [], times
    while True:
        here = low[(left & 1).astype(bool)]
        out.append(np.uint32(len(here)).tobytes())
        if 2 * len(here) < _BITMAP_BYTES:
            out.append(here.astype("<u2").tobytes())
        else:
            bits = np.zeros(RANGE_DOCUMENTS, np.uint8)
            bits[here] = 1
            out.append(np.packbits(bits, bitorder="little").tobytes())
        left = left >> 1
        if not left.any():
            return b"".join(out)


def plane_documents(data: bytes) -> Iterator[np.ndarray]:
    """The documents of each plane, in order."""
    at = 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        at += 4
        if 2 * n < _BITMAP_BYTES:
            yield np.frombuffer(data, "<u2", n, at)
            at += 2 * n
        else:
            yield np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, _BITMAP_BYTES, at), bitorder="little"))
            at += _BITMAP_BYTES


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their times."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(keys) else times


class _Range:
    """The postings of consecutive documents."""

    def __init__(self):
        self.keys, self.times, self.documents, self.entries = [], [], 0, 0

    def add(self, aligner: _Aligner, codes: list[np.ndarray], good: list[bool]) -> None:
        """Documents as codes of their pieces; the numbers of the documents go on from what is there."""
        numbers = np.arange(self.documents, self.documents + len(codes))
        self.documents += len(codes)
        with_tokens = [(n, c) for n, c, ok in zip(numbers.tolist(), codes, good) if ok and len(c)]
        if not with_tokens:
            return
        document = np.repeat(np.array([n for n, _ in with_tokens]), [len(c) for _, c in with_tokens])
        both, times = np.unique(document << 32 | np.concatenate([c for _, c in with_tokens]), return_counts=True)
        document, code = both >> 32, both & 0xFFFFFFFF
        aligner.met(code)
        ends = np.frombuffer(aligner.ends, np.int64)
        n_pairs = ends[code + 1] - ends[code]
        place = np.arange(n_pairs.sum()) - np.repeat(np.cumsum(n_pairs) - n_pairs, n_pairs) + np.repeat(ends[code], n_pairs)
        keys = np.frombuffer(aligner.pairs, np.int64)[place] | np.repeat(document, n_pairs)
        keys, times = _summed(keys, np.repeat(times, n_pairs))
        self.keys.append(keys)
        self.times.append(times)
        self.entries += len(keys)

    def postings(self) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """For each pair: both ids, planes, number of documents, number of links."""
        keys, times = _summed(np.concatenate(self.keys), np.concatenate(self.times))
        pair = keys >> 16
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        last = np.append(first[1:], len(keys))
        low = (keys & 0xFFFF).astype(np.int64)
        links = np.add.reduceat(times, first)
        written = [planes(low[s:e], times[s:e]) for s, e in zip(first.tolist(), last.tolist())]
        return pair[first] >> 24, pair[first] & 0xFFFFFF, written, last - first, links


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False, vocabulary_a: str | None = None, vocabulary_b: str | None = None) -> DataFrame:
    """Documents (kind 0) and postings (kind 1) of one pass over the texts.

    Documents: range, number in it, id, token, group and link counts, SHA-256 of the groups and, if asked for, the groups themselves.
    Postings: range, both ids, planes, numbers of documents and links.
    """
    path_a, path_b = vocabulary_a or public_tokenizers.path(VOCABULARY_A), vocabulary_b or public_tokenizers.path(VOCABULARY_B)
    kind = docs.schema[id_col].dataType
    fields = [
        ("kind", pa.int32()), ("range", pa.int64()), ("low", pa.int32()), ("id", to_arrow_type(kind)), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()),
        ("a", pa.int32()), ("b", pa.int32()), ("planes", pa.binary()), ("docs", pa.int64()), ("links", pa.int64()),
    ]
    schema = f"kind int, range bigint, low int, id {kind.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, a int, b int, planes binary, docs bigint, links bigint"

    def batch(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[name], k) if name in columns else pa.nulls(n, k) for name, k in fields], [name for name, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept(("alignment", path_a, path_b), lambda: _Aligner(path_a, path_b))
        base = TaskContext.get().partitionId() << 32
        gathered, number = _Range(), 0

        def close() -> Iterator[pa.RecordBatch]:
            if gathered.entries:
                a, b, written, documents, links = gathered.postings()
                for s in range(0, len(a), 20_000):
                    part = slice(s, s + 20_000)
                    n = len(a[part])
                    yield batch(n, kind=np.ones(n, np.int32), range=np.full(n, base + number), a=a[part].astype(np.int32), b=b[part].astype(np.int32), planes=written[part], docs=documents[part], links=links[part])

        for part in batches:
            texts = part.column(1)
            ids = part.column(0)
            begin = 0
            while begin < len(texts):
                codes, good, digests, groups = [], [], [], []
                chars, at = 0, begin
                aligner.make_room()
                while at < len(texts) and chars < WINDOW_CHARS and gathered.documents + at - begin < RANGE_DOCUMENTS:
                    text = texts[at].as_py() or ""
                    at += 1
                    chars += len(text)
                    whole, ok, running, spelled = [], bool(text), hashlib.sha256(), []
                    for window in aligner.keys(text) if text else ():
                        of = aligner.numbers(window)
                        ok = ok and all(map(aligner.good.__getitem__, of))
                        if not ok:
                            break
                        said = ";".join(map(aligner.groups.__getitem__, of))
                        running.update((";" if whole else "").encode() + said.encode())
                        if with_groups:
                            spelled.append(said)
                        whole.append(np.array(of, np.int64))
                    code = np.concatenate(whole) if ok and whole else np.zeros(0, np.int64)
                    codes.append(code)
                    good.append(ok)
                    digests.append(running.hexdigest() if ok else "")
                    groups.append(";".join(spelled) if ok else "")
                n = at - begin
                sums = [aligner.sums(known, codes) for known in (aligner.n_a, aligner.n_b, aligner.n_groups)]
                lows = np.arange(gathered.documents, gathered.documents + n, dtype=np.int32)
                extra = {"groups": groups} if with_groups else {}
                yield batch(n, kind=np.zeros(n, np.int32), range=np.full(n, base + number), low=lows, id=ids.slice(begin, n), n_a=sums[0], n_b=sums[1], n_groups=sums[2], n_links=sums[0] + sums[1] - sums[2], groups_sha256=digests, **extra)
                gathered.add(aligner, codes, good)
                if gathered.entries >= ENTRIES or gathered.documents >= RANGE_DOCUMENTS:
                    yield from close()
                    gathered, number = _Range(), number + 1
                begin = at
        yield from close()
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    return stored(rows, "alignment")


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, docs, links, best): each linked pair's documents and links, and whether it has the most links of its ``b``."""
    counts = found.where("kind = 1").groupBy("a", "b").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    counts = stored(counts, "alignment-pairs")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return stored(counts.join(most, "b").select("a", "b", "docs", "links", (F.col("links") == F.col("most")).alias("best")), "alignment-scores")


def scored(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """The documents with ``n_best`` and ``count_sum``, returned by the postings.

    A range's bitmaps come to its documents one by one; the task holds two numbers for each document of the range.
    """
    id_type = found.schema["id"].dataType
    documents = found.where("kind = 0").select("range", "kind", "low", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", F.lit(None).cast("binary").alias("planes"), F.lit(None).cast("bigint").alias("count"), F.lit(None).cast("boolean").alias("best"))
    postings = found.where("kind = 1").select("range", "a", "b", "planes").join(pairs.select("a", "b", F.col("links").alias("count"), "best"), ["a", "b"])
    empty = {name: F.lit(None).cast(documents.schema[name].dataType).alias(name) for name in ("low", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")}
    postings = postings.select("range", F.lit(1).alias("kind"), *empty.values(), "planes", "count", "best")
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"]
    schema = f"id {id_type.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, n_best bigint, count_sum bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, best, total = None, [], None, None

        def close() -> Iterator[pa.RecordBatch]:
            if not rows:
                return
            whole = pa.Table.from_batches(rows)
            low = whole.column("low").to_numpy()
            for out in whole.select(names).append_column("n_best", pa.array(best[low])).append_column("count_sum", pa.array(total[low])).to_batches():
                yield out

        for part in batches:
            # the rows of a range stand together, its documents first
            ranges, kinds = part.column("range").to_numpy(), part.column("kind").to_numpy()
            edges = np.flatnonzero((ranges[1:] != ranges[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(ranges)]) if len(ranges) else ():
                if ranges[s] != key:
                    yield from close()
                    key, rows = ranges[s], []
                    best, total = np.zeros(RANGE_DOCUMENTS, np.int64), np.zeros(RANGE_DOCUMENTS, np.int64)
                run_of = part.slice(s, e - s)
                if kinds[s] == 0:
                    rows.append(run_of)
                    continue
                for data, count, is_best in zip(run_of.column("planes").to_pylist(), run_of.column("count").to_pylist(), run_of.column("best").to_pylist()):
                    for bit, low in enumerate(plane_documents(data)):
                        total[low] += count << bit
                        if is_best:
                            best[low] += 1 << bit
        yield from close()

    width = shuffle_width(found.sparkSession)
    together = documents.unionByName(postings).repartition(width, "range").sortWithinPartitions("range", "kind")
    return together.mapInArrow(run, schema)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The columns of the registered query."""
    return scored(found, pair_counts(found)).select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
