"""Removal of repeated byte strings by sorting suffixes, deep-shallow.

A byte goes when it lies in a string of WIDTH bytes that also starts in a document with a smaller id. Whole texts are
judged as they came in.

Sorting every suffix of a corpus would move it many times over. Two equal strings of WIDTH bytes hold the same
minimizer - the smallest of the ANCHOR-byte pieces in them, by a hash - at the same place, so only suffixes that
begin at minimizers need to be sorted:

1. Texts are dealt to blocks of about BLOCK_BYTES. Each block sends the hashes of its anchors, once each; anchors that
   occur in one document only are dropped.
2. For the others the block sends each distinct surrounding (what a WIDTH-byte string around the anchor can cover)
   with its smallest document id. A bucket of anchors sorts the suffixes that begin at them, and the reversed text
   before them: multikey quicksort by symbols of eight bytes down to a shallow depth, then blind tries for what
   still ties. Common-prefix lengths of neighbours give, for every place of the string around the anchor, which
   surroundings agree, and so the smallest id it occurs under.
3. The block compares these ids with those of its documents and removes.

Equal texts stand for each other: all but the one with the smallest id go as a whole. A frequent passage costs one row
for each block and not one for each document. Blocks depend on id and text alone, so they come out the same
when a task is repeated.

Defined cases: null text is empty; texts shorter than WIDTH lose nothing; rows without id neither lose nor cause
anything; rows that share an id do not affect each other. An empty table gives an empty result. Ids are whole numbers.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.llm.common import stored, text_bytes

WIDTH = 50
ANCHOR = 24
REACH = WIDTH - ANCHOR  # bytes before an anchor that a string around it can hold

BLOCK_BYTES = 4 * 1024 * 1024

# Text for each bucket of anchors: about a million of them.
BUCKET_BYTES = 16 * 1024 * 1024

# Bytes that multikey quicksort looks at; blind tries do the rest.
SHALLOW = 32

# Hashes for one slice of text are computed at a time.
SLICE = 2 * 1024 * 1024

HASH_BITS = 48

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


# --- sorting ------------------------------------------------------------------------


def multikey(strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by their first ``depth`` bytes, and the start of each group of ties.

    One symbol is eight bytes. Each pass parts the groups that still tie by their next symbol and leaves the others alone.
    """
    n = len(strings)
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # of each place in the order, the first place of its group
    for at in range(0, depth, 8):
        symbol = np.ascontiguousarray(strings[:, at : at + 8]).view(">u8").ravel().astype(np.uint64)
        sizes = np.bincount(group, minlength=n)
        open_ = np.flatnonzero(sizes[group] > 1)
        if not len(open_):
            break
        rows = order[open_]
        by = np.lexsort((symbol[rows], group[open_]))
        order[open_] = rows[by]
        key, parent = symbol[order[open_]], group[open_]
        new = np.concatenate(([True], (parent[1:] != parent[:-1]) | (key[1:] != key[:-1])))
        group[open_] = open_[np.flatnonzero(new)][np.cumsum(new) - 1]
    return order, np.unique(group)


def blind_order(strings: list[bytes]) -> list[int]:
    """Order of strings of one length by a blind trie.

    An inner node holds the depth where its strings part and a child for each byte there. A new string goes down by those
    bytes alone, is compared with one string at the end, and branches off where the two part.
    """
    bits = 8 * len(strings[0])
    numbers = [int.from_bytes(s) for s in strings]
    root: list = [0]  # a leaf is a list of equal strings; an inner node is a (depth, children) tuple
    for i in range(1, len(strings)):
        s = strings[i]
        path, node = [], root
        while isinstance(node, tuple):
            path.append(node)
            depth, children = node
            node = children.get(s[depth]) or next(iter(children.values()))
        differ = numbers[i] ^ numbers[node[0]]
        if not differ:
            node.append(i)
            continue
        common = (bits - differ.bit_length()) // 8
        other = strings[node[0]]
        above = below = None
        for inner in path:
            if inner[0] >= common:
                below = inner
                break
            above = inner
        if below is not None and below[0] == common:
            below[1][s[common]] = [i]
            continue
        if below is None:
            below = node
        branch = (common, {other[common]: below, s[common]: [i]})
        if above is None:
            root = branch
        else:
            above[1][s[above[0]]] = branch
    out: list[int] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, tuple):
            todo += [node[1][c] for c in sorted(node[1], reverse=True)]
        else:
            out += node
    return out


def deep_shallow(strings: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and the bytes each has in common with the one before it in that order."""
    n, width = strings.shape
    shallow = min(shallow, width - width % 8)
    order, starts = multikey(strings, shallow)
    if width > shallow:
        for a, size in zip(starts.tolist(), np.diff(np.append(starts, n)).tolist()):
            if size > 1:
                rows = order[a : a + size]
                tails = strings[rows, shallow:].tobytes()
                w = width - shallow
                order[a : a + size] = rows[blind_order([tails[i * w : (i + 1) * w] for i in range(size)])]
    common = np.zeros(n, np.int64)
    if n > 1:
        ranked = strings[order]
        differ = ranked[1:] != ranked[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, common


# --- anchors ------------------------------------------------------------------------


def _symbols(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    n = len(data) - 7
    out = np.empty(n, np.uint64)
    raw = data.tobytes()
    for j in range(8):
        count = (n - j + 7) // 8
        if count > 0:
            out[j::8] = np.frombuffer(raw, "<u8", count, j)
    return out


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over every window of ``width`` values."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    return pick(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def minimizers(text: bytes) -> np.ndarray:
    """Places of all smallest ANCHOR-byte pieces of the WIDTH-byte strings of a text; ties are all taken."""
    n = len(text)
    if n < WIDTH:
        return np.zeros(0, np.int64)
    data, span, found = np.frombuffer(text, np.uint8), REACH + 1, []
    for begin in range(0, n - WIDTH + 1, SLICE):
        # a slice holds the strings that start in it
        part = data[begin : begin + SLICE + WIDTH - 1]
        w = _symbols(part)
        count = len(part) - ANCHOR + 1
        h = (w[:count] * _M1) ^ (w[8 : 8 + count] * _M2) ^ (w[16 : 16 + count] * _M3)
        h = ((h ^ (h >> np.uint64(29))) * _M1 >> np.uint64(32)).astype(np.uint32)
        least = _slide(h, span, np.minimum)
        edge = np.zeros(span - 1, np.uint32)
        reached = _slide(np.concatenate([edge, least, edge]), span, np.maximum)
        # a piece is chosen if it is the smallest of some string that holds it
        found.append(np.flatnonzero(reached == h) + begin)
    return np.unique(np.concatenate(found)) if len(found) > 1 else found[0]


class Block:
    """The texts of a block one after the other, and their anchors."""

    def __init__(self, texts: list[bytes]):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        places = [minimizers(t) for t in texts]
        self.doc = np.repeat(np.arange(len(texts)), [len(p) for p in places])
        self.place = np.concatenate(places) if places else np.zeros(0, np.int64)
        pad = np.zeros(WIDTH, np.uint8)
        self.data = np.concatenate([pad, *(np.frombuffer(t, np.uint8) for t in texts), pad])
        at = self._at(np.arange(len(self.place)))
        pieces = np.lib.stride_tricks.sliding_window_view(self.data, ANCHOR)
        self.key = np.empty(len(at), np.uint64)
        for i in range(0, len(at), SLICE):
            w = np.ascontiguousarray(pieces[at[i : i + SLICE]]).view("<u8")
            h = (w[:, 0] * _M2) ^ (w[:, 1] * _M3) ^ (w[:, 2] * _M1)
            h = (h ^ (h >> np.uint64(32))) * _M2
            self.key[i : i + SLICE] = (h ^ (h >> np.uint64(29))) >> np.uint64(64 - HASH_BITS)

    def _at(self, rows: np.ndarray) -> np.ndarray:
        return self.begins[self.doc[rows]] + self.place[rows] + WIDTH

    def surroundings(self, rows: np.ndarray) -> np.ndarray:
        """(row, REACH + WIDTH + 2) bytes: the text around each anchor, zero beyond the document, and how much there is on either side."""
        doc, place, at = self.doc[rows], self.place[rows], self._at(rows)
        before = np.minimum(place, REACH)
        after = np.minimum(self.lengths[doc] - place, WIDTH)
        out = np.empty((len(rows), REACH + WIDTH + 2), np.uint8)
        view = np.lib.stride_tricks.sliding_window_view(self.data, REACH + WIDTH)
        column = np.arange(REACH + WIDTH)
        inside = (column >= (REACH - before)[:, None]) & (column < (REACH + after)[:, None])
        out[:, :-2] = view[at - REACH] * inside
        out[:, -2], out[:, -1] = before, after
        return out


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in byte order, and the number each row has among them."""
    packed = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1]))).ravel()
    found, number = np.unique(packed, return_inverse=True)
    return found.view(np.uint8).reshape(len(found), rows.shape[1]), number.ravel()


def first_documents(around: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each surrounding and each place of the string - o bytes before the anchor - the smallest id it occurs under."""
    none = np.iinfo(np.int64).max
    kinds, number = _distinct(around)
    least = np.full(len(kinds), none, np.int64)
    np.minimum.at(least, number, ids)
    before, after = kinds[:, -2].astype(np.int64), kinds[:, -1].astype(np.int64)
    right = np.ascontiguousarray(kinds[:, REACH:-2])
    left = np.ascontiguousarray(kinds[:, REACH - 1 :: -1][:, :REACH])
    n = len(kinds)
    out = np.full((n, REACH + 1), none, np.int64)
    # surroundings with an anchor of their own need no sorting: the anchor itself is not shared
    r_order, r_common = deep_shallow(right)
    l_order, l_common = deep_shallow(left, REACH - REACH % 8)
    r_rank, l_rank = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(REACH + 1):
        fits = np.flatnonzero((before >= o) & (after >= WIDTH - o))
        if not len(fits):
            continue
        # classes of equal text after and before, by common prefixes of neighbours in the two orders
        r_rank[r_order] = np.cumsum(r_common < WIDTH - o)
        l_rank[l_order] = np.cumsum(l_common < o)
        key = r_rank[fits] * (n + 1) + l_rank[fits]
        _, member = np.unique(key, return_inverse=True)
        low = np.full(int(member.max()) + 1, none, np.int64)
        np.minimum.at(low, member, least[fits])
        out[fits, o] = low[member]
    return out[number]


# --- on Spark -----------------------------------------------------------------------


def _squeeze(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (a.nbytes, a.itemsize))], np.int64).tobytes()
    # planes of bytes: the high ones hardly change
    planes = [np.ascontiguousarray(a.ravel().view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(planes))


def _unsqueeze(data: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * count, 8).reshape(count, 2)
    at, out = 8 * (1 + 2 * count), []
    for kind, (size, item) in zip(kinds, head.tolist()):
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(item, -1)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += size
    return out


_SIDE = "block int, bucket int, doc_id bigint, text_key binary, payload binary"
_PAYLOAD = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])
_PAYLOAD_DDL = "block int, bucket int, payload binary"


class _Given:
    """A block as a task gets it: its documents, those that are copies, and the payloads sent to it."""

    def __init__(self, docs: pa.Table, side: pa.Table):
        self.ids = docs.column("doc_id").to_pylist()
        texts, keys = docs.column("text").to_pylist(), docs.column("text_key").to_pylist()
        self.number = docs.column("block")[0].as_py() if len(docs) else None
        self.texts = texts
        copies, self.payloads = set(), {}
        for bucket, doc_id, key, payload in zip(*(side.column(c).to_pylist() for c in ("bucket", "doc_id", "text_key", "payload"))):
            if bucket is None:
                copies.add((doc_id, key))
            else:
                self.payloads[bucket] = payload
        self.copy = [(i, k) in copies for i, k in zip(self.ids, keys)]
        # copies and rows without id take no part
        self.rows = [i for i, (d, c) in enumerate(zip(self.ids, self.copy)) if d is not None and not c]
        self.block = Block([texts[i] for i in self.rows])
        self.doc_ids = np.array([self.ids[i] for i in self.rows], np.int64)

    def bucket_of(self, keys: np.ndarray, n_buckets: int) -> np.ndarray:
        return ((keys >> np.uint64(HASH_BITS - 32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def _by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of a sorted array."""
    edges = np.flatnonzero(np.concatenate(([True], np.diff(buckets) > 0, [True]))) if len(buckets) else []
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(buckets[a]), slice(int(a), int(b))


def _send_anchors(n_buckets: int):
    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        given = _Given(docs, side)
        block = given.block
        order = np.lexsort((block.doc, block.key))
        key, doc = block.key[order], given.doc_ids[block.doc[order]]
        new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        several = np.zeros(len(first), np.uint8)
        if len(key):
            number = np.cumsum(new) - 1
            several[number[1:][(~new[1:]) & (doc[1:] != doc[:-1])]] = 1
        keys = key[first]
        out = [
            (given.number, bucket, _squeeze(np.diff(keys[part], prepend=np.uint64(0)), several[part]))
            for bucket, part in _by_bucket(given.bucket_of(keys, n_buckets))
        ]
        return _payload_table(out)

    return run


def _payload_table(rows: list[tuple]) -> pa.Table:
    columns = [pa.array([r[i] for r in rows], field.type) for i, field in enumerate(_PAYLOAD)]
    return pa.Table.from_arrays(columns, schema=_PAYLOAD)


def _per_bucket(rows: DataFrame, work) -> DataFrame:
    """``work`` on all (block, payload) of a bucket. Rows come sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for block, bucket, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at:
                    if held:
                        yield from work(at, held)
                    at, held = bucket, []
                held.append((block, payload))
        if held:
            yield from work(at, held)

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _PAYLOAD_DDL)


def _out(bucket: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for block, payload in rows:
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bucket], pa.int32()), pa.array([payload], pa.binary())], schema=_PAYLOAD)


def _shared_anchors(bucket: int, held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """To each block those of its anchors that occur in more than one document."""
    found = [_unsqueeze(payload, np.uint64, np.uint8) for _, payload in held]
    keys = [np.cumsum(steps, dtype=np.uint64) for steps, _ in found]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    tied = np.zeros(len(every), bool)
    same = ranked[1:] == ranked[:-1]
    tied[1:] |= same
    tied[:-1] |= same
    shared = np.empty(len(every), bool)
    shared[order] = tied
    shared |= np.concatenate([several for _, several in found]) > 0

    def rows():
        at = 0
        for (block, _), own in zip(held, keys):
            mine = own[shared[at : at + len(own)]]
            at += len(own)
            if len(mine):
                yield block, _squeeze(np.diff(mine, prepend=np.uint64(0)))

    yield from _out(bucket, rows())


def _candidates(given: _Given, n_buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each bucket the block's anchors (row numbers) that are shared, from the payloads of step 1."""
    block = given.block
    if not given.payloads or not len(block.key):
        return
    shared = np.concatenate([np.cumsum(_unsqueeze(given.payloads[b], np.uint64)[0], dtype=np.uint64) for b in sorted(given.payloads)])
    at = np.searchsorted(shared, block.key)
    rows = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == block.key)
    buckets = given.bucket_of(block.key[rows], n_buckets)
    order = np.argsort(buckets, kind="stable")
    for bucket, part in _by_bucket(buckets[order]):
        yield bucket, rows[order[part]]


def _send_surroundings(n_buckets: int):
    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        given, out = _Given(docs, side), []
        for bucket, rows in _candidates(given, n_buckets):
            around, number = _distinct(given.block.surroundings(rows))
            least = np.full(len(around), np.iinfo(np.int64).max, np.int64)
            np.minimum.at(least, number, given.doc_ids[given.block.doc[rows]])
            out.append((given.number, bucket, _squeeze(around, least)))
        return _payload_table(out)

    return run


def _answer(bucket: int, held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """To each block the smallest ids for its surroundings, in the order it sent them."""
    found = [_unsqueeze(payload, np.uint8, np.int64) for _, payload in held]
    sizes = [len(ids) for _, ids in found]
    around = np.concatenate([a.reshape(len(ids), -1) for a, ids in found])
    first = first_documents(around, np.concatenate([ids for _, ids in found]))

    def rows():
        at = 0
        for (block, _), size in zip(held, sizes):
            yield block, _squeeze(np.ascontiguousarray(first[at : at + size].T))
            at += size

    yield from _out(bucket, rows())


_REMOVED = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _remove(n_buckets: int):
    def run(docs: pa.Table, side: pa.Table) -> pa.Table:
        # payloads of even number are the shared anchors, those of odd number the answers
        answers = {b // 2: p for b, p in zip(side.column("bucket").to_pylist(), side.column("payload").to_pylist()) if b is not None and b % 2}
        shared = side.filter(pa.array([b is None or b % 2 == 0 for b in side.column("bucket").to_pylist()], pa.bool_()))
        place = shared.schema.get_field_index("bucket")
        shared = shared.set_column(place, "bucket", pa.array([None if b is None else b // 2 for b in shared.column("bucket").to_pylist()], pa.int32()))
        given = _Given(docs, shared)
        block = given.block
        begins = np.concatenate((block.begins, [int(block.lengths.sum())]))
        edge = np.zeros(int(block.lengths.sum()) + 1, np.int32)
        for bucket, rows in _candidates(given, n_buckets):
            _, number = _distinct(block.surroundings(rows))
            first = _unsqueeze(answers[bucket], np.int64)[0].reshape(REACH + 1, -1)
            ids, at = given.doc_ids[block.doc[rows]], begins[block.doc[rows]] + block.place[rows]
            for o in range(REACH + 1):
                starts = at[first[o][number] < ids] - o
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + WIDTH, -1)
        gone = np.cumsum(edge[:-1]) > 0
        kept, spans, sizes = [None] * len(given.ids), [None] * len(given.ids), [len(t) for t in given.texts]
        for i, text in enumerate(given.texts):
            whole = given.copy[i] and len(text) >= WIDTH
            kept[i], spans[i] = (b"", [{"start": 0, "end": len(text)}]) if whole else (text, [])
        for j, i in enumerate(given.rows):
            own = gone[begins[j] : begins[j] + block.lengths[j]]
            if own.any():
                turn = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8)))
                spans[i] = [{"start": a, "end": b} for a, b in turn.reshape(-1, 2).tolist()]
                kept[i] = np.frombuffer(given.texts[i], np.uint8)[~own].tobytes()
        return pa.Table.from_arrays(
            [docs.column("doc_id").combine_chunks(), pa.array(sizes, pa.int64()), pa.array(spans, _REMOVED), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "removed", "kept"],
        )

    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): the removed runs (start, end) and the remaining bytes of every row."""
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("bigint"))).first()[0] or 0
    n_blocks, n_buckets = max(width, -(-total // block_bytes)), max(width, -(-total // bucket_bytes))
    text = text_bytes(docs, text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.unhex(F.md5(text)).alias("text_key"), text.alias("text")).withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(n_blocks)).cast("int")
    )
    # the one shuffle of the texts: the three steps below use it
    held = rows.repartition(n_blocks, "block")
    light = rows.where(F.col("doc_id").isNotNull()).select("block", "doc_id", "text_key")
    # stored, so that the join below can split a text that very many rows share
    first = stored(light.groupBy("text_key").agg(F.min("doc_id").alias("first_id")), "repeats-first")
    nothing = {"bucket": F.lit(None).cast("int"), "payload": F.lit(None).cast("binary")}
    copies = (
        light.join(first, "text_key").where(F.col("doc_id") > F.col("first_id")).withColumns(nothing)
        .select("block", "bucket", "doc_id", "text_key", "payload").distinct()
        .select(*[F.col(c).alias(c) for c in ("block", "bucket", "doc_id", "text_key", "payload")])  # columns of its own
    )

    def to_side(payloads: DataFrame, bucket=F.col("bucket")) -> DataFrame:
        return payloads.select("block", bucket.alias("bucket"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("binary").alias("text_key"), "payload")

    def step(side: DataFrame, work, schema: str) -> DataFrame:
        return held.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(work, schema)

    shared = _per_bucket(step(copies, _send_anchors(n_buckets), _PAYLOAD_DDL), _shared_anchors)
    answers = _per_bucket(step(copies.unionByName(to_side(shared)), _send_surroundings(n_buckets), _PAYLOAD_DDL), _answer)
    both = copies.unionByName(to_side(shared, F.col("bucket") * 2)).unionByName(to_side(answers, F.col("bucket") * 2 + 1))
    schema = "doc_id bigint, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary"
    return step(both, _remove(n_buckets), schema)


def digest(found: DataFrame) -> DataFrame:
    n_removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
t AS (SELECT rid, doc_id, h, length(h) // 2 AS n FROM d),
w AS (
  SELECT rid, doc_id, i, substr(h, 2 * i + 1, 100) AS g
  FROM (SELECT rid, doc_id, h, unnest(range(n - 49)) AS i FROM t WHERE n >= 50 AND doc_id IS NOT NULL)),
f AS (SELECT g, min(doc_id) AS first_id FROM w GROUP BY g),
hit AS (SELECT rid, i FROM w JOIN f USING (g) WHERE doc_id > first_id),
apart AS (SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM hit),
run AS (
  SELECT rid, min(i) AS s, max(i) + 50 AS e
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS k FROM apart) GROUP BY rid, k),
removed AS (SELECT rid, sum(e - s) AS n_removed, count(*) AS n_spans FROM run GROUP BY rid),
part AS (
  SELECT rid, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) AS a, s AS b FROM run
  UNION ALL SELECT rid, max(e), NULL FROM run GROUP BY rid),
kept AS (
  SELECT rid, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS k FROM part JOIN t USING (rid) GROUP BY rid)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM t LEFT JOIN removed USING (rid) LEFT JOIN kept USING (rid)
"""
