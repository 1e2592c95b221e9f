"""Prefix trie of conversations by truncation peeling.

The deepest conversations come first. At each depth, the conversations that end there are merged with the nodes that survived from
below; the last turn is struck off and what then has the same turns is grouped again. A node is complete when its depth is done,
so counts, leaves and savings are summed while the nodes are being found.

A turn is known by a digest, a prefix by a chained digest, so texts are read once and never shuffled. The chain of a conversation
is stored as slices, one for each range of depths, and a round works on one range: depths up to 1, 2, 4, and so on, doubling up
to ``MAX_SLICE`` levels. Whatever survives joins its slice by the smallest conversation that it stands for. Within a range, nodes that
share the prefix at its upper end are peeled together in one task, level by level. Where one prefix has more than ``GROUP_LEVELS``
turns below it in the range, the range is halved for it, down to single levels, which are grouped by Spark with partial sums. So
neither a first turn that all conversations share nor copies of one conversation fill a task; equal conversations are one weighted row.

The ids of the conversations that end at a node are digested in order: sorted ids are packed into pieces of text, spread over tasks,
and a node's pieces are then hashed one by one, so a task holds one piece at a time.

Defined cases: a row without conversation id belongs to no conversation; null role or text is empty; turns of equal number, null
included, stand in order of their digest; repeated rows are turns of their own; a conversation may have no turn after the
rebuilding and is then a member of the root only; an empty table gives no rows, not even a root; a conversation with very many
turns takes more rounds, not more memory; columns other than the four are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlprism.llm.common import stored
from crawlprism.session import shuffle_width

# Bytes of a prefix digest.
WIDTH = 16
MAX_SLICE = 4096
# Turns below one prefix that a task peels at a time.
GROUP_LEVELS = 100_000
# Ids in one piece of text.
PIECE_IDS = 4096

ROOT = b"\x00" * WIDTH

NODES = (
    "hash binary, parent binary, conv bigint, depth int, n bigint, children bigint, leaves bigint, saved bigint, ends string"
)


def rebuilt(conversations: DataFrame, heads: int = 6, group: int = 100) -> DataFrame:
    """(conv, pos, turn digest, code points) of the rebuilt conversations, and a row with pos 0 for each conversation.

    A conversation c takes its first ``crc32(c) % heads`` turns from conversation ``c - c % group``, and its others from itself.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").alias("turn"),
        F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)).alias("t"),
        F.char_length(text).cast("bigint").alias("size"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "t")
    placed = stored(turns.select("conv", F.row_number().over(order).alias("pos"), "t", "size"), "trie-turns")
    h = F.crc32(F.col("conv").cast("string")) % heads
    own = placed.where(F.col("pos") > h)
    each = placed.where(F.col("pos") == 1).select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("host"))
    first = placed.where((F.col("pos") < heads) & (F.col("conv") % group == 0)).select(F.col("conv").alias("host"), "pos", "t", "size")
    lent = each.where("h > 0").join(first, "host").where(F.col("pos") <= F.col("h")).select("conv", "pos", "t", "size")
    start = each.select("conv", F.lit(0).alias("pos"), F.lit(b"").alias("t"), F.lit(0).cast("bigint").alias("size"))
    return own.unionByName(lent).unionByName(start)


def bounds(depth: int) -> list[int]:
    """Upper ends of the ranges up to a depth: range k holds the depths above bounds[k] up to bounds[k + 1]."""
    out = [0, 1]
    while out[-1] < depth:
        out.append(out[-1] + min(out[-1], MAX_SLICE))
    return out


def paths(turns: DataFrame) -> DataFrame:
    """Slices of each conversation's chain: (conv, lo, hashes, sizes, depth, last).

    ``hashes`` has the prefix at ``lo`` and those of the range after it; ``depth`` and the whole chain's digest
    ``last`` stand on the final slice alone. The rows arrive sorted; a task holds one slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, depth, chain, lo, hi, hashes, sizes = None, 0, ROOT, 0, 1, [], []

        def close(final: bool):
            out.append((conv, lo, b"".join(hashes), np.array(sizes, ">i8").tobytes(), depth if final else None, chain if final else None))

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
            columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv", "lo", "hashes", "sizes", "depth", "last"])

        for part in batches:
            for c, pos, t, size in zip(*(column.to_pylist() for column in part.columns)):
                if pos == 0:
                    if conv is not None:
                        close(True)
                    conv, depth, chain, lo, hi, hashes, sizes = c, 0, ROOT, 0, 1, [ROOT], []
                    continue
                if depth == hi:
                    close(False)
                    lo, hi = hi, hi + min(hi, MAX_SLICE)
                    hashes, sizes = [chain], []
                chain = hashlib.sha256(chain + t).digest()[:WIDTH]
                depth += 1
                hashes.append(chain)
                sizes.append(size)
                if len(out) >= 4096:
                    yield batch()
        if conv is not None:
            close(True)
        if out:
            yield batch()

    width = shuffle_width(turns.sparkSession)
    sorted_turns = turns.select("conv", "pos", "t", "size").repartition(width, "conv").sortWithinPartitions("conv", "pos")
    return sorted_turns.mapInArrow(run, "conv bigint, lo int, hashes binary, sizes binary, depth int, last binary")


def ends(finals: DataFrame) -> DataFrame:
    """One row for each distinct whole conversation: digest, depth, smallest conv, count, SHA-256 of the ids in order.

    Ids are sorted over all tasks and packed into pieces first; a node's pieces come to one task in order and only the running digest
    is kept. SHA-256 takes its bytes in sequence, so this last step cannot be split further.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        key = None

        def piece() -> tuple:
            return (*key, held[0], len(held), ",".join(map(str, held)))

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["last", "depth", "conv", "n", "ids"])

        for part in batches:
            rows = []
            for last, depth, conv in zip(*(column.to_pylist() for column in part.columns)):
                if (last, depth) != key or len(held) >= PIECE_IDS:
                    if held:
                        rows.append(piece())
                    key, held = (last, depth), []
                held.append(conv)
            if rows:
                yield batch(rows)
        if held:
            yield batch([piece()])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, conv, n, running = None, None, 0, None
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["last", "depth", "conv", "n", "ends"])
            rows.clear()
            return out

        for part in batches:
            for last, depth, first, count, ids in zip(*(column.to_pylist() for column in part.columns)):
                if (last, depth) != key:
                    if running is not None:
                        rows.append((*key, conv, n, running.hexdigest()))
                    key, conv, n, running = (last, depth), first, 0, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.encode())
                n += count
            if rows:
                yield batch()
        if running is not None:
            rows.append((*key, conv, n, running.hexdigest()))
            yield batch()

    width = shuffle_width(finals.sparkSession)
    ranged = finals.select("last", "depth", "conv").repartitionByRange(width, "last", "conv").sortWithinPartitions("last", "conv")
    pieces = ranged.mapInArrow(pack, "last binary, depth int, conv bigint, n bigint, ids string")
    in_order = pieces.repartition(width, "last").sortWithinPartitions("last", "conv")
    return in_order.mapInArrow(digest, "last binary, depth int, conv bigint, n bigint, ends string")


def _at(column: str, depth: int | Column, lo: int) -> Column:
    """The digest of the prefix at a depth, out of a slice that begins at ``lo``."""
    return F.substring(column, (F.lit(depth) - lo) * WIDTH + 1, F.lit(WIDTH))


def _one_level(rows: DataFrame, depth: int, lo: int) -> DataFrame:
    """The nodes of one depth, from all rows that add to them; sums are partial before the shuffle."""
    size = _number("sizes", depth - lo - 1)
    summed = (
        rows.select(_at("hashes", depth, lo).alias("hash"), _at("hashes", depth - 1, lo).alias("parent"), size.alias("size"), "conv", "n", "child", "leaves", "saved", "ends")
        .groupBy("hash")
        .agg(
            F.min("parent").alias("parent"), F.min("conv").alias("conv"), F.sum("n").alias("n"), F.sum("child").alias("children"), F.sum("leaves").alias("leaves"),
            F.sum("saved").alias("saved"), F.max("ends").alias("ends"), F.max("size").alias("size"),
        )
    )
    return summed.select(
        "hash", "parent", "conv", F.lit(depth).alias("depth"), "n", "children",
        F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("bigint").alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("saved"), "ends",
    )


def _number(column: str, index: int) -> Column:
    """Number ``index`` of an array of big-endian 64-bit numbers."""
    return F.conv(F.hex(F.substring(column, index * 8 + 1, 8)), 16, 10).cast("bigint")


def _peel(group: list[tuple], lo: int, slice_lo: int) -> Iterator[tuple]:
    """The nodes below ``lo`` of rows that share the prefix there, deepest first.

    A row is (top, hashes, sizes, conv, n, child, leaves, saved, ends); both arrays begin at ``slice_lo``.
    """
    by_top: dict[int, list[tuple]] = {}
    for row in group:
        by_top.setdefault(row[0], []).append(row)
    surviving: list[tuple] = []
    for depth in range(max(by_top), lo, -1):
        at, size_at = (depth - slice_lo) * WIDTH, (depth - slice_lo - 1) * 8
        nodes: dict[bytes, list] = {}
        for _, hashes, sizes, conv, n, child, leaves, saved, end in [*by_top.pop(depth, ()), *surviving]:
            node = nodes.get(key := hashes[at : at + WIDTH])
            if node is None:
                nodes[key] = [hashes, sizes, conv, n, child, leaves, saved, end]
                continue
            if conv < node[2]:
                node[0], node[1], node[2] = hashes, sizes, conv
            node[3] += n
            node[4] += child
            node[5] += leaves
            node[6] += saved
            node[7] = node[7] or end
        surviving = []
        for key, (hashes, sizes, conv, n, children, leaves, saved, end) in nodes.items():
            leaves = leaves if children else 1
            saved += (n - 1) * int.from_bytes(sizes[size_at : size_at + 8], "big")
            yield key, hashes[at - WIDTH : at], conv, depth, n, children, leaves, saved, end
            surviving.append((depth - 1, hashes, sizes, conv, n, 1, leaves, saved, None))


def _together(rows: DataFrame, lo: int, slice_lo: int) -> DataFrame:
    """All nodes below ``lo``; rows that share the prefix there are peeled in one task, one group at a time."""
    fields = [("hash", pa.binary()), ("parent", pa.binary()), ("conv", pa.int64()), ("depth", pa.int32()), ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())]

    def batch(out: list[tuple]) -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, (_, kind) in enumerate(fields)], [name for name, _ in fields])
        out.clear()
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, out = None, [], []
        for part in batches:
            for base, *row in zip(*(column.to_pylist() for column in part.columns)):
                if base != key:
                    if group:
                        out.extend(_peel(group, lo, slice_lo))
                        if len(out) >= 10_000:
                            yield batch(out)
                    key, group = base, []
                group.append(row)
        if group:
            out.extend(_peel(group, lo, slice_lo))
        if out:
            yield batch(out)

    width = shuffle_width(rows.sparkSession)
    columns = ["base", "top", "hashes", "sizes", "conv", "n", "child", "leaves", "saved", "ends"]
    return rows.select(columns).repartition(width, "base").sortWithinPartitions("base").mapInArrow(run, NODES)


def _entering(nodes: DataFrame, depth: int) -> DataFrame:
    """The nodes of a depth with their last turn struck off."""
    return nodes.where(F.col("depth") == depth).select(
        "conv", F.lit(depth - 1).alias("top"), "n", F.lit(1).cast("bigint").alias("child"), "leaves", "saved", F.lit(None).cast("string").alias("ends")
    )


def _range(entering: DataFrame, slices: DataFrame, lo: int, hi: int, slice_lo: int, group_levels: int) -> list[DataFrame]:
    """Stored nodes of the depths above ``lo`` up to ``hi``, from rows that add to those depths."""
    rows = entering.join(slices, "conv")
    if hi - lo == 1:
        return [stored(_one_level(rows, hi, slice_lo), "trie-nodes")]
    rows = stored(rows.withColumn("base", _at("hashes", lo, slice_lo)), "trie-rows")
    crowded = rows.groupBy("base").agg(F.sum(F.col("top") - lo).alias("levels")).where(F.col("levels") > group_levels).select("base")
    crowded = stored(crowded, "trie-crowded")
    if crowded.isEmpty():
        return [stored(_together(rows, lo, slice_lo), "trie-nodes")]
    out = [stored(_together(rows.join(crowded, "base", "left_anti"), lo, slice_lo), "trie-nodes")]
    heavy = rows.join(crowded, "base", "left_semi").select(entering.columns)
    middle = (lo + hi) // 2
    lower = _range(heavy.where(F.col("top") > middle), slices, middle, hi, slice_lo, group_levels)
    above = heavy.where(F.col("top") <= middle)
    for nodes in lower:
        above = above.unionByName(_entering(nodes, middle + 1))
    return out + lower + _range(above, slices, lo, middle, slice_lo, group_levels)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def trie(turns: DataFrame, group_levels: int = GROUP_LEVELS) -> DataFrame:
    """All nodes of the trie of ``rebuilt`` turns: NODES, with the parent's smallest member as ``parent_conv``."""
    slices = stored(paths(turns), "trie-paths")
    whole = stored(ends(slices.where(F.col("last").isNotNull())), "trie-ends")
    deepest = whole.agg(F.max("depth")).first()[0]
    ended = whole.select("conv", F.col("depth").alias("top"), "n", F.lit(0).cast("bigint").alias("child"), F.lit(0).cast("bigint").alias("leaves"), F.lit(0).cast("bigint").alias("saved"), "ends")
    limits = bounds(deepest or 0)
    frames: list[DataFrame] = []
    survivors: list[DataFrame] = []
    for lo, hi in reversed(list(zip(limits, limits[1:])) if deepest else []):
        entering = ended.where((F.col("top") > lo) & (F.col("top") <= hi))
        for nodes in survivors:
            entering = entering.unionByName(_entering(nodes, hi + 1))
        own = slices.where(F.col("lo") == lo).select("conv", "hashes", "sizes")
        survivors = _range(entering, own, lo, hi, lo, group_levels)
        frames += survivors
    at_root = ended.where(F.col("top") == 0)
    for nodes in survivors:
        at_root = at_root.unionByName(_entering(nodes, 1))
    root = at_root.agg(
        F.min("conv").alias("conv"), F.sum("n").alias("n"), F.sum("child").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends")
    ).where(F.col("n").isNotNull())
    root = root.select(
        F.lit(ROOT).alias("hash"), F.lit(None).cast("binary").alias("parent"), "conv", F.lit(0).alias("depth"), "n", "children",
        F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("bigint").alias("leaves"), "saved", "ends",
    )
    nodes = _union([*frames, stored(root, "trie-nodes")])
    parents = nodes.select(F.col("hash").alias("parent"), F.col("conv").alias("parent_conv"))
    below = nodes.where(F.col("parent").isNotNull()).join(parents, "parent")
    top = nodes.where(F.col("parent").isNull()).withColumn("parent_conv", F.lit(None).cast("bigint"))
    return below.unionByName(top)


_NONE = hashlib.sha256(b"").hexdigest()


def digest(nodes: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return nodes.select(
        F.col("conv").alias("conv_id"),
        F.col("depth").cast("bigint").alias("depth"),
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(_NONE)).alias("ends_sha256"),
    )


SQL = f"""
WITH RECURSIVE t AS (
  SELECT conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos, k, size
  FROM (SELECT conv_id, turn, substr(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, {2 * WIDTH}) AS k,
      length(coalesce(text, ''))::BIGINT AS size FROM conversations WHERE conv_id IS NOT NULL)),
crc_table AS (
  SELECT n, list_reduce(list_prepend(n::BIGINT, range(8)), lambda c, i: CASE WHEN (c & 1) = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) r(n)),
x AS (
  SELECT DISTINCT conv, 1 AS i, 4294967295::BIGINT AS s FROM t
  UNION ALL SELECT x.conv, i + 1, xor(v, s >> 8) FROM x JOIN crc_table ON n = (xor(s, ascii(substr(x.conv::VARCHAR, i, 1))::BIGINT) & 255) WHERE i <= length(x.conv::VARCHAR)),
c AS (SELECT conv, xor(s, 4294967295::BIGINT) % 6 AS h, conv - conv % 100 AS host FROM x WHERE i > length(conv::VARCHAR)),
r AS (
  SELECT conv, k, size, row_number() OVER (PARTITION BY conv ORDER BY pos) AS d FROM (
    SELECT t.conv, t.pos, t.k, t.size FROM t JOIN c USING (conv) WHERE t.pos > c.h
    UNION ALL SELECT c.conv, t.pos, t.k, t.size FROM c JOIN t ON t.conv = c.host WHERE t.pos <= c.h)),
p AS (
  SELECT conv, 0::BIGINT AS d, '' AS node, NULL::VARCHAR AS parent, 0::BIGINT AS size FROM c
  UNION ALL SELECT p.conv, p.d + 1, sha256(p.node || r.k), p.node, r.size FROM p JOIN r ON r.conv = p.conv AND r.d = p.d + 1),
n AS (SELECT node, d, min(parent) AS parent, min(conv) AS conv, count(*) AS n_convs, min(size) AS size FROM p GROUP BY node, d),
e AS (
  SELECT node, sha256(string_agg(conv::VARCHAR, ',' ORDER BY conv)) AS ends_sha256
  FROM (SELECT conv, arg_max(node, d) AS node FROM p GROUP BY conv) GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
m AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
-- a node counts for each prefix of its smallest member
s AS (
  SELECT p.node, sum((m.n_convs - 1) * m.size)::BIGINT AS saved_tokens, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves
  FROM m JOIN p ON p.conv = m.conv AND p.d <= m.d GROUP BY p.node)
SELECT m.conv AS conv_id, m.d::BIGINT AS depth, u.conv AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens,
  coalesce(e.ends_sha256, '{_NONE}') AS ends_sha256
FROM m JOIN s USING (node) LEFT JOIN e USING (node) LEFT JOIN n u ON u.node = m.parent
"""
