"""The prefix trie against a plain version, at several limits of what one task peels."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from common import rows

from crawlprism.llm import prefix_trie
from crawlprism.llm.common import bound_batches

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest_of(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain(turns):
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest_of(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(v, key=lambda t: t[:3])] for c, v in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        host = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = tuple(own.get(host, [])[:h] + mine[h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        saved[node] = sum(saved[c] for c in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return sorted(
        (
            (min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
             hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
            for n in members
        ),
        key=repr,
    )


def check(spark, turns, group_levels=prefix_trie.GROUP_LEVELS):
    bound_batches(spark)
    # other columns have names that the operator uses itself
    df = spark.createDataFrame([(*t, 7, "x") for t in turns], "conv_id bigint, turn bigint, role string, text string, conv int, hash string").repartition(3)
    got = prefix_trie.digest(prefix_trie.trie(prefix_trie.rebuilt(df), group_levels))
    assert sorted([tuple(r[c] for c in COLUMNS) for r in got.collect()], key=repr) == plain(turns)


def made(seed, conversations, longest):
    pick = random.Random(seed)
    out = []
    for c in range(conversations):
        conv = pick.choice([c, c + 97, -c, c * 1000])
        for turn in range(pick.randrange(longest + 1)):
            out.append((conv, None if pick.random() < 0.05 else turn, pick.choice(["user", "assistant", None]) if turn > 3 else "user", pick.choice(["a", "b", "", None, "é\U0001f600"])))
    return out + out[: conversations // 5] + [(None, 0, "user", "a"), (None, None, None, None)]


@pytest.mark.parametrize("group_levels", [prefix_trie.GROUP_LEVELS, 40, 0])
def test_made_conversations(spark, group_levels):
    check(spark, made(1, 120, 9), group_levels)


def test_copies_and_deep_ones(spark):
    deep = [(c, t, "user", "same" if t < 75 else str(c % 3)) for c in range(1, 12) for t in range(80)]
    copies = [(c, t, "user", str(t)) for c in range(200, 260) for t in range(3)]
    check(spark, deep + copies, 300)


def test_supplied_conversations(spark):
    check(spark, [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows("conversations")], 50)


def test_turnless_and_empty(spark):
    # conversation 7 lends all it has: its host is absent and it has no turn beyond the first ones
    short = [(c, 0, "user", "x") for c in range(101, 200)]
    check(spark, short)
    bound_batches(spark)
    for turns in ([], [(None, 1, "user", "x")]):
        df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
        assert prefix_trie.trie(prefix_trie.rebuilt(df)).collect() == []


def test_ranges():
    assert prefix_trie.bounds(0) == [0, 1] and prefix_trie.bounds(5) == [0, 1, 2, 4, 8]
    limits = prefix_trie.bounds(20_000)
    assert max(b - a for a, b in zip(limits, limits[1:])) == prefix_trie.MAX_SLICE and limits[-1] >= 20_000
