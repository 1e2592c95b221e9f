"""Near duplicates against all pairs."""

import random

import numpy as np
import pytest
from common import AWKWARD, awkward, prose, rows, same
from pyspark.sql import functions as F

from crawlprism.llm import near_dup as N
from crawlprism.llm.graph import components


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def plain(docs, width):
    sets = [shingles(t, width) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    ids = {}
    for i, (doc_id, _) in enumerate(docs):
        ids.setdefault(root(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        own = [d for d in ids[root(i)] if d is not None]
        component = min(own, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return out


def chain(seed, n):
    """Each text is like the one before; the ends have little in common."""
    words = prose(seed, 120).split()
    out = []
    for k in range(n):
        out.append(" ".join(words))
        words[k * 9 : k * 9 + 4] = [f"new{seed}-{k}-{j}" for j in range(4)]
    return out


DOCS = [
    *AWKWARD,
    *[(200 + i, t) for i, t in enumerate(chain(31, 10))],
    *[(300 - i, t) for i, t in enumerate(chain(32, 10))],
    (400, "ONE"), (401, "two words"), (402, "Two  Words"), (403, "words two"),
]


@pytest.mark.parametrize("width", [2, 5])
def test_against_all_pairs(spark, width):
    same(N.digest(N.near_duplicates(awkward(spark, DOCS), width=width)).collect(), plain(DOCS, width))


def test_group_of_unlike_copies(spark, monkeypatch):
    """Members vary around a text, so that many pairs are just below the bound."""
    pick, base = random.Random(3), prose(77, 150).split()
    docs = []
    for i in range(120):
        own = list(base)
        for _ in range(pick.randrange(14)):
            own[pick.randrange(len(own))] = f"v{pick.randrange(500)}"
        docs.append((i, " ".join(own)))
    want = plain(docs, 2)
    same(N.digest(N.near_duplicates(awkward(spark, docs), width=2)).collect(), want)
    # the same by blocks, and by many small ones
    monkeypatch.setattr(N, "CELL", 7)
    same(N.digest(N.near_duplicates(awkward(spark, docs), width=2, large_bucket=2)).collect(), want)


def test_stage_keeps_one_of_each_group(spark):
    docs = awkward(spark, DOCS)
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    want = [(i, t) for (i, t), r in zip(DOCS, plain(DOCS, 5)) if r[-1]]
    same(kept.select("doc_id", "text").collect(), list(dict.fromkeys(want)))
    same(N.keep_one(kept).select("doc_id", "text").collect(), list(dict.fromkeys(want)))


def test_empty_table(spark):
    assert N.near_duplicates(awkward(spark, [])).collect() == []


def test_sketches_estimate_similarity():
    items = np.random.default_rng(1).integers(0, 2**63, 3000, dtype=np.uint64)
    for n in (3, 40, 1000):
        a, b = np.sort(items[:n]), np.sort(np.concatenate([items[: n * 4 // 5], items[2000 : 2000 + n // 5]]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = N.sketch(a, 2000), N.sketch(b, 2000)
        assert (x != N._EMPTY).all() and abs((x == y).mean() - true) < 0.06


def test_components_of_random_graphs(spark):
    pick = random.Random(9)
    edges = [(pick.randrange(200), pick.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1064)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    want = [(x, root(x)) for x in sorted({v for e in edges if e[0] != e[1] for v in e})]
    same(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect(), want)


def test_supplied_copies_are_found(spark):
    docs = [(r["doc_id"], r["text"]) for r in rows("documents")]
    same(N.digest(N.near_duplicates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))).collect(), plain(docs, 5))


def test_hot_keys_meet_in_plain_shuffles(spark, plan):
    """A join with its own aggregate reads that from storage, so adaptive execution may split the other side."""
    from crawlprism.llm import graph

    pairs = spark.range(2_000).select((F.col("id") % 3).alias("u"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(graph._star(pairs, "star-test"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" in text, text
    join = text[text.index("Join") :]
    assert "HashAggregate" not in join and join.count("ENSURE_REQUIREMENTS") == 2
