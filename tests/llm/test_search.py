"""Decontamination: against a plain search, in one block of patterns and in many."""

import hashlib
import random
import re

from common import AWKWARD, BASE, LONG, PASSAGE, awkward, same

from crawlprism.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(window, len(w))
        if item is not None:
            for i in range(len(w) - m + 1 if m else 0):
                windows.setdefault(tuple(w[i : i + m]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if (own := windows.get(tuple(w[i : i + m]))) is not None:
                    hit |= set(range(i, i + m))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return out


ITEMS = [
    (1, PASSAGE.upper()), (2, PASSAGE[5:150]), (2, PASSAGE[5:150]), (3, None), (None, PASSAGE), (4, "..."), (5, "ONE"),
    (100, LONG[2000:60000]), (11, "two Spaces lines"), (12, BASE[-200:]),
]


def bench(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, "z") for i, t in items], "item_id bigint, text string, items string")


def test_against_plain_search(spark):
    got = D.digest(D.contamination(awkward(spark), bench(spark))).collect()
    want = plain(AWKWARD, ITEMS)
    same(got, want)
    assert {r.doc_id for r in got if r.contaminated} >= {14, 15, 18, 19, 20, 21}


def test_many_blocks_of_patterns_give_the_same(spark):
    got = D.contamination(awkward(spark), bench(spark), block_bytes=3000)
    same(D.digest(got).collect(), plain(AWKWARD, ITEMS))
    clean = D.keep_clean(awkward(spark), bench(spark), block_bytes=3000)
    assert clean.columns == awkward(spark).columns
    same(clean.select("doc_id", "text").collect(), [(i, t) for (i, t), r in zip(AWKWARD, plain(AWKWARD, ITEMS)) if not r[-1]])


def test_empty_tables(spark):
    assert D.digest(D.contamination(awkward(spark, []), bench(spark))).collect() == []
    same(D.digest(D.contamination(awkward(spark), bench(spark, []))).collect(), plain(AWKWARD, []))


def test_searcher_on_few_symbols():
    pick = random.Random(5)
    for _ in range(300):
        m = pick.randint(1, 6)
        patterns = {tuple(pick.randint(1, 3) for _ in range(m)): frozenset("x") for _ in range(pick.randint(1, 8))}
        text = [pick.randint(0, 3) for _ in range(pick.randint(0, 60))]
        want = [i for i in range(len(text) - m + 1) if tuple(text[i : i + m]) in patterns]
        assert [at for at, _ in D.Searcher(patterns, m).find(text)] == want
