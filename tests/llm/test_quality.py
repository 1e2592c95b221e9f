"""Repetition rules against plain counts."""

import re
from collections import Counter

from common import AWKWARD, awkward, prose, rows, same

from crawlprism.llm import quality as Q


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)

    def covered(n):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        counts = Counter(grams)
        return {j for i, g in enumerate(grams) if counts[g] > 1 for j in range(i, i + n)}, counts, grams

    repeated = len(covered(3)[0])
    failed = len(words) < 50 or 100 * repeated > 50 * len(words)
    total = sum(map(len, words))
    over = False
    if words:
        seen, chars = set(), 0
        for line in text.split("\n"):
            if line in seen:
                chars += len(re.sub(r"[\x20\x09-\x0D]", "", line))
            elif re.search(r"[^\x20\x09-\x0D]", line):
                seen.add(line)
        over |= chars / total > Q.DUPLICATED_LINES
        for n, limit in Q.DUPLICATED_NGRAM.items():
            before, inside = set(), set()
            for i, g in enumerate(covered(n)[2]):
                inside |= set(range(i, i + n)) if g in before else set()
                before.add(g)
            over |= sum(len(words[j]) for j in inside) / total > limit
        for n, limit in Q.TOP_NGRAM.items():
            _, counts, grams = covered(n)
            if not grams or max(counts.values()) < 2:
                continue
            top = next(g for g in grams if counts[g] == max(counts.values()))
            inside = {j for i, g in enumerate(grams) if g == top for j in range(i, i + n)}
            over |= sum(len(words[j]) for j in inside) / total > limit
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), total, symbols, dup, repeated, failed, not failed and not over


def test_base_counts_and_verdict(spark):
    texts = [*AWKWARD, (30, "same line here\n" * 40), (31, "# a | b\n" * 3 + prose(9, 80)), (32, prose(8, 200) + "\n" + prose(8, 200))]
    got = Q.digest(Q.repetition(awkward(spark, texts))).collect()
    same(got, [(i, *plain(t)) for i, t in texts])
    kept = {r.doc_id for r in got if r.kept}
    assert {16, 20} <= kept and not {30, 32} & kept


def test_supplied_documents(spark):
    docs = rows("documents")
    got = Q.digest(Q.repetition(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))).collect()
    same([tuple(r)[:7] for r in got], [(d["doc_id"], *plain(d["text"])[:6]) for d in docs])
    assert sum(r.kept for r in got) > 0.5 * len(docs)


def test_empty_table(spark):
    assert Q.repetition(awkward(spark, [])).collect() == []
