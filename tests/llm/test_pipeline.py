"""The pipeline against plain versions of its stages, and each stage on awkward rows."""

import hashlib

import public_tokenizers as P
import tiktoken
from common import AWKWARD, CLASHING, SF, awkward, rows, same
from test_near_dup import plain as near_plain
from test_pii import plain as pii_plain
from test_search import plain as search_plain

import corpus_pipeline as C
from crawlprism.llm import bpe


def digests(docs):
    encoding = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    out = []
    for i, t in docs:
        ids = encoding.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return out


def redact(text):
    spans = sorted(((s, -e, k) for k, own in pii_plain(text).items() for s, e in own))
    out, at = "", 0
    for s, e, k in spans:
        if s >= at:
            out += text[at:s] + f"[{k.upper()}]"
        at = max(at, -e)
    return out + text[at:]


def plain(docs, items):
    docs = [(i, t) for i, t in docs if any(c.isalpha() for c in t or "")]
    docs = list(dict.fromkeys(d for d, r in zip(docs, near_plain(docs, 5)) if r[-1]))
    docs = [d for d, r in zip(docs, search_plain(docs, items)) if not r[-1]]
    return digests([(i, redact(t)) for i, t in docs])


def test_stages():
    assert [n for n, _ in C.STAGES] == ["language_id", "near_duplicates", "decontamination", "personal_data", "bpe"]
    assert C.ORACLE_SQL is None


def test_run_against_plain_stages(spark):
    docs = [(r["doc_id"], r["text"]) for r in rows("documents")]
    items = [(r["item_id"], r["text"]) for r in rows("benchmark")]
    got = C.run(spark, SF)
    same(got.collect(), plain(docs, items))
    assert 0.5 * len(docs) < got.count() < len(docs)


def test_stages_on_awkward_rows(spark):
    docs = awkward(spark, [*AWKWARD, (90, "der die das"), (91, "the of and")])
    columns = docs.columns
    assert set(CLASHING) < set(columns)
    for name, stage in C.STAGES:
        docs = stage(spark, docs, SF)
        if name != C.STAGES[-1][0]:
            assert docs.columns == columns
    found = {r.doc_id for r in docs.collect()}
    assert {14, 16, 20, 90} - found <= {16, 14} and 10 not in found and 13 not in found


def test_texts_stay_when_no_language_is_known(spark):
    docs = awkward(spark, [*AWKWARD, (90, "der die das"), (91, "the of and")]).drop("lang").selectExpr("*", "cast(null as string) as lang")
    got = C.STAGES[0][1](spark, docs, SF)
    assert sorted(got.columns) == sorted(docs.columns)
    want = [(i, t) for i, t in [*AWKWARD, (90, "der die das"), (91, "the of and")] if any(c.isalpha() for c in t or "")]
    same(got.select("doc_id", "text").collect(), want)


def test_stages_on_an_empty_table(spark):
    docs = awkward(spark, [])
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
