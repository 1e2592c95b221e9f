"""Language status: edge rows, argument checks, and the votes against a plain re-statement of the rules."""

import re
import unicodedata

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from crawlprism.functions import text as X
from crawlprism.operators import dictionaries as D
from crawlprism.operators import language as L
from crawlprism.operators.language import DEBUG_COLUMNS, detect_language
from crawlprism.registry.fixtures import load
from crawlprism.registry.language_queries import marker_predictor

COMMON = set(D.ENGLISH_COMMON_WORDS)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def statuses(spark, texts, **kwargs):
    rows = detect_language(frame(spark, texts), "text", **kwargs).orderBy("id").collect()
    return [r["lang_status"] for r in rows]


EN = "the people of the town and the year " * 60


def test_edge_rows(spark):
    texts = [None, "", " \n\t", "12345 678", "привет", EN[:2000] + "zzqx vvkw "]
    assert statuses(spark, texts) == [
        "english_only", "english_only", "english_only", "english_only", "non_english", "mixed",
    ]


def test_chunk_borders(spark):
    whole = (EN * 2)[:2000]
    assert statuses(spark, [whole, whole + "x"]) == ["english_only", "mixed"]


def test_overlapping_chunks(spark):
    text = "abcdefghij" * 3
    df = frame(spark, [text])
    for size, step in [(10, 10), (10, 4), (4, 10), (7, 3), (100, 1)]:
        got = df.select(X.char_chunks("text", size, step)).first()[0]
        assert got == [text[i : i + size] for i in range(0, len(text), step)]


def test_chunks_count_code_points(spark):
    text = "a\U0001f600é" * 5
    assert frame(spark, [text]).select(X.char_chunks("text", 4)).first()[0] == [
        text[i : i + 4] for i in range(0, len(text), 4)
    ]


def test_bool_column(spark):
    rows = detect_language(frame(spark, ["the and of", "zzqx vvkw"]), "text").orderBy("id").collect()
    assert [r["has_other_lang"] for r in rows] == [False, True]


@pytest.mark.parametrize(
    "kwargs",
    [
        {"text_col": "missing"},
        {"bool_col": " "},
        {"bool_col": None},
        {"chunk_size": 0},
        {"step": -1},
        {"min_chunk_chars": 0},
        {"conf_threshold": 1.5},
        {"en_chunk_ratio_threshold": -0.1},
        {"min_noneng_share": 2.0},
    ],
)
def test_argument_checks(spark, kwargs):
    with pytest.raises(ValueError):
        detect_language(frame(spark, ["x"]), **{"text_col": "text", **kwargs})


def test_diacritic_ratio(spark):
    texts = [None, "", "plain", "été", "Tiếng Việt", "é"]

    def ratio(s):
        if not s:
            return 0.0
        return sum(unicodedata.category(c) == "Mn" for c in unicodedata.normalize("NFD", s)) / len(s)

    rows = frame(spark, texts).select("id", X.diacritic_ratio("text").alias("r")).orderBy("id").collect()
    assert [r["r"] for r in rows] == pytest.approx([ratio(t) for t in texts])


# --- brute force ---------------------------------------------------------------------


def brute_heuristic(text, size):
    en = non = top = 0
    label = ""
    for start in range(0, len(text), size):
        chunk = text[start : start + size]
        words = re.findall("[a-z']+", chunk.lower())
        if re.search(X.NON_LATIN, chunk):
            non += 1
            if non > top:
                top, label = non, "non_latin"
        elif words:
            hits = sum(w in COMMON for w in words)
            if hits >= 3 or hits / len(words) >= 0.3:
                en += 1
            else:
                non += 1
        if en and non:
            break
    status = "mixed" if en and non else "non_english" if non else "english_only"
    return (status, en + non, en, non, label, top, 0.0)


def brute_votes(text, size, predict):
    """The rules of the vote, told over lists."""
    if text is None or not text.strip():
        return ("english_only", 0, 0, 0, "", 0, 0.0)
    labels, accepted, marks, best = [], 0, 0, 0.0

    def tally():
        english = sum(v.startswith("en") for v in labels)
        others = [v for v in labels if not v.startswith("en")]
        order = sorted(set(others), key=lambda v: (-others.count(v), others.index(v)))
        top = (order[0], others.count(order[0])) if order else ("", 0)
        return english, len(others) + marks, top, len(set(others)) + bool(marks)

    for start in range(0, len(text), size):
        chunk = text[start : start + size].replace("\n", " ").strip()
        if len(chunk) < 50:
            continue
        found = predict(pd.Series([chunk])).iloc[0]
        marked = (
            sum(unicodedata.category(c) == "Mn" for c in unicodedata.normalize("NFD", chunk)) / len(chunk) >= 0.03
        )
        sure = found["label"] is not None and not pd.isna(found["label"]) and found["prob"] >= 0.7
        accepted += bool(sure or marked)
        marks += marked
        if not sure:
            continue
        labels.append(found["label"].replace("__label__", "").lower())
        best = max(best, found["prob"])
        en, non, top, _ = tally()
        if len(set(labels)) + bool(marks) >= 2 and accepted >= 2:
            verdict = "non_english" if non >= 2 and non / accepted >= 0.4 else "mixed"
            return (verdict, accepted, en, non, *top, best)
    en, non, top, kinds = tally()
    fallback = brute_heuristic(text, size)
    if accepted < 2:
        return fallback
    if en >= 2 and en / accepted >= 0.75:
        return ("english_only", accepted, en, non, *top, best)
    if non == 1:
        if kinds > 1:
            return ("mixed", accepted, en, non, *top, best)
        if marks and (non + marks) / accepted >= 0.4:
            return ("non_english", accepted, en, non + marks, *top, best)
        return fallback
    if non and not en:
        return ("non_english" if non / accepted >= 0.4 else "mixed", accepted, en, non, *top, best)
    if non and en:
        return ("mixed", accepted, en, non, *top, best)
    return ("english_only", accepted, en, non, *top, best)


def same(rows, texts, brute):
    for row, text in zip(rows, texts):
        got = (row["lang_status"], *[row[c] for c in DEBUG_COLUMNS])
        want = brute(text)
        assert got[:-1] == want[:-1] and got[-1] == pytest.approx(want[-1]), (got, want, text[:80])


def texts_of(spark, sf):
    rows = load(spark, sf, "documents").orderBy("doc_id").collect()
    half = [a["text"] + b["text"] for a, b in zip(rows, rows[1:])]
    return [r["text"] for r in rows] + half + ["привет " * 50 + EN]


@pytest.mark.parametrize("size", [120, 300, 2000])
def test_heuristic_votes(spark, sf, size):
    texts = texts_of(spark, sf)
    out = detect_language(frame(spark, texts), "text", add_bool=False, return_debug=True, chunk_size=size)
    same(out.orderBy("id").collect(), texts, lambda t: brute_heuristic(t, size))


@pytest.mark.parametrize("size", [80, 200, 500])
def test_model_votes(spark, sf, size):
    texts = texts_of(spark, sf)
    predictor = marker_predictor()
    out = detect_language(
        frame(spark, texts), "text", add_bool=False, return_debug=True, chunk_size=size, predictor=predictor
    )
    rows = out.orderBy("id").collect()
    same(rows, texts, lambda t: brute_votes(t, size, predictor))
    assert len({r["lang_status"] for r in rows}) == 3


def scripted(script):
    """Predictor that reads its answer from the start of the chunk, e.g. ``fr:0.9``."""

    def predict(chunks):
        labels, probs = [], []
        for c in chunks:
            label, _, prob = c.split(" ")[0].partition(":")
            labels.append(None if label == "none" else "__label__" + label)
            probs.append(float(prob) if prob else None)
        return pd.DataFrame({"label": labels, "prob": probs})

    def chunk(vote):
        mark = "é" * 5 if vote.endswith("*") else ""
        return (vote.rstrip("*") + " " + mark).ljust(60, "q")

    return "".join(chunk(v) for v in script), predict


SCRIPTS = [
    ["en:0.9", "en:0.9", "en:0.9"],
    ["en:0.9", "fr:0.9"],
    ["fr:0.9", "de:0.9", "en:0.9"],
    ["fr:0.9", "fr:0.8"],
    ["fr:0.9"],
    ["fr:0.5", "en:0.9", "en:0.8"],
    ["none*", "en:0.9", "en:0.9", "en:0.9"],
    ["fr:0.3*", "fr:0.3*"],
    ["fr:0.9*"],
    ["none*", "fr:0.9*"],
    ["none", "none", "none"],
    ["none*", "none", "en:0.95"],
    ["none*", "fr:0.2", "none*", "en:0.9"],
    ["EN:0.9", "en:0.7", "de:0.69"],
]


@pytest.mark.parametrize("script", SCRIPTS, ids=lambda s: "-".join(s))
def test_scripted_votes(spark, script):
    text, predict = scripted(script)
    out = detect_language(
        frame(spark, [text]), "text", add_bool=False, return_debug=True, chunk_size=60, predictor=predict
    )
    same(out.collect(), [text], lambda t: brute_votes(t, 60, predict))


# --- the model path ------------------------------------------------------------------------


def test_model_failures(spark, tmp_path):
    """A chunk on which the model fails has no vote; scoring stops at the early verdict; the model is built once per worker."""
    calls = str(tmp_path / "calls")

    def factory():
        import os

        with open(calls, "a") as log:
            log.write(f"load {os.getpid()}\n")

        def predict(chunks):
            import pandas as pd

            with open(calls, "a") as log:
                log.writelines(f"chunk {c[:5]}\n" for c in chunks)
            if any("bad" in c for c in chunks):
                raise RuntimeError("no")
            return pd.DataFrame({"label": ["en" if "the" in c else "fr" for c in chunks], "prob": [0.9] * len(chunks)})

        return predict

    page = ["00the " * 10, "01bad " * 10, "02mot " * 10, "03the " * 10, "04mot " * 10]
    df = frame(spark, ["".join(c[:60].ljust(60) for c in page)] * 3).coalesce(1)
    got = L.detect_language(
        df, "text", add_bool=False, return_debug=True, chunk_size=60, predictor_factory=factory, min_chunk_chars=10
    ).collect()
    assert {(r["lang_status"], r["accepted_chunks"], r["en_votes"], r["non_votes"]) for r in got} == {("mixed", 2, 1, 1)}
    lines = (tmp_path / "calls").read_text().splitlines()
    assert len([x for x in lines if x.startswith("load")]) == 1
    assert not any(x.startswith(("chunk 03", "chunk 04")) for x in lines)


def test_model_that_does_not_load(spark):
    def factory():
        raise OSError("no model here")

    texts = ["the of and to in is that it was for " * 9, "la de le et les des en un du une " * 9, None]
    df = frame(spark, texts)
    got = L.detect_language(df, "text", add_bool=False, return_debug=True, predictor_factory=factory)
    want = L.detect_language(df, "text", add_bool=False, return_debug=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError, match="not both"):
        L.detect_language(df, "text", predictor=marker_predictor(), predictor_factory=factory)


P = {"conf_threshold": 0.7, "diacritic_threshold": 0.03, "min_accepted_chunks": 2}


def test_votes_of_an_arrow_batch():
    def predict(chunks):
        if "bad" in set(chunks):
            raise ValueError("no")
        return pd.DataFrame({"label": [None if c == "?" else c[:2] for c in chunks], "prob": [None if c == "?" else 0.9 for c in chunks]})

    lists = [["xx"], None, [], ["en", "bad", "?", "en"], ["en1", "fr1", "de1"], None, ["é"], ["zz"]]
    pages = pa.array(lists, pa.list_(pa.string())).slice(1, 6)
    en, none = {"label": "en", "prob": 0.9, "marks": 0.0}, {"label": None, "prob": None, "marks": 0.0}
    got = L._scored(pages, predict, P).to_pylist()
    # a page without chunks has no votes, one without text has no list, and chunks behind the verdict are not asked for
    assert got == [None, [], [en, none, none, en], [en, {"label": "fr", "prob": 0.9, "marks": 0.0}], None, [{"label": "é", "prob": 0.9, "marks": 1.0}]]
    assert L._scored(pages.slice(0, 0), predict, P).to_pylist() == []
    assert L._scored(pages.slice(0, 1), predict, P).to_pylist() == [None]


def test_votes_take_little_memory():
    """Python objects are made of one round's texts, not of all chunks and votes of a batch."""
    import tracemalloc

    n = 40_000
    pages = pa.array([[f"{i:05d} {k} " + "x" * 480 for k in range(20)] for i in range(n // 20)])
    tracemalloc.start()
    try:
        votes = L._scored(pages, lambda c: pd.DataFrame({"label": ["en"] * len(c), "prob": [0.9] * len(c)}), P)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert pc.sum(pc.list_value_length(votes)).as_py() == n and peak < 150 * n
