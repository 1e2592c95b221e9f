"""Language identification: automata against plain substrings, held-out accuracy, awkward rows."""

import random
import zlib

from common import AWKWARD, awkward, same

from crawlprism.llm import language_id as L


def phrases(text, source):
    count, i = 0, 0
    while i < len(text):
        n = 1
        while i + n < len(text) and text[i : i + n + 1] in source:
            n += 1
        count, i = count + 1, i + n
    return count


def test_phrases_are_longest_matches(monkeypatch):
    pick = random.Random(1)
    for _ in range(200):
        source = [pick.randint(3, 6) for _ in range(pick.randint(1, 60))]
        automaton = L.Automaton(source, 8)
        texts = [[pick.randint(3, 7) for _ in range(pick.randint(1, 40))] for _ in range(5)]
        joined = "".join(map(str, source))
        want = [phrases("".join(map(str, t)), joined) for t in texts]
        for piece in (1, 3, 8, 1024):  # pieces are joined up, so their size changes nothing
            for few in (0, 2, 64):
                monkeypatch.setattr(L, "FEW", few)
                lanes = L.Lanes([L.np.array(t, L.np.uint16) for t in texts], piece, 4)
                assert lanes.phrases(automaton).tolist() == want


def test_periods_that_never_meet():
    # phrases of three symbols against pieces of four: every piece hands its end on to the next
    automaton = L.Automaton([3, 3, 3, L.END, 4], 8)
    texts = [[3] * 100, [3] * 41 + [4] + [3] * 60, [7] * 50, [3]]
    lanes = L.Lanes([L.np.array(t, L.np.uint16) for t in texts], 4, 16)
    assert lanes.phrases(automaton).tolist() == [34, 14 + 1 + 20, 50, 1]
    assert L.Lanes([]).phrases(automaton).tolist() == []


def test_whole_predictions_against_plain_parsing():
    pick = random.Random(5)
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["merol", "muspi", "rolod"], "cc": ["lomer", "sumip", "ipdol"]}
    sample = {lang: [" ".join(pick.choices(w, k=30)) for _ in range(10)] for lang, w in words.items()}
    model = L.Model(sample)
    texts = [" ".join(pick.choices(sum(words.values(), []) + ["sit", "amet"], k=pick.randint(1, 600))) for _ in range(25)]

    def plain(text):
        need = {}
        for lang, rows in sample.items():
            learn = "|".join(t for i, t in enumerate(rows) if i % 5 != 4)
            check = [t for i, t in enumerate(rows) if i % 5 == 4]
            rate = sum(phrases(t, learn) for t in check) / sum(map(len, check))
            need[lang] = phrases(text, learn) / len(text) / rate
        ranked = sorted(need.values())
        return min(need, key=need.get), 1 - ranked[0] / ranked[1]

    langs, scores = model.predict(texts)
    want = [plain(t) for t in texts]
    assert langs == [w[0] for w in want]
    assert all(abs(s - w[1]) < 1e-9 for s, w in zip(scores, want))


def test_memory_of_a_language_with_many_characters():
    pick = random.Random(7)
    chinese = ["".join(chr(0x4E00 + pick.randrange(3500)) for _ in range(2000)) for _ in range(20)]
    english = [" ".join(pick.choices("the cat sat on a mat and dog with it".split(), k=400)) for _ in range(20)]
    model = L.Model({"en": english, "zh": chinese})
    assert all(a.n_bytes < 10_000_000 for a in model.automata)
    assert model.predict([chinese[0][:50], english[3][300:900]])[0] == ["zh", "en"]


def test_many_labels(spark):
    # 300 labels, of which 200 have two rows in the learning fold at least
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, f"text of label {n % 300}", f"l{n % 300:03d}") for n, i in enumerate(ids[:500])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample = L.training_sample(df)
    assert sorted(sample) == [f"l{n:03d}" for n in range(L.MAX_LANGUAGES)]
    assert list(L.training_sample(df, max_languages=1)) == ["l000"]
    assert {r.lang_pred for r in L.predictions(df.limit(5), sample).collect()} <= set(sample)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sample = L.training_sample(docs)
    found = L.digest(docs, L.predictions(docs, sample)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
    assert set(sample) == {"en", "de", "fr", "es"} and all(len(v) <= L.SAMPLE_TEXTS for v in sample.values())


def test_only_the_learning_fold_teaches(spark):
    docs = [(i, f"only in text {i}") for i in range(40)]
    df = spark.createDataFrame([(i, t, "en") for i, t in docs], "doc_id bigint, text string, lang string")
    sample = L.training_sample(df)
    assert sorted(sample["en"]) == sorted(t for i, t in docs if zlib.crc32(str(i).encode()) % 4 != 2)


def test_awkward_rows(spark):
    docs = awkward(spark)
    sample = {"en": ["the cat sat on the mat and the dog"] * 6, "de": ["der hund und die katze auf der matte"] * 6, "xx": ["123", ""]}
    got = L.predictions(docs, sample).collect()
    assert len(got) == len(AWKWARD)
    und = {10, 11, 12, 13}
    assert {r.doc_id for r in got if r.lang_pred == "und"} - {None} == und
    assert all(r.lang_pred in {"en", "de"} for r in got if r.doc_id is not None and r.doc_id not in und)
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    texts = [(1, "The cat sat"), (2, "Der Hund und die Katze"), (3, "THE DOG, THE MAT!")]
    same([(r.doc_id, r.lang_pred) for r in L.predictions(awkward(spark, texts), sample).collect()], [(1, "en"), (2, "de"), (3, "en")])


def test_rejected_rows_go(spark):
    docs = awkward(spark)
    kept = L.keep_identified(docs, {"en": ["the cat sat on the mat"] * 6, "de": ["der hund und die katze"] * 6})
    assert kept.columns == docs.columns
    same(kept.select("doc_id", "text").collect(), [(i, t) for i, t in AWKWARD if any(c.isalpha() for c in t or "")])


def test_nothing_learned(spark):
    assert {r.lang_pred for r in L.predictions(awkward(spark), {}).collect()} == {"und"}
    assert L.training_sample(awkward(spark, [])) == {}
    assert L.predictions(awkward(spark, []), {}).collect() == []


def test_score_of_one_language(spark):
    got = L.predictions(awkward(spark, [(1, "the cat"), (2, "zzz qqq")]), {"en": ["the cat sat on the mat"] * 6}).collect()
    assert {r.lang_pred for r in got} == {"en"} and all(0 <= r.score <= 1 for r in got)
