"""Personal data: base spans against the patterns as written, bootstrapped spans on planted cues."""

import hashlib
import random
import re
import time

from common import AWKWARD, awkward, prose, same

from crawlprism.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(number):
    digits = [int(c) for c in re.sub("[^0-9]", "", number)][::-1]
    return sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])


def plain(text):
    text = text or ""
    count = lambda s: len(re.sub("[^0-9]", "", s))
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= count(m.group()) <= 19 and luhn(m.group()) % 10 == 0],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= count(m.group()) <= 15],
    }


def test_base_spans_on_random_text():
    pick = random.Random(2)
    letters = "aZ09.@-+_% ()\né4"
    for _ in range(4000):
        text = "".join(pick.choice(letters) for _ in range(pick.randrange(60)))
        assert P.base_spans(text) == plain(text), text
    for _ in range(3000):
        text = "".join(pick.choice("0123456789 .-+()") for _ in range(pick.randrange(80)))
        assert P.base_spans(text) == plain(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 200_000, "1" * 200_000, "@" * 50_000, "1.1" * 50_000, "a@" * 50_000, "+1" * 50_000):
        P.base_spans(text)


TEXTS = [
    (50, "mail jo@example.com, then jo@x or 10.0.0.1 and 10.0.0.999."),
    (51, "card 4111 1111 1111 1111 phone +1 (555) 123-4567"),
    (52, "é中 a.b+c@mail.example.org\n+49 30 1234567"),
]


def test_rows(spark):
    docs = [*AWKWARD, *TEXTS]
    want = []
    for i, t in docs:
        spans = plain(t)
        joined = ",".join(f"{k}:{s}:{e}" for k in P.KINDS for s, e in spans[k])
        want.append((i, *(len(spans[k]) for k in P.KINDS), hashlib.sha256(joined.encode()).hexdigest(), joined))
    same(P.digest(P.personal_data(awkward(spark, docs))).collect(), want)


def cues(seeds: int, unseen: list[str], ordinary: int):
    out = [(i, f"{prose(i, 5)} Tel: +1 (555) 200-{1000 + i} {prose(i + 1, 5)}") for i in range(seeds)]
    out += [(100 + i, f"{prose(i, 4)} tel: {u}, {prose(i, 4)}") for i, u in enumerate(unseen)]
    # a cue that introduces ordinary things too
    out += [(200 + i, f"{prose(i, 4)} note: +1 (555) 300-{1000 + i}") for i in range(seeds)]
    out += [(300 + i, f"{prose(i, 4)} note: word{i}") for i in range(ordinary)]
    out.append((400, "note: 555-0000"))
    return out


def test_cues_discover_unseen_numbers(spark):
    docs = cues(12, ["555-0123 456", "555 0199"], 20)
    got = {r.doc_id: r for r in P.personal_data(awkward(spark, docs)).collect()}
    texts = dict(docs)
    for i, u in ((100, "555-0123 456"), (101, "555 0199")):
        start = texts[i].index(u)
        assert [tuple(s) for s in got[i].spans] == [("phone", start, start + len(u))] and got[i].base == []
    assert got[400].spans == [] and all(len(got[i].spans) == 1 for i in range(12))


def test_words_discover_unseen_strings(spark):
    number = lambda i: f"+1 (555) 200-{1000 + i}"
    docs = [(i, f"{prose(i, 5)} please call {number(i)} {prose(i + 1, 5)}") for i in range(12)]
    docs += [(20 + i, f"{prose(i, 5)} phone number\nis {number(50 + i)}, {prose(i + 1, 5)}") for i in range(12)]
    docs += [(40 + i, f"{prose(i, 5)} jo{i}@example.com is my address {prose(i + 1, 5)}") for i in range(12)]
    # beside seeds too, but mostly beside ordinary words
    docs += [(60 + i, f"{prose(i, 5)} the {number(100 + i)}") for i in range(12)] + [(80 + i, f"{prose(i, 5)} the word{i}") for i in range(30)]
    unseen = {100: ("Please call 555-0123 456, then", "555-0123 456", "phone"), 101: ("my phone number is 555 0199.", "555 0199", "phone"), 102: ("jo(at)example is my address now", "jo(at)example", "email")}
    docs += [(i, text) for i, (text, _, _) in unseen.items()] + [(110, "see the 555-0000 there")]
    got = {r.doc_id: r for r in P.personal_data(awkward(spark, docs)).collect()}
    for i, (text, value, kind) in unseen.items():
        start = text.index(value)
        assert [tuple(s) for s in got[i].spans] == [(kind, start, start + len(value))] and got[i].base == [], text
    assert got[110].spans == [] and all(got[i].spans == got[i].base for i in [*range(12), *range(20, 32), *range(40, 52), *range(60, 72), *range(80, 110)] if i in got and i not in unseen)


def test_evidence_against_a_pattern(spark):
    docs, at = [], {}

    def add(cue: str, values: list[str]):
        for v in values:
            at[v] = len(docs)
            docs.append((len(docs), f"{prose(len(docs), 5)} {cue} {v}"))

    number = lambda area, n: [f"+1 (555) {area}-{1000 + i}" for i in range(n)]
    mixed, many = ["555 0101", "jo(at)example"], [f"555 {2000 + i}" for i in range(30)]
    add("contact:", [*number(201, 12), *[f"jo{i}@example.com" for i in range(12)], *mixed])
    add("fon:", [*number(202, 12), *many])
    add("four:", [*number(203, 4), "555 0303"])
    add("three:", [*number(204, 3), "555 0404"])
    sixteen = [f"41111111111{i:05d}" for i in range(60)]
    valid = [v for v in sixteen if luhn(v) % 10 == 0]
    add("order:", [*valid, *(bad := [v for v in sixteen if v not in valid])])
    got = {r.doc_id: [s.kind for s in r.spans] for r in P.personal_data(awkward(spark, docs)).collect()}
    assert [got[at[v]] for v in mixed] == [["phone"], ["email"]]
    assert all(got[at[v]] == ["phone"] for v in many) and got[at["555 0303"]] == ["phone"] and got[at["555 0404"]] == []
    assert len(valid) >= 4 and all("card" not in got[at[v]] for v in bad)


def test_places_are_counted_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "PATTERN_BLOCK", 2)
    docs = awkward(spark, [(1, "a b, a b c"), (1, "a b, a b c"), (2, "A. b"), (3, None), (4, "a")])
    names = ["< a", "> a", "< a b", "> b", "> a b c", "tel:"]
    got = P.places(docs, spark.createDataFrame([(n,) for n in names], "pattern string")).collect()
    assert {r.pattern: r.n_places for r in got} == {"< a": 5, "> a": 2, "< a b": 4, "> b": 5, "> a b c": 2}


def test_surroundings_stay_linear():
    n = 200_000
    texts = ["a" * n, "1" * n, "@" * 50_000, "(" * 100_000, "( " * 50_000, "a:" * 50_000, "1.1" * 50_000, "1 " * 50_000, "(at)" * 30_000]
    texts += ["x: y " + "a" * n, "a" * n + " :", "a" * n + " : b", "http://h/" + "q" * n, "=" * 100_000, "a" + "=" * 100_000, "x:" + " " * n, "x: " * 50_000, "a " * n + ": b"]
    texts += ["note: x " + "a" * n + " end", "(at)" * 50_000 + "@x@", "k=" + "(at)" * 50_000 + "@x@", "=1( " * 50_000, "x =\n" * 50_000, "-- " * 50_000 + "jo@x.de " + "-- " * 50_000]
    texts += ["tel: jo@example.com " * 5_000, "jo@example.com a:b " * 5_000]
    for text in texts:
        begun = time.perf_counter()
        P._with_words(text, P.base_spans(text))
        assert time.perf_counter() - begun < 5, text[:30]


CUE = re.compile(r"(\S*[A-Za-z]\S*[ \t]?[:=])[ \t]*(\+?[0-9(][0-9 ().-]{5,}[0-9]|\S+)")


def test_cues_are_those_of_the_pattern():
    """The linear search gives what one regular expression gives, which takes cubic time."""
    pick = random.Random(5)
    for _ in range(30_000):
        text = "".join(pick.choice(["a", "B", "é", ":", "=", ":", " ", "\t", "\n", "1", "(", "555 0199", ".", "@"]) for _ in range(pick.randrange(1, 22)))
        assert list(P._cues(text)) == [(m.group(1), *m.span(2)) for m in CUE.finditer(text)], repr(text)


def test_addresses_are_those_of_the_pattern():
    shape = re.compile(r"[^\s@]+(?:@|\(at\)|\[at\])[^\s@]+")
    pick = random.Random(6)
    for _ in range(20_000):
        text = "".join(pick.choice(["a", "@", "(at)", "[at]", "(", " ", "b."]) for _ in range(pick.randrange(1, 8)))
        assert bool(P._SHAPE["email"].fullmatch(text)) == bool(shape.fullmatch(text)), repr(text)


def test_words_beside_a_string_may_be_long(spark):
    long = "w" * 1_000
    words = P._Words(f"{long} ... {long}x jo@example.com, ... {long}y")
    start = len(long) * 2 + 7
    assert words.beside(start, start + len("jo@example.com")) == [f"< {long}x", f"< {long} {long}x", f"> {long}y"]


def test_too_few_seeds_teach_nothing(spark):
    docs = [d for d in cues(2, ["555-0123 456"], 0)]
    assert all(r.spans == r.base for r in P.personal_data(awkward(spark, docs)).collect())


def test_redaction_keeps_the_columns(spark):
    docs = awkward(spark, [*AWKWARD, *TEXTS])
    got = P.redacted(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    texts = {r.doc_id: r for r in got.where("doc_id >= 50").collect()}
    assert texts[50].text == "mail [EMAIL], then jo@x or [IP] and 10.0.0.999."
    assert texts[51].text == "card [CARD] phone [PHONE]"
    assert texts[52].text == "é中 [EMAIL]\n[PHONE]" and texts[52].n_chars == len(texts[52].text)
    same(got.where("doc_id < 50 or doc_id is null").select("doc_id", "text").collect(), AWKWARD)


def test_empty_table(spark):
    assert P.digest(P.personal_data(awkward(spark, []))).collect() == []
