"""Personal data: base patterns, and bootstrapped contextual extraction on top of them.

Base spans come from four patterns with checks. They are the seeds. What stands beside a seed induces lexical patterns: the
one to three words left of it, the one to three words right of it, and a cue such as ``mail:`` or ``tel =``, also without a
space. Spark scores the graph of patterns and the strings they introduce: a pattern is as good as its strings, a string as good
as the patterns around it, for a fixed number of rounds. Identifier-shaped strings at high-confidence patterns become added
spans. Every ordinary string behind a cue counts, and every place of the words of a pattern in the corpus without an identifier, so
patterns that stand beside ordinary words lose confidence. Seeds of other kinds and unseen identifier-shaped strings do not count
against a pattern, unless they have the form of the kind and fail its check. The texts are read twice for this: for strings and their surroundings, then for the places of
the words that enough seeds share, PATTERN_BLOCK patterns at a time.

Defined cases: null text is empty and has no spans. Repeated rows give repeated rows. An empty table gives
an empty result. Positions are code points, ends exclusive. Other columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.llm.common import map_batches, stored

KINDS = ("email", "ip", "card", "phone")

# Confidence rules of the graph.
ROUNDS = 3
# With MIN_CONFIDENCE, seeds alone suffice from 4 distinct ones on, and 3 do with unseen strings that other patterns support.
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.8

# A pattern has at most so many words on its side.
MAX_WORDS = 3
# So many patterns are counted in one pass over the texts.
PATTERN_BLOCK = 100_000

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that does not end in a point fails for each of its starts, so only its first is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_DIGIT = re.compile(r"[0-9]")

# What may be an identifier behind a cue, which is a token with a letter up to its last ``:`` or ``=``, or such a sign one
# blank behind it: a spaced number, or a token.
_SIGN = re.compile(r"[:=]")
_LETTER = re.compile(r"[A-Za-z]")
_SPACE = re.compile(r"\s")
_VALUE = re.compile(r"[ \t]*(\+?[0-9(][0-9 ().-]{5,}[0-9]|\S+)")
_SHAPE = {
    # one sign of an address with something on both sides; where there is an @, that is the sign
    "email": re.compile(r"[^\s@]++@[^\s@]+|(?=[^\s@]+\Z)[^\s@]+?(?:\(at\)|\[at\])[^\s@]+"),
    "ip": re.compile(r"[0-9A-Fa-f]+(?:[.:][0-9A-Fa-f]*){3,}"),
    "card": re.compile(r"(?:[0-9][ -]?){11,18}[0-9]"),
    "phone": re.compile(r"\+?[0-9(][0-9 ().-]{5,}[0-9]"),
}
_EDGES = "\"'<>[](){},;.!?"

# Identifier-shaped strings anywhere: around a sign of an address, in parts, or a spaced number.
_AT = re.compile(r"@|\(at\)|\[at\]")
_TOKEN = re.compile(r"\S+")
_PARTS = re.compile(r"(?<![0-9A-Za-z.:])[0-9A-Fa-f]++(?:[.:][0-9A-Fa-f]*+){3,}+")
# NUMBER_CHARS bounds how far the 7 to 19 digits of an unseen number may stretch with the blanks and signs between them.
NUMBER_CHARS = 41
_NUMBER = re.compile(rf"(?<![0-9A-Za-z().+-])\+?[0-9(][0-9 ().-]{{5,{NUMBER_CHARS - 1}}}(?<=[0-9])(?![0-9])")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Addresses around each @. The run of local characters before it holds the leftmost start."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = end + len(text[end:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append((start, end))
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if "@" in text:
        out["email"] = _emails(text)
    if _DIGIT.search(text) is None:
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out["phone"].append(m.span())
    return out


def _cue_at(text: str, at: int, sign: int) -> tuple[int, int, re.Match | None, int]:
    """The first cue not before ``at``, where ``sign`` is the first sign from there: its start and end, the match of what stands
    behind it, and the place to go on from. There may be no match. Each character is looked at a fixed number of times."""
    start = sign
    while start > at and not text[start - 1].isspace():
        start -= 1
    if start == sign and sign - 2 >= at and text[sign - 1] in " \t" and not text[sign - 2].isspace():
        begin = sign - 2
        while begin > at and not text[begin - 1].isspace():
            begin -= 1
        value = _VALUE.match(text, sign + 1) if _LETTER.search(text, begin, sign - 1) else None
        if value:
            return begin, sign + 1, value, value.end()
    gap = _SPACE.search(text, sign)
    end = gap.start() if gap else len(text)
    letter = _LETTER.search(text, start, end)
    if letter is None:
        return start, end, None, end
    if text[end : end + 1] in (" ", "\t") and text[end + 1 : end + 2] in (":", "="):
        value = _VALUE.match(text, end + 2)
        if value:
            return start, end + 2, value, value.end()
    last = max(text.rfind(":", letter.end(), end), text.rfind("=", letter.end(), end))
    if last >= 0:
        value = _VALUE.match(text, last + 1)
        if value is None:  # nothing follows the token: the sign before stands in front of its end
            last = max(text.rfind(":", letter.end(), last), text.rfind("=", letter.end(), last))
            value = _VALUE.match(text, last + 1) if last >= 0 else None
        if value:
            return start, last + 1, value, value.end()
    return start, end, None, end


def _cues(text: str) -> Iterator[tuple[str, int, int]]:
    """Cues in order, with the place of what stands behind each."""
    at = 0
    while sign := _SIGN.search(text, at):
        start, end, value, at = _cue_at(text, at, sign.start())
        if value:
            yield text[start:end], *value.span(1)


def _contexts(text: str, spans: dict[str, list[tuple[int, int]]]) -> list[dict]:
    """What stands behind a cue: the pattern, the string, its place, the base kind or null, the kinds it looks like."""
    out = []
    starts = {s: (kind, e) for kind in reversed(KINDS) for s, e in spans[kind]}
    taken = sorted(x for group in spans.values() for x in group)
    begins, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    for before, start, end in _cues(text):
        raw = text[start:end]
        start += len(raw) - len(raw.lstrip(_EDGES.replace("(", "") if raw[:1] == "(" else _EDGES))
        end = max(start, end - (len(raw) - len(raw.rstrip(_EDGES))))
        kind = None
        if start in starts:
            kind, end = starts[start]
        elif (k := bisect_left(begins, end)) and reach[k - 1] > start:
            continue
        value = text[start:end]
        if value:
            cue = "".join(before.split()).lower().lstrip(_EDGES)
            shapes = [k for k in KINDS if _SHAPE[k].fullmatch(value)] if kind is None else []
            out.append({"cue": cue, "value": value, "start": start, "end": end, "kind": kind, "shapes": shapes})
    return out


def _token_at(text: str, at: int) -> tuple[int, int]:
    start = at
    while start > 0 and not text[start - 1].isspace():
        start -= 1
    return start, _TOKEN.match(text, at).end()


def _identifiers(text: str) -> Iterator[tuple[int, int]]:
    """Places of identifier-shaped strings that are whole tokens but for the signs around them."""
    places, end = [], 0
    for m in _AT.finditer(text):
        if m.start() >= end:
            start, end = _token_at(text, m.start())
            places.append((start, end))
    if _DIGIT.search(text):
        places += [m.span() for m in _PARTS.finditer(text)]
        places += [m.span() for m in _NUMBER.finditer(text) if 7 <= len(_NOT_DIGIT.sub("", m.group())) <= 19]
    last = 0
    for start, end in sorted(places, key=lambda x: (x[0], -x[1])):
        raw = text[start:end]
        start += len(raw) - len(raw.lstrip(_EDGES.replace("(", "") if re.match(r"\([0-9]", raw) else _EDGES))
        end -= len(raw) - len(raw.rstrip(_EDGES))
        if last <= start < end:
            last = end
            yield start, end


def _fails(value: str) -> list[str]:
    """The kinds whose form the string has, but whose check it fails."""
    out, digits = [], _NOT_DIGIT.sub("", value)
    if _IP.fullmatch(value):
        out.append("ip")
    if 13 <= len(digits) <= 19 and _CARD.fullmatch(value) and not _luhn(digits):
        out.append("card")
    return out


def words_of(text: str) -> list[str]:
    return [w for t in text.lower().split() if (w := t.strip(_EDGES))]


class _Words:
    """The words of a text in order, with the places of their tokens; found when first asked for."""

    def __init__(self, text: str):
        self.text, self.words = text, None

    def _find(self) -> None:
        places = [(m.start(), m.end(), w) for m in _TOKEN.finditer(self.text) if (w := m.group().lower().strip(_EDGES))]
        self.starts, self.ends, self.words = [p[0] for p in places], [p[1] for p in places], [p[2] for p in places]

    def beside(self, start: int, end: int) -> list[str]:
        """The patterns of words left and right of a string. What is attached to the string, but for signs, leaves its side out."""
        if self.words is None:
            self._find()
        out, text = [], self.text
        at = start
        while at > 0 and text[at - 1] in _EDGES:
            at -= 1
        if at == 0 or text[at - 1].isspace():
            k = bisect_right(self.ends, start)
            words = self.words[max(0, k - MAX_WORDS) : k]
            out += ["< " + " ".join(words[-n:]) for n in range(1, len(words) + 1)]
        at = end
        while at < len(text) and text[at] in _EDGES:
            at += 1
        if at == len(text) or text[at].isspace():
            k = bisect_left(self.starts, end)
            words = self.words[k : k + MAX_WORDS]
            out += ["> " + " ".join(words[:n]) for n in range(1, len(words) + 1)]
        return out


def _with_words(text: str, spans: dict[str, list[tuple[int, int]]]) -> list[dict]:
    """Strings with their patterns: what stands behind a cue, every base span, and what is identifier-shaped anywhere."""
    found: dict[tuple, dict] = {}
    for c in _contexts(text, spans):
        cue = c.pop("cue")
        found.setdefault((c["start"], c["end"], c["kind"]), {**c, "patterns": []})["patterns"].append(cue)
    taken = [(s, e) for group in spans.values() for s, e in group] + [(c["start"], c["end"]) for c in found.values() if c["kind"] is None and c["shapes"]]
    taken.sort()
    starts, ends = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    for kind in KINDS:
        for start, end in spans[kind]:
            found.setdefault((start, end, kind), {"value": text[start:end], "start": start, "end": end, "kind": kind, "shapes": [], "patterns": []})
    for start, end in _identifiers(text):
        k = bisect_left(starts, end)
        if k and ends[k - 1] > start:
            continue
        shapes = [x for x in KINDS if _SHAPE[x].fullmatch(text, start, end)]
        if shapes:
            key = (start, end, None)
            found.setdefault(key, {"value": text[start:end], "start": start, "end": end, "kind": None, "shapes": [], "patterns": []})["shapes"] = shapes
    words = _Words(text)
    for c in found.values():
        c["fails"] = _fails(c["value"]) if c["shapes"] else []
        if c["kind"] is not None or c["shapes"]:
            c["patterns"] += words.beside(c["start"], c["end"])
    return list(found.values())


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_CONTEXT = pa.struct([
    ("patterns", pa.list_(pa.string())), ("value", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
    ("kind", pa.string()), ("shapes", pa.list_(pa.string())), ("fails", pa.list_(pa.string())),
])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, base, contexts) of every row, in one pass without a shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, contexts = [], []
        for text in batch.column(2).to_pylist():
            spans = base_spans(text)
            base.append([{"kind": k, "start": s, "end": e} for k in KINDS for s, e in spans[k]])
            contexts.append(_with_words(text, spans))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(base, pa.list_(_SPAN)), pa.array(contexts, pa.list_(_CONTEXT))],
            ["doc_id", "text_key", "base", "contexts"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    return map_batches(
        docs.select(F.col(id_col).alias("doc_id"), F.md5(text.cast("binary")).alias("text_key"), text.alias("text")),
        run,
        f"doc_id {kind}, text_key string, base array<struct<kind:string,start:bigint,end:bigint>>, "
        "contexts array<struct<patterns:array<string>,value:string,start:bigint,end:bigint,kind:string,shapes:array<string>,fails:array<string>>>",
    )


def places(docs: DataFrame, patterns: DataFrame, text_col: str = "text") -> DataFrame:
    """(pattern, n_places) of patterns of words: where their words stand with a word on the other side.

    Each pass over the texts counts the patterns of one block, so that a worker holds no more than those.
    """
    spark = docs.sparkSession
    names = stored(patterns.where(F.substring("pattern", 1, 2).isin("< ", "> ")).select("pattern").distinct(), "pii-patterns")
    blocks = -(-names.count() // PATTERN_BLOCK)
    counted = names.select("pattern", F.lit(0).cast("bigint").alias("n")).limit(0)
    for block in range(blocks):
        chosen = names.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast([row[0] for row in chosen])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            left = {p[2:]: 0 for p in shared.value if p[0] == "<"}
            right = {p[2:]: 0 for p in shared.value if p[0] == ">"}
            first = {p.split(" ", 1)[0] for p in [*left, *right]}
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    words = words_of(text)
                    for i, word in enumerate(words):
                        if word not in first:
                            continue
                        gram = word
                        for end in range(i + 1, min(i + MAX_WORDS, len(words)) + 1):
                            if gram in left and end < len(words):
                                left[gram] += 1
                            if gram in right and i > 0:
                                right[gram] += 1
                            if end < len(words):
                                gram = f"{gram} {words[end]}"
            rows = [("< " + g, n) for g, n in left.items() if n] + [("> " + g, n) for g, n in right.items() if n]
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["pattern", "n"])

        texts = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))
        counted = counted.unionByName(stored(texts.mapInArrow(run, "pattern string, n bigint"), "pii-places"))
    return counted.groupBy("pattern").agg(F.sum("n").alias("n_places"))


def induced(
    found: DataFrame, docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that pass, from the graph of patterns and strings.

    The graph has one edge for each distinct pair. Only patterns with at least ``min_seeds`` distinct seeds of a kind take
    part, so that the rounds run on a small part of it. The confidence is good / (good + against + 1): good are the
    distinct seeds, and the scores of unseen strings; against is, for a cue, each distinct ordinary string, and for words each
    place without an identifier. Ordinary is what is no seed and looks like no kind, or fails the check of the kind. A string's
    score comes from the patterns that do not share the nearest word, since patterns that do are no evidence for each other.
    """
    edges = stored(
        found.select(F.explode("contexts").alias("c"))
        .select(F.explode("c.patterns").alias("pattern"), "c.value", F.col("c.kind").alias("seed"), "c.shapes", "c.fails")
        .groupBy("pattern", "value")
        .agg(F.min("seed").alias("seed"), F.max("shapes").alias("shapes"), F.max("fails").alias("fails"), F.count(F.lit(1)).alias("n")),
        "pii-edges",
    )
    support = stored(
        edges.where(F.col("seed").isNotNull())
        .groupBy("pattern", F.col("seed").alias("kind"))
        .agg(F.count(F.lit(1)).cast("double").alias("n_seeds"))
        .where(F.col("n_seeds") >= min_seeds),
        "pii-support",
    )
    known = F.col("seed").isNotNull() | ((F.size("shapes") > 0) & ~F.array_contains("fails", F.col("kind")))
    against = F.sum(F.when(known, 0).otherwise(1))
    strings = edges.join(support, "pattern")
    beside = strings.groupBy("pattern", "kind", "n_seeds").agg(against.alias("others"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("n_known"))
    at_places = F.when(F.col("n_places").isNotNull(), F.greatest(F.col("n_places") - F.col("n_known"), F.lit(0)))
    nodes = stored(
        beside.join(places(docs, support, text_col), "pattern", "left").select(
            "pattern", "kind", "n_seeds", F.coalesce(at_places, "others").cast("double").alias("against")
        ),
        "pii-nodes",
    )
    # the side and the nearest word; a cue is the word left of its string
    words = F.split("pattern", " ")
    nearest = F.when(F.col("pattern").startswith("< "), F.concat(F.lit("< "), F.element_at(words, -1))).when(
        F.col("pattern").startswith("> "), F.concat(F.lit("> "), F.element_at(words, 2))
    )
    unseen = stored(
        strings.where(F.col("seed").isNull() & F.array_contains("shapes", F.col("kind")) & ~F.array_contains("fails", F.col("kind"))).select(
            "pattern", "value", "kind", F.coalesce(nearest, F.concat(F.lit("< "), "pattern")).alias("nearest")
        ),
        "pii-graph",
    )
    confidence = F.col("good") / (F.col("good") + F.col("against") + 1)
    patterns = nodes.withColumn("good", F.col("n_seeds")).select("pattern", "kind", confidence.alias("confidence"))
    for _ in range(rounds):
        sides = (
            unseen.join(patterns, ["pattern", "kind"])
            .groupBy("value", "kind", "nearest")
            .agg(F.log(1 - F.max(F.col("confidence") * F.col("confidence"))).alias("doubt"))
        )
        every = sides.groupBy("value", "kind").agg(F.sum("doubt").alias("doubts"))
        scores = sides.join(every, ["value", "kind"]).select("value", "kind", "nearest", (1 - F.exp(F.col("doubts") - F.col("doubt"))).alias("score"))
        more = unseen.join(scores, ["value", "kind", "nearest"]).groupBy("pattern", "kind").agg(F.sum("score").alias("more"))
        patterns = stored(
            nodes.join(more, ["pattern", "kind"], "left")
            .withColumn("good", F.col("n_seeds") + F.coalesce("more", F.lit(0.0)))
            .select("pattern", "kind", confidence.alias("confidence")),
            "pii-confidence",
        )
    return patterns.where(F.col("confidence") >= min_confidence)


def personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    min_seeds: int = MIN_SEEDS,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """(doc_id, text_key, base, spans): base spans and all spans of every row, by kind, then start.

    What the texts hold is stored, and only patterns, strings and added spans are shuffled.
    """
    found = stored(scan(docs, id_col, text_col), "pii-found")
    patterns = induced(found, docs, text_col, rounds, min_seeds, min_confidence)
    # spans depend on the text alone; the id spreads the copies of a text
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    more = (
        found.where(F.exists("contexts", lambda c: F.size(c["shapes"]) > 0))
        .select(key.alias("doc_key"), "text_key", F.explode("contexts").alias("c"))
        .select("doc_key", "text_key", "c.patterns", F.explode("c.shapes").alias("kind"), "c.start", "c.end")
        .select("doc_key", "text_key", F.explode("patterns").alias("pattern"), "kind", "start", "end")
        .distinct()
        .join(patterns, ["pattern", "kind"])
        # a string that fits several kinds is given to the most confident one, then to the first listed
        .withColumn("rank", F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")))
        .groupBy("doc_key", "text_key", "start", "end")
        .agg(F.max_by("kind", F.struct("confidence", -F.col("rank"))).alias("kind"))
        .groupBy("doc_key", "text_key")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    )
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return (
        found.select("doc_id", key.alias("doc_key"), "text_key", "base")
        .join(more, ["doc_key", "text_key"], "left")
        .select("doc_id", "text_key", "base", _ordered(F.concat("base", F.coalesce("added", none))).alias("spans"))
    )


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", **options) -> DataFrame:
    """The rows, all columns, with every span replaced by its kind in brackets. ``length_col``, if there, is counted anew."""
    found = (
        personal_data(docs, id_col, text_col, **options)
        .where(F.size("spans") > 0)
        .select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_key"), "text_key", F.array_sort("spans", _earlier).alias("spans"))
        .dropDuplicates(["doc_key", "text_key"])
    )
    text = F.col(f"row.`{text_col}`")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_key"),
        F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_key"),
    ).join(found, ["doc_key", "text_key"], "left")
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["at"]
        between = F.when(fresh, F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))).otherwise("")
        tag = F.when(fresh, F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), F.concat(done["out"], between, tag).alias("out"))

    clean = F.aggregate("spans", begin, step, lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))
    changed = rows.select("row", F.when(F.col("spans").isNull(), text).otherwise(clean).alias("clean"))

    def column(name: str) -> Column:
        if name == text_col:
            return F.col("clean").alias(name)
        if name == length_col:
            kind = docs.schema[name].dataType
            return F.when(F.col("clean").isNotNull(), F.length("clean").cast(kind)).otherwise(F.col(f"row.`{name}`")).alias(name)
        return F.col(f"row.`{name}`").alias(name)

    return changed.select(*[column(c) for c in docs.columns])


def _earlier(a: Column, b: Column) -> Column:
    """By start, the longer first."""
    return (
        F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
        .when(a["end"] > b["end"], -1).when(a["end"] < b["end"], 1).otherwise(0)
    )


def _ordered(spans: Column) -> Column:
    """By kind as listed, then start."""
    return F.flatten(F.array(*[F.array_sort(F.filter(spans, _is(kind))) for kind in KINDS]))


def _is(kind: str):
    return lambda span: span["kind"] == kind


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    counts = [F.size(F.filter("base", _is(k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans")
    )
