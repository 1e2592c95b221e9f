"""Page language status: common-word heuristic, and a vote over a pluggable chunk model."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlprism.functions import text as X

# A predictor receives the chunk texts of one batch and returns a frame with the
# columns ``label`` (None when there is no prediction) and ``prob``, row for row.
Predictor = Callable[[pd.Series], pd.DataFrame]

# Builds a predictor, once in each worker process. Use it for models that are too large to send with a task.
PredictorFactory = Callable[[], Predictor]

DEBUG_COLUMNS = (
    "accepted_chunks",
    "en_votes",
    "non_votes",
    "top_noneng_label",
    "top_noneng_votes",
    "max_conf",
)
_RESULT = (
    "struct<status: string, accepted_chunks: int, en_votes: int, non_votes: int, "
    "top_noneng_label: string, top_noneng_votes: int, max_conf: double>"
)

MIN_COMMON_WORDS = 3
MIN_COMMON_RATIO = 0.3


def _int(value: int | Column) -> Column:
    return (F.lit(value) if isinstance(value, int) else value).cast("int")


def _result(status, accepted, en, non, top_label, top_votes, conf) -> Column:
    return F.struct(
        (F.lit(status) if isinstance(status, str) else status).alias("status"),
        _int(accepted).alias("accepted_chunks"),
        _int(en).alias("en_votes"),
        _int(non).alias("non_votes"),
        (F.lit(top_label) if isinstance(top_label, str) else top_label).alias("top_noneng_label"),
        _int(top_votes).alias("top_noneng_votes"),
        (F.lit(conf) if isinstance(conf, float) else conf).cast("double").alias("max_conf"),
    )


def _blank(text: Column) -> Column:
    return text.isNull() | (X.strip(text) == "")


# --- heuristic ----------------------------------------------------------------------


def chunk_class(chunk: Column) -> Column:
    """'en', 'non', 'non_latin', or NULL for a chunk without ASCII words."""

    def by_words(words: Column) -> Column:
        def decide(common: Column) -> Column:
            english = (common >= MIN_COMMON_WORDS) | (common / F.size(words) >= MIN_COMMON_RATIO)
            return F.when(english, "en").otherwise("non")

        return F.when(F.size(words) > 0, X.let(X.common_word_count(words), decide))

    return F.when(X.has_non_latin(chunk), "non_latin").otherwise(X.let(X.ascii_words(chunk), by_words))


def chunk_classes(text: Column, chunk_size: int = 2000, step: int | None = None) -> Column:
    return F.transform(X.char_chunks(text, chunk_size, step), chunk_class)


def _heuristic_status(classes: Column) -> Column:
    """The status does not depend on chunk order, so no fold is needed."""
    english = F.exists(classes, lambda c: c == "en")
    other = F.exists(classes, lambda c: c.startswith("non"))
    return X.let(
        F.struct(F.coalesce(english, F.lit(False)).alias("en"), F.coalesce(other, F.lit(False)).alias("non")),
        lambda s: F.when(s["en"] & s["non"], "mixed").when(s["non"], "non_english").otherwise("english_only"),
    )


def _heuristic_votes(classes: Column) -> Column:
    """Vote counts in chunk order; counting stops once both kinds have been seen."""
    start = F.struct(
        _int(0).alias("en"), _int(0).alias("non"), _int(0).alias("top"), F.lit("").alias("label")
    )

    def step(acc: Column, kind: Column) -> Column:
        done = (acc["en"] > 0) & (acc["non"] > 0)
        en = acc["en"] + F.when(kind == "en", 1).otherwise(0)
        non = acc["non"] + F.when(kind.startswith("non"), 1).otherwise(0)
        leads = (kind == "non_latin") & (non > acc["top"])
        counted = F.struct(
            _int(en).alias("en"),
            _int(non).alias("non"),
            _int(F.when(leads, non).otherwise(acc["top"])).alias("top"),
            F.when(leads, "non_latin").otherwise(acc["label"]).alias("label"),
        )
        return F.when(done | kind.isNull(), acc).otherwise(counted)

    def finish(acc: Column) -> Column:
        status = (
            F.when((acc["en"] > 0) & (acc["non"] > 0), "mixed")
            .when(acc["non"] > 0, "non_english")
            .otherwise("english_only")
        )
        return _result(status, acc["en"] + acc["non"], acc["en"], acc["non"], acc["label"], acc["top"], 0.0)

    return F.aggregate(classes, start, step, finish)


# --- model votes ------------------------------------------------------------------------


def model_chunks(text: Column, chunk_size: int, step: int | None, min_chunk_chars: int) -> Column:
    """Chunks as the model sees them: one line, stripped, short ones left out."""
    chunks = F.transform(
        X.char_chunks(text, chunk_size, step), lambda c: X.strip(F.replace(c, F.lit("\n"), F.lit(" ")))
    )
    return F.filter(chunks, lambda c: F.length(c) >= min_chunk_chars)


_VOTES = pa.list_(pa.struct([("label", pa.string()), ("prob", pa.float64()), ("marks", pa.float64())]))

_LOADED: dict[str, Predictor | None] = {}


def _loaded(token: str, factory: PredictorFactory) -> Predictor | None:
    """The worker's predictor; None when it cannot be built, which leaves every page to the heuristic."""
    if token not in _LOADED:
        try:
            _LOADED[token] = factory()
        except Exception:  # noqa: BLE001  (a model that does not load is no reason to lose the load)
            _LOADED[token] = None
    return _LOADED[token]


def _marks(s: str) -> float:
    import unicodedata

    if s.isascii():
        return 0.0
    decomposed = unicodedata.normalize("NFD", s)
    return sum(unicodedata.category(ch) == "Mn" for ch in decomposed) / max(1, len(s))


def _guesses(predictor: Predictor, texts: list[str]) -> list[tuple[str | None, float | None]]:
    """(label, probability) of each chunk. When a batch fails its chunks are tried alone; one that fails has no vote."""

    def ask(some: list[str]) -> list[tuple[str | None, float | None]]:
        found = predictor(pd.Series(some, dtype=object))
        return [
            (None if label is None or pd.isna(label) else str(label), None if prob is None or pd.isna(prob) else float(prob))
            for label, prob in zip(found["label"], found["prob"], strict=True)
        ]

    try:
        out = ask(texts)
        if len(out) == len(texts):
            return out
    except Exception:  # noqa: BLE001
        pass
    if len(texts) == 1:
        return [(None, None)]
    return [_guesses(predictor, [t])[0] for t in texts]


class _Tally:
    """What decides whether a page needs more chunks: the early verdict of ``_model_status``."""

    def __init__(self):
        self.seen, self.accepted, self.dia, self.decided = set(), 0, 0, False

    def add(self, label: str | None, prob: float | None, marks: float, p: dict) -> None:
        marked = marks >= p["diacritic_threshold"]
        trusted = label is not None and prob is not None and prob >= p["conf_threshold"]
        self.accepted += trusted or marked
        self.dia += marked
        if trusted:
            self.seen.add(label.replace("__label__", "").lower())
            kinds = len(self.seen) + (self.dia > 0)
            self.decided = kinds >= 2 and self.accepted >= p["min_accepted_chunks"]


def _scored(pages: pa.ListArray, predictor: Predictor, p: dict) -> pa.ListArray:
    """Votes per page. Round k asks for the k-th chunk of the pages that are still open, all at once.

    Chunks stay in the Arrow batch: a round's texts are Python strings, and a vote is three numbers.
    """
    if not len(pages):
        return pa.nulls(0, _VOTES)
    offsets = pages.offsets.to_numpy().astype(np.int64)
    starts, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    chunks = pages.values.slice(offsets[0], offsets[-1] - offsets[0])
    present = pages.is_valid().to_numpy(zero_copy_only=False)
    labels, probs, marks = np.full(len(chunks), -1, np.int32), np.full(len(chunks), np.nan), np.zeros(len(chunks))
    names: dict[str, int] = {}
    asked = np.zeros(len(pages), np.int64)
    open_ = np.flatnonzero(present & (sizes > 0)).tolist()
    tallies = {i: _Tally() for i in open_}
    k = 0
    while open_:
        places = starts[open_] + k
        texts = pc.array_take(chunks, pa.array(places)).to_pylist()
        for i, at, text, (label, prob) in zip(open_, places.tolist(), texts, _guesses(predictor, texts), strict=True):
            marks[at] = _marks(text)
            tallies[i].add(label, prob, marks[at], p)
            if label is not None:
                labels[at] = names.setdefault(label, len(names))
            if prob is not None:
                probs[at] = prob
        k += 1
        asked[open_] = k
        open_ = [i for i in open_ if not tallies[i].decided and k < sizes[i]]
    # the chunks behind a page's verdict go
    given = np.arange(len(chunks)) - np.repeat(starts, sizes) < np.repeat(asked, sizes)
    codes = labels[given]
    votes = pa.StructArray.from_arrays(
        [pc.array_take(pa.array(list(names), pa.string()), pa.array(codes, mask=codes < 0)), pa.array(probs[given], from_pandas=True), pa.array(marks[given])],
        ["label", "prob", "marks"],
    )
    ends = np.concatenate(([0], np.cumsum(asked))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), votes, mask=pa.array(~present))


def _predict(factory: PredictorFactory, chunks: Column, p: dict) -> Column:
    """Label, probability and diacritic ratio per chunk, up to the early verdict; NULL when there is no model."""
    token = uuid.uuid4().hex

    @F.arrow_udf("array<struct<label: string, prob: double, marks: double>>")
    def vote(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predictor = _loaded(token, factory)
        for pages in batches:
            yield pa.nulls(len(pages), _VOTES) if predictor is None else _scored(pages, predictor, p)
        pa.default_memory_pool().release_unused()

    return vote(chunks)


def _clean_label(label: Column) -> Column:
    return F.lower(F.replace(label, F.lit("__label__"), F.lit("")))


def _is_en(label: Column) -> Column:
    return label.startswith("en")


def _label_counts(seen: Column) -> Column:
    """(label, votes, first position) of each accepted label."""
    return F.transform(
        F.array_distinct(seen),
        lambda label: F.struct(
            F.size(F.filter(seen, lambda x: x == label)).alias("votes"),
            F.negative(F.array_position(seen, label)).alias("earliness"),
            label.alias("label"),
        ),
    )


def _top_other(seen: Column) -> Column:
    """Most voted non-English label, the earliest one on a tie; ('', 0) when there is none."""
    best = F.array_max(_label_counts(F.filter(seen, lambda x: ~_is_en(x))))
    return F.struct(
        F.coalesce(best["label"], F.lit("")).alias("label"), F.coalesce(best["votes"], F.lit(0)).alias("votes")
    )


def _model_status(votes: Column, fallback: Column, p: dict) -> Column:
    """Fold the votes in chunk order, stop at the first early verdict, then run the threshold ladder."""
    start = F.struct(
        _int(0).alias("accepted"),
        _int(0).alias("dia"),
        F.array().cast("array<string>").alias("seen"),
        F.lit(0.0).alias("conf"),
        F.lit("").alias("early"),
    )

    def counts(acc: Column) -> Column:
        en = F.size(F.filter(acc["seen"], _is_en))
        return F.struct(en.alias("en"), (F.size(acc["seen"]) - en + acc["dia"]).alias("non"))

    def step(acc: Column, v: Column) -> Column:
        marked = v["marks"] >= p["diacritic_threshold"]
        trusted = v["label"].isNotNull() & v["prob"].isNotNull() & (v["prob"] >= p["conf_threshold"])
        trusted = trusted & ~F.isnan(v["prob"])
        label = _clean_label(v["label"])
        taken = F.struct(
            _int(acc["accepted"] + F.when(trusted | marked, 1).otherwise(0)).alias("accepted"),
            _int(acc["dia"] + F.when(marked, 1).otherwise(0)).alias("dia"),
            F.when(trusted, F.array_append(acc["seen"], label)).otherwise(acc["seen"]).alias("seen"),
            F.when(trusted & (v["prob"] > acc["conf"]), v["prob"]).otherwise(acc["conf"]).alias("conf"),
        )

        def verdict(t: Column) -> Column:
            kinds = F.size(F.array_distinct(t["seen"])) + F.when(t["dia"] > 0, 1).otherwise(0)
            c = counts(t)
            other = (c["non"] >= p["require_noneng_votes"]) & (
                c["non"] / t["accepted"] >= p["min_noneng_share"]
            )
            ripe = trusted & (kinds >= 2) & (t["accepted"] >= p["min_accepted_chunks"])
            early = F.when(ripe & other, "non_english").when(ripe, "mixed").otherwise("")
            return F.struct(*[t[f].alias(f) for f in ("accepted", "dia", "seen", "conf")], early.alias("early"))

        return F.when(acc["early"] != "", acc).otherwise(X.let(taken, verdict))

    def ladder(acc: Column) -> Column:
        def decide(s: Column) -> Column:
            en, non, dia, accepted = s["c"]["en"], s["c"]["non"], s["acc"]["dia"], s["acc"]["accepted"]
            other_labels = F.size(F.array_distinct(F.filter(s["acc"]["seen"], lambda x: ~_is_en(x))))
            kinds = other_labels + F.when(dia > 0, 1).otherwise(0)
            mostly_en = (en >= p["require_min_en_chunks"]) & (en / accepted >= p["en_chunk_ratio_threshold"])

            def say(status, non_votes: Column = non) -> Column:
                return _result(
                    status, accepted, en, non_votes, s["top"]["label"], s["top"]["votes"], s["acc"]["conf"]
                )

            enough_share = non / accepted >= p["min_noneng_share"]
            weak = (non > 0) & (non < p["require_noneng_votes"])
            return (
                F.when(s["acc"]["early"] != "", say(s["acc"]["early"]))
                .when(accepted < p["min_accepted_chunks"], fallback)
                .when(mostly_en, say("english_only"))
                .when(weak & (kinds > 1), say("mixed"))
                .when(
                    weak & (dia > 0) & ((non + dia) / accepted >= p["min_noneng_share"]),
                    say("non_english", non + dia),
                )
                .when(weak, fallback)
                .when((non > 0) & (en == 0) & enough_share, say("non_english"))
                .when((non > 0) & (en == 0), say("mixed"))
                .when((non > 0) & (en > 0) & (non >= p["require_noneng_votes"]), say("mixed"))
                .when((non > 0) & (en > 0), fallback)
                .otherwise(say("english_only"))
            )

        state = F.struct(acc.alias("acc"), counts(acc).alias("c"), _top_other(acc["seen"]).alias("top"))
        return X.let(state, decide)

    return X.let(F.aggregate(votes, start, step), ladder)


# --- public operator --------------------------------------------------------------------


def detect_language(
    df: DataFrame,
    text_col: str = "content",
    out_col: str = "lang_status",
    add_bool: bool = True,
    bool_col: str | None = "has_other_lang",
    predictor: Predictor | None = None,
    predictor_factory: PredictorFactory | None = None,
    chunk_size: int = 2000,
    step: int | None = None,
    min_chunk_chars: int = 50,
    conf_threshold: float = 0.70,
    en_chunk_ratio_threshold: float = 0.75,
    require_min_en_chunks: int = 2,
    min_accepted_chunks: int = 2,
    require_noneng_votes: int = 2,
    min_noneng_share: float = 0.4,
    diacritic_threshold: float = 0.03,
    return_debug: bool = False,
) -> DataFrame:
    """Add ``english_only`` / ``non_english`` / ``mixed`` per row, and optionally a flag and vote counts.

    Without a ``predictor`` or ``predictor_factory`` everything is a native expression. NULL and
    blank texts count as ``english_only``. A chunk on which the model fails has no vote, and a
    model that cannot be built leaves all pages to the heuristic. Chunks behind the early verdict
    are not scored.
    """
    if predictor is not None and predictor_factory is not None:
        raise ValueError("give a predictor or a predictor_factory, not both")
    factory = predictor_factory if predictor is None else lambda: predictor
    if text_col not in df.columns:
        raise ValueError(f"column {text_col!r} is not in the frame")
    if add_bool and not (bool_col or "").strip():
        raise ValueError("add_bool needs a bool_col name")
    step = chunk_size if step is None else step
    if chunk_size <= 0 or step <= 0:
        raise ValueError("chunk_size and step must be positive")
    if min_chunk_chars < 1:
        raise ValueError("min_chunk_chars must be at least 1")
    for name, share in (
        ("conf_threshold", conf_threshold),
        ("en_chunk_ratio_threshold", en_chunk_ratio_threshold),
        ("min_noneng_share", min_noneng_share),
    ):
        if not 0.0 <= share <= 1.0:
            raise ValueError(f"{name} must be between 0 and 1")

    text = F.col(text_col).cast("string")
    empty = _result("english_only", 0, 0, 0, "", 0, 0.0)
    classes = chunk_classes(text, chunk_size, step)
    if factory is None and not return_debug:
        out = df.withColumn(
            out_col, F.when(_blank(text), "english_only").otherwise(X.let(classes, _heuristic_status))
        )
    else:
        if factory is None:
            scored = df.withColumn("_lang", F.when(_blank(text), empty).otherwise(_heuristic_votes(classes)))
        else:
            p = {
                "conf_threshold": conf_threshold,
                "en_chunk_ratio_threshold": en_chunk_ratio_threshold,
                "require_min_en_chunks": require_min_en_chunks,
                "min_accepted_chunks": min_accepted_chunks,
                "require_noneng_votes": require_noneng_votes,
                "min_noneng_share": min_noneng_share,
                "diacritic_threshold": diacritic_threshold,
            }
            chunks = model_chunks(text, chunk_size, step, min_chunk_chars)
            voted = df.withColumn("_votes", _predict(factory, chunks, p))
            votes = F.col("_votes")
            status = F.when(votes.isNull(), _heuristic_votes(classes)).otherwise(_model_status(votes, _heuristic_votes(classes), p))
            scored = voted.withColumn("_lang", F.when(_blank(text), empty).otherwise(status)).drop("_votes")
        shown = {out_col: F.col("_lang.status")}
        if return_debug:
            shown.update({c: F.col(f"_lang.{c}") for c in DEBUG_COLUMNS})
        out = scored.withColumn("_lang", F.col("_lang").cast(_RESULT)).withColumns(shown).drop("_lang")
    if add_bool:
        out = out.withColumn(bool_col, F.col(out_col).isin("mixed", "non_english"))
    return out
