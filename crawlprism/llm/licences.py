"""Licence scans: a passage classifier, with template comparison behind it. DataFrame functions only.

Features are the word n-grams (one to three words) of the licence sentences that hold more than function words. A
multinomial logistic regression with an L1 penalty gives them sparse weights for each family, for other legal text
(``unknown``) and for ordinary text (``none``). Temperature and threshold are calibrated on a held-back part of the
training rows.

A paragraph is a line, but notices are wrapped: n-grams have word positions that go on over line ends, up to a line without
words. Where most of a sentence of a family lies close together, that passage is scored by itself, and every family whose
passage reaches the threshold counts, for each line that it takes words of. A line of other legal text, or of a family that is
not confirmed, is ``unknown``; long lines are scored in overlapping windows.

Training rows are the fixed sentences, alone and among ordinary words, and BACKGROUND_ROWS paragraphs of the documents,
the first by a hash. The weights are a table of at most the n-grams of the fixed sentences, which bounds its broadcast.
Lines without any word of those n-grams have no feature and are ``none``, so only the others are taken apart.

Defined cases: null or empty text has no paragraphs. Repeated rows give repeated rows. An empty table gives an empty
result. Other columns are not looked at.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlprism.llm.common import stored
from crawlprism.llm.licence_texts import FAMILIES, ORDINARY, UNKNOWN

# The bound of the sample of background paragraphs, and of what is taken of each.
BACKGROUND_ROWS = 512
BACKGROUND_CHARS = 600

MAX_WORDS = 3
REG_PARAM = 0.002
MIN_COVERAGE = 0.75
MIN_PRECISION = 0.99
# Words of a sentence may be spread over so many times its length.
SPREAD = 2
# Words from one window of a line to the next; a window has twice as many.
STRIDE = 32
# What a line without words adds to the positions: more than a passage can span.
GAP = 1000
# Lines whose words are counted together, for the position of a line.
LINE_BLOCK = 256
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 3.0)
THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)

NONE, OTHER = "none", "unknown"
CLASSES = [NONE, OTHER, *sorted(FAMILIES)]


def local_rows(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """Fixed rows as a frame."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def terms_of(words: Column) -> Column:
    """Distinct n-grams of one to MAX_WORDS words."""
    none = F.array().cast("array<string>")
    grams = [
        F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), _gram(words, n))).otherwise(none)
        for n in range(1, MAX_WORDS + 1)
    ]
    return F.array_distinct(F.concat(*grams))


def _gram(words: Column, n: int):
    return lambda i: F.array_join(F.slice(words, i, n), " ")


@dataclass(frozen=True)
class Vocabulary:
    """The n-grams of the fixed sentences."""

    terms: list[str]
    gate: list[str]  # every term holds one of these words
    sentences: list[tuple[str, list[str]]]  # family and longest n-grams of each sentence
    lengths: list[int]  # words of each sentence


def vocabulary(stop_words: list[str]) -> Vocabulary:
    stop = set(stop_words)

    def split(sentence: str) -> list[str]:
        return re.findall(r"[^\W_]+", sentence.lower())

    def grams(words: list[str], n: int) -> list[str]:
        return list(dict.fromkeys(" ".join(words[i : i + n]) for i in range(len(words) - n + 1)))

    terms, gate, sentences, lengths = set(), set(), [], []
    for family, texts in [*FAMILIES.items(), (OTHER, UNKNOWN)]:
        for text in texts:
            words = split(text)
            own = {g for n in range(1, MAX_WORDS + 1) for g in grams(words, n) if any(w not in stop and not w.isdigit() for w in g.split())}
            terms |= own
            gate |= {w for w in words if w not in stop and not w.isdigit()}
            longest = [g for g in grams(words, min(MAX_WORDS, len(words))) if g in own]
            sentences.append((family, longest))
            lengths.append(len(words))
    return Vocabulary(sorted(terms), sorted(gate), sentences, lengths)


def default_vocabulary() -> Vocabulary:
    return vocabulary(StopWordsRemover.loadDefaultStopWords("english"))


def _strings(values: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<string>")


def background(docs: DataFrame, vocab: Vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(n, text): at most BACKGROUND_ROWS first paragraphs, by hash, that share no long n-gram with the fixed sentences."""
    long = sorted({g for _, grams in vocab.sentences for g in grams})
    paragraph = F.substring(F.element_at(F.split(F.col(text_col), "\n"), 1), 1, BACKGROUND_CHARS)
    rows = docs.where(F.col(text_col).isNotNull()).select(F.xxhash64(id_col).alias("h"), paragraph.alias("text"))
    first = rows.orderBy("h", "text").limit(BACKGROUND_ROWS)
    clean = first.where(~F.arrays_overlap(terms_of(words_of(F.col("text"))), _strings(long)))
    return clean.withColumn("n", F.row_number().over(Window.orderBy("h", "text"))).select("n", "text")


def training_rows(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(label, terms, held): bounded by the fixed sentences and BACKGROUND_ROWS."""
    spark = docs.sparkSession
    fixed = [(CLASSES.index(f), t) for f, texts in [*FAMILIES.items(), (OTHER, UNKNOWN), (NONE, ORDINARY)] for t in texts]
    sentences = local_rows(spark, [{"label": float(c), "n": i, "sentence": t} for i, (c, t) in enumerate(fixed)], "label double, n int, sentence string")
    plain = stored(background(docs, vocab, id_col, text_col), "licence-background")
    n_plain = F.lit(max(plain.count(), 1))
    variants = sentences.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(7)))).withColumn(
        "pick", F.pmod(F.col("n") * 8 + F.col("variant"), n_plain) + 1
    )
    words = words_of(F.col("sentence"))
    around = words_of(F.coalesce("text", F.lit("")))
    size = F.size(words)
    shorter = F.greatest(size - 1, F.lit(1))
    mixed = (
        F.when(F.col("variant") == 1, F.concat(around, words))
        .when(F.col("variant") == 2, F.concat(words, around))
        .when(F.col("variant") == 3, F.concat(around, words, around))
        .when(F.col("variant") == 4, F.slice(words, 1, shorter))
        .when(F.col("variant") == 5, F.slice(words, size - shorter + 1, shorter))
        .when(F.col("variant") == 6, F.concat(F.slice(around, 1, 5), words, F.slice(around, 6, 5)))
        .otherwise(words)
    )
    positive = variants.join(plain.withColumnRenamed("n", "pick"), "pick", "left").select("label", mixed.alias("words"), (F.col("variant") % 4 == 3).alias("held"))
    negative = plain.select(F.lit(float(CLASSES.index(NONE))).alias("label"), words_of(F.col("text")).alias("words"), (F.col("n") % 4 == 3).alias("held"))
    return positive.unionByName(negative).select("label", terms_of(F.col("words")).alias("terms"), "held")


@dataclass(frozen=True)
class Classifier:
    vocab: Vocabulary
    weights: list[list[float]]  # by class, then term
    intercepts: list[float]
    temperature: float
    threshold: float


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    vocab = default_vocabulary()
    rows = stored(training_rows(docs, vocab, id_col, text_col), "licence-training")
    vectors = CountVectorizerModel.from_vocabulary(vocab.terms, inputCol="terms", outputCol="features", binary=True)
    known = vectors.transform(rows)
    learner = LogisticRegression(family="multinomial", maxIter=60, regParam=REG_PARAM, elasticNetParam=1.0, standardization=False)
    model = learner.fit(known.where(~F.col("held")))
    raw = model.transform(known.where("held")).select(F.col("label").cast("int").alias("label"), vector_to_array("rawPrediction").alias("raw"))
    temperature, threshold = _calibrated(stored(raw, "licence-held"))
    return Classifier(vocab, model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist(), temperature, threshold)


def _probabilities(raw: Column, temperature: float) -> Column:
    top = F.array_max(raw)
    powers = F.transform(raw, lambda z: F.exp((z - top) / temperature))
    total = F.aggregate(powers, F.lit(0.0), lambda s, p: s + p)
    return F.transform(powers, lambda p: p / total)


def _calibrated(held: DataFrame) -> tuple[float, float]:
    """The temperature of least log loss; then the least threshold at which predicted families are right often enough."""
    loss = held.agg(
        *[F.avg(-F.log(F.greatest(F.element_at(_probabilities(F.col("raw"), t), F.col("label") + 1), F.lit(1e-12)))).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]
    ).first()
    temperature = min(range(len(TEMPERATURES)), key=lambda i: (loss[f"t{i}"] if loss[f"t{i}"] is not None else 0.0, abs(TEMPERATURES[i] - 1)))
    p = _probabilities(F.col("raw"), TEMPERATURES[temperature])
    guess = held.select("label", F.array_max(p).alias("p"), (F.array_position(p, F.array_max(p)) - 1).alias("guess")).where(F.col("guess") > 1)
    right = guess.agg(*[F.avg(F.when(F.col("p") >= t, (F.col("guess") == F.col("label")).cast("double"))).alias(f"t{i}") for i, t in enumerate(THRESHOLDS)]).first()
    good = [t for i, t in enumerate(THRESHOLDS) if right[f"t{i}"] is not None and right[f"t{i}"] >= MIN_PRECISION]
    return TEMPERATURES[temperature], min(good, default=THRESHOLDS[-1])


def _term_table(spark: SparkSession, c: Classifier) -> DataFrame:
    """(term, j, weights by class, sentences it is a long n-gram of), for terms with either."""
    place: dict[str, list[int]] = {}
    for i, (_, grams) in enumerate(c.vocab.sentences):
        for g in grams:
            place.setdefault(g, []).append(i)
    rows = []
    for j, term in enumerate(c.vocab.terms):
        weights = [row[j] for row in c.weights]
        if any(weights) or term in place:
            rows.append({"term": term, "j": j, "weights": weights, "sentences": place.get(term, [])})
    return local_rows(spark, rows, "term string, j int, weights array<double>, sentences array<int>")


DOC = ["doc_key", "text_key"]
KEY = [*DOC, "pos"]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda s, x: s + x)


def gated_lines(text: Column, gate: Column) -> Column:
    """(pos, start, own, words) of the lines with a gate word; ``words`` go on for what an n-gram may take of the next lines.

    ``start`` is the position of the first of the ``own`` words. Words of blocks of lines are added up first.
    """

    def per_text(lines: Column) -> Column:
        sizes = F.transform(lines, lambda w: F.when(F.size(w) == 0, F.lit(GAP)).otherwise(F.size(w)))
        return _let(sizes, lambda sizes: _let(_blocks(lines, sizes), lambda blocks: per_line(lines, sizes, blocks)))

    def per_line(lines: Column, sizes: Column, blocks: Column) -> Column:
        def row(words: Column, k: Column) -> Column:
            block = F.floor(k / LINE_BLOCK).cast("int")
            start = _sum(F.slice(blocks, 1, block)) + _sum(F.slice(sizes, block * LINE_BLOCK + 1, k - block * LINE_BLOCK))
            own = F.size(words)
            return F.struct(k.alias("pos"), start.alias("start"), own.alias("own"), _with_next(lines, words, k).alias("words"))

        def gated(words: Column, k: Column) -> Column:
            return F.when((F.size(words) > 0) & F.arrays_overlap(_with_next(lines, words, k), gate), row(words, k))

        return F.filter(F.transform(lines, gated), lambda x: x.isNotNull())

    return _let(F.transform(F.split(text, "\n"), words_of), per_text)


def _blocks(lines: Column, sizes: Column) -> Column:
    last = F.floor((F.size(lines) - 1) / LINE_BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: _sum(F.slice(sizes, b * LINE_BLOCK + 1, F.lit(LINE_BLOCK))))


def _with_next(lines: Column, words: Column, k: Column) -> Column:
    none = F.array().cast("array<string>")
    one, two = F.coalesce(F.get(lines, k + 1), none), F.coalesce(F.get(lines, k + 2), none)
    after = F.when(F.size(one) == 1, F.concat(one, F.slice(two, 1, MAX_WORDS - 2))).otherwise(F.slice(one, 1, MAX_WORDS - 1))
    return F.concat(words, after)


def placed_terms() -> Column:
    """(i, n, term) of every n-gram that begins in the line."""
    words, own = F.col("line.words"), F.col("line.own")
    none = F.array().cast("array<struct<i:int,n:int,term:string>>")
    grams = []
    for n in range(1, MAX_WORDS + 1):
        last = F.least(own, F.size(words) - (n - 1))
        placed = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), _placed(words, n))
        grams.append(F.when(last >= 1, placed).otherwise(none))
    return F.concat(*grams)


def _placed(words: Column, n: int):
    return lambda i: F.struct((i - 1).alias("i"), F.lit(n).alias("n"), _gram(words, n)(i).alias("term"))


def _found_terms(docs: DataFrame, c: Classifier, id_col: str, text_col: str) -> DataFrame:
    """(doc_key, text_key, pos, i, n, at, own, j, sentences): the known n-grams with line, place in the line and position."""
    doc_key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_key")
    lines = docs.where(F.col(text_col).isNotNull()).select(
        doc_key, F.md5(F.col(text_col).cast("binary")).alias("text_key"), F.explode(gated_lines(F.col(text_col), _strings(c.vocab.gate))).alias("line")
    )
    terms = lines.select(*DOC, F.col("line.pos").alias("pos"), F.col("line.start").alias("start"), F.col("line.own").alias("own"), F.explode(placed_terms()).alias("t"))
    # the table has at most the n-grams of the fixed sentences
    known = terms.select(*KEY, "t.i", "t.n", (F.col("start") + F.col("t.i")).alias("at"), "own", "t.term").join(
        F.broadcast(_term_table(docs.sparkSession, c).select("term", "j", "sentences")), "term"
    )
    return known.drop("term").distinct()


def _scored(terms: DataFrame, group: list[str], c: Classifier, *more: Column) -> DataFrame:
    """(group, probability, k, more): the best class of each group of n-grams. ``terms`` has each n-gram once."""
    weights = F.broadcast(_term_table(terms.sparkSession, c).select("j", "weights"))
    sums = [F.sum(F.col("weights")[k]).alias(f"w{k}") for k in range(len(CLASSES))]
    raw = F.array(*[F.col(f"w{k}") + F.lit(b) for k, b in enumerate(c.intercepts)])
    summed = terms.join(weights, "j").groupBy(*group).agg(*sums, *more)
    kept = [x for x in summed.columns if x not in {f"w{k}" for k in range(len(CLASSES))}]
    return summed.select(*kept, _probabilities(raw, c.temperature).alias("p")).select(
        *kept, F.array_max("p").alias("probability"), F.array_position("p", F.array_max("p")).cast("int").alias("k")
    )


def passages(found: DataFrame, c: Classifier) -> DataFrame:
    """(doc_key, text_key, sentence, start, end): from an n-gram of a sentence, the words in which most of its n-grams lie."""
    rows = [{"sentence": i, "grams": len(g), "span": SPREAD * n} for i, ((f, g), n) in enumerate(zip(c.vocab.sentences, c.vocab.lengths)) if f != OTHER]
    sentences = local_rows(found.sparkSession, rows, "sentence int, grams int, span int")
    longest = max(r["span"] for r in rows)
    hits = found.select(*DOC, "at", "n", "j", F.explode("sentences").alias("sentence"))
    near = Window.partitionBy(*DOC, "sentence").orderBy("at").rangeBetween(0, longest - 1)
    ahead = (
        hits.withColumn("ahead", F.collect_list(F.struct("at", "n", "j")).over(near))
        .join(F.broadcast(sentences), "sentence")
        .withColumn("ahead", F.array_sort(F.filter("ahead", lambda h: h["at"] + h["n"] <= F.col("at") + F.col("span"))))
    )
    # the first place of each n-gram, so that the passage ends as soon as all are there
    places = F.transform("ahead", lambda h: h["j"])
    firsts = F.filter("ahead", lambda h, k: F.array_position(F.col("places"), h["j"]) == k + 1)
    return (
        ahead.withColumn("places", places)
        .withColumn("firsts", firsts)
        .where(F.size("firsts") >= MIN_COVERAGE * F.col("grams"))
        .select(*DOC, "sentence", F.col("at").alias("start"), F.array_max(F.transform("firsts", lambda h: h["at"] + h["n"])).alias("end"))
        .distinct()
    )


def confirmed_lines(found: DataFrame, c: Classifier) -> DataFrame:
    """(doc_key, text_key, pos, licence, probability) of the lines that a confirmed passage takes words of."""
    spark = found.sparkSession
    longest = SPREAD * max(c.vocab.lengths)
    place = lambda x: F.floor(x / longest)
    group = [*DOC, "sentence", "start", "end"]
    parts = passages(found, c).withColumn("part", F.explode(F.sequence(place(F.col("start")), place(F.col("end")))))
    inside = (
        found.select(*KEY, "at", "n", "j", place(F.col("at")).alias("part"))
        .join(parts, [*DOC, "part"])
        .where((F.col("at") >= F.col("start")) & (F.col("at") + F.col("n") <= F.col("end")))
        .groupBy(*group, "j")
        .agg(F.collect_set("pos").alias("lines"))
    )
    scored = _scored(inside, group, c, F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines"))
    families = local_rows(
        spark, [{"sentence": i, "licence": f, "k": CLASSES.index(f) + 1} for i, (f, _) in enumerate(c.vocab.sentences)], "sentence int, licence string, k int"
    )
    return (
        scored.where(F.col("probability") >= c.threshold)
        .join(F.broadcast(families), ["sentence", "k"])
        .select(*DOC, F.explode("lines").alias("pos"), "licence", "probability")
    )


def legal_lines(found: DataFrame, c: Classifier) -> DataFrame:
    """(doc_key, text_key, pos) of the lines that are not ``none`` by themselves, in any window."""
    own = found.where(F.col("i") + F.col("n") <= F.col("own"))
    w = F.floor(F.col("i") / STRIDE)
    windows = own.select(*KEY, "j", F.explode(F.sequence(F.greatest(w - 1, F.lit(0)), w)).alias("window")).distinct()
    return _scored(windows, [*KEY, "window"], c).where(F.col("k") > 1).select(*KEY)


def licensed_paragraphs(docs: DataFrame, c: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_key, text_key, pos, licences, probability) of the lines that are not ``none``; ``licences`` is empty for unknown ones."""
    found = stored(_found_terms(docs, c, id_col, text_col), "licence-terms")
    other = legal_lines(found, c).select(*KEY, F.lit(None).cast("string").alias("licence"), F.lit(None).cast("double").alias("probability"))
    return confirmed_lines(found, c).unionByName(other).groupBy(*KEY).agg(F.collect_set("licence").alias("licences"), F.max("probability").alias("probability"))


def licences(docs: DataFrame, c: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: lines, those of confirmed licences, other legal ones, the families (sorted, comma-joined) and the best probability."""
    found = licensed_paragraphs(docs, c, id_col, text_col).groupBy("doc_key", "text_key").agg(
        F.count_if(F.size("licences") > 0).alias("n_licensed"),
        F.count_if(F.size("licences") == 0).alias("n_unknown"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("licences")))), ",").alias("licences"),
        F.round(F.max("probability"), 6).alias("probability"),
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = F.size(F.filter(F.split(text, "\n"), lambda p: F.trim(p) != ""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_key"), F.md5(text.cast("binary")).alias("text_key"), n.cast("bigint").alias("n_paragraphs")
    )
    return rows.join(found, ["doc_key", "text_key"], "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n_licensed", F.lit(0)).cast("bigint").alias("n_licensed"),
        F.coalesce("n_unknown", F.lit(0)).cast("bigint").alias("n_unknown"), F.coalesce("licences", F.lit("")).alias("licences"), "probability",
    )
