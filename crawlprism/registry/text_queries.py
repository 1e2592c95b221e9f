"""Text normalisation, tokens, n-grams."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlprism.functions import text as X
from crawlprism.operators import dictionaries as D
from crawlprism.operators import joins, ngrams, signals
from crawlprism.plans import gold
from crawlprism.registry.base import registry
from crawlprism.registry.fixtures import CORPUS_SQL, SALTED_SQL, corpus, labelled_sql, load, salted, sql_list

NORM_TEXT = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"
STOP = "(" + sql_list(D.ENGLISH_STOP_WORDS)[1:-1] + ")"
STOP_WEB = "(" + sql_list(D.ENGLISH_STOP_WORDS + D.WEB_STOP_WORDS)[1:-1] + ")"


def _docs(spark, sf):
    return load(spark, sf, "documents", "doc_id", "text")


@registry.add(
    "normalize_text",
    f"SELECT doc_id, md5({NORM_TEXT}) AS text_norm, length({NORM_TEXT}) AS n FROM documents",
)
def _(spark, sf):
    norm = _docs(spark, sf).select("doc_id", X.normalize_text("text").alias("t"))
    return norm.select("doc_id", F.md5("t").alias("text_norm"), F.length("t").cast("bigint").alias("n"))


@registry.add("min_length_filter", f"SELECT doc_id FROM documents WHERE length({NORM_TEXT}) > 100")
def _(spark, sf):
    return signals.long_enough(_docs(spark, sf), "text").select("doc_id")


@registry.add(
    "num_density",
    r"""SELECT doc_id, round(length(regexp_replace(text, '[^0-9]', '', 'g'))
          / CASE WHEN length(text) > 0 THEN length(text) ELSE 1.0 END, 6) AS num_density FROM documents""",
)
def _(spark, sf):
    return _docs(spark, sf).select("doc_id", F.round(X.digit_density("text"), 6).alias("num_density"))


@registry.add(
    "duplicate_keys",
    """SELECT count(*) AS duplicate_keys FROM (
         SELECT md5(text) FROM documents GROUP BY 1 HAVING count(*) > 1)""",
)
def _(spark, sf):
    return joins.count_duplicate_keys(_docs(spark, sf).select(F.md5("text").alias("digest")), "digest")


@registry.add("distinct_texts", "SELECT DISTINCT md5(text) AS digest FROM documents")
def _(spark, sf):
    return _docs(spark, sf).select(F.md5("text").alias("digest")).distinct()


TOKENS_SQL = """list_filter(regexp_split_to_array(lower(text), '[^A-Za-z0-9_]'), lambda t: t <> '')"""


@registry.add(
    "tokens",
    f"SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS joined FROM (SELECT doc_id, {TOKENS_SQL} AS t FROM documents)",
)
def _(spark, sf):
    t = _docs(spark, sf).select("doc_id", X.word_tokens("text").alias("t"))
    return t.select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.concat_ws(" ", "t")).alias("joined")
    )


@registry.add(
    "tokens_no_stop",
    f"""SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS joined FROM (
          SELECT doc_id, list_filter({TOKENS_SQL}, lambda t: t NOT IN {STOP}) AS t FROM documents)""",
)
def _(spark, sf):
    t = _docs(spark, sf).select("doc_id", X.without_words(X.word_tokens("text")).alias("t"))
    return t.select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.concat_ws(" ", "t")).alias("joined")
    )


@registry.add(
    "line_token_clean",
    f"""SELECT DISTINCT array_to_string(list_filter({TOKENS_SQL}, lambda t: t NOT IN {STOP}), ' ') AS filtered_text
        FROM (SELECT unnest(string_split(text, chr(10))) AS text FROM documents)""",
)
def _(spark, sf):
    lines = _docs(spark, sf).select(F.explode(F.split("text", "\n")).alias("value"))
    return lines.select(
        F.concat_ws(" ", X.without_words(X.word_tokens("value"))).alias("filtered_text")
    ).distinct()


# --- n-grams ----------------------------------------------------------------------------


def ngram_sql(source: str, text: str, n: int, stop: str, group: str = "") -> str:
    """Rows (group, term) of all n-gram occurrences of a relation."""
    head = f"{group}, " if group else ""
    words = f"list_filter(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda w: w NOT IN {stop})"
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"""SELECT {head}{gram} AS term FROM (
        SELECT {head}w, unnest(range(1, len(w) - {n} + 2)) AS i FROM (SELECT {head}{words} AS w FROM {source}))"""


def _top(parts: list[str], k: int) -> str:
    return f"""SELECT term, count(*) AS frequency FROM ({' UNION ALL '.join(parts)}) GROUP BY term
        ORDER BY frequency DESC, term LIMIT {k}"""


@registry.add("unigrams", _top([ngram_sql("documents", "text", 1, STOP)], 25))
def _(spark, sf):
    return ngrams.top_ngrams(_docs(spark, sf), "text", top_n=25)


@registry.add("bigrams", _top([ngram_sql("documents", "text", 2, STOP_WEB)], 25))
def _(spark, sf):
    return ngrams.top_ngrams(
        _docs(spark, sf), "text", (2, 2), additional_stop_words=D.WEB_STOP_WORDS, top_n=25
    )


@registry.add("trigrams", _top([ngram_sql("documents", "text", 3, STOP_WEB)], 25))
def _(spark, sf):
    return ngrams.top_ngrams(
        _docs(spark, sf), "text", (3, 3), additional_stop_words=D.WEB_STOP_WORDS, top_n=25
    )


@registry.add(
    "unigrams_range_1_3", _top([ngram_sql("documents", "text", n, STOP) for n in (1, 2, 3)], 100)
)
def _(spark, sf):
    return ngrams.top_ngrams(_docs(spark, sf), "text", (1, 3), top_n=100)


@registry.add(
    "term_totals",
    f"SELECT term, count(*) AS frequency FROM ({ngram_sql('documents', 'text', 1, STOP)}) GROUP BY term",
)
def _(spark, sf):
    return ngrams.term_counts(_docs(spark, sf), "text")


@registry.add(
    "unigrams_extra_stop",
    f"""WITH {SALTED_SQL} {_top([ngram_sql("salted", "content", 1, STOP_WEB)], 50)}""",
)
def _(spark, sf):
    return ngrams.top_ngrams(salted(spark, sf), "content", additional_stop_words=D.WEB_STOP_WORDS, top_n=50)


LABELLED = f"{CORPUS_SQL}, {labelled_sql('corpus', 'record_id, target_uri')}"
OUTSIDE = r"""outside AS (
  SELECT * FROM labelled WHERE label IS NOT NULL
  AND replace(regexp_extract(target_uri, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), 'www.', '') <> 'census.gov')"""


@registry.add(
    "ngrams_by_label",
    f"""WITH {LABELLED}, {OUTSIDE}, counts AS (
          SELECT label, term, count(*) AS frequency FROM ({ngram_sql("outside", "text_norm", 2, STOP_WEB, "label")})
          GROUP BY ALL)
        SELECT label, term, frequency FROM counts
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY frequency DESC, term) <= 25""",
)
def _(spark, sf):
    return gold.label_ngrams(signals.label_pages(corpus(spark, sf)), (2, 2))


@registry.add(
    "gold_unigrams",
    f"""WITH {LABELLED}, {OUTSIDE}, repack AS (SELECT * FROM outside WHERE label = 'repackages')
        {_top([ngram_sql("repack", "text_norm", 1, STOP_WEB)], 100)}""",
)
def _(spark, sf):
    return gold.repackaged_unigrams(signals.label_pages(corpus(spark, sf)))
