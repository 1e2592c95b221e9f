"""Language status queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from crawlprism.functions import text as X
from crawlprism.operators import dictionaries as D
from crawlprism.operators import language as L
from crawlprism.registry.base import registry
from crawlprism.registry.fixtures import MIXED_SQL, load, mixed_texts, sql_list

_COMMON = sql_list(D.ENGLISH_COMMON_WORDS)
_COMMON_IN = "(" + _COMMON[1:-1] + ")"


def language_sql(source: str, key: str, text: str, size: int = 2000) -> str:
    """CTEs up to ``lang_status(key, lang_status)`` for a relation."""
    return f"""chunks AS (
  SELECT {key}, pos, substring({text}, pos + 1, {size}) AS chunk
  FROM (SELECT {key}, {text}, unnest(range(0, length({text}), {size})) AS pos FROM {source})),
chunk_words AS (
  SELECT {key}, pos, regexp_matches(chunk, '{X.NON_LATIN}') AS non_latin,
         regexp_extract_all(lower(chunk), '[a-zA-Z'']+') AS words FROM chunks),
chunk_stats AS (
  SELECT {key}, pos, non_latin, len(words) AS n_words,
         len(list_filter(words, lambda w: w IN {_COMMON_IN})) AS n_common FROM chunk_words),
chunk_classes AS (
  SELECT {key}, pos, CASE WHEN non_latin THEN 'non_latin' WHEN n_words = 0 THEN NULL
         WHEN n_common >= 3 OR n_common / n_words >= 0.3 THEN 'en' ELSE 'non' END AS kind FROM chunk_stats),
seen AS (
  SELECT {key}, bool_or(kind = 'en') AS en, bool_or(kind <> 'en') AS non FROM chunk_classes GROUP BY {key}),
lang_status AS (
  SELECT s.{key}, CASE WHEN en AND non THEN 'mixed' WHEN non THEN 'non_english' ELSE 'english_only' END
         AS lang_status FROM {source} s LEFT JOIN seen USING ({key}))"""


DOCS_SQL = f"WITH {MIXED_SQL}, {language_sql('mixed', 'doc_id', 'text')}"


def _docs(spark, sf):
    return mixed_texts(spark, sf).select("doc_id", "text")


@registry.add(
    "lang_chunks",
    f"{DOCS_SQL} SELECT doc_id, CAST(pos / 2000 AS INT) AS chunk_no, md5(chunk) AS chunk FROM chunks",
)
def _(spark, sf):
    chunks = _docs(spark, sf).select(
        "doc_id", F.posexplode(X.char_chunks("text", 2000)).alias("chunk_no", "chunk")
    )
    return chunks.withColumn("chunk", F.md5("chunk"))


@registry.add(
    "lang_chunks_overlapping",
    f"""WITH {MIXED_SQL} SELECT doc_id, CAST(pos / 1000 AS INT) AS chunk_no, md5(substring(text, pos + 1, 2000)) AS chunk
       FROM (SELECT doc_id, text, unnest(range(0, length(text), 1000)) AS pos FROM mixed)""",
)
def _(spark, sf):
    chunks = _docs(spark, sf).select(
        "doc_id", F.posexplode(X.char_chunks("text", 2000, 1000)).alias("chunk_no", "chunk")
    )
    return chunks.withColumn("chunk", F.md5("chunk"))


@registry.add("lang_status", f"{DOCS_SQL} SELECT doc_id, lang_status FROM lang_status")
def _(spark, sf):
    return L.detect_language(_docs(spark, sf), "text", add_bool=False).select("doc_id", "lang_status")


@registry.add(
    "lang_bool",
    f"""{DOCS_SQL} SELECT lang, lang_status <> 'english_only' AS has_other_lang, count(*) AS n
        FROM lang_status JOIN documents USING (doc_id) GROUP BY ALL""",
)
def _(spark, sf):
    flagged = L.detect_language(mixed_texts(spark, sf).select("lang", "text"), "text")
    return flagged.groupBy("lang", "has_other_lang").agg(F.count(F.lit(1)).alias("n"))


@registry.add(
    "lang_english_only",
    f"{DOCS_SQL} SELECT doc_id FROM lang_status WHERE lang_status = 'english_only'",
)
def _(spark, sf):
    status = L.detect_language(_docs(spark, sf), "text", add_bool=False)
    return status.where(F.col("lang_status") == "english_only").select("doc_id")


# Votes up to and including the first chunk that makes both kinds present.
HEURISTIC_SQL = """running AS (
          SELECT *, count(*) FILTER (WHERE kind = 'en') OVER w AS en_before,
                 count(*) FILTER (WHERE kind <> 'en') OVER w AS non_before
          FROM chunk_classes
          WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        counted AS (SELECT * FROM running WHERE kind IS NOT NULL AND NOT (en_before > 0 AND non_before > 0)),
        votes AS (
          SELECT doc_id, count(*) AS accepted, count(*) FILTER (WHERE kind = 'en') AS en,
                 count(*) FILTER (WHERE kind <> 'en') AS non,
                 coalesce(max(non_before + 1) FILTER (WHERE kind = 'non_latin'), 0) AS top
          FROM counted GROUP BY doc_id),
        heuristic AS (
          SELECT doc_id, lang_status, CAST(coalesce(accepted, 0) AS INT) AS accepted_chunks,
                 CAST(coalesce(en, 0) AS INT) AS en_votes, CAST(coalesce(non, 0) AS INT) AS non_votes,
                 CASE WHEN top > 0 THEN 'non_latin' ELSE '' END AS top_noneng_label,
                 CAST(coalesce(top, 0) AS INT) AS top_noneng_votes, CAST(0.0 AS DOUBLE) AS max_conf
          FROM lang_status LEFT JOIN votes USING (doc_id))"""


@registry.add("lang_debug", f"{DOCS_SQL}, {HEURISTIC_SQL} SELECT * FROM heuristic")
def _(spark, sf):
    return L.detect_language(_docs(spark, sf), "text", add_bool=False, return_debug=True).drop("text")


@registry.add(
    "nonlatin_flag",
    f"WITH {MIXED_SQL} SELECT doc_id, regexp_matches(text, '{X.NON_LATIN}') AS non_latin FROM mixed",
)
def _(spark, sf):
    return _docs(spark, sf).select("doc_id", X.has_non_latin("text").alias("non_latin"))


@registry.add(
    "common_word_ratio",
    f"""WITH {MIXED_SQL} SELECT doc_id, round(CASE WHEN len(words) > 0
          THEN len(list_filter(words, lambda w: w IN {_COMMON_IN})) / len(words) END, 6) AS ratio
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-zA-Z'']+') AS words FROM mixed)""",
)
def _(spark, sf):
    return _docs(spark, sf).select("doc_id", F.round(X.common_word_ratio("text"), 6).alias("ratio"))


# A letter and its base letter differ by exactly the marks removed; the supplied texts
# only hold letters that carry one mark.
@registry.add(
    "diacritic_ratio",
    """SELECT doc_id, round(CASE WHEN length(text) = 0 THEN 0
          ELSE len(list_filter(string_split(text, ''), lambda c: strip_accents(c) <> c)) / length(text) END, 6) AS ratio
       FROM documents""",
)
def _(spark, sf):
    docs = load(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", F.round(X.diacritic_ratio("text"), 6).alias("ratio"))


def marker_predictor() -> L.Predictor:
    """Stand-in for a trained model: votes by the most frequent marker word of four languages."""
    markers = {"en": " the | of | and ", "fr": " le | la | des ", "de": " der | die | und ", "es": " el | los | que "}

    def predict(chunks: pd.Series) -> pd.DataFrame:
        hits = pd.DataFrame({f"__label__{k}": chunks.str.count(v) for k, v in markers.items()}).astype("float64")
        total = hits.sum(axis=1)
        labels = hits.idxmax(axis=1).where(total > 0, None)
        return pd.DataFrame({"label": labels, "prob": hits.max(axis=1) / total.where(total > 0)})

    return predict


# characters removed by Python's str.strip, as a SQL expression
_SPACES = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)"

# The model's votes as running totals: they only grow, so the state at the first early verdict, or at the
# last chunk, is a row of the running totals. Pages that the ladder leaves open take the heuristic's row.
MODEL_SQL = f"""asked AS (
          SELECT * FROM (SELECT doc_id, pos, trim(replace(chunk, chr(10), ' '), {_SPACES}) AS c FROM chunks)
          WHERE length(c) >= 50),
        hits AS (
          SELECT doc_id, pos, c, len(regexp_extract_all(c, ' the | of | and ')) AS n_en, len(regexp_extract_all(c, ' le | la | des ')) AS n_fr,
                 len(regexp_extract_all(c, ' der | die | und ')) AS n_de, len(regexp_extract_all(c, ' el | los | que ')) AS n_es FROM asked),
        best AS (SELECT *, greatest(n_en, n_fr, n_de, n_es) AS most, n_en + n_fr + n_de + n_es AS total FROM hits),
        guessed AS (
          SELECT doc_id, pos, CASE WHEN total = 0 THEN NULL WHEN n_en = most THEN 'en' WHEN n_fr = most THEN 'fr'
                 WHEN n_de = most THEN 'de' ELSE 'es' END AS label, most / nullif(total, 0) AS prob,
                 len(list_filter(string_split(c, ''), lambda x: strip_accents(x) <> x)) / length(c) >= 0.03 AS marked FROM best),
        trusting AS (SELECT *, label IS NOT NULL AND prob >= 0.7 AS trusted FROM guessed),
        firsts AS (
          SELECT *, trusted AND row_number() OVER (PARTITION BY doc_id, label, trusted ORDER BY pos) = 1 AS fresh FROM trusting),
        tally AS (
          SELECT *, count(*) FILTER (WHERE trusted OR marked) OVER w AS accepted, count(*) FILTER (WHERE marked) OVER w AS dia,
                 count(*) FILTER (WHERE trusted AND label = 'en') OVER w AS en,
                 count(*) FILTER (WHERE trusted AND label <> 'en') OVER w + count(*) FILTER (WHERE marked) OVER w AS non,
                 count(*) FILTER (WHERE fresh) OVER w AS n_labels, count(*) FILTER (WHERE fresh AND label <> 'en') OVER w AS n_other,
                 coalesce(max(prob) FILTER (WHERE trusted) OVER w, 0.0) AS conf
          FROM firsts WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
        judged AS (
          SELECT *, CASE WHEN trusted AND n_labels + (dia > 0)::INT >= 2 AND accepted >= 2
                 THEN CASE WHEN non >= 2 AND non / accepted >= 0.4 THEN 'non_english' ELSE 'mixed' END END AS early FROM tally),
        state AS (
          SELECT * FROM judged QUALIFY row_number() OVER (
            PARTITION BY doc_id ORDER BY early IS NULL, CASE WHEN early IS NULL THEN -pos ELSE pos END) = 1),
        other AS (
          SELECT t.doc_id, t.label, count(*) AS n, min(t.pos) AS first_pos FROM trusting t JOIN state s USING (doc_id)
          WHERE t.trusted AND t.label <> 'en' AND t.pos <= s.pos GROUP BY ALL),
        top_other AS (SELECT * FROM other QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_pos) = 1),
        ladder AS (
          SELECT s.*, coalesce(t.label, '') AS top_label, coalesce(t.n, 0) AS top_n, CASE
            WHEN early IS NOT NULL THEN early
            WHEN accepted < 2 THEN NULL
            WHEN en >= 2 AND en / accepted >= 0.75 THEN 'english_only'
            WHEN non = 1 AND n_other + (dia > 0)::INT > 1 THEN 'mixed'
            WHEN non = 1 AND dia > 0 AND (non + dia) / accepted >= 0.4 THEN 'non_english'
            WHEN non = 1 THEN NULL
            WHEN non > 0 AND en = 0 AND non / accepted >= 0.4 THEN 'non_english'
            WHEN non > 0 THEN 'mixed'
            ELSE 'english_only' END AS status,
            early IS NULL AND non = 1 AND dia > 0 AND NOT (en >= 2 AND en / accepted >= 0.75)
              AND NOT n_other + (dia > 0)::INT > 1 AS both_counts
          FROM state s LEFT JOIN top_other t USING (doc_id))"""


@registry.add(
    "lang_model_votes",
    f"""WITH {MIXED_SQL}, {language_sql('mixed', 'doc_id', 'text', 500)}, {HEURISTIC_SQL}, {MODEL_SQL}, said AS (
          SELECT doc_id, coalesce(status, h.lang_status) AS lang_status,
            CASE WHEN status IS NULL THEN h.accepted_chunks ELSE accepted END::INT AS accepted_chunks,
            CASE WHEN status IS NULL THEN h.en_votes ELSE en END::INT AS en_votes,
            CASE WHEN status IS NULL THEN h.non_votes WHEN both_counts THEN non + dia ELSE non END::INT AS non_votes,
            CASE WHEN status IS NULL THEN h.top_noneng_label ELSE top_label END AS top_noneng_label,
            CASE WHEN status IS NULL THEN h.top_noneng_votes ELSE top_n END::INT AS top_noneng_votes,
            CASE WHEN status IS NULL THEN h.max_conf ELSE conf END::DOUBLE AS max_conf
          FROM heuristic h LEFT JOIN ladder USING (doc_id))
        SELECT *, lang_status <> 'english_only' AS has_other_lang FROM said""",
)
def _(spark, sf):
    return L.detect_language(
        _docs(spark, sf), "text", predictor=marker_predictor(), return_debug=True, chunk_size=500
    ).drop("text")
