"""Queries of the corpus analytics (words, histogram, overview, previews)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tokens import LETTERS, STOPWORDS
from ..operators import corpus, filters
from ..operators.rows import attach_row
from ..session import kept
from ..sources.tables import reviews, table
from .oracle_text import SPACE, cleaned_cte, q, rr
from .registry import query
from .text_queries import REVIEWS_SQL, _label_sql

R = 6

# processed reviews: standard cleaning, length >= 3, standard labels
_PROC = cleaned_cte(REVIEWS_SQL, "standard", keep="id, label_raw")
PROCESSED_SQL = (f"WITH {_PROC[0]}, processed AS (SELECT id, t AS text, "
                 f"CAST({_label_sql('standard')} AS INTEGER) AS label FROM c WHERE length(t) >= 3) ")

STOP_SQL = "(" + ", ".join(q(w) for w in sorted(set(STOPWORDS))) + ")"
CONTENT_WORDS_SQL = (
    f"list_filter(string_split(trim({rr(rr('lower(text)', f'[^{LETTERS}{SPACE}]', ' '), f'[{SPACE}]+', ' ')}), ' '), "
    f"lambda w: length(w) >= 3 AND w NOT IN {STOP_SQL})")
WS_TOKENS_SQL = f"list_filter(string_split(trim({rr('text', f'[{SPACE}]+', ' ')}), ' '), lambda w: length(w) > 0)"


def processed(spark, sf):
    df = filters.valid_texts(reviews(spark, sf), "standard")
    return filters.with_labels(df, "standard").select("id", "text", "label")


@query("tokenize_words",
       PROCESSED_SQL + f", w AS (SELECT id, {CONTENT_WORDS_SQL} AS ws FROM processed) "
       "SELECT id, len(ws) AS n_words, len(list_distinct(ws)) AS n_distinct_words FROM w")
def tokenize_words(spark, sf):
    return corpus.tokenize_words(processed(spark, sf))


@query("word_frequencies",
       PROCESSED_SQL + f", w AS (SELECT unnest({CONTENT_WORDS_SQL}) AS word FROM processed) "
       "SELECT word, count(*) AS n FROM w GROUP BY word")
def word_frequencies(spark, sf):
    return corpus.word_frequencies(processed(spark, sf))


@query("top_words",
       PROCESSED_SQL + f", w AS (SELECT unnest({CONTENT_WORDS_SQL}) AS word FROM processed), "
       "f AS (SELECT word, count(*) AS n FROM w GROUP BY word) "
       "SELECT rank, word, n FROM (SELECT row_number() OVER (ORDER BY n DESC, word ASC) AS rank, word, n FROM f) "
       "WHERE rank <= 15")
def top_words(spark, sf):
    return corpus.top_words(processed(spark, sf), n=15)


@query("vocabulary_stats",
       PROCESSED_SQL + f", w AS (SELECT unnest({WS_TOKENS_SQL}) AS tok FROM processed) "
       "SELECT count(*) AS total_words, count(DISTINCT tok) AS unique_words FROM w")
def vocabulary_stats(spark, sf):
    return corpus.vocabulary_stats(processed(spark, sf))


@query("vocabulary_sketch",
       PROCESSED_SQL + f", w AS (SELECT label, unnest({WS_TOKENS_SQL}) AS tok FROM processed) "
       "SELECT 'whole' AS part, count(*) AS total_words, TRUE AS within, TRUE AS same FROM w UNION ALL "
       "SELECT 'by label', count(*), TRUE, TRUE FROM w")
def vocabulary_sketch(spark, sf):
    """Distinct tokens by sketches (A8): of the whole table, and of the parts
    by label put together.  ``within``: at most 2 % off the exact number;
    ``same``: both ways give the same estimate."""
    # four readings follow: the texts are cleaned once and kept in the shared folder
    rows = kept(processed(spark, sf).select("text", "label"), "vocabulary")
    whole = corpus.vocabulary_stats(rows, approx=True).withColumn("part", F.lit("whole")).checkpoint()  # one row, read twice
    parts = corpus.merged_vocabulary(corpus.vocabulary_sketches(rows, ("label",))).withColumn("part", F.lit("by label"))
    exact = corpus.vocabulary_stats(rows).select(F.col("unique_words").alias("exact"))
    both = attach_row(whole.unionByName(parts), exact)
    same = attach_row(both, whole.select(F.col("unique_words").alias("once")))
    close = F.abs(F.col("unique_words") - F.col("exact")) <= 0.02 * F.col("exact")
    return same.select("part", "total_words", close.alias("within"), (F.col("unique_words") == F.col("once")).alias("same"))


@query("session_overview",
       PROCESSED_SQL + f", a AS (SELECT count(*) AS total_reviews, "
       "count(*) FILTER (WHERE label = 1) AS positive_count, count(*) FILTER (WHERE label = 0) AS negative_count, "
       f"CAST(coalesce(sum(len({WS_TOKENS_SQL})), 0) AS BIGINT) AS total_words FROM processed), "
       f"u AS (SELECT count(DISTINCT tok) AS unique_words FROM (SELECT unnest({WS_TOKENS_SQL}) AS tok FROM processed)) "
       "SELECT total_reviews, positive_count, negative_count, total_words, unique_words, "
       f"CASE WHEN positive_count > 0 AND negative_count > 0 THEN round(positive_count * 100.0 / (positive_count + negative_count), {R}) END AS pct_positive, "
       f"CASE WHEN total_words > 0 THEN round(unique_words * 100.0 / total_words, {R}) END AS lexical_diversity, "
       f"CASE WHEN total_reviews > 0 THEN round(total_words / total_reviews, {R}) END AS words_per_review "
       "FROM a, u")
def session_overview(spark, sf):
    return corpus.session_overview(processed(spark, sf))


def _hist_sql(bins: int) -> str:
    return (PROCESSED_SQL + ", l AS (SELECT length(text) AS len FROM processed), "
            "r AS (SELECT min(len) AS lo, max(len) AS hi, avg(len) AS mean FROM l), "
            f"b AS (SELECT CASE WHEN lo = hi THEN {bins // 2} ELSE least({bins - 1}, "
            f"CAST(floor((len - lo) * {bins} / (hi - lo)) AS INTEGER)) END AS bin FROM l, r), "
            "cnt AS (SELECT bin, count(*) AS n FROM b GROUP BY bin), "
            f"g AS (SELECT unnest(range(0, {bins})) AS bin, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS s, "
            f"CASE WHEN lo = hi THEN 1.0 ELSE (hi - lo) END / {bins} AS w, mean FROM r) "
            f"SELECT CAST(g.bin AS INTEGER) AS bin, round(s + g.bin * w, {R}) AS bin_start, "
            f"round(s + (g.bin + 1) * w, {R}) AS bin_end, coalesce(cnt.n, 0) AS n, round(mean, {R}) AS mean_length "
            "FROM g LEFT JOIN cnt ON g.bin = cnt.bin")


@query("length_histogram", _hist_sql(50))
def length_histogram(spark, sf):
    return corpus.length_histogram(processed(spark, sf), bins=50)


@query("length_histogram_dashboard", _hist_sql(30))
def length_histogram_dashboard(spark, sf):
    return corpus.length_histogram(processed(spark, sf), bins=30)


@query("review_preview",
       PROCESSED_SQL + "SELECT id, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END "
       "AS preview, text AS full_text, label FROM processed")
def review_preview(spark, sf):
    return filters.review_preview(processed(spark, sf))


@query("preview_head", PROCESSED_SQL + "SELECT id, text, label FROM processed ORDER BY id LIMIT 10")
def preview_head(spark, sf):
    raw = reviews(spark, sf)
    ids = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return filters.preview_first(raw, ids, lambda df: filters.with_labels(filters.valid_texts(df, "standard"), "standard").select(
        "id", "text", "label"))

