"""Queries of the cleaning, label and dataset-quality operators."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.labels import ASCII_DIGITS, UNICODE_DIGITS, normalize_label
from ..operators import filters, quality
from ..sources.tables import page_texts, reviews, table
from .oracle_text import SPACE, cleaned_cte, q, rr, single_step_sql
from .registry import query

R = 6  # rounding of floating results, same in Spark and SQL

# -- shared SQL sources ---------------------------------------------------------
DOCS_RAW = "SELECT doc_id AS id, coalesce(text, '') AS raw FROM documents"
PAGES_RAW = "SELECT page_id AS id, concat_ws(' ', url, html) AS raw FROM pages"
PAGES_HTML = "SELECT page_id AS id, coalesce(html, '') AS raw FROM pages"
REVIEWS_SQL = ("SELECT d.doc_id AS id, coalesce(d.text, '') AS raw, l.quality AS label_raw "
               "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")


def _docs(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")


def _clean_sql(src: str, policy: str, extra: str = "") -> str:
    body, last = cleaned_cte(src, policy)
    return f"WITH {body}\nSELECT id, t AS text{extra} FROM {last}"


# -- full cleaners (T-*) -------------------------------------------------------

def _cleaner(policy):
    def run(spark, sf):
        return T.with_clean_text(_docs(spark, sf), "text", policy, "text").select("id", "text")
    return run


for _p in ("standard", "extended", "embed"):
    query(f"clean_text_{_p}", _clean_sql(DOCS_RAW, _p))(_cleaner(_p))


@query("clean_html_pages", _clean_sql(PAGES_RAW, "standard"))
def clean_html_pages(spark, sf):
    return T.with_clean_text(page_texts(spark, sf), "text", "standard", "text").select("id", "text")


# -- single steps ---------------------------------------------------------------

def _step(fn, source):
    def run(spark, sf):
        df = source(spark, sf)
        return df.select("id", fn(F.coalesce(F.col("text"), F.lit(""))).alias("text"))
    return run


def _pages_html(spark, sf):
    return table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text"))


query("strip_html", single_step_sql(PAGES_HTML, "html"))(_step(T.strip_html, _pages_html))
query("mask_urls", single_step_sql(PAGES_RAW, "url_standard"))(_step(T.mask_urls, page_texts))
query("mask_urls_extended", single_step_sql(PAGES_RAW, "url_extended"))(
    _step(lambda c: T.mask_urls(c, "extended"), page_texts))
query("mask_emails", single_step_sql(DOCS_RAW, "email_standard"))(_step(T.mask_emails, _docs))
query("squash_punctuation", single_step_sql(DOCS_RAW, "punct"))(_step(T.squash_punctuation, _docs))
query("strip_specials", single_step_sql(DOCS_RAW, "specials"))(_step(T.strip_specials, _docs))
query("lower_caps_words", single_step_sql(DOCS_RAW, "caps"))(_step(T.lower_caps_words, _docs))
query("squeeze_repeats", single_step_sql(DOCS_RAW, "REPEAT"))(_step(T.squeeze_repeats, _docs))
query("collapse_whitespace", single_step_sql(DOCS_RAW, "collapse"))(_step(T.collapse_whitespace, _docs))


# -- filters (F3-F7) -------------------------------------------------------------

@query("valid_texts_standard", _clean_sql(DOCS_RAW, "standard") + " WHERE length(t) >= 3")
def valid_texts_standard(spark, sf):
    return filters.valid_texts(_docs(spark, sf), "standard").select("id", "text")


@query("valid_texts_extended", _clean_sql(DOCS_RAW, "extended")
       + f" WHERE length({rr('t', f'^[{SPACE}]+|[{SPACE}]+$', '')}) > 3")
def valid_texts_extended(spark, sf):
    return filters.valid_texts(_docs(spark, sf), "extended").select("id", "text")


@query("valid_texts_embed", _clean_sql(DOCS_RAW, "embed") + " WHERE length(t) > 5")
def valid_texts_embed(spark, sf):
    return filters.valid_texts(_docs(spark, sf), "embed").select("id", "text")


@query("valid_texts_raw", "SELECT doc_id AS id, text FROM documents WHERE text IS NOT NULL AND length(text) > 5")
def valid_texts_raw(spark, sf):
    return filters.valid_texts_raw(_docs(spark, sf))


# -- labels (N1-N5, F7) --------------------------------------------------------

_D = r"[0-9](?:_?[0-9])*"
LABEL_NUM = (r"^[+-]?(?:(?:" + _D + r"(?:\.(?:" + _D + r")?)?|\." + _D + r")(?:e[+-]?" + _D
             + r")?|inf|infinity|nan)$")


def _label_sql(policy: str, x: str = "label_raw") -> str:
    s = f"CAST({x} AS VARCHAR)"
    if policy == "strict":
        return (f"CASE WHEN {x} IS NULL THEN -1 WHEN lower({s}) IN ('positive','pos','1') THEN 1 "
                f"WHEN lower({s}) IN ('negative','neg','0') THEN 0 ELSE -1 END")
    if policy == "standard":
        pos = "('positive','pos','1','true','good','like')"
        neg = "('negative','neg','0','false','bad','dislike')"
        null_v = 0
    else:
        pos = "('positive','pos','1','true','good','like','love','great')"
        neg = "('negative','neg','0','false','bad','dislike','hate','terrible')"
        null_v = -1
    k = rr(f"lower({s})", f"^[{SPACE}]+|[{SPACE}]+$", "")
    kn = f"translate({k}, {q(UNICODE_DIGITS)}, {q(ASCII_DIGITS)})"
    num = f"TRY_CAST(replace({kn}, '_', '') AS DOUBLE)"
    return (f"CASE WHEN {x} IS NULL THEN {null_v} WHEN {k} IN {pos} THEN 1 WHEN {k} IN {neg} THEN 0 "
            f"WHEN {k} IN ('neutral','mixed','0.5') THEN 0 "
            f"WHEN NOT regexp_full_match({kn}, {q(LABEL_NUM)}) OR {num} IS NULL THEN -1 "
            f"WHEN isnan({num}) THEN -1 WHEN {num} > 0.5 THEN 1 ELSE 0 END")


def _labels_query(policy):
    def run(spark, sf):
        return reviews(spark, sf).select("id", normalize_label(F.col("label_raw"), policy).alias("label"))
    return run


for _p in ("standard", "extended", "strict"):
    query(f"normalize_label_{_p}",
          f"SELECT id, CAST({_label_sql(_p)} AS INTEGER) AS label FROM ({REVIEWS_SQL})")(_labels_query(_p))


@query("normalize_label_filter",
       f"SELECT id, CAST(label_raw AS INTEGER) AS label FROM ({REVIEWS_SQL}) WHERE label_raw IN (0, 1)")
def normalize_label_filter(spark, sf):
    return filters.normalize_label_filter(reviews(spark, sf)).select("id", "label")


@query("labelled_only",
       f"SELECT id, label FROM (SELECT id, CAST({_label_sql('extended')} AS INTEGER) AS label "
       f"FROM ({REVIEWS_SQL})) WHERE label IN (0, 1)")
def labelled_only(spark, sf):
    df = reviews(spark, sf).select("id", normalize_label(F.col("label_raw"), "extended").alias("label"))
    return filters.labelled_only(df)


# -- dataset statistics (A1-A6, A18) ---------------------------------------------

STD_CLEAN = cleaned_cte(REVIEWS_SQL, "standard", keep="id, label_raw")


def _std_reviews(spark, sf):
    return filters.clean_reviews(reviews(spark, sf), "standard")


@query("dataset_stats",
       f"WITH {STD_CLEAN[0]} SELECT count(*) AS original_count, "
       f"count(*) FILTER (WHERE length(t) >= 3) AS final_count, "
       f"count(*) - count(*) FILTER (WHERE length(t) >= 3) AS removed_count FROM c")
def dataset_stats(spark, sf):
    df = filters.clean_reviews(_docs(spark, sf), "standard").withColumn("valid", F.length("text") >= 3)
    return quality.dataset_stats(df, "valid")  # labels are not read


WORDS_SQL = f"len(list_filter(string_split(trim({rr('t', f'[{SPACE}]+', ' ')}), ' '), lambda w: length(w) > 0))"


@query("text_stats",
       f"WITH {STD_CLEAN[0]}, v AS (SELECT length(t) AS len, {WORDS_SQL} AS words FROM c WHERE length(t) >= 3) "
       f"SELECT count(*) AS n_texts, round(avg(len), {R}) AS avg_length, "
       f"round(quantile_cont(len, 0.5), {R}) AS median_length, round(avg(words), {R}) AS avg_words, "
       f"round(quantile_cont(words, 0.5), {R}) AS median_words, min(len) AS min_length, "
       f"max(len) AS max_length FROM v")
def text_stats(spark, sf):
    return quality.text_stats(filters.valid_texts(_docs(spark, sf), "standard"))


@query("quality_issues",
       f"WITH {STD_CLEAN[0]}, v AS (SELECT t FROM c WHERE length(t) >= 3) "
       f"SELECT count(*) AS n_texts, count(*) FILTER (WHERE length(t) < 5) AS very_short, "
       f"count(*) FILTER (WHERE length(t) > 1000) AS very_long, "
       f"count(*) - count(DISTINCT t) AS duplicates FROM v")
def quality_issues(spark, sf):
    return quality.quality_issues(filters.valid_texts(_docs(spark, sf), "standard"))


@query("duplicate_texts",
       f"WITH {STD_CLEAN[0]}, v AS (SELECT id, t FROM c WHERE length(t) >= 3), "
       f"g AS (SELECT t, min(id) AS first_id, count(*) AS copies FROM v GROUP BY t HAVING count(*) > 1) "
       f"SELECT v.id, g.first_id, g.copies FROM v JOIN g ON v.t = g.t WHERE v.id <> g.first_id")
def duplicate_texts(spark, sf):
    return quality.duplicate_texts(filters.valid_texts(_docs(spark, sf), "standard"))


EXT_CLEAN = cleaned_cte(REVIEWS_SQL, "extended", keep="id, label_raw")
EXT_VALID = f"length({rr('t', f'^[{SPACE}]+|[{SPACE}]+$', '')}) > 3"


def _ext_labelled(spark, sf):
    df = filters.clean_reviews(reviews(spark, sf), "extended")
    return filters.with_labels(df, "extended")


@query("label_distribution",
       f"WITH {EXT_CLEAN[0]} SELECT label, count(*) AS n FROM "
       f"(SELECT CAST({_label_sql('extended')} AS INTEGER) AS label FROM c WHERE {EXT_VALID}) GROUP BY label")
def label_distribution(spark, sf):
    df = filters.valid_texts(reviews(spark, sf), "extended")
    return quality.label_distribution(filters.with_labels(df, "extended"))


@query("quality_warnings",
       f"WITH {EXT_CLEAN[0]}, v AS (SELECT {EXT_VALID} AS valid, "
       f"CAST({_label_sql('extended')} AS INTEGER) AS label FROM c), "
       f"a AS (SELECT count(*) AS original_count, count(*) FILTER (WHERE valid) AS final_count, "
       f"count(*) FILTER (WHERE valid AND label IN (0, 1)) AS valid_label_count FROM v) "
       f"SELECT original_count, final_count, valid_label_count, valid_label_count > 0 AS has_labels, "
       f"final_count < original_count * 0.8 AS many_texts_removed, "
       f"valid_label_count > 0 AND valid_label_count < final_count * 0.5 AS few_valid_labels FROM a")
def quality_warnings(spark, sf):
    t = F.col("text")
    df = _ext_labelled(spark, sf).withColumn(
        "valid", F.length(F.regexp_replace(t, "^[" + T.SPACE + "]+|[" + T.SPACE + "]+$", "")) > 3)
    return quality.quality_warnings(df, "valid", "label")


@query("has_labels",
       "SELECT count(*) AS n_rows, count(quality) AS n_labelled, "
       "count(DISTINCT quality) + max(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS n_distinct, "
       "count(quality) > 0 AS has_labels, "
       "count(DISTINCT quality) + max(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) <= 10 AS categorical "
       "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id "
       "WHERE d.text IS NOT NULL AND length(d.text) > 5")
def has_labels(spark, sf):
    df = filters.valid_texts_raw(reviews(spark, sf))
    return quality.has_labels(df, "label_raw")

