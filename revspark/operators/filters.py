"""Row filters and projections of the review table.

All are narrow transformations: Catalyst fuses them with the cleaners into
one whole-stage-codegen span and pushes simple predicates into the scan.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import normalize_label, replace_label_words
from ..functions.text import SPACE, preview, with_clean_text


def clean_reviews(df: DataFrame, policy: str = "standard", text_col: str = "text",
                  out_col: str = "text") -> DataFrame:
    """Replace (or add) ``out_col`` with the cleaned text (null -> '')."""
    return with_clean_text(df, text_col, policy, out_col)


def keep_where(df: DataFrame, cond) -> DataFrame:
    """``filter(cond)`` written as a generator (explode of a 0/1-element
    array).

    A plain Filter on a cleaned column is pushed below the cleaning
    projections with the whole cleaning expression copied into the
    predicate, so every row would be cleaned twice.  A Generate is not
    pushed down, and its input is not an attribute, so no filter is
    inferred from it either: the cleaned text is computed once.
    """
    flag = "__keep_row"
    gen = F.explode(F.when(cond, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    return df.withColumn(flag, gen).drop(flag)


# Minimum cleaned length per policy (fixed values of the reference):
# standard keeps length >= 3, extended keeps stripped length > 3,
# embed keeps length > 5; the runner keeps raw length > 5.
def valid_texts(df: DataFrame, policy: str = "standard", text_col: str = "text") -> DataFrame:
    """Clean ``text_col`` with ``policy`` and keep rows long enough to use."""
    out = clean_reviews(df, policy, text_col)
    t = F.col(text_col)
    if policy == "standard":
        return keep_where(out, F.length(t) >= 3)
    if policy == "extended":
        stripped = F.regexp_replace(t, "^[" + SPACE + "]+|[" + SPACE + "]+$", "")
        return keep_where(out, F.length(stripped) > 3)
    if policy == "embed":
        return keep_where(out, F.length(t) > 5)
    raise ValueError(f"unknown policy {policy!r}")


def valid_texts_raw(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Runner filter: drop null texts, keep raw length > 5 (no cleaning)."""
    return df.na.drop(subset=[text_col]).filter(F.length(F.col(text_col)) > 5)


def labelled_only(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Keep rows whose label is a binary class 0/1."""
    return df.filter(F.col(label_col).isin(0, 1))


def with_labels(df: DataFrame, policy: str = "extended", raw_col: str = "label_raw",
                out_col: str = "label") -> DataFrame:
    return df.withColumn(out_col, normalize_label(F.col(raw_col), policy))


def normalize_label_filter(df: DataFrame, raw_col: str = "label_raw",
                           out_col: str = "label") -> DataFrame:
    """Runner rule: map the four label words, keep only values 0 and 1; a
    table without any label (no such column, or null in every row) keeps all
    rows with -1.

    Values are compared as numbers, so a text label ``"1"`` is kept (a
    CSV read by Spark is all strings; numeric label columns behave as in
    the reference).  One small job tells whether there is any label; it
    reads the label column only and stops at the first one."""
    if raw_col not in df.columns or df.select(raw_col).filter(F.col(raw_col).isNotNull()).isEmpty():
        return df.withColumn(out_col, F.lit(-1))
    mapped = replace_label_words(F.col(raw_col))
    num = mapped.try_cast("double")
    return (df.withColumn(out_col, num.cast("int"))
              .filter(num.isin(0.0, 1.0)))


def filter_scored(df: DataFrame, prediction=None, min_probability: float = 0.0) -> DataFrame:
    """Dashboard filter of scored rows by predicted class and probability."""
    out = df
    if prediction is not None:
        out = out.filter(F.col("prediction") == F.lit(prediction))
    return out.filter(F.col("probability") >= F.lit(min_probability))


def review_preview(df: DataFrame, width: int = 100) -> DataFrame:
    """Result projection: id, preview, full text and label."""
    return df.select("id", preview(F.col("text"), width).alias("preview"),
                     F.col("text").alias("full_text"), "label")


def scored_reviews(texts: DataFrame, scored: DataFrame, width: int = 100) -> DataFrame:
    """Texts beside their scores: ``(id, preview, full_text, label, model,
    prediction, probability)``, a row per text and model; a text that no model
    scored has one row without scores.  ``texts``: (id, text, label)."""
    s = scored.select(F.col("id").alias("__id"), "model", "prediction", "probability")
    rows = texts.select("id", preview(F.col("text"), width).alias("preview"), F.col("text").alias("full_text"), "label")
    return rows.join(s, F.col("id") == F.col("__id"), "left").drop("__id")


def preview_head(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows by id (a top-n, not a sample)."""
    return df.orderBy("id").limit(n)


def preview_first(raw: DataFrame, ids: DataFrame, process, n: int = 10) -> DataFrame:
    """``preview_head`` of ``process(raw)`` without processing all of it:
    only rows up to the id that is the 4n-th smallest, then the 16n-th and so
    on, until ``n`` of them survive.  ``ids``: the column ``id`` of ``raw``;
    ``process`` keeps ids and drops or changes rows one by one."""
    many = 4 * n
    while True:
        first = [r["id"] for r in ids.filter("id IS NOT NULL").orderBy("id").limit(many).collect()]  # ids alone
        if len(first) < many:  # all there are
            return preview_head(process(raw), n)
        found = preview_head(process(raw.filter(F.col("id") <= F.lit(first[-1]))), n)
        if found.count() >= n:
            return found
        many *= 4
