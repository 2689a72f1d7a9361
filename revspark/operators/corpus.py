"""Corpus analytics of cleaned reviews.

Word statistics explode tokens and count them with a hash aggregate:
partial counts are combined map-side, so a word that makes up a third of
the corpus sends one row per task to the shuffle, not one row per use.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tokens import content_words, whitespace_tokens
from .rows import attach_row

#: Registers of a vocabulary sketch, as a power of two: a relative error of about 0.8 / 2 ** (LG_K / 2).
LG_K = 15
ROUND = 6


def tokenize_words(df: DataFrame, text_col: str = "text", id_col: str = "id") -> DataFrame:
    """Per text: number of content words and of distinct content words."""
    w = content_words(F.col(text_col))
    return df.select(F.col(id_col).alias("id"),
                     F.size(w).cast("long").alias("n_words"),
                     F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"))


def word_frequencies(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n)`` over all texts, stopwords removed."""
    return (df.select(F.explode(content_words(F.col(text_col))).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def top_words(df: DataFrame, text_col: str = "text", n: int = 15) -> DataFrame:
    """The ``n`` most frequent content words; ties broken by the word.

    ``orderBy(...).limit(n)`` is planned as TakeOrderedAndProject: every task
    keeps its own top ``n`` and only those reach the final merge.
    """
    freq = word_frequencies(df, text_col)
    top = freq.orderBy(F.col("n").desc(), F.col("word").asc()).limit(n)
    return top.select(
        F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("word").asc())).cast("long").alias("rank"),
        "word", "n")


def vocabulary_sketches(df: DataFrame, by: tuple = (), text_col: str = "text", lg_k: int = LG_K) -> DataFrame:
    """``(*by, total_words, sketch)``: a mergeable sketch of the distinct
    tokens of each part, 2 ** lg_k registers whatever the vocabulary."""
    toks = df.select(*by, F.explode(whitespace_tokens(F.col(text_col))).alias("tok"))
    return toks.groupBy(*by).agg(F.count(F.lit(1)).alias("total_words"), F.hll_sketch_agg("tok", lg_k).alias("sketch"))


def merged_vocabulary(sketches: DataFrame, by: tuple = ()) -> DataFrame:
    """``(*by, total_words, unique_words)`` of sketches put together; the
    union of parts is the sketch of the whole."""
    both = sketches.groupBy(*by).agg(F.coalesce(F.sum("total_words"), F.lit(0)).alias("total_words"), F.hll_union_agg("sketch").alias("sketch"))
    return both.select(*by, "total_words", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0).cast("long")).alias("unique_words"))


def vocabulary_stats(df: DataFrame, text_col: str = "text", approx: bool = False) -> DataFrame:
    """Total and distinct case-sensitive whitespace tokens (one row).  With
    ``approx`` distinct tokens are estimated (about 0.4 % error) and no token
    is shuffled."""
    if approx:
        return merged_vocabulary(vocabulary_sketches(df, (), text_col))
    toks = df.select(F.explode(whitespace_tokens(F.col(text_col))).alias("tok"))
    return toks.agg(F.count(F.lit(1)).alias("total_words"),
                    F.count_distinct("tok").alias("unique_words"))


def session_overview(df: DataFrame, text_col: str = "text", label_col: str = "label") -> DataFrame:
    """Dashboard overview: reviews, label counts, % positive, diversity.

    One pass over the texts: tokens are exploded with their position
    (``posexplode_outer`` keeps texts without tokens); the row at position
    0 (or the null row of an empty text) stands for its review, so review
    and label counts, token totals and distinct tokens come from a single
    aggregate.
    """
    x = df.select(F.col(label_col).alias("label"),
                  F.posexplode_outer(whitespace_tokens(F.col(text_col))).alias("pos", "tok"))
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    counts = x.agg(
        F.sum(F.when(first, 1).otherwise(0)).alias("total_reviews"),
        F.sum(F.when(first & (F.col("label") == 1), 1).otherwise(0)).alias("positive_count"),
        F.sum(F.when(first & (F.col("label") == 0), 1).otherwise(0)).alias("negative_count"),
        F.count("tok").alias("total_words"),
        F.count_distinct("tok").alias("unique_words"))
    row = counts.select(*[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in
                          ("total_reviews", "positive_count", "negative_count", "total_words", "unique_words")])
    pos, neg = F.col("positive_count"), F.col("negative_count")
    return row.select(
        "total_reviews", "positive_count", "negative_count", "total_words", "unique_words",
        F.when((pos > 0) & (neg > 0), F.round(pos * 100.0 / (pos + neg), ROUND)).alias("pct_positive"),
        F.when(F.col("total_words") > 0,
               F.round(F.col("unique_words") * 100.0 / F.col("total_words"), ROUND)).alias("lexical_diversity"),
        F.when(F.col("total_reviews") > 0,
               F.round(F.col("total_words") / F.col("total_reviews"), ROUND)).alias("words_per_review"))


def length_histogram(df: DataFrame, text_col: str = "text", bins: int = 50) -> DataFrame:
    """Histogram of text lengths with ``bins`` equal-width bins (numpy rules).

    Edges run from min to max length; the last bin is closed on the right;
    if every text has the same length the range is widened by 0.5 on both
    sides.  Bin numbers are computed from integers, so no edge rounding can
    move a value.  One pass over the texts: rows are first counted per
    length (partial aggregation; at most one row per distinct length), and
    min / max / mean and the bins are computed on that small table.
    """
    per_len = (df.select(F.length(F.col(text_col)).cast("long").alias("len"))
                 .groupBy("len").agg(F.count(F.lit(1)).alias("c")))
    rng = per_len.agg(F.min("len").alias("lo"), F.max("len").alias("hi"),
                      (F.sum(F.col("len") * F.col("c")) / F.sum("c")).alias("mean"))
    lo, hi = F.col("lo"), F.col("hi")
    same = lo == hi
    # numpy widens a zero range to [v - 0.5, v + 0.5]; every value then
    # falls into the middle bin.
    b = F.when(same, F.lit(bins // 2)).otherwise(
        F.least(F.lit(bins - 1),
                F.floor((F.col("len") - lo) * bins / (hi - lo)).cast("int")))
    counted = (attach_row(per_len, rng)
                   .select(b.alias("bin"), "c").groupBy("bin").agg(F.sum("c").alias("n")))
    start = F.when(same, lo - 0.5).otherwise(lo.cast("double"))
    width = F.when(same, F.lit(1.0)).otherwise((hi - lo).cast("double")) / bins
    grid = rng.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
                      start.alias("s"), width.alias("w"), "mean")
    return (grid.join(counted, "bin", "left")
                .select("bin",
                        F.round(F.col("s") + F.col("bin") * F.col("w"), ROUND).alias("bin_start"),
                        F.round(F.col("s") + (F.col("bin") + 1) * F.col("w"), ROUND).alias("bin_end"),
                        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
                        F.round(F.col("mean"), ROUND).alias("mean_length")))
