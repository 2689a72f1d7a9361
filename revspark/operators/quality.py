"""Dataset statistics and quality checks (A1-A6, A18, duplicates).

Each statistic is one aggregate pass: partial aggregation on every task,
one tiny final aggregation.  Medians use Spark's exact ``percentile``
(its buffer holds one counter per *distinct* length, bounded by the longest
text, not by the row count).  Distinct-text counts use a 256-bit digest of
the text as the shuffle key, so whole texts never cross the network.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_count
from ..session import ensure_checkpoint_dir

ROUND = 6


def text_digest(c="text"):
    """32-byte SHA-256 digest of a text, the shuffle key for equality tests."""
    col = F.col(c) if isinstance(c, str) else c
    return F.unhex(F.sha2(col, 256))


def dataset_stats(df: DataFrame, valid: str = "valid") -> DataFrame:
    """original / final / removed counts in one pass over the cleaned rows;
    ``valid`` is the boolean keep-flag of the length filter."""
    keep = F.when(F.col(valid), 1).otherwise(0)
    return df.agg(F.count(F.lit(1)).alias("original_count"),
                  F.coalesce(F.sum(keep), F.lit(0)).alias("final_count")
                  ).withColumn("removed_count", F.col("original_count") - F.col("final_count"))


def text_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """avg/median length and word count, min/max length (one row)."""
    t = F.col(text_col)
    x = df.select(F.length(t).alias("len"), word_count(t).alias("words"))
    return x.agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.round(F.avg("len"), ROUND).alias("avg_length"),
        F.round(F.percentile("len", F.lit(0.5)), ROUND).alias("median_length"),
        F.round(F.avg("words"), ROUND).alias("avg_words"),
        F.round(F.percentile("words", F.lit(0.5)), ROUND).alias("median_words"),
        F.min("len").cast("long").alias("min_length"),
        F.max("len").cast("long").alias("max_length"))


def quality_issues(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Counters of very short (<5) / very long (>1000) and duplicate texts."""
    n = F.length(F.col(text_col))
    return df.agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.sum(F.when(n < 5, 1).otherwise(0)).alias("very_short"),
        F.sum(F.when(n > 1000, 1).otherwise(0)).alias("very_long"),
        (F.count(F.lit(1)) - F.count_distinct(text_digest(text_col))).alias("duplicates"))


def duplicate_texts(df: DataFrame, text_col: str = "text", id_col: str = "id",
                    cut_lineage: bool = True) -> DataFrame:
    """Rows whose text already occurred at a smaller id: ``(id, first_id)``.

    Per-digest ``min(id)`` and counts are pre-aggregated map-side, so a text
    repeated in a third of all rows costs one partial row per task.  Only
    digests seen more than once are joined back; AQE splits a skewed join
    partition if one text is very frequent.
    """
    keyed = df.select(F.col(id_col).alias("id"), text_digest(text_col).alias("h"))
    if cut_lineage:
        # both branches below read the digests: write (id, 32-byte digest)
        # once so the text cleaning above runs once
        ensure_checkpoint_dir(df.sparkSession)
        keyed = keyed.checkpoint()
    groups = (keyed.groupBy("h")
                   .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
                   .filter(F.col("copies") > 1))
    # null-safe equality: no ``isnotnull(h)`` is inferred and pushed below
    # the cleaning projections (the digest is never null anyway)
    j = keyed.join(groups.withColumnRenamed("h", "g"), F.col("h").eqNullSafe(F.col("g")))
    return j.filter(F.col("id") != F.col("first_id")).select("id", "first_id", "copies")


def label_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def quality_warnings(df: DataFrame, valid: str = "valid", label_col: str = "label") -> DataFrame:
    """Warnings of the extended validator, as flags on one stats row.

    ``df`` holds every raw row with the keep-flag ``valid`` and the mapped
    label; one aggregate pass gives all counters.
    """
    kept = F.col(valid)
    p = df.agg(
        F.count(F.lit(1)).alias("original_count"),
        F.coalesce(F.sum(F.when(kept, 1).otherwise(0)), F.lit(0)).alias("final_count"),
        F.coalesce(F.sum(F.when(kept & F.col(label_col).isin(0, 1), 1).otherwise(0)),
                   F.lit(0)).alias("valid_label_count"))
    has = F.col("valid_label_count") > 0
    return p.select(
        "original_count", "final_count", "valid_label_count",
        has.alias("has_labels"),
        (F.col("final_count") < F.col("original_count") * 0.8).alias("many_texts_removed"),
        (has & (F.col("valid_label_count") < F.col("final_count") * 0.5)).alias("few_valid_labels"))


def has_labels(df: DataFrame, label_col: str = "label_raw") -> DataFrame:
    """Runner rule (any non-null label) and dashboard rule (at most 10
    distinct values, a null counting as one value)."""
    c = F.col(label_col)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(c).alias("n_labelled"),
        (F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))).alias("n_distinct"),
    ).select("n_rows", "n_labelled", "n_distinct",
             (F.col("n_labelled") > 0).alias("has_labels"),
             (F.col("n_distinct") <= 10).alias("categorical"))


def require_rows(df: DataFrame, minimum: int = 3) -> int:
    """Action-time guard of the validators: fail when fewer than ``minimum``
    rows survive cleaning (``minimum=1``: when none survive).  Returns the
    row count (one count job)."""
    n = df.count()
    if n < minimum:
        if minimum <= 1:
            raise ValueError("no usable text is left after cleaning")
        raise ValueError(f"{n} usable rows are left, {minimum} are needed")
    return n
