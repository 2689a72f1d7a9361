"""Flagship query: the minimum end-to-end slice."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import word_count
from ..operators import filters
from ..sources.tables import reviews


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reviews -> standard cleaning -> length >= 3 -> standard labels ->
    per label: count, average length, average word count."""
    df = filters.valid_texts(reviews(spark, sf_dir), "standard")
    df = filters.with_labels(df, "standard")
    return (df.groupBy("label")
              .agg(F.count(F.lit(1)).alias("n"),
                   F.round(F.avg(F.length("text")), 6).alias("avg_length"),
                   F.round(F.avg(word_count(F.col("text"))), 6).alias("avg_words")))
