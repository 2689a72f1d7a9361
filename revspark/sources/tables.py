"""Driver tables and the shared ``reviews`` source.

``reviews`` = ``documents LEFT JOIN labels USING (doc_id)`` projected to the
canonical raw review shape ``(id, text, label_raw)``.  The join is left to
Catalyst/AQE: at run time AQE turns it into a broadcast hash join only when
the measured size of ``labels`` is below ``autoBroadcastJoinThreshold``,
otherwise it stays a sort-merge join on ``doc_id``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


# Tables whose rows carry long texts: per-row work on them is CPU heavy.
TEXT_TABLES = {"documents", "pages", "conversations", "benchmark"}


def balanced(df: DataFrame) -> DataFrame:
    """Spread a scan over the cluster when it yields fewer input partitions
    than task slots (e.g. a file written as one row group).

    The check only plans the scan (no job).  At scale the scan already has
    more splits than slots and nothing is added; otherwise a round-robin
    repartition lets every core clean its share of the texts.  Filters and
    column pruning still reach the scan below it.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return balanced(df) if name in TEXT_TABLES else df


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews: every document, its ``quality`` label when one exists."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "text")
    lbl = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label_raw"))
    return docs.join(lbl, "id", "left")


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web pages as texts: ``url`` and ``html`` joined by a space."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"),
        F.concat_ws(" ", "url", "html").alias("text"))
