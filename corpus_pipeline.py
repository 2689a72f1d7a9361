"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of the documents.

1. language ID: documents whose language is not told go;
2. exact dedup: one row of each group of equal texts stays;
3. MinHash near-dedup (shingles of five words, similarity 0.8): one
   document of each linked group stays;
4. benchmark decontamination: documents with a passage of a test item go;
5. BPE: token counts and digests of the documents that are left.

SQL cannot express stages 1, 3 and 4; the tests hold the whole run against
plain Python on a small fixture.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revspark.llm import op3_exact_dedup, op6_language_id, op7_decontaminate, op8_bpe, op10_near_dedup
from revspark.llm.common import documents, stored
from revspark.sources.tables import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6_language_id.filter_known(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op3_exact_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_near_dedup.keep_one(docs, size=5, similarity=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_bpe.encode_digests(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
