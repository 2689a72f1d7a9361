"""Exact dedup by a heavy-hitter split.

Texts are equal when they are identical after deleting every character of
``[\\x20\\x09-\\x0D]``; the SHA-256 of what is left is the digest.

1. One scan of the texts writes (doc_id, code points, digest) to the shared
   folder.  All later steps read only these narrow rows.
2. Misra-Gries: each task keeps at most ``counters`` digests with counters.
   Summed over the tasks, a counter falls short of the true frequency by at
   most n / (counters + 1), and all sums together are at most n.  So every
   digest with more than 2n / (counters + 1) rows has a sum above
   n / (counters + 1), and at most ``counters`` digests have one.
3. These candidates are counted exactly (map-side partial sums).  Their
   winners, at most ``counters`` rows of about 60 bytes whatever the size of
   the input, are broadcast: rows of frequent digests are judged where they
   are and never shuffled.
4. The remaining digests, none with more than 2n / (counters + 1) rows, are
   grouped and joined back by ordinary shuffles.

Defined results: a null text counts as empty; empty texts are equal to each
other and to texts of white space only.  A null doc_id comes after all
others.  Rows that repeat a doc_id with an equal text are one document:
they count in ``group_size`` and share ``kept``; ``drop_copies`` leaves one
of them.  An empty table gives an empty result.  Other columns of the input
are not read by ``decide`` and stay as they are in ``drop_copies``.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, stored

COUNTERS = 1024


def digest_of(text) -> F.Column:
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]", ""), 256)


def fingerprints(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
                       F.unhex(digest_of(F.col("text"))).alias("digest"))


def merged(counts: dict, more: dict, counters: int) -> dict:
    """Misra-Gries merge: add, then take the (counters + 1)-th largest off all."""
    for digest, n in more.items():
        counts[digest] = counts.get(digest, 0) + n
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return {digest: n - cut for digest, n in counts.items() if n > cut}


def frequent(prints: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them each with over
    2n / (counters + 1) rows."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            seen = batch.column(0).value_counts()
            counts = merged(counts, dict(zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist())),
                            counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()),
                                          pa.array(list(counts.values()), pa.int64())], names=["digest", "n"])

    n = prints.count()  # from the Parquet footers
    return (prints.select("digest").mapInArrow(summary, "digest binary, n long")
            .groupBy("digest").agg(F.sum("n").alias("n")).filter(F.col("n") * (counters + 1) > n).select("digest"))


def winners(prints: DataFrame) -> DataFrame:
    """Per digest: its rows, and the doc_id with the most code points, then
    the smallest doc_id."""
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id"))
    return prints.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")).select(
        "digest", F.col("best.doc_id").alias("keep_id"), "group_size")


def decide(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256."""
    prints = stored(fingerprints(docs), "op3-prints")
    heavy = stored(frequent(prints, counters), "op3-heavy")
    hot = stored(winners(prints.join(F.broadcast(heavy), "digest")), "op3-winners")  # at most `counters` rows
    rest = prints.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    judged = prints.join(F.broadcast(hot), "digest").unionByName(rest.join(winners(rest), "digest"))
    return judged.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    verdict = stored(decide(docs, counters), "op3-verdict")
    keep = verdict.filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    marked = docs.withColumn("__sha", digest_of(F.col("text")))
    out = marked.join(keep.withColumnRenamed("__sha", "__keep"),
                      F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__keep")), "left_semi")
    again = verdict.groupBy("doc_id", "text_sha256").count().filter("count > 1")
    if not again.isEmpty():  # one row of each repeated one stays
        out = out.dropDuplicates(["doc_id", "__sha"])
    return out.drop("__sha")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(documents(spark, sf_dir).select("doc_id", "text"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256
FROM (SELECT doc_id, h,
             first_value(doc_id) OVER (PARTITION BY h ORDER BY cp DESC, doc_id NULLS LAST) AS keep_id,
             count(*) OVER (PARTITION BY h) AS group_size
      FROM d)
"""
