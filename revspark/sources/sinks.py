"""Writers: split tables, embedding tables, run metadata.

Tables go to Parquet.  Splits are written partitioned by ``split`` so a
later stage reading one split prunes the others at planning time.  The
input is computed once, by the write; every writer then compares the rows in
the files' footers with the expected number, if the caller knows it, and with
``decode`` also reads every column back.  (Counting in the write with an
Observation leaves state in the session that later Arrow stages cannot
serialise, so it is not used.)
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _checked_write(df: DataFrame, path: str, mode: str, expected: int | None, decode: bool, *partition: str) -> DataFrame:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition) if partition else writer).parquet(path)
    back = df.sparkSession.read.parquet(path)
    in_footers = back.count()  # metadata only
    decoded = back.agg(F.count(F.xxhash64(*back.columns))).first()[0] if decode else in_footers  # reads every column
    if decoded != in_footers or expected not in (None, in_footers):
        raise ValueError(f"table {path}: {in_footers} rows in the footers, {decoded} readable, {expected} expected")
    return back


def write_splits(df: DataFrame, path: str, mode: str = "overwrite", expected: int | None = None, decode: bool = False) -> DataFrame:
    """Write ``df`` partitioned by ``split``; return per-split counts read back."""
    return _checked_write(df, path, mode, expected, decode, "split").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def write_embeddings(df: DataFrame, path: str, mode: str = "errorifexists", expected: int | None = None,
                     decode: bool = False) -> DataFrame:
    """Write an embedding table; fail if its rows are not those expected.

    ``mode="errorifexists"`` keeps existing embeddings (the reference skips
    the stage when files exist unless forced); pass ``"overwrite"`` to force.
    """
    return _checked_write(df, path, mode, expected, decode)


def preprocess_metadata(stats: DataFrame, small_rows: int = 100) -> DataFrame:
    """One metadata row from the dataset stats row.

    ``stats`` has ``original_count, final_count, has_labels, n_quality_issues``;
    the recommendations are codes: small dataset (< ``small_rows``), no
    labels (inference mode), quality issues.
    """
    recs = F.array_compact(F.array(
        F.when(F.col("final_count") < small_rows, F.lit("small_dataset")),
        F.when(~F.col("has_labels"), F.lit("inference_only")),
        F.when(F.col("n_quality_issues") > 0, F.lit("quality_issues"))))
    return stats.select("original_count", "final_count", "has_labels", "n_quality_issues",
                        (~F.col("has_labels")).alias("inference_only"),
                        F.array_join(recs, "|").alias("recommendations"))
