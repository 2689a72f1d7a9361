"""Tables aligned by position (J1): the n-th vector belongs to the n-th label.

Two tables that were written from the same rows in the same order, each in
files of its own, have no key in common but the position.  A row's position is
its index in its Parquet file plus the rows of the files before, so nothing is
sorted.  Files come in the order of the number that the writer gave them, then
by name.  Only positions and the wanted columns take part in the join.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def file_offsets(files: DataFrame) -> DataFrame:
    """(file, rows, before) for (file, row_index) rows: one small row per file."""
    sizes = files.groupBy("file").agg((F.max("row_index") + 1).alias("rows"))
    name = F.substring_index("file", "/", -1)
    number = F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long")
    folder = F.substring(F.col("file"), F.lit(1), F.length("file") - F.length(name))
    order = Window.orderBy(folder, number, name).rowsBetween(Window.unboundedPreceding, -1)  # rows: files
    return sizes.withColumn("before", F.coalesce(F.sum("rows").over(order), F.lit(0)))


def positioned(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """The table with each row's position over all its files."""
    rows = spark.read.parquet(path)
    columns = rows.columns
    marked = rows.select("*", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.row_index").alias("__i"))
    offsets = file_offsets(rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index")))
    found = marked.join(offsets.select("file", "before"), F.col("__f") == F.col("file"))
    return found.select(*columns, (F.col("before") + F.col("__i")).alias(name))


def aligned(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Rows of both tables side by side, with ``position``.  Tables of
    different lengths or with columns of the same name are an error."""
    n, m = (spark.read.parquet(p).count() for p in (left, right))  # from the footers
    if n != m:
        raise ValueError(f"{left} has {n} rows and {right} has {m}: they cannot be aligned by position")
    a, b = positioned(spark, left), positioned(spark, right, "__position")
    twice = set(a.columns) & set(b.columns)
    if twice:
        raise ValueError(f"both tables have columns {sorted(twice)}")
    return a.join(b, F.col("position") == F.col("__position")).drop("__position")
