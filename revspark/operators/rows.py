"""Helpers for one-row aggregate results."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row of ``df``.

    The optimiser folds the constant key away and plans a broadcast
    nested-loop join whose broadcast side is one row by construction: every
    row of ``df`` meets exactly one row, where it is, without a shuffle.
    """
    k = "__one_row_key"
    return (df.withColumn(k, F.lit(1))
              .join(F.broadcast(one_row.withColumn(k, F.lit(1))), k)
              .drop(k))
