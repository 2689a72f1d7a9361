"""Positions and running sums in a global order, without a task that sees a
whole group.

Rows are dealt by range over (group, order): a group of any size, a third of
all rows too, spreads over as many partitions as its rows need.  Inside its
partition a row counts on from the partition's first row; what the earlier
partitions of the same group hold is one small row per (partition, group),
summed by a window over these.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import stored


def _runs(group: pa.Array, before) -> tuple[np.ndarray, np.ndarray]:
    """First row of each run of equal neighbours, and whether the batch's
    first row continues the run of ``before``."""
    codes = group.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return first, before is not None and before == (group[0].as_py(),)


def numbered(df: DataFrame, group: str, order: list[str], value: str | None = None, name: str = "ranked") -> DataFrame:
    """``df`` with ``position`` (rows of the same ``group`` before this one)
    and, given the non-negative long column ``value``, ``running`` (its sum
    over these rows).  ``order`` breaks all ties that matter: rows alike in
    all of its columns come in any order.  The sorted table is written once,
    since sampled ranges need not be the same in a second run.  Null groups
    are a group; nulls come first in the order."""
    fields = [*df.schema.fields, StructField("__part", IntegerType()), StructField("__position", LongType()),
              StructField("__running", LongType())]
    at, of = df.columns.index(group), df.columns.index(value) if value else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, rows, total = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            first, goes_on = _runs(batch.column(at), before)
            size = np.diff(np.append(first, n))
            position = np.arange(n) - np.repeat(first, size)
            values = batch.column(of).to_numpy(zero_copy_only=False) if value else np.zeros(n, dtype=np.int64)
            sums = np.cumsum(values) - values
            running = sums - np.repeat(sums[first], size)
            if goes_on:
                position[:size[0]] += rows
                running[:size[0]] += total
            before, rows, total = (batch.column(at)[n - 1].as_py(),), int(position[-1]) + 1, int(running[-1] + values[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part), pa.int32()), pa.array(position),
                                              pa.array(running)], names=[f.name for f in fields])

    keys = [F.col(group), *map(F.col, order)]
    dealt = df.withColumn("__any", F.monotonically_increasing_id())  # splits rows that are alike in all keys
    dealt = dealt.repartitionByRange(*keys, "__any").sortWithinPartitions(*keys, "__any").drop("__any")
    parts = stored(dealt.mapInArrow(run, StructType(fields)), name)
    totals = parts.groupBy("__part", group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(value) if value else F.lit(0)).cast("long").alias("s"))
    # rows: partitions plus groups; a window by group over rows of one partition each
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = totals.select(F.col("__part").alias("__p"), F.col(group).alias("__g"),
                            F.coalesce(F.sum("n").over(before), zero).alias("__n"),
                            F.coalesce(F.sum("s").over(before), zero).alias("__s"))
    # most groups lie in one partition and have nothing before them: only the others are joined
    offsets = offsets.filter("__n > 0")
    out = parts.join(offsets, (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")), "left")
    out = out.withColumn("position", F.col("__position") + F.coalesce("__n", zero))
    if value:
        out = out.withColumn("running", F.col("__running") + F.coalesce("__s", zero))
    return out.drop("__part", "__position", "__running", "__p", "__g", "__n", "__s")
