"""Training rows gathered in blocks, and sums over all blocks.

An optimiser that runs step by step reads its rows many times.  They are
gathered once into blocks, one row of the frame each, so that a task works
with matrices.  The members of a block follow from a hash of the row's id
alone: neither partitions nor the order of the input change them.

``summed`` is the synchronous step: each task adds up what a function gives
for its blocks, the partial sums are added along a tree, and one vector (of
the size of the model, not of the data) reaches the driver.  Features are
bytes, four or eight a number as in the input: a step passes them on as they
are, number by number nothing is converted.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Blocks that one hash bucket is cut into, and bytes of features in a partition.
BLOCKS_PER_BUCKET, PARTITION_BYTES = 64, 64 << 20
#: Partial sums that the driver adds up; more are added in tasks before.
FAN = 16
#: Rows from which a group of blocks is worked on at once.
GROUP_ROWS = 1024


@dataclass
class Blocks:
    """``frame``: (block, x: the rows' features one after the other, as bytes
    of numbers ``kind``, y, w), persisted; ``n`` rows of ``d`` features in
    ``count`` blocks."""
    frame: DataFrame
    n: int
    d: int
    count: int
    partitions: int
    kind: str

    def unpersist(self) -> None:
        self.frame.unpersist()


def gathered(df: DataFrame, rows_per_block: int, vec_col: str = "embedding", label_col: str = "label", id_col: str = "id",
             weight: F.Column | None = None, seed: int = 42) -> Blocks:
    """Blocks of about ``rows_per_block`` rows.  Rows with a null label or
    vector, or a vector of another width than the widest, are left out."""
    element = getattr(df.select(vec_col).schema[0].dataType, "elementType", None)
    kind, sql = ("float32", "float") if isinstance(element, T.FloatType) else ("float64", "double")
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"),
                     (F.lit(1.0) if weight is None else weight.cast("double")).alias("w"),
                     F.col(vec_col).cast(f"array<{sql}>").alias("x")).filter("y IS NOT NULL AND x IS NOT NULL")
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("d")).limit(1).collect()
    n, d = (sizes[0]["n"], sizes[0]["d"]) if sizes else (0, 0)
    buckets = max(1, math.ceil(n / (rows_per_block * BLOCKS_PER_BUCKET)))
    rows = rows.filter(F.size("x") == d).withColumn("h", F.xxhash64(F.lit(seed), "id"))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    per = Window.partitionBy("bucket")
    rows = rows.withColumn("place", F.row_number().over(per.orderBy("h", "id", "y", "x")) - 1)
    rows = rows.withColumn("size", F.count(F.lit(1)).over(per))
    parts = F.greatest(F.lit(1), F.floor(F.col("size") / rows_per_block))
    block = F.col("bucket") * (1 << 20) + F.floor(F.col("place") * parts / F.col("size"))
    slots = df.sparkSession.sparkContext.defaultParallelism
    count = max(1, n // rows_per_block)
    need = math.ceil(n * d * np.dtype(kind).itemsize / PARTITION_BYTES)
    partitions = max(1, min(slots, count), math.ceil(need / slots) * slots if need > slots else need)
    dealt = rows.select(block.cast("long").alias("block"), "place", "y", "w", "x").repartition(partitions, "block")
    frame = dealt.sortWithinPartitions("block", "place").mapInArrow(joined(kind), "block long, x binary, y array<double>, w array<double>").persist()
    return Blocks(frame, n, d, frame.count(), partitions, kind)


def joined(kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (block, place, y, w, x), those of a block one after the other, as
    one row per block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []  # a block goes on in the next batch

        def row():
            y, w = (pa.array([np.concatenate([p[i] for p in parts])], pa.list_(pa.float64())) for i in (1, 2))
            return pa.RecordBatch.from_arrays([pa.array([held], pa.int64()), pa.array([b"".join(p[0] for p in parts)], pa.binary()), y, w],
                                              names=["block", "x", "y", "w"])

        for batch in batches:
            block, y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "y", "w"))
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(y), -1)
            ends = [*(np.flatnonzero(block[1:] != block[:-1]) + 1), len(block)] if len(block) else []
            for i, j in zip([0, *ends], ends):
                if parts and held != block[i]:
                    yield row()
                    parts = []
                held = int(block[i])
                parts.append((x[i:j].tobytes(), y[i:j], w[i:j]))
        if parts:
            yield row()
    return run


def arrays(batch: pa.RecordBatch, d: int, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, x as rows x d, y, w) of each row of a batch."""
    for i in range(batch.num_rows):
        y, w = (np.asarray(batch.column(c)[i].values, dtype=np.float64) for c in ("y", "w"))
        x = np.frombuffer(batch.column("x")[i].as_buffer(), dtype=kind).astype(np.float64)
        yield batch.column("block")[i].as_py(), x.reshape(len(y), d), y, w


def summed(blocks: Blocks, f: Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray | None],
           frame: DataFrame | None = None) -> np.ndarray | None:
    """The sum of ``f(block, x, y, w)`` over all blocks (of ``frame``, some
    of them); None where ``f`` gives nothing."""
    return summed_groups(blocks, lambda some: [f(*block) for block in some], frame, 1)


def summed_groups(blocks: Blocks, f: Callable[[list], list[np.ndarray | None]], frame: DataFrame | None = None,
                  rows: int = GROUP_ROWS) -> np.ndarray | None:
    """As ``summed``, of what ``f`` gives for groups of blocks ``(block, x, y,
    w)`` with at least ``rows`` rows together (but the last of a task): matrix
    products over many blocks take less time than one for each."""
    d, kind = blocks.d, blocks.kind

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held, n = [], 0
        for batch in batches:
            for block in arrays(batch, d, kind):
                held.append(block)
                n += len(block[2])
                if n >= rows:
                    yield held
                    held, n = [], 0
        if held:
            yield held

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for group in groups(batches):
            for part in f(group):
                if part is not None:
                    total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in batch.column(0):
                value = np.frombuffer(part.as_py())
                total = value if total is None else total + value
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts, n = (blocks.frame if frame is None else frame).mapInArrow(local, "part binary"), blocks.partitions
    while n > FAN:
        n = math.ceil(math.sqrt(n))
        parts = parts.repartition(n).mapInArrow(together, "part binary")
    found = [np.frombuffer(part.as_buffer()) for part in parts.toArrow().column("part")]
    return sum(found[1:], found[0].copy()) if found else None


def moments(blocks: Blocks) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population deviation of each feature; 1 for a constant one."""
    if not blocks.n:
        return np.zeros(blocks.d), np.ones(blocks.d)
    mean = summed(blocks, lambda _, x, y, w: x.sum(0)) / blocks.n
    sd = np.sqrt(summed(blocks, lambda _, x, y, w: ((x - mean) ** 2).sum(0)) / blocks.n)
    return mean, np.where(sd > 0, sd, 1.0)
