"""What the operators of this package share: input frames, Arrow batches
cut into stretches of bounded size, and tables kept in the shared folder."""
from __future__ import annotations

import ctypes
import functools
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.session import scratch_path
from revspark.sources.tables import table

#: Text bytes that a task turns into numpy arrays at once (about 60 times
#: as much memory); a longer single text makes a stretch of its own.
STRETCH_BYTES = 2 << 20
#: Rows of an Arrow batch while a table is stored.
BATCH_ROWS = 2000
#: Stands for a null doc_id where documents are ordered: after all others.
LAST = (1 << 63) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) of the whole table, spread over the task slots."""
    return table(spark, sf_dir, "documents")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the session's shared folder and
    read it back: lineage is cut, and a lost executor costs a re-read.  Rows
    may carry whole texts, so Arrow batches are kept small meanwhile."""
    spark = df.sparkSession
    path = f"{scratch_path(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before) if int(before) > 0 else BATCH_ROWS, BATCH_ROWS)))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.empty(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def in_stretches(batches: Iterator[pa.RecordBatch], column: str = "text",
                 limit: int = STRETCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` has about ``limit`` bytes in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_bytes(batch.column(column))
        at, n = 0, batch.num_rows
        while at < n:
            to = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
            to = min(n, max(at + 1, to))
            yield batch.slice(at, to - at)
            at = to


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                                       for c, f in zip(columns, schema)], schema=schema)


def doc_key(column: str = "doc_id"):
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST))


#: What operators keep in a worker process between tasks, and how each gives it back.
_kept: dict[str, Callable[[], object]] = {}
_last = [""]


def keeps(operator: str, clear: Callable[[], object]) -> None:
    _kept[operator] = clear


def task(operator: str):
    """Decorates the work of a task on Arrow batches.  Worker processes are
    used again by later stages: what tasks of other operators kept is given
    back first, and freed memory goes back to the system at the end."""
    def wrap(run):
        @functools.wraps(run)
        def inner(batches):
            if _last[0] != operator:
                _last[0] = operator
                for name, clear in _kept.items():
                    if name != operator:
                        clear()
            try:
                yield from run(batches)
            finally:
                give_back()
        return inner
    return wrap


def give_back() -> None:
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
