"""Texts compressed inside tasks before they are shuffled, a third to a half
of what the shuffle's own codec would move, and unpacked after it."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

#: Bytes of unpacked text in one batch that a task handles at once.
UNPACKED_BYTES = 4 << 20


def packed(df: DataFrame, column: str = "text", name: str = "packed") -> DataFrame:
    """``df`` with the string ``column`` replaced by ``name``: its UTF-8
    bytes, compressed; null counts as empty."""
    at = df.columns.index(column)
    names = [name if i == at else c for i, c in enumerate(df.columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            data = pa.array([pack((v.as_py() or "").encode()) for v in batch.column(at)], pa.binary())
            yield pa.RecordBatch.from_arrays([data if i == at else c for i, c in enumerate(batch.columns)], names=names)

    fields = [StructField(name, BinaryType()) if i == at else f for i, f in enumerate(df.schema.fields)]
    return df.mapInArrow(run, StructType(fields))


def unpacked(batches: Iterator[pa.RecordBatch], column: str = "packed", name: str = "text") -> Iterator[pa.RecordBatch]:
    """The reverse inside a task; batches are cut to a bounded text size."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        at, begun, texts, size = batch.schema.names.index(column), 0, [], 0
        names = [name if i == at else c for i, c in enumerate(batch.schema.names)]

        def cut(end: int) -> pa.RecordBatch:
            part = batch.slice(begun, end - begun)
            return pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string()) if i == at else c
                                               for i, c in enumerate(part.columns)], names=names)

        for i, value in enumerate(batch.column(at)):
            texts.append(unpack(value.as_py()).decode())
            size += len(texts[-1])
            if size >= UNPACKED_BYTES:
                yield cut(i + 1)
                begun, texts, size = i + 1, [], 0
        if texts:
            yield cut(batch.num_rows)
