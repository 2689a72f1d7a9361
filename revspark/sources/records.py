"""CSV records that span lines, without one task per file.

A quoted field may hold line breaks, so where a record begins is known only
after counting the quotes before it.  Files are read in their blocks:

1. one pass counts the quotes of each block; prefix sums per file of these
   parities, one small row per block, tell which blocks begin inside a record;
2. each block assembles its own records.  What a block begins or ends inside of
   leaves it as a fragment, at most two per block;
3. fragments of one record meet by a grouping over these few rows.

A file whose quotes do not pair up is not well-formed; ``balanced`` says so.
Lines end with ``\\n``; a ``\\r`` before it is taken off at the end of a record
and kept inside of one.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Blocks up to which their table is broadcast (about 100 bytes each); above, lines are sorted back into their order.
BROADCAST_BLOCKS = 500_000
#: What a row is: a record, or its begin, middle or end; an end comes before a begin of the same block.
WHOLE, END, MIDDLE, BEGIN = 0, 1, 2, 3
SCHEMA = "file string, block long, kind int, first boolean, raw binary"


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, raw): the lines in bytes, and the block each begins in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), F.col("value").cast("binary").alias("raw"))


def block_states(lines: DataFrame) -> DataFrame:
    """(file, block, opened, odd): does the block begin inside a record, and
    is its own number of quotes odd."""
    quotes = F.octet_length("raw") - F.octet_length(F.replace(F.col("raw").cast("string"), F.lit('"'), F.lit("")))
    parity = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return parity.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("opened"), "odd")


def balanced(states: DataFrame) -> bool:
    """Do the quotes of every file pair up?"""
    return states.groupBy("file").agg((F.sum("odd") % 2).alias("left")).filter("left = 1").isEmpty()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"file": pa.string(), "block": pa.int64(), "kind": pa.int32(), "first": pa.bool_(), "raw": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))


def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and fragments of the blocks of a partition, whose lines come in
    their order."""
    at, lines, inside, seen, opened = None, [], False, 0, False
    out: list[tuple] = []

    def close() -> None:
        if lines:  # the block ends inside a record
            out.append((*at, MIDDLE if opened and not seen else BEGIN, False, b"\n".join(lines)))

    for batch in batches:
        for file, block, raw, begun in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "raw", "opened"))):
            if (file, block) != at:
                if at is not None:
                    close()
                at, lines, seen, opened, inside = (file, block), [], 0, begun, begun
            lines.append(raw)
            inside ^= raw.count(b'"') & 1 == 1
            if not inside:
                kind = END if opened and not seen else WHOLE
                out.append((file, block, kind, block == 0 and not seen, b"\n".join(lines)))
                lines, seen = [], seen + 1
        if out:
            yield _batch(out)
            out = []
    if at is not None:
        close()
    if out:
        yield _batch(out)


def records(spark: SparkSession, path: str, encoding: str = "UTF-8", broadcast_blocks: int = BROADCAST_BLOCKS,
            lines: DataFrame | None = None, states: DataFrame | None = None) -> DataFrame:
    """(first, record) of every record of the files; ``first`` marks the one
    at the head of each file.  Empty lines are no records."""
    lines = raw_lines(spark, path) if lines is None else lines
    states = (block_states(lines) if states is None else states).select(
        F.col("file").alias("__file"), F.col("block").alias("__block"), "opened").persist()
    on = (F.col("file") == F.col("__file")) & (F.col("block") == F.col("__block"))
    if states.count() <= broadcast_blocks:
        marked = lines.join(F.broadcast(states), on)  # keeps the order of the lines
    else:
        marked = lines.join(states, on).repartition("file", "block").sortWithinPartitions("file", "block", "line")
    parts = marked.select("file", "block", "raw", "opened").mapInArrow(assembled, SCHEMA)
    whole = parts.filter(F.col("kind") == WHOLE).select("first", "raw")
    # fragments: a record goes on until the next begin
    place = F.struct("block", "kind")
    number = F.sum((F.col("kind") == BEGIN).cast("int")).over(Window.partitionBy("file").orderBy("block", "kind"))
    pieces = parts.filter(F.col("kind") != WHOLE).withColumn("number", number)
    joined = pieces.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct(place.alias("place"), F.col("raw").cast("string").alias("text")))).alias("p"),
        F.max("first").alias("first"))
    mended = joined.select("first", F.array_join(F.col("p.text"), "\n").cast("binary").alias("raw"))
    text = F.col("raw").cast("string") if encoding.upper() == "UTF-8" else F.decode("raw", encoding)
    return whole.unionByName(mended).select("first", F.regexp_replace(text, "\\r$", "").alias("record")).filter("record <> ''")


def read_records(spark: SparkSession, path: str, names: list[str], sep: str = ",", encoding: str = "UTF-8", header: bool = True,
                 **options) -> DataFrame:
    """The records of the files as string columns ``names``."""
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = records(spark, path, encoding, **options)
    if header:
        rows = rows.filter(~F.col("first"))
    parsed = F.from_csv("record", schema, {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return rows.select(parsed.alias("r")).select("r.*")
