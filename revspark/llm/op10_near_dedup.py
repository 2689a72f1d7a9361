"""Near-dedup by fast similarity sketching, banding and exact verification.

Sketch.  ``bins`` = bands * rows coordinates.  In round i < bins every
shingle of a document throws one hashed value into one hashed bin; in round
i >= bins into bin i - bins.  A bin keeps the smallest value of the first
round that reaches it, so after 2 * bins rounds at the latest every
coordinate is filled, usually after one or two, and two documents agree in
a coordinate with their Jaccard similarity as probability, with
concentration as if the coordinates were independent.  With 32 bands of 4
rows, two documents at similarity 0.8 share no band with probability
(1 - 0.8**4)**32 < 5e-8.

Links.  Documents with the same set are one class, represented by their
smallest doc_id, so exact copies never meet again.  Classes that share a
band are a bucket.  Exact verification compares full shingle sets:

1. a star per bucket: one hub (smallest hash) against every other member;
2. connected components of the confirmed links.  Members of a bucket that
   are already connected need no comparison;
3. the open pairs of small buckets, those of unconnected members whose set
   sizes allow the similarity, are compared one by one;
4. large buckets with unconnected members are compared in blocks of about
   ``CHUNK`` members against as many; a block counts the shingles that its
   documents share and emits links only.

So no pair of a bucket is skipped unless it is connected, compared or
impossible by size, and a group of copies that are linked to their hub costs
one comparison per member.  Set sizes and hashes travel with the bucket rows,
the texts themselves, packed, only for classes in a bucket with others.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  A
document with fewer words than a shingle has its whole sequence as one; with
no text or no words its set is empty, it is linked with nothing and kept.  A
null doc_id (ids are integers) is linked with nothing, has a null component and is kept.  Rows
that share a doc_id are one document; ``keep_one`` leaves one row of it.  An
empty table gives an empty result.  Other columns are ignored by ``judge``
and unchanged in ``keep_one``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rolling as R
from .common import documents, in_stretches, stored, task, text_bytes
from .components import components
from .packing import packed, unpacked

BANDS, ROWS = 32, 4
SHINGLE, SIMILARITY = 5, 80
#: Members of a bucket whose open pairs are listed; larger buckets are compared in blocks of two chunks.
FEW, CHUNK = 32, 2048
#: Bits that stand for ids when the rows are told that need no join (262,144 broadcast rows of two longs at most).
MARKS = 1 << 24
#: Bytes of packed texts whose sets a task holds at once (about twelve times as much memory).
PACKED_BYTES = 4 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FULL = np.uint64((1 << 64) - 1)


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a batch, ordered by document and value, and
    n + 1 offsets."""
    n = len(off) - 1
    data = _LOWER[data]
    starts, ends = R.words_of_texts(data, off)
    hashes = R.word_hashes(data, starts, ends)
    doc = np.searchsorted(off, starts, side="right") - 1
    sums = R.prefix(hashes, R.WORD_BASE)
    whole = R.fixed(sums, size, R.WORD_BASE)
    inside = doc[: len(whole)] == doc[size - 1: size - 1 + len(whole)]
    first = np.searchsorted(doc, np.arange(n + 1))
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < size))
    short = R.stretches(sums, first[few], first[few + 1], R.WORD_BASE)
    value = np.concatenate([whole[inside], short])
    owner = np.concatenate([doc[: len(whole)][inside], few])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    if len(value):
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])])
        value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(n + 1))


def sketches(value: np.ndarray, off: np.ndarray, bins: int) -> np.ndarray:
    """One row of ``bins`` coordinates per document; empty sets give zeros."""
    n = len(off) - 1
    out = np.full(n * bins, _FULL, dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(off))
    for i in range(2 * bins):
        if not len(value):
            break
        with np.errstate(over="ignore"):
            salt = R.mix(np.array([i + 1], dtype=np.uint64) * R.BYTE_BASE)[0]
            thrown = R.mix(value ^ salt)
        slot = owner * bins + ((thrown % np.uint64(bins)).astype(np.int64) if i < bins else i - bins)
        empty = out[slot] == _FULL
        slot, thrown = slot[empty], thrown[empty]
        least = np.full(n * bins, _FULL, dtype=np.uint64) if len(slot) * 8 > len(out) else None
        if least is not None:
            np.minimum.at(least, slot, thrown)
            hit = least != _FULL
            out[hit] = R.mix(least[hit] + salt) & np.uint64(_FULL - np.uint64(1))
        elif len(slot):
            order = np.lexsort((thrown, slot))
            slot, thrown = slot[order], thrown[order]
            first = np.concatenate([[True], slot[1:] != slot[:-1]])
            out[slot[first]] = R.mix(thrown[first] + salt) & np.uint64(_FULL - np.uint64(1))
        open_docs = (out.reshape(n, bins) == _FULL).any(axis=1)
        keep = open_docs[owner]
        value, owner = value[keep], owner[keep]
    out = out.reshape(n, bins)
    out[np.diff(off) == 0] = 0
    return out


def band_keys(coordinates: np.ndarray, bands: int) -> np.ndarray:
    """bands hashes per document, different for each band."""
    n, bins = coordinates.shape
    parts = coordinates.reshape(n, bands, bins // bands)
    key = np.broadcast_to(R.mix(np.arange(1, bands + 1, dtype=np.uint64)), (n, bands)).copy()
    for i in range(bins // bands):
        key = R.mix(key * R.WORD_BASE + parts[:, :, i])
    return key


def sketch_table(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, k1, k2 (128-bit hash of the set), bands."""

    @task("op10")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_stretches(batches):
            value, off = shingle_sets(*text_bytes(batch.column(1)), size)
            total = lambda x: np.diff(np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)])[off])
            keys = band_keys(sketches(value, off, bands * rows), bands)
            flat = pa.array(keys.ravel().view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(off), dtype=np.int32) * bands), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(np.diff(off).astype(np.int64)),
                 pa.array(total(R.mix(value)).view(np.int64)), pa.array(total(R.mix(value ^ R.WORD_BASE)).view(np.int64)),
                 lists], names=["doc_id", "n_shingles", "k1", "k2", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>")


def text_table(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, packed) of the documents in ``ids``: a packed text is less than
    half as large as its set of hashes, which is made where it is compared."""
    texts = packed(docs.select(F.col("doc_id").cast("long").alias("id"), "text"))
    return texts.join(ids, "id", "left_semi")


def sets_of(column: pa.Array, size: int) -> list[np.ndarray]:
    """The shingle set of each packed text: sorted hashes."""
    out = []
    for batch in in_stretches(unpacked([pa.RecordBatch.from_arrays([column], names=["packed"])]), "text"):
        value, off = shingle_sets(*text_bytes(batch.column("text")), size)
        out += np.split(value, off[1:-1])
    return out


def sets_by_id(ids: pa.Array, column: pa.Array, size: int) -> list[np.ndarray]:
    """``sets_of`` rows whose texts repeat with their ids, each made once."""
    _, first, at = np.unique(np.asarray(ids), return_index=True, return_inverse=True)
    sets = sets_of(column.take(pa.array(first)), size)
    return [sets[i] for i in at]


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, similarity: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= similarity * union."""

    @task("op10")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            size_of = np.cumsum(sum(np.asarray(pc.fill_null(pc.binary_length(whole.column(i)), 0)).astype(np.int64) for i in (2, 3)))
            edges = np.flatnonzero(np.diff(size_of // PACKED_BYTES, prepend=-1))  # a longer pair is a part of its own
            for at, end in zip(edges.tolist(), [*edges[1:].tolist(), whole.num_rows]):
                batch, keep = whole.slice(at, end - at), []
                for x, y in zip(*(sets_by_id(batch.column(i), batch.column(i + 2), size) for i in (0, 1))):
                    if len(y) < len(x):
                        x, y = y, x
                    common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                    keep.append(100 * common >= similarity * (len(x) + len(y) - common))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                    pa.array(keep, pa.bool_()))

    left = texts.select(F.col("id").alias("a"), F.col("packed").alias("x"))
    right = texts.select(F.col("id").alias("b"), F.col("packed").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def possible(x: str, y: str, similarity: int):
    return (F.least(x, y) * 100 >= F.greatest(x, y) * similarity)


def class_links(docs: DataFrame, reps: DataFrame, size: int, similarity: int) -> DataFrame:
    """(id, component) of the classes; ``reps`` (id, n, bands)."""
    order = F.xxhash64("id")
    rows = reps.select("id", "n", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"),
                                     F.min(F.struct(order.alias("o"), "id", "n")).alias("hub")).filter("size > 1")
    members = stored(rows.join(shared, "key").select(
        "key", "id", "n", "size", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n")), "op10-members")
    star = members.filter((F.col("id") != F.col("hub")) & possible("n", "hub_n", similarity)).select(
        F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    pairs = stored(star, "op10-pairs")
    texts = stored(text_table(docs, members.select("id").distinct()), "op10-texts")
    found = stored(confirmed(pairs, texts, size, similarity), "op10-found")
    joined = components(found)
    live = members.filter("size > 2").join(joined, "id", "left").withColumn("c", F.coalesce("component", "id"))
    mixed = live.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("key")
    live = stored(live.join(mixed, "key").select("key", "id", "n", "c", "size", "hub"), "op10-live")
    few = live.filter(F.col("size") <= FEW)
    other = few.select("key", F.col("id").alias("h"), F.col("n").alias("h_n"), F.col("c").alias("h_c"))
    rest = few.join(other, "key").filter((F.col("h") < F.col("id")) & (F.col("c") != F.col("h_c")) & possible(
        "n", "h_n", similarity)).select(F.col("h").alias("a"), F.col("id").alias("b")).distinct()
    rest = stored(rest.join(pairs, ["a", "b"], "left_anti"), "op10-rest")
    links = joined.select(F.col("component").alias("a"), F.col("id").alias("b"))
    links = links.unionByName(stored(confirmed(rest, texts, size, similarity), "op10-found"))
    many = live.filter(F.col("size") > FEW)
    if not many.isEmpty():
        links = links.unionByName(stored(links_in_blocks(many, texts, size, similarity), "op10-blocks"))
    return components(links)


def links_in_blocks(many: DataFrame, texts: DataFrame, size: int, similarity: int) -> DataFrame:
    """Links between unconnected members of large buckets.  Buckets that
    share members are put together, by the smallest hub of the buckets that a
    member is in, so that a text travels once for most of them; the members of
    such a cluster are dealt to chunks of about ``CHUNK``, and every two chunks
    meet in a block.  A block compares in memory and emits links only."""
    low = many.groupBy("id").agg(F.min("hub").alias("low"))
    cluster = many.join(low, "id").groupBy("key").agg(F.min("low").alias("cluster"))  # a bucket is never cut
    rows = stored(many.join(cluster, "key").select("id", "c", "cluster").distinct(), "op10-clusters")
    sizes = rows.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).cast("int").alias("chunks"))
    rows = rows.join(sizes, "cluster").join(texts, "id").withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    rows = rows.select("id", "c", "packed", "cluster", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    block = F.xxhash64("cluster", F.least("own", "other"), F.greatest("own", "other"))
    rows = rows.select(block.alias("block"), "id", "c", (F.col("own") <= F.col("other")).alias("first"),
                       (F.col("own") == F.col("other")).alias("alone"), "packed")

    @task("op10")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for batch in batches:
            numbers = np.asarray(batch.column(0))
            edges = np.concatenate([[0], np.flatnonzero(numbers[1:] != numbers[:-1]) + 1, [len(numbers)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if a == b:
                    continue
                if numbers[a] != block and held:
                    yield compared(pa.Table.from_batches(held), size, similarity)
                    held = []
                block = numbers[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield compared(pa.Table.from_batches(held), size, similarity)

    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, "a long, b long")


def compared(rows: pa.Table, width: int, similarity: int) -> pa.RecordBatch:
    """Links between the unconnected documents of a block: of the two chunks
    with each other, or of the only chunk within itself.  Every document that
    is not of the commonest component is counted against all others by way
    of the documents that have its shingles."""
    ids, c = np.asarray(rows["id"].combine_chunks()), np.asarray(rows["c"].combine_chunks())
    first, alone = (np.asarray(rows[n].combine_chunks().cast(pa.int8())) > 0 for n in ("first", "alone"))
    sets = [x for chunk in rows["packed"].chunks for x in sets_of(chunk, width)]
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
    by = np.argsort(shingle, kind="stable")
    at = np.concatenate([[0], np.cumsum(np.bincount(shingle))])
    owners, begin = owner[by], np.concatenate([[0], np.cumsum(size)])
    values, many = np.unique(c, return_counts=True)
    asked = np.flatnonzero(c != values[many.argmax()])
    rest = c == values[many.argmax()]
    a, b = [], []
    for x in asked:
        own = shingle[begin[x]: begin[x + 1]]
        lists = [owners[at[s]: at[s + 1]] for s in own]
        common = np.bincount(np.concatenate(lists), minlength=len(sets))
        near = 100 * common >= similarity * (size[x] + size - common)
        near &= (c != c[x]) & (rest | (np.arange(len(sets)) > x)) & (alone | (first != first[x]))
        for y in np.flatnonzero(near):
            a.append(min(ids[x], ids[y]))
            b.append(max(ids[x], ids[y]))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def judge(docs: DataFrame, size: int = SHINGLE, similarity: int = SIMILARITY, bands: int = BANDS,
          rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    table = stored(sketch_table(docs, size, bands, rows), "op10-sketches")
    usable = table.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(usable.groupBy("k1", "k2", "n_shingles").agg(
        F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "op10-classes")
    reps = classes.select("id", F.col("n_shingles").alias("n"), "bands")
    joined = class_links(docs, reps, size, similarity)
    known = classes.select("k1", "k2", "n_shingles", "id").join(joined, "id", "left").select(
        "k1", "k2", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    out = usable.join(known, ["k1", "k2", "n_shingles"]).select("doc_id", "n_shingles", "component_id")
    alone = table.filter("doc_id IS NULL OR n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def apart(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` that surely have none of the ids in ``ids`` (id),
    and the others.  Ids are hashed to ``MARKS`` bits; the words with a bit set
    are broadcast, so only rows that have the bit of an id go on to a join."""
    word = lambda c: F.expr(f"pmod(xxhash64({c}), {MARKS}) div 64")
    bit = lambda c: F.expr(f"shiftleft(1L, cast(pmod(xxhash64({c}), 64) as int))")
    marks = F.broadcast(ids.groupBy(word("id").alias("__word")).agg(F.bit_or(bit("id")).alias("__bits")))
    key = "cast(doc_id as long)"  # a null one has a hash, but no row to join
    hit = F.col("doc_id").isNotNull() & (word(key) == F.col("__word")) & (F.col("__bits").bitwiseAND(bit(key)) != 0)
    return docs.join(marks, hit, "left_anti"), docs.join(marks, hit, "left_semi")


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` whose document stays, with all their columns."""
    verdict = stored(judge(docs, **settings), "op10-verdict")
    ids = verdict.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(
        F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    odd = stored(ids.filter("NOT stays OR n > 1"), "op10-odd")  # all other rows stay as they are, without a join
    sure, others = apart(docs, odd)
    gone = odd.filter("NOT stays").select(F.col("id").alias("__id"))
    others = others.join(gone, F.col("doc_id").cast("long") == F.col("__id"), "left_anti")
    if not odd.filter("n > 1").isEmpty():
        others = others.dropDuplicates(["doc_id"])
    return sure.unionByName(others)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir).select("doc_id", "text"), size=2)
