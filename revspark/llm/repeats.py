"""Finding stretches of fixed length that occur more than once, for
sequences of any symbol (words, bytes), without a corpus-wide table.

Every window of ``length`` symbols owns a seed: the smallest hashed k-gram
inside it (the leftmost of equal ones).  Equal windows own equal seeds at
equal places, so a window can only repeat if its seed does, and all
windows that own the same seed can be judged in one place.

1. ``repeated_seeds``: tasks deal the distinct seeds of their documents to
   blocks by hash.  A seed that two documents of a task have is known to
   repeat; it is sent once for the task, so a seed of very many documents
   gives one entry per task and not one per document.  Blocks return, for
   each document, its seeds that repeat.
2. The texts meet these lists.  Only windows that own a repeated seed go on.
   What can be judged among the documents at hand is judged at once; first
   occurrences are dealt to blocks by seed.
3. Blocks judge what they got; judged stretches meet the texts again.

A block is one of ``n_blocks`` shares of the seeds, a shelf one of as many
shares of the documents; both are sized so that a task holds one in memory.
Rows between them carry packed arrays for a whole block or shelf.
"""
from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling as R
from .common import STRETCH_BYTES, doc_key, in_stretches, text_bytes
from .packing import packed, unpacked

#: Text bytes per block, seeds a task gathers before it deals them out.
BLOCK_BYTES, HELD = 6 << 20, 1 << 19
#: Ids of several texts up to which they are broadcast.
FEW = 100_000
ROUTED = "block int, kind int, body binary"
LISTED = "shelf int, body binary"
HERE, THERE = 0, 1  # routed rows: results for the shelf ``block``, passing through; to be judged in the block


def pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    raw = b"".join(struct.pack("<4sq", a.dtype.str.encode().ljust(4), len(a)) + a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(body: bytes) -> list[np.ndarray]:
    import zstandard

    raw, at, out = zstandard.ZstdDecompressor().decompress(body), 0, []
    while at < len(raw):
        kind, n = struct.unpack_from("<4sq", raw, at)
        dtype = np.dtype(kind.decode().strip())
        out.append(np.frombuffer(raw, dtype, n, at + 12))
        at += 12 + n * dtype.itemsize
    return out


def seed_runs(grams: np.ndarray, first: np.ndarray, k: int, length: int):
    """Runs of windows of one text that own the same seed: text, start (in
    the text), windows, and place of the seed.  ``grams``: hashed k-grams by
    start; ``first``: n + 1 offsets of the texts.  Of two k-grams the one with
    the smaller upper 40 bits is smaller, of equal ones the left one."""
    width, n = length - k + 1, int(first[-1]) - length + 1
    none = (np.empty(0, np.int64),) * 4
    if n <= 0:
        return none
    if len(grams) < 1 << 24:  # hash and place in one number
        key = (grams & ~np.uint64((1 << 24) - 1)) | np.arange(len(grams), dtype=np.uint64)
        place = (R.sliding_min(key, width)[:n] & np.uint64((1 << 24) - 1)).astype(np.int64)
    else:
        value, place, have = grams >> np.uint64(24), np.arange(len(grams)), 1
        while have < width:
            step = min(have, width - have)
            less = value[step:] < value[:-step]
            value, place = np.where(less, value[step:], value[:-step]), np.where(less, place[step:], place[:-step])
            have += step
        place = place[:n]
    windows = np.maximum(np.diff(first) - length + 1, 0)
    some = np.flatnonzero(windows)
    edge = np.zeros(n + 1, dtype=bool)
    edge[1:-1] = place[1:] != place[:-1]
    edge[first[some]] = edge[first[some] + windows[some]] = True
    at = np.flatnonzero(edge)
    at, end = at[:-1], at[1:]
    text = np.searchsorted(first, at, side="right") - 1
    inside = at - first[text] < windows[text]  # the others reach over the end of their text
    at, text = at[inside], text[inside]
    return text, at - first[text], end[inside] - at, place[at]


def short(seed: np.ndarray) -> np.ndarray:
    """The upper 48 bits of seeds, as six bytes each."""
    return np.ascontiguousarray(seed.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6]).ravel()


def lengthened(six: np.ndarray) -> np.ndarray:
    out = np.zeros((len(six) // 6, 8), dtype=np.uint8)
    out[:, :6] = six.reshape(-1, 6)
    return out.view(">u8").ravel().astype(np.uint64)


def block_of(seed: np.ndarray, n_blocks: int) -> np.ndarray:
    return ((seed >> np.uint64(16)) % np.uint64(n_blocks)).astype(np.int64)


def keyed(docs: DataFrame, few: int = FEW) -> DataFrame:
    """(doc_id, did, tid, text): did orders documents (null last), tid tells
    apart texts that share a doc_id and is 0 where none does, so that it
    takes no room in the packed rows.  Repeated ids are counted over ids alone;
    up to ``few`` of them are broadcast, with more every text has its tid."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", doc_key().alias("did"), text.alias("text"))
    again = docs.select(doc_key().alias("again")).groupBy("again").count().filter("count > 1").select("again")
    n = again.limit(few + 1).count()
    told, none = F.xxhash64("text"), F.lit(0).cast("long")
    if not n:
        told = none
    elif n <= few:
        rows = rows.join(F.broadcast(again), F.col("did") == F.col("again"), "left")
        told = F.when(F.col("again").isNotNull(), told).otherwise(none)
    return rows.select("doc_id", "did", told.alias("tid"), "text")


def block_count(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """A prime, so that ids in any regular steps spread over all shelves."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // block_bytes))
    while any(n % k == 0 for k in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def groups_of(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Offsets of the runs of equal values, taken in ``order``."""
    if not len(order):
        return np.zeros(1, dtype=np.int64)
    ordered = values[order]
    return np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]]).astype(np.int64)


def routed_batch(rows: list[tuple]) -> pa.RecordBatch:
    block, kind, body = zip(*rows) if rows else ((),) * 3
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(kind, pa.int32()), pa.array(body, pa.binary())],
                                      names=["block", "kind", "body"])


def listed_batch(rows: list[tuple]) -> pa.RecordBatch:
    shelf, body = zip(*rows) if rows else ((),) * 2
    return pa.RecordBatch.from_arrays([pa.array(shelf, pa.int32()), pa.array(body, pa.binary())], names=["shelf", "body"])


def joined_spans(doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, size) of the unions of spans that touch or overlap."""
    if not len(doc):
        return doc, start, size
    order = np.lexsort((start, doc))
    doc, start, size = doc[order].astype(np.int64), start[order].astype(np.int64), size[order].astype(np.int64)
    far = doc << 40
    reach = np.maximum.accumulate(far + start + size)
    at = np.flatnonzero(np.concatenate([[True], far[1:] + start[1:] > reach[:-1]]))
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], reach[last] - far[at] - start[at]


def by_shelf(n_blocks: int, doc: np.ndarray, did: np.ndarray, tid: np.ndarray, *columns: np.ndarray,
             pick: Callable = np.asarray) -> Iterator[tuple]:
    """(shelf, packed columns with their documents); ``doc`` indexes did and
    tid; ``pick`` turns each part of a column into what is packed."""
    shelf = ((did ^ tid) % n_blocks)[doc]
    order = np.lexsort((doc, shelf))
    edges = groups_of(shelf, order)
    for a, b in zip(edges[:-1], edges[1:]):
        at = order[a:b]
        owners, owner = np.unique(doc[at], return_inverse=True)
        yield int(shelf[at[0]]), pack(did[owners], tid[owners], owner.astype(np.int32), *[pick(c[at]) for c in columns])


def in_blocks(routed: DataFrame, n_blocks: int, judge: Callable[[list[bytes]], Iterator[tuple]]) -> DataFrame:
    """Deal rows to their blocks; ``judge`` gets the bodies of a whole block
    and yields (shelf, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, bodies = None, []
        for batch in batches:
            numbers, kinds = batch.column(0).to_pylist(), np.asarray(batch.column(1))
            passing = pa.array(kinds == HERE)
            if passing.true_count:
                done = batch.filter(passing)
                yield pa.RecordBatch.from_arrays([done.column(0), done.column(2)], names=["shelf", "body"])
            for i in np.flatnonzero(kinds == THERE):
                if numbers[i] != block and bodies:
                    yield listed_batch(list(judge(bodies)))
                    bodies = []
                block = numbers[i]
                bodies.append(batch.column(2)[int(i)].as_py())
        if bodies:
            yield listed_batch(list(judge(bodies)))

    return routed.repartition(n_blocks, "block").sortWithinPartitions("block").mapInArrow(run, LISTED)


def pieces(batches: Iterator[pa.RecordBatch], stretch: int, cuts: Callable) -> Iterator[tuple]:
    """(bytes, offsets, first row, number of rows, base) of the texts in
    ``batches``, about ``stretch`` bytes at a time.  A text of more than twice
    as many comes in pieces of its own, which overlap by all but one symbol of
    a window, so every window lies in exactly one; ``base`` is where a piece
    begins in its text, in symbols, and ``cuts(data, stretch)`` gives (begin,
    end, base) of them in bytes."""
    n = 0
    for batch in in_stretches(batches, "text", stretch):
        data, off = text_bytes(batch.column("text"))
        if batch.num_rows == 1 and len(data) > 2 * stretch:
            for begin, end, base in cuts(data, stretch):
                yield data[begin:end], np.array([0, end - begin]), n, 1, base
        else:
            yield data, off, n, batch.num_rows, 0
        n += batch.num_rows


def repeated_seeds(texts: DataFrame, seeds_of: Callable, n_blocks: int, within: bool, cuts: Callable,
                   stretch: int = STRETCH_BYTES) -> DataFrame:
    """(shelf, body): the repeated seeds of the documents, in parts.
    ``seeds_of(data, off)`` gives (document, seed) of all runs; ``within``:
    repeats inside one document count.  Only 48 bits of a seed travel here:
    one that is taken for another only lets more windows go on."""
    cut = ~np.uint64((1 << 16) - 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (document, seed) arrays, ids of the documents
        n_docs = n_seeds = 0
        dids, tids = [], []
        for batch in batches:
            dids.append(np.asarray(batch.column(0)))
            tids.append(np.asarray(batch.column(1)))
            for data, off, first, _, _ in pieces(iter([batch]), stretch, cuts):
                doc, seed = seeds_of(data, off)
                held.append((doc + first + n_docs, seed & cut))
                n_seeds += len(doc)
                if n_seeds >= 4 * HELD:  # parts of one long text: a seed in two of them only counts as repeated
                    yield flush(held, dids, tids)
                    held, n_seeds = [], 0
            n_docs += batch.num_rows
            if n_seeds >= HELD:
                yield flush(held, dids, tids)
                held, dids, tids, n_docs, n_seeds = [], [], [], 0, 0
        if n_seeds:
            yield flush(held, dids, tids)

    def flush(held: list, dids: list, tids: list) -> pa.RecordBatch:
        doc, seed = (np.concatenate(x) for x in zip(*held))
        did, tid = np.concatenate(dids), np.concatenate(tids)
        order = np.lexsort((doc, seed))
        doc, seed = doc[order], seed[order]
        new_seed = np.concatenate([[True], seed[1:] != seed[:-1]])
        new = new_seed | np.concatenate([[True], doc[1:] != doc[:-1]])
        run = np.cumsum(new_seed) - 1
        many = (np.bincount(run) if within else np.bincount(run[new])) > 1
        known = many[run] & new
        rows = [(shelf, HERE, body) for shelf, body in by_shelf(n_blocks, doc[known], did, tid, seed[known], pick=short)]
        doc, seed = doc[new_seed], seed[new_seed]
        block = block_of(seed, n_blocks)
        order = np.lexsort((doc, block))
        edges = groups_of(block, order)
        for a, b in zip(edges[:-1], edges[1:]):
            at = order[a:b]
            owners, owner = np.unique(doc[at], return_inverse=True)
            rows.append((int(block[at[0]]), THERE, pack(short(seed[at]), owner.astype(np.int32), did[owners], tid[owners])))
        return routed_batch(rows)

    def judge(bodies: list[bytes]) -> Iterator[tuple]:
        seeds, owners, dids, tids, n = [], [], [], [], 0
        for body in bodies:
            seed, owner, did, tid = unpack(body)
            seeds.append(lengthened(seed))
            owners.append(owner.astype(np.int64) + n)
            dids.append(did)
            tids.append(tid)
            n += len(did)
        seed, owner = np.concatenate(seeds), np.concatenate(owners)
        order = np.argsort(seed)
        edges = groups_of(seed, order)
        again = order[np.repeat(np.diff(edges) > 1, np.diff(edges))]
        yield from by_shelf(n_blocks, owner[again], np.concatenate(dids), np.concatenate(tids), seed[again], pick=short)

    routed = texts.select("did", "tid", "text").mapInArrow(deal, ROUTED)
    return in_blocks(routed, n_blocks, judge)


def code_of(did: np.ndarray, tid: np.ndarray) -> np.ndarray:
    """One number per document, for look-ups within a shelf."""
    return R.mix(did.view(np.uint64) * R.BYTE_BASE ^ tid.view(np.uint64))


def entries(bodies: list[bytes]) -> list[np.ndarray]:
    """The packed rows of a shelf: code of the document, and the columns."""
    parts = []
    for body in bodies:
        did, tid, owner, *columns = unpack(body)
        parts.append([code_of(did, tid)[owner], *columns])
    return [np.concatenate(x) for x in zip(*parts)]


def has_seed(code: np.ndarray, seed: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which (document, seed) are in the table of the shelf."""
    if not len(known) or not len(seed):
        return np.zeros(len(seed), dtype=bool)
    wanted = R.mix((seed >> np.uint64(16)) ^ code)
    return known[np.minimum(np.searchsorted(known, wanted), len(known) - 1)] == wanted


def seed_table(bodies: list[bytes]) -> np.ndarray:
    """The repeated seeds of a shelf's documents, for ``has_seed``."""
    if not bodies:
        return np.empty(0, dtype=np.uint64)
    code, six = entries(bodies)
    return np.sort(R.mix((lengthened(six) >> np.uint64(16)) ^ code))


def shelved(keys: DataFrame, n_blocks: int) -> DataFrame:
    """(doc_id, did, tid, packed, shelf) of every document."""
    shelf = F.pmod(F.col("did").bitwiseXOR(F.col("tid")), F.lit(n_blocks)).cast("int")
    return packed(keys.select("doc_id", "did", "tid", "text", shelf.alias("shelf")))


def with_lists(texts: DataFrame, lists: DataFrame, run: Callable[[pa.Table, list[bytes]], pa.Table], schema: str) -> DataFrame:
    """``run`` for each shelf: its texts, and the bodies that belong to it."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return run(left, right["body"].to_pylist())

    return texts.groupBy("shelf").cogroup(lists.groupBy("shelf")).applyInArrow(meet, schema)


def text_pieces(rows: pa.Table, stretch: int, cuts: Callable) -> Iterator[tuple]:
    """``pieces`` of the texts of a shelf, unpacked."""
    return pieces(unpacked(rows.to_batches()), stretch, cuts)
