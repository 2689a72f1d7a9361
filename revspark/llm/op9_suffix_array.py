"""Suffix-array dedup with two-stage sorting, on bytes.

Documents whose windows may repeat (see ``repeats``) send the stretches
around the repeated seeds to blocks.  A block concatenates its distinct
stretches and builds the suffix array of that text in two stages:

* directly sorted are only the suffixes smaller than their successor
  (type B), 8 bytes a round and only while there are ties, to the depth of
  ``length`` bytes, which is all that is compared later;
* the others (type A) are induced: buckets by first byte are scanned in
  order, and the predecessor of each suffix, if of type A, is appended to
  its own bucket.

Adjacent common prefixes of ``length`` bytes or more then join the suffixes
into groups of equal strings, and a string is a duplicate in every document
but the smallest of its group.

Stretches that are equal, seed and bytes, within a task are sent once with
the smallest document; for the larger ones every string of the stretch
starts in a smaller document, so a stretch of very many documents gives one
entry per task.

Defined results: a byte is removed if a string of ``length`` bytes over it
also starts in a document with a smaller doc_id.  Repeats inside one
document stay.  A null text is empty; texts under ``length`` bytes keep all.
A null doc_id comes after all others, and rows with a null doc_id are not
smaller than each other.  The same holds for rows that share a doc_id, so
repeated rows get the same result.  An empty table gives an empty result;
other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import rolling as R
from .common import documents, stored
from .packing import unpacked
from .repeats import (HERE, ROUTED, THERE, block_count, block_of, by_shelf, code_of, entries, groups_of, has_seed, in_blocks,
                      keyed, pack, repeated_seeds, routed_batch, seed_runs, seed_table, shelved, text_pieces, unpack,
                      with_lists)

LENGTH, GRAM = 50, 20
#: Suffixes sorted at once, and text bytes that are numpy arrays at once: arrays that fit the caches.
SORTED, STRETCH = 1 << 20, 1 << 19
#: Text bytes per block: each block repeats the ids of its documents, so fewer blocks move less.
BLOCK = 16 << 20


def types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successor (type B).  The empty
    suffix is the smallest, so the last one is of type A."""
    n = len(text)
    order = np.concatenate([np.sign(np.diff(text.astype(np.int16))), [-1]])
    place = np.where(order != 0, np.arange(n), n)
    return order[np.minimum.accumulate(place[::-1])[::-1]] > 0


def sorted_directly(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ``at`` ordered by their first ``depth`` bytes."""
    padded = np.concatenate([text, np.zeros(depth + 8, dtype=np.uint8)])

    def eight(where: np.ndarray) -> np.ndarray:
        key = np.zeros(len(where), dtype=np.uint64)
        for i in range(8):
            key = (key << np.uint64(8)) | padded[where + i]
        return key

    key = eight(at)
    order = np.argsort(key)
    at, key = at[order], key[order]
    tied = np.arange(len(at))
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(at) else np.empty(0, np.int64)
    for done in range(8, depth, 8):
        size = np.bincount(group) if len(group) else np.empty(0, np.int64)
        keep = size[group] > 1
        tied, group = tied[keep], group[keep]
        if not len(tied):
            break
        where = at[tied]
        key = eight(np.minimum(where + done, len(text)))
        order = np.argsort(key)
        order = order[np.argsort(group[order], kind="stable")]
        at[tied] = where[order]
        group, key = group[order], key[order]
        group = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (group[1:] != group[:-1])]))
    return at


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of ``text`` ordered by their first ``depth`` bytes."""
    n = len(text)
    if not n:
        return np.empty(0, dtype=np.int64)
    smaller = types(text)
    direct = sorted_directly(text, np.flatnonzero(smaller), depth)
    edges = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[n - 1]].append(np.array([n - 1]))  # after the empty suffix
    out = []
    for c in range(256):
        front = np.concatenate(induced[c]) if induced[c] else np.empty(0, np.int64)
        bucket = []
        while len(front):
            bucket.append(front)
            front = front[front > 0] - 1
            front = front[(text[front] == c) & ~smaller[front]]
        bucket.append(direct[edges[c]: edges[c + 1]])
        whole = np.concatenate(bucket)
        out.append(whole)
        before = whole[whole > 0] - 1
        before = before[text[before] > c]  # larger than their successor: type A
        first = text[before]
        for d in np.unique(first):
            induced[d].append(before[first == d])
    return np.concatenate(out)


def long_prefixes(text: np.ndarray, suffixes: np.ndarray, length: int) -> np.ndarray:
    """For each suffix but the first: does it share ``length`` bytes with the
    one before it?  All suffixes have that many."""
    a, b = suffixes[:-1], suffixes[1:]
    same = np.ones(len(b), dtype=bool)
    for i in range(length):
        on = np.flatnonzero(same)
        if not len(on):
            break
        same[on] = text[a[on] + i] == text[b[on] + i]
    return same


def byte_runs(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Runs of windows with one seed: document, start (byte of the document),
    windows, place of the seed in the document, seed."""
    sums = R.prefix(data.astype(np.uint64) + np.uint64(1), R.BYTE_BASE)
    grams = R.fixed(sums, gram, R.BYTE_BASE)
    doc, start, size, place = seed_runs(grams, off, gram, length)
    return doc, start, size, place - off[doc], grams[place]


def seeds_and_codes(data: np.ndarray, span: np.ndarray, place: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Of stretches of ``span`` bytes, one after the other, whose seeds are at
    ``place``: the seeds, and a hash of all bytes."""
    sums = R.prefix(data.astype(np.uint64) + np.uint64(1), R.BYTE_BASE)
    end = np.cumsum(span)
    at = end - span + place
    return R.stretches(sums, at, at + gram, R.BYTE_BASE), R.stretches(sums, end - span, end, R.BYTE_BASE)


def gather(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all stretches, one after the other."""
    end = np.cumsum(size)
    return data[np.arange(end[-1] if len(end) else 0) + np.repeat(begin - (end - size), size)]


def judged(seed, code, size, owner, did, data, length):
    """Of each stretch of a block (owner: its document): flags of its
    windows, those that start in a smaller document as well, one after the
    other.  Equal stretches share one place in the sorted text."""
    order = np.lexsort((code, seed))
    new = np.concatenate([[True], (seed[order][1:] != seed[order][:-1]) | (code[order][1:] != code[order][:-1])])
    shared = np.empty(len(seed), dtype=np.int64)
    shared[order] = np.cumsum(new) - 1
    kept = order[new]
    least = np.minimum.reduceat(did[owner][order], np.flatnonzero(new))
    span = size + length - 1
    begin = np.cumsum(span) - span
    text = gather(data, begin[kept], span[kept])
    at = np.cumsum(span[kept]) - span[kept]
    of = np.full(len(text), -1, dtype=np.int64)
    windows = np.repeat(at, size[kept]) + within(size[kept])
    of[windows] = np.repeat(np.arange(len(kept)), size[kept])
    array = suffix_array(text, length)
    array = array[of[array] >= 0]
    head = np.flatnonzero(np.concatenate([[True], ~long_prefixes(text, array, length)]))
    first = np.repeat(np.minimum.reduceat(least[of[array]], head), np.diff(np.append(head, len(array))))
    smallest = np.empty(len(text), dtype=np.int64)
    smallest[array] = first
    place = np.repeat(at[shared], size) + within(size)
    return smallest[place] < np.repeat(did[owner], size)


def within(size: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size in turn."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def runs(doc: np.ndarray, start: np.ndarray, length: int):
    """Windows, ordered by document and start, as (document, start, bytes)."""
    if not len(doc):
        return (np.empty(0, np.int64),) * 3
    at = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], start[last] - start[at] + length


def spans(docs: DataFrame, length: int, gram: int, stretch: int) -> tuple[DataFrame, DataFrame]:
    """The shelved texts, and the parts of their duplicate spans."""
    keys = keyed(docs)
    n_blocks = block_count(keys, BLOCK)
    small = np.uint8 if length < 256 else np.int32  # of places and runs inside a window
    texts = shelved(keys, n_blocks)

    def seeds_of(data, off):
        doc, _, _, _, seed = byte_runs(data, off, length, gram)
        return doc, seed

    def deal_out(rows: pa.Table, bodies: list[bytes]) -> pa.Table:
        if not bodies or not rows.num_rows:
            return pa.Table.from_batches([routed_batch([])])
        did, tid = (np.asarray(rows[c].combine_chunks()) for c in ("did", "tid"))
        codes, known, held = code_of(did, tid), seed_table(bodies), []
        for data, off, n, _, base in text_pieces(rows, stretch, byte_cuts):
            doc, start, size, place, seed = byte_runs(data, off, length, gram)
            on = has_seed(codes[doc + n], seed, known)
            doc, start, size, place = doc[on], start[on], size[on], place[on]
            piece = gather(data, off[doc] + start, size + length - 1)
            held.append((doc + n, start + base, size, place - start, piece, *seeds_and_codes(piece, size + length - 1, place - start, gram)))
        if not held:
            return pa.Table.from_batches([routed_batch([])])
        doc, start, size, place, data, seed, code = (np.concatenate(x) for x in zip(*held))
        del held
        order = np.lexsort((did[doc], code, seed))
        same = np.concatenate([[False], (seed[order][1:] == seed[order][:-1]) & (code[order][1:] == code[order][:-1])])[:len(order)]
        head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        known = np.zeros(len(order), dtype=bool)
        known[order] = did[doc[order]] > did[doc[head]]
        out = [(shelf, HERE, body) for shelf, body in by_shelf(
            n_blocks, doc[known], did, tid, start[known].astype(np.int32), (size[known] + length - 1).astype(np.int32))]
        span = size + length - 1
        begin = np.cumsum(span) - span
        block = block_of(seed, n_blocks)
        left = np.flatnonzero(~known)
        order = left[np.argsort(block[left], kind="stable")]
        edges = groups_of(block, order)
        for a, b in zip(edges[:-1], edges[1:]):
            at = order[a:b]
            owners, owner = np.unique(doc[at], return_inverse=True)
            out.append((int(block[at[0]]), THERE, pack(
                place[at].astype(small), owner.astype(np.int32), start[at].astype(np.int32), size[at].astype(small),
                gather(data, begin[at], span[at]), did[owners], tid[owners])))
        return pa.Table.from_batches([routed_batch(out)])

    def judge(bodies: list[bytes]) -> Iterator[tuple]:
        parts, dids, tids, n = [], [], [], 0
        while bodies:
            place, owner, start, size, data, did, tid = unpack(bodies.pop())
            place, size = place.astype(np.int64), size.astype(np.int64)
            parts.append((owner.astype(np.int64) + n, start.astype(np.int64), size, data,
                          *seeds_and_codes(data, size + length - 1, place, gram)))
            dids.append(did)
            tids.append(tid)
            n += len(did)
        owner, start, size, data, seed, code = (np.concatenate(x) for x in zip(*parts))
        did, tid = np.concatenate(dids), np.concatenate(tids)
        span = size + length - 1
        begin = np.cumsum(span) - span
        # seeds are independent of each other: shares of them keep the sorted text small
        share = (seed >> np.uint64(32)) % np.uint64(-(-len(data) // SORTED))
        order = np.argsort(share, kind="stable")
        edges = groups_of(share, order)
        for a, b in zip(edges[:-1], edges[1:]):
            at = order[a:b]
            flags = judged(seed[at], code[at], size[at], owner[at], did, gather(data, begin[at], span[at]), length)
            doc, where = np.repeat(owner[at], size[at])[flags], (np.repeat(start[at], size[at]) + within(size[at]))[flags]
            by = np.lexsort((where, doc))
            doc, where, total = runs(doc[by], where[by], length)
            yield from by_shelf(n_blocks, doc, did, tid, where.astype(np.int32), total.astype(np.int32))

    def byte_cuts(data, stretch):
        return [(k, min(len(data), k + stretch + length - 1), k) for k in range(0, max(1, len(data) - length + 1), stretch)]

    lists = repeated_seeds(keys, seeds_of, n_blocks, within=False, cuts=byte_cuts, stretch=stretch)
    return texts, in_blocks(with_lists(texts, lists, deal_out, ROUTED), n_blocks, judge)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = True,
                   stretch: int = STRETCH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end,
    ...) and, if ``with_text``, kept (bytes) of every row."""
    texts, found = spans(docs, length, gram, stretch)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(rows: pa.Table, bodies: list[bytes]) -> pa.Table:
        code = code_of(*(np.asarray(rows[c].combine_chunks()) for c in ("did", "tid")))
        owner, begin, size = entries(bodies) if bodies else (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 2)
        order = np.argsort(owner)
        owner, begin, size = owner[order], begin[order].astype(np.int64), size[order].astype(np.int64)
        lo, hi = np.searchsorted(owner, code), np.searchsorted(owner, code, side="right")
        total, removed, kept, digests, edges, n = [], [], [], [], [], 0
        for batch in unpacked(rows.to_batches()):
            for text in batch.column("text").to_pylist():
                raw = text.encode()
                change = np.zeros(len(raw) + 2, dtype=np.int64)
                np.add.at(change, begin[lo[n]: hi[n]] + 1, 1)
                np.add.at(change, (begin + size)[lo[n]: hi[n]] + 1, -1)
                n += 1
                edge = np.flatnonzero(np.diff(np.cumsum(change) > 0))
                at, left = 0, []
                for a, b in zip(edge[0::2], edge[1::2]):
                    left.append(raw[at:a])
                    at = b
                left.append(raw[at:])
                left = b"".join(left)
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left if with_text else None)
                total.append(len(raw))
                removed.append(len(raw) - len(left))
                edges.append(edge.tolist())
        return pa.table({"doc_id": rows["doc_id"], "n_bytes": pa.array(total, pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()),
                         "n_spans": pa.array([len(e) // 2 for e in edges], pa.int64()),
                         "kept": pa.array(kept, pa.binary()),
                         "kept_sha256": pa.array(digests, pa.string()),
                         "spans": pa.array(edges, pa.list_(pa.int64()))})

    out = with_lists(texts, found, run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, "
                                        "kept_sha256 string, spans array<long>")
    return out if with_text else out.drop("kept")


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir), with_text=False)
    return stored(found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), "op9")
