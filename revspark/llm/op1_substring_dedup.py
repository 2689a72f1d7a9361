"""Substring dedup by relative Lempel-Ziv parsing, on words.

A window is ``length`` consecutive words of a document.  Documents are
parsed against reference blocks.  A block holds, for its share of the seeds
(see ``repeats``), every window of the corpus that owns one of them; its
index is the sorted table of window hashes with the earliest source of each.
A factor is the longest run of windows whose sources run along as well, so
it is a stretch of ``length`` words or more copied from one earlier place;
at a factor's end the windows that straddle the boundary are looked up
anew, so nothing between two factors is missed.  Each document is parsed
against all blocks that hold one of its seeds, that is against all that can
hold a source; factors of all blocks together are the duplicate spans.

Equality means equal window hash and equal seed hash, 128 bits in all.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A word is
removed if a window over it also starts earlier: in a smaller doc_id, or in
the same document before.  A null text has no words; documents of fewer than
``length`` words keep all.  A null doc_id comes after all others.  Rows that
repeat a doc_id with the same text are one document and get the same result;
with different texts they are judged apart, the shared id being neither
smaller nor larger.  An empty table gives an empty result; other columns are
ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import rolling as R
from .common import documents, stored
from .packing import unpacked
from .repeats import (HERE, ROUTED, THERE, block_count, block_of, by_shelf, code_of, entries, groups_of, has_seed, in_blocks,
                      joined_spans, keyed, pack, repeated_seeds, routed_batch, seed_runs, seed_table, shelved, text_pieces,
                      unpack, with_lists)

LENGTH, GRAM = 20, 9
#: Text bytes that are numpy arrays at once: arrays that fit the caches.
STRETCH = 1 << 19
#: Windows parsed at once.
SHARE = 1 << 18


def word_runs(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Runs of windows with one seed: document, start (in words of the
    document), windows, seed; offsets of the documents in words, and the
    prefix sums of the words."""
    starts, ends = R.words_of_texts(data, off)
    first = np.searchsorted(starts, off)
    sums = R.prefix(R.word_hashes(data, starts, ends), R.WORD_BASE)
    grams = R.fixed(sums, gram, R.WORD_BASE)
    doc, start, size, place = seed_runs(grams, first, gram, length)
    return doc, start, size, grams[place], first, sums


def expanded(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ``size`` windows: the run of each window, and its place in it."""
    run = np.repeat(np.arange(len(size)), size)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)


def cuts_in_words(data: np.ndarray, stretch: int, length: int) -> Iterator[tuple[int, int, int]]:
    """(begin, end, words before) of pieces of a long text, in bytes; each has
    all words of the windows that begin in it."""
    starts, ends = R.words_of(data)
    step = max(1, len(starts) * stretch // max(1, len(data)))
    for k in range(0, max(0, len(starts) - length + 1), step):
        yield int(starts[k]), int(ends[min(k + step + length - 1, len(starts)) - 1]), k


@dataclass
class Runs:
    """Runs of windows of one seed, with the windows' hashes one after the
    other.  Seeds are independent of each other, so shares of them are parsed
    one by one, and only a share's windows have rows of their own."""
    doc: np.ndarray
    start: np.ndarray
    size: np.ndarray
    seed: np.ndarray
    window: np.ndarray

    def shares(self, key: np.ndarray, windows: int) -> Iterator[np.ndarray]:
        """Runs by shares of ``key``, which is the same for equal seeds, of
        about ``windows`` windows."""
        n = -(-len(self.window) // windows)
        if n <= 1:
            yield np.arange(len(self.doc))
            return
        share = (key % n).astype(np.int64)
        order = np.argsort(share, kind="stable")
        edges = np.searchsorted(share[order], np.arange(n + 1))
        for a, b in zip(edges[:-1], edges[1:]):
            if b > a:
                yield order[a:b]

    def windows(self, some: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, start, seed, hash) of each window of some runs."""
        size = self.size[some].astype(np.int64)
        run, within = expanded(size)
        first = (np.cumsum(self.size, dtype=np.int64) - self.size)[some]
        return (self.doc[some].astype(np.int64)[run], self.start[some].astype(np.int64)[run] + within, self.seed[some][run],
                self.window[first[run] + within])


def sources(window: np.ndarray, seed: np.ndarray, did: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The index of a block, read for each of its windows: the entry with
    the earliest occurrence of the same words (itself if none is earlier)."""
    order = np.lexsort((start, did, window))
    same = np.concatenate([[False], (window[order][1:] == window[order][:-1]) & (seed[order][1:] == seed[order][:-1])])
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    source = np.empty(len(order), dtype=np.int64)
    source[order] = order[head]
    itself = (did[source] == did) & (start[source] == start)
    return np.where(itself, np.arange(len(order)), source)


def factors(doc: np.ndarray, start: np.ndarray, source: np.ndarray, src_did: np.ndarray, src_start: np.ndarray,
            length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy parse: (document, start, words) of the maximal factors.  The
    entries are ordered by document and start; those without an earlier
    source are literals."""
    copied = np.flatnonzero(source != np.arange(len(source)))
    if not len(copied):
        return (np.empty(0, np.int64),) * 3
    d, s, a, b = doc[copied], start[copied], src_did[copied], src_start[copied]
    boundary = np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] != s[:-1] + 1) | (a[1:] != a[:-1]) | (b[1:] != b[:-1] + 1)])
    at = np.flatnonzero(boundary)
    last = np.concatenate([at[1:], [len(s)]]) - 1
    return d[at], s[at], s[last] - s[at] + length


def parse(doc, start, seed, window, did, length):
    """Factors (document, start, words) of the windows at hand, and the
    entries that have no earlier source here."""
    order = np.lexsort((start, doc))
    doc, start, seed, window = doc[order], start[order], seed[order], window[order]
    source = sources(window, seed, did[doc], start)
    found = factors(doc, start, source, did[doc[source]], start[source], length)
    first = source == np.arange(len(source))
    return (found[0], found[1].astype(np.int32), found[2].astype(np.int32)), (doc[first], start[first], seed[first], window[first])


def spans(docs: DataFrame, length: int, gram: int, stretch: int, share: int) -> tuple[DataFrame, DataFrame]:
    """The shelved texts, and the parts of their duplicate spans."""
    keys = keyed(docs)
    n_blocks = block_count(keys)
    texts = shelved(keys, n_blocks)

    def seeds_of(data, off):
        doc, _, _, seed, _, _ = word_runs(data, off, length, gram)
        return doc, seed

    def parse_here(rows: pa.Table, bodies: list[bytes]) -> pa.Table:
        if not bodies or not rows.num_rows:
            return pa.Table.from_batches([routed_batch([])])
        did, tid = (np.asarray(rows[c].combine_chunks()) for c in ("did", "tid"))
        code, known, held = code_of(did, tid), seed_table(bodies), []
        for data, off, n, _, base in text_pieces(rows, stretch, word_cuts):
            doc, start, size, seed, first, sums = word_runs(data, off, length, gram)
            on = has_seed(code[doc + n], seed, known)
            doc, start, size, seed = doc[on], start[on], size[on], seed[on]
            run, within = expanded(size)
            at = (first[doc] + start)[run] + within
            held.append(((doc + n).astype(np.int32), (start + base).astype(np.int32), size.astype(np.int32), seed,
                         R.stretches(sums, at, at + length, R.WORD_BASE)))
        if not held:
            return pa.Table.from_batches([routed_batch([])])
        runs = Runs(*(np.concatenate(x) for x in zip(*held)))
        del held
        spans, out, block = [], [], block_of(runs.seed, n_blocks)
        for some in runs.shares(block, share):
            found, (doc, start, seed, window) = parse(*runs.windows(some), did, length)
            spans.append(found)
            where = block_of(seed, n_blocks)
            order = np.lexsort((start, doc, where))
            edges = groups_of(where, order)
            for a, b in zip(edges[:-1], edges[1:]):
                at = order[a:b]
                d, s, k = doc[at], start[at], seed[at]
                run = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] != s[:-1] + 1) | (k[1:] != k[:-1])]))
                owners, owner = np.unique(d[run], return_inverse=True)
                out.append((int(where[at[0]]), THERE,
                            pack(k[run], owner.astype(np.int32), s[run].astype(np.int32),
                                 np.diff(np.append(run, len(d))).astype(np.int32), window[at], did[owners], tid[owners])))
        out += [(shelf, HERE, body) for shelf, body in shelf_rows(spans, did, tid)]
        return pa.Table.from_batches([routed_batch(out)])

    def parse_block(bodies: list[bytes]) -> Iterator[tuple]:
        parts, dids, tids, n = [], [], [], 0
        while bodies:
            seed, owner, start, size, window, did, tid = unpack(bodies.pop())
            parts.append((owner + np.int32(n), start, size, seed, window))
            dids.append(did)
            tids.append(tid)
            n += len(did)
        did, tid = np.concatenate(dids), np.concatenate(tids)
        runs = Runs(*(np.concatenate(x) for x in zip(*parts)))
        del parts
        yield from shelf_rows([parse(*runs.windows(some), did, length)[0] for some in runs.shares(runs.seed >> np.uint64(40), share)],
                              did, tid)

    def shelf_rows(spans: list[tuple], did: np.ndarray, tid: np.ndarray) -> Iterator[tuple]:
        doc, start, size = joined_spans(*(np.concatenate(x) for x in zip(*spans)))
        return by_shelf(n_blocks, doc, did, tid, start.astype(np.int32), size.astype(np.int32))

    def word_cuts(data, stretch):
        return cuts_in_words(data, stretch, length)

    lists = repeated_seeds(keys, seeds_of, n_blocks, within=True, cuts=word_cuts, stretch=stretch)
    return texts, in_blocks(with_lists(texts, lists, parse_here, ROUTED), n_blocks, parse_block)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = True, stretch: int = STRETCH,
                   share: int = SHARE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (start, end in words)
    and, if ``with_text``, kept_words (the words that stay, joined by one
    space) of every row."""
    texts, found = spans(docs, length, gram, stretch, share)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(rows: pa.Table, bodies: list[bytes]) -> pa.Table:
        code = code_of(*(np.asarray(rows[c].combine_chunks()) for c in ("did", "tid")))
        owner, begin, size = entries(bodies) if bodies else (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 2)
        order = np.argsort(owner)
        owner, begin, size = owner[order], begin[order].astype(np.int64), size[order].astype(np.int64)
        lo, hi = np.searchsorted(owner, code), np.searchsorted(owner, code, side="right")
        total, removed, kept, digests, stretches, n = [], [], [], [], [], 0
        for batch in unpacked(rows.to_batches()):
            for text in batch.column("text").to_pylist():
                words = text.encode().split()
                change = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(change, begin[lo[n]: hi[n]], 1)
                np.add.at(change, (begin + size)[lo[n]: hi[n]], -1)
                n += 1
                out = np.cumsum(change) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], out.view(np.int8), [0]])))
                total.append(len(words))
                removed.append(int(out.sum()))
                stretches.append(edge.tolist())
                at, left = 0, []
                for a, b in zip(edge[0::2], edge[1::2]):
                    left += words[at:a]
                    at = b
                left = b" ".join(left + words[at:])
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left if with_text else None)
        return pa.table({"doc_id": rows["doc_id"], "n_words": pa.array(total, pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()), "kept_words": pa.array(kept, pa.binary()).cast(pa.string()),
                         "kept_sha256": pa.array(digests, pa.string()),
                         "spans": pa.array(stretches, pa.list_(pa.int64()))})

    out = with_lists(texts, found, run, f"doc_id {kind}, n_words long, n_removed long, kept_words string, "
                                        "kept_sha256 string, spans array<long>")
    return out if with_text else out.drop("kept_words")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir), with_text=False)
    return stored(found.select("doc_id", "n_words", "n_removed", "kept_sha256"), "op1")
