"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

The benchmark is a query set that is matched against every document.  It is
taken in blocks of at most ``block_chars`` characters of item text (or one
longer item), ``scan_blocks`` of them at a time, so what is collected and
broadcast has a fixed bound; the number of scans grows with the benchmark,
not with the corpus.  Neither changes the result.  For each scan:

1. One pass counts, for every seed of the blocks, the documents that have it
   (summed inside the tasks before anything is sent; one row per seed and
   task).  The seeds of an item are its pairs of neighbouring words; of
   items of up to five words also such pairs with a word put in (the words
   themselves if ``min_score`` is set so low that this is not enough).
2. A second pass joins the passages of the documents to the items by these
   seeds, inside the tasks.  A passage is a candidate if it has as many seeds
   of the item, as close together, as every copy has that reaches
   ``min_score``; no seed is left out for being frequent.
3. Each candidate, with as much text on both sides as such a copy can take,
   is aligned with the item by Smith-Waterman over words (match 2, mismatch
   and gap -1).  A score of at least ``min_score`` of the score of a perfect
   copy is a leak, so edited and partly rewritten copies are found as well.
   Rarity only orders this work: candidates with a seed that is rare for its
   item (at most ``common`` times as many documents as three quarters of the
   item's seeds have) come first, and after a perfect copy no further one of
   the same item and text is aligned.

Words are maximal runs of characters other than ASCII white space and
punctuation, in lower case.

Defined results: a null or empty text has no leaks.  An item without words
leaks nowhere; one with fewer than ``gram`` words needs its whole sequence.
Items with equal text are all reported, an id of several items once; item
ids keep their type, null ones come last.  Rows are judged one by one, so
repeated rows alike, and rows that share a doc_id or have none apart.
Empty tables give clean documents or an empty result.  Other columns are
ignored by ``judge`` and unchanged in ``drop_leaks``.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructField, StructType

from revspark.sources.tables import table

from . import rolling as R
from .common import documents, in_stretches, stored, task

GRAM, COMMON, MIN_SCORE, BLOCK_CHARS, SCAN_BLOCKS = 3, 2.0, 0.6, 4_000_000, 4
MATCH, MISS, GAP = 2, 1, 1
#: Seeds of an item: single words, pairs of neighbours, and such pairs with a word put in; how far apart the words are in a text.
KINDS = {1: 1, 2: 1, 3: 2}
#: From this score on, a copy that has no pair left has one word put in between all words (up to 5 of them).
APART_SCORE = 0.6
#: Seeds of items in a stretch of text that are looked at together.
HITS = 4_000_000
_BREAK = R.SPACE.copy()
_BREAK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def words_by_text(texts) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and n + 1 offsets."""
    raw = [(t or "").lower().encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(b) + 1 for b in raw])]).astype(np.int64)
    data = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    starts, ends = R.words_of(data, _BREAK)
    return R.word_hashes(data, starts, ends), np.searchsorted(starts, off)


class Items:
    """A block of benchmark items: words, seeds, and which item has them.

    An alignment of an item of n words that scores s of a perfect copy has m
    <= n matches and at most 2m - 2sn errors, so it holds at least
    (2s - 1)n - 1 pairs of neighbouring words intact (``need``), takes at most
    (3 - 2s)n words of the text (``span``) and has at most 2(1 - s)n words put
    in (``reach``)."""

    def __init__(self, texts: list[str], gram: int, min_score: float):
        self.words, self.off = words_by_text(texts)
        n = np.diff(self.off)
        least = self.least = np.where(n >= gram, min_score, 1.0)
        need = np.ceil((2 * least - 1) * n - 1 - 1e-9).astype(np.int64)
        apart = (n > 1) & (need < 1) & (least >= APART_SCORE)  # no pair is sure to be left
        single = ((n == 1) | (need < 1)) & ~apart  # words are counted
        self.need = np.maximum(1, np.where(single, np.ceil(least * n - 1e-9).astype(np.int64), need))
        self.span = ((3 - 2 * least) * n + 1e-9).astype(np.int64)
        self.reach = (2 * (1 - least) * n + 1e-9).astype(np.int64)
        of, at = np.repeat(np.arange(len(n)), n), np.arange(len(self.words))
        hashes, places = [], []
        for kind in KINDS:
            take = single[of] if kind == 1 else (apart if kind == 3 else ~single)[of] & (at + 1 < self.off[of + 1])
            places.append(at[take])
            hashes.append(seed_hashes(self.words, kind, 1)[at[take]])
        where, hashes = np.concatenate(places), np.concatenate(hashes)
        order = np.argsort(where, kind="stable")
        self.hash, self.item = hashes[order], of[where[order]]
        self.place = where[order] - self.off[self.item]
        self.grams, self.gram_of = np.unique(self.hash, return_inverse=True)

    def occurrences(self, words: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the seeds inside the texts, in order, and which they are
        in ``grams``."""
        starts, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for kind, apart in KINDS.items():
            hashes = seed_hashes(words, kind, apart)
            if not len(hashes) or not len(self.grams):
                continue
            at = np.minimum(np.searchsorted(self.grams, hashes), len(self.grams) - 1)
            start = np.flatnonzero(self.grams[at] == hashes)
            text = np.searchsorted(off, start, side="right") - 1
            start = start[start + (apart if kind > 1 else 0) < off[text + 1]]
            starts.append(start)
            found.append(at[start])
        start, found = np.concatenate(starts), np.concatenate(found)
        order = np.argsort(start, kind="stable")
        return start[order], found[order]

    def rare(self, documents_with: np.ndarray, common: float) -> np.ndarray:
        """Which positions in ``hash`` are rare for their item."""
        n = documents_with[self.gram_of]
        out = np.zeros(len(n), dtype=bool)
        edge = np.flatnonzero(np.diff(self.item, prepend=-1, append=-1)) if len(n) else []
        for lo, hi in zip(edge[:-1], edge[1:]):
            some = n[lo:hi][n[lo:hi] > 0]
            if len(some):
                out[lo:hi] = n[lo:hi] <= common * np.quantile(some, 0.75)
        return out


def seed_hashes(words: np.ndarray, kind: int, apart: int) -> np.ndarray:
    """Hash of each word (kind 1), or of it and the one ``apart`` words on."""
    salt = np.uint64(kind)
    if kind == 1:
        return R.mix(words + salt)
    return R.mix(words[:-apart] * R.WORD_BASE + words[apart:] + salt)


def alignment(passage: np.ndarray, item: np.ndarray) -> int:
    """Best local alignment score of two word sequences; the rows of the
    matrix are computed whole, horizontal gaps by a running maximum."""
    steps = np.arange(len(passage) + 1) * GAP
    above, best = np.zeros(len(passage) + 1, dtype=np.int64), 0
    for word in item:
        row = np.zeros_like(above)
        row[1:] = above[:-1] + np.where(passage == word, MATCH, -MISS)
        np.maximum(row, above - GAP, out=row)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + steps) - steps
        best, above = max(best, int(row.max())), row
    return best


def windows(items: Items, start: np.ndarray, gram: np.ndarray, first: np.ndarray, by_gram: np.ndarray,
            rare: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rare, text, item, start and end of the passages around the seeds that
    lie as close together as those of a leak do."""
    many = first[gram + 1] - first[gram]  # seeds with this hash, in one or more items
    hit = np.repeat(start, many)
    seed = by_gram[np.repeat(first[gram], many) + np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many)]
    order = np.lexsort((hit, items.item[seed]))
    hit, seed = hit[order], seed[order]
    item = items.item[seed]
    new = np.ones(len(hit), dtype=bool)  # a start counts once per item
    new[1:] = (hit[1:] != hit[:-1]) | (item[1:] != item[:-1])
    at, of = hit[new], item[new]
    text = np.searchsorted(off, at, side="right") - 1
    end = np.arange(len(at)) + items.need[of] - 1
    last = np.minimum(end, len(at) - 1)
    near = np.flatnonzero((end < len(at)) & (of[last] == of) & (text[last] == text) & (at[last] - at < items.span[of]))
    change = np.zeros(len(at) + 1, dtype=np.int64)
    np.add.at(change, near, 1)
    np.add.at(change, end[near] + 1, -1)
    keep = (np.cumsum(change)[:-1] > 0)[np.cumsum(new) - 1]
    hit, seed, item = hit[keep], seed[keep], item[keep]
    text = np.searchsorted(off, hit, side="right") - 1
    lo, reach = hit - items.place[seed], items.reach[item]
    return (rare[seed], text, item, np.maximum(lo - reach, off[text]),
            np.minimum(lo + np.diff(items.off)[item] + reach, off[text + 1]))


def leaks_in(items: Items, rare: np.ndarray, words: np.ndarray, off: np.ndarray,
             hits: int = HITS) -> list[tuple[int, int, float]]:
    """(text, item, score) of the leaks in a batch of texts.  Seeds are
    looked at in runs of about ``hits``; a run reads on as far as a leak that
    begins in it can go."""
    by_gram = np.argsort(items.gram_of, kind="stable")
    first = np.searchsorted(items.gram_of[by_gram], np.arange(len(items.grams) + 1))
    start, gram = items.occurrences(words, off)
    done = np.cumsum(first[gram + 1] - first[gram])
    out: dict[tuple[int, int], float] = {}
    i = 0
    while i < len(start):
        k = max(i + 1, int(np.searchsorted(done, (done[i - 1] if i else 0) + hits, side="right")))
        end = int(np.searchsorted(start, start[k - 1] + items.span.max(), side="right"))
        align_windows(items, windows(items, start[i:end], gram[i:end], first, by_gram, rare, off), words, out)
        i = k
    return [(t, q, s) for (t, q), s in out.items()]


def align_windows(items: Items, found: tuple[np.ndarray, ...], words: np.ndarray, out: dict) -> None:
    """Align the passages with their items, those with a rare seed first."""
    rare, text, item, lo, hi = found
    order = np.lexsort((lo, item, text))
    merged = []
    for r, t, q, a, b in zip(*(x[order].tolist() for x in (rare, text, item, lo, hi))):
        if merged and merged[-1][1:3] == [t, q] and a <= merged[-1][4]:
            merged[-1][0] |= r
            merged[-1][4] = max(b, merged[-1][4])
        else:
            merged.append([r, t, q, a, b])
    for _, t, q, a, b in sorted(merged, key=lambda x: not x[0]):
        if out.get((t, q)) == 1.0:
            continue  # nothing can score more
        wanted = items.words[items.off[q]: items.off[q + 1]]
        passage, least = words[a:b], float(items.least[q])
        whole = MATCH * len(wanted)
        if MATCH * int(np.isin(wanted, passage).sum()) < least * whole:
            continue  # no alignment can reach the score
        score = alignment(passage, wanted) / whole
        if score >= least:
            out[t, q] = max(score, out.get((t, q), 0.0))


def blocks(bench: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """The items as lists of (item_id, text) with a bounded size."""
    sized = stored(bench.select("item_id", "text", F.xxhash64("item_id", "text").alias("h")), "op7-items")
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(2 * total / block_chars))
    for i in range(n):
        part, size = [], 0
        for row in sized.filter(F.pmod("h", F.lit(n)) == i).toLocalIterator():
            part.append((row["item_id"], row["text"]))
            size += len(row["text"] or "")
            if size >= block_chars:
                yield part
                part, size = [], 0
        if part:
            yield part


def scan_leaks(docs: DataFrame, parts: list[list[tuple]], gram: int, common: float, min_score: float, kind: str,
               clean: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, further columns) without the text, with the
    ids and the best score of the leaks of several blocks, in one scan.
    With ``clean``: the rows of ``docs`` that have no leak, unchanged."""
    sc = docs.sparkSession.sparkContext
    shared = [sc.broadcast(Items([t for _, t in part], gram, min_score)) for part in parts]

    @task("op7")
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(len(x.value.grams), dtype=np.int64) for x in shared]
        for batch in in_stretches(batches, "text"):
            words, off = words_by_text(batch.column(0).to_pylist())
            for sums, items in zip(total, shared):
                start, found = items.value.occurrences(words, off)
                text = np.searchsorted(off, start, side="right") - 1
                pair = np.unique(text * len(sums) + found)
                sums += np.bincount(pair % max(1, len(sums)), minlength=len(sums))
        for block, sums in enumerate(total):
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), block)), pa.array(some), pa.array(sums[some])],
                                             names=["block", "gram", "n"])

    counted = docs.select("text").mapInArrow(count, "block long, gram long, n long").groupBy("block", "gram").agg(
        F.sum("n").alias("n"))
    with_gram = [np.zeros(len(x.value.grams), dtype=np.int64) for x in shared]
    for row in counted.toLocalIterator():  # one row per n-gram of the blocks
        with_gram[row["block"]][row["gram"]] = row["n"]
    rare = [sc.broadcast(x.value.rare(n, common)) for x, n in zip(shared, with_gram)]
    ids = sc.broadcast([[i for i, _ in part] for part in parts])
    at = docs.columns.index("text")
    entry = to_arrow_type(_parsed(docs, kind))
    order = lambda x: (x is None, x if x is not None else 0)

    @task("op7")
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_stretches(batches, "text"):
            words, off = words_by_text(batch.column(at).to_pylist())
            n = batch.num_rows
            found, best = [set() for _ in range(n)], [0.0] * n
            for block, items in enumerate(shared):
                for t, q, score in leaks_in(items.value, rare[block].value, words, off):
                    found[t].add(ids.value[block][q])
                    best[t] = max(best[t], score)
            if clean:
                yield batch.filter(pa.array([not x for x in found], pa.bool_()))
                continue
            others = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in others], pa.array([sorted(x, key=order) for x in found], pa.list_(entry)),
                 pa.array(best, pa.float64())], names=[*[batch.schema.names[i] for i in others], "item_ids", "score"])

    if clean:
        return docs.mapInArrow(search, docs.schema)
    fields = [f for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(search, StructType([*fields, StructField("item_ids", _parsed(docs, f"array<{kind}>")),
                                               StructField("score", DoubleType())]))


def _parsed(df: DataFrame, kind: str):
    return df.sparkSession.createDataFrame([], f"x {kind}").schema["x"].dataType


def judge(docs: DataFrame, bench: DataFrame, gram: int = GRAM, common: float = COMMON, min_score: float = MIN_SCORE,
          block_chars: int = BLOCK_CHARS, scan_blocks: int = SCAN_BLOCKS) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, item_ids (distinct,
    sorted), n_items, score (best, 0 to 1), kept."""
    kind = bench.schema["item_id"].dataType.simpleString()
    found, scans, parts = None, 0, blocks(bench.select("item_id", "text"), block_chars)
    # several scans: leaks meet by id and text, so rows that share an id, or have none, are judged apart
    told = F.sha2(F.coalesce("text", F.lit("")), 256).alias("__told")
    while chosen := list(islice(parts, scan_blocks)):
        scans += 1
        more = scan_leaks(docs.select("doc_id", told, "text"), chosen, gram, common, min_score, kind)
        found = more if found is None else found.filter("score > 0").unionByName(more.filter("score > 0"))
        if scans > 1:
            found = stored(found, "op7-leaks")
    none = F.array().cast(f"array<{kind}>")
    if found is None:
        found = docs.select("doc_id", none.alias("item_ids"), F.lit(0.0).alias("score"))
    elif scans > 1:
        hits = found.groupBy(F.col("doc_id").alias("__id"), F.col("__told").alias("__sha")).agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("ids"), F.max("score").alias("best"))
        found = docs.select("doc_id", told).join(
            hits, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__told") == F.col("__sha")), "left").select(
            "doc_id", F.coalesce("ids", none).alias("item_ids"), F.coalesce("best", F.lit(0.0)).alias("score"))
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids",
                        F.size("item_ids").cast("long").alias("n_items"), "score", (F.size("item_ids") == 0).alias("kept"))


def drop_leaks(docs: DataFrame, bench: DataFrame, gram: int = GRAM, common: float = COMMON, min_score: float = MIN_SCORE,
               block_chars: int = BLOCK_CHARS, scan_blocks: int = SCAN_BLOCKS) -> DataFrame:
    """The rows of ``docs`` without a leak, with all their columns.  A
    benchmark of one scan drops them where they are, without a join."""
    parts = blocks(bench.select("item_id", "text"), block_chars)
    chosen = list(islice(parts, scan_blocks))
    if not chosen:
        return docs
    if next(parts, None) is None:
        return scan_leaks(docs, chosen, gram, common, min_score, bench.schema["item_id"].dataType.simpleString(), clean=True)
    text = F.sha2(F.coalesce("text", F.lit("")), 256)  # rows of one doc_id with other texts are judged on their own
    named = docs.select(F.struct("doc_id", text.alias("sha")).alias("doc_id"), "text")
    bad = judge(named, bench, gram, common, min_score, block_chars, scan_blocks).filter("contaminated").select("doc_id.*").distinct()
    bad = stored(bad.select(F.col("doc_id").alias("__id"), F.col("sha").alias("__sha")), "op7-bad")
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("__id")) & (text == F.col("__sha")), "left_anti")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
