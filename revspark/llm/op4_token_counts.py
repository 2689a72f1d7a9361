"""Token counts by dynamic programming over a shared trie.

The distinct pre-tokens of a task's stretch of texts are inserted in a trie.
The unigram forward score of a trie node, the best sum of piece scores over
all ways to cut its prefix into vocabulary pieces, is computed once however
many pre-tokens share the prefix; with it goes the number of pieces of that
cut.  The counts stored at the terminal nodes are looked up by all
occurrences of the pre-token and summed per document.  The trie is walked
level by level, all nodes of a depth at once.

A pre-token is a word ``[^\\x20\\x09-\\x0D]+`` with one blank before it, as
UTF-8 bytes.  The vocabulary is a file of byte pieces with ranks; as it gives
no probabilities, a piece of rank r has probability 1 / (r + 1) over the
harmonic sum (Zipf's law).  Of cuts with equal scores the one with the shorter
last piece counts.  A byte that is no piece is a token of its own, 10 below
the least score.

Nothing is shuffled or collected; the broadcast is the vocabulary.

Defined results: a null or empty text has 0 pre-tokens and 0 tokens; texts of
any length are counted whole (pre-tokens over ``LONG`` bytes one by one, not
in the trie).  Repeated rows, null ids and clashing columns pass through row
by row; an empty table gives an empty result.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import rolling as R
from .common import documents, in_stretches, text_bytes

STRETCH, LONG = 6 << 20, 512


class Pieces:
    """Vocabulary pieces with scores, found by the hash of their bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        n = max(ranks.values(), default=0) + 1
        total = float((1 / np.arange(1, n + 1)).sum())
        ranks = {p: r for p, r in ranks.items() if p}
        self.scores = {p: -float(np.log((r + 1) * total)) for p, r in ranks.items()}
        self.unknown = min(self.scores.values(), default=0.0) - 10
        for b in range(256):
            self.scores.setdefault(bytes([b]), self.unknown)
        self.longest = max(map(len, self.scores))
        pieces = list(self.scores)
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        end = np.cumsum([len(p) for p in pieces])
        start = end - [len(p) for p in pieces]
        hashes = R.word_hashes(data, start, end)
        order = np.argsort(hashes)
        self.hash, self.score = hashes[order], np.array(list(self.scores.values()))[order]
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Scores; minus infinity for what is no piece."""
        out = np.full(len(hashes), -np.inf)
        on = np.flatnonzero(self.maybe[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hash, hashes[on]), len(self.hash) - 1)
        hit = self.hash[at] == hashes[on]
        out[on[hit]] = self.score[at[hit]]
        return out

    def count_one(self, word: bytes) -> tuple[int, float]:
        """Tokens and score of one pre-token, position by position."""
        best, count = [0.0], [0]
        for end in range(1, len(word) + 1):
            top, n = -np.inf, 0
            for size in range(1, min(end, self.longest) + 1):
                score = self.scores.get(word[end - size: end])
                if score is not None and best[end - size] + score > top:
                    top, n = best[end - size] + score, count[end - size] + 1
            best.append(top)
            count.append(n)
        return count[-1], best[-1]


def trie_counts(data: np.ndarray, start: np.ndarray, end: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Tokens of the distinct pre-tokens data[start:end]."""
    n, length = len(start), end - start
    counts = np.zeros(n, dtype=np.int64)
    sums = R.prefix(data.astype(np.uint64) + np.uint64(1), R.BYTE_BASE)
    active = np.arange(n)
    root = np.zeros(n, dtype=np.int64)
    levels = [(root, np.zeros(1), np.zeros(1, dtype=np.int64))]  # of each depth: node of a word, score, tokens
    for depth in range(1, int(length.max(initial=0)) + 1):
        active = active[length[active] >= depth]
        above = levels[-1][0]
        keys, first, node = np.unique(above[active] << 8 | data[start[active] + depth - 1], return_index=True, return_inverse=True)
        word = active[first]  # stands for its node
        score, tokens = np.full(len(keys), -np.inf), np.zeros(len(keys), dtype=np.int64)
        for size in range(1, min(depth, pieces.longest) + 1):
            b = start[word] + depth
            value = pieces.look_up(R.mix(R.stretches(sums, b - size, b, R.BYTE_BASE) + np.uint64(size)))
            back, back_score, back_tokens = levels[-size]
            value += back_score[back[word]]
            better = value > score
            score[better] = value[better]
            tokens[better] = back_tokens[back[word[better]]] + 1
        of = np.zeros(n, dtype=np.int64)
        of[active] = node
        levels.append((of, score, tokens))
        if len(levels) > pieces.longest:
            levels.pop(0)
        done = active[length[active] == depth]
        counts[done] = tokens[of[done]]
    return counts


def count_stretch(data: np.ndarray, off: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Pre-tokens and tokens of each text of a batch."""
    n = len(off) - 1
    start, end = R.words_of_texts(data, off)
    doc = np.searchsorted(off, start, side="right") - 1
    if not len(start):
        return np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    hashes = R.word_hashes(data, start, end)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    length = (end - start)[first]
    short = np.flatnonzero(length < LONG)
    size = length[short] + 1
    to = np.cumsum(size)
    blank = to - size
    words = np.full(int(to[-1]) if len(to) else 0, 0x20, dtype=np.uint8)
    inner = np.ones(len(words), dtype=bool)
    inner[blank] = False
    words[inner] = data[np.arange(length[short].sum()) + np.repeat(start[first[short]] - (np.cumsum(length[short]) - length[short]),
                                                                   length[short])]
    tokens = np.zeros(len(first), dtype=np.int64)
    tokens[short] = trie_counts(words, blank, to, pieces)
    for i in np.flatnonzero(length >= LONG):
        tokens[i] = pieces.count_one(b" " + data[start[first[i]]: end[first[i]]].tobytes())[0]
    return (np.bincount(doc, minlength=n),
            np.bincount(doc, weights=tokens[which], minlength=n).astype(np.int64))


def read_ranks(path: str | None = None) -> dict[bytes, int]:
    """Pieces and ranks of a vocabulary file (base64 piece and rank a line)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for batch in in_stretches(batches, "text", STRETCH):
            words, tokens = count_stretch(*text_bytes(batch.column(1)), pieces)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=["doc_id", "n_pretokens", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_pretokens long, n_tokens long")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir))
