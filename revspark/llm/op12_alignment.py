"""Cross-tokenizer alignment by token spans.

Two tokenizers, A (byte-level BPE, ``tokenizers``) and B (pieces with byte
fallback, ``sentencepiece``), encode a blank and the text.  Byte offsets where
a token of both ends cut the tokens into groups; the two tokens that end there
are a link.

1. Spans.  A's character offsets and B's proto spans (``offset_mapping`` of the
   installed version, which no longer knows ``immutable_proto``) give the
   character at which each token ends: coarse cuts, which are exact where every
   character is one byte.
2. Refinement.  A multibyte character may be split by either tokenizer, and
   byte-fallback tokens report the whole character or nothing; there the ends
   are counted in the decoded bytes of the tokens.  Decoded bytes also tell
   whether both tokenizers give the text back; if not, it has no tokens.
3. Fragments.  No token of either vocabulary reaches over the place before a
   blank or line feed that follows a visible character: A's pre-tokens end
   there, no piece of B has a word mark behind another character, and a line
   feed is a byte token of its own (both checked).  So a text is cut there, a
   distinct fragment is aligned once per worker, in a bounded cache, and a
   document's groups are those of its fragments in order.  With other
   vocabularies the whole text is one fragment.
4. Corpus counts.  Each document keeps its distinct pairs of ids with their
   number.  Links per pair are summed by Spark with partial sums in the tasks,
   the highest per id of B by one more aggregate over the pairs.  The pair
   table grows with the vocabularies, not with the corpus; up to
   ``BROADCAST_PAIRS`` rows it is broadcast to the documents' pairs, above that
   they are joined by shuffle.

Defined results: a null or empty text, or one that either tokenizer does not
give back byte by byte (such as one with U+2581, which B takes for a blank),
has no tokens: zeros and the empty string.  Strings of special tokens are
plain text.  Rows are judged one by one: repeated rows and null ids are rows of
their own, and all count in the corpus.  An empty table gives an empty result.
Other columns are not read.
"""
from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, in_stretches, keeps, stored
from .op8_bpe import WHITE, WHITE_POINTS, byte_alphabet

#: Fragments kept per worker, and the length up to which one is kept.
CACHE, CACHE_LENGTH = 400_000, 64
#: Text bytes of documents aligned at once, and characters of new fragments encoded in one call.
STRETCH, CALL = 2 << 20, 4000
#: Pairs of ids up to which their table is broadcast (about 25 bytes each).
BROADCAST_PAIRS = 2_000_000
MARK = "▁"
CUT = re.compile(f"(?<=[^{WHITE}])(?=[ \n])")
#: White characters before a blank or line feed; without them every blank and line feed is a cut.
TWICE = [chr(p) + c for p in WHITE_POINTS for c in " \n"]
TWICE_ASCII = [x for x in TWICE if x.isascii()]


def fragments(text: str) -> list[str]:
    """A blank and the text, cut before each blank or line feed that follows
    a visible character.  The one blank that begins a fragment is left out,
    unless another or a line feed follows it."""
    if not any(map(text.__contains__, TWICE_ASCII if text.isascii() else TWICE)) and text[0] not in " \n":
        return text.replace("\n", " \n").split(" ")
    first, *rest = CUT.split(text)
    return [" " + first if first[0] in " \n" else first, *[f if f[0] == "\n" or f[1:2] in (" ", "\n") else f[1:] for f in rest]]


def full(fragment: str) -> str:
    return fragment if fragment[:1] in ("\n", " ") and fragment else " " + fragment


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the fragments known."""

    def __init__(self, config: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(config), SentencePieceProcessor(model_proto=model)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        table, spec = byte_alphabet(), json.loads(config)
        bytes_a = {i: bytes(table[c] for c in t) for t, i in spec["model"]["vocab"].items() if all(c in table for c in t)}
        self.bytes_a = [bytes_a.get(i, b"") for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.width = len(pieces)
        level = spec.get("pre_tokenizer") or {}
        self.cuts = (level.get("type") == "ByteLevel" and level.get("use_regex", True) and not level.get("add_prefix_space")
                     and not spec.get("normalizer") and not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces))
        self.told: dict[int, str] = {}  # link -> its group, where both sides are one token
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # fragment -> its number
        self.groups: list[str | None] = []  # by number; None: not given back
        self.sizes = np.empty((0, 4), dtype=np.int64)  # tokens of A, of B, links, first link
        self.links = np.empty(0, dtype=np.int64)  # A id * size of B + B id

    def encoded(self, texts: list[str]):
        """Per text: ids and end offsets of A and B in the bytes of a blank
        and the text; None where they do not give it back."""
        for text, a, b in zip(texts, self.a.encode_batch([" " + t for t in texts], add_special_tokens=False),
                              self.b.encode(texts, num_threads=1, return_type="offset_mapping")):
            ids_a, ids_b, raw = a.ids, b["ids"], b" " + text.encode()
            in_a, in_b = [self.bytes_a[i] for i in ids_a], [self.bytes_b[i] for i in ids_b]
            if b"".join(in_a) != raw or b"".join(in_b) != raw:
                yield None
                continue
            if len(raw) == len(text) + 1:  # characters are bytes: the spans' ends are exact
                ends_a, ends_b = [e for _, e in a.offsets], [e + 1 for _, e in b["offsets"]]
            else:
                ends_a, ends_b = np.cumsum([len(t) for t in in_a]), np.cumsum([len(t) for t in in_b])
            yield tuple(np.array(x, dtype=np.int64) for x in (ids_a, ends_a, ids_b, ends_b))

    def learn(self, new: list[str]) -> None:
        """Align new fragments, many of them in one call of the tokenizers;
        one that ends in a white character can have none after it."""
        alone = [f for f in new if not f or f[-1] in WHITE]
        calls, size = [[f] for f in alone], CALL
        for f in [f for f in new if f and f[-1] not in WHITE]:
            if size + len(f) > CALL:
                calls.append([])
                size = 0
            calls[-1].append(f)
            size += len(f) + 1
        sizes, links, at = [], [self.links], len(self.links)
        whole = [[full(f) for f in call] for call in calls]
        for call, texts, found in zip(calls, whole, self.encoded(["a" + "".join(w) for w in whole])):
            each = [self.split(texts, found)] if found else [
                self.split([t], x) if x else ([None], np.zeros((1, 3), dtype=np.int64), self.links[:0])
                for t, x in zip(texts, self.encoded(["a" + t for t in texts]))]
            for groups, numbers, pairs in each:
                self.groups += groups
                begin = np.cumsum(numbers[:, 2]) - numbers[:, 2] + at
                sizes.append(np.column_stack([numbers, begin]))
                links.append(pairs)
                at += len(pairs)
            self.known |= zip(call, range(len(self.groups) - len(call), len(self.groups)))
        self.sizes = np.concatenate([self.sizes, *sizes])
        self.links = np.concatenate(links)

    def split(self, texts: list[str], found) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Of the fragments after the leading "a" of one call: their groups,
        their numbers of tokens of A, of B and of links, and the links."""
        ids_a, ends_a, ids_b, ends_b = found
        common, last_a, last_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        pairs = ids_a[last_a] * self.width + ids_b[last_b]
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        told, single = self.told, (n_a == 1) & (n_b == 1)
        groups = [told.get(p) for p in pairs.tolist()]
        for k in [k for k, g in enumerate(groups) if g is None]:
            p = int(pairs[k])
            groups[k] = told[p] = f"{p // self.width}|{p % self.width}"
        for k in np.flatnonzero(~single).tolist():
            i, j = last_a[k] + 1, last_b[k] + 1
            groups[k] = f"{','.join(map(str, ids_a[i - n_a[k]: i].tolist()))}|{','.join(map(str, ids_b[j - n_b[k]: j].tolist()))}"
        ends = np.cumsum([2, *[len(t) if t.isascii() else len(t.encode()) for t in texts]])
        cut = np.searchsorted(common, ends)  # every fragment ends at a common end
        numbers = np.column_stack([np.diff(last_a[cut]), np.diff(last_b[cut]), np.diff(cut)])
        at = (cut + 1).tolist()
        return [";".join(groups[x:y]) for x, y in zip(at, at[1:])], numbers, pairs[at[0]:]

    def rows(self, texts: list[str]) -> tuple[list, list]:
        """Per text n_a, n_b, n_groups and the digest of the groups; and per
        text its distinct pairs with their numbers."""
        if max(len(self.known), len(self.links) // 8) > CACHE:
            self.forget()
        parts = [(fragments(t) if self.cuts else [" " + t if t[0] in " \n" else t]) if t else [] for t in texts]
        flat = list(chain.from_iterable(parts))
        new = set(flat).difference(self.known)
        self.learn(list(new))
        flat = list(map(self.known.__getitem__, flat))
        told = list(map(self.groups.__getitem__, flat))
        cut = np.cumsum([0, *map(len, parts)]).tolist()
        told = [told[x:y] for x, y in zip(cut, cut[1:])]
        good = np.array([bool(t) and None not in t for t in told], dtype=bool)
        row = np.repeat(np.arange(len(texts)), np.diff(cut))
        flat = np.array(flat, dtype=np.int64)[good[row]]
        row = row[good[row]]
        chosen = self.sizes[flat]
        sums = [np.bincount(row, chosen[:, i], len(texts)).astype(np.int64) for i in range(3)]
        # the links of all fragments, one after the other
        n = chosen[:, 2]
        before = np.cumsum(n) - n
        links = self.links[np.repeat(chosen[:, 3] - before, n) + np.arange(int(n.sum()))]
        size = np.int64(len(self.bytes_a)) * self.width
        pairs, times = np.unique(np.repeat(row, n) * size + links, return_counts=True)
        digests = [hashlib.sha256(";".join(t).encode()).hexdigest() if g else "" for t, g in zip(told, good)]
        for f in new:
            if len(f) > CACHE_LENGTH:
                self.groups[self.known.pop(f)] = None
        return [*sums, digests], [np.searchsorted(pairs // size, np.arange(len(texts) + 1)), pairs % size, times]


_aligners: dict[str, Aligner] = {}
keeps("op12", _aligners.clear)


def aligner_for(config: str, model: bytes) -> Aligner:
    """One aligner, with its cache, per worker process and pair of vocabularies."""
    key = hashlib.sha256(config.encode() + model).hexdigest()
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(config, model)
    return _aligners[key]


def read_vocabularies(byte_level: str | None = None, pieces: str | None = None) -> tuple[str, bytes]:
    """Contents of the two tokenizer files; by default the public ones."""
    import public_tokenizers
    with open(byte_level or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        config = f.read()
    with open(pieces or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return config, f.read()


def aligned(docs: DataFrame, vocabularies: tuple[str, bytes] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b,
    n_groups, groups_sha256, and its distinct linked pairs (A id * size of B +
    B id, ascending) with the ``times`` it has each."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies or read_vocabularies())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = aligner_for(*shared.value)
        for batch in in_stretches(batches, "text", STRETCH):
            (n_a, n_b, n_groups, digests), (cut, pairs, times) = made.rows(batch.column(1).to_pylist())
            offsets = pa.array(cut, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(offsets, pa.array(pairs, pa.int64())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
                names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(rows: DataFrame, pieces: int) -> DataFrame:
    """(pair, links, best): links in the whole corpus, and whether no pair with
    the same id of B (of ``pieces``) has more."""
    each = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    counts = stored(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("links")), "op12-pairs")
    most = counts.groupBy((F.col("pair") % pieces).alias("b")).agg(F.max("links").alias("most"))
    return counts.join(most, counts["pair"] % pieces == most["b"]).select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def align(docs: DataFrame, vocabularies: tuple[str, bytes] | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    of every row."""
    from sentencepiece import SentencePieceProcessor

    vocabularies = vocabularies or read_vocabularies()
    pieces = SentencePieceProcessor(model_proto=vocabularies[1]).get_piece_size()
    rows = stored(aligned(docs, vocabularies).withColumn("row", F.monotonically_increasing_id()), "op12-rows")
    counts = stored(pair_counts(rows, pieces), "op12-counts")
    if counts.count() <= broadcast_pairs:  # from the Parquet footers
        counts = F.broadcast(counts)
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    sums = each.join(counts, "pair").groupBy("row").agg(
        F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("links")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", *[F.coalesce(c, zero).alias(c) for c in ("n_links", "n_best", "count_sum")],
        "groups_sha256")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir)).withColumn("doc_id", F.col("doc_id").cast("long"))
