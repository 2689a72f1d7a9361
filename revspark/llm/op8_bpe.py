"""Byte-level BPE encoding and decoding with forced boundaries.

A byte pair that occurs inside no vocabulary token can never end up inside
a token, so the text may be cut between the two bytes: both sides encode
independently and their ids are concatenated.  The pairs are read off the
vocabulary once per worker (a 256 x 256 table).

Cuts are made on two levels.  Outer cuts are impossible pairs that are
pre-token boundaries as well and need no look at the rest of the text:
before a blank that follows a visible character, and around a single line
feed between visible characters (checked against the table; if a vocabulary
had such a pair in a token, the outer level would be switched off).  Each outer fragment, a word with its blank,
is encoded once and remembered in a bounded cache; a stretch's unknown
fragments are encoded together.  Inner cuts split the pre-tokens of a
fragment at all other impossible pairs; what is left is merged by rank, all
parts side by side.  In texts with other white space the pre-tokens of the
whole text are the fragments; a special token's string is one as well.

Decoding joins the bytes of the tokens, fragment by fragment; a distinct
fragment's ids are turned back into bytes once.

Per row, in Arrow batches, no shuffle; memory is bounded by the cache of
``CACHE`` fragments, one stretch and the longest text.  The vocabulary file is a
parameter and is shipped to the tasks as its content.

Defined results: a null text counts as empty: 0 tokens, the digest of the
empty string twice.  Repeated rows, null ids and other columns are passed
through row by row; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import documents, in_stretches, keeps, task

#: Fragments kept per worker (about 250 bytes each); a longer fragment is not kept.
CACHE, CACHE_LENGTH = 300_000, 64
#: Text bytes whose unknown fragments are encoded together; longer parts are encoded one by one.
STRETCH, LONG = 1 << 20, 128
NONE = np.iinfo(np.int64).max
#: The Unicode White_Space characters, as the tokenizer's pattern takes them.
WHITE_POINTS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
                0x3000]
WHITE = "".join(map(chr, WHITE_POINTS))
PRE_TOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: What outer cuts do not cover: white characters but blank and line feed, and two of these in a row.
ODD = [*[chr(c) for c in WHITE_POINTS if c not in (0x20, 0x0A)], "  ", " \n", "\n ", "\n\n"]


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary:
    itself where printable, else the next free one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    def __init__(self, config: str):
        spec = json.loads(config)
        table = byte_alphabet()
        as_bytes = lambda token: bytes(table[c] for c in token)
        vocab = {as_bytes(token): i for token, i in spec["model"]["vocab"].items() if all(c in table for c in token)}
        self.token = {i: b for b, i in vocab.items()}
        self.byte_id = [vocab.get(bytes([b])) for b in range(256)]
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.token |= {i: s.encode() for s, i in self.special.items()}
        self.split_special = regex.compile("(" + "|".join(
            map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.vocab_size = max(self.token) + 1
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = map(as_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            self.merge[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.never = np.ones((256, 256), dtype=bool)
        for token in vocab:
            for a, b in zip(token, token[1:]):
                self.never[a, b] = False
        # bytes of wide white characters also occur in tokens beside a blank; there the pre-token boundary makes the cut
        seen = [b for b in range(256) if b not in set(WHITE.encode())]
        self.outer = bool(self.never[seen, 0x20].all() and self.never[seen, 0x0A].all() and self.never[0x0A, seen].all())
        pairs = np.array([a * self.vocab_size + b for a, b in self.merge], dtype=np.int64)
        order = np.argsort(pairs)
        self.pairs, (self.ranks, self.made) = pairs[order], np.array(list(self.merge.values()), dtype=np.int64)[order].T
        self.digits = {i: str(i) for i in self.token}
        self.known: dict[str, str] = {}  # fragment -> its ids, joined by commas
        self.changed: dict[str, bytes] = {}  # fragments that do not decode to themselves

    def merge_parts(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts that begin at ``first``, and n + 1 offsets.  In
        each round every part merges its pair of the lowest rank, the
        leftmost of equal ones; parts without a mergeable pair are done."""
        n, size = len(first), np.diff(np.append(first, len(data)))
        ids = np.array(self.byte_id, dtype=np.int64)[data]
        part = np.repeat(np.arange(n), size)
        done_ids, done_parts = [], []
        for p in np.flatnonzero(size > LONG):
            out: list[int] = []
            self.merge_long(ids[first[p]: first[p] + size[p]].tolist(), out)
            done_ids.append(np.array(out, dtype=np.int64))
            done_parts.append(np.full(len(out), p))
        keep = (size <= LONG)[part]
        ids, part = ids[keep], part[keep]
        while len(ids):
            key = ids[:-1] * self.vocab_size + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            found = (self.pairs[at] == key) & (part[1:] == part[:-1])
            code = np.full(len(ids), NONE)
            on = np.flatnonzero(found)
            code[on] = self.ranks[at[on]] << 32 | on
            begin = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            best = np.minimum.reduceat(code, begin)
            more = best != NONE
            place = best[more] & 0xFFFFFFFF
            ids[place] = self.made[at[place]]
            left = np.ones(len(ids), dtype=bool)
            left[place + 1] = False
            over = ~np.repeat(more, np.diff(np.append(begin, len(ids))))
            done_ids.append(ids[over])
            done_parts.append(part[over])
            left &= ~over
            ids, part = ids[left], part[left]
        ids = np.concatenate(done_ids) if done_ids else np.empty(0, np.int64)
        part = np.concatenate(done_parts) if done_parts else np.empty(0, np.int64)
        order = np.argsort(part, kind="stable")
        return ids[order], np.searchsorted(part[order], np.arange(n + 1))

    def learn(self, fragments: list[str]) -> None:
        """Encode fragments together: pre-tokens, cut at the impossible
        pairs, parts merged by rank.  A fragment ends where a pre-token ends."""
        tokens = [PRE_TOKEN.findall(f) for f in fragments]
        raw = [t.encode() for f in tokens for t in f]
        if not raw:
            return
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        start = np.cumsum([0, *map(len, raw)])
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:-1] = self.never[data[:-1], data[1:]]
        cut[start] = True
        first = np.flatnonzero(cut[:-1])
        ids, off = self.merge_parts(data, first)
        ends = np.searchsorted(first, start[np.cumsum([0, *map(len, tokens)])])
        off = off[ends].tolist()
        ids = ids.tolist()
        digits, token = list(map(self.digits.__getitem__, ids)), list(map(self.token.__getitem__, ids))
        for f, a, b in zip(fragments, off, off[1:]):
            self.known[f] = ",".join(digits[a:b])
            if (decoded := b"".join(token[a:b])) != f.encode():
                self.changed[f] = decoded

    def merge_long(self, ids: list[int], out: list[int]) -> None:
        """The same for long parts: a heap of pairs over a linked list."""
        import heapq

        n, find = len(ids), self.merge.get
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := find((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, made, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (m := find((ids[a], ids[b]))):
                    heapq.heappush(heap, (m[0], a, m[1], ids[a], ids[b]))
        out += [x for x in ids if x >= 0]

    def fragments(self, text: str) -> list[str]:
        """The text cut where no token can reach over; special tokens'
        strings are fragments of their own."""
        if self.split_special and self.split_special.search(text):
            return [x for piece in self.split_special.split(text) if piece
                    for x in ([piece] if piece in self.special else self.fragments(piece))]
        if not self.outer or any(map(text.__contains__, ODD)):
            return PRE_TOKEN.findall(text)
        out: list[str] = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append("\n")
            words = line.split(" ")
            if words[0]:
                out.append(words[0])
            out += [" " + w for w in words[1:]]
        return out

    def encode_batch(self, texts: list[str]) -> list[tuple[list[str], str]]:
        """Per text: its fragments, and all ids joined by commas."""
        if len(self.known) > CACHE:
            self.known.clear()
            self.changed.clear()
        cut = list(map(self.fragments, texts))
        self.known |= {s: str(i) for s, i in self.special.items()}
        new = {f for fragments in cut for f in fragments}.difference(self.known)
        self.learn(list(new))
        look = self.known.__getitem__
        out = [(fragments, ",".join(map(look, fragments))) for fragments in cut]
        for f in new:
            if len(f) > CACHE_LENGTH and f not in self.changed:
                del self.known[f]
        return out

    def decoded(self, fragments: list[str]) -> bytes:
        """Bytes of the tokens of the fragments, as a text in UTF-8; invalid
        sequences become U+FFFD."""
        if not self.changed or not self.changed.keys() & set(fragments):
            return "".join(fragments).encode()
        return b"".join([self.changed.get(f) or f.encode() for f in fragments]).decode("utf-8", "replace").encode()

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.encode_batch([text])[0][1].split(",") if x]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Per text: token count, SHA-256 of the ids joined by commas and of
        the decoded text."""
        return [(ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                 hashlib.sha256(self.decoded(fragments)).hexdigest()) for fragments, ids in self.encode_batch(texts)]


_codecs: dict[str, ByteBPE] = {}
keeps("op8", _codecs.clear)


def codec_for(config: str) -> ByteBPE:
    """One codec, with its caches, per worker process and vocabulary."""
    key = hashlib.sha256(config.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = ByteBPE(config)
    return _codecs[key]


def read_vocabulary(path: str | None = None) -> str:
    """Content of a tokenizer file; by default the public byte-level one."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    @task("op8")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(shared.value)
        for batch in in_stretches(batches, "text", STRETCH):
            rows = codec.digests([t or "" for t in batch.column(1).to_pylist()])
            n, ids, decoded = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                                              pa.array(decoded, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and the token ids of every row (``ids array<int>``)."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    @task("op8")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(shared.value)
        for batch in in_stretches(batches, "text", STRETCH):
            ids = [[int(x) for x in found.split(",") if x]
                   for _, found in codec.encode_batch([t or "" for t in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(documents(spark, sf_dir))
