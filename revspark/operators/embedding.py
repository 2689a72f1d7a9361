"""Text vectors (E1, E2) and the embedding table profile.

* :func:`hash_embeddings` – the built-in encoder: each token goes to bucket
  ``int(md5[0:7], 16) % dim`` with sign ``+1`` when the 8th hex digit is < 8,
  else ``-1``; the signs are summed per bucket and the vector is
  L2-normalised.  Everything belongs to one row: an Arrow batch looks its
  tokens up and sums their signs per row, nothing is shuffled and other
  columns stay beside the vector.  It stands in for the
  sentence-transformer weights that are not available offline.
* :func:`embed_texts` – the batch encoder path: Arrow batches, the encoder is
  built once per task and called on batches of ``batch_size`` texts of similar
  length, cut to a number of tokens.  With the default encoder and no cut it
  returns the same vectors as :func:`hash_embeddings`.  :func:`embed_with`
  picks the encoder by name, with a fallback.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import collapse_whitespace

DIM = 384
BATCH = 32
# Fixed value: tokens of a text that an encoder reads.
MAX_TOKENS = 512
R = 6
#: Texts whose sums are made at once, and token codes that a task keeps.
ROWS_AT_ONCE, MAX_CODES = 1024, 1 << 18


def _tokens(c):
    return F.filter(F.split(collapse_whitespace(c), " ", -1), lambda w: F.length(w) > 0)


def _hashed(df: DataFrame, text_col: str, dim: int, made: list, columns: Callable) -> DataFrame:
    """``df`` without ``text_col``, with the fields ``made``: what ``columns``
    gives, as (values, which are null), for the signed sum of every bucket and
    their norm of some rows; the norm of a text without tokens is nan.

    A token's code is ``2 * bucket + (1 if negative)``, from the first 8 hex
    digits of its MD5 as one number: 7 digits above, the sign's digit below.
    A task keeps the codes of the tokens that it has seen."""
    others = [c for c in df.columns if c != text_col]
    texts = df.select(*others, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("__text"))
    names = [*others, *(f.name for f in made)]

    def run(batches):
        class Codes(dict):
            def __missing__(self, token):
                x = int.from_bytes(hashlib.md5(token.encode()).digest()[:4], "big")
                self[token] = code = (x >> 4) % dim * 2 + (x >> 3 & 1)
                return code

        def column(values, null):
            if values.ndim == 1:
                return pa.array(values, mask=null)
            ends = pa.array(np.arange(len(values) + 1, dtype=np.int32) * dim)
            return pa.ListArray.from_arrays(ends, pa.array(values.ravel()), mask=pa.array(null))

        codes = Codes()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch, found = whole.slice(at, ROWS_AT_ONCE), []
                for text in batch.column(len(others)):
                    tokens = text.as_py().decode("utf-8", "replace").split()
                    found.append(np.fromiter(map(codes.__getitem__, tokens), np.int64, len(tokens)))
                    if len(codes) > MAX_CODES:
                        codes.clear()
                size, code = np.array([len(x) for x in found]), np.concatenate(found)
                slot = np.repeat(np.arange(len(size)), size) * dim + code // 2
                total = np.bincount(slot, weights=1.0 - 2.0 * (code % 2), minlength=len(size) * dim).astype(np.int32).reshape(-1, dim)
                norm = np.where(size > 0, np.sqrt((total.astype(np.int64) ** 2).sum(1).astype(np.float64)), np.nan)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(column(*x) for x in columns(total, norm))], names=names)

    return texts.mapInArrow(run, T.StructType([*[df.schema[c] for c in others], *made]))


def hash_counts(df: DataFrame, text_col: str = "text", dim: int = DIM) -> DataFrame:
    """``df`` without ``text_col``, with ``counts array<int>``: the signed sum
    of every bucket, and their ``norm``; null for a text without tokens."""
    made = [T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("norm", T.DoubleType())]
    return _hashed(df, text_col, dim, made, lambda total, norm: [(total, np.isnan(norm)), (norm, np.isnan(norm))])


def hash_embedding_entries(df: DataFrame, text_col: str = "text", id_col: str = "id",
                           dim: int = DIM) -> DataFrame:
    """Sparse form ``(id, dim, value)`` of the normalised hashed vectors."""
    rows = hash_counts(df.select(F.col(id_col).alias("id"), F.col(text_col)), text_col, dim)
    return (rows.select("id", "norm", F.posexplode("counts").alias("dim", "v"))
                .filter(F.col("v") != 0).select("id", "dim", (F.col("v") / F.col("norm")).alias("value")))


def hash_embeddings(df: DataFrame, text_col: str = "text", id_col: str = "id", dim: int = DIM,
                    keep: list[str] | None = None) -> DataFrame:
    """Dense ``(id, *keep, embedding array<float>)``, no shuffle.  A text
    without tokens has a null vector, never zeros."""
    def columns(total, norm):
        some = norm > 0  # signs that cancel out in every bucket leave no direction: null as well
        return [((total / np.where(some, norm, 1.0)[:, None]).astype(np.float32), ~some)]

    rows = df.select(F.col(id_col).alias("id"), *(keep or []), F.col(text_col))
    return _hashed(rows, text_col, dim, [T.StructField("embedding", T.ArrayType(T.FloatType()))], columns)


# -- batch encoders (E1) -----------------------------------------------------------

class HashingEncoder:
    """The hashed bag of words on batches: each distinct token is hashed once
    per batch, the signs are summed by one count."""

    def __init__(self, dim: int = DIM):
        self.dim = dim

    def __call__(self, texts: list[str]) -> np.ndarray:
        words = [_WORD.findall(t) for t in texts]
        place = {w: i for i, w in enumerate(dict.fromkeys(w for row in words for w in row))}
        digests = [hashlib.md5(w.encode("utf-8", "replace")).hexdigest() for w in place]
        bucket = np.array([int(h[:7], 16) % self.dim for h in digests], dtype=np.int64)
        sign = np.array([1.0 if int(h[7], 16) < 8 else -1.0 for h in digests])
        at = np.array([place[w] for row in words for w in row], dtype=np.int64)
        row = np.repeat(np.arange(len(texts)), [len(r) for r in words])
        out = np.bincount(row * self.dim + bucket[at], weights=sign[at], minlength=len(texts) * self.dim).reshape(-1, self.dim)
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        np.divide(out, norms, out=out, where=norms > 0)
        return out.astype(np.float32)


def hashing_encoder(dim: int = DIM) -> HashingEncoder:
    """Factory of the default encoder."""
    return HashingEncoder(dim)


_WORD = re.compile(r"\S+")
FALLBACK = f"hash-{DIM}"
# Names of the sentence encoders that can be asked for, the first by default.
PRETRAINED = ("all-MiniLM-L6-v2", "all-mpnet-base-v2", "paraphrase-MiniLM-L6-v2", "all-MiniLM-L12-v2",
              "paraphrase-multilingual-MiniLM-L12-v2")


def pretrained_encoder(name: str) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """Factory of a sentence encoder; its package and weights must be there."""
    def load():
        from sentence_transformers import SentenceTransformer
        model = SentenceTransformer(name, local_files_only=True)
        return lambda texts: model.encode(texts, batch_size=len(texts), show_progress_bar=False)
    return load


#: Encoders by name: factories, called once per task; others may be added.
ENCODERS: dict[str, Callable[[], Callable[[list[str]], np.ndarray]]] = {
    FALLBACK: hashing_encoder, **{name: pretrained_encoder(name) for name in PRETRAINED}}


def find_encoder(name: str, fallback: str = FALLBACK) -> tuple[str, Callable, str | None]:
    """(name, factory, reason): the encoder of that name if it is known and
    can be made here, else the fallback and why."""
    if name not in ENCODERS:
        return fallback, ENCODERS[fallback], f"unknown encoder {name!r}"
    try:
        ENCODERS[name]()(["probe"])
    except (ImportError, OSError, ValueError) as e:  # not installed, or its weights are not there
        return fallback, ENCODERS[fallback], f"{type(e).__name__}: {e}"
    return name, ENCODERS[name], None


def truncated(c, max_tokens: int):
    """The first ``max_tokens`` tokens of a text."""
    return F.array_join(F.slice(_tokens(c), 1, max_tokens), " ")


def embed_texts(df: DataFrame, text_col: str = "text", id_col: str = "id",
                encoder_factory=hashing_encoder, batch_size: int = BATCH, max_tokens: int | None = None) -> DataFrame:
    """``(id, embedding)`` computed batch-wise in Python workers.

    ``encoder_factory()`` is called once per task (e.g. to load model
    weights) and must return ``encode(list[str]) -> ndarray[n, d]``.  Texts
    are cut to ``max_tokens`` tokens, by Spark, and come in batches of texts
    of similar length, so that an encoder that pads wastes little; results
    keep the order of the rows.  A failing batch fails the task (Spark
    retries it); no zero vectors are substituted.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = df.schema[id_col].dataType.simpleString()
    sel = df.select(F.col(id_col).alias("id"), (text if max_tokens is None else truncated(text, max_tokens)).alias("text"))

    def run(batches):
        encode = encoder_factory()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            order = np.argsort([len(t) for t in texts], kind="stable")
            out = None
            for at in range(0, len(texts), batch_size):
                some = order[at:at + batch_size]
                vectors = np.asarray(encode([texts[i] for i in some]), dtype=np.float32)
                if out is None:
                    out = np.empty((len(texts), vectors.shape[1]), dtype=np.float32)
                out[some] = vectors
            if out is not None:
                n, d = out.shape
                rows = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), rows], names=["id", "embedding"])

    return sel.mapInArrow(run, f"id {kind}, embedding array<float>")


def embed_with(df: DataFrame, model: str = PRETRAINED[0], max_tokens: int = MAX_TOKENS, **options) -> tuple[DataFrame, dict]:
    """The embedding stage: vectors by the named encoder or the fallback, and
    a record of what was used."""
    name, factory, reason = find_encoder(model)
    record = {"model_requested": model, "model_used": name, "fallback_reason": reason, "max_tokens": max_tokens}
    return embed_texts(df, encoder_factory=factory, max_tokens=max_tokens, **options), record


# -- embedding table profile ------------------------------------------------------

def embedding_profile(emb: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Shape check of an embedding table: rows, min/max width, null vectors."""
    v = F.col(vec_col)
    return emb.agg(F.count(F.lit(1)).alias("rows"), F.min(F.size(v)).cast("long").alias("min_dim"),
                   F.max(F.size(v)).cast("long").alias("max_dim"),
                   F.sum(F.when(v.isNull(), 1).otherwise(0)).alias("null_vectors"))


def embedding_metadata(emb: DataFrame, vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per split: samples, dimension, labelled samples."""
    return emb.groupBy("split").agg(
        F.count(F.lit(1)).alias("samples"), F.max(F.size(F.col(vec_col))).cast("long").alias("dim"),
        F.sum(F.when(F.col(label_col).isin(0, 1), 1).otherwise(0)).alias("labelled"))
