"""Quality classifier by hierarchical empirical Bayes.

A document's evidence is the sum, over features of its whole text, of
log P(bin | good) - log P(bin | bad), each feature cut into bins; the bin
probabilities are counted over all labelled training rows.  Its site's
evidence is a posterior rate: the host's share of good rows, shrunk towards
the global share, and the share of the path below it, shrunk towards the
host's.  The weight of the prior at each level is estimated from the spread
between the sites (method of moments), so sparse sites fall back on the level
above and a level that does not differ beyond chance has no say.

Everything learned comes from grouped aggregates: per feature and bin (at
most len(FEATURES) * BINS rows, collected), per host and per path (joined
back by key; a hot host is one row on one side and can be split on the
other).  Training rows are the labelled ones with crc32(doc_id as text)
mod 4 other than 2; the rest measure the result.

Hosts and paths are columns of the input: here the source of a document,
and its language below it.

Defined results: a null or empty text has the features of an empty text.
Null hosts and paths are sites of their own.  Without training rows of both
classes every document has probability 0.5 and is kept.  Of several labels
of a document all count; labels without document or null count nowhere.
Rows that repeat are scored alike.  An empty table gives an empty result;
other columns are ignored by ``score`` and unchanged in ``keep_good``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.sources.tables import table

from . import rolling as R
from .common import documents, in_stretches, stored, text_bytes

FEATURES = ("length", "word_length", "upper", "digit", "stop", "mark", "symbol", "distinct", "line")
BINS, CUT = 16, 0.5
_IS = np.zeros((256, 5), dtype=np.int64)
_IS[65:91, 0] = 1
_IS[48:58, 1] = 1
_IS[[ord(c) for c in ".,;:?"], 2] = 1
_IS[ord("!"), 3] = 1
_IS[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~"], 4] = 1


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A bin from 0 to BINS - 1 for each text and feature."""
    n = len(off) - 1
    start, end = R.words_of_texts(data, off)
    doc = np.searchsorted(off, start, side="right") - 1
    words = np.bincount(doc, minlength=n)
    size = np.diff(off)
    inner = np.bincount(doc, weights=end - start, minlength=n)
    sums = np.concatenate([np.zeros((1, 5), dtype=np.int64), np.cumsum(_IS[data], axis=0)])
    kinds = sums[off[1:]] - sums[off[:-1]]
    hashes = R.word_hashes(data, start, end)
    pair = np.unique(R.mix(hashes) ^ R.mix(doc.astype(np.uint64) + np.uint64(1)), return_index=True)[1]
    distinct = np.bincount(doc[pair], minlength=n)
    feeds = np.concatenate([[0], np.cumsum(data == 0x0A)])
    lines = feeds[off[1:]] - feeds[off[:-1]] + 1
    least = np.maximum(words, 1)
    share = lambda x: np.sqrt(np.minimum(1.0, x / np.maximum(inner, 1))) * BINS
    columns = [np.log2(size + 1), inner / least, share(kinds[:, 0]), share(kinds[:, 1]), share(kinds[:, 2]),
               share(kinds[:, 3]), share(kinds[:, 4]), distinct / least * BINS, np.log2(words / lines + 1)]
    return np.clip(np.stack(columns, axis=1), 0, BINS - 1).astype(np.int32)


def feature_table(docs: DataFrame, host: str, path: str) -> DataFrame:
    """doc_id, host, path, bins array<int> of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_stretches(batches):
            bins = features(*text_bytes(batch.column(3)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bins) + 1, dtype=np.int32) * len(FEATURES)),
                                             pa.array(bins.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], lists],
                                             names=["doc_id", "host", "path", "bins"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    site = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    return docs.select("doc_id", site(host, "host"), site(path, "path"), "text").mapInArrow(
        run, f"doc_id {kind}, host string, path string, bins array<int>")


def in_training():
    return ~F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Bin probabilities; half of each neighbouring bin counts as well."""
    around = np.pad(counts, ((0, 0), (1, 1)))
    counts = counts + (around[:, 2:] + around[:, :-2]) / 2 + 0.1
    return counts / counts.sum(axis=1, keepdims=True)


def prior_weight(groups: DataFrame) -> float:
    """How many rows the level above is worth, from (n, good, above): the
    spread of the groups' shares beyond what chance gives them."""
    share = F.col("good") / F.col("n")
    above = F.col("above").cast("double")
    chance = above * (1 - above)
    spread = F.col("n") * F.pow(share - above, 2)
    r = groups.agg(F.sum(spread).alias("spread"), F.sum(chance).alias("chance"), F.sum("n").alias("n"),
                   F.sum(F.col("n") * chance).alias("within")).first()
    if not r["n"] or not r["within"]:
        return 0.0
    between = (r["spread"] - r["chance"]) / r["n"]  # variance of the true shares
    within = r["within"] / r["n"]
    return within / between - 1 if between > within * 1e-6 else 1e6


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", host: str = "source", path: str = "lang") -> DataFrame:
    """doc_id, evidence (document), host_rate, path_rate, p_good, kept."""
    rows = stored(feature_table(docs, host, path), "op5-features")
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).filter("y IN (0, 1)")
    train = stored(rows.filter(in_training()).distinct().join(known, "doc_id"), "op5-train")
    total = train.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")).first()
    n, good = total["n"], total["good"] or 0
    if not 0 < good < n:
        return rows.select("doc_id", *[F.lit(v).alias(c) for c, v in (
            ("evidence", 0.0), ("host_rate", 0.5), ("path_rate", 0.5), ("p_good", 0.5), ("kept", True))])
    counts = train.select("y", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")).collect()
    seen = np.zeros((2, len(FEATURES), BINS))
    for r in counts:
        seen[1, r["feature"], r["bin"]], seen[0, r["feature"], r["bin"]] = r["good"], r["n"] - r["good"]
    weight = np.log(smoothed(seen[1])) - np.log(smoothed(seen[0]))
    table_of = F.array(*[F.array(*[F.lit(w) for w in row]) for row in weight.tolist()])
    evidence = F.aggregate(F.transform("bins", lambda b, i: F.element_at(F.element_at(table_of, i + 1), b + 1)),
                           F.lit(0.0), lambda a, x: a + x)
    rate = good / n
    by_host = train.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")).withColumn("above", F.lit(rate))
    m = prior_weight(by_host)
    by_host = stored(by_host.select("host", ((F.col("good") + m * F.col("above") + rate) / (F.col("n") + m + 1)).alias("host_rate")),
                     "op5-hosts")
    by_path = train.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")).join(
        by_host, "host").withColumnRenamed("host_rate", "above")
    m = prior_weight(by_path)
    by_path = by_path.select("host", "path", ((F.col("good") + (m + 1) * F.col("above")) / (F.col("n") + m + 1)).alias("path_rate"))
    out = rows.withColumn("evidence", evidence).join(by_host, "host", "left").join(by_path, ["host", "path"], "left")
    host_rate = F.coalesce("host_rate", F.lit(rate))
    path_rate = F.coalesce("path_rate", host_rate)
    logit = F.col("evidence") + F.log(path_rate / (1 - path_rate))
    p = 1 / (1 + F.exp(-logit))
    return out.select("doc_id", "evidence", host_rate.alias("host_rate"), path_rate.alias("path_rate"),
                      p.alias("p_good"), (p >= CUT).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` judged good, with all their columns."""
    bad = score(docs, labels, **settings).filter("NOT kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(stored(bad, "op5-bad"), F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
