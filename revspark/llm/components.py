"""Connected components of a link table, by alternating large and small stars.

Before each round the links that a task reads are replaced by a spanning
forest of stars, in runs of bounded size, so that most components are settled
where their links lie and fewer rounds are left (none if the links are not
enough for two tasks).  Every other step is a
grouped minimum and a join, so a vertex with very many links sends one partial
minimum per task and its rows of the join can be split by adaptive execution.
Each round is written to the shared folder.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Links that a task joins at once, and links below which a task gets no share of its own.
RUN, LEAST = 1 << 18, 1 << 15


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest connected id) of every id that is not the smallest itself."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a):]
    label = np.arange(len(ids))
    while (label[x] != label[y]).any():
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while (label[label] != label).any():
            label = label[label]
    below = np.flatnonzero(label != np.arange(len(ids)))
    return ids[below], ids[label[below]]


def contracted(links: DataFrame) -> DataFrame:
    """(a, b), a larger than b, with the components of ``links``: stars made of
    runs of links in their tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def stars() -> pa.RecordBatch:
            both = pa.Table.from_batches(held)
            a, b = forest(*(both[c].to_numpy() for c in ("a", "b")))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= RUN:
                yield stars()
                held, rows = [], 0
        if rows:
            yield stars()

    return links.mapInArrow(run, "a long, b long")


def large_star(links: DataFrame) -> DataFrame:
    """Connect all larger neighbours of each vertex to its smallest one."""
    both = links.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(links: DataFrame) -> DataFrame:
    """Connect all smaller neighbours of each vertex, and itself, to the
    smallest; links go from larger a to smaller b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return links.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                         F.col("m").alias("b")).distinct()


def settled(links: DataFrame) -> bool:
    """Are all links stars: one for each id, to an id that has none?"""
    one, none = F.lit(1), F.lit(0)
    ends = links.select(F.inline(F.array(F.struct(F.col("a").alias("id"), one.alias("n"), none.alias("below")),
                                         F.struct(F.col("b").alias("id"), none.alias("n"), one.alias("below")))))
    ends = ends.groupBy("id").agg(F.sum("n").alias("n"), F.max("below").alias("below"))
    return ends.filter("n > 1 OR n = 1 AND below = 1").agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b long) that is not the
    smallest of its component."""
    links = links.filter("a <> b").select("a", "b")
    while True:
        tasks = max(1, math.ceil(links.count() / LEAST))  # small tables are not dealt to many tasks
        links = stored(contracted(links.coalesce(tasks)), "links")
        if tasks == 1 or settled(links):
            return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
        links = stored(small_star(large_star(links)), "links")
