"""Operator 13 and the global order it rests on."""
import math
import re
from collections import defaultdict
from fractions import Fraction
from hashlib import md5

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revspark.llm import op13_mixing as op13
from revspark.llm.ranks import numbered

SCHEMA = "doc_id long, text string, source string, size string, target string, key string, position string"


def reshared(sizes: dict) -> dict:
    """Targets as the contract words them: shares, then the excess over the
    cap goes to the others by weight until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: Fraction(op13.SHARES[i % 3]) for i, s in enumerate(order)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        open_ = [s for s in order if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        if not open_:
            return target
        for s in open_:
            target[s] = weight[s] * left / sum(weight[x] for x in open_)
        above = {s for s in open_ if target[s] >= 3 * sizes[s]}
        for s in above:
            target[s] = Fraction(3 * sizes[s])
        if not above:
            return target
        full |= above


def brute(rows):
    docs = []
    for doc_id, text, source in rows:
        t = text or ""
        weight = max(0.05, (len(re.sub(r"[!-@\[-`{-~]", "", t)) / len(t)) ** 2) if t else 0.05
        told = md5(t.encode()).hexdigest()
        u = (int(md5(f"13|{'-' if doc_id is None else doc_id}|{told}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        docs.append((doc_id, source, len(re.findall(r"[^\x20\x09-\x0D]+", t)), -math.log(u) / weight, told[:8]))
    sizes = defaultdict(int)
    for d in docs:
        sizes[d[1]] += d[2]
    target = reshared(dict(sizes))
    out, used = [], defaultdict(int)
    for doc_id, source, size, key, _ in sorted(docs, key=lambda d: (d[3], d[0] is not None, d[0] or 0, d[4])):
        budget = int(target[source])
        epochs = budget // sizes[source] if sizes[source] else 0
        part = max(0, min(size, budget - epochs * sizes[source] - used[source]))
        used[source] += size
        out.append((doc_id, size, source, sizes[source], round(float(target[source]), 6), epochs * size + part))
    return sorted(out, key=str)


def got(df):
    return sorted([(r["doc_id"], r["size"], r["source"], r["source_size"], round(r["target"], 6), r["taken"])
                   for r in df.collect()], key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "?", "?", "?", "?") for i, t, s in rows], SCHEMA).repartition(3)


def test_mix_equals_plain_python(spark, mixed):
    names = ["web", "web", "web", None, "books", "Zeitung", "é"]
    rows = [(i, t, names[n % 7]) for n, (i, t) in enumerate(mixed)]
    rows += [(None, "null id " * 30, "web"), (None, "null id " * 30, "web"), (5, "same row " * 30, "web"),
             (5, "same row " * 30, "web"), (5, "other", "web"), (None, None, "nothing"), (9, "", "empty")]
    result = op13.mix(frame(spark, rows))
    assert got(result) == brute(rows) == got(op13.mix(frame(spark, rows[::-1]).coalesce(1)))
    by_source = defaultdict(lambda: [0, 0.0])
    for r in result.collect():
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_source[r["source"]][0] += r["taken"]
        by_source[r["source"]][1] = r["target"]
    assert all(t - 1 < n <= t + 1e-6 for n, t in by_source.values())


def test_mixture_rows_add_up(spark, mixed):
    rows = [(i, t, "ab"[n % 9 == 0]) for n, (i, t) in enumerate(mixed)]
    taken = sum(r["taken"] for r in op13.mix(frame(spark, rows)).collect())
    parts = op13.mixture(frame(spark, rows)).collect()
    assert sum(r["words"] for r in parts) == taken and all(0 < r["words"] <= r["size"] for r in parts)
    assert max(r["epoch"] for r in parts) <= 3


def test_weights_decide_the_order(spark):
    """Documents of weight 4 against 1 come first four times in five."""
    from pyspark.sql import functions as F
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                    F.lit("s").alias("source"), (F.col("id") % 2 * 3 + 1).alias("w"))
    first = op13.mix(rows, weight=F.col("w")).select("doc_id", "key").orderBy("key").limit(500).collect()
    share = sum(r["doc_id"] % 2 for r in first) / 500
    assert 0.74 < share < 0.86


def test_edges(spark):
    assert op13.mix(frame(spark, []).limit(0)).collect() == []
    assert got(op13.mix(frame(spark, [(1, None, "a"), (2, " ", None)]))) == brute([(1, None, "a"), (2, " ", None)])
    one = [(7, "x y z", "only")]
    assert got(op13.mix(frame(spark, one))) == brute(one) == [(7, 3, "only", 3, 3.0, 3)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=9))
def test_targets(spark, sizes):
    known = {(None if i == 3 else f"s{i}"): n for i, n in enumerate(sizes)}
    df = spark.createDataFrame([*known.items()], "source string, source_size long")
    want = reshared(known)
    for r in op13.targets(df).collect():
        assert r["target"] == pytest.approx(float(want[r["source"]]), abs=1e-9)
        assert r["budget"] == int(want[r["source"]])


def test_numbered(spark):
    """Positions and sums over many partitions, with one group that holds most rows and rows alike in all keys."""
    rows = [("hot" if i % 5 else None, i // 40, i % 7) for i in range(3000)] + [("x", 1, 4)]
    df = spark.createDataFrame(rows, "g string, o int, v long").repartition(6)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = numbered(df, "g", ["o", "v"], "v").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    for g in ("hot", None, "x"):
        mine = sorted((r for r in out if r["g"] == g), key=lambda r: r["position"])
        assert [r["position"] for r in mine] == list(range(len(mine)))
        assert [(r["o"], r["v"]) for r in mine] == sorted((r["o"], r["v"]) for r in mine)
        total = 0
        for r in mine:
            assert r["running"] == total
            total += r["v"]
