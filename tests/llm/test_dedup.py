"""Operators 1, 3, 9 and 10 against plain Python, and their edge cases."""
import hashlib
import random
import sys
from collections import Counter

import numpy as np
import pytest

from revspark.llm import (op1_substring_dedup as op1, op3_exact_dedup as op3, op9_suffix_array as op9,
                          op10_near_dedup as op10)
from tests.llm import brute
from tests.llm.conftest import EDGE


def by_id(rows, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in rows}


def test_substring_dedup(mixed, table_of):
    got = op1.remove_repeats(table_of(mixed)).collect()
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], brute.sha(r["kept_words"].encode())) for r in got}
    assert found == brute.substring_dedup(mixed)
    assert sum(v[1] for v in found.values()) > 500


def test_substring_dedup_short_windows(mixed, table_of):
    some = [d for d in mixed if len(d[1] or "") < 2000]
    got = op1.remove_repeats(table_of(some), length=3, gram=2).collect()
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], brute.sha(r["kept_words"].encode())) for r in got}
    assert found == brute.substring_dedup(some, 3)


def test_substring_dedup_edges(table_of):
    got = op1.remove_repeats(table_of(EDGE)).collect()
    assert len(got) == len(EDGE)
    by = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in got)
    # "same row same row ..." repeats itself: all but the first 21 words start earlier
    assert by[5, 60, 39 + 0] == 2 or by[5, 60, 58] == 2
    assert by[7, 60, 60] == 1 and by[5, 2, 0] == 1 and by[8, 0, 0] == by[9, 0, 0] == 1
    assert op1.remove_repeats(table_of([])).collect() == []


def test_long_texts_in_pieces(mixed, table_of):
    """Pieces of texts and shares of windows change nothing."""
    rows = [*mixed, (5000, " ".join(f"u{i}" for i in range(400)) + " " + "z" * 900), (5001, " " * 3000), (5002, "\n".join(["q"] * 700))]
    got = op1.remove_repeats(table_of(rows), stretch=700, share=300).collect()
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], brute.sha(r["kept_words"].encode())) for r in got}
    assert found == brute.substring_dedup(rows)
    got = op9.remove_repeats(table_of(rows), stretch=700).collect()
    assert by_id(got, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.byte_dedup(rows)


def test_shared_ids_in_any_number(table_of, spark):
    """Texts that share an id are told apart with few of them (broadcast) and with many."""
    from revspark.llm import repeats
    rows = [*EDGE, (20, "unique text here")]
    for few in (repeats.FEW, 1):
        got = Counter(map(tuple, repeats.keyed(table_of(rows), few).select("did", "tid").distinct().collect()))
        of = Counter(d for d, _ in got)
        assert of[5] == 2 and of[7] == of[8] == of[9] == of[20] == 1 and of[(1 << 63) - 1] == 2
    alone = repeats.keyed(table_of([(1, "a"), (2, None)])).select("did", "tid").collect()
    assert sorted(map(tuple, alone)) == [(1, 0), (2, 0)]


def test_factors_cross_boundaries():
    """A window over the end of one copied passage and the start of the next
    is looked up on its own."""
    did, start = np.array([1, 1, 1, 2, 2, 2]), np.array([0, 1, 2, 0, 1, 2])
    window = np.array([11, 12, 13, 12, 99, 11], dtype=np.uint64)
    seed = np.ones(6, dtype=np.uint64)
    source = op1.sources(window, seed, did, start)
    assert source.tolist() == [0, 1, 2, 1, 4, 0]
    doc, at, size = op1.factors(did, start, source, did[source], start[source], 20)
    assert (doc.tolist(), at.tolist(), size.tolist()) == ([2, 2], [0, 2], [20, 20])


def test_byte_dedup(mixed, table_of):
    got = op9.remove_repeats(table_of(mixed)).collect()
    assert by_id(got, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.byte_dedup(mixed)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)


def test_byte_dedup_edges(table_of):
    got = op9.remove_repeats(table_of(EDGE)).collect()
    by = Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in got)
    assert len(got) == len(EDGE) and by[5, 270, 0] == 2 and by[7, 270, 270] == 1  # equal ids are not smaller
    assert by[None, 240, 0] == 2 and by[None, 0, 0] == by[8, 0, 0] == by[9, 0, 0] == 1
    assert op9.remove_repeats(table_of([])).collect() == []


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abc\x00\xff"])
def test_two_stage_suffix_array(alphabet):
    rng = np.random.default_rng(3)
    for n in range(60):
        text = rng.choice(np.frombuffer(alphabet, np.uint8), n)
        raw = text.tobytes()
        assert op9.suffix_array(text, 64).tolist() == sorted(range(n), key=lambda i: raw[i:])


def test_exact_dedup(mixed, table_of):
    for counters in (1024, 2):
        got = op3.decide(table_of(mixed), counters).collect()
        assert by_id(got, "keep_id", "group_size", "text_sha256") == brute.exact_dedup(mixed)
        assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)


def test_exact_dedup_edges(table_of):
    docs = table_of(EDGE)
    by = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in op3.decide(docs).collect())
    assert by == {(None, None, 2, True): 2, (5, 5, 3, True): 2, (7, 5, 3, False): 1, (5, 5, 1, True): 1,
                  (None, 8, 3, False): 1, (8, 8, 3, True): 1, (9, 8, 3, False): 1}
    kept = op3.drop_copies(docs)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        {(None, "null id " * 30): 1, (5, "same row " * 30): 1, (5, "other text"): 1, (8, None): 1})
    assert op3.decide(table_of([])).collect() == []


def test_misra_gries_keeps_the_frequent():
    rng = np.random.default_rng(5)
    stream = [bytes([b]) for b in rng.integers(0, 200, 3000)] + [b"hot"] * 700
    counts = {}
    for i in range(0, len(stream), 97):
        counts = op3.merged(counts, Counter(stream[i: i + 97]), 10)
    assert len(counts) <= 10 and 700 - len(stream) // 11 <= counts[b"hot"] <= 700


@pytest.mark.parametrize("size", [2, 5])
def test_near_dedup(mixed, table_of, size):
    got = op10.judge(table_of(mixed), size=size).collect()
    assert by_id(got, "n_shingles", "component_id") == brute.near_dedup(mixed, size)


@pytest.mark.parametrize("few,chunk", [(2, 3), (2, 1000)])
def test_near_dedup_in_blocks(mixed, table_of, monkeypatch, few, chunk):
    """Large buckets are compared in blocks of chunks, with the same result."""
    monkeypatch.setattr(op10, "FEW", few)
    monkeypatch.setattr(op10, "CHUNK", chunk)
    some = [d for d in mixed if len(d[1] or "") < 2000]
    got = op10.judge(table_of(some), size=2, bands=64, rows=2).collect()
    assert by_id(got, "n_shingles", "component_id") == brute.near_dedup(some, 2)


def test_near_dedup_many_unlinked(table_of):
    """A bucket whose members are linked only along a chain."""
    rows, text = [], [f"a{i}" for i in range(60)]
    for i in range(40):
        text = text[:]
        text[(7 * i) % 60] = f"b{i}"
        rows.append((100 - i, " ".join(text)))
    got = op10.judge(table_of(rows), size=1).collect()
    assert by_id(got, "n_shingles", "component_id") == brute.near_dedup(rows, 1)


def test_near_dedup_edges(table_of):
    docs = table_of(EDGE)
    got = op10.judge(docs).collect()
    assert len(got) >= len(EDGE)
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(None, None), (5, 5), (7, 5), (8, 8), (9, 9)}
    kept = op10.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == {None: 3, 5: 1, 8: 1, 9: 1}
    assert op10.judge(table_of([])).collect() == []


def test_sketch_agreement_is_the_similarity():
    rng = np.random.default_rng(1)
    for n, common in ((6, 4), (40, 30), (3000, 2400)):
        pool = rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64)
        value = np.concatenate([np.sort(pool[:n]), np.sort(pool[n - common:])])
        agree = []
        for salt in range(20):
            s = op10.sketches(value ^ np.uint64(salt * 7919), np.array([0, n, 2 * n]), 128)
            assert (s != np.uint64(2**64 - 1)).all()  # every coordinate is filled
            agree.append((s[0] == s[1]).mean())
        assert abs(np.mean(agree) - common / (2 * n - common)) < 0.05


@pytest.mark.parametrize("run,least,rounds", [(1 << 18, 1 << 15, 1), (50, 100, 20)])
def test_components_take_few_rounds(spark, monkeypatch, run, least, rounds):
    """Links of one task are joined without a round of shuffles; links of many tasks come out the same."""
    module = sys.modules["revspark.llm.components"]
    monkeypatch.setattr(module, "RUN", run)
    monkeypatch.setattr(module, "LEAST", least)
    written, keep = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: written.append(name) or keep(df, name))
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 400)] + [(1000, 2000 + i) for i in range(300)] + [(5, 5), (None, 5)]
    links += [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(250)] + [(7, 6)] * 9
    rng.shuffle(links)
    lowest = {}
    for a, b in links:
        if a is not None and a != b:
            lowest.setdefault(a, a), lowest.setdefault(b, b)
    while any(lowest[a] != lowest[b] for a, b in links if a in lowest and a != b):
        for a, b in links:
            if a in lowest and a != b:
                lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    got = op10.components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()
    assert {r["id"]: r["component"] for r in got} == {i: x for i, x in lowest.items() if i != x} and len(got) == len({r["id"] for r in got})
    assert len(written) <= rounds


def test_keep_one_shuffles_few_texts(spark, monkeypatch):
    """Rows whose document stays are not joined with the verdict; the others are told exactly, whatever the number of marks."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(30)) for _ in range(300)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(1000 + i, texts[i], "y") for i in range(40)]
    rows += [(7, "quite another text of this document", "z"), (1003, texts[3], "again"), (None, texts[0], "n"), (None, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(5)
    want = {i for i in range(300)}
    for marks in (op10.MARKS, 64):
        monkeypatch.setattr(op10, "MARKS", marks)
        kept = op10.keep_one(docs)
        got = kept.collect()
        assert Counter(r["doc_id"] for r in got if r["doc_id"] is not None) == Counter(want)
        assert sum(r["doc_id"] is None for r in got) == 2 and kept.columns == docs.columns
        touched = op10.apart(docs, spark.createDataFrame([(1003,), (7,)], "id long"))
        assert touched[0].count() + touched[1].count() == len(rows)
        assert {7, 1003} <= {r["doc_id"] for r in touched[1].collect()}
    monkeypatch.undo()
    touched = op10.apart(docs, spark.createDataFrame([(1003,), (7,)], "id long"))
    assert touched[1].count() < 10
