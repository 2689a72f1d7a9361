"""Operator 11 against a plain tree in memory."""
import hashlib
import zlib

import pytest

from revspark.llm import op11_merkle as op11

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, position string, hash string, tree string"


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels_over(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        at = i - i % 8
        out.append((i % 8, [x for k, x in enumerate(nodes[at:at + 8], at) if k != i]))
        i //= 8
    return out


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r, r[1])))
        built[lang] = levels_over([leaf(r, r[1]) for r in trees[lang]])
    high = levels_over([built[lang][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for i, r in enumerate(trees[lang]):
            path = siblings(built[lang], i) + siblings(high, k)
            odd = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if odd and r[1] is not None else r[1]
            node = leaf(r, text)
            for place, others in path:
                node = H(others[:place] + [node] + others[place:])
            out.append((r[0], built[lang][0][i], built[lang][-1][0], high[-1][0], H(s for _, x in path for s in x), node,
                        node == high[-1][0]))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "?", "?", "?") for r in rows], SCHEMA).repartition(3)


def audited(spark, rows):
    from pyspark.sql import functions as F
    changed = op11.leaf_of(*[F.translate("text", op11.UPPER, op11.LOWER) if f == "text" else F.col(f) for f in op11.FIELDS])
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    made = op11.manifest(frame(spark, rows), claimed=F.when(odd, changed))
    return made, sorted([tuple(r) for r in op11.audit(made).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()], key=str)


def test_against_a_plain_tree(spark):
    """Trees of 0 to 4 levels, some that end beside others, long texts, nulls anywhere, rows that repeat."""
    langs = ["en"] * 700 + ["de"] * 65 + ["fr"] * 64 + ["é"] * 9 + ["a"] * 8 + ["b"] + [None] * 3 + ["", "A" * 40]
    langs += [f"x{i}" for i in range(12)]
    rows = [(i * 7 % 5003, f"Text {i} Über" * (1 + i % 3), lang, "s" if i % 4 else None, i if i % 5 else None)
            for i, lang in enumerate(langs)]
    rows += [(3, "SAME", "en", "s", 4), (3, "SAME", "en", "s", 4), (3, "Other", "en", "s", 4), (None, "No id", "en", "s", 1),
             (None, None, None, None, None), (8, "", "en", "", 0), (9, None, "de", None, None), (10, "L" * 300_000, "en", "s", 1)]
    made, got = audited(spark, rows)
    assert got == brute(rows)
    assert made.root == got[0][3] and len(made.levels) == 3  # leaves, and every second level
    assert made.subroots.count() == len({r[2] for r in rows})
    for r in op11.proofs(made).collect():
        node = r["leaf"].encode()
        assert op11.fold(node, op11.unplain([x.asDict() for x in r["path"]])).decode() == made.root


@pytest.mark.parametrize("rows", [[(1, "One", "en", "s", 3)], [(None, None, None, None, None)],
                                  [(1, "One", "en", "s", 3), (2, "Two", None, "s", 3)]])
def test_small_trees(spark, rows):
    assert audited(spark, rows)[1] == brute(rows)


def test_empty_table(spark):
    made = op11.manifest(frame(spark, []))
    assert made.root is None and op11.audit(made).collect() == [] and op11.proofs(made).collect() == []
