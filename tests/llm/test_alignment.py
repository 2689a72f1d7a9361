"""Operator 12 against whole texts encoded by the libraries."""
import hashlib
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from revspark.llm import op12_alignment as op12
from revspark.llm.op8_bpe import byte_alphabet
from tests.llm.conftest import EDGE

ODD = ["a  b", " lead", "trail ", "\n\nx\n y", "tab\tand \t blank", "é␣你好 世界 🙂🙂 café", "é combining ́", "nb sp   x",
       "<|endoftext|> <s> </s> <0x41> it's we'll", "word▁mark here", "▁", "a\x00b \x00 c", "　 wide   line", "\r\n x;\r\n", "x" * 300,
       "ﬁne ½ ①", "مرحبا بالعالم", "\U0001f468‍\U0001f469‍\U0001f467 family", " ", "  ", "a", "ab cd " * 800, "line\nnext\n\nthird\n\n\nfourth \n fifth\n", "end \n", "\nstart", "x;\r\ny\t\nz\n\tw", "a b ", "\n", "a\n", "﻿bom", "𝔘𝔫𝔦 code"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens(tools, text):
    """Ids and byte ends of both tokenizers over the whole text."""
    a, b = tools
    table, raw = byte_alphabet(), (" " + text).encode()
    found = a.encode(" " + text, add_special_tokens=False)
    in_a = [bytes(table[c] for c in t) for t in found.tokens]
    ids_b = b.encode(text)
    in_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(in_a) != raw or b"".join(in_b) != raw:
        return None
    ends = []
    for part in (in_a, in_b):
        at, out = 0, []
        for t in part:
            at += len(t)
            out.append(at)
        ends.append(out)
    return found.ids, ends[0], ids_b, ends[1]


def brute(tools, rows):
    docs, counts = [], Counter()
    for doc_id, text in rows:
        found = tokens(tools, text) if text else None
        if not found:
            docs.append((doc_id, 0, 0, "", []))
            continue
        ids_a, ends_a, ids_b, ends_b = found
        cuts, links, told, before = sorted(set(ends_a) & set(ends_b)), [], [], 0
        at_a, at_b = dict(zip(ends_a, ids_a)), dict(zip(ends_b, ids_b))
        for c in cuts:
            told.append(",".join(str(i) for i, e in zip(ids_a, ends_a) if before < e <= c) + "|"
                        + ",".join(str(i) for i, e in zip(ids_b, ends_b) if before < e <= c))
            links.append((at_a[c], at_b[c]))
            before = c
        counts.update(links)
        docs.append((doc_id, len(ids_a), len(ids_b), hashlib.sha256(";".join(told).encode()).hexdigest(), links))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return sorted([(d, n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links),
                    sum(counts[x] for x in links), told) for d, n_a, n_b, told, links in docs], key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                               "groups_sha256").collect()], key=str)


def test_align_equals_whole_texts(spark, tools, mixed, table_of):
    rows = [(i, t if t is None or len(t) < 20_000 else t[:6000]) for i, t in mixed] + EDGE
    rows += [(1000 + i, t) for i, t in enumerate(ODD + [t[::-1] for t in ODD])]
    want = brute(tools, rows)
    assert got(op12.align(table_of(rows))) == want
    assert got(op12.align(table_of(rows[::-1]), broadcast_pairs=0)) == want  # joined by shuffle


def test_long_text_and_empty_table(spark, tools, table_of, mixed):
    long = max((t for _, t in mixed if t), key=len)
    out = got(op12.align(table_of([(1, long), (2, "y" * 200_000), (3, None)])))
    assert [(r[0], r[1] > 0) for r in out] == [(1, True), (2, True), (3, False)]
    found = tokens(tools, long)
    assert out[0][1:3] == (len(found[0]), len(found[2]))
    assert op12.align(table_of(rows=[(1, "x")]).limit(0)).collect() == []


def test_cache_may_forget(tools, monkeypatch):
    made = op12.Aligner(*op12.read_vocabularies())
    first = made.rows(ODD)
    monkeypatch.setattr(op12, "CACHE", 3)
    again = made.rows(ODD)
    assert made.cuts and [list(map(list, x)) for x in first] == [list(map(list, x)) for x in again]
    made.cuts = False  # whole texts as fragments
    assert [list(map(list, x)) for x in made.rows(ODD)] == [list(map(list, x)) for x in first]
