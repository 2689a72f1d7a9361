"""Operators 2, 4, 5, 6, 7 and 8."""
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revspark.llm import (op2_html_text as op2, op4_token_counts as op4, op5_quality as op5, op6_language_id as op6,
                          op7_decontaminate as op7, op8_bpe as op8)
from revspark.llm.common import text_bytes
from tests.conftest import SF01
from tests.llm import brute
from tests.llm.conftest import EDGE

PAGE = """<html><body class="has-sidebar"><header><h2>Site</h2></header><div id="cookie-notice">We use cookies</div><main>
<article class="post"><header><h1>T &amp; x</h1></header><p>One<p>Two <i>it</i>alic<br>three&nbsp;  four<div class="ad">buy</div>
<ul><li>a<li>b</ul><table><tr><td>c<td>d</table><section id="comments"><article class="comment"><p>nice</p></article></section>
<form><p>f</p></form></article></main><aside>side</aside><footer>foot</footer><script>if(a<b){"</p>"}</script></body></html>"""


def test_main_text():
    assert op2.main_text(PAGE) == "T & x\nOne\nTwo italic three four\na\nb\nc d"
    assert op2.main_text("<body><div class='content'><p>Just</p> text</div><div class=menu>m</div><footer>f</footer>") == "Just\ntext"
    assert [op2.main_text(x) for x in (None, "", "plain &lt; text", "<p>open <b>tag")] == ["", "", "plain < text", "open tag"]


def test_several_main_elements():
    pair = "<div class='has-sidebar'><main><p>One</p></main></div><p>between</p><div role='main'><p>Two</p>{}</div><footer>f</footer>"
    assert op2.main_text(pair.format("")) == op2.main_text(pair.format("<main hidden>no</main>")) == "One\nTwo"
    assert op2.main_text(pair.format("<main>Three</main>")) == "One\nTwo\nThree"
    assert op2.main_text("<main hidden>a</main><main>b</main>") == "b"
    assert op2.main_text("<main hidden>a</main>") == "a"


def test_site_template(spark):
    """Unnamed subtrees on most pages of a host go; a passage that a few
    articles share, and other hosts' pages with the same subtree, stay."""
    bar = "<div class='x1'><p>Home of things</p></div>"
    rows = [(i, f"http://A.example/{i}", f"<body>{bar}<div><p>Text {i}</p>{'<p>shared</p>' if i < 3 else ''}</div></body>")
            for i in range(12)]
    rows += [(50, "http://b.example/", f"<body>{bar}<p>Own</p></body>"), (51, None, None), (None, "::", "<p>x</p>"), (51, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", pa_null())
    want = {i: f"Text {i}" + ("\nshared" if i < 3 else "") for i in range(12)} | {50: "Home of things\nOwn", 51: "", None: "x"}
    for limit in (op2.BROADCAST_ROWS, 0):  # broadcast, and join by host
        got = op2.extract(pages, broadcast_rows=limit).collect()
        assert len(got) == len(rows) and {r["page_id"]: r["text"] for r in got} == want
        assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert op2.extract(pages.limit(0)).collect() == []


def test_copied_articles_are_no_template(spark):
    """An article under six of eight urls, with other counters, menus and
    footers each time, is one page of its host."""
    def page(i, text, tag):
        return (f"<body><!-- ad {i} --><nav>menu {i}</nav><div class='x1'><p>Bar</p></div><{tag}><h1>T {text}</h1><p>Text {text}</p>"
                f"</{tag}><footer>seen {i}</footer><script>track({i})</script></body>")

    def bare(text):
        return f"T {text}\nText {text}"

    for tag in ("article", "main", "div"):
        texts = ["copied"] * 6 + ["b", "c"]
        rows = [(i, f"http://c.example/{i}", page(i, t, tag)) for i, t in enumerate(texts)]
        got = op2.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
        before = "Bar\n" if tag == "div" else ""  # three pages are too few for a template
        assert {r["page_id"]: r["text"] for r in got} == {i: before + bare(t) for i, t in enumerate(texts)}
    texts = ["copied"] * 12 + list("bcdefg")
    rows = [(i, f"http://c.example/{i}", page(i, t, "div")) for i, t in enumerate(texts)]
    got = op2.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: bare(t) for i, t in enumerate(texts)}


def pa_null():
    from pyspark.sql import functions as F
    return F.lit("clash")


def test_pages_of_the_fixture(spark):
    import re
    from html import unescape

    def plain(html):
        body = re.search(r"<article>(.*)</article>", html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        return "\n".join(x for x in parts if x)

    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    assert {r["page_id"]: r["text"] for r in op2.op2_html_text(spark, SF01).collect()} == {i: plain(h) for i, h in html.items()}


@pytest.fixture(scope="module")
def pieces():
    return op4.Pieces(op4.read_ranks())


def test_token_counts(mixed, table_of, pieces):
    got = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in op4.count_tokens(table_of(mixed)).collect()}
    seen = {}

    def tokens(word):
        if word not in seen:
            seen[word] = pieces.count_one(b" " + word.encode())[0]
        return seen[word]

    words = {i: brute.WORD.findall(t or "") for i, t in mixed}
    assert got == {i: (len(w), sum(map(tokens, w))) for i, w in words.items()}
    assert len(op4.count_tokens(table_of(EDGE)).collect()) == len(EDGE)
    assert op4.count_tokens(table_of([])).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=8))
def test_trie_equals_single_words(texts):
    small = op4.Pieces({b" a": 3, b"ab": 0, b"b ": 9, b"abc": 5, "é".encode(): 2, b" ": 1, b"c": 4})
    n, tokens = op4.count_stretch(*text_bytes(pa.array(texts, pa.string())), small)
    words = [brute.WORD.findall(t) for t in texts]
    assert n.tolist() == [len(w) for w in words]
    assert tokens.tolist() == [sum(small.count_one(b" " + x.encode())[0] for x in w) for w in words]


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    y = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = op5.op5_quality(spark, SF01).collect()
    assert len(got) == docs.count()
    held = [(r["kept"], y[r["doc_id"]]) for r in got if r["doc_id"] in y and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([k == bool(v) for k, v in held]) > 0.93
    assert np.mean([k for k, v in held if v == 1]) > 0.95


def test_quality_shrinks_sparse_sites(spark):
    rows = [("big", 900, 1000), ("small", 0, 1), ("other", 500, 1000)]
    groups = spark.createDataFrame(rows, "host string, good long, n long").selectExpr("*", "0.7 AS above")
    m = op5.prior_weight(groups)
    assert 1 < m < 50  # the large sites differ far beyond chance
    same = spark.createDataFrame([("a", 70, 100), ("b", 140, 200)], "host string, good long, n long").selectExpr("*", "0.7 AS above")
    assert op5.prior_weight(same) == 1e6  # no spread: the level above decides


def test_quality_edges(spark, table_of):
    docs, labels = table_of(EDGE), spark.createDataFrame([(5, 1), (None, 0), (8, None), (99, 0)], "doc_id long, quality int")
    got = op5.score(docs, labels).collect()
    assert len(got) == len(EDGE) and all(r["kept"] and r["p_good"] == 0.5 for r in got)
    assert op5.keep_good(docs, labels).count() == len(EDGE)
    assert op5.score(table_of([]), labels).collect() == []


def test_language_held_out(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = op6.op6_language_id(spark, SF01).collect()
    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    assert np.mean([r["rejected"] for r in got]) < 0.02
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_the_whole_text(spark):
    """What a long text begins with does not decide for the rest of it."""
    rng = np.random.default_rng(3)
    letters = {"aa": "abcdefgh", "bb": "klmnopqr", "": "stuvwxyz"}
    words = {k: ["".join(rng.choice(list(v), rng.integers(3, 9))) for _ in range(400)] for k, v in letters.items()}
    text = lambda k, size: " ".join(rng.choice(words[k], size // 5))[:size]
    docs = spark.createDataFrame([(i, text(k, 2000), k) for i in range(60) for k in ("aa", "bb")], "doc_id long, text string, lang string")
    mixed = [(1, text("", 800_000) + text("aa", 300_000)), (2, text("bb", 400_000) + text("", 300_000) + text("aa", 2_000_000)),
             (3, text("aa", 300_000))]
    got = {r["doc_id"]: r for r in op6.predict(spark.createDataFrame(mixed, "doc_id long, text string"), op6.fit(docs)).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["aa"] * 3
    assert got[1]["margin"] > got[3]["margin"] / 2


def test_unlearned_languages_are_rejected(spark):
    """Noise and most longer texts of a language without a dictionary go; no
    held-out row that is told right goes beyond those that tie."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rng = np.random.default_rng(5)
    noise = [(i, "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), n))) for i, n in enumerate([20_000, 50_000, 300_000])]
    got = op6.predict(spark.createDataFrame(noise, "doc_id long, text string"), op6.fit(docs)).collect()
    assert all(r["rejected"] and r["margin"] >= 0 for r in got) and any(r["margin"] for r in got)
    for lang in ("fr", "de"):
        got = op6.predict(docs.filter(f"lang = '{lang}' AND length(text) > 1000"), op6.fit(docs.filter(f"lang <> '{lang}'"))).collect()
        assert np.mean([r["rejected"] for r in got]) > 2 * np.mean([r["margin"] < 1 for r in got]) + 0.2
    right = op6.predict(docs.filter(op6.held_out()), op6.fit(docs)).filter("lang = lang_pred AND margin > 0").collect()
    assert not any(r["rejected"] for r in right)


def test_every_language_is_learned(spark):
    """Also beyond those that are handled at once, the rarest ones too."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(op6.AT_ONCE + 6):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(30)]
        rows += [(len(rows) + i, " ".join(rng.choice(words, 30)), f"l{k:02}") for i in range(12 if k < op6.AT_ONCE else 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = op6.predict(docs, op6.fit(docs)).collect()
    assert len(got) == len(rows) and all(r["lang_pred"] == r["lang"] and not r["rejected"] for r in got)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("aé漢🙂"), max_size=40), st.integers(4, 9))
def test_pieces_are_whole_characters(text, size):
    parts = op6.pieces(text.encode(), size)
    assert "".join(x.decode() for x in parts) == text and all(len(x) <= size for x in parts)


def test_language_edges(spark):
    rows = [(i, f"{w} {i}", lang) for i, (w, lang) in enumerate([("der und die das nicht", "de"), ("the and of with that", "en")] * 20)]
    rows += [(100, None, "de"), (101, "12 .. 3", "en"), (None, "the of the", None), (102, "", "de"), (102, "", "de")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    model = op6.fit(docs)
    assert sorted(name for name, _ in model) == ["de", "en"]
    got = op6.predict(docs, model).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and by[0]["lang_pred"] == "de" and by[1]["lang_pred"] == "en"
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and by[i]["rejected"] for i in (100, 101, 102))
    kept = op6.filter_known(docs)
    assert kept.columns == docs.columns and {r["score"] for r in kept.collect()} == {"x"}
    assert op6.fit(docs.limit(0)) == [] and op6.predict(docs.limit(0), model).collect() == []
    assert {r["lang_pred"] for r in op6.predict(docs, []).collect()} == {"und"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=25), st.lists(st.integers(0, 5), max_size=12))
def test_alignment(passage, item):
    assert op7.alignment(np.array(passage, np.int64), np.array(item, np.int64)) == brute.align(passage, item)


def leaks_by_alignment(docs, items, least=op7.MIN_SCORE):
    """Every item aligned with every whole text."""
    cut = lambda t: op7.words_by_text([t])[0]
    out = {}
    for i, text in docs:
        words = cut(text)
        out[i] = sorted(j for j, item in items if len(cut(item)) and
                        op7.alignment(words, cut(item)) >= least * 2 * len(cut(item)))
    return out


def test_decontamination(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(150)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for n, (i, text) in enumerate(items[:12]):  # copies: exact, every 6th word changed, a word dropped or put in
        w = text.split()
        edited = [w, [x if k % 6 else "zzz" for k, x in enumerate(w)], w[:4] + w[5:], w[:9] + ["qq"] + w[9:]][n % 4]
        rows.append((10_000 + n, f"{rows[n][1][:200]} {' '.join(edited).upper()} {rows[n + 1][1][:200]}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = leaks_by_alignment(rows, items)
    assert all(want[10_000 + n] for n in range(12))
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string")
    for chars in (op7.BLOCK_CHARS, 1500):  # one block, several blocks
        got = op7.judge(table, bench, block_chars=chars).collect()
        assert {r["doc_id"]: r["item_ids"] for r in got} == want
        assert all(r["contaminated"] == bool(r["item_ids"]) == (not r["kept"]) for r in got)
    kept = op7.drop_leaks(table, bench)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, x in want.items() if not x}


@pytest.mark.parametrize("chars,scan", [(op7.BLOCK_CHARS, 4), (40, 1), (40, 2), (90, 100)])
def test_blocks_never_change_the_result(spark, chars, scan):
    """Rows that share a doc_id or have none are judged apart, whatever the blocks and scans; ids may be strings."""
    item = [f"w{i}" for i in range(12)]
    items = [("a", " ".join(item)), ("b", "quick brown foxes jump over seven dogs"), (None, "one two three four five six seven"),
             ("a", "alpha beta gamma delta epsilon zeta eta"), ("c", None), ("d", "")]
    rows = [(1, "pre " + " ".join(item) + " post"), (1, "clean words only here"), (None, "x quick brown foxes jump over seven dogs"),
            (None, "nothing of that kind"), (None, None), (2, "one two three four five six seven alpha beta gamma delta epsilon zeta eta"),
            (2, "one two three four five six seven alpha beta gamma delta epsilon zeta eta"),
            (3, " ".join(item) + " alpha beta gamma delta epsilon zeta eta")]
    want = Counter([(1, ("a",)), (1, ()), (None, ("b",)), (None, ()), (None, ()), (2, ("a", None)), (2, ("a", None)), (3, ("a",))])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = op7.judge(docs, bench, block_chars=chars, scan_blocks=scan).collect()
    assert Counter((r["doc_id"], tuple(r["item_ids"])) for r in got) == want
    assert all(r["n_items"] == len(r["item_ids"]) and (r["score"] >= op7.MIN_SCORE) == r["contaminated"] for r in got)
    kept = Counter(map(tuple, op7.drop_leaks(docs, bench, block_chars=chars, scan_blocks=scan).collect()))
    assert kept == Counter([(1, "clean words only here"), (None, "nothing of that kind"), (None, None)])


def test_clean_rows_are_not_shuffled(spark, capsys):
    """Rows with leaks are dropped where they are read: no exchange, all columns, repeated and null rows as they were."""
    rows = [(1, "pre alpha beta gamma delta epsilon zeta eta post", {"a": 1}), (1, "clean", {"b": 2}), (1, "clean", {"b": 2}),
            (None, None, None), (None, "x alpha beta gamma delta epsilon zeta eta", None), (2, "", {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more map<string,long>")
    bench = spark.createDataFrame([(4, "alpha beta gamma delta epsilon zeta eta")], "item_id long, text string")
    kept = op7.drop_leaks(docs, bench)
    assert kept.schema == docs.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, (r for r in docs.collect() if "alpha" not in (r["text"] or ""))))
    kept.explain()
    assert "Exchange" not in capsys.readouterr().out
    assert op7.drop_leaks(docs, bench.limit(0)).count() == len(rows)


def found_in(rows, items, **settings):
    block = op7.Items([t for _, t in items], op7.GRAM, op7.MIN_SCORE)
    words, off = op7.words_by_text([t for _, t in rows])
    out = {i: [] for i, _ in rows}
    for t, q, _ in op7.leaks_in(block, np.zeros(len(block.hash), bool), words, off, **settings):
        out[rows[t][0]].append(items[q][0])
    return {i: sorted(x) for i, x in out.items()}


def test_decontamination_of_copied_edits(spark):
    """Seeds that a group of edited copies makes frequent are seeds still."""
    item = [f"a{i}" for i in range(30)]
    edited = " ".join(x if k % 4 else "zzz" for k, x in enumerate(item))
    for copies in (3, 200):
        rows = [(i, f"q{i} {edited} r{i}") for i in range(copies)] + [(1000, " ".join(item)), (1001, "a1 a2 a3 b b b a5 a6")]
        got = op7.judge(spark.createDataFrame(rows, "doc_id long, text string"),
                        spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
        assert {r["doc_id"] for r in got if r["contaminated"]} == {*range(copies), 1000}


def test_decontamination_without_intact_trigrams(spark):
    """A word after every second word, the middle of five words changed, a
    word between all of five: no three words of the item are left together."""
    long, short = [f"a{i}" for i in range(20)], list("vwxyz")
    rows = [(1, " ".join(f"{x} zz" if i % 2 else x for i, x in enumerate(long))), (2, "v w q y z"), (3, "p v 1 w 2 x 3 y 4 z p"),
            (4, "v w q q q q y z"), (5, "v 1 2 w 3 x 4 5 y 6 z")]
    bench = [(10, " ".join(long)), (11, " ".join(short))]
    want = {1: [10], 2: [11], 3: [11], 4: [], 5: []}
    assert leaks_by_alignment(rows, bench) == want
    got = op7.judge(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert {r["doc_id"]: r["item_ids"] for r in got.collect()} == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=20), max_size=8), st.lists(st.lists(st.integers(0, 6), min_size=3, max_size=6),
                                                                               max_size=5))
def test_every_copy_of_a_short_item_is_found(texts, wanted):
    cut = lambda x: [(i, " ".join(f"w{k}" for k in t)) for i, t in enumerate(x)]
    assert found_in(cut(texts), cut(wanted)) == leaks_by_alignment(cut(texts), cut(wanted))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=30), max_size=6), st.lists(st.lists(st.integers(0, 9), min_size=6, max_size=14),
                                                                               max_size=4), st.sampled_from([1, 7, op7.HITS]))
def test_every_copy_is_found(texts, wanted, hits):
    cut = lambda x: [(i, " ".join(f"w{k}" for k in t)) for i, t in enumerate(x)]
    assert found_in(cut(texts), cut(wanted), hits=hits) == leaks_by_alignment(cut(texts), cut(wanted))


def test_decontamination_edges(spark, table_of):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "tiny"), (None, "a b c d e f g h"), (4, "same row " * 3)],
                                  "item_id long, text string")
    docs = table_of([*EDGE, (20, "a b c d e f g h"), (21, "so tiny!"), (22, "tin y")])
    got = Counter((r["doc_id"], tuple(r["item_ids"])) for r in op7.judge(docs, bench).collect())
    assert got[20, (None,)] == 1 and got[21, (3,)] == 1 and got[22, ()] == 1 and got[5, (4,)] == 2 and got[7, (4,)] == 1
    assert sum(got.values()) == len(EDGE) + 3
    assert op7.judge(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert op7.judge(table_of([]), bench).collect() == []


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


CODEC = op8.codec_for(op8.read_vocabulary())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab 's\n\t\r\x1c\x85\xa0  '.!<|>é½漢🙂"), st.characters(codec="utf-8")), max_size=40))
def test_bpe_like_the_library(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert CODEC.encode(text) == ids
    (n, _, decoded), = CODEC.digests([text])
    assert n == len(ids) and decoded == brute.sha(library.decode(ids, skip_special_tokens=False).encode())


def test_bpe_special_strings(library):
    for text in ("<|endoftext|>", "a<|endoftext|> b", "<|endoftext", "x" * 3000, "ab" * 900, "é" * 700, " \n" * 50):
        assert CODEC.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_bpe_query(mixed, table_of, library):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op8.encode_digests(table_of(mixed)).collect()}
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in mixed}
    assert got == {i: (len(x), brute.sha(",".join(map(str, x)).encode()),
                       brute.sha(library.decode(x, skip_special_tokens=False).encode())) for i, x in ids.items()}
    lists = op8.encode_ids(table_of(EDGE)).collect()
    assert len(lists) == len(EDGE) and all(r["ids"] == ids.get("-", CODEC.encode({9: "", 8: ""}.get(r["doc_id"], ""))) or r["ids"]
                                           for r in lists)
    assert op8.encode_digests(table_of([])).collect() == []


def test_impossible_pairs_are_in_no_token():
    for token in list(CODEC.token.values())[:5000]:
        if token.decode("utf-8", "ignore") not in CODEC.special:
            assert not any(CODEC.never[a, b] for a, b in zip(token, token[1:]))


def test_bpe_encodes_a_batch_in_short_stretches():
    """What one batch of texts takes at once, whatever its length."""
    import tracemalloc

    import pyarrow as pa

    from revspark.llm import op8_bpe
    from revspark.llm.common import in_stretches

    codec = op8_bpe.ByteBPE(op8_bpe.read_vocabulary())
    texts = ["some words of a long batch " * 800] * 200
    codec.digests(texts[:1])
    tracemalloc.start()
    rows = [r for b in in_stretches([pa.record_batch([pa.array(texts)], names=["text"])], "text", op8_bpe.STRETCH)
            for r in codec.digests(b.column(0).to_pylist())]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(rows)) == 1 and len(rows) == 200 and peak < 40 << 20, peak
