"""Operator 2: names, forms, broken and long pages, and whole made-up sites whose text is known."""
import random
import time

import pytest

from revspark.llm import op2_html_text as op2
from revspark.llm.html_tree import Node, parse


@pytest.mark.parametrize("html,text", [
    ('<article><h1>T</h1><div class="elementor-widget"><p>Whole article text.</p></div></article>', "T\nWhole article text."),
    ('<article><p>Long text of it</p><p class="share-price">5 euro</p><section class="related-work">work</section></article>',
     "Long text of it\n5 euro\nwork"),
    ('<article><p>Long text of it all</p><div class="share-buttons">tell</div><div class="social">x</div><p id="comments">c</p></article>',
     "Long text of it all"),
    ('<article><h1>T</h1><div class="comments"><p>Only this named element has the text of it</p></div></article>',
     "T\nOnly this named element has the text of it"),
    ('<body><form id="aspnetForm"><nav>menu</nav><article><h1>Head</h1><p>Main text.</p></article></form></body>', "Head\nMain text."),
    ('<body><form id="f"><div class="ad">buy</div><p>Main text here, quite long.</p><button>send</button></form><footer>x</footer></body>',
     "Main text here, quite long."),
    ('<body><p>Long main text of the page</p><form><p>Search this</p><input></form></body>', "Long main text of the page"),
    ('<body class="has-sidebar"><div class="Sidebar">s</div><p>Text of the page</p></body>', "Text of the page"),
    ('<article>a<aside><article>other</article></aside></article>', "a"),
    ('<aside><article>left out</article></aside><article>one</article><article>two</article>', "one\ntwo"),
    ('<aside><p>x</p></aside><div class="sidebar"><article>only one</article></div>', "only one"),
    ('a < b and c > d <1> <p title="x > y">e</p>', "a < b and c > d <1>\ne"),
    ("<p>one<li>two<li>three<p>four</p>", "one\ntwo\nthree\nfour"),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", "a b\nc\nd"),
    ('<p>x <a href="never closed>y</p><p>z</p>', "x y\nz"),
])
def test_pages(html, text):
    assert op2.main_text(html) == text


SLOW = {"named": lambda n: '<article><p>t</p>' + '<div class="ad">' * (n // 16), "tags": lambda n: "<a " * (n // 3),
        "tags at last": lambda n: "<a " * (n // 3) + ">", "quotes": lambda n: '<a ">' * (n // 5), "both quotes": lambda n: "<a '>' " * (n // 7),
        "odd quotes": lambda n: "<a \"'>" * (n // 6), "stray ends": lambda n: "<b>" * (n // 7) + "</i>" * (n // 7),
        "paragraph": lambda n: "<p>" + "<b>" * (n // 9) + "<div>x" * (n // 9), "items": lambda n: "<ul>" + "<div>" * (n // 10) + "<li>x" * (n // 10),
        "list in item": lambda n: "<li><ul>" + "<b>" * (n // 8) + "<li>x" * (n // 8), "cells": lambda n: "<table><tr>" + "<td>" * (n // 12) + "<b>x</td>" * (n // 12),
        "articles": lambda n: "<div>" * (n // 20) + "<article>x</article>" * (n // 40), "mains": lambda n: "<main>" * (n // 6) + "x",
        "scripts": lambda n: "<script>" * (n // 8), "comments": lambda n: "<!--" * (n // 4), "cdata": lambda n: "<![CDATA[" * (n // 9),
        "attributes": lambda n: "<p " + "a=b " * (n // 4) + ">x", "entities": lambda n: "<p>" + "&amp" * (n // 4),
        "text": lambda n: "<p>" + "word " * (n // 5), "open": lambda n: "<" * n}


@pytest.mark.parametrize("kind", sorted(SLOW))
def test_long_broken_pages_take_linear_time(kind):
    begun = time.process_time()
    op2.main_text(SLOW[kind](1_000_000))
    assert time.process_time() - begun < 25  # 1 to 5 s; anything quadratic takes hours


def searched(at: Node, ends, within) -> Node:
    """The implied ends, by climbing to the next element that bounds the search."""
    up, found = at, None
    while up.parent is not None and (up.tag not in within or up.tag in ends):
        found = up if up.tag in ends else found
        up = up.parent
    return found.parent if found is not None else at


def test_implied_ends_equal_a_search():
    from revspark.llm.html_tree import GROUPS, closed
    rng = random.Random(3)
    tags = ["p", "li", "ul", "div", "b", "td", "tr", "table", "dl", "dt", "dd", "option", "select", "tbody", "a", "span"]
    for _ in range(400):
        html = "".join(f"<{rng.choice(['', '', '', '/'])}{rng.choice(tags)}>" for _ in range(rng.randint(1, 40)))
        root = parse(html)
        stack = [root]
        while stack:
            x = stack.pop()
            for i, (ends, within) in enumerate(GROUPS):
                assert closed(x, i) is searched(x, ends, within)
            stack += [c for c in x.children if isinstance(c, Node)]


WORDS = "river stone light paper green window seven morning table garden winter music road silver".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def site(rng, host, pages, marked):
    """Rows of (url, html, text): every page has the host's menu, footer, notice and an unnamed box; with ``marked``
    the text is in an article, else in nameless elements."""
    menu, box, notice = ([prose(rng, rng.randint(2, 5)) for _ in range(4)], prose(rng, 8), prose(rng, 6))
    out = []
    for i in range(pages):
        title, blocks = prose(rng, 4), [prose(rng, rng.randint(12, 30)) for _ in range(rng.randint(2, 6))]
        inner = [f"<h1>{title}</h1>"]
        for b in blocks:
            style = rng.choice(["<p>{}</p>", "<div><p>{}</p></div>", "<p>{}", "<blockquote>{}</blockquote>", "<ul><li>{}</ul>"])
            a, c = b.split(" ", 1)
            inner.append(style.format(f"<b>{a}</b>\n {c}" if rng.random() < 0.5 else b))
        body = "".join(inner)
        body = f"<article class='post-{i}'>{body}<div class='share-links'>{prose(rng, 3)}</div></article>" if marked else f"<div>{body}</div>"
        html = (f"<!doctype html><html><head><title>{title}</title><style>p > a {{}}</style></head><body>"
                f"<nav><ul>{''.join(f'<li><a href=/x>{m}</a>' for m in menu)}</ul></nav><div id='cookie-notice'>{notice}</div>"
                f"<div class='x7'><p>{box}</p></div>{body}<aside>{prose(rng, 5)}</aside>"
                f"<div class='comments'><article class='comment'><p>{prose(rng, 4)}</p></article></div>"
                f"<footer>{host} {i}</footer><script>if (a < {i}) {{ '<p>no</p>' }}</script></body></html>")
        out.append((f"https://{host}/{i}", html, "\n".join([title, *blocks])))
    return out


def test_made_up_sites(spark):
    """The text of each page is what its maker put in, with templates by broadcast and by join."""
    rng = random.Random(11)
    rows = [row for k in range(6) for row in site(rng, f"h{k}.example", rng.randint(8, 20), k % 2 == 0)]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(rows)], "page_id long, url string, html string").repartition(3)
    for limit in (op2.BROADCAST_ROWS, 0):
        got = {r["page_id"]: r["text"] for r in op2.extract(pages, broadcast_rows=limit).collect()}
        assert got == {i: t for i, (_, _, t) in enumerate(rows)}
