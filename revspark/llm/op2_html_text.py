"""HTML main text by site template removal.

1. One scan parses the pages, hashes every element's subtree and gives the
   distinct (host, hash) of each page with a digest of the page's text.
2. Spark counts, per host, the distinct pages that have a subtree, with
   partial sums in the tasks.  Pages with the same text of article, main or
   body count once, however they differ in comments, scripts, menus or
   footers, so an article that is copied is no template of its host.  Subtrees on at least
   ``share`` of a host's distinct pages, and on ``min_pages``, are the site's
   template.  A host has at most (elements per page) / share of them.  Inline
   elements amid text, such as a bold word, are no subtrees of their own.
3. A second scan deletes the template's subtrees and extracts the text.  The
   templates are broadcast while their number is at most ``broadcast_rows``;
   beyond it pages and templates are joined by host.

Inside the article a subtree must recur on ``share_inside`` of the pages to
go, so a passage that some articles of a site share stays.  Elements that are
never main text go whatever their number: scripts, styles, forms, menus,
footers, sidebars by element, and whatever a class, id or role names as such,
or as notice, advert or reader comment.  A name is a whole class or id, or
its parts if the others only tell place or form (``share-buttons``, but not
``share-price``).  An element that is only named so, or a form, stays if it
holds over half of the article's text, or of the page's without an article;
articles inside forms are found.

Pages are read in time linear in their size, broken ones too.

Blocks are block elements; text between them makes blocks of its own, a line
break is white space, table cells are separated by a space.

Defined results: null or empty html gives the empty string.  A null or
unreadable url is a host of its own kind, the empty name.  A page without
``article``, ``main`` or such a role gives what is left of its body.  Rows
that repeat are extracted alike and count once.  An empty table gives an
empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.sources.tables import table

from .common import stored
from .html_tree import Node, blocks, hash_subtrees, in_prose, inside, number, parse
from .packing import packed, unpacked

SHARE, SHARE_INSIDE, MIN_PAGES, BROADCAST_ROWS = 0.3, 0.6, 5, 500_000
DROP = frozenset("""script style noscript template nav footer aside form button select textarea input label iframe object
    embed svg canvas video audio dialog menu head title map datalist""".split())
NAMED = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense adslot banner sponsor sponsored
    sponsors promo promos promotion promotions cookie cookies consent gdpr notice notices popup modal overlay newsletter
    subscribe subscription signup sidebar sidebars sidenav menu menus nav navbar navigation navi breadcrumb breadcrumbs
    footer comment comments commentlist disqus replies respond social share sharing related recommended recommendations
    widget widgets masthead toolbar pagination pager login topbar skip""".split())
OUTSIDE = frozenset("header heading logo search".split())
#: Parts of a class or id that tell place or form only; any other part beside a name makes it a name of its own.
PLAIN = frozenset("""a an the and of in on for to at by with top bottom left right center main page site global local primary
    secondary first second last inner outer wrapper wrap container box area block section sections region zone panel row col
    column columns grid list lists item items unit units slot link links button buttons btn icon icons bar group set content
    body text title label inline fixed sticky floating mobile desktop small large xs sm md lg xl js wp post posts article
    articles entry entries story stories news blog user users reader readers form thread""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def named(node: Node) -> bool:
    """Does a class or the id name something that is never main text: as a
    whole, or in parts of which the others only tell place or form."""
    return any(_names(token) for a in ("class", "id") for token in (node.get(a) or "").split())


@lru_cache(maxsize=50_000)
def _names(token: str) -> bool:
    if token.lower() in NAMED:
        return True
    parts = {w.lower() for w in _WORD.findall(token)}
    return bool(parts & NAMED) and not parts - NAMED - PLAIN


@lru_cache(maxsize=50_000)
def _outside(token: str) -> bool:
    parts = {w.lower() for w in _WORD.findall(token)}
    return bool(parts & OUTSIDE) and not parts - NAMED - PLAIN - OUTSIDE


def never_text(node: Node, in_article: bool) -> bool:
    if node.tag in DROP or (node.tag == "header" and not in_article):
        return True
    if not node.attributes:
        return False
    style = (node.get("style") or "").replace(" ", "").lower()
    return (node.get("hidden") is not None or (node.get("aria-hidden") or "").lower() == "true" or "display:none" in style
            or (node.get("role") or "").lower() in ROLES)


def named_away(node: Node, in_article: bool) -> bool:
    return bool(node.attributes) and (named(node) or (not in_article and any(
        _outside(token) for a in ("class", "id") for token in (node.get(a) or "").split())))


def roots(root: Node) -> list[Node]:
    """The outermost articles, those inside a named or dropped element only
    if there are no others; else the outermost main elements, without
    hidden ones if another is shown; else the body.  Forms are searched: some
    sites put the whole page into one."""
    articles, aside, shown, mains, bodies = [], [], [], [], []
    stack = [(root, False, False, False)]  # element; inside something named or dropped; hidden; inside main
    while stack:
        x, away, hidden, inner = stack.pop()
        role = (x.get("role") or "").lower() if x.attributes else ""
        if x.tag == "article" or role == "article":
            if not (named_away(x, True) or never_text(x, True)):  # reader comments are often articles
                (aside if away else articles).append(x)
            continue
        if x.tag == "main" or role == "main":
            if not inner:
                mains.append(x)
                if not (hidden or never_text(x, True)):
                    shown.append(x)
            away, inner = False, True
        elif x.tag in ("body", "html", "#root"):
            away = False
            if x.tag == "body":
                bodies.append(x)
        else:
            away = away or named_away(x, False) or never_text(x, False)
        if x.tag not in DROP or x.tag == "form":
            hidden = hidden or (x.tag != "form" and never_text(x, True))
            stack += [(c, away, hidden, inner) for c in reversed(x.children) if isinstance(c, Node)]
    return articles or aside or shown or mains or bodies[:1] or [root]


def weights(top: Node) -> dict[int, int]:
    """Visible characters below each element, by id, without those of dropped
    elements; a form counts, what is in its fields does not."""
    out: dict[int, int] = {}
    for x in reversed([top, *inside(top)]):
        out[id(x)] = sum(sum(map(len, c.split())) if isinstance(c, str) else 0 if c.tag in DROP and c.tag != "form"
                         else out[id(c)] for c in x.children)
    return out


def main_text(html: str | None, everywhere: frozenset = frozenset(), mostly: frozenset = frozenset()) -> str:
    """Text of a page; ``everywhere`` and ``mostly`` are the hashes of its
    host's template outside and inside of articles."""
    root = parse(html or "")
    if everywhere or mostly:
        hash_subtrees(root)
    return text_of(root, everywhere, mostly)


def text_of(root: Node, everywhere: frozenset = frozenset(), mostly: frozenset = frozenset()) -> str:
    """The same for a parsed page, hashed if there is a template."""
    out: list[str] = []
    for top in roots(root):
        in_article = top.tag in ("article", "main") or top.get("role") is not None
        template, weight = mostly if in_article else everywhere, weights(top)
        most = weight[id(top)]

        def skip(x: Node) -> bool:
            if bool(template) and number(x.digest) in template and not in_prose(x):
                return True
            # neither a name nor being a form takes away over half of the text
            if x.tag == "form" and 2 * weight[id(x)] > most:
                return False
            return never_text(x, in_article) or (named_away(x, in_article) and 2 * weight[id(x)] <= most)

        out += blocks(top, skip)
    return "\n".join(out)


def subtrees(pages: DataFrame) -> DataFrame:
    """(host, page, hash): distinct subtrees with text of each page; hash 0
    stands for the page itself, ``page`` is a digest of its text before any
    template is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, digests, hashes = [], [], []
            for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root = parse(html or "")
                hash_subtrees(root)
                found = {number(x.digest) for x in inside(root) if x.children and x.tag not in ("html", "body", "head") and not in_prose(x)} | {0}
                hosts += [host_of(url)] * len(found)
                digests += [int.from_bytes(hashlib.blake2b(text_of(root).encode("utf-8", "replace"), digest_size=8).digest(),
                                           "little", signed=True)] * len(found)
                hashes += found
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(digests, pa.int64()),
                                              pa.array(hashes, pa.int64())], names=["host", "page", "hash"])

    return pages.select("url", "html").mapInArrow(run, "host string, page long, hash long")


def templates(pages: DataFrame, share: float = SHARE, share_inside: float = SHARE_INSIDE,
              min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, hash, mostly): the subtrees that recur on a host's pages;
    mostly: also deleted inside articles."""
    counts = stored(subtrees(pages).groupBy("host", "hash").agg(F.count_distinct("page").alias("n")).filter(
        (F.col("n") >= min_pages) | (F.col("hash") == 0)), "op2-counts")
    total = counts.filter("hash = 0").select("host", F.col("n").alias("pages"))
    return counts.filter("hash <> 0").join(total, "host").filter(F.col("n") >= F.col("pages") * share).select(
        "host", "hash", (F.col("n") >= F.col("pages") * share_inside).alias("mostly"))


def extract(pages: DataFrame, broadcast_rows: int = BROADCAST_ROWS, **settings) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    found = stored(templates(pages, **settings), "op2-templates")
    kind = pages.schema["page_id"].dataType.simpleString()
    names = ["page_id", "url", "text", "n_chars"]

    def rows(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                           pa.array([len(t) for t in texts], pa.int64())], names=names)

    if found.count() <= broadcast_rows:
        known: dict[str, tuple[set, set]] = {}
        for r in found.toLocalIterator():
            both = known.setdefault(r["host"], (set(), set()))
            both[0].add(r["hash"])
            if r["mostly"]:
                both[1].add(r["hash"])
        shared = pages.sparkSession.sparkContext.broadcast({h: tuple(map(frozenset, x)) for h, x in known.items()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            none = (frozenset(), frozenset())
            for batch in batches:
                yield rows(batch, [main_text(html, *shared.value.get(host_of(url), none)) for url, html in
                                   zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())])

        return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")

    def hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("host", pa.array([host_of(u) for u in batch.column(1).to_pylist()], pa.string()))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches, "packed", "html"):
            yield rows(batch, [main_text(h, frozenset(a or ()), frozenset(b or ())) for h, a, b in zip(
                *(batch.column(c).to_pylist() for c in ("html", "everywhere", "mostly")))])

    shared = found.groupBy("host").agg(F.collect_set("hash").alias("everywhere"),
                                       F.collect_set(F.when(F.col("mostly"), F.col("hash"))).alias("mostly"))
    small = packed(pages.select("page_id", "url", "html"), "html")
    with_host = small.mapInArrow(hosts, f"page_id {kind}, url string, packed binary, host string")
    return with_host.join(shared, "host", "left").select("page_id", "url", "packed", "everywhere", "mostly").mapInArrow(
        joined, f"page_id {kind}, url string, text string, n_chars long")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
