"""Main text of web pages, without the furniture that a page or its host repeats."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import stage

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br img".split()
)
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr caption figcaption tbody thead".split())
DROPPED = frozenset(
    "script style noscript template nav footer aside form button select option textarea input iframe svg object "
    "canvas dialog menu head title audio video map".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
                  "th": ("tr", "table"), "option": ("select",)}
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe subscription signup social share sharing related recommended recommendations comment "
    "comments disqus reply replies respond widget widgets toolbar login search masthead skip pagination pager".split()
)
CONTENT_ROLES = {"main", "article"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "hash", "words", "linked", "furniture")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children, self.hash, self.words, self.linked = tag, attrs, [], 0, 0, 0
        names = {w.lower() for k in ("class", "id") for w in WORD.findall(attrs.get(k) or "")}
        role = (attrs.get("role") or "").lower()
        hidden = "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or \
            "display:none" in (attrs.get("style") or "").replace(" ", "").lower()
        self.furniture = bool(names & FURNITURE) or role in CHROME_ROLES or hidden

    @property
    def content(self) -> bool:
        return self.tag in ("article", "main") or (self.attrs.get("role") or "").lower() in CONTENT_ROLES


class Tree(HTMLParser):
    """Nested nodes of a page; elements left open end where a browser would end them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", {})
        self.open = [self.root]
        self.n_open: Counter[str] = Counter()  # by tag, so that a deep page is not searched in vain

    def _close_from(self, i: int) -> None:
        self.n_open.subtract(n.tag for n in self.open[i:])
        del self.open[i:]

    def _close_open(self, tags: tuple[str, ...] | frozenset, within: tuple[str, ...]) -> None:
        if not any(self.n_open[t] for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                self._close_from(i)
                return
            if tag in within:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close_open(("p",), ("button", "table", "td", "th", "article", "section", "div"))
        if tag in CLOSED_BY_SAME:
            same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            self._close_open(same, CLOSED_BY_SAME[tag])
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.n_open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # "/>" means nothing on an element that is not void

    def handle_endtag(self, tag: str) -> None:
        if not self.n_open[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self._close_from(i)
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def hash_subtrees(node: Node) -> list[Node]:
    """Give each element a 64-bit hash of its tag and all below it, and its numbers of words and of
    words in links; elements, children first."""
    order, todo = [], [node]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += [c for c in n.children if isinstance(c, Node)]
    order.reverse()
    for n in order:
        parts = [n.tag, *(f"<{c.hash}>" if isinstance(c, Node) else " ".join(c.split()) for c in n.children)]
        n.hash = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "replace")) - (1 << 63) & ~1
        for c in n.children:
            if isinstance(c, Node):
                n.words, n.linked = n.words + c.words, n.linked + c.linked
            else:
                n.words += len(c.split())
        if n.tag == "a":
            n.linked = n.words
    return order


def content_roots(page: Node) -> list[Node]:
    """The outermost articles, else the outermost main elements, else the page itself."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    todo = [(page, "")]
    while todo:
        node, inside = todo.pop()
        kind = ("article" if node.tag == "article" or (node.attrs.get("role") or "").lower() == "article" else "main") \
            if node.content else ""
        if node.tag in DROPPED or (node.furniture and not kind):
            continue
        if kind and kind != inside:
            if not (kind == "article" and node.furniture):
                found[kind].append(node)
            if kind == "article":
                continue
        todo += [(c, inside or kind) for c in reversed(node.children) if isinstance(c, Node)]
    return found["article"] or found["main"] or [page]


def _dropped(node: Node, rooted: bool) -> bool:
    if node.tag in DROPPED or (node.tag == "header" and not rooted):
        return True
    return node.furniture and node.tag not in ("html", "body")


def blocks(page: Node) -> tuple[list[str], list[tuple[int, int, int]], list[int]]:
    """Text blocks of the main part, the candidates for the host's template there, and all subtrees
    that count.

    A candidate is ``(id, first, last)``: its subtree holds the blocks from ``first`` up to, not
    including, ``last``. The id is the subtree's hash, whose lowest bit is free and set for elements
    of an article that are not link lists: those must recur on a larger share of the host's pages.
    Paragraphs, headings, list items, quotations and cells of an article are no candidates, for a
    quoted passage or a copied article is not a template. Where a page marks no article, every
    block element is one. A page's work grows with its size, whatever its depth.
    """
    hash_subtrees(page)
    roots = content_roots(page)
    rooted = roots[0] is not page
    out: list[str] = []
    spans: list[tuple[int, int, int]] = []
    buffer: list[str] = []

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            out.append(text)

    for root in roots:
        stack: list = [(root, -1)]
        while stack:
            item, first = stack.pop()
            if isinstance(item, str):
                buffer.append(item)
                continue
            if first < 0:
                if item is not root and _dropped(item, rooted):
                    continue
                if item.tag == "br":
                    buffer.append(" ")
                    continue
                if item.tag not in INLINE:
                    flush()
                    stack.append((item, len(out)))
                stack += [(c, -1) for c in reversed(item.children)]
            else:
                flush()
                if first < len(out) and _candidate(item, root, rooted):
                    links = 2 * item.linked >= item.words
                    spans.append((item.hash | (rooted and not links), first, len(out)))
        flush()
    seen = {i & ~1 for i, _, _ in spans}
    todo = [page]
    while todo:  # furniture found by its tag or name recurs as well
        node = todo.pop()
        if node.tag in DROPPED or node.furniture:
            seen.add(node.hash)
        elif node not in roots:
            todo += [c for c in node.children if isinstance(c, Node)]
    return out, spans, sorted(seen)


def _candidate(node: Node, root: Node, rooted: bool) -> bool:
    if node is root or node.tag in ("html", "body", "head"):
        return False
    return not rooted or node.tag not in TEXT_BLOCKS and not node.content


def parsed(pages: DataFrame) -> DataFrame:
    """Pages as blocks: ``page_id, url, host, body, texts, spans, subtrees``."""
    span = pa.struct([("id", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, subtrees, bodies = [], [], [], []
            for html in batch["html"].to_pylist():
                found, candidates, seen = blocks(parse(html))
                texts.append([t.encode("utf-8", "replace").decode() for t in found])
                spans.append([dict(zip(("id", "first", "last"), c)) for c in candidates])
                subtrees.append(seen)
                bodies.append(xxhash.xxh64_intdigest("\n".join(texts[-1]).encode()) - (1 << 63))
            yield pa.RecordBatch.from_arrays([
                batch["page_id"], batch["url"], pa.array(bodies, pa.int64()), pa.array(texts, pa.list_(pa.string())),
                pa.array(spans, pa.list_(span)), pa.array(subtrees, pa.list_(pa.int64())),
            ], ["page_id", "url", "body", "texts", "spans", "subtrees"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    schema = "page_id long, url string, body long, texts array<string>, " \
             "spans array<struct<id: long, first: int, last: int>>, subtrees array<long>"
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1))
    return rows.mapInArrow(run, schema).withColumn("host", host)


def templates(pages: DataFrame, min_pages: int = 10, min_share: float = 0.1, article_share: float = 0.5) -> DataFrame:
    """``host, subtree, common``: subtrees on at least ``min_pages`` and ``min_share`` of a host's
    pages; ``common`` are those on at least ``article_share`` of them.

    Pages of a host with the same text count once, so copies of a page make no template.
    """
    different = pages.select("host", "body").distinct().groupBy("host").agg(F.count("*").alias("n_pages"))
    seen = pages.select("host", "body", F.explode("subtrees").alias("subtree")).distinct()
    counts = seen.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    return counts.join(different, "host").where(F.col("n") >= min_share * F.col("n_pages")).select(
        "host", "subtree", (F.col("n") >= article_share * F.col("n_pages")).alias("common")
    )


def main_text(pages: DataFrame, min_pages: int = 10, min_share: float = 0.1, article_share: float = 0.5) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Scripts, forms, navigation and named furniture go by their tags, roles and names; then
    every remaining block goes that hangs in a subtree the host repeats (``templates``): inside
    an article on ``article_share`` of its pages, for link lists and where no article is marked
    on ``min_share``. The rest is joined in page order, white space inside a block as one space.
    Null and empty pages have an empty text; pages without a host in their url share one;
    repeated rows are extracted one by one; other columns are ignored.
    """
    rows = stage(parsed(pages), "pages")
    found = stage(templates(rows, min_pages, min_share, article_share), "templates")
    key = F.xxhash64("page_id", "url", "body", "spans")
    held = rows.where(F.size("spans") > 0).select("host", key.alias("key"), F.explode("spans").alias("span")).select(
        "host", "key", "span", F.col("span.id").bitwiseAND(F.lit(-2)).alias("subtree")
    )
    wide = F.col("common") | (F.col("span.id").bitwiseAND(F.lit(1)) == 0)
    gone = held.join(found, ["host", "subtree"]).where(wide).groupBy("key").agg(
        F.collect_set(F.struct("span.first", "span.last")).alias("gone")
    )
    gone = stage(gone, "gone")  # of known size: where few pages lose something, no text is shuffled
    both = rows.withColumn("key", key).join(gone, "key", "left")
    left = F.when(F.col("gone").isNull(), F.col("texts")).otherwise(F.filter(
        "texts", lambda t, i: ~F.exists("gone", lambda g: (g["first"] <= i) & (i < g["last"]))
    ))
    text = F.array_join(left, "\n")
    return both.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
