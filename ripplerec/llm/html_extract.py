"""Main text of web pages by wrapper induction.

Every page is aligned with a pivot page of its host by simple tree matching.
Per pivot node the corpus says how many pages have it, how many have the same
text there, and how much varying text it holds: nodes with the same text on
nearly all pages are the host's template, the least element around the nodes
with varying text (those in <article> or <main>, if they have most of it) is its
content slot.  A page's text is what its content slot holds, without template
nodes, page furniture and reader comments; a text that is template as a whole
(a host of copies) is kept.

Defined results: null or empty html gives an empty text; a null url is a host
of its own; a page of a host without varying text, or one that does not align
with its pivot, is read by its own largest <article>, else whole; repeated pages
give repeated rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of, small_batches
from .dom import BLOCK, RAW, Node, align, blocks, finish, parse

#: A text is template if this share of the host's pages, at least so many, have it in its place.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.8, 4
#: Parts that the pages of one host are joined with their pivot in.
SALT = 32

# Elements, roles and class words that are never main text.
FURNITURE = RAW | frozenset("head nav header footer aside form button select menu dialog object canvas label input".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
CLASSES = frozenset((
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus discussion footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter "
    "notice notices notification paywall popup promo promoted promotion recommended related replies reply respond "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget").split())
_MARK = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_STATS = "host string, node int, pages long, same long, mass long"
_RESULT = "page_id long, url string, text string, n_chars long"


def furniture(node: Node) -> bool:
    """Whether an element is page furniture by its kind or its class."""
    if node.tag in FURNITURE:
        return True
    if not node.marks or node.tag in ("html", "body", "article", "main"):
        return False
    words = {w.lower() for w in _MARK.findall(node.marks)}
    return not words.isdisjoint(CLASSES) or not ROLES.isdisjoint(node.marks.lower().split())


def visible(root: Node) -> list[Node]:
    """Elements outside furniture, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if not furniture(node):
            out.append(node)
            stack.extend(reversed(node.elements()))
    return out


def article_of(node: Node) -> Node:
    """The outermost <article>, else the outermost <main>, around a node."""
    found = {"article": None, "main": None}
    at: Node | None = node
    while at is not None:
        if at.tag in found:
            found[at.tag] = at
        at = at.parent
    return found["article"] or found["main"] or node


def around(nodes: list[Node]) -> Node | None:
    """The least element that holds all of ``nodes``."""
    best: list[Node] | None = None
    for node in nodes:
        path = [node]
        while path[-1].parent is not None:
            path.append(path[-1].parent)
        path.reverse()
        if best is None:
            best = path
        same = 0
        while same < min(len(best), len(path)) and best[same] is path[same]:
            same += 1
        best = best[:same]
    return best[-1] if best else None


def content(nodes: list[Node], mass: dict[int, int]) -> Node | None:
    """The element around all nodes with text; of those in <article> or <main>,
    if they have at least half of it."""
    some = [n for n in nodes if mass.get(n.number, 0)]
    named = [n for n in some if article_of(n).tag in ("article", "main")]
    if 2 * sum(mass[n.number] for n in named) >= sum(mass[n.number] for n in some):
        some = named
    best = around(some)
    return None if best is None else article_of(best)


class Wrapper:
    """What the pages of one host have taught about its pivot page."""

    def __init__(self, pivot: str | None, stats: list | None = None):
        self.root = parse(pivot)
        self.order = finish(self.root)
        self.texts = {n.number: n.own_text() for n in self.order}
        self.seen = visible(self.root)
        self.template: set[int] = set()
        self.slot: int | None = None
        if stats:
            mass = {s["node"]: s["mass"] for s in stats}
            # empty pages have the root only
            pages = max((s["pages"] for s in stats if s["node"]), default=0)
            self.template = {s["node"] for s in stats if pages >= TEMPLATE_PAGES and self.texts[s["node"]]
                             and s["same"] >= TEMPLATE_SHARE * pages}
            self.template = {n for n in self.template if not self._within(self.order[n])}
            best = content([n for n in self.seen if n.number not in self.template], mass)
            self.slot = None if best is None else best.number

    def _within(self, node: Node) -> bool:
        """Whether an inline element stands in the running text of its block: such a constant word is content."""
        at = node
        while at.tag not in BLOCK and at.parent is not None:
            at = at.parent
            if self.texts[at.number] and at.number not in self.template:
                return True
        return False

    def observe(self, page: str | None, counts: dict[int, np.ndarray]) -> None:
        """Add one page to the counts (pages, same text, varying characters) per pivot node."""
        root = parse(page)
        finish(root)
        for number, partner in align(self.root, root).items():
            text = partner.own_text()
            same = text == self.texts[number]
            row = counts.setdefault(number, np.zeros(3, dtype=np.int64))
            row += (1, same, 0 if same else len(text))

    def extract(self, page: str | None) -> str:
        """The page's main text, blocks joined by line feeds."""
        root = parse(page)
        order = finish(root)
        seen = visible(root)
        pairs = align(self.root, root)
        template = {p.number for n, p in pairs.items() if n in self.template and p.own_text() == self.texts[n]}
        start = pairs.get(self.slot) if self.slot is not None else None
        if start is None:
            articles = [n for n in seen if n.tag == "article" and article_of(n) is n]
            if articles:
                start = max(articles, key=lambda n: sum(map(len, blocks(n, furniture))))
            else:
                start = content(seen, {n.number: len(n.own_text()) for n in seen if n.number not in template})
                start = order[0] if start is None else start
        text = "\n".join(blocks(start, lambda n: furniture(n) or n.number in template))
        return text or "\n".join(blocks(start, furniture))


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in rows_of(batches):
        wrappers: dict[str, Wrapper] = {}
        counts: dict[str, dict[int, np.ndarray]] = {}
        pivots = b["pivot"]
        for i, (host, page) in enumerate(zip(b["host"].to_pylist(), b["html"].to_pylist(), strict=True)):
            if host not in wrappers:
                wrappers[host] = Wrapper(pivots[i].as_py())
            wrappers[host].observe(page, counts.setdefault(host, {}))
        rows = [(host, node, *map(int, c)) for host, own in counts.items() for node, c in own.items()]
        types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                         ["host", "node", "pages", "same", "mass"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in rows_of(batches):
        wrappers: dict[str, Wrapper] = {}
        pivots, stats = b["pivot"], b["stats"]
        texts = []
        for i, (host, page) in enumerate(zip(b["host"].to_pylist(), b["html"].to_pylist(), strict=True)):
            if host not in wrappers:
                wrappers[host] = Wrapper(pivots[i].as_py(), stats[i].as_py())
            texts.append(wrappers[host].extract(page))
        yield pa.RecordBatch.from_arrays(
            [b["page_id"].cast(pa.int64()), b["url"], pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages`` (page_id, url, html)."""
    small_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    pages = pages.select("page_id", "url", "html", host.alias("host"),
                         F.pmod(F.xxhash64("page_id"), F.lit(SALT)).alias("salt"))
    # the pivot is a page of the host's most frequent set of tags, empty pages last; the
    # least hash is one that does not depend on the order
    html = F.coalesce("html", F.lit(""))
    tags = F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit("<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1))))
    pivots = (pages.groupBy("host", (F.trim(html) != "").alias("full"), F.xxhash64(tags).alias("shape"))
              .agg(F.count(F.lit(1)).alias("n"), F.min_by(html, F.xxhash64("page_id", "html")).alias("pivot"))
              .groupBy("host").agg(F.max_by("pivot", F.struct("full", "n", "shape")).alias("pivot")))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).alias("salt")
    spread = pivots.select("host", "pivot", salts)
    # both passes read the same columns, so the pages are shuffled once for the two joins
    stats = (pages.join(spread.hint("merge"), ["host", "salt"]).select("page_id", "url", "html", "host", "pivot")
             .mapInArrow(_observe, _STATS)
             .groupBy("host", "node").agg(*(F.sum(c).alias(c) for c in ("pages", "same", "mass")))
             .groupBy("host").agg(F.collect_list(F.struct("node", "pages", "same", "mass")).alias("stats")))
    known = pivots.join(stats, "host", "left").select("host", "pivot", "stats", salts)
    return (pages.join(known.hint("merge"), ["host", "salt"]).select("page_id", "url", "html", "host", "pivot", "stats")
            .mapInArrow(_extract, _RESULT))
