"""A small tolerant HTML tree: enough structure to align and to read pages."""

from __future__ import annotations

import html
import re
from collections.abc import Generator, Iterator

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)",
    re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noscript template svg math".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul").split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th")}
SCOPES = frozenset("ul ol dl table article section main div body html".split())


class Node:
    """An element: children are nodes and strings in page order."""

    __slots__ = ("tag", "marks", "kids", "parent", "sig", "number")

    def __init__(self, tag: str, marks: str = "", parent: Node | None = None):
        self.tag, self.marks, self.parent = tag, marks, parent
        self.kids: list = []
        self.sig = 0
        self.number = -1

    def elements(self) -> list[Node]:
        return [k for k in self.kids if isinstance(k, Node)]

    def own_text(self) -> str:
        return squeeze(" ".join(k for k in self.kids if isinstance(k, str)))


def squeeze(text: str) -> str:
    return _SPACE.sub(" ", text).strip()


def parse(page: str | None) -> Node:
    """Tree of a page; unclosed and stray tags are tolerated."""
    root = top = Node("#page")
    page = page or ""
    at, size = 0, len(page)
    last = page.rfind(">")  # a tag that begins after it never ends
    match = _TOKEN.match
    while at < size:
        if at > last and page[at] == "<" and page[at + 1:at + 2] not in ("!", "?"):
            top.kids.append("<")
            at += 1
            continue
        m = match(page, at)
        if m is None:  # a tag that never ends
            break
        at = m.end()
        text = m.group(4)
        if text is not None:
            top.kids.append(html.unescape(text) if "&" in text else text)
            continue
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            node = top
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                top = node.parent
            elif tag == "br":
                top.kids.append(" ")
            continue
        if tag in BLOCK or tag in CLOSES:
            shut = CLOSES.get(tag, ())
            node = top
            while node is not root:
                if node.tag in shut or node.tag == "p" and tag in BLOCK:
                    top = node.parent
                elif node.tag in SCOPES:
                    break
                node = node.parent
        marks = " ".join(x for a in _ATTRIBUTE.findall(m.group(3)) for x in a[1:] if x) if m.group(3) else ""
        node = Node(tag, marks, top)
        top.kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            node.kids.append(page[at:end.start() if end else size])
            at = end.end() if end else size
        elif tag not in VOID and not m.group(3).endswith("/") or tag in BLOCK:
            if tag not in VOID:
                top = node
    return root


def finish(root: Node) -> list[Node]:
    """Number the elements in page order and sign every subtree by its shape."""
    order: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        node.number = len(order)
        order.append(node)
        stack.extend(reversed(node.elements()))
    for node in reversed(order):
        node.sig = hash((node.tag, *(k.sig for k in node.elements())))
    return order


def align(a: Node, b: Node) -> dict[int, Node]:
    """Simple tree matching of two pages: number of a node in ``a`` -> its
    partner in ``b``.  Equal heads and tails of child lists are paired at
    once; the rest is matched in order with the largest total."""
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def known(x: Node, y: Node) -> int | None:
        if x.tag != y.tag:
            return 0
        found = memo.get((x.number, y.number))
        return None if found is None else found[0]

    def match(x: Node, y: Node) -> Generator[tuple[Node, Node], int, int]:
        """Size of the best matching of two subtrees; yields the pairs that it needs first."""
        p, q = x.elements(), y.elements()
        pairs = []
        lo = 0
        while lo < len(p) and lo < len(q) and p[lo].sig == q[lo].sig:
            pairs.append((p[lo], q[lo]))
            lo += 1
        i, j = len(p), len(q)
        while i > lo and j > lo and p[i - 1].sig == q[j - 1].sig:
            i, j = i - 1, j - 1
            pairs.append((p[i], q[j]))
        p, q = p[lo:i], q[lo:j]
        ends = list(pairs)
        total = 1
        if p and q:
            w = []
            for c in p:
                w.append([])
                for d in q:
                    size = known(c, d)
                    w[-1].append((yield c, d) if size is None else size)
            best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
            for s in range(len(p)):
                row, up, ws = best[s + 1], best[s], w[s]
                for t in range(len(q)):
                    row[t + 1] = max(up[t + 1], row[t], up[t] + ws[t])
            total += best[-1][-1]
            s, t = len(p), len(q)
            while s and t:
                if w[s - 1][t - 1] and best[s][t] == best[s - 1][t - 1] + w[s - 1][t - 1]:
                    s, t = s - 1, t - 1
                    pairs.append((p[s], q[t]))
                elif best[s][t] == best[s - 1][t]:
                    s -= 1
                else:
                    t -= 1
        for c, d in ends:
            size = known(c, d)
            total += (yield c, d) if size is None else size
        memo[x.number, y.number] = (total, pairs)
        return total

    # the pages may be nested deeper than calls can be
    size, running = known(a, b), []
    if size is None:
        running.append(match(a, b))
    while running:
        try:
            running.append(match(*running[-1].send(size)))
            size = None
        except StopIteration as done:
            running.pop()
            size = done.value
    out: dict[int, Node] = {}
    if size:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            out[x.number] = y
            todo += memo[(x.number, y.number)][1]
    return out


def blocks(root: Node, skip) -> Iterator[str]:
    """Texts of the blocks below ``root`` in page order; ``skip(node)`` leaves
    a subtree out."""
    line: list[str] = []
    done: list[str] = []

    def end() -> None:
        text = squeeze("".join(line))
        line.clear()
        if text:
            done.append(text)

    stack: list = [iter(root.kids)]
    open_: list[Node] = [root]
    while stack:
        kid = next(stack[-1], None)
        if kid is None:
            stack.pop()
            if open_.pop().tag in BLOCK:
                end()
        elif isinstance(kid, str):
            line.append(kid)
        elif kid.tag == "br":
            line.append(" ")
        elif skip(kid):
            if kid.tag in BLOCK:
                end()
        else:
            if kid.tag in BLOCK:
                end()
            stack.append(iter(kid.kids))
            open_.append(kid)
    end()
    yield from done
