"""Deep, unclosed and long pages; constant words in running text; alignment against brute force."""

import random
import time

from ripplerec.llm import dom, html_extract

URL = "page_id long, url string, html string"


def _texts(spark, pages):
    df = spark.createDataFrame([(i, "http://a.b/x", h) for i, h in enumerate(pages)], URL)
    return {r.page_id: r.text for r in html_extract.main_text(df).collect()}


def test_deep_and_unclosed_pages_do_not_fail(spark):
    deep = "<div>" * 5000 + "deep {0}" + "</div>" * 5000
    pages = [deep.replace("{0}", f"words {i}") for i in range(3)]
    pages += ["<b>" * 20_000 + "x", "a <b " * 200_000, "<p>ends <" + "i " * 10]
    began = time.time()
    got = _texts(spark, pages)
    assert [got[i] for i in range(3)] == [f"deep words {i}" for i in range(3)] and got[3] == "x"
    assert time.time() - began < 60


def test_a_megabyte_of_unclosed_tags_is_parsed_in_linear_time():
    times = []
    for n in (40_000, 160_000):
        began = time.time()
        root = dom.parse("a <b " * n)
        times.append(time.time() - began)
        assert "".join(dom.blocks(root, lambda _: False)).count("<b") == n
    assert times[1] < 12 * times[0] + 1


def test_constant_words_in_running_text_stay(spark):
    page = ("<body><div><a href=/>Home</a> <a href=/x>World</a></div><div id=c><p>The <b>Ministry</b> said {0} today.</p>"
            "<p>More <em>of <b>this</b></em> {1}</p><p><a>Share</a> <a>Print</a></p></div></body>")
    got = _texts(spark, [page.format(f"thing {i}", f"line {i}") for i in range(8)])
    assert got == {i: f"The Ministry said thing {i} today.\nMore of this line {i}" for i in range(8)}


def _largest(x, y):
    """Simple tree matching by its definition."""
    if x.tag != y.tag:
        return 0
    p, q = x.elements(), y.elements()
    best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    for i, c in enumerate(p, 1):
        for j, d in enumerate(q, 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + _largest(c, d))
    return 1 + best[-1][-1]


def test_alignment_is_a_largest_matching():
    rng = random.Random(6)

    def tree(depth):
        tag = rng.choice(["div", "span", "em"])
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rng.randrange(4) if depth else 0)) + f"</{tag}>"

    for _ in range(150):
        a, b = (dom.parse("".join(tree(3) for _ in range(rng.randrange(1, 4)))) for _ in range(2))
        dom.finish(a), dom.finish(b)
        pairs = dom.align(a, b)
        assert len(pairs) == _largest(a, b)
        order = {n.number: n for n in _nodes(a)}
        for number, partner in pairs.items():
            node = order[number]
            assert node.tag == partner.tag
            if node.parent is not None:  # parents are partners too
                assert pairs[node.parent.number] is partner.parent


def _nodes(root):
    out, stack = [], [root]
    while stack:
        out.append(stack.pop())
        stack.extend(out[-1].elements())
    return out
