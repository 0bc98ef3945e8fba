"""Random well-formed markup: the nodes are those of the tree it was written from."""

import html
import random

from pyspark.sql import functions as F

from reelbook.functions.markup import NodeReader
from reelbook.operators import dom

TAGS = ["div", "p", "strong", "span", "h2"]
WORDS = ["a", "B&b", "<x>", "ü　", '"q"', "é ", "1,2"]


def tree(rng, depth=0):
    """Markup of a random element, its nodes in document order, and its text."""
    if rng.random() < 0.15:
        return "<br>", [("br", 0, "")], ""
    tag = rng.choice(TAGS)
    markup, nodes, text = "", [], ""
    for _ in range(rng.randrange(4)):
        if depth < 5 and rng.random() < 0.6:
            inner, inner_nodes, inner_text = tree(rng, depth + 1)
        else:
            inner_text = rng.choice(WORDS)
            inner, inner_nodes = html.escape(inner_text), []
        markup, nodes, text = markup + inner, nodes + inner_nodes, text + inner_text
        if rng.random() < 0.2:
            markup += "<!-- <i>no</i> -->"
    return f"<{tag}>{markup}</{tag}>", [(tag, len(nodes), text), *nodes], text


def test_random_trees(spark):
    rng = random.Random(11)
    cases = [tree(rng) for _ in range(300)]
    frame = spark.createDataFrame([(i, case[0]) for i, case in enumerate(cases)], "i int, html string")
    read = frame.select("i", dom.page_nodes(F.col("html")).alias("page")).select(
        "i",
        "page.nodes",
        F.transform(
            "page.nodes",
            lambda n: F.substring(F.col("page.text"), n["t0"] + 1, n["t1"] - n["t0"]).cast("string"),
        ).alias("texts"),
    )
    for row in read.collect():
        found = [(n.tag, n.last - n.i, text) for n, text in zip(row.nodes, row.texts)]
        assert found == cases[row.i][1], cases[row.i][0]


class _Slow(NodeReader):
    """Every construct read by HTMLParser."""

    def _usual(self, html):
        return 0


def test_usual_markup_is_read_as_by_html_parser():
    rng = random.Random(5)
    parts = [
        "<p>", "</p>", "<DIV Class=\"a  b\">", "</div>", "<br/>", "<img src=\"x\"/>", "<a href=\"?a=1&amp;b\">", "text ", " \n",
        "&nbsp;", "&amp", "&#65;", "&lt;", "&", "<!-- c -->", "<!--a--b-->", "<!-->", "<!---->", "<!--->", "<!DOCTYPE html>",
        "<script>var t='</p>';</script>", "<script id=\"x\"></script>", "<script>a</ script >b</script>", "<script>a<!--b</script>",
        "<SCRIPT>x</SCRIPT>", "<style>a</style>", "</script>", "<textarea> <b></textarea>", "<a b='c'>", "<a b=c>", "<a  b = \"c\" >",
        "<a x=\"1\" x=\"2\" y=\"\">", "<x-y>", "</x-y>", "<pre>  </pre>", "<", ">", "</p >", "<![CDATA[x]]>", "<?pi?>", "<b", "é　",
    ]
    for _ in range(4000):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 12)))
        for tags, attrs in ((None, None), (frozenset({"a", "div"}), frozenset({"class", "x"}))):
            try:
                found = _Slow(tags, attrs).read(page)
            except AssertionError:
                continue
            assert NodeReader(tags, attrs).read(page) == found, page


def test_usual_markup_leaves_html_parser_nothing(monkeypatch):
    left = []
    monkeypatch.setattr(NodeReader, "feed", lambda self, html: left.append(html))
    page = (
        '<!DOCTYPE html><html><head><script>var t=\'</p>\';</script></head><body><!-- <i>no</i> --><h2 data-e2e="x">\nann </h2>'
        '<a href="https://host.example/@ann"><img src="i.jpg"/></a>&nbsp;<br></body></html>'
    )
    assert [node["tag"] for node in NodeReader(None, None).read(page)["nodes"]][:3] == ["html", "head", "script"]
    assert left == [""]
