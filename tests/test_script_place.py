"""The script's place on random pages is the one the markup reader finds."""

import random

from pyspark.sql import functions as F

from reelbook.functions.markup import NodeReader
from reelbook.operators import jsondoc
from reelbook.schemas import SCRIPT_ID


class ScriptReader(NodeReader):
    """Keeps the text of the first script with the id."""

    def __init__(self):
        super().__init__(frozenset(["script"]), frozenset(["id"]))
        self.found = None

    def wanted(self):
        places = [i for i, node in enumerate(self.nodes) if dict(node["attrs"]).get("id") == SCRIPT_ID]
        return self.nodes[places[0]] if places else None

    def handle_data(self, data):
        node = self.wanted()
        if node is not None and self.open and self.open[-1][1] is node:
            self.found = (self.found or "") + data
        super().handle_data(data)


def reader_script(page):
    reader = ScriptReader()
    try:
        reader.read(page)
    except AssertionError:
        return "broken"
    return reader.found or None


OPEN = f'<script id="{SCRIPT_ID}">'
PIECES = [
    OPEN, OPEN, f"<SCRIPT type=x ID='{SCRIPT_ID}' >", f"<script id={SCRIPT_ID}>", f"<script id={SCRIPT_ID}/>",
    f'<script id="{SCRIPT_ID}"/>', f'<script id="{SCRIPT_ID}" />', f'<script id="{SCRIPT_ID}" / >', f'<script id="other" id="{SCRIPT_ID}">',
    f'<script id="{SCRIPT_ID}" id=other>', f'<script data-id="{SCRIPT_ID}">', f'<script id = "{SCRIPT_ID}"a>', f'<script id=="{SCRIPT_ID}">',
    f"<script/id='{SCRIPT_ID}'/>", f'<div id="{SCRIPT_ID}">', f"<p title='{OPEN}x</script>'>", f'<p title="<script id={SCRIPT_ID}>x</script>">',
    f"<scripts id='{SCRIPT_ID}'>", "</script>", "</script>", "</SCRIPT >", "</ script>", "</script x>", "<script>", "<script src='>'>", "<script/>",
    "<style>", "</style>", "<style/>", "<!--", "-->", "-- >", "--", "<!-->", "<![CDATA[", "]]>", "] ] >", "]>", "<![if x", "<!doctype html>", "<!x",
    "<?php", "?>", ">", "<", "</", "</>", "</1>", "<1", "<br/>", "<br", "<a href=x/>", "<a b='", "<a b=\"", "'", '"', "=", "/", "<a\x00b>", "<a b c>",
    "&", "&#", "&#1;", "&#x1F;", "&#12a;", ";", "&amp;", "&amp", "text", " ", "\n", "\x0b", "\xa0", "{}", '{"a":"<b>"}', "é",
]


def page(rng):
    parts = [rng.choice(PIECES) for _ in range(rng.randint(1, 14))]
    if rng.random() < 0.7:
        parts += [OPEN, rng.choice(["1", '{"a":1}', "</x>", "<!--"]), "</script>"]
    if rng.random() < 0.3:
        parts += [rng.choice(PIECES) for _ in range(4)]
    return "".join(parts)


def found(spark, pages):
    frame = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    rows = frame.repartition(8).select("i", jsondoc.script_body(F.col("html")).alias("body")).collect()
    return [row.body for row in sorted(rows)]


def test_random_pages(spark):
    rng = random.Random(3)
    pages = [page(rng) for _ in range(40_000)]
    want = [reader_script(p) for p in pages]
    assert sum(w not in (None, "broken") for w in want) > 8000
    differ = [(p, w, g) for p, w, g in zip(pages, want, found(spark, pages)) if w != "broken" and w != g]
    assert not differ, (len(differ), differ[:5])


def test_long_pages(spark):
    """One pass and no stack, whatever stands in front of the script."""
    end = f"{OPEN}yes</script>"
    many = 60_000
    fronts = ["<p>" * many, "<!-- x -->" * many, "<a b='c' d>" * many, "<a " + "b='c' " * many + ">", "&#" * many + ";",
              "<a b='" + "<x>" * many + "'>", "<script>1</script>" * many, "x< " * many, "/" * many, "<a " + "/" * many + ">"]
    want = ["yes"] * len(fronts)
    want[4] = None  # the reader stops at the second unknown reference
    assert found(spark, [front + end for front in fronts]) == want


def test_text_is_taken_in_runs():
    """Scripts, styles and comments are not looked through letter by letter, which takes seven times as long."""
    marked_sections = sum("[\\s\\S]*?" in token for token in jsondoc._TOKENS)
    assert marked_sections == 2 and all(token.startswith(r"<!\[") for token in jsondoc._TOKENS if "[\\s\\S]*?" in token)
    assert jsondoc._PAGE.count("[\\s\\S]*?") == marked_sections * jsondoc._PAGE.count(r"|<\?[^>]*+>|")
