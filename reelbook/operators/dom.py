"""Page markup as an array of nodes, and selectors over that array.

One Arrow UDF turns a page into ``struct<text, nodes>``. ``text`` holds the
visible text of the page once, as UTF-8 bytes; a node refers to its part by
offsets, so nesting does not repeat text. Nodes are in document order, and the
descendants of node ``n`` are those with ``n.i < i <= n.last``. Everything that
selects or reads nodes is a column expression.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from reelbook.functions import text as tx
from reelbook.functions import variants as vr
from reelbook.functions.markup import NodeReader
from reelbook.schemas import CLASS_DESC, CLASS_FEED, CLASS_STATS, PROFILE_DEFAULTS, VIDEO_DEFAULTS

PAGE_TYPE = (
    "struct<text: binary, nodes: array<struct<"
    "i: int, last: int, tag: string, attrs: map<string,string>, t0: int, t1: int>>>"
)


def page_nodes(
    html: Column, tags: Iterable[str] | None = None, attrs: Iterable[str] | None = None
) -> Column:
    """Nodes and text of a page; NULL for NULL and for markup that cannot be read.

    ``tags`` and ``attrs`` limit which nodes and attributes leave the Python
    worker (all by default). Give NULL for pages that need no parsing: they cost
    a null slot in the Arrow batch.
    """
    wanted_tags = None if tags is None else frozenset(tags)
    wanted_attrs = None if attrs is None else frozenset(attrs)
    arrow_type = to_arrow_type(_parse_datatype_string(PAGE_TYPE))

    def read(page: str) -> dict | None:
        try:
            return NodeReader(wanted_tags, wanted_attrs).read(page)
        except AssertionError:
            return None

    def read_batch(pages: pa.Array) -> pa.Array:
        # a column of all nodes of the batch for each of their parts: Arrow takes a flat list
        # in a fraction of the time of a list of dictionaries
        texts, ends, nodes = [], [0], []
        # the nodes of a batch are many objects without cycles: the collector would walk them in vain
        collects = gc.isenabled()
        gc.disable()
        try:
            for page in pages.to_pylist():
                found = None if page is None else read(page)
                texts.append(found and found["text"])
                nodes += found["nodes"] if found else ()
                ends.append(len(nodes))
        finally:
            if collects:
                gc.enable()
        attrs = [attr for node in nodes for attr in node["attrs"]]
        attr_ends = [0, *accumulate(len(node["attrs"]) for node in nodes)]
        node_type = arrow_type.field("nodes").type.value_type
        names, values = (pa.array([attr[k] for attr in attrs], pa.string()) for k in (0, 1))
        given = pa.MapArray.from_arrays(pa.array(attr_ends, pa.int32()), names, values)
        columns = {
            field.name: pa.array([node[field.name] for node in nodes], field.type)
            for field in node_type
            if field.name != "attrs"
        }
        columns["attrs"] = given.cast(node_type.field("attrs").type)
        rows = pa.StructArray.from_arrays([columns[field.name] for field in node_type], fields=list(node_type))
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows).cast(arrow_type.field("nodes").type)
        missing = pa.array([text is None for text in texts], pa.bool_())
        parts = [pa.array(texts, pa.binary()), listed]
        return pa.StructArray.from_arrays(parts, fields=list(arrow_type), mask=missing)

    read_batch.__annotations__ = {"pages": pa.Array, "return": pa.Array}
    # Marked as not deterministic, so that no filter or size test repeats the reading below it.
    return F.arrow_udf(read_batch, PAGE_TYPE).asNondeterministic()(html)


# --- selectors ------------------------------------------------------------------

Test = Callable[[Column], Column]


def attr(node: Column, name: str) -> Column:
    """Attribute value; NULL if the node or the attribute is missing."""
    return node["attrs"][name]


def where(tag: str | None = None, class_like: str | None = None, **equal: str) -> Test:
    """Test on tag, attribute equality (``data_e2e`` is ``data-e2e``) and class pattern."""

    def test(node: Column) -> Column:
        result = F.lit(True) if tag is None else node["tag"] == tag
        for name, value in equal.items():
            result = result & (attr(node, name.replace("_", "-")) == value)
        if class_like is not None:
            result = result & attr(node, "class").rlike(f"(?s){class_like}")
        return F.coalesce(result, F.lit(False))

    return test


def find_all(nodes: Column, test: Test) -> Column:
    return F.filter(nodes, test)


def find_first(nodes: Column, test: Test) -> Column:
    """First matching node, or NULL."""
    return F.get(find_all(nodes, test), F.lit(0))


def ranks(pool: Column) -> Column:
    """For each place of a page, up to the last node of ``pool``, which node of the
    pool is the first one there or later. Built from run lengths in one pass."""

    def run(node: Column, rank: Column) -> Column:
        before = F.coalesce(F.get(pool, rank - 1)["i"], F.lit(-1))
        return F.array_repeat(rank, node["i"] - before)

    return F.flatten(F.transform(pool, run))


def first_inside(pool: Column, rank_at: Column, container: Column) -> Column:
    """First node of ``pool`` among the descendants of ``container``, or NULL."""
    node = F.get(pool, F.get(rank_at, container["i"] + 1))
    return F.when(node["i"] <= container["last"], node)


def node_text(page: Column, node: Column) -> Column:
    """Text of a node and its descendants, stripped."""
    raw = F.substring(page["text"], node["t0"] + 1, node["t1"] - node["t0"])
    return tx.strip(raw.cast("string"))


def class_text(node: Column) -> Column:
    """Class value with runs of blanks as one space."""
    return F.trim(F.regexp_replace(attr(node, "class"), r"\s+", " "))


# --- creator page -----------------------------------------------------------------

CREATOR_TAGS = ("a", "div", "h1", "h2", "img", "strong", "svg")
CREATOR_ATTRS = ("class", "data-e2e", "href", "src")


def creator_nodes(html: Column) -> Column:
    """Nodes of a creator page that its selectors can ask for."""
    return page_nodes(html, CREATOR_TAGS, CREATOR_ATTRS)


def marked_nodes(page: Column) -> Column:
    """Nodes with a ``data-e2e`` mark, the short list most selectors search."""
    return F.filter(page["nodes"], lambda node: attr(node, "data-e2e").isNotNull())


_COUNTS = ("following", "followers", "likes")


def profile_steps(page: Column, marked: Column) -> Column:
    """Raw parts of a profile, and the number of the first step that fails (0 if none).

    Steps run in field order, and a failing step leaves it and all later fields
    at their defaults: a count without digits (1 to 3), a link without href (4),
    a picture without src (5). Each node is searched for once, and each text read once.
    """
    text = lambda node: node_text(page, node)
    found = F.struct(
        find_all(marked, where("strong", data_e2e="user-stats")).alias("counts"),
        find_first(marked, where("h2", data_e2e="user-subtitle")).alias("name"),
        find_first(marked, where("h1", data_e2e="user-title")).alias("title"),
        find_first(marked, where("h2", data_e2e="user-bio")).alias("bio"),
        find_first(marked, where("a", data_e2e="user-link")).alias("link"),
        find_first(marked, where("img", data_e2e="user-avatar")).alias("picture"),
        find_first(marked, where("svg", data_e2e="verify-badge")).alias("badge"),
    )

    def read(found: Column) -> Column:
        link, picture = found["link"], found["picture"]
        counts = {name: F.get(found["counts"], F.lit(k)) for k, name in enumerate(_COUNTS)}
        return F.struct(
            text(found["name"]).alias("username"),
            text(found["title"]).alias("actual_name"),
            *[tx.digits_of(text(node)).alias(name) for name, node in counts.items()],
            text(found["bio"]).alias("bio"),
            attr(link, "href").alias("link"),
            attr(picture, "src").alias("picture"),
            found["badge"].isNotNull().alias("verified"),
            (link.isNotNull() & attr(link, "href").isNull()).alias("no_href"),
            (picture.isNotNull() & attr(picture, "src").isNull()).alias("no_src"),
        )

    def judged(parts: Column) -> Column:
        failed = None
        bad = [*[parts[name] == "" for name in _COUNTS], parts["no_href"], parts["no_src"]]
        for step, fails in enumerate(bad, start=1):
            failed = F.when(fails, step) if failed is None else failed.when(fails, step)
        given = ("username", "actual_name", *_COUNTS, "bio", "link", "picture", "verified")
        return F.struct(*[parts[name].alias(name) for name in given], failed.otherwise(0).alias("failed"))

    return vr.let(found, lambda found: vr.let(read(found), judged))


def profile(steps: Column) -> Column:
    """The 11 profile fields from :func:`profile_steps`."""

    def upto(step: int, value: Column, name: str) -> Column:
        reached = (steps["failed"] == 0) | (steps["failed"] > step)
        default = F.lit(PROFILE_DEFAULTS[name])
        return F.when(reached & value.isNotNull(), value).otherwise(default).alias(name)

    count = lambda digits: digits.try_cast("bigint")
    default = lambda name: F.lit(PROFILE_DEFAULTS[name]).alias(name)
    return F.struct(
        upto(0, steps["username"], "username"),
        default("user_id"),
        upto(0, steps["actual_name"], "actual_name"),
        upto(1, count(steps["following"]), "following_count").cast("bigint").alias("following_count"),
        upto(2, count(steps["followers"]), "follower_count").cast("bigint").alias("follower_count"),
        upto(3, count(steps["likes"]), "total_like_count").cast("bigint").alias("total_like_count"),
        upto(3, steps["bio"], "bio").alias("caption"),
        upto(4, steps["link"], "bio_link"),
        upto(3, steps["bio"], "bio"),
        upto(5, steps["picture"], "profile_pic_url"),
        upto(5, steps["verified"], "is_verified"),
    )


def profile_loads(steps: Column) -> Column:
    """Whether the counts that are read fit 64 bits."""
    fits = F.lit(True)
    for step, name in enumerate(_COUNTS, start=1):
        digits = F.coalesce(steps[name], F.lit(""))
        read = (steps["failed"] == 0) | (steps["failed"] > step)
        fits = fits & (~read | (digits == "") | digits.try_cast("bigint").isNotNull())
    return fits


_NUMBERS = ("views", "likes", "comments", "shares")


def videos(page: Column, marked: Column) -> Column:
    """Video rows of the post containers; a container that fails is left out.

    The candidates of each selector are listed and ranked once per page; a
    container then looks its first candidate up, so the work is linear in the page.
    """
    posts = find_all(marked, where("div", data_e2e="user-post-item"))
    count = lambda name: find_all(marked, where("strong", data_e2e=name))
    pools = {
        "link": find_all(page["nodes"], where("a")),
        "views": count("video-views"),
        "image": find_all(page["nodes"], where("img")),
        "desc": find_all(page["nodes"], where("div", class_like=CLASS_DESC)),
        "stats": find_all(page["nodes"], where("div", class_like=CLASS_STATS)),
        "likes": count("like-count"),
        "comments": count("comment-count"),
        "shares": count("share-count"),
    }
    feeds = find_all(page["nodes"], where("div", class_like=CLASS_FEED))
    found = F.struct(posts.alias("posts"), *[pool.alias(name) for name, pool in pools.items()])

    def read(found: Column, at: Column) -> Column:
        first = lambda name, container: first_inside(found[name], at[name], container)
        containers = F.when(F.size(found["posts"]) > 0, found["posts"]).otherwise(feeds)
        parts = F.transform(
            containers,
            lambda container: F.struct(
                *[first(name, container).alias(name) for name in ("link", "views", "image")],
                *[first(name, container).alias(name) for name in ("desc", "stats")],
            ),
        )
        digits = lambda node: tx.digits_of(node_text(page, node))
        values = F.transform(
            parts,
            lambda part: F.struct(
                part["link"].alias("link"),
                part["image"].alias("image"),
                node_text(page, part["desc"]).alias("description"),
                digits(part["views"]).alias("views"),
                *[
                    digits(first(name, part["stats"])).alias(name)
                    for name in ("likes", "comments", "shares")
                ],
            ),
        )
        return F.transform(F.filter(values, _complete), _video)

    return vr.let(
        found,
        lambda found: vr.let(
            F.struct(*[ranks(found[name]).alias(name) for name in pools]),
            lambda at: read(found, at),
        ),
    )


def _complete(value: Column) -> Column:
    """Whether a container has a URL, no picture without src, and digits in its counts."""
    usable = F.coalesce(~attr(value["link"], "href").isin("", "N/A"), F.lit(False))
    usable = usable & (value["image"].isNull() | attr(value["image"], "src").isNotNull())
    for name in _NUMBERS:
        usable = usable & (value[name].isNull() | (value[name] != ""))
    return usable


def _video(value: Column) -> Column:
    def number(name: str) -> Column:
        return F.when(value[name].isNull(), F.lit(0).cast("bigint")).otherwise(
            value[name].try_cast("bigint")
        )

    default = lambda given, name: F.coalesce(given, F.lit(VIDEO_DEFAULTS[name])).alias(name)
    fits = F.lit(True)
    for name in _NUMBERS:
        fits = fits & number(name).isNotNull()
    return F.struct(
        attr(value["link"], "href").alias("url"),
        number("views").alias("views"),
        default(attr(value["image"], "src"), "thumbnail"),
        default(value["description"], "description"),
        F.lit(VIDEO_DEFAULTS["create_time"]).alias("create_time"),
        number("likes").alias("like_count"),
        number("comments").alias("comment_count"),
        number("shares").alias("share_count"),
        fits.alias("fits"),
    )
