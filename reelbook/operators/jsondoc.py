"""The JSON document embedded in a page: locate, parse, and read records from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelbook.functions import text as tx
from reelbook.functions import variants as vr
from reelbook.schemas import (
    DETAIL_KEY,
    ITEM_MODULE_KEY,
    PROFILE_DEFAULTS,
    SCOPE_KEY,
    SCRIPT_ID,
    VIDEO_COLUMNS,
    VIDEO_DEFAULTS,
    VIDEO_URL_BASE,
)

#: Bytes below which every document fits a VARIANT (whose parts may take several times the text).
LARGE_BYTES = 16 << 20

# The constructs of a page, each consumed whole (possessively, so a page of any length is
# read in one pass without a stack). Blanks and names are those of the markup reader.
_S = r"[\s\x0B\x1C-\x1F\x85\xA0  -     　]"
_NOT_S = _S.replace("[", "[^", 1)
_SEP = rf"(?:{_S}|/(?!>))*+"
_VALUE = rf"""(?:'[^']*+'|"[^"]*+"|(?!['"])(?:(?!>){_NOT_S})*+)"""
_REST = rf"(?:{_S}*+=++{_S}*{_VALUE}{_S}*+|{_S}*=+{_S}*{_VALUE}{_S}*+)?+"
_ATTR = rf"""(?<=['"\s\x0B\x1C-\x1F\x85\xA0  -     　/])(?:(?![/>]){_NOT_S})(?:(?![/=>]){_NOT_S})*+{_REST}{_SEP}"""
_NAME_END = r"(?=[\t\n\r\f />])"
_NAME = r"[a-zA-Z][^\t\n\r\f />\x00]*+"
_ATTRS = rf"{_SEP}(?:{_ATTR})*+"
# The last attribute `id` of a tag has the wanted value.
_ID = rf"""(?<=['"\s/])(?i:id){_S}*+=++{_S}*+(?:"{SCRIPT_ID}"|'{SCRIPT_ID}'|{SCRIPT_ID}(?=>|{_S})){_S}*+{_SEP}"""
_OTHER = rf"(?!(?i:id)(?:[/=>]|{_S})){_ATTR}"
_LAST_ID = rf"{_ID}(?:{_OTHER})*+(?=/?>)"
_WANTED = rf"<(?i:script){_NAME_END}{_SEP}(?:(?!{_LAST_ID}){_ATTR})*+{_LAST_ID}"
_CLOSED = rf"</{_S}*+(?i:script){_S}*+>"


def _up_to(first: str, rest: str) -> str:
    """Text up to the next ``first`` that ``rest`` follows. Runs without ``first`` are taken at
    once: a reluctant ``[\\s\\S]*?`` tries what follows at every letter, at seven times the cost.
    ``(?>x*)`` takes what ``x*+`` takes, by a loop of its own instead of a match for each letter."""
    return rf"(?>[^{first}]*)(?:{first}(?!{rest})(?>[^{first}]*))*+"


_SCRIPT_TEXT = _up_to("<", rf"/{_S}*+(?i:script){_S}*+>")
_STYLE_TEXT = _up_to("<", rf"/{_S}*+(?i:style){_S}*+>")
_COMMENT_TEXT = _up_to("-", rf"-{_S}*+>")
_TOKENS = (
    r"(?>[^<&]+)",
    r"&(?!#)",
    r"&#(?=(?:[0-9]+|[xX][0-9a-fA-F]+)[^0-9a-fA-F])",
    r"<(?![a-zA-Z/!?])",
    r"</[^>]*+>",
    rf"<!--{_COMMENT_TEXT}--{_S}*+>",
    r"<\?[^>]*+>",
    r"<!(?!--|\[)[^>]*+>",
    rf"<!\[(?i:temp|cdata|ignore|include|rcdata)(?![-_.a-zA-Z0-9])[\s\S]*?\]{_S}*+\]{_S}*+>",
    rf"<!\[(?i:if|else|endif)(?![-_.a-zA-Z0-9])[\s\S]*?\]{_S}*+>",
    r"<!\[(?!(?i:temp|cdata|ignore|include|rcdata|if|else|endif)(?![-_.a-zA-Z0-9]))",
    # scripts and styles with their text, other tags, and tags cut short by a stray character
    rf"(?!{_WANTED})<(?i:script){_NAME_END}{_ATTRS}>{_SCRIPT_TEXT}{_CLOSED}",
    rf"<(?i:style){_NAME_END}{_ATTRS}>{_STYLE_TEXT}</{_S}*+(?i:style){_S}*+>",
    rf"(?!{_WANTED}|<(?i:script|style){_NAME_END}{_ATTRS}>)<{_NAME}{_ATTRS}/?+>",
    rf"<{_NAME}{_ATTRS}(?![>/=a-zA-Z]|\z)",
)
# What ends the first pass of the reader: an unknown character reference before some ';', or
# a construct without an end. Such a construct is text up to the next '>', then and later.
_OPEN = (
    rf"(?=<!--(?!{_COMMENT_TEXT}--{_S}*+>)|<!\[(?i:temp|cdata|ignore|include|rcdata|if|else|endif)(?![-_.a-zA-Z0-9])"
    rf"|<{_NAME}{_ATTRS}(?=/(?!>)|[=a-zA-Z]|\z))<[^>]*+>"
)
_TOKEN = "|".join(_TOKENS)
_PAGE = (
    rf"\A(?:{_TOKEN})*+(?:(?:&#(?=[^;]*+;)|{_OPEN})(?:{_TOKEN}|{_OPEN})*+)?+"
    rf"{_WANTED}(?:/>|>({_SCRIPT_TEXT}){_CLOSED})"
)


def script_body(html: Column) -> Column:
    """Text of the first script with the wanted id; NULL if there is none or it is empty.

    Pages without the id, which a plain substring test finds, are not looked at. In the
    others one pattern walks from construct to construct up to the script, so what
    stands in a comment, a marked section, an attribute or another script does not
    count; a wanted script that closes itself or never ends has no text. An id spelled
    with character references is not seen.
    """
    body = vr.let(F.regexp_extract(html, _PAGE, 1), lambda text: F.when(text != "", text))
    return F.when(F.contains(html, F.lit(SCRIPT_ID)), body)


def parse(body: Column) -> Column:
    """VARIANT ``[document, digest]``; NULL if the text is not exactly one JSON value.

    The parser stops after the first value. Placing the text in an array in front
    of its own digest makes trailing text break the array (see :func:`is_whole`).
    """
    end = F.concat(F.lit(',"'), F.sha2(body, 256), F.lit('"]'))
    return F.try_parse_json(F.concat(F.lit("["), body, end))


def is_too_large(doc: Column, body: Column) -> Column:
    """Whether a text that gave no VARIANT is a JSON object all the same: too large for one.

    Only large texts are looked through again, token by token.
    """
    large = doc.isNull() & (F.octet_length(body) >= LARGE_BYTES)
    return F.when(large, F.json_object_keys(body).isNotNull()).otherwise(False)


def is_whole(doc: Column, body: Column) -> Column:
    """Whether ``parse(body)`` holds one document and nothing after it."""
    return F.coalesce(
        (F.try_variant_get(doc, "$[1]", "string") == F.sha2(body, 256))
        & F.variant_get(doc, "$[2]", "variant").isNull(),
        F.lit(False),
    )


def member(doc: Column, *keys: str) -> Column:
    """VARIANT under the given keys of the document; NULL if missing."""
    return F.try_variant_get(doc, _path(*keys), "variant")


def _path(*keys: str) -> str:
    return "$[0]" + "".join(f'["{key}"]' for key in keys)


# --- gate and shape -------------------------------------------------------------


def gate(doc: Column) -> Column:
    """Does the document hold the user detail? Presence counts, a null value passes.

    NULL means that the test itself is an error: a document or scope that is
    null, a number or a boolean, or one that holds the key as text.

    A VARIANT that is handed on is copied, so a user detail that is an object, as it
    nearly always is, is told by itself; others are looked up key by key.
    """

    def has_key(container: Column, key: str) -> Column:
        what = vr.kind(container)
        mentions = F.when(what == "STRING", F.contains(vr.text_of(container), F.lit(key))).when(
            what == "ARRAY",
            F.exists(
                F.try_variant_get(container, "$", "array<variant>"),
                lambda item: (vr.kind(item) == "STRING") & (vr.text_of(item) == key),
            ),
        )
        # Text and arrays may mention the key, but cannot be read by it.
        return F.when(vr.is_object(container), vr.object_of(container, key)[key].isNotNull()).when(
            mentions == F.lit(False), F.lit(False)
        )

    root = F.try_variant_get(doc, "$[0]", "variant")
    scope = member(doc, SCOPE_KEY)
    found = vr.object_of(doc, "_", path=_path(SCOPE_KEY, DETAIL_KEY)).isNotNull()
    return F.when(found, F.lit(True)).when(has_key(root, SCOPE_KEY), has_key(scope, DETAIL_KEY)).otherwise(
        has_key(root, SCOPE_KEY)
    )


def detail_parts(doc: Column) -> Column:
    """Parts of the user detail; NULL if it is not an object."""
    return vr.object_of(doc, "userInfo", "posts", "itemList", path=_path(SCOPE_KEY, DETAIL_KEY))


def info_parts(info: Column) -> Column:
    return vr.object_of(info, "user", "stats")


def link_of(bio_link: Column) -> Column:
    return vr.object_of(bio_link, "link")["link"]


def user_parts(user: Column) -> Column:
    return vr.object_of(
        user,
        "uniqueId",
        "id",
        "nickname",
        "signature",
        "bioLink",
        "bio",
        "avatarLarger",
        "verified",
    )


def stats_parts(stats: Column) -> Column:
    return vr.object_of(stats, "followingCount", "followerCount", "heartCount", "videoList")


# --- profile ----------------------------------------------------------------------


def profile_sources(user: Column, stats: Column, link: Column) -> dict[str, tuple[Column, str]]:
    """Profile column -> (VARIANT it is read from, column type)."""
    return {
        "username": (user["uniqueId"], "string"),
        "user_id": (user["id"], "string"),
        "actual_name": (user["nickname"], "string"),
        "following_count": (stats["followingCount"], "bigint"),
        "follower_count": (stats["followerCount"], "bigint"),
        "total_like_count": (stats["heartCount"], "bigint"),
        "caption": (user["signature"], "string"),
        "bio_link": (link, "string"),
        "bio": (user["bio"], "string"),
        "profile_pic_url": (user["avatarLarger"], "string"),
        "is_verified": (user["verified"], "boolean"),
    }


def profile(user: Column, stats: Column, link: Column) -> Column:
    """The 11 profile fields with defaults for missing keys."""
    return F.struct(
        *[
            vr.default_if_missing(value, PROFILE_DEFAULTS[name], sql_type).alias(name)
            for name, (value, sql_type) in profile_sources(user, stats, link).items()
        ]
    )


def profile_loads(user: Column, stats: Column, link: Column) -> Column:
    """Whether every profile value fits its column."""
    fits = F.lit(True)
    for value, sql_type in profile_sources(user, stats, link).values():
        fits = fits & vr.loads_as(value, sql_type)
    return fits


# --- posts ------------------------------------------------------------------------

_POST_FIELDS = ("id", "desc", "createTime", "video", "stats")
_POST = "struct<" + ",".join(f"`{name}`: variant" for name in _POST_FIELDS) + ">"


def as_list(place: Column) -> Column:
    """The posts of a list; NULL if it is not one. An element that is not an object
    becomes a NULL struct."""
    return F.try_variant_get(place, "$", f"array<{_POST}>")


def items_place(doc: Column, items: Column) -> Column:
    """``itemList`` if that key exists, even if it is null or empty, else ``ItemList``."""
    return F.coalesce(items, member(doc, SCOPE_KEY, DETAIL_KEY, "ItemList"))


def posts(doc: Column, body: Column, *places_and_lists: Column) -> Column:
    """Posts of a page, from the first place that is not empty.

    ``places_and_lists`` are pairs of a place and :func:`as_list` of it; the root
    map of posts is the last place. A place that holds something other than a
    list ends the search with no posts.
    """
    places, lists = places_and_lists[::2], places_and_lists[1::2]
    chain = F
    for place, rows in zip(places, lists):
        found = F.when(rows.isNotNull(), F.size(rows) > 0).otherwise(vr.truthy(place))
        chain = chain.when(found, rows)
    chain = chain.when(vr.is_object(member(doc, ITEM_MODULE_KEY)), item_module_posts(body))
    return F.coalesce(chain, F.array().cast(f"array<{_POST}>"))


def item_module_posts(body: Column) -> Column:
    """Values of the root map of posts, in document order (VARIANT objects sort their keys).

    Of a repeated key the last value counts, at the place of the first; of several
    such maps the last.
    """
    root = F.map_entries(F.from_json(body, "map<string,string>"))
    maps = F.filter(root, lambda entry: entry["key"] == ITEM_MODULE_KEY)
    text = F.element_at(maps, -1)["value"]
    # building the map anew settles repeated keys as `spark.sql.mapKeyDedupPolicy` says
    posts = F.map_from_entries(F.map_entries(F.from_json(text, "map<string,variant>")))
    return F.transform(F.map_values(posts), lambda post: F.try_variant_get(post, "$", _POST))


def readings(rows: Column) -> Column:
    """What each post gives, each part read once; later steps use plain fields.

    Lambdas are evaluated as written, without sharing equal parts, so a value
    needed more than once is bound to a field first.
    """

    def read(post: Column) -> Column:
        return F.struct(
            post.isNull().alias("no_post"),
            F.when(vr.is_plain(post["id"], "STRING"), vr.text_of(post["id"]) != "")
            .otherwise(vr.truthy(post["id"]))
            .alias("has_id"),
            vr.text_of(post["id"]).alias("id"),
            post["desc"].alias("desc"),
            post["createTime"].isNotNull().alias("has_time"),
            # the text of a number is not asked for
            F.when(~vr.is_plain(post["createTime"], "BIGINT"), vr.text_of(post["createTime"])).alias("time_text"),
            F.coalesce(
                F.try_variant_get(post["createTime"], "$", "bigint"),
                tx.grouped_to_long(vr.text_of(post["createTime"])),
            ).alias("seconds"),
            post["video"].isNotNull().alias("has_video"),
            vr.object_of(post["video"], "cover").alias("video"),
            post["stats"].isNotNull().alias("has_stats"),
            vr.object_of(
                post["stats"], "playCount", "diggCount", "commentCount", "shareCount"
            ).alias("stats"),
        )

    return F.transform(rows, read)


def _is_timed(reading: Column) -> Column:
    """Whether there is a createTime to convert: given, and not the default text itself."""
    return reading["has_time"] & ~F.coalesce(
        reading["time_text"] == VIDEO_DEFAULTS["create_time"], F.lit(False)
    )


def breaks_list(reading: Column) -> Column:
    """Whether reading this post ends the reading of the whole list."""
    in_range = F.coalesce(reading["seconds"].between(tx.MIN_EPOCH, tx.MAX_EPOCH), F.lit(False))
    unreadable = (
        (reading["has_stats"] & reading["stats"].isNull())
        | (reading["has_video"] & reading["video"].isNull())
        | (_is_timed(reading) & ~in_range)
    )
    return reading["no_post"] | (reading["has_id"] & unreadable)


def readable_prefix(given: Column) -> Column:
    """Readings before the first one that breaks the list."""
    first_bad = F.array_position(F.transform(given, breaks_list), F.lit(True)).cast("int")
    return F.when(first_bad == 0, given).otherwise(F.slice(given, F.lit(1), first_bad - 1))


def videos(given: Column, username: Column, url_base: str = VIDEO_URL_BASE) -> Column:
    """Video rows of readable posts; posts without an id are skipped.

    ``fits`` tells whether all values of a row can be loaded.
    """

    def row(reading: Column, prefix: Column) -> Column:
        stats = reading["stats"]
        sources = {
            "views": (stats["playCount"], "bigint"),
            "thumbnail": (reading["video"]["cover"], "string"),
            "description": (reading["desc"], "string"),
            "like_count": (stats["diggCount"], "bigint"),
            "comment_count": (stats["commentCount"], "bigint"),
            "share_count": (stats["shareCount"], "bigint"),
        }
        fields = {
            name: vr.default_if_missing(value, VIDEO_DEFAULTS[name], sql_type)
            for name, (value, sql_type) in sources.items()
        }
        fields["url"] = F.concat(prefix, reading["id"])
        fields["create_time"] = F.when(
            _is_timed(reading), tx.epoch_to_iso(reading["seconds"])
        ).otherwise(VIDEO_DEFAULTS["create_time"])
        fits = F.lit(True)
        for value, sql_type in sources.values():
            fits = fits & vr.loads_as(value, sql_type)
        return F.struct(
            *[fields[name].alias(name) for name in VIDEO_COLUMNS], fits.alias("fits")
        )

    with_id = F.filter(given, lambda reading: reading["has_id"])
    return vr.let(
        F.concat(F.lit(f"{url_base}/@"), username, F.lit("/video/")),
        lambda prefix: F.transform(with_id, lambda reading: row(reading, prefix)),
    )
