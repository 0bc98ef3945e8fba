"""Expected results as SQL over the given tables, one statement per query.

The statements compute the expected rows from ``customer``, ``orders``, ``events``
and so on, never from rendered pages, and share no code with the extraction.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Creators, pages and posts as the rendered pages hold them.
_CREATOR = """
orders_of AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
creator AS (
  SELECT c_custkey, c_custkey % 12 AS shape, 'user' || c_custkey AS username, c_name,
         CAST(c_nationkey AS BIGINT) AS following,
         abs(CAST(round(c_acctbal * 100) AS BIGINT)) AS followers,
         coalesce(n, 0) AS n, c_mktsegment, c_custkey % 11 < 6 AS verified,
         greatest(CAST(ceil(coalesce(n, 0) / 10.0) AS BIGINT), 1) AS chunks
  FROM customer LEFT JOIN orders_of ON o_custkey = c_custkey)"""
_PAGE = (
    _CREATOR
    + """,
own_post AS (
  SELECT creator.*, o_orderkey % 1000000007 * 387420489 % 1000000007 % chunks AS chunk,
         CAST(o_orderkey AS VARCHAR) AS id, o_orderkey,
         CAST(floor(o_totalprice) AS BIGINT) AS views, o_orderpriority,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso
  FROM orders JOIN creator ON o_custkey = c_custkey),
post_row AS (
  SELECT * FROM own_post
  UNION ALL
  SELECT * REPLACE (chunk - 1 AS chunk, views + 7 AS views) FROM own_post WHERE o_orderkey % 5 = 0 AND chunk > 0),
page AS (
  SELECT creator.* REPLACE (followers + chunk AS followers), chunk, posts,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey + chunk * 1000000) AS created,
         'profiles/' || username || '/' || strftime(TIMESTAMP '2024-01-01 00:00:00'
           + to_seconds(c_custkey + chunk * 1000000), '%Y%m%d-%H%M%S') || '.html' AS path
  FROM (SELECT c_custkey, chunk, count(*) AS posts FROM post_row GROUP BY ALL
        UNION ALL SELECT c_custkey, 0, 0 FROM creator WHERE n = 0) JOIN creator USING (c_custkey)),
post AS (
  SELECT page.path, page.posts, page.created, post_row.*,
         row_number() OVER (PARTITION BY post_row.c_custkey, post_row.chunk ORDER BY o_orderkey) AS pos
  FROM post_row JOIN page ON page.c_custkey = post_row.c_custkey AND page.chunk = post_row.chunk)"""
)
_JSON_SHAPES = "(0, 1, 2, 3, 4, 10)"
_PROFILE = """
json_profile AS (
  SELECT path, created, shape = 6 AS defaulted,
    CASE shape WHEN 6 THEN 'N/A' ELSE username END AS username,
    CASE shape WHEN 6 THEN 'N/A' ELSE CAST(c_custkey AS VARCHAR) END AS user_id,
    CASE shape WHEN 6 THEN 'Unknown' WHEN 11 THEN NULL ELSE c_name END AS actual_name,
    CASE shape WHEN 6 THEN 0 WHEN 11 THEN NULL ELSE following END AS following_count,
    CASE WHEN shape IN (6, 11) THEN 0 ELSE followers END AS follower_count,
    CASE WHEN shape IN (6, 11) THEN 0 ELSE n END AS total_like_count,
    CASE WHEN shape IN (6, 11) THEN 'N/A' ELSE c_mktsegment END AS caption,
    CASE WHEN shape IN (6, 11) THEN 'No link' ELSE 'https://link.example/u' || c_custkey END AS bio_link,
    CASE shape WHEN 6 THEN 'N/A' WHEN 11 THEN NULL ELSE c_mktsegment END AS bio,
    CASE WHEN shape IN (6, 11) THEN 'N/A'
         ELSE 'https://img.example/u' || c_custkey || '.jpg' END AS profile_pic_url,
    CASE WHEN shape IN (6, 11) THEN false ELSE verified END AS is_verified
  FROM page WHERE shape NOT IN (5, 7, 8, 9)),
html_profile AS (
  SELECT path, created,
    CASE WHEN shape IN (5, 6, 9) THEN username ELSE 'N/A' END AS username,
    'N/A' AS user_id,
    CASE WHEN shape IN (5, 6, 9) THEN c_name ELSE 'Unknown' END AS actual_name,
    CASE WHEN shape IN (5, 6, 9) THEN following ELSE 0 END AS following_count,
    CASE WHEN shape IN (5, 6, 9) THEN followers ELSE 0 END AS follower_count,
    CASE WHEN shape IN (5, 6, 9) THEN n ELSE 0 END AS total_like_count,
    CASE WHEN shape IN (5, 6, 9) THEN c_mktsegment ELSE 'N/A' END AS caption,
    CASE WHEN shape IN (5, 6, 9) THEN 'https://link.example/u' || c_custkey ELSE 'No link' END AS bio_link,
    CASE WHEN shape IN (5, 6, 9) THEN c_mktsegment ELSE 'N/A' END AS bio,
    CASE WHEN shape IN (5, 6, 9) THEN 'https://img.example/u' || c_custkey || '.jpg'
         ELSE 'N/A' END AS profile_pic_url,
    CASE WHEN shape IN (5, 6, 9) THEN verified ELSE false END AS is_verified
  FROM page),
page_profile AS (
  SELECT * EXCLUDE (defaulted) FROM json_profile WHERE NOT defaulted
  UNION ALL BY NAME
  SELECT html_profile.* FROM html_profile JOIN page USING (path) WHERE shape IN (5, 6, 8, 9))"""
_VIDEO = """
json_video AS (
  SELECT path, created, o_orderkey, username,
    'https://www.tiktok.com/@' || CASE shape WHEN 6 THEN 'N/A' ELSE username END
      || '/video/' || id AS url,
    views,
    CASE shape WHEN 11 THEN 'N/A' ELSE 'https://img.example/v' || id || '.jpg' END AS thumbnail,
    CASE shape WHEN 11 THEN NULL ELSE o_orderpriority END AS description,
    CASE shape WHEN 11 THEN 'N/A' ELSE iso END AS create_time,
    CASE shape WHEN 11 THEN 0 ELSE views // 10 END AS like_count,
    CASE shape WHEN 11 THEN 0 ELSE views // 100 END AS comment_count,
    CASE shape WHEN 11 THEN 0 ELSE views // 1000 END AS share_count
  FROM post
  WHERE shape IN (0, 1, 2, 3, 4, 6, 11) OR (shape = 10 AND pos <= 2)),
html_video AS (
  SELECT path, created, o_orderkey, username, 'https://host.example/@' || username || '/video/' || id AS url,
    views, 'https://img.example/v' || id || '.jpg' AS thumbnail, o_orderpriority AS description,
    'N/A' AS create_time, views // 10 AS like_count, views // 100 AS comment_count,
    views // 1000 AS share_count
  FROM post WHERE shape = 5 OR (shape = 9 AND pos = 1)),
page_video AS (SELECT * FROM json_video UNION ALL SELECT * FROM html_video)"""
_PROFILE_COLUMNS = """username, user_id, actual_name, following_count, follower_count,
  total_like_count, caption, bio_link, bio, profile_pic_url, is_verified"""
_VIDEO_COLUMNS = """url, views, thumbnail, description, create_time, like_count, comment_count,
  share_count"""
# The tables after all pages: one row per key, the page with the last time wins.
_TABLES = f"""
profiles AS (
  SELECT {_PROFILE_COLUMNS}, created AS scrape_timestamp FROM page_profile WHERE username <> 'N/A'
  QUALIFY row_number() OVER (PARTITION BY username ORDER BY created DESC) = 1),
videos AS (
  SELECT {_VIDEO_COLUMNS}, username FROM page_video
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY created DESC, path DESC) = 1)"""
_SCRAPE = """
scrape AS (
  SELECT event_id % 1000000007 * 387420489 % 1000000007 AS arrival, 'user' || user_id AS username,
    CAST(user_id AS VARCHAR) AS user_id, event_type AS actual_name,
    CAST(0 AS BIGINT) AS following_count, CAST(round(value * 100) AS BIGINT) AS follower_count,
    CAST(0 AS BIGINT) AS total_like_count, props AS caption, 'No link' AS bio_link,
    CASE WHEN event_id % 10 <> 0 THEN event_type END AS bio, 'N/A' AS profile_pic_url,
    false AS is_verified, ts AS scrape_timestamp
  FROM events)"""
_DAY_OF_PAGE = "WITH " + _PAGE + "," + _PROFILE + "," + _VIDEO + "," + _TABLES


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


# --- messages, objects, names ---------------------------------------------------------

ORACLES["trigger_decode"] = """
SELECT conv_id, turn, text AS url, list_extract(string_split(text, '@'), -1) AS username
FROM conversations"""

ORACLES["raw_page_scan"] = """
SELECT 'page' || page_id AS creator, length(html) AS chars, md5(html) AS html_md5, true AS has_time
FROM pages"""

ORACLES["url_username"] = """
SELECT url, list_extract(string_split(url, '@'), -1) AS username
FROM (SELECT url FROM pages
      UNION ALL SELECT 'https://www.tiktok.com/@user' || c_custkey FROM customer)"""

ORACLES["path_username"] = (
    _with(_PAGE)
    + """
SELECT path, list_extract(string_split(path, '/'), -2) AS username
FROM (SELECT path FROM page UNION ALL SELECT url FROM pages)"""
)

ORACLES["landing_path"] = """
SELECT event_id,
  'profiles/user' || user_id || '/' || strftime(ts, '%Y%m%d-%H%M%S') || '.html' AS landing,
  'profiles/user' || user_id || '/' || strftime(ts, '%Y%m%d-%H%M%S') || '.json' AS profile_json,
  'videos/user' || user_id || '/' || strftime(ts, '%Y%m%d-%H%M%S') || '.json' AS video_json
FROM events"""

ORACLES["landing_dedupe"] = """
SELECT 'profiles/user' || user_id || '/' || strftime(date_trunc('hour', ts), '%Y%m%d-%H%M%S')
    || '.html' AS path,
  arg_max(props, ts) AS html, max(ts) AS time_created
FROM events GROUP BY 1"""

ORACLES["digits_to_long"] = """
SELECT c_custkey,
  TRY_CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS BIGINT) AS from_name,
  abs(CAST(round(c_acctbal * 100) AS BIGINT)) AS from_amount,
  CAST(c_nationkey AS BIGINT) * 10 + 2 AS from_suffix,
  CAST(NULL AS BIGINT) AS from_words
FROM customer"""

ORACLES["epoch_to_iso"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso,
  CAST(NULL AS VARCHAR) AS iso_of_micros
FROM orders"""

# --- the embedded document --------------------------------------------------------------

ORACLES["json_script"] = (
    _with(_PAGE)
    + """
SELECT path, shape NOT IN (5, 8, 9) AS has_script,
  CASE WHEN shape NOT IN (5, 8, 9) THEN '{"__DEFAULT_SCOPE__"' END AS head,
  CASE WHEN shape NOT IN (5, 8, 9) THEN posts END AS posts
FROM page"""
)

ORACLES["json_malformed"] = _with(_PAGE) + "\nSELECT path, shape = 7 AS malformed FROM page"

ORACLES["json_scope_gate"] = (
    _with(_PAGE) + "\nSELECT path, shape NOT IN (5, 7, 8, 9) AS gate FROM page"
)

ORACLES["json_field_default"] = """
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, 'N/A' AS absent,
  CAST(props->>'$.k' AS BIGINT) <> 0 AS k_truthy,
  CAST(props->>'$.k' AS BIGINT) IN (0, 1) AS k_is_flag
FROM events"""

ORACLES["json_shape_guard"] = """
SELECT 'profiles/user' || user_id || '/' || event_id || '.html' AS path,
  CASE event_id % 13
    WHEN 1 THEN 'user_detail_kind' WHEN 2 THEN 'user_info_kind' WHEN 3 THEN 'user_kind'
    WHEN 4 THEN 'stats_kind' WHEN 5 THEN 'bio_link_kind' WHEN 6 THEN 'document_kind'
    WHEN 7 THEN 'document_kind' WHEN 9 THEN 'malformed_json' WHEN 10 THEN 'null_username'
    WHEN 11 THEN 'profile_value_kind' WHEN 12 THEN 'profile_value_kind' END AS fault
FROM events"""

ORACLES["extract_profile_json"] = (
    _with(_PAGE, _PROFILE) + f"\nSELECT path, defaulted, {_PROFILE_COLUMNS} FROM json_profile"
)

ORACLES["extract_videos_json"] = (
    _with(_PAGE, _VIDEO) + f"\nSELECT path, {_VIDEO_COLUMNS} FROM json_video"
)

ORACLES["video_source_chain"] = (
    _with(_PAGE)
    + """
SELECT page.path, CASE WHEN shape IN (5, 7, 8, 9) THEN 0 ELSE posts END AS posts,
  CASE WHEN shape IN (5, 7, 8, 9) THEN '' ELSE coalesce(ids, '') END AS ids
FROM page LEFT JOIN
  (SELECT path, string_agg(id, ',' ORDER BY o_orderkey) AS ids FROM post GROUP BY path) USING (path)"""
)

ORACLES["video_prefix_truncation"] = (
    _with(_PAGE)
    + """
SELECT path,
  CASE WHEN shape IN (5, 7, 8, 9) THEN 0 WHEN shape = 10 THEN least(posts, 2) ELSE posts END
    AS readable,
  CASE WHEN shape = 10 THEN greatest(posts - 2, 0) ELSE 0 END AS lost
FROM page"""
)

# --- markup -------------------------------------------------------------------------------

# Raw pages without comments and without the bodies of scripts and styles.
_BARE = """
bare AS (
  SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
    '(?s)(<script[^>]*>|<style[^>]*>).*?(</script>|</style>)', '\\1\\2', 'g') AS html
  FROM pages)"""

ORACLES["html_nodes_count"] = (
    _with(_BARE)
    + """
SELECT page_id, tag, count(*) AS nodes
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM bare)
GROUP BY page_id, tag"""
)


def _text(expression: str) -> str:
    """Text of markup without tags; the entities are those the raw pages use, the
    last of a text sometimes without its semicolon."""
    bare = f"regexp_replace({expression}, '<[^>]*>', '', 'g')"
    for entity, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        bare = f"regexp_replace({bare}, '&{entity}(;|$)', '{char}', 'g')"
    return f"trim({bare})"


ORACLES["html_text_strip"] = (
    _with(_BARE)
    + f"""
SELECT page_id, {_text("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS h1 FROM bare"""
)

_HREF = "replace(replace(regexp_extract({}, '<a href=\"([^\"]*)\"', 1), '&quot;', '\"'), '&amp;', '&')"

ORACLES["html_find_first"] = (
    _with(_BARE)
    + f"""
SELECT page_id, {_HREF.format("html")} AS href,
  {_text("regexp_extract(html, '(?s)<a [^>]*>(.*?)</a>', 1)")} AS text
FROM bare"""
)

ORACLES["html_find_all"] = (
    _with(
        _BARE,
        " item AS (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS li FROM bare)",
    )
    + f"""
SELECT page_id, len(li) AS items, {_text("li[3]")} AS third, coalesce({_text("li[100]")}, 'none')
  AS hundredth
FROM item"""
)

ORACLES["html_attr"] = (
    _with(
        _BARE,
        " link AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*>') AS tags FROM bare)",
        """ numbered AS (
  SELECT page_id, unnest(tags) AS tag, unnest(range(len(tags))) AS place FROM link)""",
    )
    + f"""
SELECT page_id, place, {_HREF.format("tag")} AS href, true AS no_rel FROM numbered"""
)

ORACLES["html_class_regex"] = (
    _with(_BARE)
    + """
SELECT page_id, len(regexp_extract_all(html, '<div class="ad"')) AS boxes,
  CASE WHEN contains(html, '<div class="ad"') THEN 'ad' END AS first_class
FROM bare"""
)

ORACLES["extract_profile_html"] = (
    _with(_PAGE, _PROFILE) + f"\nSELECT path, {_PROFILE_COLUMNS} FROM html_profile"
)

ORACLES["extract_videos_html"] = (
    _with(_PAGE, _VIDEO) + f"\nSELECT path, {_VIDEO_COLUMNS} FROM html_video"
)

ORACLES["html_profile_freeze"] = """
SELECT 'p/' || c_custkey AS path, CAST(c_custkey % 6 AS INTEGER) AS failed_step,
  c_name AS username, 'N/A' AS user_id, 'Unknown' AS actual_name,
  CASE WHEN c_custkey % 6 = 1 THEN 0 ELSE CAST(c_nationkey AS BIGINT) END AS following_count,
  CASE WHEN c_custkey % 6 IN (1, 2) THEN 0 ELSE c_custkey END AS follower_count,
  CASE WHEN c_custkey % 6 IN (1, 2, 3) THEN 0 ELSE c_custkey END AS total_like_count,
  CASE WHEN c_custkey % 6 IN (1, 2, 3) THEN 'N/A' ELSE c_mktsegment END AS caption,
  CASE WHEN c_custkey % 6 IN (1, 2, 3, 4) THEN 'No link' ELSE '/me' END AS bio_link,
  CASE WHEN c_custkey % 6 IN (1, 2, 3) THEN 'N/A' ELSE c_mktsegment END AS bio,
  CASE WHEN c_custkey % 6 = 0 THEN 'me.jpg' ELSE 'N/A' END AS profile_pic_url,
  c_custkey % 6 = 0 AS is_verified
FROM customer"""

ORACLES["html_alt_container"] = (
    _with(_PAGE)
    + """
SELECT path, CASE WHEN shape = 5 THEN posts ELSE 0 END AS posts,
  CAST(CASE WHEN shape = 9 THEN 1 ELSE 0 END AS BIGINT) AS feeds
FROM page"""
)

# --- whole pages -----------------------------------------------------------------------------

ORACLES["fallback_profile"] = (
    _with(_PAGE)
    + """
SELECT path,
  CASE WHEN shape = 7 THEN NULL WHEN shape IN (5, 6, 8, 9) THEN 'html' ELSE 'json' END
    AS profile_source,
  CASE WHEN shape = 7 THEN NULL WHEN shape = 8 THEN 'N/A' ELSE username END AS username
FROM page"""
)

_VIDEO_COUNTS = """
counted AS (
  SELECT path, shape,
    CASE WHEN shape IN (5, 7, 8, 9) THEN 0 WHEN shape = 10 THEN least(posts, 2) ELSE posts END AS j,
    CASE WHEN shape = 5 THEN posts WHEN shape = 9 THEN least(posts, 1) ELSE 0 END AS h
  FROM page)"""

ORACLES["fallback_videos"] = (
    _with(_PAGE, _VIDEO_COUNTS)
    + """
SELECT path, CASE WHEN shape = 7 THEN NULL WHEN j > 0 THEN 'json' ELSE 'html' END AS video_source,
  j + h AS videos
FROM counted"""
)

ORACLES["quarantine_reasons"] = (
    _with(_PAGE)
    + """
SELECT CASE shape WHEN 7 THEN 'page' ELSE 'videos' END AS scope,
  CASE shape WHEN 7 THEN 'malformed_json' ELSE 'unreadable_post' END AS reason,
  count(*) AS entries,
  CAST(sum(CASE shape WHEN 7 THEN 0 ELSE posts - 2 END) AS BIGINT) AS lost
FROM page WHERE shape = 7 OR (shape = 10 AND posts > 2) GROUP BY 1, 2"""
)

ORACLES["extraction_counts"] = (
    _with(_PAGE, _VIDEO_COUNTS)
    + "\nSELECT path, j AS json_videos, h AS html_videos, j + h AS videos FROM counted"
)

ORACLES["page_profiles"] = (
    _with(_PAGE, _PROFILE)
    + f"\nSELECT {_PROFILE_COLUMNS}, created AS scrape_timestamp FROM page_profile"
)
ORACLES["ndjson_profiles"] = ORACLES["page_profiles"]

ORACLES["page_videos"] = _with(_PAGE, _VIDEO) + f"\nSELECT {_VIDEO_COLUMNS} FROM page_video"
ORACLES["ndjson_roundtrip"] = ORACLES["page_videos"]

ORACLES["filter_invalid_profiles"] = (
    _with(_PAGE, _PROFILE)
    + """
SELECT username, actual_name, follower_count FROM page_profile WHERE username <> 'N/A'"""
)

# --- latest state -----------------------------------------------------------------------------

_LOG = f"{_PROFILE_COLUMNS}, scrape_timestamp"


def _last(order: str, source: str = "scrape") -> str:
    return (
        f"SELECT {_LOG} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY username ORDER BY {order} DESC) = 1"
    )


ORACLES["latest_profile"] = _with(_SCRAPE) + "\n" + _last("scrape_timestamp")
ORACLES["latest_profile_arrival"] = _with(_SCRAPE) + "\n" + _last("arrival")
ORACLES["latest_table"] = ORACLES["latest_profile"]
ORACLES["stream_latest"] = ORACLES["latest_profile_arrival"]


def _merged(log: str, columns: str, key: str) -> str:
    """First part of a log updated by the rest: full join, the rest decides where present."""
    names = [name.strip() for name in columns.split(",")]
    half = "arrival < 500000003"
    last = f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY arrival DESC) = 1"
    picks = ",\n  ".join(
        f"CASE WHEN new.{key} IS NOT NULL THEN new.{name} ELSE old.{name} END AS {name}"
        for name in names
    )
    return (
        f"{log},\n"
        f"old AS (SELECT * FROM log WHERE {half} {last}),\n"
        f"new AS (SELECT * FROM log WHERE NOT ({half}) {last})\n"
        f"SELECT {picks}\nFROM old FULL JOIN new ON old.{key} = new.{key}"
    )


ORACLES["merge_profiles"] = _merged(
    _with(_SCRAPE, " log AS (SELECT * FROM scrape)"), _LOG, "username"
)

ORACLES["merge_videos"] = _merged(
    """WITH log AS (
  SELECT (l_orderkey * 8 + l_linenumber) % 1000000007 * 387420489 % 1000000007 AS arrival,
    'https://host.example/@user' || l_suppkey || '/video/' || l_partkey AS url,
    CAST(round(l_extendedprice) AS BIGINT) AS views, 't' || l_orderkey AS thumbnail,
    CASE WHEN l_linenumber % 3 <> 0 THEN l_linestatus END AS description,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS create_time,
    CAST(l_quantity AS BIGINT) AS like_count, l_orderkey AS comment_count,
    CAST(l_linenumber AS BIGINT) AS share_count
  FROM lineitem)""",
    _VIDEO_COLUMNS,
    "url",
)

ORACLES["stream_profiles"] = _DAY_OF_PAGE + f"\nSELECT {_PROFILE_COLUMNS}, scrape_timestamp FROM profiles"
ORACLES["stream_two_feeds"] = ORACLES["stream_profiles"]
ORACLES["stream_videos"] = _DAY_OF_PAGE + f"\nSELECT {_VIDEO_COLUMNS} FROM videos"

ORACLES["object_stream"] = "SELECT 'page' || page_id AS creator, md5(html) AS html_md5 FROM pages"
ORACLES["stream_chain"] = (
    _DAY_OF_PAGE
    + """
SELECT username, follower_count,
  TIMESTAMP '2024-06-01 00:00:00' + to_seconds(CAST(substr(username, 5) AS BIGINT)) AS scrape_timestamp
FROM profiles WHERE CAST(substr(username, 5) AS BIGINT) % 50 <> 1
UNION ALL
SELECT 'rejected', NULL, TIMESTAMP '2024-06-01 00:00:00' + to_seconds(c_custkey)
FROM customer WHERE c_custkey % 50 = 1"""
)
ORACLES["catalog_tables"] = ORACLES["stream_videos"]
ORACLES["profile_history"] = (
    _DAY_OF_PAGE
    + """
SELECT username, CAST(created AS DATE) AS day, arg_max(follower_count, created) AS follower_count,
  count(*) AS scrapes
FROM page_profile WHERE username <> 'N/A' GROUP BY 1, 2"""
)
ORACLES["message_log"] = """
SELECT concat_ws(':', conv_id, turn, role, md5(text)) AS message, 1717200000 + turn AS seconds FROM conversations"""
ORACLES["overwrite_audit"] = (
    _with(_SCRAPE)
    + """
SELECT username, arrival, scrape_timestamp, lag(arrival) OVER held AS replaced_arrival,
  lag(scrape_timestamp) OVER held AS replaced_timestamp
FROM scrape WINDOW held AS (PARTITION BY username ORDER BY arrival)
QUALIFY scrape_timestamp < lag(scrape_timestamp) OVER held"""
)
ORACLES["batch_counts"] = (
    _with(_PAGE, _PROFILE, _VIDEO_COUNTS)
    + """
SELECT (SELECT count(*) FROM page) AS pages, (SELECT count(*) FROM page_profile) AS profiles,
  (SELECT CAST(sum(j + h) AS BIGINT) FROM counted) AS videos,
  (SELECT CAST(coalesce(sum(posts - 2), 0) AS BIGINT) FROM page WHERE shape = 10 AND posts > 2) AS lost_posts"""
)
ORACLES["history_state"] = ORACLES["profile_history"]
ORACLES["catalog_upsert"] = ORACLES["merge_videos"]
ORACLES["object_arrivals"] = "SELECT md5(html) AS html_md5, length(html) AS chars FROM pages"
ORACLES["quarantine_inputs"] = """
SELECT CASE event_id % 5 WHEN 1 THEN '' ELSE 'profiles/user' || user_id || '/' END || event_id || '.html' AS path,
  CASE event_id % 5 WHEN 3 THEN 'videos' ELSE 'page' END AS scope,
  CASE event_id % 5 WHEN 0 THEN 'invalid_utf8' WHEN 1 THEN 'path_without_folder'
    WHEN 2 THEN 'unreadable_markup' ELSE 'video_value_kind' END AS reason
FROM events WHERE event_id % 5 < 4"""

# --- dashboard ----------------------------------------------------------------------------------

ORACLES["followers_per_creator"] = (
    _DAY_OF_PAGE
    + """
SELECT username, follower_count FROM profiles ORDER BY follower_count DESC NULLS LAST, username"""
)

ORACLES["total_followers"] = (
    _DAY_OF_PAGE
    + "\nSELECT CAST(sum(follower_count) AS BIGINT) AS total_followers FROM profiles"
)

ORACLES["verified_share"] = (
    _DAY_OF_PAGE
    + """
SELECT is_verified, count(*) AS creators,
  round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 1) AS percent
FROM profiles GROUP BY is_verified"""
)

ORACLES["followers_vs_likes"] = (
    _DAY_OF_PAGE + "\nSELECT username, follower_count, total_like_count FROM profiles"
)

ORACLES["followers_likes_correlation"] = (
    _DAY_OF_PAGE
    + """
SELECT round(corr(follower_count, total_like_count), 6) AS correlation, count(*) AS creators
FROM profiles"""
)

ORACLES["trend_by_day"] = (
    _DAY_OF_PAGE
    + """
SELECT CAST(create_time AS DATE) AS day, count(*) AS videos, CAST(sum(views) AS BIGINT) AS views,
  CAST(sum(like_count) AS BIGINT) AS likes
FROM videos WHERE create_time <> 'N/A' GROUP BY 1"""
)

ORACLES["follower_history"] = (
    _with(_SCRAPE)
    + """
SELECT username, CAST(scrape_timestamp AS DATE) AS day,
  arg_max(follower_count, scrape_timestamp) AS follower_count, count(*) AS scrapes
FROM scrape GROUP BY 1, 2"""
)

_RATE = "CAST({0}like_count{1} + {0}comment_count{1} + {0}share_count{1} AS DOUBLE) / nullif({0}views{1}, 0)"

ORACLES["engagement_video"] = (
    _DAY_OF_PAGE + f"\nSELECT url, {_RATE.format('', '')} AS engagement_rate FROM videos"
)

ORACLES["engagement_creator"] = (
    _DAY_OF_PAGE
    + f"""
SELECT username, count(*) AS videos, {_RATE.format("sum(", ")")} AS engagement_rate
FROM videos GROUP BY 1"""
)

ORACLES["creator_video_rollup"] = (
    _DAY_OF_PAGE
    + """,
summed AS (
  SELECT username, count(*) AS videos, CAST(sum(views) AS BIGINT) AS views,
    CAST(sum(like_count) AS BIGINT) AS like_count
  FROM videos GROUP BY 1)
SELECT username, follower_count, is_verified, videos, views, like_count
FROM summed LEFT JOIN profiles USING (username)"""
)

ORACLES["top_videos"] = (
    _DAY_OF_PAGE
    + "\nSELECT url, views, description FROM videos ORDER BY views DESC NULLS LAST, url LIMIT 10"
)
