"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelbook.llm import (
    decontaminate,
    grammar,
    mixing,
    periodic,
    pii,
    quality,
    secrets,
    sharding,
    similarity,
    tokens,
    toxicity,
    urls,
    whitening,
)
from reelbook.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hit_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_digest(table(spark, sf_dir, "pages"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.similarity_digest(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_digest(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_digest(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digest(table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return grammar.id_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_mixing,
        op3_sharding,
        op4_decontamination,
        op5_url_filter,
        op6_jaccard_join,
        op7_personal_data,
        op8_secrets,
        op9_quality_rules,
        op10_toxicity,
        op11_whitening,
        op12_periodic_runs,
        op13_token_files,
    )
}

ORACLES: dict[str, str] = {}

# The rules as a table; the longest of those that fit a URL wins.
ORACLES["op5_url_filter"] = """
WITH rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
parts AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
fitting AS (
  SELECT s.page_id, r.rhost || r.rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rhost || r.rpath) DESC, length(r.rhost) DESC) AS n
  FROM split s JOIN rules r
    ON (s.host = r.rhost OR ends_with(s.host, '.' || r.rhost)) AND starts_with(s.path, r.rpath))
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM split s LEFT JOIN fitting f ON f.page_id = s.page_id AND f.n = 1
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

# Windows as texts of joined words, looked up by length and text.
ORACLES["op4_decontamination"] = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT *, least(len(words), {decontaminate.WINDOW}) AS size FROM item WHERE len(words) > 0),
gram AS (
  SELECT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM sized)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
place AS (
  SELECT r, i, size, array_to_string(words[i:i + size - 1], ' ') AS gram
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM doc CROSS JOIN (SELECT DISTINCT size FROM sized))),
found AS (SELECT r, i, size, item_id FROM place JOIN gram USING (size, gram)),
hit AS (SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS w FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

# Every pair of sets that shares an n-gram, compared whole.
ORACLES["op6_jaccard_join"] = f"""
WITH RECURSIVE doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
listed AS (
  SELECT r, doc_id,
    CASE WHEN len(words) >= {similarity.WORDS}
      THEN list_transform(range(1, len(words) - {similarity.WORDS - 2}), lambda i: array_to_string(words[i:i + {similarity.WORDS - 1}], ' '))
      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS grams
  FROM doc),
keyed AS (SELECT r, doc_id, list_sort(list_distinct(grams)) AS grams FROM listed),
sets AS (
  SELECT row_number() OVER () AS s, grams, len(grams) AS n, count(*) AS weight, min(doc_id) AS copy_id
  FROM keyed WHERE len(grams) > 0 GROUP BY grams),
held AS (SELECT s, n, unnest(grams) AS gram FROM sets),
pair AS (
  SELECT a.s AS a, b.s AS b FROM held a JOIN held b ON a.gram = b.gram AND a.s <> b.s
  GROUP BY a.s, b.s, a.n, b.n HAVING {sum(similarity.SIMILAR)} * count(*) >= {similarity.SIMILAR[0]} * (a.n + b.n)),
reach AS (SELECT s AS a, s AS b FROM sets UNION SELECT reach.a, pair.b FROM reach JOIN pair ON pair.a = reach.b),
class AS (SELECT reach.a AS s, min(copy_id) AS class_id FROM reach JOIN sets ON sets.s = reach.b GROUP BY reach.a),
degree AS (SELECT pair.a AS s, CAST(sum(weight) AS BIGINT) AS links FROM pair JOIN sets ON sets.s = pair.b GROUP BY pair.a)
SELECT keyed.doc_id, CASE WHEN s IS NULL THEN keyed.doc_id ELSE class_id END AS class_id,
  CASE WHEN s IS NULL THEN keyed.doc_id ELSE copy_id END AS copy_id,
  CASE WHEN s IS NULL THEN 0 ELSE weight - 1 + coalesce(links, 0) END AS n_links
FROM keyed LEFT JOIN sets USING (grams) LEFT JOIN class USING (s) LEFT JOIN degree USING (s)
"""


def _secret_spans(number: int, form: secrets.Form) -> str:
    """Matches of a form with their places: lengths of pieces and matches before them, added up."""
    pattern = form.pattern.replace("'", "''")
    return rf"""
  SELECT r, doc_id, source, {number} AS no, '{form.kind}' AS kind, value,
    CAST(list_sum(list_transform(pieces[1:i], lambda p: length(p)))
      + coalesce(list_sum(list_transform(matches[1:i - 1], lambda m: length(m))), 0) AS BIGINT) AS start,
    length(matches[i]) AS size
  FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i, unnest(vals) AS value
        FROM (SELECT r, doc_id, source, string_split_regex(t, '{pattern}') AS pieces,
                regexp_extract_all(t, '{pattern}') AS matches, regexp_extract_all(t, '{pattern}', {form.group}) AS vals
              FROM doc WHERE regexp_matches(t, '{pattern}')))
  WHERE length(value) >= {form.least}"""


_BASE_SECRETS = ", ".join(f"'{form.kind}'" for form in secrets.BASE)

ORACLES["op8_secrets"] = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
span AS ({" UNION ALL ".join(_secret_spans(i, form) for i, form in enumerate(secrets.FORMS))}),
owned AS (
  SELECT value, count(*) AS n_owners
  FROM (SELECT DISTINCT value, source FROM span) GROUP BY value),
shown AS (
  SELECT r, kind || ':' || start || ':' || (start + size) AS shown, start, no, kind,
    n_owners >= {secrets.EXAMPLE_OWNERS} AS example
  FROM span JOIN owned USING (value)),
summed AS (
  SELECT r, string_agg(shown, ',' ORDER BY start, no) AS spans,
    string_agg(shown, ',' ORDER BY start, no) FILTER (kind IN ({_BASE_SECRETS})) AS base,
    {", ".join(f"count(*) FILTER (kind = '{form.kind}') AS n_{form.kind}" for form in secrets.BASE)},
    count(*) FILTER (NOT example) AS n_live, count(*) FILTER (example) AS n_example
  FROM shown GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{form.kind}, 0) AS n_{form.kind}" for form in secrets.BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM doc LEFT JOIN summed USING (r)
"""


def _level(name: str, keys: str) -> str:
    """Size and quartiles of the groups of ``keys``, of rows that pass the fixed rules."""
    quartiles = ", ".join(
        f"quantile_disc({m}, {r}) FILTER (NOT base_failed) AS {m}_{q}"
        for m in quality.MEASURES
        for q, r in (("q1", 0.25), ("q3", 0.75))
    )
    group = f"GROUP BY {keys}" if keys else ""
    return f"{name} AS (SELECT {keys + ', ' if keys else ''}count(*) FILTER (NOT base_failed) AS n, {quartiles} FROM measured {group})"


def _within(measure: str, side: str, least: float) -> str:
    def of(q: str) -> str:
        column = f"{measure}_{q}"
        return (
            f"(CASE WHEN small.n >= {quality.GROUP_ROWS} THEN small.{column} "
            f"WHEN large.n >= {quality.GROUP_ROWS} THEN large.{column} ELSE whole.{column} END)"
        )

    reach = f"greatest({quality.REACH} * ({of('q3')} - {of('q1')}), {least})"
    high = f"coalesce(m.{measure} <= ceil(({of('q3')} + {reach}) * 100) / 100, true)"
    low = f"coalesce(m.{measure} >= floor(({of('q1')} - {reach}) * 100) / 100, true)"
    return f"{high} AND {low}" if side == "both" else high


# The quartiles are exact here; a sketch's are, too, up to some thousand rows of a group.
ORACLES["op9_quality_rules"] = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^ \t-\r]')) AS lines
  FROM documents),
word AS (SELECT r, generate_subscripts(words, 1) AS i, unnest(words) AS w FROM doc),
three AS (
  SELECT r, i, w, lead(w) OVER next AS second, lead(w, 2) OVER next AS third
  FROM word WINDOW next AS (PARTITION BY r ORDER BY i)),
gram AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w, second, third) AS n FROM three WHERE third IS NOT NULL),
again AS (
  SELECT r, count(DISTINCT w) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + 3)) AS w FROM gram WHERE n > 1) GROUP BY r),
counted AS (
  SELECT r, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM doc LEFT JOIN again USING (r)),
measured AS MATERIALIZED (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_share, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS line_share,
    coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_share, coalesce(word_chars / nullif(n_words, 0), 0) AS word_length
  FROM counted),
{_level("small", "lang, source")},
{_level("large", "lang")},
{_level("whole", "")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(_within(m, side, least) for m, (side, least) in quality.MEASURES.items())} AS kept
FROM measured m
JOIN small ON small.lang IS NOT DISTINCT FROM m.lang AND small.source IS NOT DISTINCT FROM m.source
JOIN large ON large.lang IS NOT DISTINCT FROM m.lang CROSS JOIN whole
"""
