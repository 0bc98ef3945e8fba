"""Quality rules with thresholds that adapt to each language and source.

Every document is measured once. Mergeable quantile sketches of the measures are
built per language and source; the sketches of small groups give way to the merged
sketches of their language, and those to the sketch of all. A document is rejected
if a measure lies far outside the middle half of its group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelbook.llm.common import BLANKS, fields, maybe_broadcast, named, saved, text_or_empty, whole_row

#: Items a sketch keeps at its finest level; ranks are then good to about 0.1 percent.
SKETCH_K = 2048
#: Documents that a group needs for thresholds of its own.
GROUP_ROWS = 200
#: Widths of the middle half that a measure may lie above the third quartile (or below the first).
REACH = 6.0
#: Measure -> (side that is bad, least distance from the middle half that counts).
MEASURES = {
    "symbol_share": ("high", 0.05),
    "line_share": ("high", 0.50),
    "repeat_share": ("high", 0.45),
    "word_length": ("both", 3.0),
}


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed`` and ``n_lines`` (lines with a word).

    Each step stands in a projection of its own and is read more than once by the
    next, so the optimizer keeps it as a column instead of computing it again for
    every element of an array. Nothing is longer than the text or slower than a sort.
    """
    names = ("words", "lines", "grams", "ordered", "places")
    hidden = {n: f"__{n}" for n in names}
    words, lines, grams, ordered, places = (F.col(hidden[n]) for n in names)
    body = text_or_empty(text)
    trimmed = F.btrim(body, F.lit(BLANKS))
    none = F.array().cast("array<string>")
    split = F.split(trimmed, r"[ \t-\r]+", -1)
    has_word = lambda line: F.btrim(line, F.lit(BLANKS)) != ""
    gram = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    rows = docs.withColumns(
        {
            hidden["words"]: F.when(trimmed == "", none).otherwise(split),
            hidden["lines"]: F.filter(F.split(body, "\n", -1), has_word),
            "n_symbols": F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long"),
        }
    )
    rows = rows.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            hidden["grams"]: F.when(F.size(words) >= 3, F.transform(F.sequence(F.lit(0), F.size(words) - 3), gram)),
        }
    ).drop(hidden["words"], hidden["lines"])
    # grams beside their places, sorted: equal ones are neighbours
    repeated = F.size(F.array_distinct(grams)) < F.size(grams)
    beside = F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    rows = rows.withColumn(hidden["ordered"], F.when(repeated, F.sort_array(beside))).drop(hidden["grams"])
    same = lambda x, k: F.coalesce(F.get(ordered, k)["g"] == x["g"], F.lit(False))
    found = F.filter(ordered, lambda x, k: same(x, k - 1) | same(x, k + 1))
    rows = rows.withColumn(hidden["places"], F.sort_array(F.transform(found, lambda x: x["i"]))).drop(hidden["ordered"])
    # a window covers three words, or as many as are left before the next window
    covered = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda n, x: n + x)
    rows = rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop(hidden["places"])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def _measures() -> dict[str, Column]:
    return {
        "symbol_share": _share("n_symbols", "word_chars"),
        "line_share": _share("n_dup_lines", "n_lines"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "word_length": _share("word_chars", "n_words"),
    }


def thresholds(rows: DataFrame, keys: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """One row per group of ``keys``: ``n`` and, per measure, ``<measure>_low`` and ``_high``.

    Rows that fail the fixed rules take no part: they would widen the middle half.
    """
    large = keys[0]
    good = ~F.col("base_failed")
    sketches = [F.kll_sketch_agg_double(F.when(good, c), SKETCH_K).alias(m) for m, c in _measures().items()]
    groups = rows.groupBy(*keys).agg(F.count_if(good).alias("n"), *sketches)
    groups = saved(groups, "sketches")
    merged = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(m, SKETCH_K).alias(m) for m in MEASURES)]
    by_large = groups.groupBy(large).agg(*merged).select(
        F.col(large).alias("__large"), *(F.col(c).alias(f"__1_{c}") for c in ("n", *MEASURES))
    )
    # one row, of four sketches of bounded size
    whole = groups.agg(*merged).first()
    levels = groups.join(by_large, F.col(large).eqNullSafe(F.col("__large")), "left")
    out: list[Column] = [*map(F.col, keys), F.col("n")]
    for m, (side, least) in MEASURES.items():
        sketch = (
            F.when(F.col("n") >= GROUP_ROWS, F.col(m))
            .when(F.col("__1_n") >= GROUP_ROWS, F.col(f"__1_{m}"))
            .otherwise(F.lit(None if whole[m] is None else bytes(whole[m])).cast("binary"))
        )
        n = F.kll_sketch_get_n_double(sketch)
        q1, q3 = (F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(r))) for r in (0.25, 0.75))
        reach = F.greatest(REACH * (q3 - q1), F.lit(least))
        # in steps of a hundredth: a sketch's quantiles may differ a little between runs
        high, low = F.ceil((q3 + reach) * 100) / 100, F.floor((q1 - reach) * 100) / 100
        out += [high.alias(f"{m}_high"), (low if side == "both" else F.lit(None).cast("double")).alias(f"{m}_low")]
    return levels.select(*out)


def judge(docs: DataFrame, keys: tuple[str, str] = ("lang", "source"), text: str = "text") -> DataFrame:
    """``docs`` with what :func:`measured` adds and ``kept``.

    Null keys form groups of their own. A null or empty text has no words and fails
    the fixed rules; a very long one is measured whole. Repeated rows are judged alike
    and all stay; without rows the result is empty. Input columns with the names added
    here are replaced (:func:`keep_good` keeps them); no other name matters. One scan of
    the texts: the thresholds are built from the measured rows, which are written once.
    """
    mine = [c for c in docs.columns if c not in ADDED]
    return _judged(docs, keys, text).select(*fields("row", mine), *ADDED)


def _judged(docs: DataFrame, keys: tuple[str, str], text: str) -> DataFrame:
    """``row`` (all columns given) beside what :func:`measured` adds and ``kept``."""
    large, small = keys
    packed = docs.select(
        whole_row(docs).alias("row"), named(large).alias("large"), named(small).alias("small"), named(text).alias("text")
    )
    return _kept(saved(measured(packed).drop("text"), "measured"), ("large", "small"))


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "base_failed", "kept")


def _kept(rows: DataFrame, keys: tuple[str, str]) -> DataFrame:
    limits = saved(thresholds(rows, keys), "thresholds")
    names = [c for c in limits.columns if c not in (*keys, "n")]
    limits = limits.select(
        *(F.col(k).alias(f"__key_{k}") for k in keys), *(F.col(c).alias(f"__{c}") for c in names)
    )
    limits = maybe_broadcast(limits, limits.count())
    same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
    rows = rows.join(limits, same, "left")
    fine = ~F.col("base_failed")
    for m, value in _measures().items():
        for side in ("high", "low"):
            limit = F.col(f"__{m}_{side}")
            outside = value > limit if side == "high" else value < limit
            fine = fine & ~F.coalesce(outside, F.lit(False))
    return rows.withColumn("kept", fine)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns and the values they had.

    Nulls, empty and long texts, repeated rows and empty tables are treated as by
    :func:`judge`; no name of an input column matters.
    """
    settings = {"keys": ("lang", "source"), "text": "text"} | options
    return _judged(docs, **settings).where("kept").select(*fields("row", docs.columns))


def quality_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measures of the fixed rules, ``base_failed`` and ``kept``."""
    rows = saved(measured(docs.select("doc_id", "text", "lang", "source")).drop("text"), "measured")
    return _kept(rows, ("lang", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
