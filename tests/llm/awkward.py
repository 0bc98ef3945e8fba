"""Documents with everything that is awkward: nulls, empty and very long texts, ties, repeats, clashing names."""

from __future__ import annotations

CLASHING = [
    "n_words", "n_tokens", "size", "found", "personal", "secrets", "toxicity", "kept", "shard", "slot",
    "copies", "row", "unit", "path", "class", "t", "k", "k1", "words", "host", "rule", "n_lines",
]
LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(60_000))


def documents(spark, texts=None):
    """``documents`` with extra columns of clashing names."""
    if texts is None:
        body = " ".join(f"word{i}" for i in range(80))
        texts = [None, "", " \n\t ", body, body, body + " more", LONG, "é 😀 \x00 x", "a" * 5000, body]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, "no id at all", None, None, None), (3, "same id, other text", "en", "s1", 1)]
    if len(texts) > 3:
        rows += [rows[3], rows[3]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.selectExpr("*", *(f"'x' AS `{name}`" for name in CLASHING))


def empty(spark):
    return documents(spark).where("false")


def plain(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
