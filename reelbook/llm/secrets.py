"""Secret scan with the ownership of every candidate over the whole corpus.

Candidates are found with their places by built-in functions. Each candidate value
is hashed and counted over all documents by distinct repositories and owners. A
value that several owners have is a copied example; one that stays with few owners
looks like a live credential.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelbook.llm.common import fields, named, saved, text_or_empty


@dataclass(frozen=True)
class Form:
    """How a kind of secret looks: ``group`` is its value, of ``least`` characters at least."""

    kind: str
    pattern: str
    group: int
    least: int


#: Kinds with a fixed definition, in the order that breaks ties of the start. A match whose value
#: is too short is dropped after it has been read, so that nothing inside it is tried again.
BASE = (
    Form(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Form("access", r"(AKIA[A-Z0-9]+)", 1, 16),
    Form("hex", r"([0-9a-f]{32,})", 1, 32),
)
#: Further kinds: tokens that carry their issuer, signed web tokens, heads of private keys.
MORE = (
    Form("issued", r"((?:gh[pousr]_[A-Za-z0-9]|xox[abprs]-[A-Za-z0-9]|sk_live_[A-Za-z0-9])[A-Za-z0-9-]+)", 1, 20),
    Form("signed", r"(eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)", 1, 40),
    Form("private", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, 20),
)
FORMS = BASE + MORE
#: Distinct owners from which on a value counts as a widely copied example.
EXAMPLE_OWNERS = 3

_SPAN = "array<struct<start:bigint,kind_no:int,stop:bigint,value_hash:string>>"


def _spans(text: Column, number: int, form: Form) -> Column:
    """Places of a form in ``text``, counted in code points.

    Cut at the matches, a text gives the pieces between them; the lengths of pieces
    and matches, added up from the left, are the places.
    """
    pieces = F.split(text, form.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(form.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(form.pattern), F.lit(form.group))
    parts = F.arrays_zip(pieces.alias("piece"), matches.alias("match"), values.alias("value"))

    def add(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["piece"])
        stop = start + F.length(part["match"])
        span = F.struct(
            start.alias("start"), F.lit(number).alias("kind_no"), stop.alias("stop"), F.md5(part["value"]).alias("value_hash")
        )
        fits = F.length(part["value"]) >= form.least
        found = F.when(fits, F.array(span)).otherwise(F.array().cast(_SPAN))
        return F.struct(stop.alias("at"), F.concat(done["spans"], found.cast(_SPAN)).alias("spans"))

    # the last piece has no match after it
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPAN).alias("spans"))
    end = F.lit(None).cast(f"struct<at:bigint,spans:{_SPAN}>")
    folded = F.aggregate(F.filter(parts, lambda p: p["match"].isNotNull()), start, lambda d, p: F.coalesce(add(d, p), end))
    return F.when(text.rlike(form.pattern), folded["spans"]).otherwise(F.array().cast(_SPAN))


def find_secrets(
    docs: DataFrame, text: str = "text", repository: str = "doc_id", owner: str = "source"
) -> DataFrame:
    """``docs`` without ``text`` and with ``secrets``: per candidate ``start``, ``stop``, ``kind``,
    ``value_hash``, ``n_repositories``, ``n_owners`` and ``verdict`` (``example`` or ``live``).

    Offsets count code points; order is by start and then kind. A null or empty text
    has none; null repositories and owners count as one of each; repeated rows keep
    their rows and do not raise the counts. Texts of any length are read whole; without
    rows the result is empty. Other columns pass through whatever they are called, an
    input column ``secrets`` is replaced. The texts are read once; what is shuffled are
    candidates, summed up per task first.
    """
    keep = [c for c in docs.columns if c not in (text, "secrets")]
    body = text_or_empty(text)
    spans = F.array_sort(F.concat(*(_spans(body, i, form) for i, form in enumerate(FORMS))))
    rows = docs.select(
        F.monotonically_increasing_id().alias("__row"),
        F.struct(*map(named, keep)).alias("__kept"),
        named(repository).alias("__repository"),
        named(owner).alias("__owner"),
        spans.alias("__spans"),
    )
    rows = saved(rows, "candidates")
    each = rows.where(F.size("__spans") > 0).select("__row", "__repository", "__owner", F.inline("__spans"))
    # copies of a value in one repository, repositories of one owner, owners: each step narrows the next
    owned = each.groupBy("value_hash", "__owner", "__repository").agg(F.lit(1).alias("one"))
    owned = owned.groupBy("value_hash", "__owner").agg(F.sum("one").alias("n"))
    owned = owned.groupBy("value_hash").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))
    kinds = F.array(*(F.lit(f.kind) for f in FORMS))
    judged = each.join(owned, "value_hash").select(
        "__row",
        F.struct(
            "start",
            "kind_no",
            "stop",
            F.get(kinds, F.col("kind_no")).alias("kind"),
            "value_hash",
            "n_repositories",
            "n_owners",
            F.when(F.col("n_owners") >= EXAMPLE_OWNERS, F.lit("example")).otherwise(F.lit("live")).alias("verdict"),
        ).alias("s"),
    )
    judged = judged.groupBy("__row").agg(F.sort_array(F.collect_list("s")).alias("secrets"))
    secrets = F.transform(F.coalesce("secrets", F.array().cast(judged.schema["secrets"].dataType)), lambda s: s.dropFields("kind_no"))
    return rows.join(judged, "__row", "left").select(*fields("__kept", keep), secrets.alias("secrets"))


def secret_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, a count for each base kind, ``base_sha256``, ``spans``, ``n_live``, ``n_example``."""
    rows = find_secrets(docs.select("doc_id", "text", "source"))
    base = [f.kind for f in BASE]

    def count(test) -> Column:
        return F.size(F.filter("secrets", test)).cast("long")

    def shown(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")

    return rows.select(
        "doc_id",
        *(F.array_size(F.filter("secrets.kind", F.lit(kind).eqNullSafe)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(shown(F.filter("secrets", lambda s: s.kind.isin(*base))), 256).alias("base_sha256"),
        shown(F.col("secrets")).alias("spans"),
        count(lambda s: s.verdict == "live").alias("n_live"),
        count(lambda s: s.verdict == "example").alias("n_example"),
    )
