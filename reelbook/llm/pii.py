"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one walk: at-signs, plus
signs, digits, schemes and words that announce an account. A small parser per kind
then expands from the anchor to both sides and validates what it has read. A parser
never looks back behind the end of its last find, so the work is linear in the text.
"""

from __future__ import annotations

import sys
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Python workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Kinds in the order that breaks ties of the start.
KINDS = ("email", "ip", "card", "phone", "account", "address")
#: Kinds with a fixed definition; the others are what the anchors add.
BASE = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_AFTER_PLUS = re.compile(r"[0-9][ ().0-9-]*")
_USERINFO = re.compile(r"[^\s/?#@]+:[^\s/?#@]+@[^\s/?#]+")
_IBAN = re.compile(r"[ :#=]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})")
_NUMBER = re.compile(r"(?: (?:number|no\.?|nr\.?))?[ :#=]{1,3}([0-9](?:[ -]?[0-9]){7,19})(?![0-9])")

#: Anchor texts and the parser that each calls. Letters match in lower case as written here.
ANCHORS = (
    {"@": "email", "+": "phone"}
    | {d: "digits" for d in "0123456789"}
    | {s + "://": "address" for s in ("http", "https", "ftp", "ssh", "postgres", "mysql", "mongodb")}
    | {w: "iban" for w in ("IBAN", "iban", "Iban")}
    | {w: "account" for w in ("account", "Account", "acct", "Acct", "a/c")}
)


def anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for anchor, kind in ANCHORS.items():
        automaton.add_word(anchor, (kind, len(anchor)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban(text: str) -> bool:
    """Check digits of an account number (ISO 13616: the rearranged number is 1 modulo 97)."""
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    rest = 0
    for c in plain[4:] + plain[:4]:
        value = int(c, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def find(text: str | None, automaton: ahocorasick.Automaton | None = None) -> list[tuple[int, int, str]]:
    """Spans ``(start, end, kind)`` of a text in code points, by start and then kind."""
    if not text:
        return []
    spans: list[tuple[int, int, str]] = []
    done = dict.fromkeys(("email", "dotted", "chain", "phone", "iban", "account", "address"), 0)
    for last, (kind, size) in (automaton or anchors()).iter(text):
        at = last - size + 1
        if kind == "digits":
            if at >= done["dotted"]:
                done["dotted"] = _dotted(text, at, spans)
            if at >= done["chain"]:
                done["chain"] = _chain(text, at, spans)
        elif kind == "email":
            done["email"] = _email(text, at, done["email"], spans)
        elif kind == "phone":
            done["phone"] = _phone(text, at, done["phone"], spans)
        elif kind == "address":
            done["address"] = _address(text, last + 1, done["address"], spans)
        elif kind == "iban":
            done["iban"] = _cued(text, last + 1, done["iban"], _IBAN, spans)
        else:
            done["account"] = _cued(text, last + 1, done["account"], _NUMBER, spans)
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(set(spans), key=lambda s: (s[0], order[s[2]], s[1]))


def _email(text: str, at: int, done: int, spans: list) -> int:
    """``at`` is an at-sign: local part to the left (not before ``done``), domain to the right."""
    start = at
    while start > done and text[start - 1] in _LOCAL:
        start -= 1
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    if domain is None:
        return done
    spans.append((start, domain.end(), "email"))
    return domain.end()


def _dotted(text: str, at: int, spans: list) -> int:
    """Digit runs joined by single dots, taken four at a time from the left."""
    run = _DOTTED.match(text, at)
    starts, stops = [run.start()], []
    for dot in re.finditer(r"\.", run[0]):
        stops.append(at + dot.start())
        starts.append(at + dot.end())
    stops.append(run.end())
    for i in range(0, len(starts) - 3, 4):
        parts = [text[a:b].lstrip("0") for a, b in zip(starts[i : i + 4], stops[i : i + 4], strict=True)]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            spans.append((starts[i], stops[i + 3], "ip"))
    return run.end()


def _chain(text: str, at: int, spans: list) -> int:
    """Digits with at most one blank or hyphen between them."""
    run = _CHAIN.match(text, at)
    digits = run[0].replace(" ", "").replace("-", "")
    if 14 <= len(digits) <= 19 and luhn(digits):
        spans.append((at, run.end(), "card"))
    return run.end()


def _phone(text: str, at: int, done: int, spans: list) -> int:
    """``at`` is a plus sign: digits and separators up to the last digit."""
    run = _AFTER_PLUS.match(text, at + 1) if at >= done else None
    if run is None:
        return done
    shown = run[0].rstrip(" ().-")
    if len(shown) < 3:
        return done
    if 10 <= sum(c.isdigit() for c in shown) <= 15:
        spans.append((at, at + 1 + len(shown), "phone"))
    return at + 1 + len(shown)


def _address(text: str, after: int, done: int, spans: list) -> int:
    """After a scheme: an address that carries a name and a password."""
    found = _USERINFO.match(text, after) if after >= done else None
    if found is None:
        return done
    spans.append((after, found.end(), "address"))
    return found.end()


def _cued(text: str, after: int, done: int, form: re.Pattern, spans: list) -> int:
    """After a word that announces an account: its number, validated."""
    found = form.match(text, after) if after >= done else None
    if found is None:
        return done
    if form is _NUMBER:
        spans.append((*found.span(1), "account"))
        return found.end(1)
    stop = found.end(1)
    while stop - found.start(1) >= 15:  # what follows a number may look like more of it
        if text[stop - 1] != " " and iban(text[found.start(1) : stop]):
            spans.append((found.start(1), stop, "account"))
            return stop
        stop -= 1
    return done


_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string())]))


def find_personal(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``personal``: the spans of each text, ``array<struct<start,stop,kind>>``.

    Offsets count code points, the stop is exclusive, order is by start and then
    kind. A null or empty text has no spans. Repeated rows keep their rows, other
    columns pass through, an input column ``personal`` is replaced; without rows the
    result is empty. Texts of any length are read whole, in one scan without a shuffle.
    """

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = anchors()
        for batch in texts:
            rows = [[{"start": a, "stop": b, "kind": k} for a, b, k in find(t, automaton)] for t in batch.to_pylist()]
            yield pa.array(rows, _ARROW)

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    kind = "array<struct<start:bigint,stop:bigint,kind:string>>"
    return docs.withColumn("personal", F.arrow_udf(run, kind).asNondeterministic()(F.col(text)))


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets.

    Null, empty and long texts, repeated rows and empty tables as with
    :func:`find_personal`; other columns pass through whatever they are called.
    """

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = anchors()
        for batch in texts:
            yield pa.array([None if t is None else masked(t, automaton) for t in batch.to_pylist()], pa.string())

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(text, F.arrow_udf(run, "string")(F.col(text)))


def masked(text: str, automaton=None) -> str:
    out, at = [], 0
    for start, stop, kind in find(text, automaton or anchors()):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
            at = stop
        elif stop > at:  # it overlaps the span before: that one grows
            at = stop
    return "".join([*out, text[at:]])


def personal_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, a count for each base kind, ``base_sha256`` and ``spans``."""
    rows = find_personal(docs.select("doc_id", "text"))

    def shown(spans):
        text = F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop))
        return F.array_join(text, ",")

    base = F.filter("personal", lambda s: s.kind.isin(*BASE))
    counts = [
        F.array_size(F.filter("personal.kind", F.lit(kind).eqNullSafe)).cast("long").alias(f"n_{kind}")
        for kind in BASE
    ]
    return rows.select(
        "doc_id", *counts, F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("personal")).alias("spans")
    )
