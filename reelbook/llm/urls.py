"""URL filter by a cascade of Bloom filters.

Each URL has a fixed number of keys: ends of its host joined with starts of its
path. The first filter of a cascade holds the listed keys, the second the keys of
the corpus that pass the first by mistake, the third the listed keys that pass the
second, and so on until no mistake is left. Over all keys of the corpus the cascade
then answers exactly, from a few literals, without a join of the judged pages.

The rules are a table of any size. Only rules whose key the corpus has are encoded, so
the filters take some bits (about 1.5, and as many more as the corpus has doublings of
keys over rules) for each rule that occurs.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelbook.llm.common import named, saved

#: (verdict, host, path start): the rule fits the host and its subdomains.
Rule = tuple[str, str, str]
def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


@dataclass
class Level:
    bits: int
    hashes: int
    words: list[int]


class Cascade:
    """Exact membership of the keys of one corpus in a listed set."""

    def __init__(self, name: str, levels: list[Level]):
        self.name, self.levels = name, levels

    @classmethod
    def build(cls, name: str, listed: DataFrame, others: DataFrame) -> Cascade:
        """``listed`` and ``others`` have one column ``key``, distinct keys, and share none.

        Only filters come to the driver: they follow the number of listed keys. Each level
        has hashes of its own, so the mistakes of one shrink geometrically in the next.
        """
        self = cls(name, [])
        sides = [listed, others]
        n, m = listed.count(), others.count()
        while n:
            # the first filter lets through about as many others as there are listed keys
            hashes = max(1, math.ceil(math.log2(m / n))) if not self.levels and m > n else 1
            bits = max(64, 64 * math.ceil(n * hashes / math.log(2) / 64))
            here = Level(bits, hashes, [0] * (bits // 64))
            self.levels.append(here)
            places = F.explode(F.array(*self._places(len(self.levels) - 1, F.col("key"))))
            word = F.shiftright("p", 6)
            bit = F.expr("shiftleft(1L, cast(p & 63 AS int))")
            for row in sides[0].select(places.alias("p")).groupBy(word.alias("w")).agg(F.bit_or(bit).alias("b")).collect():
                here.words[row.w] = row.b
            passed = sides[1].where(self._passes(len(self.levels) - 1, F.col("key")))
            sides = [saved(passed, "cascade"), sides[0]]
            n, m = sides[0].count(), n
        return self

    def holds(self, key: Column) -> Column:
        """Whether ``key``, one of the corpus, is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(self._passes(i, key), answer).otherwise(F.lit(i % 2 == 1))
        return answer

    def _places(self, i: int, key: Column) -> list[Column]:
        here = self.levels[i]
        return [
            F.pmod(F.xxhash64(F.lit(f"{self.name}.{i}.{j}"), key), F.lit(here.bits).cast("long"))
            for j in range(here.hashes)
        ]

    def _passes(self, i: int, key: Column) -> Column:
        # one literal: a text whose cast to numbers is folded when the query is planned
        words = F.split(F.lit(",".join(map(str, self.levels[i].words))), ",").cast("array<bigint>")
        answer = F.lit(True)
        for place in self._places(i, key):
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            answer = answer & (F.getbit(word, place.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1)
        return answer


def _keys(host: Column, path: Column, sizes: Sequence[int], lengths: Sequence[int]) -> Column:
    """All keys of a URL that could be a rule: by number of host labels and length of path.

    Two nested loops over short lists, so the plan does not grow with the rules.
    """
    counts, widths = (F.split(F.lit(",".join(map(str, n))), ",").cast("array<int>") for n in (sizes, lengths))
    labels = F.size(F.split(host, r"\.", -1))
    # of a host of n labels, the last k: cut before the n-k-th dot from the left
    last = lambda k: F.array_join(F.slice(F.split(host, r"\.", -1), labels - k + 1, k), ".")
    ends = F.transform(F.filter(counts, lambda k: (labels >= k) & (host != "")), last)
    starts = F.transform(F.filter(widths, lambda w: F.length(path) >= w), lambda w: F.substring(path, 1, w))
    return F.flatten(F.transform(ends, lambda e: F.transform(starts, lambda s: F.concat(e, s))))


def _rule_table(spark: SparkSession, rules: Sequence[Rule] | DataFrame) -> DataFrame:
    """``host``, ``path``, ``key`` and ``verdict``. Of a list the last verdict for a key counts, of a
    table ``block``; rules without a verdict, a host or a path are left out."""
    if not isinstance(rules, DataFrame):
        last = {host + path: (verdict, host, path) for verdict, host, path in rules}
        # one text that the JVM reads: no row passes a Python worker
        text = json.dumps([dict(zip(("verdict", "host", "path"), rule, strict=True)) for rule in last.values()])
        parsed = F.from_json(F.lit(text), "array<struct<verdict: string, host: string, path: string>>")
        rules = spark.range(1).select(F.inline(parsed))
    rules = rules.where("verdict IN ('allow', 'block') AND host IS NOT NULL AND path IS NOT NULL")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    return rules.select("host", "path", F.concat("host", "path").alias("key"), "verdict")


def judge_urls(pages: DataFrame, rules: Sequence[Rule] | DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` is a list of (verdict, host, path start) or a table with these columns. Of
    the rules that fit, the longest (host and path together; then the longer host) wins.
    A URL without a rule is allowed and its ``rule`` is null; that is also what a null
    URL or one without ``://`` gets, with host and path empty. Without rules everything
    is allowed; a very long URL is judged whole; without pages the result is empty.
    Repeated rows keep their rows; other columns pass through; input columns with the
    four names are replaced. Rules meet the distinct keys of the corpus in a join when
    the cascade is built; the pages are judged by the cascade alone.
    """
    spark = pages.sparkSession
    pages = pages.withColumns({"host": host_of(named(url)), "path": path_of(named(url))})
    pages = pages.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("host", "path")})
    table = saved(_rule_table(spark, rules), "rules")
    # numbers of labels and lengths of path that rules have: as many as the longest rule at most
    labels = F.size(F.split("host", r"\.", -1))
    sizes = [row[0] for row in table.select(labels).distinct().collect()]
    lengths = [row[0] for row in table.select(F.length("path")).distinct().collect()]
    if not sizes:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    found = _keys(F.col("host"), F.col("path"), sorted(sizes), sorted(lengths))
    corpus = pages.select(F.explode(found).alias("key")).distinct()
    verdicts = table.groupBy("key").agg(F.max("verdict").alias("verdict"))
    corpus = saved(corpus.join(verdicts, "key", "left"), "keys")
    known = corpus.where("verdict IS NOT NULL")
    listed = Cascade.build("listed", known.select("key"), corpus.where("verdict IS NULL").select("key"))
    blocked = Cascade.build("blocked", *(known.where(F.col("verdict") == v).select("key") for v in ("block", "allow")))
    hits = F.filter(found, listed.holds)
    ranked = F.transform(hits, lambda k: F.struct(F.length(k), F.length(F.substring_index(k, "/", 1)), k.alias("key")))
    pages = pages.withColumn("rule", F.array_max(ranked)["key"])
    block = F.coalesce(blocked.holds(F.col("rule")), F.lit(False)) & F.col("rule").isNotNull()
    return pages.withColumn("verdict", F.when(block, F.lit("block")).otherwise(F.lit("allow")))


#: Rules of the registered query.
RULES: list[Rule] = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def url_digest(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    return judge_urls(pages.select("page_id", "url"), rules).drop("url")
