"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is f times its size takes every document floor(f) times and
once more with probability p, the rest of f. Whether a document gets the extra copy
is settled in pairs: one gives the other of its probability, weighted by size, until
one of the two is 0 or 1, and which way is drawn so that no expectation changes. The
undecided one goes on. Small buckets are settled first; what each has left meets in
the next level of a tree, until one document per source is left to a last draw. The
words of a source therefore miss its target by less than one document.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelbook.llm.common import fields, maybe_broadcast, row_hash, saved, text_or_empty, whole_row

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix, as a share of all words, and copies of a word at most.
SHARE, MOST = 1.5, 2
#: log2 of the residuals that meet in one bucket.
FAN_BITS = 5


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """From ``source`` (one row each) and ``source_size``: ``target``.

    A target is its weight times one common factor, or ``most`` times its size if
    that is less. Sorted by the factor at which each reaches its limit, the common
    factor is what is left for the rest, at the first source that stays below its
    own. One row per source, so one task orders them.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(place, F.lit(len(weights))))
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    rows = rows.withColumn("ratio", F.col("limit") / F.col("weight"))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    in_order = Window.orderBy("ratio", F.col("source").asc_nulls_first())
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumns({"factor": left / open_weight, "rank": F.row_number().over(in_order)})
    below = F.when(F.col("factor") <= F.col("ratio"), F.struct("rank", "factor"))
    factor = F.min(below).over(everything)["factor"]
    target = F.least(F.col("limit"), F.coalesce(factor * F.col("weight"), F.col("limit")))
    return rows.select("source", "source_size", target.alias("target"))


_ITEM = "struct<h:bigint,unit:bigint,size:double,p:double>"
_DONE = "array<struct<unit:bigint,h:bigint,one:int>>"


def _pair(state: Column, item: Column, level: int) -> Column:
    """Settle one of the carried and the next item; the other is carried on."""
    held = state["held"]
    up, down = (1 - item["p"]) * item["size"], item["p"] * item["size"]
    give = F.least(held["p"] * held["size"], up)
    take = F.least((1 - held["p"]) * held["size"], down)
    draw = _uniform(F.xxhash64(F.lit(level), held["h"], item["h"]))
    gives = draw * (give + take) < take
    moved = F.when(gives, -give).otherwise(take)
    # the one whose end is nearer is settled
    first = F.when(gives, held["p"] * held["size"] <= up).otherwise((1 - held["p"]) * held["size"] <= down)
    one = F.when(first, F.when(gives, 0).otherwise(1)).otherwise(F.when(gives, 1).otherwise(0))
    settled = F.struct(
        F.when(first, held["unit"]).otherwise(item["unit"]).alias("unit"),
        F.when(first, held["h"]).otherwise(item["h"]).alias("h"),
        one.alias("one"),
    )
    p = F.when(first, item["p"] - moved / item["size"]).otherwise(held["p"] + moved / held["size"])
    kept = F.when(first, item).otherwise(held)
    next_held = F.struct(kept["h"], kept["unit"], kept["size"], F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))).cast(_ITEM)
    paired = F.struct(next_held.alias("held"), F.concat(state["done"], F.array(settled).cast(_DONE)).alias("done"))
    start = F.struct(item.cast(_ITEM).alias("held"), state["done"].alias("done"))
    return F.when(held.isNull(), start).otherwise(paired)


def _uniform(hash64: Column) -> Column:
    """A number in [0, 1) from 53 bits of a hash."""
    return F.shiftrightunsigned(hash64, 11) / F.lit(float(1 << 53))


def _reduce(items: DataFrame, bits: Column, level: int) -> DataFrame:
    """One level of the tree: ``source``, ``bits``, ``held`` and ``done`` per bucket.

    ``items`` has ``source``, ``bits`` (of its first level) and ``item``. A bucket is
    a common start of the hashes, so its members are about 2^FAN_BITS.
    """
    wide = F.greatest(bits, F.lit(0))
    bucket = F.when(wide == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftrightunsigned(item.h, 64 - greatest({_sql(level)}, 0))"))
    grouped = items.groupBy("source", "bits", bucket.alias("bucket")).agg(F.sort_array(F.collect_list("item")).alias("members"))
    start = F.struct(F.lit(None).cast(_ITEM).alias("held"), F.array().cast(_DONE).alias("done"))
    folded = F.aggregate("members", start, lambda s, x: _pair(s, x, level))
    return grouped.select("source", "bits", folded.alias("f")).select("source", "bits", "f.held", "f.done")


def _sql(level: int) -> str:
    return f"bits - {FAN_BITS * level}"


def plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 7,
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target``, ``copies``,
    ``taken``, and the text's keys ``k1`` and ``k2``.

    Draws come from the document's id and text alone, so reruns agree. Repeated
    rows are counted first and then numbered, each with a draw of its own. A null
    text has size 0; a document without words takes no words and is copied with the
    probability of its source. A null source is a source. Only ``doc_id``,
    ``source`` and ``text`` are read, whatever other columns are called; long texts are
    counted whole; without rows the result is empty; texts are not shuffled.
    """
    body = text_or_empty(text)
    units = docs.select(
        "doc_id",
        "source",
        F.regexp_count(body, F.lit(r"[^ \t-\r]+")).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), body).alias("k1"),
        F.xxhash64(F.lit(seed + 1), body, F.col("doc_id")).alias("k2"),
    )
    units = saved(units.groupBy("doc_id", "source", "size", "k1", "k2").agg(F.count("*").alias("rows")), "units")
    sizes = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("n")
    )
    sizes = saved(sizes, "sizes")
    quota = saved(targets(sizes.select("source", "source_size"), weights, share, most), "targets")
    n_sources, most_rows = quota.count(), sizes.agg(F.max("n")).first()[0] or 0
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    quota = quota.join(sizes.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s")))
    quota = quota.select(
        F.col("source").alias("__source"), "source_size", "target", F.floor(factor).alias("whole"), (factor - F.floor(factor)).alias("p"),
        F.greatest(F.ceil(F.log2(F.greatest("n", F.lit(1)) / (1 << FAN_BITS))), F.lit(0)).cast("int").alias("bits"),
    )
    quota = maybe_broadcast(quota, n_sources)
    rows = units.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy"))
    rows = rows.join(quota, F.col("source").eqNullSafe(F.col("__source"))).select(
        F.monotonically_increasing_id().alias("unit"), "*", F.xxhash64("k1", "k2", "copy").alias("h")
    )
    rows = saved(rows.drop("__source", "rows"), "rows")
    paired = (F.col("size") > 0) & (F.col("p") > 0)
    item = F.struct("h", "unit", F.col("size").cast("double").alias("size"), "p").cast(_ITEM)
    level, found = 0, []
    items = rows.where(paired).select("source", "bits", item.alias("item"))
    levels = 1 + math.ceil(math.log2(max(most_rows / (1 << FAN_BITS), 1)) / FAN_BITS)
    while level <= levels:
        here = saved(_reduce(items, F.col("bits") - FAN_BITS * level, level), "level")
        found.append(here.select(F.explode("done").alias("d")).select("d.unit", "d.one"))
        items = here.select("source", "bits", F.col("held").alias("item"))
        level += 1
    # one residual per source is left
    last = items.select(F.col("item.unit").alias("unit"), (_uniform(F.xxhash64(F.lit(-1), "item.h")) < F.col("item.p")).cast("int").alias("one"))
    found.append(last)
    alone = (F.col("size") == 0) & (_uniform(F.xxhash64(F.lit(-2), "h")) < F.col("p"))
    found.append(rows.where(alone).select("unit", F.lit(1).alias("one")))
    extra = found[0]
    for more in found[1:]:
        extra = extra.unionByName(more)
    extra = extra.where("one = 1").select(F.col("unit").alias("__unit"), "one")
    rows = rows.join(extra, F.col("unit") == F.col("__unit"), "left")
    copies = F.col("whole") + F.coalesce(F.col("one"), F.lit(0))
    return rows.select(
        "doc_id", "size", "source_size", "target", copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"), "k1", "k2",
    )


def mix(docs: DataFrame, text: str = "text", seed: int = 7, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, with their columns.

    Rows that repeat a document (same id and text) share the copies of all of them as
    evenly as whole copies go: which of them get one more is decided by a hash of their
    columns, so none of several versions is lost for another. Nulls, texts without words
    and long texts are treated as by :func:`plan`; without rows the result is empty; no
    name of an input column matters but ``doc_id``, ``source`` and the text's. Texts are
    shuffled once; equal rows are counted, and the versions of one document numbered in 64 parts.
    """
    body = text_or_empty(text)
    k1 = F.xxhash64(F.lit(seed), F.col("doc_id"), body)
    k2 = F.xxhash64(F.lit(seed + 1), body, F.col("doc_id"))
    total = plan(docs, seed=seed, text=text, **options).groupBy("k1", "k2")
    total = total.agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    keys = docs.select(k1.alias("k1"), k2.alias("k2"), row_hash(docs).alias("h"), whole_row(docs).alias("row"))
    # the versions of a document, in the order of their hashes: first 64 parts, then within a part
    versions = keys.groupBy("k1", "k2", "h").agg(F.count("*").alias("n"))
    versions = saved(versions.withColumn("part", F.shiftrightunsigned("h", 58)), "versions")
    earlier = lambda *by: Window.partitionBy("k1", "k2", *by[:-1]).orderBy(by[-1])
    parts = versions.groupBy("k1", "k2", "part").agg(F.sum("n").alias("m"))
    parts = parts.select("k1", "k2", "part", (F.sum("m").over(earlier("part")) - F.col("m")).alias("before"))
    versions = versions.withColumn("upto", F.sum("n").over(earlier("part", "h"))).join(parts, ["k1", "k2", "part"])
    versions = versions.join(total, ["k1", "k2"])
    every = F.floor(F.col("copies") / F.col("rows"))
    extra = F.col("copies") - every * F.col("rows") - (F.col("before") + F.col("upto") - F.col("n"))
    taken = F.col("n") * every + F.greatest(F.least(extra, F.col("n")), F.lit(0).cast("long"))
    share = versions.select("k1", "k2", "h", taken.alias("taken")).where("taken > 0")
    kept = keys.groupBy("k1", "k2", "h").agg(F.any_value("row").alias("row")).join(share, ["k1", "k2", "h"])
    kept = kept.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("taken"))))
    return kept.select(*fields("row", docs.columns))


def mix_digest(docs: DataFrame) -> DataFrame:
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken")
