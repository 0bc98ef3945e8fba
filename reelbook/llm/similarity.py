"""N-gram Jaccard join by chosen paths.

Each text becomes the set of its word n-grams, equal sets become one set, and each
set a row of min-hashes: tokens that similar sets share with a probability equal to
their similarity. Sets are split on a few chosen tokens; a part that is still large
is split again on other tokens, by itself. Small parts are compared pair by pair, and
so are parts that no token splits, which are groups of near copies. Several such runs
make the chance of missing a similar pair as small as wanted. Pairs are confirmed on
the whole n-gram sets; they are counted where they are found and never become rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelbook.llm.common import (
    FOLD,
    discarding,
    fields,
    maybe_broadcast,
    mixed,
    row_hash,
    saved,
    text_or_empty,
    whole_row,
)

#: Python workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of an n-gram; texts with fewer words, but not none, are one n-gram.
WORDS = 5
#: Least similarity, as a fraction of whole numbers.
SIMILAR = (4, 5)
#: Wanted chance of finding a pair of just that similarity.
TARGET = 0.9999
#: Tokens on which a part is split in one run, and tokens kept of each set.
BRANCH, TOKENS = 2, 64
#: Tokens from which a part of a given depth chooses; depths use other tokens than their parents.
CHOICE = 6
#: Sets up to which a part is compared pair by pair at once.
LEAF = 512
#: A split that leaves a larger share in one part does not help.
HOLD = 0.7
#: Agreeing tokens (of 64) below which a pair is not compared exactly: five standard errors below 0.8.
AGREE = 35
#: Sets and n-grams that one task compares at once; larger parts are compared block by block.
BLOCK_SETS, BLOCK_GRAMS = 16_384, 4_000_000
#: Sets on a side of a tile of pairs within a task.
TILE = 256

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WEIGH = mixed(np.arange(1, WORDS + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
_TOKEN_A = mixed(np.arange(1000, 1000 + TOKENS, dtype=np.uint64) * _BASE) | np.uint64(1)
_TOKEN_B = mixed(np.arange(2000, 2000 + TOKENS, dtype=np.uint64) * _BASE)


def runs_for(target: float = TARGET, similar: float = SIMILAR[0] / SIMILAR[1], branch: int = BRANCH) -> int:
    """Runs after which a pair has met with the chance ``target``, however deep the splits go.

    Two sets stay together below a part if one of its ``branch`` tokens agrees and
    they stay together below that: q = 1 - (1 - similar * q) ** branch.
    """
    q = 1.0
    for _ in range(200):
        q = 1 - (1 - similar * q) ** branch
    return math.ceil(math.log(1 - target) / math.log(1 - q))


class Grams:
    """N-gram hashes of texts, with the powers that word hashes need."""

    def __init__(self):
        self.power = self.inverse = np.ones(1, np.uint64)

    def of(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct hashes of the n-grams of a text."""
        raw = np.frombuffer((text or b"").translate(FOLD), np.uint8)
        edge = np.flatnonzero(np.diff(np.r_[False, raw != 32, False].astype(np.int8)))
        start, stop = edge[::2], edge[1::2]
        if not start.size:
            return np.empty(0, np.uint64)
        if self.power.size < raw.size:
            size = 2 * raw.size
            inverse = pow(int(_BASE), -1, 1 << 64)
            self.power = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE)])
            self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(size, np.uint64(inverse))])
        # a word's hash is a polynomial of its bytes: a difference of running sums, shifted back
        sums = np.r_[np.uint64(0), np.cumsum(raw * self.power[: raw.size])]
        words = mixed((sums[stop] - sums[start]) * self.inverse[start])
        if words.size < WORDS:
            return mixed(np.array([(words * _WEIGH[: words.size]).sum() + np.uint64(words.size)], np.uint64))
        grams = words[: words.size - WORDS + 1] * _WEIGH[0]
        for i in range(1, WORDS):
            grams = grams + words[i : words.size - WORDS + 1 + i] * _WEIGH[i]
        return np.unique(mixed(grams))


def digest(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as two signed numbers."""
    halves = (mixed(grams ^ np.uint64(seed)).sum(dtype=np.uint64).astype(np.int64) for seed in (11, 13))
    return tuple(int(h) for h in halves)


def min_hashes(grams: np.ndarray) -> np.ndarray:
    """The set's ``TOKENS`` tokens: least values under as many hash functions."""
    low = np.full(TOKENS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, grams.size, 4096):
        some = grams[None, at : at + 4096] * _TOKEN_A[:, None] + _TOKEN_B[:, None]
        low = np.minimum(low, (some >> np.uint64(32)).astype(np.uint32).min(axis=1))
    return low


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    maker = Grams()
    for batch in batches:
        first, second, size, tokens = [], [], [], []
        for text in batch.column(2).to_pylist():
            grams = maker.of(text)
            a, b = digest(grams)
            first.append(a)
            second.append(b)
            size.append(grams.size)
            tokens.append(min_hashes(grams))
        flat = np.array(tokens, np.uint32).reshape(-1, TOKENS)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(flat.view(np.int32).ravel()), TOKENS).cast(pa.list_(pa.int32()))
        short = flat.astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(first, pa.int64()),
                pa.array(second, pa.int64()),
                pa.array(size, pa.int64()),
                lists,
                pa.array([row.tobytes() for row in short], pa.binary()),
            ],
            names=["doc_id", "t", "d1", "d2", "n", "tokens", "short"],
        )


def _split(path: Column, depth: int) -> Column:
    """The ends of the paths that lead on from ``path``: one per chosen token."""
    if depth == 0:
        chosen = [F.lit(i) for i in range(runs_for() * BRANCH)]
    else:
        first = runs_for() * BRANCH + CHOICE * ((depth - 1) % _depths())
        lead = F.pmod(F.xxhash64(path), F.lit(CHOICE // BRANCH)).cast("int") * BRANCH
        chosen = [lead + first + i for i in range(BRANCH)]
    return F.array(*(F.xxhash64(path, c, F.get("tokens", c)) for c in chosen))


def _depths() -> int:
    return (TOKENS - runs_for() * BRANCH) // CHOICE


def _leaves(sets: DataFrame) -> DataFrame:
    """``path`` and ``set`` of the parts that are to be compared pair by pair."""
    paths = sets.select(F.explode(_split(F.lit(0).cast("long"), 0)).alias("path"), "set")
    out: list[DataFrame] = []
    for depth in range(1, _depths() + 2):
        counts = saved(paths.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"), "parts")
        members = paths.join(counts, "path")
        large = counts.where(F.col("n") > LEAF)
        if depth > _depths() or large.isEmpty():
            out.append(members.select("path", "set"))
            break
        out.append(members.where(F.col("n") <= LEAF).select("path", "set"))
        members = members.where(F.col("n") > LEAF).join(sets.select("set", "tokens"), "set")
        parts = members.select(F.col("path").alias("parent"), "n", F.explode(_split(F.col("path"), depth)).alias("path"), "set")
        parts = saved(parts, "split")
        most = parts.groupBy("parent", "path").agg(F.count("*").alias("c"), F.first("n").alias("n"))
        held = most.groupBy("parent").agg(F.max(F.col("c") / F.col("n")).alias("share")).where(F.col("share") > HOLD)
        held = saved(held.select("parent"), "held")
        held = maybe_broadcast(held, held.count())
        whole = parts.join(held, "parent", "left_semi").select(F.col("parent").alias("path"), "set").distinct()
        out.append(whole)
        paths = parts.join(held, "parent", "left_anti").select("path", "set")
    leaves = out[0]
    for more in out[1:]:
        leaves = leaves.unionByName(more)
    return leaves


_MEMBER = "path long, low int, high int, own int, set long, n long, weight long, leaves array<long>, short binary"


def _blocked(leaves: DataFrame, sets: DataFrame) -> DataFrame:
    """The members of every part, once per pair of blocks that they take part in."""
    known = leaves.groupBy("set").agg(F.sort_array(F.collect_set("path")).alias("leaves"))
    known = known.join(sets.select("set", "n", "weight", "short"), "set")
    rows = saved(known, "members").select("*", F.explode("leaves").alias("path"))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_GRAMS))
    wide = saved(rows.groupBy("path").agg(blocks.cast("int").alias("blocks")).where("blocks > 1"), "wide")
    rows = rows.join(maybe_broadcast(wide, wide.count()), "path", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("set"), blocks).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.select(
        "path", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "set", "n", "weight", "leaves", "short"
    )


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (path, low, high), which follow one another but for ends of batches."""
    held: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
        ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for low, high in zip([0, *ends], [*ends, batch.num_rows], strict=True):
            here = tuple(keys[:, low])
            if held and here != name:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            name = here
    if held:
        yield pa.Table.from_batches(held)


class Part:
    """The sets of one part (or of two blocks of it) and the pairs that are counted in it."""

    def __init__(self, rows: pa.Table):
        column = rows.column
        self.path = column("path")[0].as_py()
        self.cross = column("low")[0].as_py() != column("high")[0].as_py()
        self.own = column("own").to_numpy()
        self.set = column("set").to_numpy()
        self.size = column("n").to_numpy()
        self.weight = column("weight").to_numpy()
        self.short = np.frombuffer(b"".join(column("short").to_pylist()), np.uint8).reshape(-1, TOKENS)
        lists = column("leaves").combine_chunks()
        count = np.diff(lists.offsets.to_numpy())
        leaf, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(self.set)), count)
        earlier = leaf < self.path
        self.leaf, self.owner = leaf[earlier], owner[earlier]

    def tiles(self) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """Tiles of pairs with a mask of those worth an exact comparison here.

        A pair that also meets in a part with a lower path is left to that part.
        """
        m = len(self.set)
        for a in range(0, m, TILE):
            for b in range(a, m, TILE):
                rows, cols = slice(a, min(a + TILE, m)), slice(b, min(b + TILE, m))
                mask = ~self._met(rows, cols)
                if a == b:
                    mask &= np.triu(np.ones_like(mask), 1)
                if self.cross:
                    mask &= self.own[rows, None] != self.own[None, cols]
                i, j = np.nonzero(mask)
                for at in range(0, i.size, 1 << 16):
                    p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                    agree = (self.short[rows][p] == self.short[cols][q]).sum(axis=1)
                    mask[p, q] = agree >= AGREE
                if mask.any():
                    yield rows, cols, mask

    def _met(self, rows: slice, cols: slice) -> np.ndarray:
        """Whether a row and a column share a leaf with a lower path."""
        left, at = self._leaves_of(rows)
        right, to = self._leaves_of(cols)
        shared = np.intersect1d(left, right)
        met = np.zeros((rows.stop - rows.start, cols.stop - cols.start), bool)
        for chunk in range(0, shared.size, 1024):
            some = shared[chunk : chunk + 1024]
            met |= _incidence(left, at, some, met.shape[0]) @ _incidence(right, to, some, met.shape[1]).T > 0
        return met

    def _leaves_of(self, side: slice) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.searchsorted(self.owner, [side.start, side.stop])
        return self.leaf[low:high], self.owner[low:high] - side.start


def _incidence(values: np.ndarray, owner: np.ndarray, columns: np.ndarray, rows: int) -> np.ndarray:
    """A matrix of owners by (sorted) columns with 1 where an owner has a column's value."""
    at = np.minimum(np.searchsorted(columns, values), columns.size - 1)
    there = columns[at] == values
    out = np.zeros((rows, columns.size), np.float32)
    out[owner[there], at[there]] = 1
    return out


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members that have a pair to compare exactly."""
    for rows in _grouped(batches):
        wanted = np.zeros(rows.num_rows, bool)
        for left, right, mask in Part(rows).tiles():
            wanted[left] |= mask.any(axis=1)
            wanted[right] |= mask.any(axis=0)
        if wanted.any():
            yield from rows.filter(pa.array(wanted)).to_batches()


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per member with links: the links, weighed and not, and the label of its local component."""
    for rows in _grouped(batches):
        part = Part(rows)
        grams = [np.frombuffer(g, np.uint64) for g in rows.column("grams").to_pylist()]
        links, texts = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
        label = np.arange(len(grams))
        for left, right, mask in part.tiles():
            linked = mask & _similar(grams[left], grams[right], mask)
            if not linked.any():
                continue
            links[left] += linked @ part.weight[right]
            links[right] += linked.T @ part.weight[left]
            texts[left] += linked.sum(axis=1)
            texts[right] += linked.sum(axis=0)
            for i in np.flatnonzero(linked.any(axis=1)):
                mine = left.start + i
                near = np.unique(np.r_[label[mine], label[right][linked[i]]])
                if near.size > 1:
                    label[np.isin(label, near)] = near[0]
        found = np.flatnonzero(texts)
        if found.size:
            columns = [part.set[found], links[found], texts[found], part.set[label[found]]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["set", "links", "texts", "label"])


def _similar(left: list[np.ndarray], right: list[np.ndarray], mask: np.ndarray) -> np.ndarray:
    """Exact test of the pairs in ``mask``: common n-grams against all n-grams of both."""
    i, j = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    a, b = [left[k] for k in i], [right[k] for k in j]
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    at, to = (np.repeat(np.arange(len(s)), [g.size for g in s]) for s in (a, b))
    shared = np.intersect1d(flat_a, flat_b)
    common = np.zeros((len(a), len(b)), np.float64)
    for chunk in range(0, shared.size, 4096):
        some = shared[chunk : chunk + 4096]
        common += _incidence(flat_a, at, some, len(a)) @ _incidence(flat_b, to, some, len(b)).T
    sizes = np.add.outer([g.size for g in a], [g.size for g in b])
    up, down = SIMILAR
    out = np.zeros(mask.shape, bool)
    out[np.ix_(i, j)] = (up + down) * common >= up * sizes
    return out


def _gram_sets(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """``set`` and ``grams`` of the wanted sets, made anew from a text of each."""
    body = text_or_empty(text)
    texts = docs.select(F.xxhash64(body).alias("t"), body.cast("binary").alias("text"))
    rows = texts.join(wanted.select("set", "t", "d1", "d2"), "t").select("set", "d1", "d2", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, last = Grams(), None
        for batch in batches:
            sets, out = [], []
            for name, d1, d2, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name == last:  # copies follow one another
                    continue
                grams = maker.of(raw)
                if digest(grams) == (d1, d2):
                    last = name
                    sets.append(name)
                    out.append(grams.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.int64()), pa.array(out, pa.binary())], names=["set", "grams"])

    return rows.mapInArrow(run, "set long, grams binary").groupBy("set").agg(F.any_value("grams").alias("grams"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) from ``a`` and ``b``.

    Stars are drawn towards the least neighbour, first from larger and then from
    smaller nodes, until nothing changes. Nodes without an edge have no row.
    """
    edges = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = saved(larger.where("a <> b").distinct(), "edges")
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = saved(smaller.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")


def classes(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``t`` (hash of the text), ``class_id``, ``copy_id``,
    ``n_links``, and ``class`` (a number of this run; null without words).

    ``copy_id`` is the least id with the same n-gram set, ``class_id`` the least id
    connected by links, ``n_links`` the number of other rows with a similarity of 0.8
    or more, copies included. A text without words (null or empty too) is linked to
    nothing and its class is its own id. A null id is left out of the least ids.
    Repeated rows count as copies; texts of any length are compared whole; without rows
    the result is empty. Only ids and texts are read, whatever other columns are called.
    """
    body = text_or_empty(text)
    rows = docs.select("doc_id", F.xxhash64(body).alias("t"), body.cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, t long, d1 long, d2 long, n long, tokens array<int>, short binary"
    sketches = saved(rows.mapInArrow(_sketched, schema), "sketches")
    one = F.struct("t", "n", "tokens", "short")
    sets = sketches.where("n > 0").groupBy("d1", "d2").agg(
        F.count("*").alias("weight"), F.min("doc_id").alias("copy_id"), F.any_value(one).alias("one")
    )
    sets = saved(sets.select(F.monotonically_increasing_id().alias("set"), "d1", "d2", "weight", "copy_id", "one.*"), "sets")
    with discarding(docs.sparkSession):
        about = saved(_linked(docs, sets, text), "about", stay=True)
    names = about.groupBy("class").agg(F.min("copy_id").alias("class_id"))
    about = about.join(names, "class").withColumn("n_links", F.col("weight") - 1 + F.coalesce("links", F.lit(0)))
    rows = sketches.select("doc_id", "t", "d1", "d2", "n").join(
        about.select("d1", "d2", "class", "class_id", "copy_id", "n_links"), ["d1", "d2"], "left"
    )
    words = F.col("n") > 0
    return rows.select(
        "doc_id",
        "t",
        F.when(words, F.col("class")).alias("class"),
        F.when(words, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(words, F.col("copy_id")).otherwise(F.col("doc_id")).alias("copy_id"),
        F.when(words, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def _linked(docs: DataFrame, sets: DataFrame, text: str) -> DataFrame:
    """``sets`` without their tokens, with ``links`` (null without any) and ``class``."""
    members = _blocked(_leaves(sets), sets)
    key = ["path", "low", "high"]
    candidates = members.repartition(*key).sortWithinPartitions(*key, "set").mapInArrow(_candidates, _MEMBER)
    candidates = saved(candidates, "candidates")
    wanted = candidates.select("set").distinct().join(sets, "set")
    grams = saved(_gram_sets(docs, wanted, text), "grams")
    found = candidates.join(grams, "set").select(*candidates.columns, "grams")
    found = found.repartition(*key).sortWithinPartitions(*key, "set")
    found = saved(found.mapInArrow(_confirmed, "set long, links long, texts long, label long"), "links")
    degrees = found.groupBy("set").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("set").alias("a"), F.col("label").alias("b")))
    rows = sets.select("set", "d1", "d2", "weight", "copy_id").join(degrees, "set", "left")
    rows = rows.join(joined.select(F.col("node").alias("set"), "root"), "set", "left")
    return rows.withColumn("class", F.coalesce("root", "set"))


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that with the least id (null ids last), then text hash.

    Rows without words (null, empty or blank texts) are classes of their own, but for
    repeats of id and text. Of rows that repeat id and text but differ elsewhere the one
    with the least hash of its columns stays. Long texts are compared whole; without
    rows the result is empty; columns keep their names and values, whatever they are called.
    """
    with discarding(docs.sparkSession):
        rows = saved(classes(docs, text).select("doc_id", "t", "class"), "classes", stay=True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t")).alias("f")
    best = rows.where("class IS NOT NULL").groupBy("class").agg(first).select("f.doc_id", "f.t")
    best = best.unionByName(rows.where("class IS NULL").select("doc_id", "t")).distinct()
    hash2 = F.xxhash64(F.col("doc_id"), F.col("t"))
    best = best.select(F.col("doc_id").alias("__id"), F.col("t").alias("__t"), hash2.alias("__k"))
    t = F.xxhash64(text_or_empty(text))
    whole = docs.select(whole_row(docs).alias("row"), F.col("doc_id"), t.alias("t"), row_hash(docs).alias("h"))
    whole = whole.withColumn("k", hash2)
    same = (F.col("k") == F.col("__k")) & F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("t") == F.col("__t"))
    kept = whole.join(best, same, "left_semi").groupBy("k", "doc_id", "t").agg(F.min_by("row", "h").alias("row"))
    return kept.select(*fields("row", docs.columns))


def similarity_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id``, ``copy_id``, ``n_links``."""
    return classes(docs.select("doc_id", "text")).select("doc_id", "class_id", "copy_id", "n_links")
