"""Periodic runs of words: stretches that repeat one period four times or more.

A grid of every q-th place is laid over the words for each period q; neighbours on the
grid that agree three times in a row are extended both ways by longest common
extensions. These come from a difference cover: only suffixes at sampled places are
sorted, two places are compared word by word until both reach samples (fewer than
:data:`CYCLE` words), and a range minimum over the sorted samples gives the rest.
"""

from __future__ import annotations

import sys
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Every difference modulo CYCLE is one of two residues of COVER (a perfect difference set).
CYCLE = 31
COVER = (1, 5, 11, 24, 25, 27)
#: A run has at least so many words, and at least so many periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Places of the keys among the distinct ones, from 1."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1


class Extensions:
    """How many words two places of an array have in common to the right.

    ``words`` are positive numbers; the last one occurs nowhere else, so two different
    places always differ before the end.
    """

    def __init__(self, words: np.ndarray):
        self.words = words
        n = words.size
        self.meet = np.empty(CYCLE, np.int64)
        for a in COVER:
            for b in COVER:
                self.meet[(b - a) % CYCLE] = a
        classes = [np.arange(d, n, CYCLE) for d in COVER]
        self.first = np.zeros(CYCLE, np.int64)
        self.first[list(COVER)] = np.cumsum([0, *(c.size for c in classes[:-1])])
        places = np.concatenate(classes)
        levels = [self._blocks(places)]
        m = places.size
        while m and levels[-1].max() < m:
            # equal prefixes of twice the length: the second half starts `step` blocks later
            step = 1 << (len(levels) - 1)
            later = np.zeros(m, np.int64)
            later[: m - step] = levels[-1][step:]
            levels.append(_ranks(levels[-1] * (m + 1) + later))
        self.rank = levels[-1] - 1
        self.table = [self._common(places, np.argsort(self.rank), levels)]
        width = 1
        while 2 * width <= self.table[0].size:
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _blocks(self, places: np.ndarray) -> np.ndarray:
        """Ranks of the CYCLE words from each sampled place on; several words fit one sort key."""
        padded = np.concatenate([self.words, np.zeros(CYCLE, np.int64)])
        bits = int(padded.max()).bit_length()
        rank, used = np.zeros(places.size, np.int64), places.size.bit_length() + 1
        room = used
        for t in range(CYCLE):
            if room + bits > 62:
                rank, room = _ranks(rank), used
            rank = (rank << bits) | padded[places + t]
            room += bits
        return _ranks(rank)

    def _common(self, places: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words that neighbours among the sorted samples have in common."""
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(a.size, np.int64)
        for level in range(len(levels) - 1, -1, -1):
            same = levels[level][a] == levels[level][b]
            step = same.astype(np.int64) << level
            common += step * CYCLE
            a += step
            b += step
        return common + self._walk(places[a], places[b], np.full(a.size, CYCLE))

    def _walk(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from two places on, ``most`` at most, word by word."""
        found = most.copy()
        live = np.flatnonzero(most > 0)
        t = 0
        while live.size:
            same = self.words[a[live] + t] == self.words[b[live] + t]
            found[live[~same]] = t
            t += 1
            live = live[same]
            live = live[most[live] > t]
        return found

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common words from ``a`` and from ``b`` on, two arrays of places that differ pairwise."""
        least = (self.meet[(b - a) % CYCLE] - a) % CYCLE
        found = self._walk(a, b, least)
        far = np.flatnonzero(found == least)
        x, y = self._rank_at(a[far] + least[far]), self._rank_at(b[far] + least[far])
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level):
            mine = level == k
            of, last = self.table[k], high[mine] - (1 << int(k))
            found[far[mine]] += np.minimum(of[low[mine]], of[last])
        return found

    def _rank_at(self, place: np.ndarray) -> np.ndarray:
        return self.rank[self.first[place % CYCLE] + place // CYCLE]


def _grid(words: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grid places and periods where words agree with those a period later, three times in a row.

    Texts stand by falling length, so those long enough for a period are a prefix.
    Equal words a period apart cover three periods of a run, hence three grid places in
    a row; every third place of a row of agreements is enough to meet each run.
    """
    places, periods = [], []
    for q in range(1, int(lengths[0]) // LEAST_PERIODS + 1 if lengths.size else 1):
        texts = int(np.searchsorted(-lengths, -max(LEAST_WORDS, LEAST_PERIODS * q), side="right"))
        if not texts:
            break
        part = words[: ends[texts - 1]]
        agree = part[:-q:q] == part[q::q]
        three = np.flatnonzero(agree[:-2] & agree[1:-1] & agree[2:])
        if three.size:
            opens = np.r_[True, np.diff(three) > 1]
            start = np.maximum.accumulate(np.where(opens, three, 0))
            chosen = three[(three - start) % 3 == 0] + 2
            places.append(chosen * q)
            periods.append(np.full(chosen.size, q))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *periods])


def _laid(texts: list[np.ndarray], top: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another between numbers above ``top`` that occur once each, and where they start."""
    parts, starts, at = [np.array([top + 1])], [], 1
    for i, text in enumerate(texts):
        starts.append(at)
        parts += [text, np.array([top + 2 + i])]
        at += text.size + 1
    return np.concatenate(parts), np.array(starts, np.int64)


def runs_of(texts: list[np.ndarray], top: int) -> list[np.ndarray]:
    """For each text of word numbers (1 to ``top``) its runs: rows of start, length, period.

    Runs stand by start, then period. A run cannot be longer on either side, and its
    period is its smallest.
    """
    found = [np.zeros((0, 3), np.int64)] * len(texts)
    order = sorted(range(len(texts)), key=lambda i: -texts[i].size)
    words, starts = _laid([texts[i] for i in order], top)
    lengths = np.array([texts[i].size for i in order], np.int64)
    places, periods = _grid(words, starts + lengths + 1, lengths)
    owner = np.searchsorted(starts, places, side="right") - 1
    within = owner == np.searchsorted(starts, places + periods, side="right") - 1
    places, periods, owner = places[within], periods[within], owner[within]
    if not places.size:
        return found
    # only texts with agreements on a grid are sorted
    some, mine = np.unique(owner, return_inverse=True)
    inside = places - starts[owner]
    words, starts = _laid([texts[order[i]] for i in some], top)
    lengths = lengths[some]
    places = starts[mine] + inside
    end = places + periods + Extensions(words)(places, places + periods)
    # place i of the reversed array is the last but i, and what stands left of a place is right of it there
    back = Extensions(words[::-1].copy())
    start = places - back(words.size - places, words.size - places - periods)
    enough = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * periods)
    rows = np.stack([mine, start - starts[mine], end - start, periods], axis=1)[enough]
    rows = rows[np.lexsort(rows.T[::-1])]
    # one stretch with several periods: the smallest comes first and divides the others
    new = np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)] if len(rows) else np.zeros(0, bool)
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], np.arange(some.size + 1))
    for k, i in enumerate(some):
        found[order[i]] = rows[cuts[k] : cuts[k + 1], 1:]
    return found


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay: those of no run, and of each run its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


Change = Callable[[object, list[bytes]], list[bytes]]


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", change: Change | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` lists start (word number), length and period of every run, by start, then
    period; ``collapsed`` is the text's words, joined by one blank, without those that
    repeat a run's first period. Words stand between blanks and U+0009 to U+000D.
    ``change`` may replace a document's words, given its key, before they are searched.

    A null, empty or blank text has no words, no runs and an empty ``collapsed``; a null
    key stays null; repeated rows each give a row; without rows the result is empty;
    other columns are not read, whatever their names. A text of any length is searched
    whole, in memory linear in it times the logarithm of its sampled places. One scan,
    no shuffle: a lost task reads its rows again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            keys = batch.column(0).to_pylist() if change else [None] * len(batch)
            numbers: defaultdict[bytes, int] = defaultdict()
            numbers.default_factory = lambda numbers=numbers: len(numbers) + 1
            worded, texts = [], []
            for one, body in zip(keys, batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = (body or b"").split()
                if change:
                    words = change(one, words)
                worded.append(words)
                texts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            runs = runs_of(texts, len(numbers))
            collapsed = []
            for words, mine in zip(worded, runs, strict=True):
                if len(mine):
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), mine))]
                collapsed.append(b" ".join(words))
            all_runs = np.concatenate([np.zeros((0, 3), np.int64), *runs])
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(all_runs[:, c]) for c in range(3)], ["start", "length", "period"]),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(words) for words in worded], pa.int64()),
                    lists.cast(run_kind),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    return rows.mapInArrow(run, schema)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of the documents made periodic from a place on; a null id leaves them."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    times = -(-(n - a) // p)
    return words[:a] + (period * times)[: n - a]


def run_digest(docs: DataFrame) -> DataFrame:
    """Counts, the longest run and digests, per document with planted periods."""
    found = find_runs(docs.select("doc_id", "text"), change=planted)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    # the longest first, then the least start and period: negated, that is the least struct
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("short"), r.start, r.period)))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        (-best.short).alias("length"),
        best.period.alias("period"),
        F.floor(F.lit(-1000) * best.short / best.period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
