"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton knows every run of words of every item. A training text walks
through it word by word; the length of the longest run of item words that ends at
a word tells which windows end there. Only stretches of words that the items use
are walked at all.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelbook.llm.common import whole_row, words_of

#: Python workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of an item that make a window; a shorter item is one window as a whole.
WINDOW = 10
#: Item words in one automaton. More items make more automata, one pass each; only the one in the
#: making has dictionaries (about 0.5 KB a word), a worker holds all of them packed (50 bytes).
BLOCK_WORDS = 200_000
#: States whose steps a worker keeps as dictionaries.
KNOWN_STATES = 100_000


@dataclass
class SuffixAutomaton:
    """All runs of words of the items, with the items that own each window."""

    window: int = WINDOW
    shortest: int = 0
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    #: State of the longest suffix of exactly ``window`` words, or -1.
    full: list[int] = field(default_factory=list)
    #: Next state on the way of suffixes (itself included) that is a whole short item, or -1.
    short: list[int] = field(default_factory=list)
    #: Items with the window of a state; items that are a state's whole short run.
    owners: dict[int, set[str]] = field(default_factory=dict)
    whole: dict[int, set[str]] = field(default_factory=dict)

    @classmethod
    def of(cls, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW) -> SuffixAutomaton:
        self = cls(window=window)
        items = [(name, words) for name, words in items if words]
        self.shortest = min([window, *(len(words) for _, words in items)])
        coded = []
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            last = 0
            for word in ids:
                last = self._extend(last, word)
            coded.append((name, ids))
        by_length = sorted(range(len(self.length)), key=self.length.__getitem__)
        self.full, self.short = [-1] * len(self.length), [-1] * len(self.length)
        for name, ids in coded:
            at, known = 0, 0
            for word in ids:
                at, known = self._walk(at, known, word)
                if len(ids) < window:
                    continue
                if known >= window:
                    self.owners.setdefault(self._suffix_of(at, window), set()).add(name)
            if len(ids) < window:
                self.whole.setdefault(self._suffix_of(at, len(ids)), set()).add(name)
        for state in by_length:
            up = self.link[state]
            if self.length[state] >= window:
                self.full[state] = state if self.length[up] < window else self.full[up]
            if up >= 0:
                self.short[state] = state if state in self.whole else self.short[up]
        return self

    def _extend(self, last: int, word: int) -> int:
        """Append ``word`` after state ``last``; works for several items, one after another."""
        if word in self.step[last]:
            there = self.step[last][word]
            if self.length[there] == self.length[last] + 1:
                return there
            return self._clone(last, word, there)
        new = self._state(self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            there = self.step[at][word]
            exact = self.length[there] == self.length[at] + 1
            self.link[new] = there if exact else self._clone(at, word, there)
        return new

    def _clone(self, at: int, word: int, there: int) -> int:
        copy = self._state(self.length[at] + 1)
        self.step[copy] = dict(self.step[there])
        self.link[copy] = self.link[there]
        self.link[there] = copy
        while at >= 0 and self.step[at].get(word) == there:
            self.step[at][word] = copy
            at = self.link[at]
        return copy

    def _state(self, length: int) -> int:
        self.step.append({})
        self.length.append(length)
        self.link.append(-1)
        return len(self.length) - 1

    def _walk(self, at: int, known: int, word: int) -> tuple[int, int]:
        """State and length of the longest run of item words after one more word."""
        while at and word not in self.step[at]:
            at = self.link[at]
            known = self.length[at]
        if word in self.step[at]:
            return self.step[at][word], known + 1
        return 0, 0

    def _suffix_of(self, at: int, length: int) -> int:
        while self.length[self.link[at]] >= length:
            at = self.link[at]
        return at

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        return Scanner(self.packed()).scan(words)

    def packed(self) -> dict:
        """What a scan needs, as flat arrays: some 50 bytes for each word of the items."""
        order = [sorted(step.items()) for step in self.step]
        holders = sorted(self.owners | self.whole)
        names = sorted(set().union(*self.owners.values(), *self.whole.values()))
        number = {name: i for i, name in enumerate(names)}
        lists = [sorted(number[n] for n in self.owners.get(h, set()) | self.whole.get(h, set())) for h in holders]
        return {
            "window": self.window,
            "shortest": self.shortest,
            "vocabulary": self.vocabulary,
            "names": names,
            "firsts": np.cumsum([0, *map(len, order)], dtype=np.int64),
            "words": np.array([word for step in order for word, _ in step], np.int32),
            "targets": np.array([there for step in order for _, there in step], np.int32),
            "length": np.array(self.length, np.int32),
            "link": np.array(self.link, np.int32),
            "full": np.array(self.full, np.int32),
            "short": np.array(self.short, np.int32),
            "holders": np.array(holders, np.int32),
            "owned": np.cumsum([0, *map(len, lists)], dtype=np.int64),
            "owners": np.array([n for owners in lists for n in owners], np.int32),
            "windows": np.array(sorted(self.owners), np.int32),
        }


class Scanner:
    """A packed automaton at work; steps of a state are looked up as a dictionary when it is first met."""

    def __init__(self, packed: dict):
        vars(self).update(packed)
        self.steps: dict[int, tuple[dict[int, int], int, int, int, int, bool]] = {}

    def _state(self, at: int) -> tuple[dict[int, int], int, int, int, int, bool]:
        """Steps, link, length, window state, short state, and whether the state is an owned window."""
        found = self.steps.get(at)
        if found is None:
            if len(self.steps) > KNOWN_STATES:
                self.steps.clear()
            here = slice(*self.firsts[at : at + 2])
            step = dict(zip(self.words[here].tolist(), self.targets[here].tolist(), strict=True))
            place = int(np.searchsorted(self.windows, at))
            owned = place < self.windows.size and int(self.windows[place]) == at
            numbers = (int(a[at]) for a in (self.link, self.length, self.full, self.short))
            found = self.steps[at] = (step, *numbers, owned)
        return found

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches of words ``[start, end)``, apart and in order, and the items found."""
        ids = np.array(list(map(self.vocabulary.get, words, [-1] * len(words))), np.int64)
        edge = np.flatnonzero(np.diff(np.r_[False, ids >= 0, False].astype(np.int8)))
        spans: list[tuple[int, int]] = []
        states: set[int] = set()
        for low, high in edge.reshape(-1, 2).tolist():
            if high - low >= self.shortest:
                self._scan_run(ids[low:high].tolist(), low, spans, states)
        return joined(spans), self._names(states)

    def _names(self, states: set[int]) -> set[str]:
        """Items of the states met, each state looked up once."""
        places = np.searchsorted(self.holders, np.array(sorted(states), np.int64))
        some = [self.owners[self.owned[p] : self.owned[p + 1]] for p in places.tolist()]
        return {self.names[i] for i in np.unique(np.concatenate(some)).tolist()} if some else set()

    def _scan_run(self, ids: list[int], low: int, spans: list, states: set[int]) -> None:
        at, known = 0, 0
        here = self._state(0)
        for end, word in enumerate(ids, low + 1):
            while at and word not in here[0]:
                at = here[1]
                here = self._state(at)
                known = here[2]
            at = here[0].get(word, 0)
            known = known + 1 if at else 0
            here = self._state(at)
            if known >= self.window and here[3] >= 0 and self._state(here[3])[5]:
                states.add(here[3])
                spans.append((end - self.window, end))
            short = here[4] if at else -1
            while short > 0:
                _, link, size, _, _, _ = self._state(short)
                if size <= known:
                    states.add(short)
                    spans.append((end - size, end))
                short = self._state(link)[4]


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping or touching ones made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _automata(items: DataFrame, key: str, text: str, block_words: int):
    """Broadcast automata, each of a bounded number of item words.

    The items stream through the driver block by block; only one automaton is in
    the making at a time. An item of more words is a block of its own.
    """
    context = items.sparkSession.sparkContext
    rows = items.select(items[key].cast("string").alias("k"), items[text].cast("binary").alias("t"))
    block: list[tuple[str, list[bytes]]] = []
    size = 0
    for row in rows.where("k IS NOT NULL").toLocalIterator():
        words = words_of(row.t)
        if block and size + len(words) > block_words:
            yield context.broadcast(SuffixAutomaton.of(block).packed())
            block, size = [], 0
        block.append((row.k, words))
        size += len(words)
    yield context.broadcast(SuffixAutomaton.of(block).packed())  # without items, one that knows nothing


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with a struct column ``found``: ``n_words``, ``hits`` (stretches of word numbers)
    and ``items`` (ids of the items with an occurring window, sorted as strings, each once).

    A null text has no words; an item that is null, has a null id or no words
    matches nothing; without items nothing is hit. Repeated rows each keep their
    row and extra columns pass through; an input column named ``found`` is
    replaced. A text of any length is searched whole; without documents the result is
    empty. One scan per block of items, no shuffle.
    """
    found = F.lit(None).cast(f"struct<{_TYPE}>")
    for automaton in _automata(items, item_key, item_text, block_words):
        docs = docs.withColumn("found", _scan(automaton)(F.col(text), found))
        found = F.col("found")
    return docs


_TYPE = "n_words:bigint,hits:array<struct<start:bigint,stop:bigint>>,items:array<string>"


def _scan(automaton):
    def run(texts: pa.Array, before: pa.Array) -> pa.Array:
        rows, known = [], Scanner(automaton.value)
        for text, old in zip(texts.cast(pa.binary()).to_pylist(), before.to_pylist(), strict=True):
            words = words_of(text)
            spans, names = known.scan(words)
            if old:
                spans = joined(spans + [(s["start"], s["stop"]) for s in old["hits"]])
                names = names | set(old["items"])
            hits = [{"start": a, "stop": b} for a, b in spans]
            rows.append({"n_words": len(words), "hits": hits, "items": sorted(names)})
        return pa.array(rows, _ARROW)

    run.__annotations__ = {"texts": pa.Array, "before": pa.Array, "return": pa.Array}
    # not deterministic as far as the optimizer knows: it then runs once, whatever reads it
    return F.arrow_udf(run, f"struct<{_TYPE}>").asNondeterministic()


_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the given stretches of words and what stands between their words."""
    raw = text.encode("utf-8")
    flags = np.frombuffer(raw.translate(_WORD_BYTES), np.uint8).astype(np.int8)
    edge = np.flatnonzero(np.diff(np.r_[0, flags, 0])).reshape(-1, 2)
    out, at = [], 0
    for start, stop in spans:
        out.append(raw[at : edge[start][0]])
        at = edge[stop - 1][1]
    return b"".join([*out, raw[at:]]).decode("utf-8")


_WORD_BYTES = bytes(int(b >= 128 or chr(b).isalnum()) for b in range(256))


def remove_hits(docs: DataFrame, items: DataFrame, max_share: float = 0.5, **options) -> DataFrame:
    """Cleaned ``docs``: hit stretches are cut out of ``text``, and ``n_chars`` (if there) is
    counted anew; a document of whose words more than ``max_share`` are hit goes. Other
    documents, null and empty texts included, stay as they are, with the columns they had,
    whatever these are called. Repeated rows are all treated alike; long texts are searched
    whole; without documents the result is empty, without items it is ``docs``.
    """
    columns = docs.columns

    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), found.to_pylist(), strict=True)
        cuts = ([(h["start"], h["stop"]) for h in f["hits"]] for _, f in pairs)
        return pa.array([cut_text(t, c) if c else t for t, c in zip(texts.to_pylist(), cuts, strict=True)], pa.string())

    cut.__annotations__ = {"texts": pa.Array, "found": pa.Array, "return": pa.Array}
    rows = find_hits(docs.select(whole_row(docs).alias("row"), F.col("text")), items, **options)
    hit = F.aggregate("found.hits", F.lit(0).cast("long"), lambda n, h: n + h.stop - h.start)
    rows = rows.where(hit <= max_share * F.col("found.n_words"))
    rows = rows.withColumn("text", F.arrow_udf(cut, "string")(F.col("text"), F.col("found")))
    changed = {"text": F.col("text")}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        count = F.length("text").cast(kind)
        changed["n_chars"] = F.when(F.size("found.hits") > 0, count).otherwise(F.col("row.n_chars"))
    return rows.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in columns))


def hit_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    rows = find_hits(docs.select("doc_id", "text"), items)
    n_hit = F.aggregate("found.hits", F.lit(0).cast("long"), lambda n, h: n + h.stop - h.start)
    return rows.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
