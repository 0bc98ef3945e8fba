"""Token counts by rank-synchronous merging of ragged arrays.

The pre-tokens of a batch that have not been seen before lie in one flat array of
symbols. In every round each pre-token looks up the ranks of its neighbouring
pairs, and all occurrences of its lowest-ranked pair are merged at once, in all
pre-tokens together. A pre-token without a known pair is done; the symbols it has
left are its tokens. In a long pre-token the places of each rank are held, and a round
looks up ranks anew only beside the places it merges, so its cost follows its merges.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import DataFrame

#: Python workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Lower-case letters, numbers and white space below U+0100 (fixed values).
LETTERS = r"a-z\xAA\xB5\xBA\xDF-\xF6\xF8-\xFF"
NUMBERS = r"0-9\xB2\xB3\xB9\xBC-\xBE"
SPACE = r"\t-\r \x85\xA0"
WORD = re.compile(r"[^\t-\r ]+")
#: Known pre-tokens kept by a worker before it starts afresh.
KNOWN = 400_000
_NONE = np.iinfo(np.int64).max
#: Bytes from which a pre-token is merged by itself.
LONG = 4096


class WordBpe:
    """A byte-pair vocabulary with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"]
        shown = _byte_signs()
        self.size = len(vocab)
        self.inner = np.array([vocab[c] for c in shown], np.int64)
        self.last = np.array([vocab[c + end] for c in shown], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pieces = re.compile(rf"[{LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{NUMBERS}]|[^{SPACE}{LETTERS}{NUMBERS}]+")
        self.known: dict[str, int] = {}
        self.path, self.library, self.cut = path, None, {}

    def pre_tokens(self, text: str) -> list[str]:
        """Pieces of a text. Words with characters from U+0100 on are cut by the library's own
        tables, since which of them are letters depends on the edition of Unicode."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return [piece for word in WORD.findall(text) for piece in self._word(word)]
        return self.pieces.findall(text.lower())

    def _word(self, word: str) -> list[str]:
        if max(word) < "\u0100":
            return self.pieces.findall(word.lower())
        found = self.cut.get(word)
        if found is None:
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path)
            plain = self.library.normalizer.normalize_str(word)
            found = [plain[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]
            if len(self.cut) > KNOWN:
                self.cut.clear()
            self.cut[word] = found
        return found

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        parts, extra = [], []
        for text in texts:
            pieces = self.special.split(text) if text and self.special else [text or ""]
            extra.append(len(pieces) - 1)
            parts.append([w for p in pieces for w in self.pre_tokens(p)])
        if len(self.known) > KNOWN:
            self.known.clear()
        new = sorted({w for words in parts for w in words} - self.known.keys())
        self.known.update((w, self.merged_length(w)) for w in new if len(w) >= LONG)
        new = [w for w in new if len(w) < LONG]
        for at in range(0, len(new), 100_000):
            some = new[at : at + 100_000]
            self.known.update(zip(some, self.merged_lengths(some), strict=True))
        return [sum(map(self.known.__getitem__, w)) + n for w, n in zip(parts, extra, strict=True)]

    def _found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where the pairs stand among the known ones; -1 for others."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
        return np.where(self.keys[at] == key, at, -1)

    def merged_length(self, word: str) -> int:
        """Symbols that one long word has left when no pair can be merged."""
        flat = np.frombuffer(word.encode("utf-8"), np.uint8)
        n = flat.size
        sym = self.inner[flat]
        sym[-1] = self.last[flat[-1]]
        # neighbours in both directions, and the known pair that begins at each place (-1: none)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        pair = np.full(n, -1, np.int64)
        held: dict[int, list[np.ndarray]] = {}
        heap: list[tuple[int, int]] = []

        def hold(places: np.ndarray) -> None:
            found = self._found(sym[places], sym[after[places]])
            pair[places] = found
            places, found = places[found >= 0], found[found >= 0]
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
            cuts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if found.size else found
            for which, some in zip(found[cuts].tolist(), np.split(places, cuts[1:]), strict=True) if found.size else ():
                if which not in held:
                    held[which] = []
                    heapq.heappush(heap, (int(self.ranks[which]), which))
                held[which].append(some)

        hold(np.arange(n - 1))
        left = n
        while heap:
            _, which = heapq.heappop(heap)
            places = np.unique(np.concatenate(held.pop(which)))
            places = places[pair[places] == which]
            if not places.size:
                continue
            # a letter repeated: from the left end of each run, every second pair merges
            follows = np.r_[False, after[places[:-1]] == places[1:]]
            rank = np.arange(places.size)
            head = np.maximum.accumulate(np.where(follows, 0, rank))
            places = places[(rank - head) % 2 == 0]
            gone = after[places]
            sym[places] = self.made[self.ranks[which]]
            after[places] = after[gone]
            inside = after[places] < n
            before[after[places][inside]] = places[inside]
            pair[gone] = -1
            pair[places] = -1
            left -= places.size
            beside = np.unique(np.r_[places, before[places]])
            beside = beside[beside >= 0]
            pair[beside] = -1
            hold(beside[after[beside] < n])
        return left

    def merged_lengths(self, words: list[str]) -> list[int]:
        """Symbols that each (non-empty) word has left when no pair can be merged."""
        raw = [w.encode("utf-8") for w in words]
        length = np.array([len(w) for w in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        stop = np.cumsum(length)
        sym = self.inner[flat]
        sym[stop - 1] = self.last[flat[stop - 1]]
        owner = np.repeat(np.arange(len(words)), length)
        done = length.copy()
        while sym.size:
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            key = np.full(sym.size, -1, np.int64)
            inside = owner[1:] == owner[:-1]
            key[:-1][inside] = sym[:-1][inside] * self.size + sym[1:][inside]
            at = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
            rank = np.where(self.keys[at] == key, self.ranks[at], _NONE)
            best = np.minimum.reduceat(rank, start)
            mine = np.repeat(best, np.diff(np.r_[start, sym.size]))
            hit = (rank == mine) & (rank != _NONE)
            # a run of hits is one letter repeated: from its left end, every second pair merges
            place = np.arange(sym.size)
            head = hit & ~np.r_[False, hit[:-1]]
            head_at = np.maximum.accumulate(np.where(head, place, -1))
            hit &= (place - head_at) % 2 == 0
            sym[hit] = self.made[rank[hit]]
            done -= np.bincount(owner[hit], minlength=done.size)
            keep = ~np.r_[False, hit[:-1]]
            sym, owner, mine = sym[keep], owner[keep], mine[keep]
            live = mine != _NONE
            sym, owner = sym[live], owner[live]
        return done.tolist()


def _byte_signs() -> list[str]:
    """The printable sign that stands for each byte: itself, or the next free one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 2048, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``vocabulary`` is the path of a tokenizer file that every worker can read. A
    null or empty text has 0 bytes and 0 tokens; a null key stays null; repeated
    rows each give a row; other columns are not read. A text of any length is
    counted whole. One scan, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            size = pa.compute.fill_null(pa.compute.binary_length(texts.cast(pa.binary())), 0)
            n = pa.array(bpe.counts(texts.to_pylist()), pa.int64())
            over = pa.compute.greater(n, limit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), size.cast(pa.int64()), n, over],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return rows.mapInArrow(run, schema)
