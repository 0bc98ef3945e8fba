"""Token ids of documents in files of grammars (Re-Pair).

Documents in order of their key are cut into shards of whole documents. In each shard
frequent pairs of neighbouring ids are replaced by nonterminals, again and again; the
rules, how many ids each stands for, and what is left of the ids are one binary record:

======== ======== ==========================================================
offset   type     content
======== ======== ==========================================================
0        4 bytes  ``RPG1``
4        u32      ``base``: ids below it are terminals, ``base + i`` is rule i
8        u32      number of rules, R
12       u32      number of symbols, S
16       u32 x R  left symbol of each rule
..       u32 x R  right symbol; both are terminals or earlier rules
..       u32 x R  number of ids the rule stands for
..       u32 x S  the symbols
======== ======== ==========================================================

All numbers are little-endian. Records lie in Parquet as carrier, one row each with its
part, its number in the part, its first id within the part, its number of ids, and keys
and lengths of its documents; so any file system does, a task that is lost writes its
part again, and a range of ids is found by the statistics of the files.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelbook.session import scratch_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = b"RPG1"
#: Ids of a shard, unless one document has more.
SHARD_IDS = 1 << 17
#: A pair is frequent if it stands so often in its shard.
LEAST_COUNT = 8
#: Pairs a SHARE-th as frequent as the most frequent one are replaced in the same round.
SHARE = 64
#: Rounds end after one that saves less than this part of the symbols.
SAVED = 32
#: Bytes of text of one part (a task's share of the files).
PART_BYTES = 64 << 20
#: Words (and pieces) whose ids a worker keeps, and their characters.
KNOWN_WORDS = 600_000
KNOWN_LETTERS = 32_000_000
#: Bytes of rows whose words are looked up together.
BATCH_BYTES = 12 << 20
#: Words whose ids are put in their places together.
STRETCH = 1 << 14
#: How the tokenizer cuts a lower-case text of characters below U+0100 (fixed values:
#: its own pattern, with letters and numbers written out), and the ends of words here.
LETTERS = r"a-z\xAA\xB5\xBA\xDF-\xF6\xF8-\xFF"
NUMBERS = r"0-9\xB2\xB3\xB9\xBC-\xBE"
PIECES = re.compile(rf"[{LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{NUMBERS}]|[^\x09-\x0D\x20\x85\xA0{LETTERS}{NUMBERS}]+|\n")
MARK = b"\xFF" * 4
#: The printable sign that stands for each byte: itself, or the next free one from U+0100.
PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
SIGNS = {b: b if b in PLAIN else 256 + sum(c not in PLAIN for c in range(b)) for b in range(256)}


def _taken(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Which pairs, the most frequent first, can be replaced at the same time.

    No symbol may be the left one of a pair and the right one of another, so no two
    occurrences overlap; a symbol doubled stands alone.
    """
    lefts: set[int] = set()
    rights: set[int] = set()
    taken = []
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        if a in rights or b in lefts or (a == b and (a in lefts or b in rights)):
            continue
        lefts.add(a)
        rights.add(b)
        if a == b:
            rights.add(a)
            lefts.add(b)
        taken.append(i)
    return taken


def compress(ids: np.ndarray, least: int = LEAST_COUNT) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``base``, left and right symbols of the rules, their lengths, and the symbols left of ``ids``.

    Each round replaces the pairs that stand ``least`` times and a :data:`SHARE`-th as
    often as the most frequent one, as far as they cannot overlap. Rounds end when no
    pair does, or after one that saves less than a :data:`SAVED`-th of the symbols.
    """
    symbols = ids.astype(np.int64)
    base = int(symbols.max()) + 1 if symbols.size else 0
    lefts, rights = [], []
    made, before = base, 0
    while symbols.size > 1 and before != symbols.size:
        code, place, limit = _frequent_pairs(symbols, made, least)
        if not code.size:
            break
        opens = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        often = np.diff(np.r_[opens, code.size])
        frequent = np.flatnonzero(often >= limit)
        if not frequent.size:
            break
        frequent = frequent[np.argsort(-often[frequent], kind="stable")]
        pairs = code[opens[frequent]]
        left, right = pairs >> 32, pairs & 0xFFFFFFFF
        taken = _taken(left, right)
        frequent, left, right = frequent[taken], left[taken], right[taken]
        size = often[frequent]
        at = place[np.repeat(opens[frequent] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        rule = np.repeat(np.arange(made, made + frequent.size), size)
        if (left == right).any():
            # neighbouring places are a symbol doubled again and again: every second one counts
            order = np.argsort(at)
            at, rule = at[order], rule[order]
            heads = np.r_[True, np.diff(at) > 1]
            even = (at - np.maximum.accumulate(np.where(heads, at, 0))) % 2 == 0
            at, rule = at[even], rule[even]
        symbols[at] = rule
        stay = np.ones(symbols.size, bool)
        stay[at + 1] = False
        before = symbols.size
        symbols = symbols[stay]
        lefts.append(left)
        rights.append(right)
        made += frequent.size
        if (before - symbols.size) * SAVED < before:
            break
    none = np.zeros(0, np.int64)
    left, right = np.concatenate([none, *lefts]), np.concatenate([none, *rights])
    return base, left, right, _lengths(base, left, right), symbols


def _frequent_pairs(symbols: np.ndarray, made: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """All pairs of neighbours that stand ``limit`` times and some others, in order; their places; the limit.

    Pairs are counted in buckets first: a bucket has at least the count of each pair in it.
    """
    left, right = symbols[:-1], symbols[1:]
    short = symbols.astype(np.uint16)  # its products are the whole numbers' modulo 2^16
    bucket = (short * np.uint16(40503))[:-1] + (short * np.uint16(30011))[1:]
    counts = np.bincount(bucket)
    limit = max(least, int(counts.max()) // SHARE)
    place = np.flatnonzero((counts >= limit)[bucket])
    left, right = left[place], right[place]
    bits, room = int(made).bit_length(), int(symbols.size).bit_length()
    if 2 * bits + room < 64:  # pair and place fit one number
        key = (left << bits | right) << room | place
        key.sort()
        left, right = key >> (bits + room), (key >> room) & ((1 << bits) - 1)
        return left << 32 | right, key & ((1 << room) - 1), limit
    code = left << 32 | right
    order = np.argsort(code, kind="stable")
    return code[order], place[order], limit


def _lengths(base: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    lengths = [0] * left.size
    for i, (a, b) in enumerate(zip((left - base).tolist(), (right - base).tolist(), strict=True)):
        lengths[i] = (1 if a < 0 else lengths[a]) + (1 if b < 0 else lengths[b])
    return np.array(lengths, np.int64)


def pack(ids: np.ndarray, least: int = LEAST_COUNT) -> bytes:
    """The record of ``ids``."""
    base, left, right, lengths, symbols = compress(ids, least)
    head = np.array([base, left.size, symbols.size])
    return MAGIC + b"".join(part.astype("<u4").tobytes() for part in (head, left, right, lengths, symbols))


class Record:
    """Reads a record: all of its ids, or any range of them."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a grammar record")
        self.base, rules, size = np.frombuffer(data, "<u4", 3, 4).tolist()
        body = np.frombuffer(data, "<u4", 3 * rules + size, 16).astype(np.int64)
        self.left, self.right, self.lengths = body[: 3 * rules].reshape(3, rules)
        self.symbols = body[3 * rules :]
        spans = np.ones(self.symbols.size, np.int64)
        ruled = self.symbols >= self.base
        spans[ruled] = self.lengths[self.symbols[ruled] - self.base]
        self.ends = np.cumsum(spans)
        self._flat = None

    def __len__(self) -> int:
        return int(self.ends[-1]) if self.ends.size else 0

    def _expanded(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every terminal's place and rule, one after another, and where each rule's begin."""
        if self._flat is None:
            flat = np.stack([self.left, self.right], axis=1).ravel()
            while (ruled := flat >= self.base).any():
                wide = np.repeat(flat, 1 + ruled)
                second = np.cumsum(1 + ruled)[ruled] - 1
                wide[second - 1] = self.left[flat[ruled] - self.base]
                wide[second] = self.right[flat[ruled] - self.base]
                flat = wide
            self._flat = flat, np.cumsum(self.lengths) - self.lengths
        return self._flat

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from ``start`` to before ``stop``; only symbols that overlap the range are expanded."""
        stop = len(self) if stop is None else min(stop, len(self))
        start = min(max(start, 0), stop)
        first = int(np.searchsorted(self.ends, start, side="right"))
        last = int(np.searchsorted(self.ends, stop, side="left")) + 1 if stop > start else first
        symbols = self.symbols[first:last]
        flat, begins = self._expanded()
        ruled = symbols >= self.base
        spans = np.ones(symbols.size, np.int64)
        spans[ruled] = self.lengths[symbols[ruled] - self.base]
        origin = np.cumsum(spans) - spans
        skipped = start - (int(self.ends[first - 1]) if first else 0)
        out = np.repeat(symbols, spans)
        at = np.repeat(ruled, spans)
        where = np.arange(out.size) - np.repeat(origin, spans)
        out[at] = flat[begins[out[at] - self.base] + where[at]]
        return out[skipped : skipped + stop - start].astype("<u4")


class TextIds:
    """Ids of whole texts by the tokenizer library, asked once for each frequent piece.

    Made for a tokenizer that lower-cases, drops white space and cuts by :data:`PIECES`:
    words between blanks and U+0009 to U+000D do not touch each other. New words of
    characters below U+0100 alone, where lower-casing and letters do not depend on the
    edition of Unicode, are cut here and their pieces go to the library's merges; words of
    other characters or with special tokens go to the library whole.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one of many on its machine
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces: dict[str, bytes] = {}
        self._forget()

    @classmethod
    def of_worker(cls, vocabulary: str) -> TextIds:
        """The one that earlier tasks of this worker have used, with the words it knows, or a new one.

        It is kept at the library's module, which stays in the worker: this module travels
        by value, anew with each task.
        """
        import tokenizers

        held = getattr(tokenizers, "reelbook_held", None)
        if held is None or held[0] != vocabulary:
            held = tokenizers.reelbook_held = vocabulary, cls(vocabulary)
        return held[1]

    def _forget(self) -> None:
        """Known words by number, and their ids one after another, those of a word from ``starts`` on."""
        self.words: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, "<u4")
        self.letters = 0

    def _piece(self, piece: str) -> bytes:
        signs = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(SIGNS)
        return array("I", [token.id for token in self.model.tokenize(signs)]).tobytes()

    def _plain(self, text: str) -> bool:
        """Whether the text can be cut here."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(s in text for s in self.special)

    def _cut_here(self, words: list[str]) -> list[bytes]:
        """Ids of words without special tokens, of characters below U+0100."""
        pieces = PIECES.findall("\n".join(words).lower())
        for piece in set(pieces).difference(self.pieces):
            self.pieces[piece] = self._piece(piece)
        self.pieces["\n"] = MARK
        ids = np.frombuffer(b"".join(map(self.pieces.__getitem__, pieces)), "<u4")
        ends = np.r_[np.flatnonzero(ids == 0xFFFFFFFF), ids.size].tolist()
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip([0, *(e + 1 for e in ends[:-1])], ends, strict=True)]

    def _learn(self, words: list[str]) -> None:
        """Add new words to the known ones."""
        found: list[bytes] = [b""] * len(words)
        here, there = list(range(len(words))), []
        if not self._plain("\n".join(words)):
            here = [i for i, word in enumerate(words) if self._plain(word)]
            there = sorted(set(range(len(words))).difference(here))
        if here:
            for i, ids in zip(here, self._cut_here([words[i] for i in here]), strict=True):
                found[i] = ids
        whole = self.tokenizer.encode_batch_fast([words[i] for i in there], add_special_tokens=False)
        for i, e in zip(there, whole, strict=True):
            found[i] = np.array(e.ids, "<u4").tobytes()
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words)), strict=True))
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), "<u4")])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.letters += sum(map(len, words))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and where each text's end; a null has none."""
        if len(self.words) > KNOWN_WORDS or self.letters > KNOWN_LETTERS:
            self._forget()
        if len(self.pieces) > KNOWN_WORDS:
            self.pieces = {}
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(self.words.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(number < 0)
        if new.size:
            number[new] = np.arange(len(self.words), len(self.words) + new.size)
            self._learn(distinct[new].tolist())
        number = number[coded.indices.to_numpy()]
        starts = self.starts[number]
        sizes = self.starts[number + 1] - starts
        ends = np.cumsum(sizes)
        shift = starts - (ends - sizes)
        ids = np.empty(ends[-1] if ends.size else 0, "<u4")
        for a in range(0, ends.size, STRETCH):  # places of all ids at once would not fit a processor's cache
            some = slice(a, a + STRETCH)
            first, last = ends[a] - sizes[a], ends[some][-1]
            ids[first:last] = self.ids[np.repeat(shift[some], sizes[some]) + np.arange(first, last)]
        return ids, np.r_[0, ends][np.cumsum(pc.list_value_length(split).to_numpy())]


def _schema(kind: str) -> str:
    return (
        f"part int, number int, start long, n_ids long, doc_id array<{kind}>, doc_ids array<long>, record binary"
    )


def write_ids(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, key: str = "doc_id", text: str = "text"
) -> None:
    """Write the token ids of ``docs`` in ascending order of the key, each document ended by ``end_id``.

    ``vocabulary`` is the path of a tokenizer file that every worker can read. A null or
    empty text has its end id only; null keys come first; documents of one key stand in
    the order of a hash of their texts, so that repeated rows are all written and any
    order of theirs gives the same files' content; without rows no record is written;
    other columns are not read, whatever their names. A document of any length lies
    whole in one record. Texts are shuffled once, by ranges of key and hash; rows that
    agree in both are spread by their place in the input, so no key can fill a part.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.xxhash64(body).alias("mark"),
        F.monotonically_increasing_id().alias("place"),
        body.alias("text"),
    )
    size = docs.select(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(-(-size // PART_BYTES), min(least, 1 + size // (1 << 20)))
    order = ["doc_id", "mark", "place"]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    key_kind = pa.list_(rows.limit(0).toArrow().schema.field("doc_id").type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        library = TextIds.of_worker(vocabulary)
        keys, bodies, n, start, number = [], [], 0, 0, 0

        def record() -> pa.RecordBatch:
            counts = [body.size for body in bodies]
            values = [part, number, start, n, keys, counts, pack(np.concatenate(bodies))]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), key_kind, pa.list_(pa.int64()), pa.binary()]
            names = ["part", "number", "start", "n_ids", "doc_id", "doc_ids", "record"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in _larger(batches):
            ids, ends = library.batch(batch.column(1))
            ids = np.insert(ids, ends, end_id)
            ends = ends + np.arange(1, ends.size + 1)
            for one, a, b in zip(batch.column(0).to_pylist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                if n and n + b - a > SHARD_IDS:
                    yield record()
                    start, number = start + n, number + 1
                    keys, bodies, n = [], [], 0
                keys.append(one)
                bodies.append(ids[a:b])
                n += b - a
        if n:
            yield record()

    rows.mapInArrow(run, _schema(kind)).write.option("compression", "zstd").parquet(path)


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least :data:`BATCH_BYTES`, so that fewer words are looked up again."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BATCH_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part`` and ``part_start``, the ids before it: one row for each part, not for each record.

    The totals of the parts come to the driver, one number for some :data:`PART_BYTES` of text.
    """
    totals = spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before = np.cumsum([0, *(row.n for row in totals)]).tolist()
    rows = [(row.part, before[i]) for i, row in enumerate(totals)]
    return spark.createDataFrame(rows, "part int, part_start long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: ``doc_id``, ``start`` (ids before it), ``n_tokens``, ``ids`` (binary)."""
    records = spark.read.parquet(path)
    starts = F.broadcast(part_starts(spark, path))
    rows = records.join(starts, "part").select(
        (F.col("part_start") + F.col("start")).alias("start"), "doc_id", "doc_ids", "record"
    )
    kind = rows.schema["doc_id"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                counts = batch.column(2).slice(i, 1).flatten()
                n = counts.to_numpy()
                ends = np.cumsum(n)
                ids = Record(batch.column(3)[i].as_py()).ids().tobytes()
                cut = [ids[4 * (e - k) : 4 * e] for k, e in zip(n.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(i, 1).flatten(),
                        pa.array(ends - n + batch.column(0)[i].as_py()),
                        counts,
                        pa.array(cut, pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary")


def ids_between(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """Ids from ``start`` to before ``stop`` of the whole sequence: reads only the records that overlap it."""
    starts = part_starts(spark, path)
    records = spark.read.parquet(path).join(F.broadcast(starts), "part")
    at = F.col("part_start") + F.col("start")
    found = records.where((at < stop) & (at + F.col("n_ids") > start)).select(at.alias("at"), "record").orderBy("at")
    pieces = [Record(bytes(r.record)).ids(max(start - r.at, 0), stop - r.at) for r in found.toLocalIterator()]
    return np.concatenate([np.zeros(0, "<u4"), *pieces])


def id_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """What the files say of each document after they are written and read back."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "grammars")
    write_ids(docs.select("doc_id", "text"), path, vocabulary)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
