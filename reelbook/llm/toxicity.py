"""Toxic passages by maximum-scoring segments.

A word's score is the lower end of its log-odds between toxic and clean texts, both
multinomials over words under one Dirichlet prior, whose weights follow the counts of
all labelled texts; every other word costs a little. One
linear scan of a text finds all its maximal segments. Their scores are compared with
what the best segment of a clean text of that length reaches by chance (an extreme
value), and the evidence of all significant ones is added up and calibrated to a
probability.
"""

from __future__ import annotations

import sys
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelbook.llm.common import saved, words_of

#: Python workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled rows that a model is learned from at most, lowest hash of the id first.
TRAIN_ROWS = 40_000
#: Share of the labelled words that the prior counts as, and standard errors taken off a log-odds.
PRIOR, CAUTION = 0.05, 2.0
#: Log-odds that a word needs after that; words that are barely toxic would only add noise.
LEAST = 3.0
#: Distinct words that a task counts before it hands the counts on.
COUNTED = 20_000
#: What a word outside the model costs, in nats.
COST = 0.25
#: Evidence is counted in steps of this size when it is calibrated, within these ends.
STEP, LOW, HIGH = 0.25, -20.0, 400.0
_EULER = 0.5772156649


@dataclass(frozen=True)
class Model:
    scores: dict[bytes, float]
    #: log of the factor K in the chance of a segment (Karlin and Altschul); lambda is 1 for log-odds.
    log_k: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def evidence(self, words: list[bytes]) -> tuple[float, list[tuple[int, int, float]]]:
        """Added evidence of a text, and its significant passages ``(start, stop, score)`` in words."""
        found = segments(words, self.scores)
        chance = self.log_k + math.log(max(len(words), 1))
        over = [(a, b, s) for a, b, s in found if s > chance]
        if over:
            return sum(s - chance for *_, s in over), over
        return max((s for *_, s in found), default=0.0) - chance, over

    def score(self, evidence: float) -> float:
        x = self.slope * min(max(evidence, LOW), HIGH) + self.shift
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def segments(words: Sequence[bytes], scores: dict[bytes, float], cost: float = COST) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (Ruzzo and Tompa), in one pass over the scored words."""
    stack: list[tuple[int, int, float, float]] = []  # start, stop, sum before, sum at the end
    total, last = 0.0, 0
    for at, word in enumerate(words):
        gain = scores.get(word)
        if gain is None:
            continue
        total -= cost * (at - last)
        start, before = at, total
        total += gain
        last = at + 1
        while stack:
            # the nearest segment that begins lower; those passed over stay apart
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j -= 1
            if j < 0 or stack[j][3] >= total:
                break
            start, before = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((start, last, before, total))
    return [(a, b, end - low) for a, b, low, end in stack]


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model from the labelled documents whose crc32 of the id, modulo 3, is not 1.

    For the calibration, words scored by the documents with remainder 0 are applied
    to those with remainder 2; the words of the model are scored by both. Of more than ``rows`` labelled ids those with the lowest hash are
    taken, so what is broadcast is bounded. A text counts once however often it is
    copied; a document with several labels is toxic if one says so; ids or labels
    that are null are left out. Without toxic or without clean texts no word has a
    score.
    """
    rest = _remainder(F.col("doc_id"))
    known = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).where((rest != 1) & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    known = known.select(F.col("doc_id").alias("__id"), "toxic")
    body = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.join(F.broadcast(known), F.col("doc_id") == F.col("__id")).select(
        rest.alias("part"), "toxic", body.cast("binary").alias("text"), F.xxhash64(body).alias("h")
    )
    texts = saved(texts.dropDuplicates(["part", "toxic", "h"]).drop("h"), "labelled")
    half = _calibrated(texts.where("part = 2"), Model(word_scores(texts.where("part = 0"))))
    return replace(half, scores=word_scores(texts))


def _remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def word_scores(texts: DataFrame) -> dict[bytes, float]:
    """Words with a score, from texts with ``toxic``: every word as often as it stands there.

    With y counts of a word in a class of n words and a prior of a0 words, of which the
    word has the share a that it has in all texts, its log-odds in the class are
    ``log((y + a) / (n + a0 - y - a))`` (Monroe, Colaresi and Quinn). Without words in one
    of the classes no word has a score.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}
        for batch in batches:
            for label, text in zip(*batch.columns, strict=True):
                for word in words_of(text.as_py()):
                    seen.setdefault(word, [0, 0])[label.as_py()] += 1
                if len(seen) > COUNTED:
                    yield rows_of(seen)
                    seen = {}
        yield rows_of(seen)

    def rows_of(seen: dict[bytes, list[int]]) -> pa.RecordBatch:
        clean, toxic = (pa.array([n[k] for n in seen.values()], pa.int64()) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(seen, pa.binary()), toxic, clean], names=["word", "t", "c"])

    label = (F.col("toxic") > 0).cast("int").alias("toxic")
    counts = texts.select(label, "text").mapInArrow(count, "word binary, t long, c long")
    counts = saved(counts.groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c")), "words")
    n_toxic, n_clean = counts.agg(F.sum("t"), F.sum("c")).first()
    if not n_toxic or not n_clean:
        return {}
    weight = PRIOR * (n_toxic + n_clean)
    prior = PRIOR * (F.col("t") + F.col("c"))
    t, c = F.col("t") + prior, F.col("c") + prior
    odds = F.log(t / (n_toxic + weight - t)) - F.log(c / (n_clean + weight - c))
    score = odds - CAUTION * F.sqrt(1 / t + 1 / c)
    # every such word: how many there are is bounded by the texts learned from
    best = counts.where("t > 0").select("word", score.alias("score")).where(F.col("score") > LEAST)
    return {bytes(r.word): r.score for r in best.toLocalIterator()}


def _calibrated(texts: DataFrame, model: Model) -> Model:
    """``model`` with the chance of a segment from clean texts, then a logistic fit over counted steps."""
    shared = texts.sparkSession.sparkContext.broadcast(model.scores)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t) for t in batch.column(1).to_pylist()]
            top = [max((s for *_, s in segments(w, shared.value)), default=0.0) for w in words]
            over = [s - math.log(max(len(w), 1)) for s, w in zip(top, words, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(over, pa.float64())], names=["toxic", "over"])

    clean = texts.where("toxic <= 0").select("toxic", "text").mapInArrow(best, "toxic int, over double")
    mean = clean.agg(F.avg("over")).first()[0]
    model = Model(model.scores, (mean or 0.0) - _EULER)
    fixed = texts.sparkSession.sparkContext.broadcast(vars(model))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**fixed.value)
        for batch in batches:
            found = [known.evidence(words_of(t))[0] for t in batch.column(1).to_pylist()]
            steps = np.round(np.clip(found, LOW, HIGH) / STEP).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(steps)], names=["toxic", "step"])

    counts = texts.select("toxic", "text").mapInArrow(weigh, "toxic int, step long")
    counts = counts.groupBy("step").agg(F.count_if(F.col("toxic") > 0).alias("t"), F.count("*").alias("n"))
    rows = np.array([(r.step * STEP, r.t, r["n"]) for r in counts.collect()], float).reshape(-1, 3)
    slope, shift = logistic(*rows.T)
    return Model(model.scores, model.log_k, slope, shift)


def logistic(x: np.ndarray, hits: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and shift of a logistic curve through counts, by damped Newton steps."""
    a = np.c_[x, np.ones_like(x)]
    w = np.array([0.0, 0.0])
    pull = np.array([1e-2, 1e-2])  # keeps the fit finite when the classes do not overlap
    loss = _loss(a, w, hits, n, pull)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        slope = a.T @ (n * p - hits) + pull * w
        curve = (a * (n * p * (1 - p))[:, None]).T @ a + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-6 and _loss(a, w - size * step, hits, n, pull) > loss:
            size /= 2
        w = w - size * step
        new = _loss(a, w, hits, n, pull)
        if loss - new < 1e-9:
            break
        loss = new
    return max(float(w[0]), 0.0), float(w[1])


def _loss(a: np.ndarray, w: np.ndarray, hits: np.ndarray, n: np.ndarray, pull: np.ndarray) -> float:
    z = a @ w
    return float(np.sum(n * np.logaddexp(0, z) - hits * z) + np.sum(pull * w * w) / 2)


_ARROW = pa.struct([
    ("score", pa.float64()),
    ("passages", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))),
])


def score_texts(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``toxicity``: ``score`` (0 to 1) and significant ``passages`` (word numbers).

    Only the text is an input. A null or empty text has no passage and the score of
    no evidence; a text of any length is scanned whole. Repeated rows score alike; other
    columns pass through, an input column ``toxicity`` is replaced; without rows the
    result is empty. One scan, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(texts: pa.Array) -> pa.Array:
        rows, known = [], Model(**shared.value)
        for t in texts.to_pylist():
            evidence, passages = known.evidence(words_of(t))
            spans = [{"start": a, "stop": b, "score": s} for a, b, s in passages]
            rows.append({"score": known.score(evidence), "passages": spans})
        return pa.array(rows, _ARROW)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    kind = "struct<score:double,passages:array<struct<start:bigint,stop:bigint,score:double>>>"
    return docs.withColumn("toxicity", F.arrow_udf(run, kind).asNondeterministic()(F.col(text).cast("binary")))


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``n_passages``."""
    rows = score_texts(docs.select("doc_id", "text"), train(docs.select("doc_id", "text"), labels))
    return rows.select(
        "doc_id",
        F.coalesce(_remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.7).cast("int").alias("predicted"),
        F.size("toxicity.passages").cast("long").alias("n_passages"),
    )
