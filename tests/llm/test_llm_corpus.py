"""Operators over the whole corpus, and the pipeline."""

import math
import os
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from awkward import documents, empty, plain  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from check import compare  # noqa: E402
from reelbook.llm import decontaminate, mixing, quality, secrets, sharding, similarity, toxicity  # noqa: E402
from reelbook.llm.common import words_of  # noqa: E402
from reelbook.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, name):
    assert compare(spark, SF, name, QUERIES[name], ORACLES[name]) is None


def test_registered():
    assert [n for n in entry.queries() if n.startswith("op")] == list(QUERIES)
    assert "pipeline" in entry.queries()


# mixing


def targets_by_hand(sizes):
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    target, full, total = {}, set(), 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(2.0 * sizes[s] for s in full)
        share = sum(weight[s] for s in sizes if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else rest * weight[s] / share for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > 2.0 * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    draw = random.Random(seed)
    sizes = {f"s{i}" if i else None: draw.choice([0, 1, 5, 100, 3000]) for i in range(draw.randint(1, 9))}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = targets_by_hand(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    assert got == pytest.approx(want)


@pytest.mark.parametrize("make", ["given", "awkward"])
def test_mix(spark, docs, make):
    frame = docs if make == "given" else documents(spark)
    rows = mixing.plan(frame)
    found = rows.collect()
    assert len(found) == frame.count()
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((r.doc_id, len((r.text or "").split())) for r in frame.select("doc_id", "text").collect() if "\x00" not in (r.text or "")) + Counter((r.doc_id, 4) for r in frame.select("doc_id", "text").collect() if "\x00" in (r.text or ""))
    assert all(r.taken == r.copies * r["size"] and r.copies <= 2 for r in found)
    again = mixing.plan(frame.repartition(7))
    assert plain(rows) == plain(again)
    by_source = defaultdict(list)
    for r in found:
        by_source[r.target, r.source_size].append(r)
    for (target, _), members in by_source.items():
        taken, largest = sum(r.taken for r in members), max(r["size"] for r in members)
        n = sum(r.source_size == members[0].source_size and r.target == target for r in found)
        assert abs(taken - target * (sum(r["size"] for r in members) / members[0].source_size if members[0].source_size else 0)) <= largest + 1e-6, n
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    assert mixed.count() == sum(r.copies for r in found)


def test_copies_are_as_likely_as_they_should_be(spark):
    """Over many seeds, each document of a source is taken in proportion to its target."""
    rows = [(i, "w " * (1 + i % 7), "a" if i < 60 else "b") for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    total = Counter()
    for seed in range(12):
        for r in mixing.plan(frame, seed=seed).where("source_size > 0").collect():
            total[r.doc_id] += r.copies - r.target / r.source_size
    assert abs(np.mean(list(total.values()))) < 0.5
    assert max(map(abs, total.values())) < 9


def test_mix_of_nothing(spark):
    assert mixing.plan(empty(spark)).count() == 0
    assert mixing.mix(empty(spark)).columns == documents(spark).columns


# sharding


@pytest.mark.parametrize("seed", range(100))
def test_cuts_are_minimax(seed):
    draw = random.Random(seed)
    shards, sizes = draw.randint(1, 5), [draw.randint(0, 20) for _ in range(draw.randint(1, 12))]
    capacity, places = sharding.cuts(sizes, shards)
    best = [[0 if i == len(sizes) else 10**9 for i in range(len(sizes) + 1)]]
    for _ in range(shards):
        best.append([min(max(sum(sizes[i:j]), best[-1][j]) for j in range(i, len(sizes) + 1)) for i in range(len(sizes) + 1)])
    assert places == sorted(places) and len(places) == shards + 1 and places[-1] == len(sizes)
    assert max(sum(sizes[a:b]) for a, b in zip(places, places[1:], strict=False)) == capacity == best[-1][0]


@pytest.mark.parametrize("make", ["given", "awkward"])
def test_shards(spark, docs, make):
    frame = docs if make == "given" else documents(spark)
    rows = sharding.shard(frame, keep=["doc_id", "text"]).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in frame.collect())
    slots, homes, sizes = defaultdict(list), defaultdict(set), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        homes[r.text or ""].add(r.shard)
        sizes[r.shard] += r["size"]
        assert r["size"] == len((r.text or "").encode()) + 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    groups = Counter()
    for r in rows:
        groups[r.text] += r["size"]
    assert max(sizes.values()) <= sum(sizes.values()) / 40 + max(groups.values())
    assert sharding.shard(empty(spark)).count() == 0


def test_written_shards(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 5


# similarity


def links_by_hand(texts):
    sets, holders, links = {}, defaultdict(list), defaultdict(set)
    for i, text in enumerate(texts):
        words = words_of((text or "").encode())
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()
        sets[i] = grams
        for g in grams:
            holders[g].append(i)
    for i, grams in sets.items():
        for j, n in Counter(j for g in grams for j in holders[g]).items():
            if i != j and 9 * n >= 4 * (len(grams) + len(sets[j])):
                links[i].add(j)
    label = {}
    for i in sets:
        open_ = [i] if i not in label else []
        while open_:
            at = open_.pop()
            if at not in label:
                label[at] = i
                open_ += links[at]
    return {i: (label[i], len(links[i])) for i in sets}


def family(draw, size, copies, edits):
    base = [f"v{draw.randint(0, 10**6)}" for _ in range(size)]
    for _ in range(copies):
        words = list(base)
        for _ in range(draw.randint(0, edits)):
            words[draw.randrange(size)] = f"e{draw.randint(0, 10**6)}"
        yield " ".join(words)


def test_links(spark, docs):
    draw = random.Random(2)
    texts = [r.text for r in docs.orderBy("doc_id").collect()] + ["", None, "!!", "one", "One!", "a b c d", "a b c d"]
    for size, copies, edits in [(300, 40, 6), (60, 30, 3), (12, 20, 1), (2000, 5, 80)]:
        texts += family(draw, size, copies, edits)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = similarity.classes(frame).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows} == links_by_hand(texts)


def test_large_groups_are_split_and_blocked(spark, monkeypatch):
    """With small limits the same links are found through deep splits, held parts and blocks."""
    draw = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = list(family(draw, 120, 60, 4)) + [passage + " " + " ".join(f"q{draw.randint(0, 10**6)}" for _ in range(90)) for _ in range(80)]
    texts += list(family(draw, 200, 40, 30))
    for name, value in {"LEAF": 8, "BLOCK_SETS": 10, "TILE": 7}.items():
        monkeypatch.setattr(similarity, name, value)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in similarity.classes(frame).collect()}
    want = links_by_hand(texts)
    assert sum(got[i] != want[i] for i in want) == 0


def test_runs_reach_the_target():
    q = 1.0
    for _ in range(100):
        q = 1 - (1 - 0.8 * q) ** similarity.BRANCH
    assert (1 - q) ** similarity.runs_for() <= 1 - similarity.TARGET


def test_components(spark):
    draw = random.Random(1)
    pairs = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)]
    label = {v: v for p in pairs for v in p}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.root for r in similarity.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {v: r for v, r in label.items() if v in got} and all(r == v for v, r in label.items() if v not in got)


def test_one_of_each_group(spark):
    frame = documents(spark)
    kept = similarity.keep_one(frame)
    assert kept.columns == frame.columns
    texts = Counter(r.text for r in kept.collect())
    body = " ".join(f"word{i}" for i in range(80))
    assert texts[body] == 1 and texts[body + " more"] == 0 and texts[None] == texts[""] == 1
    assert texts["no id at all"] == texts["same id, other text"] == 1
    assert similarity.keep_one(empty(spark)).count() == 0
    rows = similarity.classes(frame)
    assert rows.count() == frame.count()


# toxicity


def segments_by_hand(values):
    """Maximal segments by their definition: the best one, then those left and right of it."""
    best, at = 0.0, None
    for a in range(len(values)):
        for b in range(a + 1, len(values) + 1):
            total = sum(values[a:b])
            if total > best + 1e-9:
                best, at = total, (a, b)
    if at is None:
        return []
    a, b = at
    left, right = segments_by_hand(values[:a]), segments_by_hand(values[b:])
    return left + [(a, b, best)] + [(x + b, y + b, s) for x, y, s in right]


@pytest.mark.parametrize("seed", range(60))
def test_segments(seed):
    draw = random.Random(seed)
    scores = {b"p": 1.0, b"q": 2.5, b"r": 0.5}
    words = draw.choices([b"p", b"q", b"r", b"x", b"y"], [1, 1, 1, 4, 4], k=draw.randint(0, 30))
    got = toxicity.segments(words, scores, cost=0.7)
    want = segments_by_hand([scores.get(w, -0.7) for w in words])
    assert sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in want))
    assert max((s for *_, s in got), default=0) == pytest.approx(max((s for *_, s in want), default=0))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = toxicity.toxicity_digest(docs, labels).where("held_out").join(labels, "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in judged.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.85
    assert n.get((0, 1), 0) / n[0, 0] < 0.005


def test_labels_are_not_inputs(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    assert plain(toxicity.toxicity_digest(docs, labels)) == plain(toxicity.toxicity_digest(docs, turned))


def test_toxicity_of_awkward_input(spark, docs):
    labels = spark.createDataFrame([(None, 1), (3, None), (3, 1), (3, 0), (4, 0), (6, 0)], "doc_id long, toxic int")
    for known in (labels, labels.where("false")):
        rows = toxicity.toxicity_digest(documents(spark), known).collect()
        assert len(rows) == documents(spark).count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert toxicity.toxicity_digest(empty(spark), labels).count() == 0


# pipeline


def test_stages(spark, docs):
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == docs.columns, name
    found = corpus_pipeline.run(spark, SF)
    assert plain(found.select("doc_id")) == plain(frame.select("doc_id"))


def test_pipeline_against_brute_force(spark, docs):
    """What the first stages leave follows from rules that are simple to state."""
    kept = {r.doc_id for r in quality.quality_digest(docs).where("kept").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    ids = sorted(texts)
    links = links_by_hand([texts[i] for i in ids])
    first = {ids[links[k][0]] for k in range(len(ids))}
    got = {r.doc_id for r in similarity.keep_one(quality.keep_good(docs)).collect()}
    assert got == first


def test_pipeline_of_awkward_documents(spark, tmp_path):
    folder = str(tmp_path)
    for frame in (documents(spark), empty(spark)):
        frame.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
        assert corpus_pipeline.run(spark, folder).count() <= 2 * frame.count()


# what stages hand on


def named_awkwardly(spark):
    """Documents with repeats whose other columns differ, and names that could clash."""
    body = " ".join(f"word{i}" for i in range(80))
    texts = [body, body + " more", " ".join(f"other{i}" for i in range(90)), " ".join(f"third{i % 95}" for i in range(100))]
    data = [(i, t, "en", f"s{i % 2}", len(t), f"x{i}", j) for i, t in enumerate(texts) for j in range(3)]
    data += [(0, body, "en", "s0", len(body), "x0", 0)] * 2 + [(9, None, None, None, None, None, 1)]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, kept long")
    return frame.selectExpr(
        "*", "'w' AS __words", "concat('n', kept) AS n_words", "'r' AS row", "'c' AS copies", "'h' AS h", "'p' AS part",
        "'t' AS taken", "'k' AS k1", "'l' AS `limit``s`", "'z' AS size",
    )


def test_stages_keep_values_of_clashing_columns(spark):
    docs = named_awkwardly(spark)
    given = Counter(tuple(r) for r in docs.collect())
    good = quality.keep_good(docs)
    assert good.columns == docs.columns
    assert Counter(tuple(r) for r in good.collect()) == Counter({r: n for r, n in given.items() if r[1]})
    assert quality.judge(docs).columns == [c for c in docs.columns if c not in quality.ADDED] + list(quality.ADDED)
    one = similarity.keep_one(docs)
    rows = [tuple(r) for r in one.collect()]
    assert one.columns == docs.columns and set(rows) <= set(given) and len(rows) == 4
    assert plain(similarity.keep_one(docs.repartition(5))) == sorted(rows, key=repr)
    items = spark.createDataFrame([(1, " ".join(f"other{i}" for i in range(30)))], "item_id long, text string")
    clean = decontaminate.remove_hits(docs, items)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert set(plain(clean.where("doc_id <> 2"))) == {r for r in given if r[0] != 2 and r[0] is not None}
    sharded = sharding.shard(docs, 3, keep=docs.columns)
    kept = [c for c in docs.columns if c not in ("size", "text_crc32", "shard", "slot")]
    assert plain(sharded.select(*(f"`{c.replace('`', '``')}`" for c in kept))) == plain(docs.drop("size"))
    found = secrets.find_secrets(docs)
    assert found.count() == docs.count() and "a.b" in found.columns


def test_mix_takes_every_version(spark):
    """Rows that share id and text but differ elsewhere all have their part of the copies."""
    docs = named_awkwardly(spark)
    given = Counter(tuple(r) for r in docs.collect())
    for weights, share in (((1.0,), 1.0), ((5.0, 2.0, 1.0), 1.5), ((1.0, 3.0), 0.4)):
        mixed = mixing.mix(docs, weights=weights, share=share)
        assert mixed.columns == docs.columns
        rows = Counter(tuple(r) for r in mixed.collect())
        assert set(rows) <= set(given)
        assert plain(mixing.mix(docs.repartition(7), weights=weights, share=share)) == sorted(rows.elements(), key=repr)
        copies = {r.doc_id: r.n for r in mixing.plan(docs, weights, share).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()}
        per_id = Counter()
        for row, n in rows.items():
            per_id[row[0]] += n
        assert per_id == Counter({i: n for i, n in copies.items() if n})
        total = Counter()
        for row, n in given.items():
            total[row[0]] += n
        for row, n in given.items():
            low = n * (copies[row[0]] // total[row[0]])
            assert low <= rows[row] <= low + n
    # everything once: nothing is lost
    assert Counter(tuple(r) for r in mixing.mix(docs.where("text IS NOT NULL"), weights=(1.0,), share=0.5, most=1.0).collect()) <= given


# toxicity, by hand


def labelled(spark, n=400):
    """Texts of both classes over few words, some of which one class has more often."""
    draw = random.Random(8)
    rows = []
    for i in range(n):
        toxic = int(draw.random() < 0.3)
        words = draw.choices(["plain", "word", "of", "text", "And", "more"], k=draw.randint(0, 40))
        words += draw.choices(["bad", "worse", "worst"], k=draw.randint(0, 6) if toxic else int(draw.random() < 0.02))
        draw.shuffle(words)
        rows.append((i, toxic, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, toxic int, text string")
    return rows, frame.withColumn("text", F.col("text").cast("binary"))


def scores_by_hand(rows):
    t, c = Counter(), Counter()
    for _, toxic, text in rows:
        (t if toxic else c).update(words_of(text.encode()))
    n_t, n_c = sum(t.values()), sum(c.values())
    weight, out = toxicity.PRIOR * (n_t + n_c), {}
    for word in t:
        a = weight * (t[word] + c[word]) / (n_t + n_c)
        x, y = t[word] + a, c[word] + a
        odds = math.log(x / (n_t + weight - x)) - math.log(y / (n_c + weight - y))
        score = odds - toxicity.CAUTION * math.sqrt(1 / x + 1 / y)
        if score > toxicity.LEAST:
            out[word] = score
    return out


def test_log_odds_by_hand(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST", -50.0)
    rows, frame = labelled(spark)
    got, want = toxicity.word_scores(frame), scores_by_hand(rows)
    assert got.keys() == want.keys() and len(want) >= 9
    assert all(abs(got[w] - want[w]) < 1e-9 for w in want)
    assert toxicity.word_scores(frame.where("toxic = 0")) == {} == toxicity.word_scores(frame.where("toxic = 1"))
    assert toxicity.word_scores(frame.where("false")) == {}


def test_calibration_by_hand(spark):
    rows, frame = labelled(spark)
    scores = {b"bad": 2.0, b"worse": 3.0, b"worst": 2.5}
    model = toxicity._calibrated(frame, toxicity.Model(scores))
    top = lambda words: max((s for *_, s in toxicity.segments(words, scores)), default=0.0)
    clean = [top(w) - math.log(max(len(w), 1)) for w in (words_of(t.encode()) for _, y, t in rows if not y)]
    # the mean of an extreme value lies Euler's constant above its mode
    assert abs(model.log_k - (sum(clean) / len(clean) - toxicity._EULER)) < 1e-9
    x = np.array([model.evidence(words_of(t.encode()))[0] for *_, t in rows])
    x = np.round(np.clip(x, toxicity.LOW, toxicity.HIGH) / toxicity.STEP) * toxicity.STEP
    y = np.array([t for _, t, _ in rows])

    def loss(slope, shift):
        z = slope * x + shift
        return np.sum(np.logaddexp(0, z) - y * z) + 0.005 * (slope**2 + shift**2)

    best = loss(model.slope, model.shift)
    for a in np.linspace(-0.3, 0.3, 13):
        for b in np.linspace(-0.3, 0.3, 13):
            assert best <= loss(model.slope + a, model.shift + b) + 1e-6
