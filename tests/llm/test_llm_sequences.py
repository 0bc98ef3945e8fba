"""Periodic runs, token files and whitening, against brute force."""

import hashlib
import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from awkward import documents, empty, plain  # noqa: E402

from reelbook.llm import grammar, periodic, queries, whitening  # noqa: E402

SF = "/root/testdata/sf0.01"


# runs


def brute_runs(words):
    """Every maximal stretch of a period, by trying all periods at all places."""
    _, words = np.unique(np.array(words), return_inverse=True)
    n, seen = len(words), {}
    for q in range(1, n // 4 + 1):
        same = np.r_[False, words[:-q] == words[q:], False]
        turns = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            if j + q - i >= max(6, 4 * q):
                seen.setdefault((i, j + q), q)
    return sorted(((s, e - s, q) for (s, e), q in seen.items()), key=lambda r: (r[0], r[2]))


def test_cover_has_every_difference():
    assert {(a - b) % periodic.CYCLE for a in periodic.COVER for b in periodic.COVER} == set(range(periodic.CYCLE))


def test_extensions():
    draw = np.random.default_rng(2)
    for n in (8, 40, 300, 2000):
        words = np.r_[draw.integers(1, 3, n), 9]
        words[n // 2 : n] = words[: n - n // 2]
        a, b = draw.integers(0, n, 500), draw.integers(0, n, 500)
        a, b = a[a != b], b[a != b]
        for i, j, got in zip(a, b, periodic.Extensions(words)(a, b), strict=True):
            k = 0
            while words[i + k] == words[j + k]:
                k += 1
            assert got == k


def test_runs_equal_brute_force():
    draw = random.Random(1)
    for _ in range(400):
        texts = []
        for _ in range(draw.randint(1, 6)):
            letters, n = draw.randint(1, 4), draw.choice([0, 1, 5, 6, 7, 20, 60, 200])
            words = [draw.randint(1, letters) for _ in range(n)]
            if n and draw.random() < 0.5:
                a = draw.randrange(n)
                p = 1 + draw.randrange((n - a) // 3 + 1)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        got = periodic.runs_of([np.array(t, np.int64) for t in texts], 4)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [brute_runs(t) for t in texts]
    assert periodic.runs_of([], 0) == []


def digest_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_run_digest(spark):
    for frame in (spark.read.parquet(f"{SF}/documents.parquet"), documents(spark)):
        rows = periodic.run_digest(frame).drop("n_words")
        assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        assert plain(rows) == sorted((digest_row(*r) for r in frame.select("doc_id", "text").collect()), key=repr)
    assert periodic.run_digest(empty(spark)).count() == 0


def test_long_runs():
    words = np.tile(np.arange(1, 3002), 40)
    assert [tuple(r) for r in periodic.runs_of([words], 3001)[0].tolist()] == [(0, words.size, 3001)]


# token files


@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    return public.path("word_bpe_49k.json")


def test_records_round_trip():
    draw = random.Random(1)
    for n in (0, 1, 2, 5, 60, 400, 5000):
        for top in (0, 1, 5, 300, 2**32 - 2**20):
            ids = np.array([draw.randint(0, top) for _ in range(n)], np.int64)
            record = grammar.Record(grammar.pack(ids, 2))
            assert len(record) == n and record.ids().tolist() == ids.tolist()
            for _ in range(5):
                a = draw.randint(0, n + 1)
                b = draw.randint(a, n + 3)
                assert record.ids(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(ValueError):
        grammar.Record(b"none of ours....")


def test_records_are_grammars():
    ids = np.tile(np.arange(50), 200)
    base, left, right, lengths, symbols = grammar.compress(ids, 2)
    assert symbols.size + 3 * left.size < 400
    expanded = []
    for a, b in zip(left, right, strict=True):
        expanded.append([x for s in (a, b) for x in (expanded[s - base] if s >= base else [s])])
    assert [len(e) for e in expanded] == lengths.tolist()
    assert [x for s in symbols for x in (expanded[s - base] if s >= base else [s])] == ids.tolist()


def test_ids_of_odd_texts(vocabulary):
    import pyarrow as pa

    known = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    signs = ["a", "aa", "ab", "the", " ", "\t", "\n", "!", "'s", "'re", "'", "1", "é", "É", "é", "ΑΣ", "İ", "ß", "日本",
             "😀", "À", "×", "÷", "ª", "µ", "²", "¼", "ÿ", "Þ", "\xad", "<|endoftext|>", "<|startoftext|>", "<|END",
             "\x1c", "\x85", "\xa0", "½", "_", "हि", "K", "\x00", "́", " ", "Ž", "ſ", "\x7f", "\x9f"]
    draw = random.Random(4)
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 25))) for _ in range(5000)]
    points = [c for c in range(0x2FA20) if not 0xD800 <= c < 0xE000]
    texts += ["".join(map(chr, draw.choices(points, k=20))) for _ in range(3000)]
    texts += ["".join(map(chr, draw.choices(range(0x180), k=20))) for _ in range(3000)]
    texts += ["a" * n for n in range(60)] + ["Ha" * n for n in range(60)] + ["é" * 3000]
    want = [e.ids for e in known.encode_batch(texts, add_special_tokens=False)]
    library = grammar.TextIds(vocabulary)
    for part in (texts[:4000], texts[4000:], [None, ""]):
        ids, ends = library.batch(pa.array(part, pa.string()))
        got = [x.tolist() for x in np.split(ids, ends[:-1])]
        assert got == (want[:4000] if part is not texts and len(part) == 4000 else want[4000:] if len(part) > 2 else [[], []])


def token_rows(frame, vocabulary):
    known = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    rows = [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]
    found = known.encode_batch([t for _, t in rows], add_special_tokens=False)
    return [(d, np.array([*e.ids, 1], "<u4")) for (d, _), e in zip(rows, found, strict=True)]


def test_token_digest(spark, vocabulary):
    for frame in (spark.read.parquet(f"{SF}/documents.parquet"), documents(spark)):
        rows = grammar.id_digest(frame, vocabulary).collect()
        want = token_rows(frame, vocabulary)
        assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in rows) == sorted(
            (d or -1, ids.size, zlib.crc32(ids.tobytes())) for d, ids in want
        )
        rows.sort(key=lambda r: r.start)
        keys = [-1 if r.doc_id is None else r.doc_id for r in rows]
        assert keys == sorted(keys)
        assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    assert grammar.id_digest(empty(spark), vocabulary).count() == 0


def test_token_files_of_several_parts(spark, vocabulary, tmp_path, monkeypatch):
    monkeypatch.setattr(grammar, "PART_BYTES", 1 << 18)
    monkeypatch.setattr(grammar, "SHARD_IDS", 1 << 13)
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    grammar.write_ids(frame, str(tmp_path / "ids"), vocabulary)
    records = spark.read.parquet(str(tmp_path / "ids"))
    assert records.select("part").distinct().count() > 2 and records.where("number > 0").count()
    found = grammar.read_ids(spark, str(tmp_path / "ids")).orderBy("start").collect()
    want = dict(token_rows(frame, vocabulary))
    assert [r.doc_id for r in found] == sorted(want)
    assert all(bytes(r.ids) == want[r.doc_id].tobytes() for r in found)
    whole = np.concatenate([want[d] for d in sorted(want)])
    for a, b in ((0, 5), (12_345, 45_678), (whole.size - 3, whole.size + 9), (7, 7)):
        assert grammar.ids_between(spark, str(tmp_path / "ids"), a, b).tolist() == whole[a:b].tolist()


# whitening


def test_inertia_and_eigenpairs():
    draw = np.random.default_rng(3)
    for d in (1, 2, 3, 8, 9, 16, 40):
        for kind in range(4):
            x = draw.standard_normal((3 * d + 5, d)) * np.exp(-draw.random(d) * kind * 4)
            a = np.cov(x.T, bias=True).reshape(d, d)
            if kind == 3:  # equal values, and zeros
                q, _ = np.linalg.qr(draw.standard_normal((d, d)))
                a = q @ np.diag(np.repeat([5.0, 2, 1, 0], -(-d // 4))[:d]) @ q.T
                a = (a + a.T) / 2
            want, axes = np.linalg.eigh(a)
            want, axes = want[::-1], axes[:, ::-1]
            shift = float(draw.uniform(want[-1], want[0])) if d > 1 else 0.0
            assert whitening.negatives(a - shift * np.eye(d)) == (want < shift).sum()
            values, vectors = whitening.leading(a, 8)
            k = min(8, int((want > 1e-12 * want.sum()).sum()))
            assert len(values) == k
            assert np.allclose(values, want[:k], rtol=1e-11, atol=1e-14 * want[0])
            assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * want[0]
            assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
            if kind < 3:
                assert np.allclose(np.abs((vectors * axes[:, :k]).sum(axis=0)), 1, atol=1e-12)


def expected(rows):
    """Whitening by exact sums and numpy's eigenvectors."""
    rows = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([np.floor(1024 * np.array(v, np.float32).astype(np.float64)) + 100_000 for _, v in rows])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(8, int((values > 1e-12 * values.sum()).sum()))
    far = ((n * x - sums).astype(np.int64).astype(object) ** 2).sum(axis=1)
    return [i for i, _ in rows], n, far.tolist(), centred @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def check_whitening(frame):
    got = whitening.whitening_digest(frame).collect()
    ids, n, far, white, share = expected([tuple(r) for r in frame.select("vec_id", "embedding").collect()])
    k = white.shape[1]
    assert len(got) == len(ids) * k
    signs = np.zeros(k)
    by_row = {}
    for r in got:
        assert r.n == n and abs(r.explained / share[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
        by_row.setdefault((r.vec_id, r.deviation), []).append((r.component, r.whitened))
    for i, d, w in zip(ids, far, white, strict=True):
        mine = dict(by_row[i, d])
        for c in range(k):
            signs[c] = signs[c] or np.sign(mine[c + 1] * w[c])
            assert abs(mine[c + 1] - signs[c] * w[c]) < 1e-8
    return got


def test_whitening_of_all(spark):
    assert check_whitening(spark.read.parquet(f"{SF}/embeddings.parquet"))


def test_whitening_of_odd_rows(spark):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 1 + j) for j in range(5)]) for i in range(60)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1]), (100, None), (101, [1.0, None, 2.0, 3.0, 4.0]),
             (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (104, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    frame = frame.selectExpr("*", "'x' AS x", "'y' AS n", "'z' AS component")
    got = whitening.whitening_digest(frame).collect()
    assert {r.vec_id for r in got} == {*range(60), None}
    check_whitening(frame.where("vec_id < 60 OR vec_id IS NULL").distinct())
    # vectors of another length are left out; huge entries are held
    more = spark.createDataFrame([(200, [1.0, 2.0]), (201, [1e38, -1e38, 0.0, 0.0, 0.0])], "vec_id long, embedding array<float>")
    wide = whitening.whitening_digest(frame.select("vec_id", "embedding").union(more)).collect()
    assert {r.vec_id for r in wide} == {*range(60), None, 201} and {r.n for r in wide} == {64}
    # nothing to whiten
    for some in (frame.where("false"), frame.where("vec_id = 7"), frame.where("vec_id = 3"), frame.where("vec_id > 99")):
        assert whitening.whitening_digest(some).count() == 0


def test_queries_are_registered():
    assert {"op11_whitening", "op12_periodic_runs", "op13_token_files"} <= set(queries.QUERIES)


def test_known_words_stay_in_a_worker_from_task_to_task(spark):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")

    def run(batches):
        known = len(grammar.TextIds.of_worker(path).words)
        for batch in batches:
            grammar.TextIds.of_worker(path).batch(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array([known], pa.int64())], names=["known"])

    for _ in range(3):  # the second and third time in workers that have run before
        words = spark.range(0, 400, 1, 40).selectExpr("concat('word', id) AS w")
        known = [row.known for row in words.mapInArrow(run, "known long").collect()]
    assert max(known) > 0
