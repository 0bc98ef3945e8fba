"""Operators that judge each text by itself, against brute force."""

import hashlib
import random
import re
import os
import sys
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from awkward import documents, empty, plain  # noqa: E402

from reelbook.llm import decontaminate, pii, quality, secrets, tokens, urls  # noqa: E402
from reelbook.llm.common import words_of  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# tokens


@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    return public.path("word_bpe_49k.json")


def test_tokens_match_the_library(spark, docs, vocabulary):
    known = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    for frame in (docs, documents(spark)):
        texts = [r.text or "" for r in frame.collect()]
        want = [len(e.ids) for e in known.encode_batch(texts, add_special_tokens=False)]
        want = sorted((len(t.encode()), n, n > 2048) for t, n in zip(texts, want, strict=True))
        got = sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(frame, vocabulary).collect())
        assert got == want
    assert tokens.count_tokens(empty(spark), vocabulary).count() == 0


def test_tokens_of_odd_texts(vocabulary):
    known = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    signs = ["a", "aa", "ab", "the", " ", "\t", "!", "'s", "'re", "1", "é", "é", "ΑΣ", "İ", "ß", "日本", "😀",
             "<|endoftext|>", "<|END", "\x1c", "\x85", "\xa0", "½", "_", "हि", "K", "\x00"]
    draw = random.Random(4)
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 25))) for _ in range(3000)]
    texts += ["a" * n for n in range(60)] + ["ha" * n for n in range(60)]
    want = [len(e.ids) for e in known.encode_batch(texts, add_special_tokens=False)]
    assert tokens.WordBpe(vocabulary).counts(texts) == want


def test_tokens_of_any_characters(vocabulary):
    """Letters are what the library's own tables say, whatever edition of Unicode they follow."""
    known = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    draw = random.Random(3)
    points = [c for c in range(0x2FA20) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, draw.choices(points, k=12))) for _ in range(20_000)]
    texts += ["".join(map(chr, draw.choices(range(0x180), k=15))) for _ in range(10_000)]
    texts += [chr(c) + "a" + chr(c) for c in points[::7]]
    want = [len(e.ids) for e in known.encode_batch(texts, add_special_tokens=False)]
    assert tokens.WordBpe(vocabulary).counts(texts) == want


def test_tokens_of_long_words(vocabulary):
    """Linear in the word: a million letters take about what their merges take."""
    known = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary)
    bpe, draw = tokens.WordBpe(vocabulary), random.Random(3)
    size = lambda word: len(known.encode(word, add_special_tokens=False).ids)
    for letters in ("a", "ab", "abcde", "abcdefghijklmnopqrstuvwxyz", "éß日"):
        for n in (1, 2, 3, 50, 500, 5000, 20_000):
            word = "".join(draw.choices(letters, k=n))
            assert bpe.merged_length(word) == bpe.merged_lengths([word])[0] if n < 500 else True
            if letters != "éß日":  # a word of the library; the last one is cut into several
                assert bpe.merged_length(word) == size(word)
    word = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    started = time.perf_counter()
    assert bpe.counts([word]) == [size(word)]
    assert time.perf_counter() - started < 60


# decontamination


def hits_by_hand(words, items, window):
    hit, names = set(), set()
    for name, item in items:
        size = min(window, len(item))
        for at in range(len(item) - size + 1 if item else 0):
            for i in range(len(words) - size + 1):
                if words[i : i + size] == item[at : at + size]:
                    hit |= set(range(i, i + size))
                    names.add(name)
    return hit, names


@pytest.mark.parametrize("seed", range(200))
def test_automaton(seed):
    draw = random.Random(seed)
    window, letters = draw.choice([2, 3, 4, 10]), [b"a", b"b", b"c", b"d"][: draw.randint(1, 4)]
    items = [(str(i), draw.choices(letters, k=draw.randint(0, 14))) for i in range(draw.randint(0, 6))]
    known = decontaminate.SuffixAutomaton.of(items, window)
    for _ in range(4):
        words = draw.choices([*letters, b"x"], k=draw.randint(0, 40))
        if items:
            words += draw.choice(items)[1]
        spans, names = known.scan(words)
        assert ({i for a, b in spans for i in range(a, b)}, names) == hits_by_hand(words, items, window)


def test_packed_automata_are_small():
    """Some fifty bytes a word, so that millions of item words fit a worker."""
    draw = random.Random(5)
    items = [(str(i), [b"%d" % draw.randrange(20_000) for _ in range(100)]) for i in range(500)]
    packed = decontaminate.SuffixAutomaton.of(items).packed()
    arrays = sum(a.nbytes for a in packed.values() if hasattr(a, "nbytes"))
    assert arrays < 120 * 50_000
    names = packed["names"]
    assert sorted(names) == sorted(name for name, _ in items)


def test_many_owners_of_a_window():
    """Owners are looked up once for each state met, not at every word."""
    shared = [b"w%d" % i for i in range(12)]
    scanner = decontaminate.Scanner(decontaminate.SuffixAutomaton.of([(str(i), shared) for i in range(5000)]).packed())
    started = time.perf_counter()
    spans, names = scanner.scan(shared * 2000)
    assert spans == [(0, 24_000)] and len(names) == 5000
    assert time.perf_counter() - started < 2


def benchmark(spark):
    rows = [(1, "one two three"), (2, None), (None, "w1 x1 w2"), (10, " ".join(f"word{i}" for i in range(30, 45))), (3, "!!")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block_words", [5, 1000])
def test_hits(spark, block_words):
    frame = documents(spark).unionByName(
        spark.createDataFrame([(77, "so One, TWO three! one two three", "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long"),
        allowMissingColumns=True,
    )
    items = [(str(r.item_id), words_of((r.text or "").encode())) for r in benchmark(spark).collect() if r.item_id is not None]
    found = decontaminate.find_hits(frame, benchmark(spark), block_words=block_words)
    assert found.count() == frame.count()
    for row in found.collect():
        words = words_of((row.text or "").encode()) if len(row.text or "") < 9999 else []
        hit, names = hits_by_hand(words, items, 10)
        assert {i for h in row.found.hits for i in range(h.start, h.stop)} == hit
        assert row.found["items"] == sorted(names)


def test_removal(spark):
    items = benchmark(spark)
    body = " ".join(f"word{i}" for i in range(80))
    cleaned = {r.doc_id: r for r in decontaminate.remove_hits(documents(spark), items).where("doc_id <> 3").collect()}
    assert "word29" in cleaned[4].text and "word45" in cleaned[4].text and "word30" not in cleaned[4].text
    assert cleaned[4].n_chars == len(cleaned[4].text) < len(body)
    assert cleaned[0].text is None and cleaned[1].text == ""
    mostly = spark.createDataFrame([(1, "one two three"), (2, "one two three and four five six seven")], "doc_id long, text string")
    assert [tuple(r) for r in decontaminate.remove_hits(mostly, items).collect()] == [(2, " and four five six seven")]
    assert plain(decontaminate.remove_hits(documents(spark), items.where("false"))) == plain(documents(spark))
    assert decontaminate.remove_hits(empty(spark), items).columns == documents(spark).columns


def test_hit_digest(spark):
    rows = spark.createDataFrame([(1, "x One two THREE x"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.hit_digest(rows, benchmark(spark)).collect()}
    assert got[1].n_words == 5 and got[1].n_hit == 3 and got[1].n_items == 1 and got[1].contaminated
    assert got[1].items_sha256 == hashlib.sha256(b"1").hexdigest()
    assert (got[2].n_words, got[2].n_hit, got[2].contaminated) == (0, 0, False)
    assert got[2].items_sha256 == hashlib.sha256(b"").hexdigest()


# personal data

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and pii.luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def personal_by_hand(text):
    order = list(FORMS)
    spans = [(m.start(), m.end(), k) for k, f in FORMS.items() for m in re.finditer(f, text) if valid(k, m[0])]
    return sorted(spans, key=lambda s: (s[0], order.index(s[2])))


@pytest.mark.parametrize("seed", range(30))
def test_personal_data(seed):
    parts = ["a", "b.c", "@", "@x.y", ".", "-", "+", "+1", "+49 ", "0", "255", "256", "12", "4111 1111 1111 1111", "4111",
             "1111", " ", "(", "_", "é", "😀", "..", "1.2.3.4", "x@y.z", "http://", "\n", "007"]
    draw = random.Random(seed)
    for _ in range(300):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))
        assert [s for s in pii.find(text) if s[2] in pii.BASE] == personal_by_hand(text)


def test_cued_accounts_and_addresses():
    text = "IBAN: DE89 3704 0044 0532 0130 00 or account no. 12345678, see ftp://joe:pw@host/x; account of 2024"
    assert [text[a:b] for a, b, k in pii.find(text) if k == "account"] == ["DE89 3704 0044 0532 0130 00", "12345678"]
    assert [text[a:b] for a, b, k in pii.find(text) if k == "address"] == ["joe:pw@host"]
    assert pii.masked("to a@b.cd now") == "to <email> now"


def test_personal_digest(spark, docs):
    for frame in (docs, documents(spark)):
        got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.personal_digest(frame).collect())
        want = Counter()
        for r in frame.collect():
            spans = personal_by_hand(r.text or "")
            shown = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
            want[(r.doc_id, *(sum(s[2] == k for s in spans) for k in FORMS), hashlib.sha256(shown.encode()).hexdigest())] += 1
        assert got == want
    assert pii.personal_digest(empty(spark)).count() == 0
    assert pii.mask(documents(spark)).count() == documents(spark).count()


# secrets

SECRETS = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}


def secrets_by_hand(text):
    spans = []
    for kind, (form, group, least) in SECRETS.items():
        flags = re.I | re.A if kind == "assign" else re.A
        spans += [(m.start(), m.end(), kind) for m in re.finditer(form, text, flags) if len(m[group]) >= least]
    order = list(SECRETS)
    return sorted(spans, key=lambda s: (s[0], order.index(s[2])))


def test_secrets(spark, docs):
    parts = ["token", "secret", "PASSWORD", "api_key", "apikey", '"', "'", " ", ":", "=", "abcdefgh", "x", "é😀", "AKIA",
             "ABCDEFGHIJKL0123", "0123456789abcdef" * 2, "deadbeef", "-", "\n", "_", "."]
    draw = random.Random(6)
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(1500)]
    for frame in (docs, documents(spark), documents(spark, texts)):
        got = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.secret_digest(frame).collect())
        want = Counter()
        for r in frame.collect():
            spans = secrets_by_hand(r.text or "")
            shown = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
            want[(r.doc_id, *(sum(s[2] == k for s in spans) for k in SECRETS), hashlib.sha256(shown.encode()).hexdigest())] += 1
        assert got == want
    assert secrets.secret_digest(empty(spark)).count() == 0


def test_ownership(spark):
    rows = [(i, "token=widelyCopied", f"owner{i}") for i in range(3)] + [(9, "token=onlyMine1 token=widelyCopied", "owner0"), (10, "token=onlyMine1", "owner0")]
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = {(r.doc_id, s.start): (s.n_repositories, s.n_owners, s.verdict) for r in found.collect() for s in r.secrets}
    assert got[0, 0] == (4, 3, "example") and got[9, 0] == (2, 1, "live") and got[9, 16] == (4, 3, "example")


# quality


def measures_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    again = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def test_measures(spark, docs):
    texts = [None, "", "\n\n", "a b", "a b c a b c", "x\nx\n x\nx", "# $\n# $", "a a a a a", "\x0b\x0ca\x1fb\x85c\xa0d", "no"]
    for frame in (docs, documents(spark), documents(spark, texts)):
        rows = quality.quality_digest(frame).collect()
        got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
        assert got == Counter((r.doc_id, *measures_by_hand(r.text or "")) for r in frame.collect())
        for r in rows:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.base_failed and r.kept)
    assert quality.keep_good(empty(spark)).columns == documents(spark).columns
    assert quality.keep_good(empty(spark)).count() == 0


def test_rules_follow_the_labels(spark, docs):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert kept.join(labels, "doc_id").where("quality = 0").count() == 0
    judged = quality.quality_digest(docs).join(labels, "doc_id").where("quality = 1 AND NOT base_failed")
    assert judged.where("NOT kept").count() == 0


def test_thresholds_adapt(spark):
    """Long words are usual in one source and far out in the other; a small group follows its language."""
    rows = [(i, " ".join([("abcdefghijklmno" if s else "ab") + "c" * (i % 2)] + [f"{'longwordlong' if s else ''}{k + i}" for k in range(60)]), "en", f"s{s}", 0)
            for i in range(600) for s in (0, 1)]
    rows.append((9999, " ".join(f"{'x' * 30}{k}" for k in range(60)), "en", "s0", 0))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    judged = quality.judge(frame)
    assert judged.where("NOT kept").select("doc_id").collect()[0].doc_id == 9999
    assert judged.where("NOT kept").count() == 1


# urls


def url_by_hand(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_urls(spark):
    rules = [*urls.RULES, ("block", "a.b.c", "/x"), ("allow", "b.c", "/x/y/z"), ("block", "é.org", "")]
    hosts = ["example.com", "www.Example.com", "com", "net", "x.net", "a.b.c", "z.a.b.c", "b.c", "é.org", "", ".com", "com.", "com:80"]
    ends = ["", "/", "/en/", "/en", "/es/x", "/fr/?q", "/x/y/z", "/x#y", "?a=/en/", "/EN/", "//en/"]
    texts = [f"{s}{h}{e}" for s in ("http://", "", "://", "a://b://") for h in hosts for e in ends] + [None, "://", "x"] * 2
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(texts)], "page_id long, url string, rule string")
    for some in (rules, urls.RULES, rules[:1], rules[1:2], []):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(frame, some).collect()}
        assert got == {i: url_by_hand(u, some) for i, u in enumerate(texts)}
    assert urls.judge_urls(frame.where("false"), rules).count() == 0


def test_cascade_is_exact(spark):
    listed = spark.range(0, 300).selectExpr("cast(id AS string) AS key")
    others = spark.range(300, 40_000).selectExpr("cast(id AS string) AS key")
    known = urls.Cascade.build("t", listed, others)
    assert len(known.levels) > 2
    keys = spark.range(0, 40_000).selectExpr("id", "cast(id AS string) AS key")
    got = keys.where(known.holds(keys.key)).agg({"id": "max", "*": "count"}).first()
    assert set(got) == {299, 300}


def test_many_rules_as_a_table(spark):
    """A million rules that no page has, beside some hundred that pages have, against a join."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    kind = F.when(F.crc32(F.col("url").cast("binary")) % 2 == 0, "allow").otherwise("block")
    cut = F.substring(path, 1, 1 + (F.col("page_id") % 7).cast("int"))
    own = pages.select(kind.alias("verdict"), host.alias("host"), cut.alias("path"))
    many = spark.range(1_000_000).selectExpr("if(id % 3 = 0, 'allow', 'block') verdict", "concat('h', id, '.example') host",
                                             "concat('/', id % 50, '/') path")
    odd = spark.createDataFrame([("block", None, "/"), (None, "com", "/"), ("what", "com", "/")], "verdict string, host string, path string")
    rules = own.unionByName(many).unionByName(odd)
    found = urls.judge_urls(pages, rules)
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 200_000
    keys = rules.where("verdict IN ('allow', 'block') AND host IS NOT NULL").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    split = pages.select("page_id", host.alias("h"), path.alias("p"))
    ends = F.expr("transform(sequence(1, size(split(h, '[.]'))), k -> substring_index(h, '.', -k))")
    each = split.select("*", F.explode(ends).alias("host")).join(keys, "host").where("startswith(p, path)")
    best = each.groupBy("page_id").agg(F.max(F.struct(F.length(F.concat("host", "path")), F.length("host"), "host", "path", "verdict")).alias("b"))
    want = {r.page_id: (r.b.host + r.b.path, r.b.verdict) for r in best.collect()}
    got = {r.page_id: (r.rule, r.verdict) for r in found.collect()}
    assert len(want) > 200 and got == {i: want.get(i, (None, "allow")) for i in got}
