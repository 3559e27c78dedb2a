"""Collocations, periodic runs and sharding against brute force, and on null, empty, repeated and odd rows."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from strata.llm import common, periodic, phrases, secrets, sharding
from tests.conftest import SF001

ODD = [(0, None, None, "x", 1), (1, "", "en", "y", 2), (2, "one two", None, None, 3), (2, "one two", None, None, 3),
       (None, "a b " * 30_000, "en", "z", 4), (4, " \t\x0b\x0c\r\n", "de", "z", 5), (5, "x" * 200_000, "en", "z", 6),
       (6, "à é. " * 40, "und", "w", 7)]
ODD_SCHEMA = "doc_id long, text string, lang string, h string, shard int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


# 11 ----------------------------------------------------------------------------------------------
def plain_collocations(rows, least, top, longest=5):
    f, total = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = {}
    for lang, counts in f.items():
        cand = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        held = {g[i:j] for g, a in cand.items() for i in range(len(g)) for j in range(i + 1, len(g) + 1)
                if j - i < len(g) and 100 * a >= 100 * counts[g[i:j]]}
        rows_ = []
        for g, a in cand.items():
            if g not in held:
                score, k = min((1000 * a * total[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g)))
                rows_.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        out[lang] = [(i + 1, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows_)[:top])]
    return {k: v for k, v in out.items() if v}


def got_collocations(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("lang", "rank").collect():
        out[r["lang"]].append((r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]))
    return dict(out)


@pytest.mark.parametrize(("least", "top", "longest"), [(8, 30, 5), (5, 50, 3)])
def test_collocations_equal_brute_force(spark, least, top, longest):
    docs = common.table(spark, SF001, "documents")
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    want = plain_collocations(rows, least, top, longest)
    assert sum(map(len, want.values())) > 5
    assert got_collocations(phrases.collocations(docs, longest, least, top)) == want


def test_collocations_of_copies_and_long_paths(spark):
    rnd = random.Random(3)
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(f"{rnd.choice('abc')} {passage} {rnd.choice('xyz')}. a b a b a b, A B! b\ta" * 2, lang)
            for lang in ("en", "fr", None) for _ in range(9)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert got_collocations(phrases.collocations(docs, least=6)) == plain_collocations(rows, 6, 2000)
    words = common.written(phrases.word_counts(docs), "w")
    grams = phrases.gram_counts(common.written(phrases.graph(docs, words, least=6), "g"), least=6)
    ones = {(r["lang"], r["gram"]): r["n"] for r in grams.filter("k = 1").collect()}
    assert ones == {(r["lang"], r["gram"]): r["n"] for r in words.filter("n >= 6").collect()}
    longest = {r["phrase"]: (r["n"], r["edges"]) for r in phrases.long_phrases(phrases.paths(grams)).filter("lang = 'en'").collect()}
    assert longest[passage] == (18, 56)


def test_collocations_of_odd_rows(spark, odd):
    rows = [(r[1], r[2]) for r in ODD]
    assert got_collocations(phrases.collocations(odd, least=2)) == plain_collocations(rows, 2, 2000)
    empty = phrases.collocations(odd.limit(0))
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and empty.count() == 0


def test_counts_past_64_bits(spark):
    big = spark.sql("select cast(3e12 as long) a, cast(9e15 as long) total, cast(3e12 as long) l, cast(4e12 as long) r")
    assert big.selectExpr(phrases.SCORE).first()[0] == 1000 * 3 * 10**12 * 9 * 10**15 // (12 * 10**24)


# 12 ----------------------------------------------------------------------------------------------
def plain_runs(w, least=12):
    n, out = len(w), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            m = j - i + p
            if m >= max(least, 2 * p) and not any(p % q == 0 and w[i:i + m - q] == w[i + q:i + m] for q in range(1, p)):
                out.append((i, m, p))
            i = j
    return sorted(out, key=lambda x: (x[0], x[2]))


def random_words(rnd):
    n, k = rnd.randint(0, 90), rnd.choice([1, 2, 3, 5, 50])
    w = [rnd.randrange(k) for _ in range(n)]
    if rnd.random() < 0.6 and n > 4:
        a = rnd.randrange(n)
        p = rnd.randint(1, max(1, (n - a) // 2))
        w[a:] = [w[a + (i - a) % p] for i in range(a, n)]
    return w


@pytest.mark.parametrize("step", [1, 3, 1000])
def test_online_runs_and_squares_equal_brute_force(step):
    rnd = random.Random(step)
    for _ in range(200):
        w, least = random_words(rnd), rnd.choice([12, 12, 2, 20])
        c, squares = periodic.Catchers(least), []
        for i in range(0, len(w), step):
            squares += c.append(np.array(w[i:i + step], dtype=np.int64))
        want = plain_runs(w, least)
        assert c.runs() == want
        assert sorted(squares) == sorted((a, p, a + max(least, 2 * p) - 1) for a, _, p in want)


def test_runs_of_many_texts_and_long_ones():
    rnd = random.Random(9)
    texts = [[str(x).encode() for x in random_words(rnd)] for _ in range(150)]
    assert periodic.runs_of(texts) == [plain_runs(t) for t in texts]
    root = [b"%d" % i for i in range(70_001)]
    long = [b"x"] + root * 5 + [b"y"]
    assert periodic.runs_of([long, [b"a"] * 300_000, root]) == [[(1, 350_005, 70_001)], [(0, 300_000, 1)], []]


def plain_detect(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    drop = {i for s, m, p in runs for i in range(s + p, s + m)}
    top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
    return (doc_id, len(runs), *top, top[0] if top[0] is None else 1000 * top[1] // top[2],
            hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def test_detect_equals_brute_force(spark):
    docs = common.table(spark, SF001, "documents")
    short = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"]) < 4000]
    got = {r["doc_id"]: tuple(r) for r in periodic.detect(docs).collect()}
    assert len(got) == docs.count() and sum(r[1] > 0 for r in got.values()) > 10
    for doc_id, text in short:
        assert got[doc_id] == plain_detect(doc_id, text)


def test_detect_odd_rows(spark, odd):
    key = repr
    got = sorted((tuple(r) for r in periodic.detect(odd).collect()), key=key)
    want = [plain_detect(r[0], r[1]) for r in ODD if r[0] is not None]
    assert sorted((r for r in got if r[0] is not None), key=key) == sorted(want, key=key)
    assert next(r for r in got if r[0] is None)[2:5] == (0, 60_000, 20_001)
    assert periodic.detect(odd.limit(0)).count() == 0
    full = {r["doc_id"]: r for r in periodic.detect(odd.filter("doc_id = 6"), change=None, texts=True).collect()}[6]
    assert full["collapsed"] == "à é." and full["runs"][0].asDict() == {"start": 0, "length": 80, "period": 2}


# 13 ----------------------------------------------------------------------------------------------
def shards_of(df):
    by = collections.defaultdict(list)
    for r in df.collect():
        by[r["shard"]].append(r)
    for rows in by.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in rows)
    return by


def test_shards_are_near_equal_and_keep_small_groups(spark):
    docs = common.table(spark, SF001.replace("0.001", "0.01"), "documents")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    by = shards_of(sharding.assign(docs))
    rows = [r for x in by.values() for r in x]
    assert sorted(r["doc_id"] for r in rows) == sorted(text) and set(by) == set(range(16))
    for r in rows:
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    sizes = [sum(r["size"] for r in x) for x in by.values()]
    mean, top = sum(sizes) / 16, max(r["size"] for r in rows)
    assert all(abs(s - mean) <= top + 2 * sharding.GROUP_SHARE * mean for s in sizes)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[text[r["doc_id"]]].append(r)
    for same in groups.values():
        if sum(r["size"] for r in same) <= sharding.GROUP_SHARE * mean:
            assert len({r["shard"] for r in same}) == 1


def test_hot_text_is_divided(spark):
    rows = [(i, "hot text" if i % 3 else f"text {i}") for i in range(3000)] + [(None, None)] * 1500 + [(7, "same")] * 500
    by = shards_of(sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 8))
    sizes = [sum(r["size"] for r in x) for x in by.values()]
    assert len(by) == 8 and max(sizes) - min(sizes) <= 2 * 0.05 * sum(sizes) / 8 + 20
    assert sum(map(len, by.values())) == len(rows)


def test_hot_empty_rows_do_not_fill_one_range(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_A_RANGE", 50)
    rows = [(i, None) for i in range(4000)] + [(10_000 + i, "x" * 3000) for i in range(400)]
    ranges = []
    real = sharding._splitters
    monkeypatch.setattr(sharding, "_splitters", lambda *a: ranges.append(real(*a)) or ranges[-1])
    by = shards_of(sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 4))
    assert max(n for n, _ in ranges[0][1]) <= 2 * 4400 // min(4400, 128) + 2
    sizes = [sum(r["size"] for r in x) for x in by.values()]
    assert max(sizes) - min(sizes) <= 2 * 3001


def test_shards_of_odd_rows_and_files(spark, odd, tmp_path):
    by = shards_of(sharding.assign(odd))
    assert sorted(r["size"] for x in by.values() for r in x) == sorted(len((r[1] or "").encode()) + 1 for r in ODD)
    assert sharding.assign(odd.limit(0)).collect() == []
    again = {(r["doc_id"], r["size"], r["shard"], r["slot"]) for r in sharding.assign(odd.repartition(5)).collect()}
    assert again == {(r["doc_id"], r["size"], r["shard"], r["slot"]) for x in by.values() for r in x}
    sharding.write_shards(odd.withColumnRenamed("shard", "keep"), str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, back.select("doc_id", "text", "lang", "h", "keep").collect())) == sorted(
        map(repr, odd.withColumnRenamed("shard", "keep").collect()))


# 6 -----------------------------------------------------------------------------------------------
@pytest.mark.parametrize("run", [b"a" * 10**6, b"7" * 10**6, b"." * 10**6, b"a.b-" * 250_000, b"aGVsbG8/+" * 111_111,
                                 b"password = password\n" * 50_000, b'"' * 10**6, b"a=" * 500_000,
                                 b"password " + b" " * 10**6, b"password = $" + b"a" * 10**6 + b"!"])
def test_secret_scan_reads_long_runs_once(run):
    start = time.time()
    secrets.scan(b"password: x " + run + b" token")
    assert time.time() - start < 10  # hours if it grew with the square


def test_secret_names_inside_runs_and_passphrases():
    def found(text):
        return [text[a:b] for k, a, b in secrets.scan(text) if k == "literal"]

    assert found(b"--db-password: Zx9!kq7Lp2wQ") == [b"Zx9!kq7Lp2wQ"]
    assert found(b'1.password = "Zx9!kq7Lp2wQ"; a = "Zx9!kq7Lp2wQ"') == [b"Zx9!kq7Lp2wQ"]
    assert found(b'db_password: "correct horse battery staple 42"') == [b"correct horse battery staple 42"]
    assert found(b'password: "please type it here"') == found(b'key: "chapter 12 of the book"') == []
    assert found(b"password = a\na = b\nb = password\nb = 'Zx9!kq7Lp2wQ'") == [b"Zx9!kq7Lp2wQ"]
