"""Periodic runs against every stretch of every lag."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

from shelfspark.llm import periodic


def plainly(words):
    """Every maximal stretch of every lag that is long enough and has no smaller period."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = max(i, j) + 1
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def test_random_words_of_small_alphabets():
    rng = random.Random(3)
    texts = []
    for _ in range(400):
        letters = rng.choice(("a", "ab", "abc", "abcdefgh"))
        words = []
        while len(words) < rng.randrange(120):
            block = [rng.choice(letters) for _ in range(rng.randrange(1, 9))]
            words += block * rng.choice((1, 1, 4, 5, 7))
        texts.append([w.encode() for w in words])
    found = periodic.runs_of(texts)
    assert found == [plainly(t) for t in texts]
    assert sum(map(len, found)) > 300


def test_runs_within_runs_and_powers_of_powers():
    inner = ["a"] * 6 + ["b"]
    words = [w.encode() for w in inner * 5 + ["c"] + ["x", "y"] * 40 + ["z"] * 9]
    assert periodic.runs_of([words]) == [plainly(words)]
    assert (0, 35, 7) in periodic.runs_of([words])[0]


def test_fibonacci_words_have_no_run_and_binary_repeats_few():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 3000:
        a, b = b, b + a
    assert periodic.runs_of([b]) == [plainly(b)] == [[]]


def test_fingerprints_that_agree_by_chance(monkeypatch):
    """With fingerprints that are all the same, words decide."""
    rng = random.Random(4)
    monkeypatch.setattr(periodic.segment, "mix", lambda x: np.zeros(len(x), np.uint64))
    for _ in range(60):
        words = np.array([rng.choice((1, 2)) for _ in range(rng.randrange(6, 60))] + [1, 2, 2] * rng.randrange(6), np.int64)
        assert periodic.lag_scan(words) == sorted(plainly(list(words)))


def test_long_repeats_stay_quick():
    for words in ([b"a", b"b"] * 200_000, [b"a"] * 300_000, [str(i).encode() for i in range(30_000)] * 5):
        began = time.time()
        ((s, length, q),) = periodic.runs_of([words])[0]
        assert (s, length) == (0, len(words)) and time.time() - began < 20


def test_ordinary_text_splits_away():
    words = (b"the cat sat on the mat and the dog sat by the door of the house " * 1).split()
    assert periodic.survivors(np.arange(len(words)), np.zeros(len(words), np.int64)) == []


def test_documents(spark):
    long = "word other " * 30_000
    rows = [(1, "a a a a a a b"), (1, "a a a a a a b"), (None, "x y x y  x\ty x y"), (2, None), (3, ""), (4, " \n"), (5, long), (6, "é\xa0 é\xa0 é\xa0 é\xa0 é\xa0 é\xa0")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("user's") for c in ("runs", "start", "length", "period", "collapsed")})
    out = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(df).collect()), key=str)
    assert out == sorted([(1, [(0, 6, 1)], "a b"), (1, [(0, 6, 1)], "a b"), (None, [(0, 8, 2)], "x y"), (2, [], ""), (3, [], ""), (4, [], ""), (5, [(0, 60_000, 2)], "word other"), (6, [(0, 6, 1)], "é\xa0")], key=str)
    assert periodic.periodic_runs(df.limit(0)).collect() == []


def test_planted_digests(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(80)))) for i in range(150)]
    out = {r.doc_id: r for r in periodic.planted_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hits = 0
    for i, text in rows:
        words = text.split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            hits += 1
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = plainly(words)
        stay = [w for k, w in enumerate(words) if not any(s + q <= k < s + length for s, length, q in runs)]
        r = out[i]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(stay).encode()).hexdigest()
        top = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*top, 1000 * top[1] // top[2]) if top else (None,) * 4)
    assert hits > 5
