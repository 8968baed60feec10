"""Periodic runs against a scan of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from noticeloom.llm import runs

DOCS = "doc_id long, text string"


def brute(w, least, times):
    """Each maximal stretch of words that equal those q words on, for every q; the smallest q of an interval."""
    n, out = len(w), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                out.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in out.items())


def edited(doc_id, text):
    """The words of a text after the periodic end that the contract gives a tenth of them."""
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def report(doc_id, text):
    w = edited(doc_id, text)
    found = brute(w, 24, 3)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    told = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize(("least", "times"), [(24, 3), (6, 3), (2, 2), (9, 4)])
def test_random_words(least, times):
    rng = random.Random(least)
    for _ in range(1500):
        n = rng.randint(0, 90)
        w = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(n)]
        for _ in range(rng.randint(0, 2)):
            if n:
                a, p = rng.randrange(n), rng.randint(1, 15)
                w = [x if i < a else w[a + (i - a) % p] if a + (i - a) % p < n else 0 for i, x in enumerate(w)]
                w[rng.randrange(n)] = 9
        assert runs.runs_of(np.array(w, np.int32), least, times) == brute(w, least, times)


def test_z_function():
    for w in ([1, 1, 1, 1], [1, 2, 1, 2, 1], [3], [1, 2, 3], [5] * 300 + [1] + [5] * 200):
        want = {i: next((k for k in range(len(w) - i) if w[k] != w[i + k]), len(w) - i) for i in range(1, len(w))}
        assert runs.z_function(np.array(w)) == {i: k for i, k in want.items() if k}


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {tuple(r) for r in runs.run_report(runs.with_planted_runs(docs)).collect()}
    want = {report(r["doc_id"], r["text"]) for r in docs.collect()}
    assert got == want and any(r[1] for r in want)


def test_edges(spark):
    long = " ".join(["a b c d e f g h"] * 12_500) + " end"  # 100,001 words
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "x y"), (4, "w " * 23), (5, "w " * 24), (5, "w " * 24), (61, long), (10, "one two three"), (7, "\u00a0 a\u00a0b")]
    rows += [(i, "p q r s t u v w " * 4) for i in range(20, 60)]  # some get a periodic end
    made = runs.run_report(runs.with_planted_runs(spark.createDataFrame(rows, DOCS)))
    got = sorted((tuple(r) for r in made.collect()), key=repr)
    want = sorted((report(i, t) if i != 61 else _of_long(long) for i, t in rows), key=repr)
    assert got == want


def _of_long(text):
    """One run of period 8, before the last word; crc32 of "61" does not end in 0."""
    assert zlib.crc32(b"61") % 10
    told, kept = "0,100000,8\n", "a b c d e f g h end"
    return (61, 1, 0, 100_000, 8, 12_500_000, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_operator_keeps_columns(spark):
    rows = [(1, "z " * 30 + "end", 5, "kept", 1.5), (2, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int, start string, `a b` double")
    made = runs.find_runs(docs)
    assert made.columns == ["doc_id", "text", "start", "a b", "runs", "collapsed"]
    one, two = sorted(made.collect())
    assert [tuple(r) for r in one["runs"]] == [(0, 30, 1)] and one["collapsed"] == "z end" and one["start"] == "kept"
    assert two["runs"] == [] and two["collapsed"] == ""
    assert runs.run_report(docs.limit(0)).count() == 0
