import re

import numpy as np
import pytest
from noticeloom.llm import quality
from noticeloom.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text) if words else 0, dup, len(covered)


TEXTS = ["", " \n\t", "a b c a b c", "a\nb\na\n\n\n", "ünï cödé x ### $%", "x " * 40, "one two\x0bthree\x0cfour\rfive", "a a a a", "p q r s p q r t"]


@pytest.mark.parametrize("text", TEXTS)
def test_base_columns(text):
    assert quality.measure(text.encode())[:5] == base(text)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = quality.quality_rules(docs, Scratch(spark)).collect()
    right = []
    for r in rows:
        n, chars, symbols, dup, rep = base(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, rep)
        failed = n < 50 or 100 * rep > 50 * n
        assert r["base_failed"] == failed and not (failed and r["kept"])
        if not failed and r["doc_id"] in labels:
            right.append(r["kept"] == bool(labels[r["doc_id"]]))
    assert sum(right) >= 0.95 * len(right)
    kept = {r["doc_id"] for r in quality.keep_good(docs).collect()}
    assert kept == {r["doc_id"] for r in rows if r["kept"]}


def test_em_learns_whom_to_trust():
    patterns = np.array([[1, 1, 0, 0], [0, 0, 0, 1], [0, 0, 1, 1], [0, 0, 0, 0]], float)
    weight, polarity = np.array([100.0, 900.0, 60.0, 40.0]), np.array([0, 0, 0, 1])
    model = quality.LabelModel.fit(patterns, weight, polarity)
    assert model.accuracy[2] < 0.7 < 0.85 < min(model.accuracy[0], model.accuracy[1])
    good = model.posterior(patterns)
    assert good[0] < 0.1 and good[1] > 0.95 and good[2] > 0.5
    rows = np.repeat(patterns, weight.astype(int), axis=0)
    each = quality.LabelModel.fit(rows, np.ones(len(rows)), polarity)
    assert np.allclose(each.accuracy, model.accuracy) and np.isclose(each.share, model.share)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "")], [(1, "a"), (1, "a")]])
def test_edges(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert quality.quality_rules(docs, Scratch(spark)).count() == len(rows)
    assert quality.keep_good(docs).columns == docs.columns


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "w%d " * 60 % tuple(range(60)), 5, 6)], "doc_id long, text string, n_words int, pattern int")
    assert quality.keep_good(docs).columns == docs.columns
