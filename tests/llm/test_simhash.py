"""SimHash groups against all pairs."""

import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from noticeloom.llm import simhash
from noticeloom.llm.common import Scratch
from noticeloom.llm.components import components

DOCS = "doc_id long, text string"


def print_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least(codes, names, distance=3):
    """The least name reachable from each place over codes that differ in so few bits."""
    label = list(range(len(codes)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= distance) + i + 1:
            a, b = root(i), root(int(j))
            label[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(codes)):
        groups.setdefault(root(i), []).append(i)
    return {i: min((names[k] for k in g if names[k] is not None), default=None) for g in groups.values() for i in g}


def check(rows, texts):
    rows = sorted(rows, key=repr)
    codes = np.array([int(r["fingerprint"], 16) for r in rows], np.uint64)
    want = least(codes, [r["doc_id"] for r in rows])
    assert [r["component_id"] for r in rows] == [want[i] for i in range(len(rows))]
    if texts:
        assert all(int(r["fingerprint"], 16) == print_of(texts[r["doc_id"]]) for r in rows)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(simhash.near_duplicates(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


@pytest.mark.parametrize("node", [8, 50, 2_000])
def test_crowded_nodes(spark, monkeypatch, node):
    monkeypatch.setattr(simhash, "NODE", node)
    rng = np.random.default_rng(node)
    heads = rng.integers(0, 2**63, 30, dtype=np.uint64)
    near = [heads[:12] ^ (np.uint64(1) << rng.integers(0, 64, 12, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 12, dtype=np.uint64)) for _ in range(50)]
    codes = np.unique(np.concatenate([heads, *near]))
    frame, scratch = spark.createDataFrame(pd.DataFrame({"fp": codes.view(np.int64)})), Scratch(spark)
    found = components(simhash.near_links(frame, scratch), scratch).collect()
    names = codes.view(np.int64).tolist()
    want = {names[i]: n for i, n in least(codes, names).items()}
    got = {n: n for n in names} | {r["node"]: r["root"] for r in found}
    assert got == want


def test_links_do_not_grow_with_the_square(spark):
    codes = np.array([1 << a | 1 << b for a in range(64) for b in range(a)], np.uint64)  # within four bits of each other
    frame = spark.createDataFrame(pd.DataFrame({"fp": codes.view(np.int64)}))
    assert simhash.near_links(frame, Scratch(spark)).count() <= 64 * len(codes)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One"), (6, "one two"), (None, "one"), (7, "x " * 3_000), (7, "x " * 3_000)]
    docs = spark.createDataFrame(rows, DOCS)
    got = simhash.near_duplicates(docs).collect()
    check(got, None)
    assert {r["doc_id"]: r["component_id"] for r in got}[3] == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_stays(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(5, text, 1), (3, text, 2), (3, text, 2), (9, text.upper(), 3), (1, "quite another text of some words", 4), (None, text, 5)]
    made = simhash.drop_near_duplicates(spark.createDataFrame(rows, DOCS + ", fp int"))
    assert made.columns == ["doc_id", "text", "fp"]
    assert sorted((r["doc_id"], r["fp"]) for r in made.collect()) == [(1, 4), (3, 2)]
