import zlib

import numpy as np
import pytest
from noticeloom.llm import toxicity as t


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    rows = t.toxicity(docs, labels).collect()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([a > b for a in bad for b in good]) > 0.8


def test_log_count_ratio_and_whole_texts():
    clean = [f"the quick brown fox number {i}".encode() for i in range(40)]
    toxic = [f"the quick zzgrumpf fox number {i}".encode() for i in range(40)]
    made = [t.grams(x) for x in clean + toxic]
    held = np.zeros((2, 1 << t.BITS), int)
    for i, x in enumerate(made):
        held[int(i >= 40), np.unique(x)] += 1
    place = np.flatnonzero(held.sum(axis=0))
    ratio = t.log_ratios(held[1, place], held[0, place], 40, 40)
    weights, intercept = t.fit(ratio, [np.searchsorted(place, np.unique(x)) for x in made], np.array([len(x) for x in made]), np.array([0] * 40 + [1] * 40), 0.5)
    weight = np.zeros(1 << t.BITS)
    weight[place] = weights
    c = t.Classifier(weight, intercept)
    assert c.score(b"a zzgrumpf here") > 0.5 > c.score(b"a fox here")
    assert c.score(b"plain words " * 3_000 + b"zzgrumpf " * 60) > c.score(b"plain words " * 3_000)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (9, 0)]])
def test_edges(spark, labels):
    docs = spark.createDataFrame([(1, "a"), (2, None), (None, ""), (1, "a")], "doc_id long, text string")
    rows = t.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 for r in rows)
