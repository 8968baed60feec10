"""Elkan's bounds against comparing every vector with every centroid, in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from noticeloom.llm import elkan


def brute(rows, k=16, size=64, rounds=3, scale=64, seed=1):
    """rows: (vec_id, components). vec_id, cluster, distance of the usable ones, and the last centroids."""
    kept = [(i, [math.floor(scale * int(x)) if float(x).is_integer() else math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in start[:k]]
    for turn in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]
        if turn < rounds:
            for j in range(len(centroids)):
                own = [v for (_, v), (_, of) in zip(kept, near) if of == j]
                if own:
                    centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, j, d) for (i, _), (d, j) in zip(kept, near)], centroids


def as_frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def same(spark, rows, kind="float", **settings):
    made, centroids, work = elkan.cluster(as_frame(spark, rows, kind), **settings)
    want, last = brute(rows, **settings)
    got = sorted((tuple(r) for r in made.collect()), key=repr)
    assert got == sorted(((i, j, min(d, elkan.LONGEST)) for i, j, d in want), key=repr)
    assert centroids == last
    return work


@pytest.mark.parametrize("seed", [1, 2])
def test_coarse_vectors_with_many_ties(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.randrange(-3, 4) / 64 for _ in range(4)]) for i in range(400)]
    same(spark, rows, k=12, size=4, rounds=5, seed=seed)


def test_clustered_vectors_are_pruned(spark):
    rng = np.random.default_rng(3)
    heads = rng.normal(size=(10, 16))
    rows = [(i, [float(np.float32(x)) for x in heads[i % 10] + rng.normal(size=16) * 0.05]) for i in range(3_000)]
    work = same(spark, rows, k=10, size=16, rounds=6)
    assert len(work) == 6 and work[0] <= 30_000 + 3_000 and work[-1] < 10_000  # of 30,000


def test_embeddings(spark, sf):
    frame = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    want, last = brute(rows)
    sums = {}
    for _, j, d in want:
        sums[j] = sums.get(j, 0) + d
    told = {(i, j, d, sums[j], sum(sums.values()), hashlib.sha256(",".join(map(str, last[j])).encode()).hexdigest()) for i, j, d in want}
    assert {tuple(r) for r in elkan.cluster_report(frame).collect()} == told


def test_unusable_vectors_repeats_and_null_ids(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(30)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    odd = [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0] * 4), (104, [1.0, None, 2.0]), (105, [1.0, math.nan, 2.0]), (106, [math.inf, 0.0, 0.0]), (107, [0.0, 0.0, -math.inf])]
    again = [(None, [0.5, 0.5, 0.5]), (None, [0.25, 0.5, 0.5]), rows[0], rows[0], (rows[1][0], rows[2][1])]
    same(spark, rows + odd + again, k=5, size=3, rounds=3)


def test_few_none_and_equal_vectors(spark):
    assert elkan.cluster_report(as_frame(spark, [])).count() == 0
    assert elkan.cluster_report(as_frame(spark, [(1, None)])).collect() == []
    same(spark, [(1, [1.0, 2.0]), (2, [3.0, 4.0])], k=16, size=2)
    same(spark, [(i, [0.5, -0.5]) for i in range(50)], k=4, size=2)  # all but one centroid stay empty


def test_huge_components_are_exact(spark):
    rng = random.Random(7)
    rows = [(i, [rng.choice([1e9, -1e9, 3e38, 1e300, 1.7e308, 0.1]) * rng.random() for _ in range(2)]) for i in range(60)]
    same(spark, rows, kind="double", k=6, size=2)
    made = elkan.cluster_report(as_frame(spark, rows, "double"), k=6, size=2).collect()
    assert all(0 <= r["distance"] <= elkan.LONGEST for r in made)


def test_other_columns_do_not_matter(spark):
    rows = [(i, [i / 7, -i / 3], i, "x", 1.0) for i in range(20)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int, own string, upper double")
    assert sorted(elkan.cluster_report(frame, size=2).collect()) == sorted(elkan.cluster_report(frame.select("vec_id", "embedding"), size=2).collect())
