"""Centroid clustering with Elkan's bounds.

Every vector carries an upper bound of the distance to its centroid and a lower bound of the distance to each centroid.
A centroid is left aside where a lower bound, or half its distance from the vector's centroid, lies strictly above the
upper bound: then it is farther off, and a tie is never left aside. Bounds are rounded outwards by more than the error of
the floating-point steps, and whatever is compared at last are squared distances in integers; so the pruned rounds give
what comparing every vector with every centroid gives.

A round is one pass over the vectors without a shuffle: it reads the last round's bounds, assigns, and writes new ones to
the shared folder, beside a row for each centroid and task with the sum of its vectors there. The sums go through one
small aggregate; the driver holds the centroids and nothing else of the data.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import Scratch

#: Outward rounding: above the error of a conversion, a root and a sum in double precision together.
UP, DOWN = 1 + 2.0**-48, 1 - 2.0**-48
#: Components up to here, after scaling, are squared and added in 64 bits (up to 128 of them); larger ones take Python's integers.
SMALL = 2**27
#: Sums are passed on in digits of so many bits, so that they stay exact at any number of rows.
DIGIT = 40
LONGEST = 2**63 - 1


def usable(embedding: str, size: int) -> Column:
    """The vector has exactly size components, none null, not a number or infinite."""
    bad = F.exists(F.col(embedding).cast("array<double>"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(embedding).isNotNull() & (F.size(embedding) == size) & ~bad


def _whole(x: float, scale: int) -> int:
    """floor(scale * x), exactly, for any finite x."""
    top, bottom = x.as_integer_ratio()
    return scale * top // bottom


def integers(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component; scale is a power of two, so small ones are exact in double precision."""
    scaled = np.floor(np.clip(rows, -1e300, 1e300) * scale)
    if not rows.size or np.abs(scaled).max() <= SMALL:
        return scaled.astype(np.int64)
    return np.array([[_whole(x, scale) for x in row] for row in rows.tolist()], object)


def squared(rows: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances: in 64 bits, or in Python's integers where rows are such."""
    apart = rows - centroid
    return np.einsum("ij,ij->i", apart, apart) if rows.dtype != object else (apart * apart).sum(axis=1)


def _root(d2: np.ndarray, by: float) -> np.ndarray:
    if d2.dtype != object:
        return np.sqrt(d2.astype(float)) * by
    past = np.inf if by > 1 else 0.0  # beyond what a double holds: a bound that prunes nothing
    return np.array([float(math.isqrt(x) + (by > 1)) * by if x < 2**2000 else past for x in d2.tolist()])


class Centroids:
    """Centroids in integers, and what the bounds need of the distances between them."""

    def __init__(self, rows: list[list[int]], before: list[list[int]] | None = None):
        big = any(abs(x) > SMALL for row in rows for x in row)
        self.rows = np.array(rows, object if big else np.int64).reshape(len(rows), -1)
        k = len(rows)
        self.half = np.array([_root(squared(self.rows, c), DOWN) / 2 * DOWN for c in self.rows]).reshape(k, k)
        np.fill_diagonal(self.half, np.inf)
        self.nearest = self.half.min(axis=1)
        moved = [sum((a - b) ** 2 for a, b in zip(x, y)) for x, y in zip(rows, before or rows)]
        self.drift = _root(np.array(moved, object), UP) * UP


def assign(rows: np.ndarray, centroids: Centroids, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """One round over a batch, in place: own becomes the nearest centroid (the smaller number on ties), bounds follow. Distances worked out."""
    upper += centroids.drift[own]
    upper *= UP
    np.maximum((lower - centroids.drift) * DOWN, 0, out=lower)
    here = np.flatnonzero(upper >= centroids.nearest[own])
    if not len(here):
        return 0
    exact = rows.dtype == object or centroids.rows.dtype == object
    table = centroids.rows.astype(object) if exact else centroids.rows
    rows = rows[here].astype(object) if exact else rows[here]
    a, low = own[here].copy(), lower[here]
    each = table[a] - rows
    best = (each * each).sum(axis=1) if exact else np.einsum("ij,ij->i", each, each)
    high, done = _root(best, UP), len(here)
    low[np.arange(len(here)), a] = _root(best, DOWN)
    for j in range(len(table)):
        at = np.flatnonzero((a != j) & (high >= low[:, j]) & (high >= centroids.half[a, j]))
        if not len(at):
            continue
        d2 = squared(rows[at], table[j])
        done += len(at)
        low[at, j] = _root(d2, DOWN)
        nearer = (d2 < best[at]) | ((d2 == best[at]) & (j < a[at]))
        won = at[nearer.astype(bool)]
        a[won], best[won] = j, d2[nearer.astype(bool)]
        high[won] = _root(best[won], UP)
    own[here], upper[here], lower[here] = a, high, low
    return done


def _digits(value: int, count: int) -> list[int]:
    """value in so many digits of DIGIT bits; the last one carries the sign and what is left."""
    return [(value >> DIGIT * i) & (2**DIGIT - 1) for i in range(count - 1)] + [value >> DIGIT * (count - 1)]


def _pass(state: DataFrame, centroids: Centroids, scale: int, first: bool, last: bool) -> DataFrame:
    """The next state: vec_id, embedding, own, upper, lower, d2 (on the last pass) of every vector, and a row for each task and centroid with sum."""
    k, size = centroids.rows.shape
    kinds = f"vec_id {state.schema['vec_id'].dataType.simpleString()}, embedding {state.schema['embedding'].dataType.simpleString()}, own int, upper double, lower array<double>, d2 decimal(38,0), sum array<bigint>, work bigint"
    names = ["vec_id", "embedding", "own", "upper", "lower", "d2", "sum", "work"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        work, types = 0, None
        for batch in batches:
            n, vectors = batch.num_rows, batch.column("embedding")
            types = batch.schema.field("vec_id").type, batch.schema.field("embedding").type
            if not n:
                continue
            rows = integers(vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, size), scale)
            if first:
                own, upper, lower = np.zeros(n, np.int32), np.full(n, np.inf), np.zeros((n, k))
            else:
                own, upper = (batch.column(c).to_numpy().copy() for c in ("own", "upper"))
                lower = batch.column("lower").flatten().to_numpy().reshape(n, k).copy()
            work += assign(rows, centroids, own, upper, lower)
            exact = rows.dtype == object or centroids.rows.dtype == object
            d2 = pa.nulls(n, pa.decimal128(38, 0))
            if last:
                told = rows.astype(object) - centroids.rows[own] if exact else rows - centroids.rows[own]
                d2 = pa.array([min(x, LONGEST) for x in (told * told).sum(axis=1).tolist()], pa.decimal128(38, 0))
            else:
                order = np.argsort(own, kind="stable")
                met, begin = np.unique(own[order], return_index=True)
                for j, part in zip(met.tolist(), np.add.reduceat(rows[order], begin, axis=0)):
                    total[j] = total.get(j, 0) + np.concatenate([part.astype(object), [int((own == j).sum())]])
            flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(lower.ravel()))
            bounds = [pa.nulls(n, pa.float64()), pa.nulls(n, pa.list_(pa.float64()))] if last else [pa.array(upper), flat]
            kept = pa.nulls(n, types[1]) if last else vectors
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), kept, pa.array(own, pa.int32()), *bounds, d2, pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64())], names)
        if total:
            n, sums = len(total), []
            for row in total.values():
                count = 1 + max(x.bit_length() for x in map(int, row)) // DIGIT
                each = [_digits(int(x), count) for x in row]
                sums.append([d[i] for i in range(count) for d in each])
            empty = [pa.nulls(n, types[0]), pa.nulls(n, types[1]), pa.array(list(total), pa.int32()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.list_(pa.float64())), pa.nulls(n, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(sums, pa.list_(pa.int64())), pa.array([work] + [0] * (n - 1), pa.int64())], names)

    columns = ["vec_id", "embedding"] if first else ["vec_id", "embedding", "own", "upper", "lower"]
    return state.select(*columns).mapInArrow(run, kinds)


def _means(state: DataFrame, before: list[list[int]]) -> list[list[int]]:
    """The floor of each centroid's mean; one without vectors stays. k times the components rows reach the driver."""
    size = len(before[0]) + 1
    parts = state.filter("sum is not null").select("own", F.posexplode("sum").alias("i", "digit"))
    total: dict[int, list[int]] = {}
    for own, i, digit in parts.groupBy("own", "i").agg(F.sum("digit")).collect():
        total.setdefault(own, [0] * size)[i % size] += digit << DIGIT * (i // size)
    return [[x // total[j][-1] for x in total[j][:-1]] if j in total else row for j, row in enumerate(before)]


def first_centroids(vectors: DataFrame, k: int, scale: int, seed: int) -> list[list[int]]:
    """The k vectors of smallest sha256 of `seed:vec_id`, in that order; equal ids by their components. A null id counts as the empty text."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = vectors.select(order.alias("order"), F.col("embedding").cast("array<double>").alias("x")).orderBy("order", "x").limit(k)
    return [[_whole(x, scale) for x in r["x"]] for r in chosen.collect()]


def cluster(vectors: DataFrame, k: int = 16, size: int = 64, rounds: int = 3, scale: int = 64, seed: int = 1, scratch: Scratch | None = None) -> tuple[DataFrame, list[list[int]], list[int]]:
    """vec_id, cluster (int), distance (decimal, squared) of every usable vector; the final centroids; distances worked out in each round but the last.

    Vectors (vec_id, embedding) of another size or with a component that is null or not finite are left out. Repeated
    rows count each for itself. With fewer than k vectors there are as many centroids as vectors, with none no rows.
    A distance beyond 63 bits is given as 2^63 - 1; it is compared as it is.
    """
    scratch = scratch or Scratch(vectors.sparkSession)
    state = vectors.filter(usable("embedding", size)).select("vec_id", "embedding")
    rows, before, work = first_centroids(state, k, scale, seed), None, []
    if not rows:
        return state.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("decimal(38,0)").alias("distance")), [], []
    for turn in range(rounds + 1):
        last = turn == rounds
        made = scratch.keep(_pass(state, Centroids(rows, before), scale, turn == 0, last), f"round{turn}")
        if not last:
            work.append(made.agg(F.sum("work")).first()[0] or 0)
            rows, before = _means(made, rows), rows
            state = made.filter("sum is null")
        if turn:
            scratch.drop(f"round{turn - 1}")
    return made.select("vec_id", F.col("own").alias("cluster"), F.col("d2").alias("distance")), rows, work


def cluster_report(vectors: DataFrame, **settings: int) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector."""
    made, rows, _ = cluster(vectors, **settings)
    sums = {r["cluster"]: int(r["s"]) for r in made.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    told = [(j, min(s, LONGEST), min(sum(sums.values()), LONGEST), hashlib.sha256(",".join(map(str, rows[j])).encode()).hexdigest()) for j, s in sums.items()]
    told = made.sparkSession.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    made = made.join(F.broadcast(told), "cluster")  # a row for each centroid
    return made.select("vec_id", "cluster", F.col("distance").cast("long").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")
