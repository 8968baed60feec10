"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is an n-gram of characters that a text holds, hashed to a fixed table; it counts once however often it occurs,
and its value is the log-ratio of its share in toxic and in clean training texts. Logistic regression over these values
gives the weights. Texts are lower-cased and white space between words is one blank, so n-grams see where words begin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import Scratch, binary, crc_fold

#: Lengths of n-grams, bits of the table that they are hashed to.
LEAST, MOST, BITS = 3, 6, 21
#: Labelled texts of each class that the classifier is fitted on: the only bound on what is learned from.
SAMPLE = 3_000
#: A feature must occur in so many sampled texts, and its log-ratio must be so far from 0.
TEXTS, RATIO = 4, 0.7
PRIME = np.uint64(0x9E3779B97F4A7C15)


def grams(raw: bytes) -> np.ndarray:
    """The places in the table of a text's n-grams, in order, with repeats."""
    text = " " + " ".join(raw.decode("utf-8", "replace").lower().split()) + " "
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    out, h = [], c
    for n in range(2, MOST + 1):
        if len(h) < 2:
            break
        h = h[:-1] * PRIME + c[n - 1 :]
        if n >= LEAST:
            out.append((((h ^ (h >> np.uint64(31))) * PRIME) >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.empty(0, np.int32)


class Classifier:
    """weight of each place in the table (most are 0) and the intercept."""

    def __init__(self, weight: np.ndarray, intercept: float):
        self.weight, self.intercept = weight, intercept

    def logit(self, raw: bytes) -> float:
        places = grams(raw)
        told = places[self.weight[places] != 0]
        if not len(told):
            return self.intercept
        distinct = np.unique(told)
        return self.intercept + float(self.weight[distinct].sum()) / scale(len(places))

    def score(self, raw: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(raw), -500, 500))))


def scale(places: int) -> float:
    """Longer texts hold more n-grams by chance."""
    return float(np.sqrt(max(places, 400)) / 100)


def log_ratios(bad: np.ndarray, good: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Of features that so many toxic and clean texts hold, the log-ratio of their smoothed shares."""
    return np.log(((bad + 1.0) / (toxic + 2)) / ((good + 1.0) / (clean + 2)))


def fit(ratio: np.ndarray, texts: list[np.ndarray], sizes: np.ndarray, toxic: np.ndarray, share: float, penalty: float = 1e-2, rounds: int = 300) -> tuple[np.ndarray, float]:
    """The features' weights times their log-ratios, and the intercept, by logistic regression.

    texts: the numbers of the features that each text holds; sizes: n-grams of each with repeats; share: toxic texts
    among all labelled ones.
    """
    odds = float(np.log(share / (1 - share)))
    if not len(texts) or toxic.all() or not toxic.any() or not len(ratio):
        return np.zeros(len(ratio)), odds
    places = np.concatenate(texts).astype(np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    value = (ratio[places] / np.array([scale(int(s)) for s in sizes])[owner]).astype(np.float32)
    # Adam over all rows; the penalty holds weights near 0.
    w, b, m, v, mb, vb = np.zeros(len(ratio), np.float32), 0.0, np.zeros(len(ratio)), np.zeros(len(ratio)), 0.0, 0.0
    y, n = toxic.astype(float), len(texts)
    each = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())  # both classes weigh the same
    for step in range(1, rounds + 1):
        z = np.bincount(owner, w[places] * value, n) + b
        err = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * each
        g, gb = np.bincount(places, err.astype(np.float32)[owner] * value, len(ratio)) + penalty * w / n, err.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        lift = 0.05 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        w, b = (w - lift * m / (np.sqrt(v) + 1e-12)).astype(np.float32), b - lift * mb / (np.sqrt(vb) + 1e-12)
    return w * ratio, float(b + odds)


def _batch(names: list[str], *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names)


def train(labels: DataFrame, texts: DataFrame, sample: int = SAMPLE) -> Classifier:
    """labels: doc_id, toxic; texts: doc_id, text. At most sample labels of each class, by hash of the id, have their texts read, whole.

    Features are counted and chosen in the cluster; the driver gets the chosen ones of the sampled texts.
    """
    spark, scratch = texts.sparkSession, Scratch(texts.sparkSession)
    counts = dict(labels.groupBy("toxic").count().collect())
    total = counts.get(1, 0) + counts.get(0, 0)
    share = (counts.get(1, 0) + 1) / (total + 2)
    drawn = None
    for label in (0, 1):
        part = labels.filter(F.col("toxic") == label).withColumn("h", F.xxhash64("doc_id", F.lit(5)))
        part = part.orderBy("h", "doc_id").limit(sample)
        drawn = part if drawn is None else drawn.union(part)
    drawn = drawn.select(F.col("doc_id").alias("l0"), "toxic")  # twice sample rows at most
    rows = scratch.keep(texts.join(F.broadcast(drawn), F.col("doc_id") == F.col("l0")).select("text", "toxic").repartition(8), "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for raw, toxic in zip(binary(batch.column("text")), batch.column("toxic").to_pylist()):
                held[toxic, np.unique(grams(raw or b""))] += 1
        there = np.flatnonzero(held.any(axis=0)).astype(np.int32)
        yield _batch(["place", "good", "bad"], pa.array(there), pa.array(held[0, there]), pa.array(held[1, there]))

    counted = rows.mapInArrow(count, "place int, good int, bad int").groupBy("place").agg(F.sum("good").cast("int").alias("good"), F.sum("bad").cast("int").alias("bad"))
    found = counted.filter(F.col("good") + F.col("bad") >= TEXTS).toArrow()  # the table's places at most
    place, good, bad = (found.column(c).to_numpy() for c in ("place", "good", "bad"))
    of = dict(rows.groupBy("toxic").count().collect())
    ratio = log_ratios(bad, good, of.get(1, 0), of.get(0, 0))
    chosen = np.argsort(place)
    chosen = chosen[np.abs(ratio[chosen]) >= RATIO]
    place, ratio = place[chosen], ratio[chosen]
    shared = spark.sparkContext.broadcast(place)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.full(1 << BITS, -1, np.int32)
        number[shared.value] = np.arange(len(shared.value), dtype=np.int32)
        for batch in batches:
            made = [grams(raw or b"") for raw in binary(batch.column("text"))]
            told = [n[n >= 0] for n in (number[np.unique(x)] for x in made)]
            offsets = np.cumsum([0, *map(len, told)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(told) if told else np.empty(0, np.int32)))
            yield _batch(["toxic", "size", "told"], batch.column("toxic"), pa.array([len(x) for x in made], pa.int64()), lists)

    sampled = rows.mapInArrow(read, "toxic int, size bigint, told array<int>").toArrow()
    weights, intercept = fit(ratio, [x.values.to_numpy() for x in sampled.column("told")], sampled.column("size").to_numpy(), sampled.column("toxic").to_numpy(), share)
    weight = np.zeros(1 << BITS)
    weight[place] = weights
    return Classifier(weight, intercept)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs (doc_id, text); labels: doc_id, toxic (0, 1 or null).

    Learned from labels whose crc32(doc_id as text) mod folds is not 0; null labels and labels of no document teach
    nothing, and without both classes every text has the classes' share as its score. Null texts count as empty.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & (crc_fold(folds) != 0)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", "text")
    classifier = train(known, texts, sample)
    told = np.flatnonzero(classifier.weight).astype(np.int32)
    shared = docs.sparkSession.sparkContext.broadcast((told, classifier.weight[told].astype(np.float32), classifier.intercept))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weights, intercept = shared.value
        weight = np.zeros(1 << BITS, np.float32)
        weight[places] = weights
        made = Classifier(weight, intercept)
        for batch in batches:
            scores = [made.score(raw or b"") for raw in binary(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "held_out")), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = texts.withColumn("held_out", crc_fold(folds) == 0).mapInArrow(read, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
