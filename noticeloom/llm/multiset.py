"""Document fingerprints as homomorphic multiset hashes.

A paragraph (what lies between line ends) is hashed to a wide vector, and a text's fingerprint is the sum of its
paragraphs' vectors, lane by lane, modulo 2**32. So the order of paragraphs does not matter, paragraphs are added and
removed by adding and subtracting their vectors, and fingerprints of parts add up to that of the whole. The first lanes
are drawn from the paragraph's bytes, and two multisets of paragraphs agree there only if they are equal. The other
lanes count the paragraph's shingles of three words with random signs in random lanes; the sum keeps inner products, so
two fingerprints tell how much their texts share without the texts.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticeloom.llm.common import binary

#: Lanes that tell equality (2048 bits) and lanes that tell likeness.
EQUAL, LIKE = 64, 256
#: Words whose hashes a task remembers; the memory starts anew when it is full.
REMEMBERED = 500_000
#: Odd multipliers of a shingle's words.
K1, K2, K3, MIX = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        made = xxhash.xxh64_intdigest(word, 7)
        self[word] = made
        return made


class Fingerprinter:
    """Vectors of EQUAL + LIKE unsigned 32-bit lanes."""

    def __init__(self):
        self.words = WordHashes()

    def vector(self, paragraphs: list[bytes]) -> np.ndarray:
        """The sum of the paragraphs' vectors; no paragraphs give zeros."""
        out = np.zeros(EQUAL + LIKE, np.uint32)
        if not paragraphs:
            return out
        drawn = b"".join([hashlib.shake_128(p).digest(4 * EQUAL) for p in paragraphs])
        out[:EQUAL] = np.frombuffer(drawn, "<u4").reshape(-1, EQUAL).sum(axis=0, dtype=np.uint32)
        split = [p.split() for p in paragraphs]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        n = int(sizes.sum())
        if n:
            get = self.words.__getitem__
            h = np.fromiter((get(w) for words in split for w in words), np.uint64, n)
            ends = np.cumsum(sizes)
            left = np.repeat(ends, sizes) - np.arange(n)  # words from here to the paragraph's end
            whole = np.zeros(n, bool)
            whole[(ends - sizes)[(sizes > 0) & (sizes < 3)]] = True  # a short paragraph is one shingle
            padded = np.concatenate([h, np.zeros(2, np.uint64)])
            s = h * K1 + np.where(left > 1, padded[1 : n + 1] * K2, 0) + np.where(left > 2, padded[2 : n + 2] * K3, 0)
            s = s[(left > 2) | whole]
            s ^= s >> np.uint64(32)
            s *= MIX
            s ^= s >> np.uint64(29)
            s *= MIX
            lane = (s >> np.uint64(56)).astype(np.int64)
            sign = ((s >> np.uint64(55)) & np.uint64(1)).astype(np.float64) * 2 - 1
            out[EQUAL:] = np.bincount(lane, sign, LIKE).astype(np.int64).astype(np.uint32)
        return out

    def text(self, raw: bytes) -> np.ndarray:
        return self.vector(raw.split(b"\n"))

    def edit(self, before: np.ndarray, old: bytes, new: bytes) -> np.ndarray:
        """The fingerprint of new from that of old: the paragraphs that differ are taken out and put in."""
        a, b = old.split(b"\n"), new.split(b"\n")
        same, most = 0, min(len(a), len(b))
        while same < most and a[same] == b[same]:
            same += 1
        return before - self.vector(a[same:]) + self.vector(b[same:])


def written(vector: np.ndarray) -> str:
    """The lanes as text: base64 of their little-endian bytes. Equal vectors have equal texts."""
    return base64.b64encode(vector.astype("<u4").tobytes()).decode()


def lanes(told: str) -> np.ndarray:
    """The vector that written() gave as text; paragraphs can be added to it and taken from it."""
    return np.frombuffer(base64.b64decode(told), "<u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the estimated shared shingles by all of both, from 0 to 1; 1 for equal fingerprints, and 0 if nothing can be told.

    The estimate is off by one over the square root of LIKE at most as a standard error: about 0.06.
    """
    if np.array_equal(a, b):
        return 1.0
    x, y = (v[EQUAL:].astype(np.int32).astype(np.float64) for v in (a, b))
    both = x @ x + y @ y
    return float(min(1.0, max(0.0, 2 * (x @ y) / both))) if both else 0.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (binary, little-endian lanes) of every row of docs (doc_id, text). A null text counts as empty: one empty paragraph."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Fingerprinter()
        for batch in batches:
            made = [f.text(raw or b"").tobytes() for raw in binary(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.binary())], ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint binary")


def beside_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id integral, text) dealt out so that each task holds a run of documents in descending doc_id, in order.

    Columns bucket, halo, doc_id, text: the first document of the run that follows comes last, marked halo; after the
    last run comes the first. Among equal ids, and after all others among null ones, hashes of the texts decide.
    Only ids are read to find the runs' ends; texts move once.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = ids.withColumn("h", F.xxhash64("text"))
    shares = [i / n for i in range(1, n)]
    ends = sorted(set(docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares or [0.5], 10_000)).first()[0] or []))
    # Null ids are dealt out by their texts' hashes, which are even.
    nulls = F.lit(len(ends) + 1) + F.floor((F.lit(0.5) - F.col("h") / float(2**64)) * n).cast("int")
    bucket = F.when(F.col("doc_id").isNull(), nulls).otherwise(len(ends) - _below(ends, F.col("doc_id"))).cast("int")
    ids = ids.withColumn("bucket", bucket)
    tops = ids.groupBy("bucket").agg(F.max(F.struct("doc_id", "h")).alias("top")).orderBy("bucket").collect()  # a row per bucket
    heads = [(r["bucket"], r["top"]["doc_id"], r["top"]["h"], tops[i - 1]["bucket"]) for i, r in enumerate(tops)]
    heads = spark.createDataFrame(heads, "b0 int, d0 long, h0 long, before int")
    met = ids.join(F.broadcast(heads), F.col("bucket") == F.col("b0"))  # two buckets for each shuffle partition at most
    is_first = F.col("doc_id").eqNullSafe(F.col("d0")) & (F.col("h") == F.col("h0"))
    own, copy = (F.struct(b.alias("bucket"), F.lit(halo).alias("halo")) for b, halo in ((F.col("bucket"), False), (F.col("before"), True)))
    dealt = met.select("doc_id", "text", "h", F.explode(F.when(is_first, F.array(own, copy)).otherwise(F.array(own))).alias("at"))
    dealt = dealt.select("at.bucket", "at.halo", "doc_id", "text", "h").repartitionById(len(ends) + n + 2, F.col("bucket"))
    return dealt.sortWithinPartitions("bucket", "halo", F.col("doc_id").desc_nulls_last(), F.col("h").desc()).drop("h")


def _below(ends: list[int], value: Column) -> Column:
    """How many of ends (ascending) are below value: whole blocks of them first, then those in one block."""
    if not ends:
        return F.lit(0)
    k = math.isqrt(len(ends)) + 1
    blocks = [ends[i : i + k] for i in range(0, len(ends), k)]
    whole = F.size(F.filter(F.array(*(F.lit(b[-1]) for b in blocks)).cast("array<bigint>"), lambda e: e < value))
    block = F.get(F.array(*(F.array(*map(F.lit, b)).cast("array<bigint>") for b in blocks)), whole)
    return whole * k + F.coalesce(F.size(F.filter(block, lambda e: e < value)), F.lit(0))


def edited_text(text: str, following: str) -> str:
    """text with its last third replaced by as much of the beginning of the following one, or all of that."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


EDITED = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row of docs.

    The edited text takes its end from the next document in descending doc_id, which must be integral and keeps its type.
    Fingerprints are given whole, as written() has them: lanes() reads them back. A null text counts as empty; a table of
    one row has itself as its next; equal rows give equal rows; null ids come last, by the hashes of their texts.
    """
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"doc_id orders the documents and must be integral, not {kind.simpleString()}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, held = Fingerprinter(), None
        for batch in batches:
            out: list[tuple] = []
            for bucket, halo, doc_id, raw in zip(batch.column("bucket").to_pylist(), batch.column("halo").to_pylist(), batch.column("doc_id").to_pylist(), binary(batch.column("text"))):
                if halo and (held is None or held[0] != bucket):
                    continue
                vector = f.text(raw)
                if held is not None and held[0] == bucket:
                    out.append(row(f, held, raw, vector))
                held = None if halo else (bucket, doc_id, raw, vector)
            columns = list(map(list, zip(*out))) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def row(f: Fingerprinter, held: tuple, following: bytes, next_vector: np.ndarray) -> tuple:
        _, doc_id, raw, vector = held
        text = raw.decode()
        edited = edited_text(text, following.decode()).encode()
        changed = f.edit(vector, raw, edited)
        return doc_id, len(text), hashlib.sha256(edited).hexdigest(), written(vector), written(changed), likeness(vector, changed), likeness(vector, next_vector)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    made = beside_next(docs).mapInArrow(run, f"doc_id bigint, {EDITED}")
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))
