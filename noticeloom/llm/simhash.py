"""SimHash near-duplicates through a hierarchical index in Gray order.

Distinct fingerprints are dealt out by masked bit patterns: two that differ in three bits at most agree in one of four
blocks of sixteen, so every fingerprint goes to four nodes, each a mask and the pattern under it. A node with too many
goes on to four children whose masks hold a quarter of the bits that are left, where the same argument holds again.
Within a node the fingerprints are sorted by Gray rank, which puts those that share bits side by side; runs of them are
factored into tree nodes that keep the bits which all below them share. Pairs of tree nodes are descended together, and
a pair is pruned with everything below it once the differences in the bits that both share exceed the limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import Scratch, binary
from noticeloom.llm.components import components

SEED, SHINGLE, DISTANCE = 42, 3, 3
#: Fingerprints in a node from which on it is split by a longer mask.
NODE = 2_000
#: Children of a tree node, and node pairs that are descended at a time.
FAN, PAIRS = 8, 1 << 17
#: Hashes whose bits are counted at a time: a byte counts up to 255 of them.
BLOCK = 255 * 128


def fingerprint(raw: bytes) -> int:
    """Bit i is set if it is set in over half of the shingles' XXH64; shingles count as often as they occur."""
    words = raw.lower().split()  # of bytes: A-Z alone, and ASCII white space
    n = len(words)
    if not n:
        return 0
    if n < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[: n - SHINGLE] + 1]).tolist()
    pieces = map(text.__getitem__, map(slice, starts, ends[SHINGLE - 1 :].tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, n - SHINGLE + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].astype("<u8").view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 8)
        sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)  # eight counts of a byte each in a number
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in keep and fp (bigint with the fingerprint's bits) of every row; a null or blank text has 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(raw or b"") for raw in binary(batch.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(made)], [*keep, "fp"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(run, f"{kinds}, fp bigint")


def _masks() -> list[dict[tuple[int, ...], int]]:
    """By level, the mask of every path of quarters: a block of 16 bits, then a nibble of each other block, then a bit of each nibble left."""
    blocks = {(j,): 0xFFFF << 16 * j for j in range(4)}
    nibbles = {(j, k): blocks[(j,)] | sum(0xF << 16 * b + 4 * k for b in range(4) if b != j) for j in range(4) for k in range(4)}
    bits = {
        (j, k, m): nibbles[(j, k)] | sum(1 << 16 * b + 4 * c + m for b in range(4) if b != j for c in range(4) if c != k)
        for j in range(4) for k in range(4) for m in range(4)
    }
    return [blocks, nibbles, bits]


MASKS = _masks()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _children(level: int, path: Column | None) -> Column:
    """The nodes of a level below path as an array of structs: path as a number to the base of four, and the node's key."""
    made = []
    for at, mask in MASKS[level].items():
        number = sum(q * 4**i for i, q in enumerate(at))
        node = F.struct(F.lit(number).alias("path"), F.xxhash64(F.lit(level), F.lit(number), F.col("fp").bitwiseAND(F.lit(_signed(mask)))).alias("node"))
        if level == 0:
            made.append(node)
        else:
            up = sum(q * 4**i for i, q in enumerate(at[:-1]))
            made.append(F.when(path == up, node))
    return F.array(*made) if level == 0 else F.filter(F.array(*made), lambda x: x.isNotNull())


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of a code in the binary-reflected Gray sequence."""
    out = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


class GrayForest:
    """A tree for each node of a sorted block: codes at height 0, above them runs of FAN with their shared bits."""

    def __init__(self, node: np.ndarray, code: np.ndarray):
        order = np.lexsort((gray_rank(code), node))
        self.code = code[order]
        owner = node[order]
        full = np.full(len(code), ~np.uint64(0))
        self.heights = [(self.code, full, None, None)]  # pattern, shared bits, first child, children
        least, most = self.code, self.code
        while True:
            begins = np.concatenate([[True], owner[1:] != owner[:-1]])
            first = np.maximum.accumulate(np.where(begins, np.arange(len(owner)), 0))
            starts = np.flatnonzero((np.arange(len(owner)) - first) % FAN == 0)
            if len(starts) == len(owner):
                break
            least, most = np.bitwise_and.reduceat(least, starts), np.bitwise_or.reduceat(most, starts)
            counts = np.diff(np.append(starts, len(owner)))
            self.heights.append((least, ~(least ^ most), starts, counts))
            owner = owner[starts]
        self.roots = len(owner)

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places in code whose codes differ in so many bits at most, in blocks."""
        top = len(self.heights) - 1
        root = np.arange(self.roots)
        stack = [(top, root[i : i + PAIRS], root[i : i + PAIRS]) for i in range(0, self.roots, PAIRS)]
        while stack:
            h, a, b = stack.pop()
            if h == 0:
                yield a, b
                continue
            _, _, starts, counts = self.heights[h]
            pattern, shared, _, _ = self.heights[h - 1]
            each = counts[a] * counts[b]
            pair = np.repeat(np.arange(len(a)), each)
            nth = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
            c, d = starts[a[pair]] + nth // counts[b[pair]], starts[b[pair]] + nth % counts[b[pair]]
            near = np.bitwise_count((pattern[c] ^ pattern[d]) & shared[c] & shared[d]) <= distance
            near &= c < d if h == 1 else c <= d
            c, d = c[near], d[near]
            step = PAIRS // (FAN * FAN) if h > 1 else PAIRS
            stack += [(h - 1, c[i : i + step], d[i : i + step]) for i in range(0, len(c), step)]

    def chains(self, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """A chain of codes through each group that is linked here: one pair fewer than the group has codes."""
        label = np.arange(len(self.code))
        for a, b in self.links(distance):
            while True:
                x, y = label[a], label[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
                while (label[label] != label).any():
                    label = label[label]
        order = np.argsort(label, kind="stable")
        same = label[order][1:] == label[order][:-1]
        return self.code[order[:-1][same]], self.code[order[1:][same]]


def near_links(codes: DataFrame, scratch: Scratch, distance: int = DISTANCE) -> DataFrame:
    """a, b: chains through the groups of codes (fp, distinct) that differ in distance bits at most; distance is 3 at most.

    Every link between two codes is found in a node that holds both, and a chain joins the codes linked there, so the
    rows are fewer than four (with splits, sixteen or sixty-four) for each code whatever the groups' sizes.
    """
    if not 0 <= distance <= 3:
        raise ValueError("four blocks find up to three differing bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chains(node: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
            a, b = GrayForest(node, code).chains(distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        node, code = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            node = np.concatenate([node, batch.column("node").to_numpy()])
            code = np.concatenate([code, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(node) or node[0] == node[-1]:
                continue
            whole = int(np.flatnonzero(node != node[-1])[-1]) + 1  # the last node may go on in the next batch
            yield chains(node[:whole], code[:whole])
            node, code = node[whole:], code[whole:]
        if len(node):
            yield chains(node, code)

    found, rows = [], codes.select("fp", F.explode(_children(0, None)).alias("at")).select("fp", "at.path", "at.node")
    for level in range(len(MASKS)):
        last = level == len(MASKS) - 1
        rows = scratch.keep(rows, f"nodes{level}") if not last else rows
        crowded = None
        if not last:
            crowded = rows.groupBy("node").count().filter(F.col("count") > NODE).select(F.col("node").alias("n0"))
            crowded = scratch.keep(crowded, f"crowded{level}")
            if crowded.isEmpty():
                crowded = None
        fit = rows if crowded is None else rows.join(crowded, F.col("node") == F.col("n0"), "left_anti")
        dealt = fit.select("node", "fp").repartition("node").sortWithinPartitions("node")
        found.append(dealt.mapInArrow(run, "a bigint, b bigint"))
        if crowded is None:
            break
        more = rows.join(crowded, F.col("node") == F.col("n0"), "left_semi")
        rows = more.select("fp", F.explode(_children(level + 1, F.col("path"))).alias("at")).select("fp", "at.path", "at.node")
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out


def _grouped(docs: DataFrame, keep: tuple[str, ...], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The kept columns with fp of every row, and fp with its root for all linked ones."""
    prints = scratch.keep(fingerprints(docs, keep), "prints")
    codes = scratch.keep(prints.select("fp").distinct(), "codes")
    return prints, components(near_links(codes, scratch), scratch)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of docs (doc_id, text).

    component_id is the least doc_id that is reached over links of three differing bits or fewer. Null ids count as none,
    so a group without any id has a null one. Texts without words share the fingerprint of zeros and are linked like any other.
    """
    scratch = Scratch(docs.sparkSession)
    prints, roots = _grouped(docs, ("doc_id",), scratch)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = scratch.keep(rooted, "rooted")
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = rooted.join(groups, "root").select(F.col("fp").alias("f0"), "component_id")
    made = prints.join(ids, F.col("fp") == F.col("f0"))
    return made.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group, with all columns: that of the least doc_id (null last), among equal ids of the least text hash.

    Only ids, hashes and fingerprints are grouped; the rows that go are taken out of docs by an anti join.
    """
    scratch = Scratch(docs.sparkSession)
    keyed = docs.select(F.col("doc_id"), F.xxhash64("text").alias("digest"), F.col("text"))
    prints, roots = _grouped(keyed, ("doc_id", "digest"), scratch)
    key = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id"), F.col("digest"))
    least = prints.groupBy("fp").agg(F.min(key).alias("least"))
    rooted = scratch.keep(least.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    groups = rooted.groupBy("root").agg(F.min("least").alias("stays"))
    stays = rooted.join(groups, "root").select(F.col("fp").alias("f0"), "stays")
    gone = prints.join(stays, F.col("fp") == F.col("f0")).filter(~key.eqNullSafe(F.col("stays")))
    gone = scratch.keep(gone.select(F.col("doc_id").alias("d0"), F.col("digest").alias("h0")).distinct(), "gone")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("d1"), F.xxhash64("text").alias("h1"))
    left = rows.join(gone, F.col("d1").eqNullSafe(F.col("d0")) & (F.col("h1") == F.col("h0")), "left_anti")
    again = prints.groupBy("doc_id", "digest").count().filter("count > 1").limit(1)
    if not again.isEmpty():  # rows that repeat an id and a text whole: one of each stays
        left = left.dropDuplicates(["d1", "h1"])
    return left.select("row.*")
