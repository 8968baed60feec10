"""Periodic runs of words by the divide and conquer of Main and Lorentz.

The words of a text become small integers. A stretch is cut in the middle; a run that crosses the middle with period q
shows in how far the words around the middle equal those q words on or back, and two Z-functions at the middle give that
for all q at once. Runs that do not cross it lie in one of the halves. Z-functions are kept where they are not 0, that is
at the places of the words that stand at the middle. Plain prose does not come that far: a run lies in a stretch in which
every word occurs again close by, and only such stretches are cut.

A run that goes on beyond a stretch crosses the middle of a larger one and is found whole there; here it is left out. The
same interval turns up with multiples of its period; the smallest is kept. By Fine and Wilf's theorem an interval of three
periods that has a smaller period too is maximal for both, so nothing else needs to be compared. By the same theorem a
run inside a run of period p, but not it, of period q has fewer than p + q words; so halves that lie in a run are searched
for short periods only, and a text of one word repeated is done after a few steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import binary, text_or_empty

#: Words and periods that a run holds at least.
LEAST, TIMES = 24, 3
SPACE = r"[\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _equal(values: list[int], array: np.ndarray, i: int, j: int) -> int:
    """How many values from i on equal those from j on, j > i; stretches beyond 32 are compared in growing blocks."""
    n, k = len(values), 0
    while j + k < n and values[i + k] == values[j + k]:
        k += 1
        if k == 32:
            break
    else:
        return k
    block = 64
    while True:
        there = array[j + k : j + k + block]
        differ = np.flatnonzero(array[i + k : i + k + len(there)] != there)
        if len(differ):
            return k + int(differ[0])
        k += len(there)
        if len(there) < block:
            return k
        block *= 2


def z_function(array: np.ndarray) -> dict[int, int]:
    """For each place but 0: how many values from there on equal those at the start; places with none are left out."""
    places = np.flatnonzero(array[1:] == array[0])
    if not len(places):
        return {}
    values, z, lo, hi = array.tolist(), {}, 0, 0
    for i in (places + 1).tolist():
        k = z.get(i - lo, 0) if i < hi else 0
        if i + k >= hi:
            k = max(hi - i, 0)
            k += _equal(values, array, k, i + k)
            lo, hi = i, i + k
        z[i] = k
    return z


def _stretches(words: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Disjoint stretches that hold all runs whole: every word of a run has its like no farther off than a period."""
    n = len(words)
    if n < least:
        return []
    order = np.argsort(words.astype(np.uint16) if words.max() < 2**16 else words, kind="stable")  # short numbers sort faster
    apart = np.where(words[order[1:]] == words[order[:-1]], np.diff(order), n)
    gap = np.full(n, n)
    gap[order[1:]] = apart
    gap[order[:-1]] = np.minimum(gap[order[:-1]], apart)
    out, stack = [], [(0, n)]
    while stack:
        lo, hi = stack.pop()
        cuts = np.flatnonzero(gap[lo:hi] > (hi - lo) // times) + lo
        if not len(cuts):
            out.append((lo, hi))
            continue
        ends = np.concatenate([[lo - 1], cuts, [hi]])
        wide = np.flatnonzero(np.diff(ends) > least)
        stack += zip((ends[wide] + 1).tolist(), ends[wide + 1].tolist())
    return out


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """start, length and smallest period of all runs of least words and times periods or more, times at least 2, in order."""
    found: dict[tuple[int, int], int] = {}
    stack = [(lo, hi, hi - lo) for lo, hi in _stretches(words, least, times)]
    stop = np.array([-1], words.dtype)
    while stack:
        lo, hi, bound = stack.pop()  # bound: no run here has a longer period
        mid, most = (lo + hi) // 2, min((hi - lo) // times, bound)
        if hi - lo < max(least, 2) or not most:
            continue
        left, right, here = mid - lo, hi - mid, set()
        # The text behind the stop begins (or, backwards, ends) most words on this side of the middle.
        ahead = z_function(np.concatenate([words[mid:hi], stop, words[mid - most : hi]]))
        back = z_function(np.concatenate([words[lo:mid][::-1], stop, words[lo : mid + most][::-1]]))
        to, of = right + 1 + most, left + 1 + most
        pairs = {(q, mid - back.get(of - q, 0), mid + q + ahead.get(q, 0)) for q in _periods(ahead, back, of, most)}
        pairs |= {(q, mid - q - back.get(q, 0), mid + ahead.get(to - q, 0)) for q in _periods(back, ahead, to, most)}
        for q, start, end in pairs:
            if end - start < max(least, times * q):
                continue
            if start == lo > 0 and words[start - 1] == words[start - 1 + q] or end == hi < len(words) and words[end] == words[end - q]:
                continue
            found[start, end] = min(q, found.get((start, end), q))
            here.add((start, end))
        for a, b in ((lo, mid), (mid, hi)):
            around = min((found[x] for x in here if x[0] <= a and b <= x[1]), default=None)
            within = bound if around is None else min(bound, (around - 1) // (times - 1))
            if around is None or around + within > least:
                stack.append((a, b, within))
    return sorted((start, end - start, q) for (start, end), q in found.items())


def _periods(own: dict[int, int], other: dict[int, int], at: int, most: int) -> set[int]:
    """Periods up to most at which at least one of the two sides of the middle goes on."""
    return {q for q in own if q <= most} | {at - i for i in other if at - most <= i < at}


def interned(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    ids: dict[bytes, int] = {}
    return np.array([ids.setdefault(w, len(ids)) for w in words], np.int32)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return [w for w, g in zip(words, gone.tolist()) if not g]


def find_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """docs with runs (array of start, length, period, in words, by start, then period) and collapsed (text) added.

    collapsed holds the text's words, joined by one blank, without those that a run holds after its first period. A null
    or empty text has no runs and an empty collapsed text; repeated rows are judged each for itself; columns of docs
    named runs or collapsed are replaced, all others stay. A text is worked on whole, by one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, lengths, periods, upto, texts = [], [], [], [0], []
            for raw in binary(batch.column("text")):
                words = (raw or b"").split()
                runs = runs_of(interned(words), least, times) if len(words) >= least else []
                for start, length, period in runs:
                    starts.append(start)
                    lengths.append(length)
                    periods.append(period)
                upto.append(len(starts))
                texts.append(b" ".join(collapsed(words, runs)))
            parts = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (starts, lengths, periods)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), parts)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(texts, pa.binary()).cast(pa.string(), safe=False)], [*batch.schema.names, "runs", "collapsed"])

    rows = docs.drop("runs", "collapsed")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, runs {RUNS}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, told by crc32 of the id, get a periodic end.

    With h = crc32(id) divisible by 10, g = h // 10 and n words, each word i from a = g % n on becomes word a + (i - a) % p,
    p = 1 + (n - a) // (3 + g % 8). A null id counts as the empty text, a null text as empty.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(text_or_empty(), SPACE), lambda w: w != "")
    g, n = F.floor(h / 10).cast("long"), F.size(words)
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    end = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    text = F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), end), " ")).otherwise(text_or_empty())
    return docs.select("doc_id", text.alias("text"))


def strongest(runs: str = "runs") -> Column:
    """The run of greatest length / period, compared exactly; ties: smallest start, then period. Null without runs."""

    def better(best: Column, x: Column) -> Column:
        return F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUNS.removeprefix("array<").removesuffix(">")), better)


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the strongest run, runs_sha256, collapsed_sha256."""
    made = find_runs(docs.select("doc_id", "text")).withColumn("best", strongest())
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    milli = F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long")
    return made.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", milli.alias("exponent_milli"), F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
