"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target of words. Whole copies of all its documents are certain; what remains of the target is
filled by one further copy of some documents. For it each document has an inclusion probability p, which grows with its
length; in each source the sum of p times size is the remainder. Each document has a fixed random number u, and
documents are taken by ascending (u / (1 - u)) / (p / (1 - p)) until the remainder is full:
Pareto order sampling with the sample's size fixed in words. The order is cut by two rounds of histograms, so no task
ever sorts a source; only the rows of one bin in a million are compared one by one. The order is cut where it is nearest
to the remainder: a document is taken if its middle word lies within it. Nothing is taken out of order, so a source misses
its target by half of the document at the cut at most. Sources that miss it by more than a ten-thousandth, which only those
of few documents do, are drawn again with other random numbers (rejective sampling): of up to 64 Pareto samples the one nearest
to the target stands, so what decides between samples is their sum, never the size of one document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.llm.common import WORD, Scratch, text_or_empty, uniform

#: Sources up to which the table of targets is broadcast; beyond it, it is joined by a shuffle whose hot keys AQE splits.
BROADCAST_SOURCES = 10_000
#: Bins of a histogram round.
BINS = 1024
#: A source whose sample misses its target by more than this part of it is drawn again.
TOLERANCE = 1e-4
#: Samples drawn of a source at most.
DRAWS = 64
#: How far inclusion probabilities are spread, of what keeps them between 0 and 1.
SPREAD = 0.9


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, scratch: Scratch, weights: Sequence[float], cap: float, half: float) -> DataFrame:
    """A row per source: source, source_size, mean (preference by size), weight, target.

    Sources in code point order, null last, get the weights in turn; the targets share the sum of all sizes, none is
    above cap times its source, and what a cap cuts off goes to the others by weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("i") % len(weights) + 1)
    preferred = F.sum(F.col("size") * preference(F.col("size"), half))
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.coalesce(preferred / F.nullif(F.sum("size"), F.lit(0)), F.lit(0.0)).alias("mean"))
    table = table.withColumn("i", (F.row_number().over(order) - 1).cast("int")).withColumn("weight", weight)
    table = scratch.keep(table, "sources")
    # The targets are min(weight * level, cap * size); the level rises until the targets share everything.
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * level > cap * F.col("source_size")
        row = table.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, cap * F.col("source_size")).otherwise(0.0)).alias("cut"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("free"),
            F.count_if(full).alias("n"),
        ).first()
        if row["n"] == capped or not row["free"]:
            break
        level, capped = (row["all"] - row["cut"]) / row["free"], row["n"]
    return table.withColumn("target", F.least(F.col("weight") * level, cap * F.col("source_size")).cast("double"))


def preference(size: Column, half: float) -> Column:
    """Grows with a document's length and levels off below 1."""
    return size / (size + half)


def inclusion(share: Column, size: Column, mean: Column, half: float) -> Column:
    """p of a document, from 0 to 1: the share of its source that is still to be taken, moved by how its preference differs from the mean.

    mean is the source's preference weighted by sizes, so the sum of p times size is share times the source's size: the remainder.
    """
    return share + SPREAD * F.least(share, 1 - share) * (preference(size, half) - mean)


def _rank(p: Column, size: Column, u: Column) -> Column:
    """The Pareto rank, random odds by inclusion odds, as r / (1 + r), in (0, 1)."""
    r = (u / (1 - u)) * ((1 - p) / p)
    return F.when((p > 0) & (size > 0), r / (1 + r)).otherwise(F.lit(1.0))


#: Columns of a source's plan.
PLAN = ("source_size", "mean", "weight", "target", "whole", "rest", "share")


def _of_source(left: DataFrame, side: DataFrame, few: bool, *also: str, how: str = "inner") -> DataFrame:
    """left with side's columns, by source (null is one of them) and the other columns named; side is broadcast if it has few rows."""
    keys = ("source", *also)
    side = side.withColumnsRenamed({c: f"side_{c}" for c in keys})
    same = [F.col(c).eqNullSafe(F.col(f"side_{c}")) for c in keys]
    on = same[0] if len(same) == 1 else same[0] & same[1]
    return left.join(F.broadcast(side) if few else side, on, how).drop(*(f"side_{c}" for c in keys))


class Mix:
    """Copies of each document for a mix.

    docs needs source, size (long, not null), and doc_id and digest, which tell documents apart; rows alike in all of
    them share one fate. A null source is a source of its own. Without rows there is nothing to mix.
    """

    def __init__(self, sizes: DataFrame, *, weights: Sequence[float] = (1, 2, 3), cap: int = 3, seed: int = 20_011, half: float = 50.0):
        self.cap, self.seed, self.half = cap, seed, half
        spark = sizes.sparkSession
        scratch = Scratch(spark)
        plan = source_targets(sizes, scratch, weights, cap, half)
        whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(cap))).otherwise(0)
        plan = plan.withColumn("whole", whole.cast("long")).withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
        plan = plan.withColumn("share", F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(0.0))
        plan = scratch.keep(plan, "plan")
        first = self._draw(sizes, plan, range(1), scratch)
        missed = scratch.keep(first.filter(F.col("gap") > TOLERANCE * F.col("target")).select("source", *PLAN), "missed")
        again = self._draw(sizes, missed, range(1, DRAWS), scratch)
        best = F.min_by(F.struct("draw", "floor", "limit", "gap"), F.struct("gap", "draw")).alias("best")
        cuts = first.unionByName(again)
        self.plan = scratch.keep(cuts.groupBy("source", *PLAN).agg(best).select("source", *PLAN, "best.*"), "cuts")
        self.few = self.plan.count() <= BROADCAST_SOURCES

    def _ranked(self, docs: DataFrame, plan: DataFrame, few: bool) -> DataFrame:
        """docs with the columns of plan, where each row is a draw of a source, and their rank in that draw."""
        joined = _of_source(docs, plan, few)
        u = uniform("doc_id", "digest", "draw", seed=self.seed)
        return joined.withColumn("rank", _rank(inclusion(F.col("share"), F.col("size"), F.col("mean"), self.half), F.col("size"), u))

    def _draw(self, sizes: DataFrame, plan: DataFrame, draws: range, scratch: Scratch) -> DataFrame:
        """plan for each draw, with floor and limit of its cut and the words by which it misses the remainder (gap)."""
        plan = plan.withColumn("draw", F.explode(F.array(*map(F.lit, draws))))
        few = plan.count() <= BROADCAST_SOURCES
        rows = self._ranked(sizes, plan, few).filter("size > 0 and rest > 0").select("source", "draw", "doc_id", "digest", "size", "rank", "rest")
        name = f"draw{draws.start}"
        rows = scratch.keep(rows, f"{name}-ranked")
        edge = self._cut(rows, plan, few, scratch, name)
        scratch.drop(f"{name}-ranked")
        return edge

    def _cut(self, rows: DataFrame, plan: DataFrame, few: bool, scratch: Scratch, name: str) -> DataFrame:
        """For every draw the last row in the order whose middle is within the remainder: bins first, then the rows of one bin."""
        before = plan.select("source", "draw", F.lit(0.0).alias("taken"))
        by_draw = Window.partitionBy("source", "draw")
        for depth in (1, 2):
            scale = float(BINS**depth)
            rows = rows.withColumn("bin", F.least(F.floor(F.col("rank") * scale), F.lit(int(scale) - 1)).cast("long"))
            bins = rows.groupBy("source", "draw", "bin").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
            bins = _of_source(bins, before.select("source", "draw", "taken"), few, "draw")
            bins = bins.withColumn("upto", F.col("taken") + F.sum("words").over(by_draw.orderBy("bin")))
            # The bin where the remainder is passed, or the last one where it never is.
            at = F.struct("bin", (F.col("upto") - F.col("words")).alias("taken"))
            passed = F.min(F.when(F.col("upto") > F.col("rest"), at))
            before = bins.groupBy("source", "draw").agg(F.coalesce(passed, F.max(at)).alias("at")).select("source", "draw", "at.taken", F.col("at.bin").alias("floor"))
            before = scratch.keep(before, f"{name}-bin{depth}")
            rows = _of_source(rows, before.drop("taken"), few, "draw").filter("bin = floor").drop("floor", "bin")
        key = F.struct("rank", "doc_id", "digest")
        alike = rows.groupBy("source", "draw", "rank", "doc_id", "digest").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"))  # one fate
        upto = F.col("taken") + F.sum("size").over(by_draw.orderBy("rank", "doc_id", "digest"))
        last = _of_source(alike, before, few, "draw").withColumn("upto", upto).filter("upto - size / 2 <= rest")
        last = last.groupBy("source", "draw").agg(F.max(key).alias("limit"), F.max("upto").alias("upto"))
        edge = _of_source(_of_source(plan, before, few, "draw", how="left"), last, few, "draw", how="left")
        gap = F.abs(F.col("rest") - F.coalesce("upto", "taken", F.lit(0.0)))
        edge = edge.withColumn("gap", gap).withColumn("floor", F.coalesce("floor", F.lit(0)))
        return scratch.keep(edge.select("source", *PLAN, "draw", "floor", "limit", "gap"), f"{name}-cut")

    def _in(self) -> Column:
        """Taken: below the bin of the cut, or within it up to its limit."""
        below = F.floor(F.col("rank") * float(BINS**2)) < F.col("floor")
        within = F.col("limit").isNotNull() & (F.struct("rank", "doc_id", "digest") <= F.col("limit"))
        return F.coalesce((F.col("rest") > 0) & (F.col("rank") < 1) & (below | within), F.lit(False))

    def apply(self, docs: DataFrame) -> DataFrame:
        """docs (source, doc_id, digest, size) with source_size, target, copies (long) and the plan's columns."""
        return self._ranked(docs, self.plan, self.few).withColumn("copies", F.col("whole") + self._in().cast("long"))


def sized(docs: DataFrame, *extra: Column) -> DataFrame:
    return docs.select(F.col("doc_id"), F.col("source"), word_count().alias("size"), F.xxhash64("text").alias("digest"), *extra)


def mix_copies(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every row of docs (doc_id, text, source).

    A null text has no words. Sizes are counted once and kept; nothing but counts is shuffled.
    """
    sizes = Scratch(docs.sparkSession).keep(sized(docs), "sizes")
    mixed = Mix(sizes, **options).apply(sizes)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "source")


def mix_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of docs as often as it is taken, with all its columns. Text is never shuffled."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select("doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("digest"), row)
    sizes = Scratch(docs.sparkSession).keep(sized(docs), "sizes")
    mixed = Mix(sizes, **options).apply(rows)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
