"""Line dedup through a suffix array over line ids.

The corpus is a sequence of line ids, broken at document ends, at lines without words left out. Prefix doubling sorts
its suffixes: the rank of a suffix by its first 2h lines follows from sorting the pairs (rank by h lines here, rank by h
lines h lines on). Each round sorts all open suffixes by range over the cluster, pair first and place second, so that
equal pairs of any number are spread over tasks. A suffix whose rank no other shares is settled and leaves.

A repeated run counts from a number of words on. The longest common prefix intervals at that depth are the groups of
suffixes that share their first so many words; at every place the shortest run with enough words, counted forwards from
it and backwards from it, is looked up as an interval by two overlapping ranks of the deepest round that fits it. Within a
repeated run, however long, these shortest runs overlap and cover it from end to end; so the union of those that occur
earlier is the union of the later copies of all maximal repeated runs, and that is what is deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.llm.common import Scratch, binary

#: Words from which on a repeated run of lines is deleted.
MIN_WORDS = 50


def _windows(words: list[int], least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line: how many lines from it on, and how many back to it, first hold enough words; 0 if all do not."""
    n = len(words)
    total = np.concatenate([[0], np.cumsum(np.array(words, np.int64))])
    ahead = np.searchsorted(total, total[:-1] + least) - np.arange(n)
    ahead[total[-1] - total[:-1] < least] = 0
    back = np.arange(n) + 1 - (np.searchsorted(total, total[1:] - least, side="right") - 1)
    back[total[1:] < least] = 0
    return ahead, back


def numbered_lines(docs: DataFrame, least: int) -> DataFrame:
    """A row per line with a word: doc_id, digest (of the text), place (among such lines), line (in the text), h1, h2, ahead, back, left.

    Lines equal in h1 and h2, 128 bits together, count as equal. left: lines from here to the document's end.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, line, place, h1, h2, ahead, back, left, digest = ([] for _ in range(9))
            for i, raw in enumerate(binary(batch.column("text"))):
                lines = (raw or b"").split(b"\n")
                words = [len(x.split()) for x in lines]
                at = [j for j, w in enumerate(words) if w]
                if not at or sum(words) < least:
                    continue
                f, b = _windows([words[j] for j in at], least)
                pairs = [xxhash.xxh3_128_intdigest(lines[j]) for j in at]
                n = len(at)
                of += [i] * n
                digest += [xxhash.xxh64_intdigest(raw, 42)] * n
                line += at
                place += range(n)
                left += range(n, 0, -1)
                h1 += [p >> 64 for p in pairs]
                h2 += [p & (2**64 - 1) for p in pairs]
                ahead += f.tolist()
                back += b.tolist()
            wide = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (digest, h1, h2)]
            ints = [pa.array(np.array(x, np.int32)) for x in (place, line, ahead, back, left)]
            ids = batch.column("doc_id").take(pa.array(np.array(of, np.int64)))
            yield pa.RecordBatch.from_arrays([ids, *wide, *ints], names)

    names = ["doc_id", "digest", "h1", "h2", "place", "line", "ahead", "back", "left"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, digest bigint, h1 bigint, h2 bigint, place int, line int, ahead int, back int, left int")


KEY = ("doc_id", "digest", "place")


def _sorted_groups(rows: DataFrame, by: tuple[str, ...], scratch: Scratch, name: str) -> DataFrame:
    """KEY, by, group, again and first of rows: groups ascend with the columns in by (integers, not null), equal ones share one.

    again: another row has the group; first: no row of the group comes before it in the order of KEY, and of rows with one
    KEY one only is first, so callers make KEYs distinct. Rows are sorted by range over the cluster,
    KEY behind by, so that a group of any size is spread over tasks. A task numbers its groups from its own number on. Only
    a group that crosses into the next task needs more: each task's first and last groups, a row a task, tell which go on.
    """
    names = [f"g{i}" for i in range(len(by))]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen, group, last, held = 0, 0, None, None  # held: the last row, until its next is known

        def out(part: pa.RecordBatch, again: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*part.columns, pa.array(again)], [*part.schema.names, "again"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in names]
            new = np.zeros(len(columns[0]), bool)
            new[0] = last is None or tuple(c[0] for c in columns) != last
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            starts = np.where(new, np.arange(seen, seen + len(new)), 0)
            starts[0] = starts[0] if new[0] else group
            starts = np.maximum.accumulate(starts)
            seen, group, last = seen + len(new), int(starts[-1]), tuple(c[-1] for c in columns)
            rank = (np.int64(task) << np.int64(40)) + starts
            ranked = pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank), pa.array(new)], [*batch.schema.names, "rank", "first"])
            if held is not None:
                yield out(held[0], np.array([held[1] or not new[0]]))
            yield out(ranked.slice(0, len(new) - 1), ~new[:-1] | ~new[1:])
            held = ranked.slice(len(new) - 1), not new[-1]
        if held is not None:
            yield out(held[0], np.array([held[1]]))

    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*KEY, *(F.col(c).cast("long").alias(g) for c, g in zip(by, names)))
    dealt = dealt.repartitionByRange(parts, *names, *KEY).sortWithinPartitions(*names, *KEY)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    ranked = scratch.keep(dealt.mapInArrow(number, f"{kinds}, rank bigint, first boolean, again boolean"), name)
    one = F.struct("rank", *names)
    ends = ranked.groupBy(F.shiftright("rank", 40).alias("task")).agg(F.min(one).alias("first"), F.max(one).alias("last"))
    ends = sorted(ends.collect(), key=lambda r: r["task"])  # two groups a task
    goes_on, of_last = {}, None
    for r in ends:
        if of_last is not None and tuple(r["first"])[1:] == of_last[1]:
            goes_on[r["first"]["rank"]] = of_last[0]
        whole = r["first"]["rank"] == r["last"]["rank"]
        of_last = (goes_on.get(r["last"]["rank"], r["last"]["rank"]) if whole else r["last"]["rank"], tuple(r["last"])[1:])
    if goes_on:
        crossing = spark.createDataFrame([(r, goes_on.get(r, r)) for r in {*goes_on, *goes_on.values()}], "r0 long, r1 long")
        ranked = ranked.join(F.broadcast(crossing), F.col("rank") == F.col("r0"), "left")  # two rows a task at most
        again, first = F.col("again") | F.col("r0").isNotNull(), F.col("first") & F.coalesce(F.col("r0") == F.col("r1"), F.lit(True))
        ranked = ranked.withColumns({"again": again, "first": first, "rank": F.coalesce("r1", "rank")})
    return ranked.select(*KEY, *(F.col(g).alias(c) for c, g in zip(by, names)), F.col("rank").alias("group"), "again", "first")


def _sorted_names(rows: DataFrame, pair: tuple[str, str], scratch: Scratch, name: str) -> DataFrame:
    """KEY and rank of the rows whose pair occurs again; ranks ascend with the pairs."""
    made = _sorted_groups(rows, pair, scratch, f"{name}_all").filter("again").select(*KEY, F.col("group").alias("rank"))
    made = scratch.keep(made, name)
    scratch.drop(f"{name}_all")
    return made


def _shifted(ranks: DataFrame, by: int) -> DataFrame:
    return ranks.select(*KEY[:2], (F.col("place") - by).alias("place"), F.col("rank").alias("next"))


def _meet(a: DataFrame, b: DataFrame, *columns: str) -> DataFrame:
    b = b.select(F.col("doc_id").alias("d0"), F.col("digest").alias("g0"), F.col("place").alias("p0"), *columns)
    return a.join(b, a["doc_id"].eqNullSafe(F.col("d0")) & (a["digest"] == F.col("g0")) & (a["place"] == F.col("p0"))).drop("d0", "g0", "p0")


def suffix_ranks(lines: DataFrame, scratch: Scratch, depth: int) -> list[DataFrame]:
    """Ranks by the first 1, 2, 4 ... lines, up to depth, of the places where such a run occurs again.

    Places whose run is cut short by the document's end have no rank at that length, nor have those settled before.
    """
    ranks = [_sorted_names(lines, ("h1", "h2"), scratch, "ranks0")]
    h = 1
    while 2 * h <= depth and not ranks[-1].isEmpty():
        pairs = _meet(ranks[-1], _shifted(ranks[-1], h), "next")
        ranks.append(_sorted_names(pairs, ("rank", "next"), scratch, f"ranks{len(ranks)}"))
        h *= 2
    return ranks


def distinct_places(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """lines with one row for each KEY: of documents listed more than once the lines of one listing.

    Only lines of such documents are grouped; copies are combined before the shuffle. Others pass as they are.
    """
    again = lines.filter("place = 0").groupBy("doc_id", "digest").count().filter("count > 1")
    again = scratch.keep(again.select(F.col("doc_id").alias("d0"), F.col("digest").alias("g0")), "again")
    if again.isEmpty():
        return lines
    marked = lines.join(again, lines["doc_id"].eqNullSafe(F.col("d0")) & (lines["digest"] == F.col("g0")), "left").withColumn("twice", F.col("g0").isNotNull())
    once = marked.filter(~F.col("twice")).select(lines.columns)
    return scratch.keep(once.unionByName(marked.filter("twice").select(lines.columns).dropDuplicates([*KEY])), "places")


def repeated_places(docs: DataFrame, scratch: Scratch, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, digest, begin, end (lines of the text, end not included) of later copies of repeated runs.

    The first copy is the one at the least doc_id (null first), then digest, then place.
    """
    lines = distinct_places(scratch.keep(numbered_lines(docs, least), "lines"), scratch)
    longest = lines.agg(F.greatest(F.max("ahead"), F.max("back"))).first()[0] or 0  # at most least, as every line has a word
    ranks = suffix_ranks(lines, scratch, longest)
    # The runs to look up, by their first place and length, where the first line occurs again at all.
    ahead = lines.filter("ahead > 0").select(*KEY, F.col("ahead").alias("size"))
    back = lines.filter("back > 0").select(*KEY[:2], (F.col("place") - F.col("back") + 1).alias("place"), F.col("back").alias("size"))
    runs = _meet(ahead.union(back).distinct(), ranks[0])
    runs = scratch.keep(runs, "runs")
    found = None
    for k, rank in enumerate(ranks):
        h = 2**k
        fit = runs.filter((F.col("size") >= h) & (F.col("size") < 2 * h))
        fit = _meet(fit, rank, "rank")
        if h > 1:  # the same table again, at the run's last h lines
            tail = fit.select(*KEY[:2], (F.col("place") + F.col("size") - h).alias("place"), F.col("place").alias("from"), "size", "rank")
            fit = _meet(tail, rank.withColumnRenamed("rank", "tail"), "tail").select(*KEY[:2], F.col("from").alias("place"), "size", "rank", "tail")
        else:
            fit = fit.withColumn("tail", F.lit(0).cast("long"))
        fit = fit.select(*KEY, "size", "rank", "tail")
        found = fit if found is None else found.union(fit)
    later = _sorted_groups(found, ("size", "rank", "tail"), scratch, "found").filter("not first")
    later = later.select(*KEY[:2], F.col("place").alias("lo"), (F.col("place") + F.col("size") - 1).alias("hi"))
    # Overlapping runs become one per document and stretch of places, then places become lines of the text.
    by_doc = Window.partitionBy(*KEY[:2]).orderBy("lo", "hi")
    reach = F.max("hi").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    marked = later.withColumn("new", (reach.isNull() | (F.col("lo") > reach + 1)).cast("int"))
    marked = marked.withColumn("stretch", F.sum("new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    merged = marked.groupBy(*KEY[:2], "stretch").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    merged = scratch.keep(merged.drop("stretch"), "merged")
    line = lines.select(*KEY, "line")
    begin = _meet(merged.withColumn("place", F.col("lo")), line, "line").withColumnRenamed("line", "begin")
    ends = _meet(begin.withColumn("place", F.col("hi")), line, "line")
    return ends.select(*KEY[:2], "begin", (F.col("line") + 1).alias("end"))


def cut_lines(docs: DataFrame, least: int = MIN_WORDS, scratch: Scratch | None = None) -> DataFrame:
    """docs with the column cuts added (array of begin, end; null if nothing repeats): lines that are later copies.

    Rows alike in doc_id and text are one document listed more than once: they are no copies of each other and share that
    document's cuts. Null texts have no lines.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    cuts = repeated_places(docs, scratch, least)
    cuts = cuts.groupBy(*KEY[:2]).agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("cuts"))
    cuts = scratch.keep(cuts, "cuts").select(F.col("doc_id").alias("d0"), F.col("digest").alias("g0"), "cuts")
    return docs.join(cuts.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(F.col("d0")) & (F.xxhash64(docs["text"]) == F.col("g0")), "left").drop("d0", "g0")


def remaining_text(text: str = "text", cuts: str = "cuts") -> Column:
    """The text without the lines in cuts."""
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda _, i: ~F.exists(F.col(cuts), lambda c: (i >= c["begin"]) & (i < c["end"])))
    return F.when(F.col(cuts).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """docs with later copies of repeated line runs deleted from text; n_chars, where there is one, follows it.

    Lines without words that lie between deleted lines go with them; all others stay.
    """
    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    made = cut_lines(rows, least).withColumn("text", remaining_text())
    out = made.select("row.*", F.col("text").alias("__text"))
    replaced = {"text": F.col("__text"), "n_chars": F.length("__text").cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    return out.select(*(replaced[c].alias(c) if c in replaced else F.col(f"`{c}`") for c in names))


def line_report(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines, n_cut (lines deleted), n_chars_left and kept_sha256 (of the text that is left) of every row of docs."""
    made = cut_lines(docs.select("doc_id", "text"), least).withColumn("left", remaining_text())
    cut = F.coalesce(F.aggregate("cuts", F.lit(0), lambda a, c: a + c["end"] - c["begin"]), F.lit(0))
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))
    left = F.coalesce("left", F.lit(""))
    return made.select("doc_id", lines.cast("long").alias("n_lines"), cut.cast("long").alias("n_cut"), F.length(left).cast("long").alias("n_chars_left"), F.sha2(left, 256).alias("kept_sha256"))
