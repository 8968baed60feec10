"""Walks that read few pages: a binary search for the first page of interest, then the pages from there to the stop.

Pages lie in a table partitioned by spot, a number of a group of listings and a page number together. Each round joins the
listings' wanted pages to it; the wanted side is small and filtered, so Spark broadcasts it where its size allows and prunes
the table's partitions by it (dynamic partition pruning), and pages that no listing asks for are not opened. A listing of N
pages costs about log2(N) probes and the pages of its walk, not N. What is known of the listings lies in a table between
rounds; the number of rounds grows with log2 of the longest listing.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.operators import flow

#: keep(df, name): the same rows, read back from where the cluster keeps intermediate tables.
Keep = Callable[[DataFrame, str], DataFrame]


#: Bits of the page numbers whose pages have a spot each.
SINGLE = 7


def spot(slug: Column, page: Column, groups: int) -> Column:
    """The group of a listing and the first page of the page's block."""
    spare = F.greatest(F.length(F.bin(page)) - SINGLE, F.lit(0))
    block = F.call_function("shiftleft", F.call_function("shiftright", page.cast("bigint"), spare), spare)
    return F.concat(F.pmod(F.hash(slug), F.lit(groups)).cast("string"), F.lit("-"), block.cast("string"))


def write_pages(pages: DataFrame, root: str, groups: int = 256) -> None:
    """pages (slug, page, ...) by spot: for each group 2^SINGLE folders, and half as many for each doubling of the highest page number behind them."""
    made = pages.withColumn("spot", spot(F.col("slug"), F.col("page"), groups)).withColumn("groups", F.lit(groups))
    made.repartition("spot").sortWithinPartitions("spot", "slug", "page").write.mode("overwrite").partitionBy("spot").parquet(root)


def fetch(table: DataFrame, wanted: DataFrame, groups: int = 256) -> DataFrame:
    """The rows of table (by spot) for wanted (slug, page); wanted holds a comparison, as Spark prunes by filtered sides only."""
    asked = wanted.select("slug", F.col("page").alias("page"), spot(F.col("slug"), F.col("page"), groups).alias("spot")).filter("page >= 0")
    return table.join(asked, ["spot", "slug", "page"]).drop("spot", "groups")


def probed_start(table: DataFrame, listings: DataFrame, target_max: int, target_min: int, keep: Keep, groups: int = 256) -> DataFrame:
    """slug, n_pages, start_page and probes (pages opened) of listings (slug, n_pages), newest pages first.

    table: slug, page, min_year, max_year by spot. start_page is what flow.start_page gives from all pages: the first one
    with anything as old as target_max, else the last; one past the end where page 0 is older than target_min already.
    Years must not grow with the page number; a page without a dated item counts as newer than the target.
    """
    years = F.struct("min_year", "max_year")
    listings = keep(listings.select("slug", "n_pages"), "listings")  # a written table has a known size, by which Spark decides on broadcasts
    first = fetch(table, listings.filter("n_pages > 0").select("slug", F.lit(0).cast("long").alias("page")), groups).select("slug", years.alias("y"))
    state = listings.select("slug", "n_pages").join(first, "slug", "left")
    past, here = F.coalesce(F.col("y.max_year") < target_min, F.lit(False)), F.coalesce(F.col("y.min_year") <= target_max, F.lit(False))
    low = F.when(past, F.col("n_pages")).when(here, 0).otherwise(F.least(F.lit(1), F.col("n_pages") - 1))
    high = F.when(past, F.col("n_pages")).when(here, 0).otherwise(F.col("n_pages") - 1)
    state = keep(state.select("slug", "n_pages", low.cast("long").alias("low"), high.cast("long").alias("high"), F.lit(1).cast("long").alias("probes")), "probe0")
    longest = state.agg(F.max("n_pages")).first()[0] or 0
    for turn in range(1, math.ceil(math.log2(longest + 1)) + 1 if longest else 1):
        wanted = state.filter("low < high").select("slug", F.floor((F.col("low") + F.col("high")) / 2).cast("long").alias("page"))
        found = fetch(table, wanted, groups).select("slug", years.alias("y"))
        is_open, middle = F.col("low") < F.col("high"), F.floor((F.col("low") + F.col("high")) / 2).cast("long")
        old = F.coalesce(F.col("y.min_year") <= target_max, F.lit(False))
        moved = state.join(found, "slug", "left").select(
            "slug", "n_pages",
            F.when(is_open & ~old, middle + 1).otherwise(F.col("low")).alias("low"),
            F.when(is_open & old, middle).otherwise(F.col("high")).alias("high"),
            (F.col("probes") + is_open.cast("long")).alias("probes"),
        )
        state = keep(moved, f"probe{turn}")
        if not state.filter("low < high").limit(1).count():
            break
    return state.select("slug", "n_pages", F.col("low").alias("start_page"), "probes")


def probing_walk(facts: DataFrame, items: DataFrame, listings: DataFrame, years: set[int], keep: Keep, cap: int = flow.PAGE_CAP, groups: int = 256) -> tuple[DataFrame, DataFrame]:
    """flow.walk's items for the target years, and slug, start_page, probes and n_read (item pages opened) of each listing.

    facts (slug, page, min_year, max_year) and items (slug, page, ordinal, url, ...) are tables by spot. From the start
    page on, pages are read in blocks of 2, 4, 8 and so on until the walk's own rules stop it in what was read; so at most
    twice the pages of the walk and two more are opened. cap counts from page 0, as in flow.walked.
    """
    start = keep(probed_start(facts, listings, max(years), min(years), keep, groups), "start")
    ends = start.select("slug", F.least("n_pages", F.greatest(F.lit(cap), F.col("start_page") + 1)).alias("end"), F.col("start_page").alias("next"))
    still, read, block = keep(ends.filter("next < end"), "open0"), None, 2
    rounds = math.ceil(math.log2((start.agg(F.max(F.col("n_pages") - F.col("start_page"))).first()[0] or 0) + 2)) + 1
    for turn in range(rounds):
        pages = still.filter("next < end").select("slug", F.explode(F.sequence("next", F.least(F.col("next") + block - 1, F.col("end") - 1))).alias("page"))
        new = fetch(items, pages, groups)
        read = keep(new if read is None else read.unionByName(new), f"read{turn}")
        seen = flow.walked(flow.page_years(read, "slug", "page"), read, min(years), cap)
        # A listing goes on if the walk has not stopped within what was read: its last page is the last one read, and lets it pass.
        tail = seen.groupBy("slug").agg(F.max_by(F.struct("page", "n_new", "max_year"), "page").alias("t"))
        goes = (F.col("t.page") == F.col("next") + block - 1) & (F.col("t.n_new") > 0) & F.coalesce(F.col("t.max_year") >= min(years), F.lit(True))
        after = still.join(tail, "slug").filter(goes).select("slug", "end", (F.col("next") + block).alias("next")).filter("next < end")
        still, block = keep(after, f"open{turn + 1}"), block * 2
        if still.isEmpty():
            break
    opened = read.groupBy("slug").agg(F.countDistinct("page").alias("n_read"))
    told = start.join(opened, "slug", "left").select("slug", "start_page", "probes", F.coalesce("n_read", F.lit(0)).cast("long").alias("n_read"))
    kept = flow.walked(flow.page_years(read, "slug", "page"), read, min(years), cap).select("slug", "page")
    return flow.dedupe(read.join(kept, ["slug", "page"], "left_semi"), "ordinal", ("slug",)), told
