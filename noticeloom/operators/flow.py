"""From extracted items to a clean list: filter, order, limit, deduplicate, stop early, fill dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.functions import dates, urls

#: Pages after which a walk ends in any case, in general and by platform, and years that a walk goes back.
PAGE_CAP = 100
PAGE_CAPS = {"notified": 100, "investorroom": 50, "investis": 50, "aem_cme": 300}
YEAR_CAP = 60


def year_set(years: list[int] | None = None, start: int | None = None, end: int | None = None) -> set[int] | None:
    """Single years and a range, its ends in any order and one standing for both; None for all."""
    out = set(years or [])
    if start is not None or end is not None:
        a, b = start if start is not None else end, end if end is not None else start
        out |= set(range(min(a, b), max(a, b) + 1))
    return out or None


def cap_of(platform: Column) -> Column:
    """The number of pages after which a walk of this platform's listings ends."""
    out = F.lit(PAGE_CAP)
    for name, cap in PAGE_CAPS.items():
        out = F.when(platform == name, cap).otherwise(out)
    return out


def filter_items(items: DataFrame, years: set[int] | None = None, since: str | None = None, until: str | None = None, limit: int | None = None, tie: tuple[str, ...] = ()) -> DataFrame:
    """Items within all bounds, oldest first, undated ones before them; a limit keeps the oldest.

    Any bound drops undated items; without one they stay.
    """
    d = F.col("publish_date")
    keep = F.lit(True)
    if years is not None:
        keep = keep & dates.year_ranges(years, d)
    if since:
        keep = keep & (d >= F.lit(since).cast("date"))
    if until:
        keep = keep & (d <= F.lit(until).cast("date"))
    out = items.filter(keep).orderBy(F.coalesce(d, F.lit("0001-01-01").cast("date")), "title", *tie)
    return out.limit(limit) if limit is not None else out


def store_order() -> list[Column]:
    return [F.col("publish_date"), F.col("slug"), F.col("ticker"), dates.time_sort_key(F.col("publish_time")), F.col("title"), F.col("url")]


def dedupe(items: DataFrame, ordinal: str = "ordinal", by: tuple[str, ...] = ()) -> DataFrame:
    """The first item of each address (and of each of by); addresses that differ in last slashes are one."""
    first = Window.partitionBy(*by, urls.normal(F.col("url"))).orderBy(ordinal)
    return items.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def page_years(items: DataFrame, *by: str) -> DataFrame:
    return items.groupBy(*by).agg(F.min(F.year("publish_date")).cast("long").alias("min_year"), F.max(F.year("publish_date")).cast("long").alias("max_year"))


def start_page(pages: DataFrame, target_max: int, target_min: int, by: str = "slug") -> DataFrame:
    """Where a walk from newest to oldest begins: the first page with anything as old as the target's last year.

    A listing whose first page is already older than the target has nothing: one past its last page is told.
    """
    first = F.min(F.when(F.col("min_year") <= target_max, F.col("page")))
    last, newest = F.max("page"), F.max(F.when(F.col("page") == 0, F.col("max_year")))
    return pages.groupBy(by).agg(F.when(newest < target_min, last + 1).otherwise(F.coalesce(first, last)).cast("long").alias("start_page"))


def walked(pages: DataFrame, items: DataFrame, target_min: int | None = None, cap: int | Column = PAGE_CAP, by: str = "slug") -> DataFrame:
    """The pages (by, page, n_new, max_year) that a walk reads before it stops.

    It stops after a page without new addresses, after one that is wholly older than the target, or at the cap (a null cap
    never); the page that stops it is read.
    """
    first = items.groupBy(by, urls.normal(F.col("url")).alias("u")).agg(F.min("page").alias("first_page"))
    new = first.groupBy(by, F.col("first_page").alias("page")).agg(F.count("*").alias("n_new"))
    seen = pages.join(new, [by, "page"], "left").withColumn("n_new", F.coalesce("n_new", F.lit(0)).cast("long"))
    stop = (F.col("n_new") == 0) | F.coalesce(F.col("page") + 1 >= cap, F.lit(False))
    if target_min is not None:
        stop = stop | F.coalesce(F.col("max_year") < target_min, F.lit(False))
    before = Window.partitionBy(by).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    out = seen.withColumn("_stop", stop.cast("int"))
    return out.withColumn("_was", F.coalesce(F.max("_stop").over(before), F.lit(0))).filter("_was = 0").drop("_stop", "_was")


def walk(items: DataFrame, years: set[int] | None = None, cap: int = PAGE_CAP, by: str = "slug", ordinal: str = "ordinal") -> DataFrame:
    """The items (by, page, url, publish_date, ordinal) that a whole walk of each listing brings, each address once.

    With years it begins at the first page that can hold them and ends behind them; without, it reads all pages up to the
    cap or the first one without a new address. A walk brings whole pages: filter_items cuts them to the years.
    """
    pages = page_years(items, by, "page")
    if years:
        start = start_page(pages, max(years), min(years), by)
        pages = pages.join(start, by).filter(F.col("page") >= F.col("start_page")).drop("start_page")
        items = items.join(start, by).filter(F.col("page") >= F.col("start_page")).drop("start_page")
    read = walked(pages, items, min(years) if years else None, cap, by).select(by, "page")
    return dedupe(items.join(read, [by, "page"], "left_semi"), ordinal, (by,))


def largest_offered(sizes: Column, wanted: Column) -> Column:
    """The largest of the offered page sizes that is not above the wanted one; null without one."""
    return F.array_max(F.filter(sizes, lambda s: s <= wanted))


def history_years(years: DataFrame, by: str = "slug", cap: int = YEAR_CAP) -> DataFrame:
    """Of rows (by, year, n), those that a walk back from the newest year reads before the first empty one, cap years at most."""
    back = Window.partitionBy(by).orderBy(F.desc("year"))
    held = years.filter("n > 0").withColumn("_run", F.col("year") + F.row_number().over(back))  # one number for years without a gap
    return held.withColumn("_first", F.max("year").over(Window.partitionBy(by))).filter("_run = _first + 1").filter(F.col("year") > F.col("_first") - cap).drop("_run", "_first")


def fill_dates(items: DataFrame, details: DataFrame) -> DataFrame:
    """Undated items take the date of their detail page (url, detail_date); dated ones keep theirs."""
    side = details.select(F.col("url").alias("_u"), "detail_date")
    out = items.join(side, (F.col("url") == F.col("_u")) & F.col("publish_date").isNull(), "left").drop("_u")
    return out.withColumn("publish_date", F.coalesce("publish_date", "detail_date")).drop("detail_date")


def or_else(first: DataFrame, second: DataFrame, by: str = "slug") -> DataFrame:
    """The first source's rows, and the second's for keys where the first has none."""
    return first.unionByName(second.join(first.select(by).distinct(), by, "left_anti"))


def smoke_sample(sources: DataFrame, *signature: str, seed: int = 0, key: str = "slug") -> DataFrame:
    """One member of each signature: the one whose key and seed have the smallest md5. Members are combined before the shuffle."""
    pick = F.struct(F.md5(F.concat_ws(" ", key, F.lit(seed))), key)
    return sources.groupBy(*signature).agg(F.min_by(F.struct(*sources.columns), pick).alias("_r")).select("_r.*")
