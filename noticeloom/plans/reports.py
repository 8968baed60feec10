"""Relational reports over releases, the catalog and the configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.operators.flow import store_order

KEYS = ("year", "slug", "ticker")


def with_year(rows: DataFrame) -> DataFrame:
    """Rows whose publish_date is a date, with its year; the date column decides, never a path."""
    date = F.expr("try_cast(publish_date AS date)")
    return rows.withColumn("publish_date", date).filter(F.col("publish_date").isNotNull()).withColumn("year", F.year("publish_date").cast("long"))


def bad_dates(rows: DataFrame) -> DataFrame:
    return rows.filter(F.expr("try_cast(publish_date AS date)").isNull())


def release_counts(rows: DataFrame, keep_null: bool = False) -> DataFrame:
    """Releases by year, slug and ticker. Rows without a slug or ticker are left out, as in the stored baseline, unless kept."""
    made = with_year(rows)
    made = made if keep_null else made.na.drop(subset=["slug", "ticker"])
    return made.groupBy(*KEYS).agg(F.count("*").alias("release_count")).orderBy(*KEYS)


def merged_tallies(*counts: DataFrame) -> DataFrame:
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.groupBy(*KEYS).agg(F.sum("release_count").alias("release_count"))


def check_counts(baseline: DataFrame, store: DataFrame | None, found: DataFrame | None, years: list[int] | None = None, slugs: list[str] | None = None) -> DataFrame:
    """Mismatches with the baseline, for what a run covered: of the store after a wet run, of the items found (counts of keys) after a dry one."""
    actual = release_counts(store) if found is None else found
    return count_mismatches(restricted(baseline, years, slugs), restricted(actual, years, slugs))


def restricted(rows: DataFrame, years: list[int] | None = None, slugs: list[str] | None = None) -> DataFrame:
    if years is not None:
        rows = rows.filter(F.col("year").isin(*years))
    return rows if slugs is None else rows.filter(F.col("slug").isin(*slugs))


def mismatch_text(year: Column, slug: Column, ticker: Column, baseline: Column, actual: Column) -> Column:
    key = F.concat(year.cast("string"), F.lit(" "), slug, F.lit(" ("), F.coalesce(ticker, F.lit("")), F.lit("): "))
    b, a, diff = baseline.cast("string"), actual.cast("string"), actual - baseline
    signed = F.concat(F.when(diff > 0, "+").otherwise(""), diff.cast("string"))
    return F.concat(
        key,
        F.when(baseline.isNull(), F.concat(F.lit("not in baseline, found "), a))
        .when(actual.isNull(), F.concat(F.lit("baseline "), b, F.lit(", found none - scraper regression?")))
        .when(diff > 0, F.concat(F.lit("baseline "), b, F.lit(", found "), a, F.lit(" ("), signed, F.lit(") - new releases")))
        .otherwise(F.concat(F.lit("baseline "), b, F.lit(", found "), a, F.lit(" ("), signed, F.lit(") - scraper regression?"))),
    )


def count_mismatches(baseline: DataFrame, actual: DataFrame) -> DataFrame:
    """Keys whose counts differ or that one side lacks; null keys match each other."""
    b = baseline.select(*(F.col(k).alias(f"b_{k}") for k in KEYS), F.col("release_count").alias("baseline_count"))
    a = actual.select(*KEYS, F.col("release_count").alias("actual_count"))
    on = F.lit(True)
    for k in KEYS:
        on = on & F.col(k).eqNullSafe(F.col(f"b_{k}"))
    both = b.join(a, on, "full").filter(~F.col("baseline_count").eqNullSafe(F.col("actual_count")))
    there = F.col("actual_count").isNotNull()
    keyed = both.select(*(F.when(there, F.col(k)).otherwise(F.col(f"b_{k}")).alias(k) for k in KEYS), "baseline_count", "actual_count")
    diff = (F.col("actual_count") - F.col("baseline_count")).alias("diff")
    text = mismatch_text(*(F.col(c) for c in (*KEYS, "baseline_count", "actual_count"))).alias("description")
    return keyed.select("*", diff, text).orderBy(*KEYS)


def configured_groups(entries: DataFrame) -> DataFrame:
    """Slugs in more than one group, with the groups in order of appearance (ordinal)."""
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", "group")))
    made = entries.filter(F.col("slug").isNotNull()).groupBy("slug").agg(ordered.alias("g"))
    return made.filter(F.size("g") > 1).select("slug", F.array_join(F.transform("g", lambda x: x["group"]), ",").alias("groups"))


def coverage_missing(sources: DataFrame, configured: DataFrame, platforms: DataFrame) -> DataFrame:
    """Sources that no group has, with their platform."""
    left = sources.join(configured.select("slug").distinct(), "slug", "left_anti")
    return left.join(platforms.select("slug", "platform"), "slug", "left").withColumn("platform", F.coalesce("platform", F.lit("unknown")))


def covered(sources: DataFrame, configured: DataFrame) -> DataFrame:
    """Sources with whether any group has them (column covered)."""
    there = configured.select(F.col("slug").alias("_s")).distinct()
    return sources.join(there, F.col("slug") == F.col("_s"), "left").withColumn("covered", F.col("_s").isNotNull()).drop("_s")


def unknown_slugs(configured: DataFrame, sources: DataFrame) -> DataFrame:
    return configured.select("slug").distinct().join(sources, "slug", "left_anti").orderBy("slug")


def _percent(done: Column, total: Column) -> Column:
    return F.when(total > 0, F.bround(100.0 * done / total, 1)).otherwise(0.0)


def coverage_table(configured: DataFrame, missing: DataFrame) -> DataFrame:
    """platform, total, configured, missing, percentage_done; most missing first, platforms without a count last."""
    c = configured.groupBy("platform").agg(F.count("*").alias("configured"))
    m = missing.groupBy(F.col("platform").alias("_p")).agg(F.count("*").alias("missing"))
    both = c.join(m, F.col("platform") == F.col("_p"), "full")
    done = F.coalesce("configured", F.lit(0).cast("long"))
    made = both.select(F.coalesce("platform", "_p").alias("platform"), done.alias("configured"), "missing")
    total = F.col("configured") + F.coalesce("missing", F.lit(0).cast("long"))
    made = made.withColumn("total", total).withColumn("percentage_done", _percent(F.col("configured"), F.col("total")))
    return made.select("platform", "total", "configured", "missing", "percentage_done").orderBy(F.desc_nulls_last("missing"), "platform")


def with_total(table: DataFrame) -> DataFrame:
    sums = table.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("total", "configured", "missing")))
    row = sums.select(F.lit("TOTAL").alias("platform"), "total", "configured", "missing", _percent(F.col("configured"), F.col("total")).alias("percentage_done"))
    return table.unionByName(row)


def coverage_ratio(sources: DataFrame, configured: DataFrame) -> DataFrame:
    marked = sources.join(configured.select("slug").distinct().withColumn("_in", F.lit(1)), "slug", "left")
    made = marked.agg(F.count("*").alias("total"), F.count("_in").alias("covered"))
    return made.withColumn("percentage", F.when(F.col("total") > 0, 100.0 * F.col("covered") / F.col("total")).otherwise(0.0))


def rendered_coverage(table: DataFrame) -> DataFrame:
    """The table's lines as text of fixed width."""
    cells = [F.rpad("platform", 16, " "), *(F.lpad(F.coalesce(F.col(c).cast("string"), F.lit("-")), 10, " ") for c in ("total", "configured", "missing"))]
    return table.select("platform", F.concat(*cells, F.lpad(F.format_number("percentage_done", 1), 8, " "), F.lit("%")).alias("line"))


def missing_tickers(wanted: DataFrame, covered: DataFrame) -> DataFrame:
    return wanted.select("ticker").subtract(covered.select("ticker")).orderBy("ticker")


def ticker_overlap(wanted: DataFrame, covered: DataFrame) -> DataFrame:
    """One row: index_size, covered, missing."""
    w, c = wanted.select("ticker").distinct(), covered.select("ticker").distinct()
    both = w.join(c.withColumn("_in", F.lit(1)), "ticker", "left")
    return both.agg(F.count("*").alias("index_size"), F.count("_in").alias("covered"), F.count_if(F.col("_in").isNull()).alias("missing"))


def majority(values: DataFrame, by: str, value: str, ordinal: str) -> DataFrame:
    """The most frequent value of each key; of equally frequent ones the first seen."""
    counted = values.groupBy(by, value).agg(F.count("*").alias("n"), F.min(ordinal).alias("at"))
    return counted.groupBy(by).agg(F.max_by(value, F.struct(F.col("n"), -F.col("at"))).alias(value), F.max("n").alias("votes"))


def signature_groups(sources: DataFrame, *signature: str, key: str = "slug", ordinal: str = "ordinal") -> DataFrame:
    """Members of each signature in configuration order."""
    ordered = F.array_sort(F.collect_list(F.struct(ordinal, key)))
    made = sources.groupBy(*signature).agg(ordered.alias("m"))
    return made.select(*signature, F.size("m").cast("long").alias("n"), F.array_join(F.transform("m", lambda x: x[key].cast("string")), ",").alias("members"))


def preview(rows: DataFrame, category: str | None = None) -> DataFrame:
    """url, line and place of every row, its place in the store's order of its day; the time shows only if any row has one.

    category: a column whose value follows the title where there is one.
    """
    rows = store_lines(rows)
    timed = rows.agg(F.coalesce(F.max(F.col("publish_time") != ""), F.lit(False)).alias("timed"))
    joined = rows.crossJoin(F.broadcast(timed))  # one row
    time = F.when(F.col("timed"), F.concat(F.lit("  "), F.rpad("publish_time", 14, " "))).otherwise("")
    line = F.concat(F.coalesce(F.col("publish_date").cast("string"), F.lit("(no date)")), time, F.lit("  "), F.col("title"))
    if category:
        line = F.concat(line, F.when(F.coalesce(F.col(category), F.lit("")) != "", F.concat(F.lit(" ["), F.col(category), F.lit("]"))).otherwise(""))
    return joined.select("url", line.alias("line"), "place")


def digest(rows: DataFrame) -> DataFrame:
    """One row a release: the text that a message holds for it, and its place in the store's order of its day."""
    rows = store_lines(rows)
    time = F.when(F.coalesce(F.col("publish_time"), F.lit("")) != "", F.concat(F.lit(", "), F.col("publish_time"))).otherwise("")
    text = F.concat(F.coalesce("ticker", "slug"), F.lit(": "), F.col("title"), F.lit(" ("), F.col("publish_date").cast("string"), time, F.lit(")\n"), F.col("url"))
    return rows.select("url", text.alias("text"), "place")


def digest_title(rows: DataFrame) -> DataFrame:
    """One row: the day, the range of days, or that there is none."""
    d = F.col("publish_date")
    made = rows.agg(F.countDistinct(d).alias("days"), F.min(d).alias("first"), F.max(d).alias("last"), F.count("*").alias("releases"))
    label = F.when(F.col("days") == 0, "unknown date").when(F.col("days") == 1, F.col("first").cast("string")).otherwise(F.concat(F.col("first").cast("string"), F.lit(" to "), F.col("last").cast("string")))
    return made.select(label.alias("title"), "days", "releases")


def column_widths(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.agg(*(F.greatest(F.max(F.coalesce(F.length(F.col(c).cast("string")), F.lit(0))), F.lit(len(c))).cast("long").alias(c) for c in columns))


def _padded(cells: list[Column], widths: list[Column]) -> Column:
    return F.rtrim(F.concat_ws("  ", *(F.rpad(F.coalesce(cell.cast("string"), F.lit("")), width.cast("int"), F.lit(" ")) for cell, width in zip(cells, widths))))


def table_lines(rows: DataFrame, *columns: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row as a line padded to the widths that all rows and the header need, with header and rule, beside the columns in keep."""
    told = column_widths(rows, *columns).select(F.struct(*columns).alias("_w"))
    widths = [F.col(f"_w.{c}") for c in columns]
    header = _padded([F.lit(c) for c in columns], widths)
    rule = F.concat_ws("  ", *(F.repeat(F.lit("-"), w.cast("int")) for w in widths))
    made = rows.crossJoin(F.broadcast(told))  # one row
    return made.select(*keep, header.alias("header"), rule.alias("rule"), _padded([F.col(c) for c in columns], widths).alias("line"))


def text_table(rows: DataFrame, *columns: str) -> list[str]:
    """Header, rule and rows, in their order, padded to common widths. For reports of a bounded number of rows."""
    width = column_widths(rows, *columns).first().asDict()
    line = _padded([F.col(c) for c in columns], [F.lit(width[c]) for c in columns])
    head = "  ".join(c.ljust(width[c]) for c in columns)
    return [head.rstrip(), "  ".join("-" * width[c] for c in columns), *(r[0] for r in rows.select(line).collect())]


def record_lines(rows: DataFrame, *columns: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """A record's fields that are given, a line each, beside the columns in keep."""
    return rows.select(*keep, F.concat_ws("\n", *(F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in columns)).alias("text"))


def store_lines(rows: DataFrame) -> DataFrame:
    """Rows with their place in the store's order of their day."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("publish_date").orderBy(*store_order()[1:])).cast("long"))
