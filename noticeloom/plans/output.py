"""The end of a run: filter, preview, JSON and the store; reports as files."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.operators import flow
from noticeloom.plans import reports
from noticeloom.sources import store


@dataclass
class Output:
    """items: what the filter left; preview: their lines; summary: what the store took (a row), or None; files: day files written."""

    items: DataFrame
    preview: DataFrame
    summary: DataFrame | None = None
    files: int = 0


def stored(spark: SparkSession, root: str) -> DataFrame:
    """The store's rows as merge takes them, dates as dates, in the order of their files."""
    made = store.read_days(spark, root)
    made = made.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) if c != "publish_date" else F.expr("try_cast(publish_date AS date)").alias(c) for c in store.COLUMNS))
    return made.withColumn("ordinal", F.monotonically_increasing_id())


def finalize(items: DataFrame, root: str, *, years: set[int] | None = None, since: str | None = None, until: str | None = None, limit: int | None = None, form: str = "csv", json_path: str | None = None, dry_run: bool = False, write: bool = True, preview: Callable[[DataFrame], DataFrame] = reports.preview) -> Output:
    """Filter items, make their preview, write JSON and merge them into the store, as form (csv, json, both) asks.

    A dry run writes nothing but says what it would; write=False leaves only the store alone, so that a caller can merge
    many sources at once. JSON without a path is an error.
    """
    if form not in ("csv", "json", "both"):
        raise ValueError(f"no such form: {form}")
    if form != "csv" and json_path is None:
        raise ValueError("json needs a path")
    kept = flow.filter_items(items, years, since, until, limit)
    out = Output(kept, preview(kept))
    if form != "csv" and not dry_run:
        write_json(kept, json_path)
    if write and form != "json":
        old, new = stored(items.sparkSession, root), kept.withColumn("ticker", F.coalesce("ticker", F.lit("")))
        dated, _ = store.split_undated(new)
        out.summary = store.summary(new, store.classify(old, dated))
        if not dry_run:
            out.summary = items.sparkSession.createDataFrame(out.summary.collect(), out.summary.schema)  # one row, before the store changes
            out.files = store.write_day_files(store.merge(old, new), root)
    return out


#: Fixed value: the line that tells what a merge did, or on a dry run would do.
SUMMARY = "%s %d new + %d updated row(s) across %d daily CSV file(s)%s%s"


def summary_line(told: DataFrame, incoming: DataFrame, dry_run: bool = False, root: str | None = None) -> DataFrame:
    """line of store.summary's one row. A dry run tells the days that came in instead of those that change."""
    days = incoming.agg(F.count_distinct("publish_date").alias("days"))
    files = F.col("days") if dry_run else F.col("files_written")
    skipped = F.when(F.col("undated") > 0, F.format_string(" (%d undated item(s) skipped)", "undated")).otherwise("")
    place = F.lit("" if root is None else f" under {root}")
    line = F.format_string(SUMMARY, F.lit("Would write" if dry_run else "Wrote"), "rows_added", "rows_updated", files, place, skipped)
    return told.crossJoin(days).select(line.alias("line"))  # one row by one row


def dump_path(path: str, page: Column | None = None, year: Column | None = None) -> Column:
    """Where a page's HTML is dumped to: path for page 1, else with _page and the number before its ending, behind _ and the year where there is one."""
    folder, name = posixpath.split(path)
    stem, ending = posixpath.splitext(name)
    middle = [F.concat(F.lit("_"), year.cast("string"))] if year is not None else []
    middle += [F.when(page == 1, "").otherwise(F.concat(F.lit("_page"), page.cast("string")))] if page is not None else []
    return F.concat(F.lit(posixpath.join(folder, stem)), *(F.coalesce(m, F.lit("")) for m in middle), F.lit(ending))


def write_dumps(pages: DataFrame, root: str, name: str = "page.html") -> None:
    """pages (slug, year, page, html) as text, a folder for each dump, named by the slug and dump_path; null pages are left out."""
    dump = F.concat_ws("-", "slug", dump_path(name, F.col("page"), F.col("year")))
    made = pages.filter("html is not null").select(F.col("html").alias("value"), dump.alias("dump"))
    made.repartition("dump").write.mode("append").partitionBy("dump").text(root)


def write_json(items: DataFrame, path: str) -> None:
    """An array of the items' stored columns, in their order, as one file. For exports of a bounded number of items."""
    told = [json.loads(r["json"]) for r in store.as_json(items).toLocalIterator()]
    _write(items.sparkSession, path, json.dumps(told, indent=2, ensure_ascii=False))


def write_csv_report(table: DataFrame, path: str | None = None) -> str:
    """A report as CSV with a header, to a file where a path is given. For reports of a bounded number of rows."""
    text = table.toPandas().to_csv(index=False)
    if path is not None:
        _write(table.sparkSession, path, text)
    return text


def write_coverage(table: DataFrame, missing: DataFrame, summary_path: str, missing_path: str) -> None:
    """The two files of the coverage report, both from one reading of the table."""
    lines = [r["line"] for r in reports.rendered_coverage(reports.with_total(table)).collect()]
    _write(table.sparkSession, summary_path, "\n".join(lines) + "\n")
    write_csv_report(missing.orderBy("slug"), missing_path)


def _write(spark: SparkSession, path: str, text: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    with_parents = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        with_parents.write(bytearray(text.encode()))
    finally:
        with_parents.close()
