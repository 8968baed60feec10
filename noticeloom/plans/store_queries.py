"""Registered queries over the store as a data source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.plans import output
from noticeloom.plans import views as v
from noticeloom.plans.queries import CHANGES, _crawl, query
from noticeloom.sources import store
from noticeloom.sources.daystore import DayStore


def monthly(rows: DataFrame) -> DataFrame:
    """Releases dated to the first of their month: fewer, larger days."""
    return rows.withColumn("publish_date", F.trunc("publish_date", "month"))


MONTHLY = (v.RELEASES.replace("CAST(o_orderdate AS DATE) AS publish_date", "CAST(date_trunc('month', o_orderdate) AS DATE) AS publish_date"), v.CHANGED)
MERGED = """SELECT slug, ticker, title, url, publish_date, publish_time FROM releases r WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.publish_date = r.publish_date AND i.url = r.url)
  UNION ALL SELECT slug, ticker, title, url, publish_date, publish_time FROM incoming"""


def _stored(spark: SparkSession, *crawls: DataFrame) -> DayStore:
    made = DayStore(spark, f"{store.scratch_path(spark)}/days")
    for rows in crawls:
        made.upsert(rows)
    return made


def _plain(rows: DataFrame) -> DataFrame:
    """As the releases are: a file holds an empty ticker for none."""
    return rows.select("slug", F.when(F.col("ticker") != "", F.col("ticker")).alias("ticker"), "title", "url", F.col("day").alias("publish_date"), "publish_time")


@query(MERGED, *MONTHLY)
def store_commits(spark, sf):
    """Two days' crawls, each committed whole, and the second again, which changes nothing."""
    first = monthly(v.releases(spark, sf))
    return _plain(_stored(spark, first, v.changed(first), v.changed(first)).read())


@query("SELECT slug, ticker, title, url, publish_date, publish_time FROM releases WHERE publish_date IN (DATE '1996-03-01', DATE '1998-07-01') OR (publish_date >= DATE '2000-06-15' AND publish_date < DATE '2001-01-01')", *MONTHLY)
def store_days(spark, sf):
    """Two days and half a year of the store: only their files are opened."""
    made = _stored(spark, monthly(v.releases(spark, sf)))
    two = made.read().filter(F.col("day").isin(*(F.lit(d).cast("date") for d in ("1996-03-01", "1998-07-01"))))
    half = made.read().filter((F.col("day") >= F.lit("2000-06-15").cast("date")) & (F.col("day") < F.lit("2001-01-01").cast("date")))
    return _plain(two.unionByName(half))


@query(f"""SELECT CAST(publish_date AS VARCHAR) AS day, count(*) AS n, count(*) FILTER (title LIKE '%(updated)') AS updated FROM ({MERGED}) GROUP BY ALL""", *MONTHLY)
def store_versions(spark, sf):
    """The first version is still read whole after the second is there; the second's counts are returned where the first has the day too."""
    first = monthly(v.releases(spark, sf))
    made = _stored(spark, first, v.changed(first))
    was = made.read(version=1).groupBy("day").count().select("day")
    now = made.read().groupBy("day").agg(F.count("*").alias("n"), F.count_if(F.col("title").endswith("(updated)")).alias("updated"))
    return now.join(was, "day").select(F.col("day").cast("string").alias("day"), "n", "updated")


@query(f"SELECT CAST(year(publish_date) AS BIGINT) AS year, slug, coalesce(ticker, '') AS ticker, count(*) AS release_count FROM ({MERGED}) GROUP BY ALL", *MONTHLY)
def store_counts(spark, sf):
    """Counts after each of three crawls, each time from the days that changed."""
    first = monthly(v.releases(spark, sf))
    made = DayStore(spark, f"{store.scratch_path(spark)}/days")
    for rows in (first.filter("release_id % 2 = 0"), first, v.changed(first)):
        made.upsert(rows)
        counts = made.counts()
    return counts


@query(f"""SELECT 'Wrote ' || a || ' new + ' || u || ' updated row(s) across ' || f || ' daily CSV file(s) under data (' || n || ' undated item(s) skipped)' AS line FROM (SELECT count(DISTINCT CASE WHEN change <> 'same' THEN publish_date END) AS f, count(*) FILTER (change = 'added') AS a, count(*) FILTER (change = 'updated') AS u, (SELECT count(*) FROM releases WHERE release_id % 6 = 0) AS n FROM changes)
  UNION ALL SELECT 'Would write ' || a || ' new + ' || u || ' updated row(s) across ' || d || ' daily CSV file(s)' FROM (SELECT count(*) FILTER (change = 'added') AS a, count(*) FILTER (change = 'updated') AS u, (SELECT count(DISTINCT publish_date) FROM incoming) AS d FROM changes)""", v.RELEASES, CHANGES)
def merge_lines(spark, sf):
    """A merge's line with undated items, and a dry run's without."""
    old, new = _crawl(spark, sf)
    told = store.summary(new, store.classify(old, new))
    undated = v.releases(spark, sf).filter("release_id % 6 = 0").withColumn("publish_date", F.lit(None).cast("date"))
    wet = output.summary_line(told.drop("undated").crossJoin(undated.agg(F.count("*").alias("undated"))), new, root="data")
    return wet.unionByName(output.summary_line(told, new, dry_run=True))


@query("SELECT page_id, 'out/list' || CASE WHEN page_id % 4 = 0 THEN '' ELSE '_page' || (page_id % 4 + 1) END || '.html' AS by_page, 'list_' || (2000 + page_id % 26) || CASE WHEN page_id % 4 = 0 THEN '' ELSE '_page' || (page_id % 4 + 1) END || '.html' AS by_year FROM pages")
def dump_paths(spark, sf):
    k = F.col("page_id")
    return v.table(spark, sf, "pages").select("page_id", output.dump_path("out/list.html", k % 4 + 1).alias("by_page"), output.dump_path("list.html", k % 4 + 1, 2000 + k % 26).alias("by_year"))
