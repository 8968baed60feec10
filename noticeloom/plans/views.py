"""Views over the driver's tables in the shapes that the operators take, each with the same view in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as releases: some tickers null, some addresses with a last slash, dates in eight shapes of text, times with and without zone."""
    k, c = F.col("o_orderkey"), F.col("o_custkey") % 50
    d = F.col("o_orderdate").cast("date")
    hour, minute, half = k % 12 + 1, F.lpad((k % 60).cast("string"), 2, "0"), F.when(k % 2 == 0, " AM").otherwise(" PM")
    clock = F.concat(hour.cast("string"), F.lit(":"), minute, half)
    time = F.when(k % 3 == 0, "").when(k % 11 == 0, clock).otherwise(F.concat(clock, F.lit(" EDT")))
    shapes = ["MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM, yyyy", "M/d/yyyy", "yyyy-MM-dd", "MMM'.' dd, yyyy", "'NEW YORK,' MMMM dd, yyyy '(WIRE)'"]
    text = None
    for i, shape in enumerate(shapes):
        made = F.date_format(d, shape)
        text = F.when(k % 8 == i, made) if text is None else text.when(k % 8 == i, made)
    return table(spark, sf_dir, "orders").select(
        k.alias("release_id"), F.concat(F.lit("c"), c.cast("string")).alias("slug"),
        F.when(c != 0, F.concat(F.lit("T"), c.cast("string"))).alias("ticker"),
        F.concat("o_orderpriority", F.lit(" order "), k.cast("string")).alias("title"),
        F.concat(F.lit("https://ir.example.com/news/"), k.cast("string"), F.when(k % 7 == 0, "/").otherwise("")).alias("url"),
        d.alias("publish_date"), time.alias("publish_time"), text.alias("date_text"),
    )


RELEASES = """releases AS (SELECT o_orderkey AS release_id, 'c' || (o_custkey % 50) AS slug,
  CASE WHEN o_custkey % 50 <> 0 THEN 'T' || (o_custkey % 50) END AS ticker, o_orderpriority || ' order ' || o_orderkey AS title,
  'https://ir.example.com/news/' || o_orderkey || CASE WHEN o_orderkey % 7 = 0 THEN '/' ELSE '' END AS url,
  CAST(o_orderdate AS DATE) AS publish_date,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE (o_orderkey % 12 + 1) || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')
    || CASE WHEN o_orderkey % 2 = 0 THEN ' AM' ELSE ' PM' END || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE ' EDT' END END AS publish_time
  FROM orders)"""


def changed(rows: DataFrame) -> DataFrame:
    """releases as a second day's crawl brings them: a third is gone, a fifth has another title, a few are new."""
    k = F.col("release_id")
    old = rows.filter(k % 3 != 1).withColumn("title", F.when(k % 5 == 0, F.concat("title", F.lit(" (updated)"))).otherwise(F.col("title")))
    new = rows.filter(k % 10 == 0).withColumn("url", F.concat("url", F.lit("-new")))
    return old.unionByName(new)


CHANGED = """incoming AS (SELECT release_id, slug, ticker, CASE WHEN release_id % 5 = 0 THEN title || ' (updated)' ELSE title END AS title, url, publish_date, publish_time
  FROM releases WHERE release_id % 3 <> 1
  UNION ALL SELECT release_id, slug, ticker, title, url || '-new', publish_date, publish_time FROM releases WHERE release_id % 10 = 0)"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, place and href of every anchor in pages."""
    found = F.regexp_extract_all("html", F.lit('<a[^>]+href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(found).alias("place", "href")).withColumn("place", F.col("place").cast("long"))


LINKS = """links AS (SELECT page_id, url, unnest(range(len(h))) AS place, unnest(h) AS href
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a[^>]+href="([^"]*)"', 1) AS h FROM pages))"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as listings: slug, page, url, publish_date (newest first over pages of fifty)."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("s"), (e % 20).cast("string")).alias("slug"), F.floor(e / 1000).cast("long").alias("page"),
        F.concat(F.lit("https://x.example.com/"), (F.floor(e / 40) + F.when(e % 3 == 0, 0).otherwise(e % 7)).cast("string")).alias("url"),
        F.make_date(F.lit(2026) - F.floor(e / 2500).cast("int") - (e % 20 % 3).cast("int"), F.lit(6), F.lit(1)).alias("publish_date"),
        e.alias("ordinal"),
    )


LISTING = """listing AS (SELECT 's' || (event_id % 20) AS slug, event_id // 1000 AS page,
  'https://x.example.com/' || (event_id // 40 + CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 7 END) AS url,
  make_date(2026 - event_id // 2500 - event_id % 20 % 3, 6, 1) AS publish_date, event_id AS ordinal FROM events)"""


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """suppliers as catalog; configured and detected follow from it by number."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), k.cast("string")).alias("slug"), F.concat(F.lit("S."), (k % 70).cast("string")).alias("ticker"), k.alias("ordinal"),
        F.concat(F.lit("https://www.h"), (k % 40).cast("string"), F.lit(".example.com/ir/")).alias("ir_url"),
        F.when(k % 5 == 0, F.concat(F.lit("https://news"), k.cast("string"), F.lit(".example.com"))).otherwise("").alias("news_url"),
        F.element_at(F.array(*map(F.lit, ("q4", "notified", "investorroom", "investis", "aem", "unknown"))), (k % 6 + 1).cast("int")).alias("platform"),
    )


SOURCES = """sources AS (SELECT 's' || s_suppkey AS slug, 'S.' || (s_suppkey % 70) AS ticker, s_suppkey AS ordinal,
  'https://www.h' || (s_suppkey % 40) || '.example.com/ir/' AS ir_url,
  CASE WHEN s_suppkey % 5 = 0 THEN 'https://news' || s_suppkey || '.example.com' ELSE '' END AS news_url,
  ['q4', 'notified', 'investorroom', 'investis', 'aem', 'unknown'][s_suppkey % 6 + 1] AS platform FROM supplier)"""


def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sources(spark, sf_dir)
    one = s.filter("ordinal % 4 = 0").select("slug", F.col("platform").alias("group"), "ordinal", "platform")
    two = s.filter("ordinal % 12 = 0").select("slug", F.lit("extra").alias("group"), (F.col("ordinal") + 100000).alias("ordinal"), "platform")
    return one.unionByName(two)


CONFIGURED = """configured AS (SELECT slug, platform AS "group", ordinal, platform FROM sources WHERE ordinal % 4 = 0
  UNION ALL SELECT slug, 'extra', ordinal + 100000, platform FROM sources WHERE ordinal % 12 = 0)"""
