"""Registered queries over the catalog's files and lookups, the store's plain layout, and reports as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.functions import urls
from noticeloom.plans import output, reports
from noticeloom.plans import views as v
from noticeloom.plans.queries import BASELINE, COUNTS, MISMATCH, MISSING, ORACLES, TABLE, _baseline, _missing, query
from noticeloom.plans.store_queries import MONTHLY, monthly
from noticeloom.sources import catalog, store

QUOTED = "CASE WHEN s_suppkey % 5 = 0 THEN 'https://news' || s_suppkey || '.example.com' ELSE '' END"


def _written(spark: SparkSession, lines: DataFrame) -> str:
    """lines (place, line) as one text file in a folder; for files of the catalog's size."""
    path = f"{store.scratch_path(spark)}/file"
    lines.orderBy("place").coalesce(1).select("line").write.text(path)
    return path


def _catalog(spark: SparkSession, sf: str) -> str:
    """The suppliers as a YAML catalog: a record a line, null and empty fields left out."""
    k = F.col("s_suppkey")
    record = F.struct(
        F.concat(F.lit("s"), k.cast("string")).alias("slug"), F.col("s_name").alias("name"), F.when(k % 9 > 0, F.concat(F.lit("T"), k.cast("string"))).alias("ticker"),
        F.concat(F.lit("https://ir"), k.cast("string"), F.lit(".example.com")).alias("ir_url"), F.when(k % 4 == 0, F.lit("news/{year}/default.aspx")).alias("news_path"),
        F.when(k % 3 == 0, (k % 2).cast("int")).alias("first_page_index"), F.when(k % 6 == 0, k % 4 == 0).alias("needs_detail_page_dates"),
    )
    return _written(spark, v.table(spark, sf, "supplier").select(k.alias("place"), F.concat(F.lit("- "), F.to_json(record)).alias("line")))


def _config(spark: SparkSession, sf: str) -> str:
    """The suppliers as a configuration: a group a line with its module and its sources' arguments; an entry without a slug in each."""
    k = F.col("s_suppkey")
    slug = F.when(k % 10 > 0, F.concat(F.lit("s"), k.cast("string")))
    entry = F.struct(slug.alias("slug"), F.array(F.lit("--b"), F.concat(F.lit("--a"), (k % 2).cast("string"))).alias("args"))
    group = F.element_at(F.array(*map(F.lit, ("q4_ir", "notified_gated", "investis"))), (k % 3 + 1).cast("int"))
    made = v.table(spark, sf, "supplier").groupBy(group.alias("group")).agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), entry.alias("e")))).alias("es"), F.min(k).alias("place"))
    body = F.struct(F.concat(F.lit("mod_"), F.col("group")).alias("scraper"), F.transform("es", lambda e: e["e"]).alias("sources"))
    return _written(spark, made.select("place", F.concat("group", F.lit(": "), F.to_json(body)).alias("line")))


@query("""SELECT CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS INT) AS ordinal, 's' || s_suppkey AS slug, s_name AS name, CASE WHEN s_suppkey % 9 > 0 THEN 'T' || s_suppkey ELSE '' END AS ticker,
  'https://ir' || s_suppkey || '.example.com' AS ir_url, '' AS news_url, CASE WHEN s_suppkey % 4 = 0 THEN 'news/{year}/default.aspx' ELSE '' END AS news_path, '' AS news_details_segment, '' AS news_releases_path FROM supplier""")
def catalog_described(spark, sf):
    """The catalog's YAML read with empty defaults."""
    return catalog.described(catalog.load_sources(spark, _catalog(spark, sf)))


@query("""SELECT 's' || s_suppkey AS slug, CASE WHEN s_suppkey % 9 > 0 THEN 'T' || s_suppkey END AS ticker, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey % 2 END AS first_page_index,
  CASE WHEN s_suppkey % 6 = 0 THEN s_suppkey % 4 = 0 END AS needs_detail_page_dates, 'order ' || o_orderkey AS asked FROM orders JOIN supplier ON s_suppkey = o_orderkey % (SELECT count(*) FROM supplier) + (SELECT min(s_suppkey) FROM supplier)""")
def catalog_required(spark, sf):
    """Every order asks for a record by slug in another spelling; a slug that is lacking would fail the job."""
    n = v.table(spark, sf, "supplier").agg(F.count("*").alias("n"), F.min("s_suppkey").alias("least"))
    slug = F.concat(F.lit(" S"), (F.col("o_orderkey") % F.col("n") + F.col("least")).cast("string"))
    asked = v.table(spark, sf, "orders").crossJoin(F.broadcast(n)).select(slug.alias("slug"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("asked"))  # one row
    made = catalog.with_required(asked, catalog.load_sources(spark, _catalog(spark, sf)), "ticker", "first_page_index", "needs_detail_page_dates")
    return made.withColumn("slug", F.lower(F.trim("slug"))).withColumn("first_page_index", F.col("first_page_index").cast("long"))


@query("""SELECT 's' || s_suppkey AS slug, ['q4_ir', 'notified_gated', 'investis'][s_suppkey % 3 + 1] AS strategy, ['q4', 'notified', 'investis'][s_suppkey % 3 + 1] AS platform,
  '{"module":"mod_' || ['q4_ir', 'notified_gated', 'investis'][s_suppkey % 3 + 1] || '","args":["--a' || s_suppkey % 2 || '","--b"]' || CASE WHEN s_suppkey % 6 = 0 THEN ',"needs_detail_page_dates":' || CASE WHEN s_suppkey % 4 = 0 THEN 'true' ELSE 'false' END ELSE '' END || '}' AS signature
  FROM supplier WHERE s_suppkey % 10 > 0""")
def config_signatures(spark, sf):
    """The configuration's YAML, flattened, with each source's platform and its signature with the catalog's durable facts."""
    config = catalog.load_config(spark, _config(spark, sf))
    signed = catalog.signatures(config, catalog.load_sources(spark, _catalog(spark, sf))).select("ordinal", "signature")
    return catalog.configured_platforms(config).join(signed, "ordinal").drop("ordinal")


@query("""SELECT slug, ticker, EXISTS (SELECT 1 FROM sources s WHERE s.slug = lower(trim(w.slug)) AND s.ticker <> coalesce(w.ticker, '')) AS taken
  FROM (SELECT ' S' || (ordinal + 20) AS slug, CASE WHEN ordinal % 3 > 0 THEN 'S.' || ((ordinal + 20) % CASE WHEN ordinal % 3 = 1 THEN 70 ELSE 71 END) END AS ticker FROM sources) w""", v.SOURCES)
def slug_conflicts(spark, sf):
    k = F.col("ordinal") + 20
    ticker = F.when(F.col("ordinal") % 3 > 0, F.concat(F.lit("S."), F.when(F.col("ordinal") % 3 == 1, k % 70).otherwise(k % 71).cast("string")))
    s = v.sources(spark, sf)
    return catalog.conflicts(s.select(F.concat(F.lit(" S"), k.cast("string")).alias("slug"), ticker.alias("ticker")), s)


def _days(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    rows, root = monthly(v.releases(spark, sf)), f"{store.scratch_path(spark)}/data"
    store.write_day_files(rows, root)
    return rows, root


@query("SELECT year(publish_date) || '/' || publish_date || '.csv' AS file, count(*) AS n, count(ticker) AS tickers, min(title) AS first FROM releases GROUP BY ALL", *MONTHLY)
def day_files(spark, sf):
    """The plain layout read back whole: which file each row is from."""
    _, root = _days(spark, sf)
    file = F.regexp_extract("source_file", r"([0-9]+/[^/]+)$", 1)
    return store.read_days(spark, root, "ticker", "title").groupBy(file.alias("file")).agg(F.count("*").alias("n"), F.count("ticker").alias("tickers"), F.min("title").alias("first"))


@query("SELECT slug, coalesce(ticker, '') AS ticker, title, url, CAST(publish_date AS VARCHAR) AS publish_date, publish_time FROM releases WHERE publish_date IN (DATE '1995-02-01', DATE '1997-08-01')", *MONTHLY)
def day_points(spark, sf):
    """Two days read by their names, and one that has no file."""
    _, root = _days(spark, sf)
    first, second, none = (store.read_day(spark, root, day) for day in ("1995-02-01", "1997-08-01", "1995-02-02"))
    return first.unionByName(second).unionByName(none)


@query("""SELECT slug, coalesce(ticker, '') AS ticker, title, url, CAST(publish_date AS VARCHAR) AS publish_date, publish_time FROM releases r WHERE NOT EXISTS (SELECT 1 FROM kept i WHERE i.publish_date = r.publish_date AND i.url = r.url)
  UNION ALL SELECT slug, coalesce(ticker, ''), title, url, CAST(publish_date AS VARCHAR), publish_time FROM kept""", *MONTHLY, "kept AS (SELECT * FROM incoming WHERE publish_date BETWEEN DATE '1996-03-01' AND DATE '1997-06-30')")
def run_tail(spark, sf):
    """The end of a run: a crawl filtered by years and days, its preview made, its rows merged into the day files."""
    rows, root = _days(spark, sf)
    output.finalize(v.changed(rows), root, years={1996, 1997}, since="1996-03-01", until="1997-06-30")
    return store.read_days(spark, root).drop("source_file").na.fill("")


@query("""SELECT 'Updated' AS action, slug, ticker, CASE WHEN url = (SELECT max(url) FROM day) THEN 'told anew' ELSE title END AS title, url FROM day
  UNION ALL SELECT 'Added', slug, ticker, title, url FROM day UNION ALL SELECT 'Added', slug, ticker, 'told anew', url || '-new' FROM day WHERE url = (SELECT max(url) FROM day)""", *MONTHLY, "day AS (SELECT * FROM releases WHERE publish_date = DATE '1996-03-01')")
def one_row_upsert(spark, sf):
    """One release told anew, and one that its day did not have."""
    day = monthly(v.releases(spark, sf)).filter(F.col("publish_date") == F.lit("1996-03-01").cast("date"))
    last = day.select(*store.COLUMNS).orderBy(F.desc("url")).limit(1).withColumn("title", F.lit("told anew"))
    out = None
    for row in (last, last.withColumn("url", F.concat("url", F.lit("-new")))):
        made, action = store.upsert_row(day, row)
        made = made.select(F.lit(action).alias("action"), "slug", "ticker", "title", "url")
        out = made if out is None else out.unionByName(made)
    return out


STORED = BASELINE.replace(f"{COUNTS} GROUP BY ALL", f"{COUNTS} WHERE ticker IS NOT NULL GROUP BY ALL")


@query()
def check_counts_store(spark, sf):
    """After a wet run: the counts of the day files against a stored baseline, for two years of four sources."""
    rows, root = _days(spark, sf)
    path = f"{store.scratch_path(spark)}/baseline.csv"
    _baseline(reports.release_counts(rows)).write.csv(path, header=True)
    return reports.check_counts(store.read_baseline(spark, path), store.read_days(spark, root), None, [1996, 1997], ["c1", "c5", "c8", "c13"])


ORACLES["check_counts_store"] = f"WITH {', '.join(MONTHLY)}, {STORED}{MISMATCH} WHERE year IN (1996, 1997) AND slug IN ('c1', 'c5', 'c8', 'c13')"


@query("""SELECT release_id, rtrim(rpad('slug', w1, ' ') || '  ' || rpad('title', w2, ' ') || '  ' || rpad('publish_time', w3, ' ')) AS header, repeat('-', w1) || '  ' || repeat('-', w2) || '  ' || repeat('-', w3) AS rule,
  rtrim(rpad(slug, w1, ' ') || '  ' || rpad(title, w2, ' ') || '  ' || rpad(publish_time, w3, ' ')) AS line
  FROM releases, (SELECT CAST(greatest(4, max(length(slug))) AS INT) AS w1, CAST(greatest(5, max(length(title))) AS INT) AS w2, CAST(greatest(12, max(length(publish_time))) AS INT) AS w3 FROM releases)""", v.RELEASES)
def table_lines(spark, sf):
    return reports.table_lines(v.releases(spark, sf), "slug", "title", "publish_time", keep=("release_id",))


def _coverage(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Paths of the coverage report's two files."""
    root, missing = store.scratch_path(spark), _missing(spark, sf)
    output.write_coverage(reports.coverage_table(v.configured(spark, sf), missing), missing.select("slug", "ticker", "platform"), f"{root}/summary.txt", f"{root}/missing.csv")
    return f"{root}/summary.txt", f"{root}/missing.csv"


@query("""SELECT rpad(platform, 16, ' ') || lpad(CAST(total AS VARCHAR), 10, ' ') || lpad(CAST(configured AS VARCHAR), 10, ' ') || lpad(coalesce(CAST(missing AS VARCHAR), '-'), 10, ' ') || lpad(printf('%.1f', percentage_done), 8, ' ') || '%' AS line
  FROM (SELECT * FROM t UNION ALL SELECT 'TOTAL', CAST(sum(total) AS BIGINT), CAST(sum(configured) AS BIGINT), CAST(sum(missing) AS BIGINT), round_even(100.0::DOUBLE * sum(configured) / sum(total), 1) FROM t)""", v.SOURCES, v.CONFIGURED, MISSING, TABLE)
def coverage_file(spark, sf):
    return spark.read.text(_coverage(spark, sf)[0]).withColumnRenamed("value", "line")


@query("SELECT slug, ticker, platform FROM missing", v.SOURCES, v.CONFIGURED, MISSING)
def missing_file(spark, sf):
    return catalog.read_text_table(spark, _coverage(spark, sf)[1])


@query("SELECT CAST(release_id AS VARCHAR) AS release_id, title, CAST(publish_date AS VARCHAR) AS publish_date FROM releases", v.RELEASES)
def checked_files(spark, sf):
    """Two CSV exports with their columns in different orders, both checked for the same header."""
    rows, root = v.releases(spark, sf), store.scratch_path(spark)
    rows.filter("release_id % 2 = 0").select("title", "release_id", "publish_date", "url").write.csv(f"{root}/even", header=True, escape='"')
    rows.filter("release_id % 2 = 1").select("publish_date", "title", "release_id").write.csv(f"{root}/odd", header=True, escape='"')
    return catalog.read_checked(spark, [f"{root}/even", f"{root}/odd"], ("release_id", "title", "publish_date"))


@query("SELECT slug, CASE WHEN ordinal % 5 = 0 THEN 'NA' WHEN ordinal % 7 = 0 THEN '' ELSE platform END AS platform FROM sources", v.SOURCES)
def detected_platforms(spark, sf):
    """A detection report as text: no value reads as a null, and a report that is not there has no rows."""
    root, k = store.scratch_path(spark), F.col("ordinal")
    platform = F.when(k % 5 == 0, "NA").when(k % 7 == 0, "").otherwise(F.col("platform"))
    v.sources(spark, sf).select("ticker", platform.alias("platform"), "slug").write.csv(f"{root}/report", header=True, escape='"')
    return catalog.platform_map(spark, f"{root}/report").unionByName(catalog.platform_map(spark, f"{root}/none"))


@query("""SELECT page_id, 'https://x.example.com/list?' || CASE k % 3 WHEN 0 THEN 'a=1&' WHEN 1 THEN CASE WHEN k % 2 = 0 THEN 'a=1&category=7%26&' ELSE 'category=7%26&' END ELSE '' END
  || 'w' || k % 5 || '_year%5Bvalue%5D=' || (2000 + k % 26) || '&w' || k % 5 || '_widget_id=w' || k % 5 || '&form_build_id=form-' || k || '&form_id=widget_form_base#widget-form-base' AS asked FROM (SELECT page_id, page_id AS k FROM pages)""")
def exposed_years(spark, sf):
    """The year widget's address: with extra parameters, own ones, both, both with one name, or none."""
    k = F.col("page_id")
    pair = F.array(F.struct(F.when(k % 2 == 1, "category").otherwise("a").alias("k"), F.lit("1").alias("v")))
    extra = F.when(k % 3 == 0, F.array(F.struct(F.lit("a").alias("k"), F.lit("1").alias("v")))).when(k % 3 == 1, pair).otherwise(F.filter(pair, lambda p: F.lit(False)))
    base = F.concat(F.lit("https://x.example.com/list"), F.when(k % 3 == 1, "?category=7%26#top").otherwise(""))
    w = F.concat(F.lit("w"), (k % 5).cast("string"))
    asked = urls.exposed_year(base, extra, w, 2000 + k % 26, F.concat(F.lit("form-"), k.cast("string")), "widget_form_base")
    return v.table(spark, sf, "pages").select("page_id", asked.alias("asked"))
