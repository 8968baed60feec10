"""Registered queries: each an operator over the driver's tables, with the same result in DuckDB's SQL where SQL has it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.functions import dates, urls
from noticeloom.operators import extract, flow
from noticeloom.plans import classify, reports
from noticeloom.plans import views as v
from noticeloom.sources import catalog, store
from noticeloom.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, *ctes: str):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = (f"WITH {', '.join(ctes)} " if ctes else "") + oracle
        return f

    return register


COUNTS = "SELECT CAST(year(publish_date) AS BIGINT) AS year, slug, ticker, count(*) AS release_count FROM releases"


@query(f"{COUNTS} WHERE ticker IS NOT NULL GROUP BY ALL ORDER BY 1, 2, 3", v.RELEASES)
def release_counts(spark, sf):
    return reports.release_counts(v.releases(spark, sf))


@query(f"{COUNTS} GROUP BY ALL", v.RELEASES)
def release_counts_keep_null(spark, sf):
    return reports.release_counts(v.releases(spark, sf), keep_null=True)


@query(f"{COUNTS} WHERE ticker IS NOT NULL GROUP BY ALL", v.RELEASES)
def tally_union(spark, sf):
    r = v.releases(spark, sf)
    return reports.merged_tallies(*(reports.release_counts(r.filter(F.col("release_id") % 2 == i)) for i in (0, 1)))


def _baseline(counts: DataFrame) -> DataFrame:
    n = F.substring("slug", F.lit(2), F.lit(9)).cast("int")
    return counts.filter(n % 9 != 1).withColumn("release_count", F.col("release_count") + F.when(n % 4 == 0, 1).when(n % 4 == 1, -1).otherwise(0)).withColumn("ticker", F.when(n % 10 == 3, F.concat("ticker", F.lit("X"))).otherwise(F.col("ticker")))


BASELINE = f"""actual AS ({COUNTS} GROUP BY ALL),
baseline AS (SELECT year, slug, CASE WHEN n % 10 = 3 THEN ticker || 'X' ELSE ticker END AS ticker, release_count + CASE n % 4 WHEN 0 THEN 1 WHEN 1 THEN -1 ELSE 0 END AS release_count
  FROM (SELECT *, CAST(substr(slug, 2) AS INT) AS n FROM actual) WHERE n % 9 <> 1)"""
MISMATCH = """, m AS (SELECT coalesce(b.year, a.year) AS year, coalesce(b.slug, a.slug) AS slug, coalesce(b.ticker, a.ticker) AS ticker, b.release_count AS baseline_count, a.release_count AS actual_count
  FROM baseline b FULL JOIN actual a ON b.year IS NOT DISTINCT FROM a.year AND b.slug IS NOT DISTINCT FROM a.slug AND b.ticker IS NOT DISTINCT FROM a.ticker
  WHERE b.release_count IS DISTINCT FROM a.release_count)
SELECT *, actual_count - baseline_count AS diff, year || ' ' || slug || ' (' || coalesce(ticker, '') || '): ' || CASE
  WHEN baseline_count IS NULL THEN 'not in baseline, found ' || actual_count WHEN actual_count IS NULL THEN 'baseline ' || baseline_count || ', found none - scraper regression?'
  WHEN actual_count > baseline_count THEN 'baseline ' || baseline_count || ', found ' || actual_count || ' (+' || (actual_count - baseline_count) || ') - new releases'
  ELSE 'baseline ' || baseline_count || ', found ' || actual_count || ' (' || (actual_count - baseline_count) || ') - scraper regression?' END AS description FROM m"""


@query()
def count_mismatch(spark, sf):
    actual = reports.release_counts(v.releases(spark, sf), keep_null=True)
    return reports.count_mismatches(_baseline(actual), actual)


ORACLES["count_mismatch"] = f"WITH {v.RELEASES}, {BASELINE}{MISMATCH}"


@query("SELECT CAST(year(publish_date) AS BIGINT) AS year, slug, ticker, count(*) AS release_count FROM releases WHERE ticker IS NOT NULL AND year(publish_date) IN (1996, 1997) AND slug IN ('c1', 'c7') GROUP BY ALL", v.RELEASES)
def restrict_keys(spark, sf):
    return reports.restricted(reports.release_counts(v.releases(spark, sf)), [1996, 1997], ["c1", "c7"])


@query("SELECT release_id, title, publish_date FROM releases WHERE year(publish_date) IN (1996, 1997) AND publish_date >= DATE '1996-03-01' AND publish_date <= DATE '1997-10-31' ORDER BY publish_date, title, release_id LIMIT 500", v.RELEASES)
def filter_items_range(spark, sf):
    years = flow.year_set(start=1997, end=1996)
    return flow.filter_items(v.releases(spark, sf), years, "1996-03-01", "1997-10-31", 500, ("release_id",)).select("release_id", "title", "publish_date")


@query("SELECT release_id, CAST(year(publish_date) AS BIGINT) AS year FROM releases WHERE year(publish_date) = 1995 OR year(publish_date) BETWEEN 1998 AND 2000", v.RELEASES)
def year_set(spark, sf):
    """Single years and a range whose ends are told in the wrong order, as a filter of all releases."""
    made = flow.filter_items(v.releases(spark, sf), years=flow.year_set([1995], start=2000, end=1998))
    return made.select("release_id", F.year("publish_date").cast("long").alias("year"))


RAW = """CASE release_id % 8 WHEN 0 THEN strftime(publish_date, '%b %-d, %Y') WHEN 1 THEN strftime(publish_date, '%B %-d, %Y') WHEN 2 THEN strftime(publish_date, '%-d %b %Y')
  WHEN 3 THEN strftime(publish_date, '%-d %B, %Y') WHEN 4 THEN strftime(publish_date, '%-m/%-d/%Y') WHEN 5 THEN strftime(publish_date, '%Y-%m-%d') WHEN 6 THEN strftime(publish_date, '%b. %d, %Y') ELSE strftime(publish_date, '%B %d, %Y') END"""


@query(f"SELECT release_id, publish_date AS date, {RAW} AS raw FROM releases", v.RELEASES)
def parse_date(spark, sf):
    return v.releases(spark, sf).select("release_id", dates.parse_date(F.col("date_text")).alias("p")).select("release_id", "p.date", "p.raw")


@query("SELECT release_id, publish_date AS date, strftime(publish_date, '%B %-d, %Y') AS raw FROM releases", v.RELEASES)
def parse_trailing_date(spark, sf):
    text = F.concat(F.lit("Results on January 27, 2026, "), F.date_format("publish_date", "MMMM d, yyyy"))
    return v.releases(spark, sf).select("release_id", dates.parse_trailing_date(text).alias("p")).select("release_id", "p.date", "p.raw")


@query("""SELECT release_id, CASE WHEN release_id % 13 > 0 AND release_id % 32 > 0 THEN try_strptime('20' || lpad(CAST(release_id % 100 AS VARCHAR), 2, '0') || '-' || (release_id % 13) || '-' || (release_id % 32), '%Y-%m-%d')::DATE END AS date
  FROM releases""", v.RELEASES)
def parse_short_date(spark, sf):
    k = F.col("release_id")
    text = F.concat((k % 13).cast("string"), F.lit("/"), (k % 32).cast("string"), F.lit("/"), F.lpad((k % 100).cast("string"), 2, "0"), F.lit(" - 3:35 PM EST"))
    return v.releases(spark, sf).select("release_id", dates.parse_short_date(text)["date"].alias("date"))


@query("""SELECT release_id, CASE WHEN publish_time LIKE '%EDT' THEN publish_time ELSE '' END AS time, CASE WHEN publish_time LIKE '%EDT' THEN 0 ELSE 1 END AS missing,
  CASE WHEN publish_time LIKE '%EDT' THEN CAST((release_id % 12 + 1) % 12 + CASE WHEN release_id % 2 = 1 THEN 12 ELSE 0 END AS INT) ELSE 0 END AS hour,
  CASE WHEN publish_time LIKE '%EDT' THEN CAST(release_id % 60 AS INT) ELSE 0 END AS minute FROM releases""", v.RELEASES)
def parse_time(spark, sf):
    made = v.releases(spark, sf).select("release_id", dates.parse_time(F.concat("date_text", F.lit(" "), "publish_time")).alias("time"))
    return made.select("*", dates.time_sort_key(F.col("time")).alias("k")).select("release_id", "time", "k.missing", "k.hour", "k.minute")


PLACE = """row_number() OVER (PARTITION BY publish_date ORDER BY slug, ticker NULLS FIRST, CASE WHEN publish_time LIKE '%EDT' THEN 0 ELSE 1 END,
  CASE WHEN publish_time LIKE '%EDT' THEN (release_id % 12 + 1) % 12 + release_id % 2 * 12 ELSE 0 END, CASE WHEN publish_time LIKE '%EDT' THEN release_id % 60 ELSE 0 END, title, url) AS place"""


@query(f"SELECT release_id, slug, publish_date, {PLACE} FROM releases", v.RELEASES)
def store_order(spark, sf):
    return reports.store_lines(v.releases(spark, sf)).select("release_id", "slug", "publish_date", "place")


@query("SELECT release_id, release_id % 4 <> 0 AS bare FROM releases", v.RELEASES)
def bare_date(spark, sf):
    k, raw = F.col("release_id"), F.date_format("publish_date", "MMMM d, yyyy")
    text = F.when(k % 4 == 0, F.concat(F.lit("Results on "), raw)).when(k % 4 == 1, F.concat(F.lit(" | "), raw, F.lit(" – "))).when(k % 4 == 2, F.concat(raw, F.lit("."))).otherwise(raw)
    return v.releases(spark, sf).select("release_id", dates.is_bare(text, raw).alias("bare"))


CARD = "CASE WHEN release_id % 5 = 0 THEN NULL ELSE publish_date END"
URL_DATE = "CASE WHEN release_id % 3 = 0 THEN NULL WHEN release_id % 4 = 0 THEN publish_date + 1 ELSE publish_date END"


@query(f"""SELECT release_id, coalesce(card, url_date) AS date, CASE WHEN card IS NOT NULL THEN 'card' WHEN url_date IS NOT NULL THEN CAST(url_date AS VARCHAR) ELSE '' END AS raw,
  card IS NOT NULL AND url_date IS NOT NULL AND card <> url_date AS conflict, CASE WHEN card IS NOT NULL THEN publish_time ELSE '' END AS time FROM (SELECT *, {CARD} AS card, {URL_DATE} AS url_date FROM releases)""", v.RELEASES)
def resolve_publish_date(spark, sf):
    k, d = F.col("release_id"), F.col("publish_date")
    card = F.when(k % 5 != 0, d)
    shown = F.date_format(F.when(k % 4 == 0, F.date_add(d, 1)).otherwise(d), "yyyy/M/dd")
    address = F.when(k % 3 == 0, "https://x.example.com/about").otherwise(F.concat(F.lit("https://x.example.com/"), shown, F.lit("/story")))
    made = v.releases(spark, sf).withColumn("card", card).withColumn("r", dates.resolve_publish_date(card, F.lit("card"), dates.date_from_url(address, "aem_bny")))
    return made.select("release_id", "r.date", "r.raw", "r.conflict", dates.time_of_card(F.col("r.date"), F.col("card"), F.col("publish_time")).alias("time"))


#: New York midnights: standard time on both days, five hours behind.
@query("""SELECT release_id, (epoch_ms(CAST(make_date(CAST(year(publish_date) AS BIGINT), 1, 1) AS TIMESTAMP)) + 18000000) AS begin_ms, (epoch_ms(CAST(make_date(CAST(year(publish_date) AS BIGINT), 12, 31) AS TIMESTAMP)) + 18000000) AS end_ms FROM releases""", v.RELEASES)
def epoch_range(spark, sf):
    made = v.releases(spark, sf).select("release_id", dates.year_epoch_range(F.year("publish_date")).alias("r"))
    return made.select("release_id", "r.begin_ms", "r.end_ms")


@query("""SELECT page_id, rtrim(url, '/') || '/news' AS joined, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root, regexp_replace(regexp_extract(url, '://([^/?#]*)', 1), '^www\\.', '') AS host,
  rtrim(url, '/') AS normal, rtrim(regexp_replace(url, '[?#].*$', ''), '/') AS normal_page FROM pages""")
def url_parts(spark, sf):
    u = F.col("url")
    return v.table(spark, sf, "pages").select("page_id", urls.join_path(u, F.lit("/news")).alias("joined"), urls.site_root(u).alias("root"), urls.host_key(u).alias("host"), urls.normal(u).alias("normal"), urls.normal_page(u).alias("normal_page"))


@query("""SELECT page_id, regexp_replace(url, '[?#].*$', '') || '?category=788&year=' || (2000 + page_id % 26) || '&l=100' AS listing,
  regexp_replace(url, '[?#].*$', '') || '?a=1&page=' || page_id || '&b=2#top' AS paged FROM pages""")
def url_params(spark, sf):
    def pair(k: str, value) -> object:
        return F.struct(F.lit(k).alias("k"), value.alias("v"))

    plain = F.regexp_replace("url", r"[?#].*$", "")
    listing = urls.listing_url(F.concat(plain, F.lit("?year=1999")), F.array(pair("category", F.lit("788")), pair("year", F.lit("7"))), F.array(pair("year", (2000 + F.col("page_id") % 26).cast("string")), pair("l", F.lit("100"))))
    return v.table(spark, sf, "pages").select("page_id", listing.alias("listing"), urls.with_page(F.concat(plain, F.lit("?a=1&page=9&b=2#top")), F.col("page_id")).alias("paged"))


@query("""SELECT page_id, place, href, CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '//%' THEN regexp_extract(url, '^([a-z]+:)', 1) || href WHEN href = '' THEN url
  WHEN href LIKE '/%' THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href WHEN href LIKE '#%' THEN regexp_replace(url, '#.*$', '') || href WHEN regexp_matches(href, '^[a-z]+:') THEN href
  ELSE regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || CASE WHEN regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[^/]*$', '') END || href END AS full_url FROM links""", v.LINKS)
def link_explode(spark, sf):
    return extract.links(v.table(spark, sf, "pages")).select("page_id", "place", "href", urls.resolve(F.col("url"), F.col("href")).alias("full_url"))


@query("""SELECT page_id, place, CASE WHEN regexp_matches(lower(href), '[?&]item=[0-9]+') OR regexp_matches(href, '/[0-9]{4}-[0-9]{2}-[0-9]{2}-[^/#]+/?$') THEN 'known' END AS known,
  len(list_filter(regexp_extract_all(lower(href), '/(?:news|press|financial)-releases/([^/#?]+)', 1), lambda x: x <> 'rss')) > 0 AS notified,
  regexp_matches(lower(href), '/(news|press)-releases/[0-9]{4}/[^/?#]+/?$') AS investis, regexp_matches(lower(href), '/news-details/[0-9]{4}/[^/]+') AS q4 FROM links""", v.LINKS)
def link_classify(spark, sf):
    h = F.col("href")
    known = F.when(urls.is_detail(h, "investorroom"), "known")
    return v.links(spark, sf).select("page_id", "place", known.alias("known"), *(urls.is_detail(h, p).alias(p) for p in ("notified", "investis", "q4")))


@query("SELECT page_id, replace(trim(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)), '&amp;', '&') AS title FROM pages")
def title_h1(spark, sf):
    return extract.headings(v.table(spark, sf, "pages"))


@query("SELECT release_id, url, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY rtrim(url, '/') ORDER BY ordinal) AS n FROM (SELECT release_id, url, release_id * 4 + 1 AS ordinal FROM releases UNION ALL SELECT release_id, rtrim(url, '/'), release_id * 4 + release_id % 3 * 2 FROM releases WHERE release_id % 2 = 0)) WHERE n = 1", v.RELEASES)
def dedupe_url(spark, sf):
    k, r = F.col("release_id"), v.releases(spark, sf)
    rows = r.select("release_id", "url", (k * 4 + 1).alias("ordinal")).union(r.filter(k % 2 == 0).select("release_id", urls.normal(F.col("url")), k * 4 + k % 3 * 2))
    return flow.dedupe(rows)


def _crawl(spark, sf) -> tuple[DataFrame, DataFrame]:
    r = v.releases(spark, sf)
    return r.withColumn("ordinal", F.col("release_id")), v.changed(r)


CHANGES = f"""{v.CHANGED}, changes AS (SELECT i.*, CASE WHEN r.url IS NULL THEN 'added' WHEN r.title <> i.title THEN 'updated' ELSE 'same' END AS change
  FROM incoming i LEFT JOIN releases r ON r.publish_date = i.publish_date AND r.url = i.url)"""


@query("SELECT release_id, url, change FROM changes", v.RELEASES, CHANGES)
def upsert_classify(spark, sf):
    return store.classify(*_crawl(spark, sf)).select("release_id", "url", "change")


@query("SELECT DISTINCT publish_date FROM changes WHERE change <> 'same'", v.RELEASES, CHANGES)
def touched_partitions(spark, sf):
    return store.touched_days(store.classify(*_crawl(spark, sf)))


@query("""SELECT slug, ticker, title, url, publish_date, publish_time FROM (SELECT r.slug, r.ticker, r.title, r.url, r.publish_date, r.publish_time FROM releases r
    WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.publish_date = r.publish_date AND i.url = r.url) UNION ALL SELECT slug, ticker, title, url, publish_date, publish_time FROM incoming)
  WHERE publish_date IN (SELECT publish_date FROM changes WHERE change <> 'same')""", v.RELEASES, CHANGES)
def upsert_result(spark, sf):
    return store.merge(*_crawl(spark, sf))


@query("SELECT count(DISTINCT CASE WHEN change <> 'same' THEN publish_date END) AS files_written, count(*) FILTER (change = 'added') AS rows_added, count(*) FILTER (change = 'updated') AS rows_updated, (SELECT count(*) FROM incoming WHERE publish_date IS NULL) AS undated FROM changes", v.RELEASES, CHANGES)
def merge_summary(spark, sf):
    old, new = _crawl(spark, sf)
    return store.summary(new, store.classify(old, new))


@query("SELECT slug, count(*) FILTER (release_id % 6 = 0) AS undated, count(*) FILTER (release_id % 6 <> 0) AS dated FROM releases GROUP BY slug", v.RELEASES)
def undated_split(spark, sf):
    r = v.releases(spark, sf).withColumn("publish_date", F.when(F.col("release_id") % 6 != 0, F.col("publish_date")))
    return store.undated_counts(r, "slug")


PAGES = f"{v.LISTING}, pages_of AS (SELECT slug, page, CAST(min(year(publish_date)) AS BIGINT) AS min_year, CAST(max(year(publish_date)) AS BIGINT) AS max_year FROM listing GROUP BY ALL)"


@query("SELECT * FROM pages_of", PAGES)
def page_years(spark, sf):
    return flow.page_years(v.listing(spark, sf), "slug", "page")


@query("SELECT slug, CASE WHEN max(max_year) FILTER (page = 0) < 2025 THEN max(page) + 1 ELSE coalesce(min(page) FILTER (min_year <= 2025), max(page)) END AS start_page FROM pages_of GROUP BY slug", PAGES)
def start_page(spark, sf):
    return flow.start_page(flow.page_years(v.listing(spark, sf), "slug", "page"), 2025, 2025)


@query("""SELECT slug, page, n_new, max_year FROM (SELECT *, coalesce(max(CASE WHEN n_new = 0 OR max_year < 2024 OR page + 1 >= 100 THEN 1 ELSE 0 END) OVER (PARTITION BY slug ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS was
  FROM (SELECT p.slug, p.page, p.max_year, coalesce(n.n_new, 0) AS n_new FROM pages_of p LEFT JOIN (SELECT slug, page, count(*) AS n_new FROM (SELECT slug, url, min(page) AS page FROM listing GROUP BY ALL) GROUP BY ALL) n ON p.slug = n.slug AND p.page = n.page)) WHERE was = 0""", PAGES)
def stop_early(spark, sf):
    items = v.listing(spark, sf)
    return flow.walked(flow.page_years(items, "slug", "page"), items, target_min=2024).select("slug", "page", "n_new", "max_year")


@query("""SELECT slug, year, n FROM (SELECT *, year + row_number() OVER (PARTITION BY slug ORDER BY year DESC) AS g, max(year) OVER (PARTITION BY slug) AS top FROM (SELECT slug, CAST(year(publish_date) AS BIGINT) AS year, count(*) AS n FROM releases WHERE (release_id % 50) % 7 <> year(publish_date) % 7 OR slug < 'c3' GROUP BY ALL)) WHERE g = top + 1""", v.RELEASES)
def year_gap_scan(spark, sf):
    year = F.year("publish_date").cast("long")
    rows = v.releases(spark, sf).filter(((F.col("release_id") % 50) % 7 != year % 7) | (F.col("slug") < "c3"))
    return flow.history_years(rows.groupBy("slug", year.alias("year")).agg(F.count("*").alias("n")))


@query("SELECT release_id, CASE WHEN release_id % 4 <> 0 THEN publish_date WHEN release_id % 8 = 0 THEN publish_date + 3 END AS publish_date FROM releases", v.RELEASES)
def fill_missing_dates(spark, sf):
    r, k = v.releases(spark, sf), F.col("release_id")
    details = r.filter(k % 8 == 0).select("url", F.date_add("publish_date", 3).alias("detail_date"))
    return flow.fill_dates(r.withColumn("publish_date", F.when(k % 4 != 0, F.col("publish_date"))), details).select("release_id", "publish_date")


SIDES = "sides AS (SELECT release_id, slug, release_id % 2 = 0 AND CAST(substr(slug, 2) AS INT) % 3 <> 1 AS is_first FROM releases)"


@query("SELECT release_id, slug FROM sides WHERE is_first UNION ALL SELECT release_id, slug FROM sides WHERE NOT is_first AND slug NOT IN (SELECT slug FROM sides WHERE is_first)", v.RELEASES, SIDES)
def second_source(spark, sf):
    r = v.releases(spark, sf).select("release_id", "slug")
    is_first = (F.col("release_id") % 2 == 0) & (F.substring("slug", F.lit(2), F.lit(9)).cast("int") % 3 != 1)
    return flow.or_else(r.filter(is_first), r.filter(~is_first))


@query("""SELECT slug, string_agg("group", ',' ORDER BY ordinal) AS groups FROM configured GROUP BY slug HAVING count(*) > 1""", v.SOURCES, v.CONFIGURED)
def config_groups(spark, sf):
    return reports.configured_groups(v.configured(spark, sf))


@query("SELECT slug, EXISTS (SELECT 1 FROM configured c WHERE c.slug = s.slug) AS covered FROM sources s", v.SOURCES, v.CONFIGURED)
def coverage_split(spark, sf):
    return reports.covered(v.sources(spark, sf).select("slug"), v.configured(spark, sf))


@query("SELECT DISTINCT 's' || c_custkey AS slug FROM customer WHERE 's' || c_custkey NOT IN (SELECT slug FROM sources) ORDER BY slug", v.SOURCES)
def unknown_configured(spark, sf):
    c = v.table(spark, sf, "customer").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("slug"))
    return reports.unknown_slugs(c, v.sources(spark, sf))


MISSING = "missing AS (SELECT s.slug, s.ticker, CASE WHEN s.ordinal % 7 = 0 THEN 'unknown' ELSE s.platform END AS platform FROM sources s WHERE s.slug NOT IN (SELECT slug FROM configured))"


def _missing(spark, sf) -> DataFrame:
    s = v.sources(spark, sf)
    return reports.coverage_missing(s.select("slug", "ticker"), v.configured(spark, sf), s.filter("ordinal % 7 <> 0"))


@query("SELECT * FROM missing", v.SOURCES, v.CONFIGURED, MISSING)
def coverage_missing(spark, sf):
    return _missing(spark, sf)


TABLE = """t AS (SELECT coalesce(c.platform, m.platform) AS platform, coalesce(c.n, 0) + coalesce(m.n, 0) AS total, coalesce(c.n, 0) AS configured, m.n AS missing,
  round_even(100.0::DOUBLE * coalesce(c.n, 0) / (coalesce(c.n, 0) + coalesce(m.n, 0)), 1) AS percentage_done
  FROM (SELECT platform, count(*) AS n FROM configured GROUP BY ALL) c FULL JOIN (SELECT platform, count(*) AS n FROM missing GROUP BY ALL) m ON c.platform = m.platform)"""


@query("SELECT * FROM t", v.SOURCES, v.CONFIGURED, MISSING, TABLE)
def coverage_table(spark, sf):
    return reports.coverage_table(v.configured(spark, sf), _missing(spark, sf))


@query("SELECT * FROM t UNION ALL SELECT 'TOTAL', CAST(sum(total) AS BIGINT), CAST(sum(configured) AS BIGINT), CAST(sum(missing) AS BIGINT), round_even(100.0::DOUBLE * sum(configured) / sum(total), 1) FROM t", v.SOURCES, v.CONFIGURED, MISSING, TABLE)
def coverage_total(spark, sf):
    return reports.with_total(reports.coverage_table(v.configured(spark, sf), _missing(spark, sf)))


@query("SELECT (SELECT count(*) FROM sources) AS total, (SELECT count(DISTINCT slug) FROM configured) AS covered, 100.0::DOUBLE * (SELECT count(DISTINCT slug) FROM configured) / (SELECT count(*) FROM sources) AS percentage", v.SOURCES, v.CONFIGURED)
def coverage_ratio(spark, sf):
    return reports.coverage_ratio(v.sources(spark, sf), v.configured(spark, sf))


@query("SELECT platform, rpad(platform, 16, ' ') || lpad(CAST(total AS VARCHAR), 10, ' ') || lpad(CAST(configured AS VARCHAR), 10, ' ') || lpad(coalesce(CAST(missing AS VARCHAR), '-'), 10, ' ') || lpad(printf('%.1f', percentage_done), 8, ' ') || '%' AS line FROM t", v.SOURCES, v.CONFIGURED, MISSING, TABLE)
def coverage_lines(spark, sf):
    return reports.rendered_coverage(reports.coverage_table(v.configured(spark, sf), _missing(spark, sf)))


WANTED = "wanted AS (SELECT DISTINCT 'S-' || (c_custkey % 90) AS ticker FROM customer), covered AS (SELECT DISTINCT replace(trim(ticker), '.', '-') AS ticker FROM sources)"


def _wanted(spark, sf) -> tuple[DataFrame, DataFrame]:
    w = v.table(spark, sf, "customer").select(F.concat(F.lit("S-"), (F.col("c_custkey") % 90).cast("string")).alias("ticker")).distinct()
    return w, catalog.tickers(v.sources(spark, sf))


@query("SELECT ticker FROM wanted EXCEPT SELECT ticker FROM covered ORDER BY ticker", v.SOURCES, WANTED)
def ticker_gap(spark, sf):
    return reports.missing_tickers(*_wanted(spark, sf))


@query("SELECT (SELECT count(*) FROM wanted) AS index_size, (SELECT count(*) FROM wanted JOIN covered USING (ticker)) AS covered, (SELECT count(*) FROM wanted WHERE ticker NOT IN (SELECT ticker FROM covered)) AS missing", v.SOURCES, WANTED)
def ticker_overlap(spark, sf):
    return reports.ticker_overlap(*_wanted(spark, sf))


@query("""SELECT page_id, segment, n AS votes FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY n DESC, first_place) AS r FROM (SELECT page_id, regexp_extract(href, '^(?:[a-z]+://[^/]*)?/([^/?#]*)', 1) AS segment, count(*) AS n, min(place) AS first_place FROM links GROUP BY ALL)) WHERE r = 1""", v.LINKS)
def majority_segment(spark, sf):
    rows = v.links(spark, sf).withColumn("segment", F.regexp_extract("href", "^(?:[a-z]+://[^/]*)?/([^/?#]*)", 1))
    return reports.majority(rows, "page_id", "segment", "place")


@query("SELECT p_brand AS brand, CAST(p_size % 5 AS BIGINT) AS size, count(*) AS n, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS members FROM part GROUP BY ALL")
def signature_groups(spark, sf):
    rows = v.table(spark, sf, "part").select(F.col("p_brand").alias("brand"), (F.col("p_size") % 5).cast("long").alias("size"), F.col("p_partkey").alias("slug"), F.col("p_partkey").alias("ordinal"))
    return reports.signature_groups(rows, "brand", "size")


@query("SELECT p_brand, p_type, arg_min(p_partkey, md5(p_partkey || ' 7')) AS slug FROM part GROUP BY ALL")
def smoke_sample(spark, sf):
    rows = v.table(spark, sf, "part").select("p_brand", "p_type", F.col("p_partkey").alias("slug"))
    return flow.smoke_sample(rows, "p_brand", "p_type", seed=7)


CONFIG_ARGS = (
    '{"b": 2, "a": [1, 2, {"y": null, "x": true}]}',
    '{"a":[1,2,{"x":true,"y":null}],"b":2}',  # the same value as the first
    '{"a": [2, 1, {"x": true, "y": null}], "b": 2}',
    '["--limit", 5]',
    '[5, "--limit"]',
    '"--dry"',
)


@query("""SELECT string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS members, count(*) AS n FROM part
  GROUP BY p_brand, greatest(p_partkey % 6, 1), greatest((p_partkey // 6) % 6, 1)""")
def nested_signatures(spark, sf):
    """Parts as sources with two nested arguments in either order; the second is told apart by its key."""
    k = F.col("p_partkey")
    arg = lambda n: F.element_at(F.array(*map(F.lit, CONFIG_ARGS)), (n % 6 + 1).cast("int"))
    one, two = arg(k), F.concat(F.lit('{"second": '), arg(F.floor(k / 6)), F.lit("}"))
    args = F.when(k % 2 == 0, F.array(one, two, F.lit("null"))).otherwise(F.array(F.lit("null"), two, one))
    rows = v.table(spark, sf, "part").select(F.col("p_brand").alias("module"), args.alias("args"), k.alias("slug"))
    made = catalog.nested_signatures(rows).groupBy("signature").agg(F.array_sort(F.collect_list("slug")).alias("m"))
    return made.select(F.array_join(F.transform("m", lambda x: x.cast("string")), ",").alias("members"), F.size("m").cast("long").alias("n"))


NEUTRAL = (("archive", "<article"), ("menu", "<nav"), ("plain", "<h1"))


@query("SELECT page_id, CASE WHEN html LIKE '%<article%' THEN 'archive' WHEN html LIKE '%<nav%' THEN 'menu' WHEN html LIKE '%<h1%' THEN 'plain' ELSE 'unknown' END AS platform FROM pages")
def platform_detect(spark, sf):
    return v.table(spark, sf, "pages").select("page_id", classify.detect_platform(F.col("html"), NEUTRAL).alias("platform"))


@query("SELECT slug, CASE platform WHEN 'q4' THEN 'q4_ir' ELSE platform END AS strategy, platform AS back FROM sources", v.SOURCES)
def strategy(spark, sf):
    s = v.sources(spark, sf).withColumn("strategy", classify.strategy_of(F.col("platform"), F.col("slug")))
    return s.select("slug", "strategy", classify.platform_of(F.col("strategy")).alias("back"))


@query("SELECT slug, platform AS strategy, CASE WHEN ordinal % 8 <> 0 THEN CASE WHEN ordinal % 3 = 0 THEN 'q4' ELSE platform END END AS detected, CASE WHEN ordinal % 8 = 0 THEN 'missing' ELSE 'mismatch' END AS problem FROM sources WHERE (ordinal % 8 = 0 OR (ordinal % 3 = 0 AND platform <> 'q4'))", v.SOURCES)
def consistency(spark, sf):
    s = v.sources(spark, sf)
    found = s.filter("ordinal % 8 <> 0").select("slug", F.when(F.col("ordinal") % 3 == 0, "q4").otherwise(F.col("platform")).alias("strategy"))
    return classify.inconsistencies(s.select("slug", F.col("platform").alias("strategy")), found)


@query("""SELECT slug, CASE platform WHEN 'q4' THEN b || '/news/default.aspx' WHEN 'aem' THEN b WHEN 'unknown' THEN CASE WHEN news_url <> '' THEN news_url ELSE ir_url END ELSE b || '/news-releases' END AS listing
  FROM (SELECT *, rtrim(CASE WHEN news_url <> '' THEN news_url ELSE ir_url END, '/') AS b FROM sources)""", v.SOURCES)
def listing_url(spark, sf):
    return v.sources(spark, sf).select("slug", classify.listing_url(F.col("platform"), F.col("ir_url"), F.col("news_url")).alias("listing"))


@query("""SELECT page_id, s.slug FROM (SELECT page_id, 'h' || (page_id % 60) || '.example.com' AS host FROM pages) p
  LEFT JOIN (SELECT host, arg_min(slug, ordinal) AS slug FROM (SELECT regexp_replace(regexp_extract(ir_url, '://([^/]*)', 1), '^www\\.', '') AS host, slug, ordinal FROM sources) GROUP BY host) s ON p.host = s.host""", v.SOURCES)
def source_of_url(spark, sf):
    addresses = v.table(spark, sf, "pages").select("page_id", F.concat(F.lit("https://h"), (F.col("page_id") % 60).cast("string"), F.lit(".example.com/x")).alias("url"))
    return catalog.find_by_url(v.sources(spark, sf), addresses).select("page_id", "slug")


@query("SELECT p_partkey, CAST(list_max(list_filter([5, 10, 25, 50, 100], lambda x: x <= p_size)) AS BIGINT) AS size FROM part")
def page_size_pick(spark, sf):
    offered = F.array(*map(F.lit, (5, 10, 25, 50, 100)))
    return v.table(spark, sf, "part").select("p_partkey", flow.largest_offered(offered, F.col("p_size")).cast("long").alias("size"))


@query("SELECT s_suppkey, lower(regexp_replace(s_name, '[^A-Za-z0-9]+', '-', 'g')) AS slug FROM supplier")
def slugify(spark, sf):
    return v.table(spark, sf, "supplier").select("s_suppkey", urls.slugify(F.concat("s_name", F.lit(" (Old Name) Holdings Company, Inc."))).alias("slug"))


@query("SELECT url, coalesce(ticker, slug) || ': ' || title || ' (' || CAST(publish_date AS VARCHAR) || CASE WHEN publish_time <> '' THEN ', ' || publish_time ELSE '' END || ')' || chr(10) || url AS text, " + PLACE + " FROM releases", v.RELEASES)
def digest(spark, sf):
    return reports.digest(v.releases(spark, sf))


@query("SELECT CAST(min(publish_date) AS VARCHAR) || ' to ' || CAST(max(publish_date) AS VARCHAR) AS title, count(DISTINCT publish_date) AS days, count(*) AS releases FROM releases", v.RELEASES)
def digest_title(spark, sf):
    return reports.digest_title(v.releases(spark, sf))


@query("SELECT CAST(greatest(max(length(slug)), 4) AS BIGINT) AS slug, CAST(greatest(max(length(coalesce(ticker, ''))), 6) AS BIGINT) AS ticker, CAST(greatest(max(length(title)), 5) AS BIGINT) AS title FROM releases", v.RELEASES)
def table_widths(spark, sf):
    return reports.column_widths(v.releases(spark, sf), "slug", "ticker", "title")


@query("SELECT url, CAST(publish_date AS VARCHAR) || '  ' || rpad(publish_time, 14, ' ') || '  ' || title AS line, " + PLACE + " FROM releases", v.RELEASES)
def preview(spark, sf):
    return reports.preview(v.releases(spark, sf))


@query("SELECT release_id, 'slug: ' || slug || CASE WHEN ticker IS NOT NULL THEN chr(10) || 'ticker: ' || ticker ELSE '' END || chr(10) || 'title: ' || title AS text FROM releases", v.RELEASES)
def record_text(spark, sf):
    return reports.record_lines(v.releases(spark, sf), "slug", "ticker", "title", keep=("release_id",))


@query("SELECT release_id, publish_date, release_id % 4 <> 0 AS is_date FROM (SELECT release_id, CASE WHEN release_id % 4 = 0 THEN 'soon' ELSE CAST(publish_date AS VARCHAR) END AS publish_date FROM releases)", v.RELEASES)
def migrate_rename(spark, sf):
    k = F.col("release_id")
    old = v.releases(spark, sf).select("release_id", F.when(k % 4 == 0, "soon").otherwise(F.col("publish_date").cast("string")).alias("publish_datetime"))
    return store.rename_column(old)


@query("SELECT release_id, url, '' AS publish_time FROM releases", v.RELEASES)
def migrate_add(spark, sf):
    return store.add_column(v.releases(spark, sf).select("release_id", "url"))



def _forms(spark, sf, *forms: str):
    """releases with an address of the form that its number picks."""
    form = F.element_at(F.array(*map(F.lit, forms)), (F.col("release_id") % len(forms) + 1).cast("int"))
    return v.releases(spark, sf).select("release_id", F.replace(form, F.lit("{id}"), F.col("release_id").cast("string")).alias("href"))


BASE = "https://ir.example.com/news-releases"


@query("SELECT release_id, ['known', 'known', 'bare-slug', NULL, NULL, NULL, NULL, NULL][release_id % 8 + 1] AS kind FROM releases", v.RELEASES)
def link_kind(spark, sf):
    rows = _forms(spark, sf, "https://ir.example.com/2026-01-02-title-{id}", "/news?item={id}", "/some-title-{id}", "/subscribe", "https://other.example.com/title-{id}", "/a/title-{id}", "/latest-news-{id}", "/some-title-{id}?x=1")
    return rows.select("release_id", urls.classify_link(F.col("href"), F.lit(BASE)).alias("kind"))


@query("SELECT release_id, release_id % 6 IN (0, 5) AS probable FROM releases", v.RELEASES)
def probable_release(spark, sf):
    rows = _forms(spark, sf, "/corporate/global/en/story-{id}.html", "/corporate/global/en/insights.html", "/corporate/x-{id}.html#top", "/", "https://other.example.com/x-{id}.html", "../x/./story-{id}.html")
    return rows.select("release_id", urls.is_probable_release(F.col("href"), F.lit(BASE)).alias("probable"))


@query("SELECT release_id, length(title) >= 20 AND release_id % 3 <> 0 AS confirmed FROM releases", v.RELEASES)
def confirmed_item(spark, sf):
    return v.releases(spark, sf).select("release_id", urls.is_confirmed(F.col("title"), F.when(F.col("release_id") % 3 != 0, F.col("publish_date"))).alias("confirmed"))


@query("SELECT release_id, release_id % 4 IN (0, 1) AS detail FROM releases", v.RELEASES)
def segment_detail(spark, sf):
    rows = _forms(spark, sf, "/News-Details/2026/t-{id}/default.aspx", "/x/press-release-details/2026/t-{id}", "/press-release-details/t-{id}", "/event-details/2026/t-{id}")
    segment = F.when(F.col("release_id") % 4 == 0, "news-details").otherwise("press-release-details")
    return rows.select("release_id", urls.is_segment_detail(F.col("href"), segment).alias("detail"))


@query("SELECT release_id, release_id % 8 < 6 AS action FROM releases", v.RELEASES)
def call_to_action(spark, sf):
    rows = _forms(spark, sf, "Read more", "LEARN MORE", "find  out more", "More", "detail", "Details", "Read more about {id}", "Moreover")
    return rows.select("release_id", urls.is_call_to_action(F.col("href")).alias("action"))


@query("""SELECT release_id, 'https://ir.example.com/news/' || year(publish_date) || CASE WHEN release_id % 3 > 0 THEN '?page=' || (release_id % 3 + 1) ELSE '' END AS year_page,
  CASE WHEN release_id % 2 = 0 THEN 'news/' || year(publish_date) || '/default.aspx' ELSE 'news/default.aspx' END AS filled, 'https://x.example.com/list#pageNum=' || (release_id % 9) || '&dateFrom=1&dateTo=' || release_id AS hashed FROM releases""", v.RELEASES)
def listing_addresses(spark, sf):
    k, year = F.col("release_id"), F.year("publish_date")
    filled = urls.fill_year(F.lit("news/{year}/default.aspx"), F.when(k % 2 == 0, year))
    hashed = urls.hash_listing(F.lit("https://x.example.com/list#old"), k % 9, F.lit(1), k)
    return v.releases(spark, sf).select("release_id", urls.year_listing(F.lit("https://ir.example.com/"), "/news", year, k % 3 + 1).alias("year_page"), filled.alias("filled"), hashed.alias("hashed"))


@query("""SELECT release_id, CASE release_id % 4 WHEN 0 THEN 'https://a.example.com/x/y' WHEN 1 THEN 'https://a.example.com/y?q=../z' WHEN 2 THEN 'https://a.example.com/y/' ELSE 'https://a.example.com/news/n' || release_id || '#f' END AS full_url FROM releases""", v.RELEASES)
def dot_segments(spark, sf):
    rows = _forms(spark, sf, "/x/./z/../y", "../../y?q=../z", "x/../../y/.", "./n{id}#f")
    return rows.select("release_id", urls.resolve(F.lit("https://a.example.com/news/list"), F.col("href")).alias("full_url"))


@query("""SELECT release_id, CASE WHEN release_id % 3 <> 0 THEN publish_date END AS prefix, release_id % 2 = 0 AS iso, 'data/' || year(publish_date) || '/' || publish_date || '.csv' AS path FROM releases""", v.RELEASES)
def iso_dates(spark, sf):
    k, text = F.col("release_id"), F.col("publish_date").cast("string")
    stamp = F.when(k % 3 == 0, F.concat(F.lit("on "), text)).otherwise(F.concat(text, F.lit("T09:30:00Z")))
    shape = F.when(k % 2 == 0, text).otherwise(F.date_format("publish_date", "yyyy-M-dd'x'"))
    return v.releases(spark, sf).select("release_id", dates.iso_prefix(stamp).alias("prefix"), dates.is_iso_shape(shape).alias("iso"), dates.day_path(F.col("publish_date")).alias("path"))


@query("""SELECT release_id, CASE release_id % 4 WHEN 0 THEN publish_date END AS investorroom, CASE release_id % 4 WHEN 1 THEN publish_date END AS investis,
  CASE WHEN release_id % 4 IN (0, 2) THEN publish_date END AS aem_bny, CASE release_id % 4 WHEN 2 THEN publish_date END AS aem_cme FROM releases""", v.RELEASES)
def url_dates(spark, sf):
    k, d = F.col("release_id"), F.col("publish_date")
    href = F.when(k % 4 == 0, F.date_format(d, "'/'yyyy-MM-dd'-title'")).when(k % 4 == 1, F.date_format(d, "'/news-releases/2026/'MM-dd-yyyy'-1'")).when(k % 4 == 2, F.date_format(d, "'/'yyyy'/'M'/'dd")).otherwise("/2026/13/45/")
    return v.releases(spark, sf).select("release_id", *(dates.date_from_url(href, p).alias(p) for p in ("investorroom", "investis", "aem_bny", "aem_cme")))


def _told_dates(spark, sf) -> DataFrame:
    """releases as a file has them: dates as text, some of them none."""
    k = F.col("release_id")
    return v.releases(spark, sf).withColumn("publish_date", F.when(k % 5 == 0, "soon").when(k % 5 == 1, "2026-02-30").otherwise(F.col("publish_date").cast("string")))


@query("SELECT CAST(year(publish_date) AS BIGINT) AS year, slug, ticker, count(*) AS release_count FROM releases WHERE release_id % 5 > 1 AND ticker IS NOT NULL GROUP BY ALL", v.RELEASES)
def counts_of_told_dates(spark, sf):
    return reports.release_counts(_told_dates(spark, sf))


@query("SELECT release_id, CASE release_id % 5 WHEN 0 THEN 'soon' ELSE '2026-02-30' END AS publish_date FROM releases WHERE release_id % 5 < 2", v.RELEASES)
def bad_dates(spark, sf):
    return reports.bad_dates(_told_dates(spark, sf)).select("release_id", "publish_date")


@query()
def check_counts(spark, sf):
    actual = reports.release_counts(v.releases(spark, sf), keep_null=True)
    return reports.check_counts(_baseline(actual), None, actual, [1996, 1997])


ORACLES["check_counts"] = f"WITH {v.RELEASES}, {BASELINE}{MISMATCH} WHERE year IN (1996, 1997)"


@query("""SELECT release_id, CASE WHEN release_id % 5 < 4 THEN publish_date END AS detail_date, CASE WHEN release_id % 5 = 3 THEN '9:30 AM ET' ELSE '' END AS detail_time FROM releases""", v.RELEASES)
def detail_dates(spark, sf):
    k, plain = F.col("release_id"), F.date_format("publish_date", "MMMM d, yyyy")
    page = F.element_at(F.array(*map(F.lit, ("<time datetime='{iso}'>x</time>", "<div class='date'>{plain}</div>", "<article><p>TOWN, {plain} (Wire) - text</p></article>", "<nav>1:00 PM PT</nav><main>{plain} 9:30 AM ET text</main>", "<p>no date</p>"))), (k % 5 + 1).cast("int"))
    page = F.replace(F.replace(page, F.lit("{iso}"), F.col("publish_date").cast("string")), F.lit("{plain}"), plain)
    made = extract.detail_dates(v.releases(spark, sf).select(k.cast("string").alias("url"), page.alias("html"), F.lit("notified").alias("platform")))
    return made.select(F.col("url").cast("bigint").alias("release_id"), "detail_date", "detail_time")


MARKS = (
    ("notified", "<meta content='Drupal 10' name='Generator'>investorroom"), ("unknown", "<!-- <meta name='generator' content='Drupal'> -->"), ("investis", "<!-- Investis Sitecore common GTM --><a href='/news-releases/2026/07-15-2026-1'>x</a>"),
    ("investorroom", "<a href='/news?item=12'>x</a>"), ("q4", "<a href='/financial-releases/press-release-details/2026/x/default.aspx'>x</a>"), ("q4", "<script src='/newsroom/list.aspx'></script>"),
    ("notified", "<a href='/news-releases/news-release-details/x'>x</a>"), ("aem", "<img src='/content/dam/x.png'>"), ("unknown", "<!-- <a href='/news-releases/a/b'>x</a> -->"),
)


@query(f"SELECT release_id, {[m[0] for m in MARKS]}[release_id % {len(MARKS)} + 1] AS platform FROM releases", v.RELEASES)
def platform_fingerprints(spark, sf):
    page = F.element_at(F.array(*(F.lit(m[1]) for m in MARKS)), (F.col("release_id") % len(MARKS) + 1).cast("int"))
    html = F.concat(F.lit("<html><body>"), page, F.lit("</body></html>"))
    return v.releases(spark, sf).select("release_id", classify.detect_platform(html, segment=F.lit("press-release-details"), news_path=F.lit("newsroom/{year}/list.aspx")).alias("platform"))


@query("""SELECT slug, ordinal, url, page FROM (SELECT l.*, row_number() OVER (PARTITION BY l.slug, rtrim(url, '/') ORDER BY ordinal) AS k FROM listing l JOIN read r ON l.slug = r.slug AND l.page = r.page) WHERE k = 1""", PAGES, """
begins AS (SELECT slug, CASE WHEN max(max_year) FILTER (page = 0) < 2024 THEN max(page) + 1 ELSE coalesce(min(page) FILTER (min_year <= 2025), max(page)) END AS b FROM pages_of GROUP BY slug),
inside AS (SELECT p.* FROM pages_of p JOIN begins USING (slug) WHERE page >= b),
news AS (SELECT slug, page, count(*) AS n FROM (SELECT l.slug, rtrim(url, '/') AS u, min(page) AS page FROM listing l JOIN begins USING (slug) WHERE page >= b GROUP BY ALL) GROUP BY ALL),
read AS (SELECT slug, page FROM (SELECT *, coalesce(max(stop) OVER (PARTITION BY slug ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS was
  FROM (SELECT i.slug, i.page, CASE WHEN coalesce(n, 0) = 0 OR max_year < 2024 OR i.page + 1 >= 100 THEN 1 ELSE 0 END AS stop FROM inside i LEFT JOIN news n ON i.slug = n.slug AND i.page = n.page)) WHERE was = 0)""")
def walk(spark, sf):
    return flow.walk(v.listing(spark, sf), {2024, 2025}).select("slug", "ordinal", "url", "page")


@query("""SELECT page_id, coalesce(s.slug, CASE WHEN page_id % 3 = 0 THEN 'x' || page_id ELSE 'none' END) AS slug, coalesce(s.ticker, '') AS ticker, s.slug IS NOT NULL AS known, 'https://h' || (page_id % 60) || '.example.com' AS base
  FROM (SELECT page_id, CASE WHEN page_id % 3 = 1 THEN 's' || (page_id % 7 + 1) END AS given, 'h' || (page_id % 60) || '.example.com' AS host FROM pages) p
  LEFT JOIN (SELECT host, arg_min(slug, ordinal) AS slug FROM (SELECT regexp_replace(regexp_extract(ir_url, '://([^/]*)', 1), '^www\\.', '') AS host, slug, ordinal FROM sources) GROUP BY host) h ON p.host = h.host
  LEFT JOIN sources s ON s.slug = coalesce(p.given, h.slug)""", v.SOURCES)
def identity(spark, sf):
    k = F.col("page_id")
    slug = F.when(k % 3 == 1, F.concat(F.lit(" S"), (k % 7 + 1).cast("string"))).when(k % 3 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise("")
    url = F.concat(F.lit("https://h"), (k % 60).cast("string"), F.lit(".example.com/news/"), k.cast("string"))
    asked = v.table(spark, sf, "pages").select(url.alias("url"), slug.alias("slug"), F.lit("").alias("ticker"))
    made = catalog.with_identity(asked, v.sources(spark, sf), default_slug="none")
    return made.select(F.regexp_extract("url", r"(\d+)$", 1).cast("bigint").alias("page_id"), "slug", "ticker", "known", "base")


@query("""SELECT slug, CASE platform WHEN 'q4' THEN 'q4_ir' ELSE platform END AS strategy, CASE platform WHEN 'q4' THEN b || '/news/default.aspx' WHEN 'aem' THEN b WHEN 'unknown' THEN u ELSE b || '/' || CASE WHEN ordinal % 2 = 0 THEN 'list' ELSE 'news-releases' END END AS listing, 'news-details' AS news_details_segment, CAST(ordinal % 2 AS INT) AS first_page_index, false AS needs_detail_page_dates
  FROM (SELECT *, CASE WHEN news_url <> '' THEN news_url ELSE ir_url END AS u, rtrim(CASE WHEN news_url <> '' THEN news_url ELSE ir_url END, '/') AS b FROM sources)""", v.SOURCES)
def resolved_sources(spark, sf):
    s, none = v.sources(spark, sf), F.lit(None).cast("string")
    k = F.col("ordinal")
    full = s.drop("platform").withColumns({"news_releases_path": F.when(k % 2 == 0, "/list"), "news_path": none, "aem_listing_path": none, "news_details_segment": none, "first_page_index": F.when(k % 2 == 1, 1).cast("int"), "needs_detail_page_dates": F.lit(None).cast("boolean")})
    made = catalog.resolved_sources(full, s.select("slug", "platform"))
    return made.select("slug", "strategy", "listing", "news_details_segment", "first_page_index", "needs_detail_page_dates")


@query("SELECT arg_min(c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN ' ' ELSE '' END, c_custkey) AS query, min(c_custkey) AS ordinal FROM customer GROUP BY c_mktsegment")
def distinct_queries(spark, sf):
    c = v.table(spark, sf, "customer")
    return catalog.distinct_queries(c.select(F.concat("c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, " ").otherwise("")).alias("query"), F.col("c_custkey").alias("ordinal")))


@query("SELECT ordinal, slug FROM configured WHERE lower(\"group\") = 'q4' AND slug = 's12' ORDER BY ordinal", v.SOURCES, v.CONFIGURED)
def select_sources(spark, sf):
    return catalog.selected(v.configured(spark, sf), "Q4", "S12").select("ordinal", "slug")


@query("SELECT slug, ticker FROM sources WHERE lower(ticker) = 's.7' ORDER BY ordinal LIMIT 1", v.SOURCES)
def find_source(spark, sf):
    return catalog.find_source(v.sources(spark, sf), " s.7 ").select("slug", "ticker")


@query("SELECT DISTINCT replace(trim(ticker), '.', '-') AS ticker FROM sources", v.SOURCES)
def index_tickers(spark, sf):
    row = F.concat(F.lit("<tr><td>Name</td><td> "), F.col("ticker"), F.lit(" </td></tr>"))
    rows = v.sources(spark, sf).groupBy((F.col("ordinal") % 9).alias("page")).agg(F.array_join(F.collect_list(row), "").alias("rows"))
    page = F.concat(F.lit("<table><tr><th>Security</th><th>Symbol</th></tr>"), F.col("rows"), F.lit("</table><table><tr><th>Symbol</th></tr><tr><td>OTHER</td></tr></table>"))
    return catalog.index_tickers(rows.select(page.alias("html")))


#: Cards by platform: what stands around them, and the card of a release with its date as text.
CARDS = {
    "q4": ("<section>", "<div><span>{date}</span><a href='/news/news-details/2026/{id}'>{title}</a></div>", "</section>"),
    "investorroom": ("<main>", "<div><p>{plain}</p><a href='/news?item={id}'>{title}</a></div>", "</main>"),
    "notified": ("<table>", "<tr><td>{date}</td><td><a href='/news-releases/news-release-details/{id}'>{title}</a></td></tr>", "</table>"),
    "notified_gated": ("<table>", "<tr><td>{date}</td><td><a href='/news-releases/news-release-details/{id}'>{title}</a></td></tr>", "</table>"),
    "investis": ("<table>", "<tr><td>Date {date}</td><td><a href='/news-releases/2026/{id}'>{title}</a></td></tr>", "</table>"),
    "aem_bny": ("<nav><a href='/home'>Home</a></nav>", "<div class='list-item-tile'><time>{date}</time><a href='/x/{id}.html'><h3>{title}</h3></a></div>", ""),
    "aem_cme": ("<ul id='cmeSearchFilterResults'>", "<li><span class='cmeBrowseAllDate'>{date}</span><a href='/x/{id}.html'>{title}</a></li>", "</ul>"),
}


def listing_pages(spark: SparkSession, sf: str, platform: str) -> DataFrame:
    """releases as listing pages of 25 cards."""
    before, card, after = CARDS[platform]
    r, text = v.releases(spark, sf), F.lit(card)
    for name, value in (("{date}", F.col("date_text")), ("{plain}", F.date_format("publish_date", "MMMM d, yyyy")), ("{id}", F.col("release_id").cast("string")), ("{title}", F.col("title"))):
        text = F.replace(text, F.lit(name), value)
    cards = r.select(F.floor(F.col("release_id") / 25).alias("page"), F.struct("release_id", text.alias("card")).alias("c")).groupBy("page").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    html = F.concat(F.lit(before), F.array_join(F.col("cs.card"), ""), F.lit(after))
    return cards.select(F.lit("s").alias("slug"), F.lit("S").alias("ticker"), "page", F.lit("https://ir.example.com/news").alias("base_url"), html.alias("html"), F.lit(platform).alias("platform"), F.lit(None).cast("string").alias("segment"))


def _register_extraction(platform: str) -> None:
    href = CARDS[platform][1].split("href='")[1].split("'")[0].replace("{id}", "' || release_id || '")

    def run(spark, sf):
        return extract.extract_items(listing_pages(spark, sf, platform)).select("page", "title", "url", "publish_date")

    run.__name__ = f"extract_items_{platform}"
    query(f"SELECT release_id // 25 AS page, title, 'https://ir.example.com{href}' AS url, publish_date FROM releases", v.RELEASES)(run)


for _platform in CARDS:
    _register_extraction(_platform)


@query("SELECT url, '{\"slug\":\"' || slug || '\",\"ticker\":\"' || coalesce(ticker, '') || '\",\"title\":\"' || title || '\",\"url\":\"' || url || '\",\"publish_date\":\"' || publish_date || '\",\"publish_time\":\"' || publish_time || '\"}' AS json FROM releases", v.RELEASES)
def json_rows(spark, sf):
    return store.as_json(v.releases(spark, sf), "url")


@query("""SELECT slug, ticker, title, url, publish_date, publish_time FROM releases r WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.publish_date = r.publish_date AND i.url = r.url)
  UNION ALL SELECT slug, ticker, title, url, publish_date, publish_time FROM incoming""", v.RELEASES, v.CHANGED)
def stream_upsert_all(spark, sf):
    """The whole table through the stream and the day folders."""
    return _streamed(spark, v.releases(spark, sf))


def _streamed(spark: SparkSession, first: DataFrame) -> DataFrame:
    """Two days' crawls arrive as files; each is merged by a run of the stream, and a third run finds nothing new."""
    root = store.scratch_path(spark)
    for rows in (first, v.changed(first), None):
        if rows is not None:
            rows.select(*(F.col(c).cast("string").alias(c) for c in store.COLUMNS)).write.mode("append").parquet(f"{root}/incoming")
        ingest.ingest(spark, f"{root}/incoming", f"{root}/store", f"{root}/state")
    made = store.read_day_folders(spark, f"{root}/store")
    return made.select("slug", "ticker", "title", "url", F.col("day").alias("publish_date"), F.coalesce("publish_time", F.lit("")).alias("publish_time"))


from noticeloom.plans import catalog_queries, store_queries, walk_queries  # noqa: E402, F401  they register more, with the functions above
