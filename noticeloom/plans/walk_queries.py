"""Registered queries over walks: as a stream, and by probing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeloom.operators import containment, extract, flow, probe
from noticeloom.plans import views as v
from noticeloom.plans.queries import CARDS, ORACLES, query
from noticeloom.sources import store
from noticeloom.streaming import walk

PLATFORMS = ("notified", "investorroom", "investis", "q4")


def short_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The listings in pages of five, each with its platform."""
    k = F.substring("slug", 2, 9).cast("int")
    platform = F.element_at(F.array(*map(F.lit, PLATFORMS)), k % 4 + 1)
    return v.listing(spark, sf).select("slug", platform.alias("platform"), F.floor(F.col("ordinal") / 100).cast("long").alias("page"), "ordinal", "url", "publish_date")


SHORT = f"""{v.LISTING}, short AS (SELECT slug, {[*PLATFORMS]}[CAST(substr(slug, 2) AS INT) % 4 + 1] AS platform, ordinal // 100 AS page, ordinal, url, publish_date FROM listing),
fresh AS (SELECT slug, page, ordinal, url, publish_date FROM (SELECT *, row_number() OVER (PARTITION BY slug, rtrim(url, '/') ORDER BY page, ordinal) AS k FROM short) WHERE k = 1),
judged AS (SELECT s.*, coalesce(f.n_new, 0) AS n_new FROM (SELECT slug, platform, page, CAST(max(year(publish_date)) AS BIGINT) AS max_year FROM short GROUP BY ALL) s LEFT JOIN (SELECT slug, page, count(*) AS n_new FROM fresh GROUP BY ALL) f ON s.slug = f.slug AND s.page = f.page),
read_pages AS (SELECT * FROM (SELECT *, coalesce(max(CASE WHEN n_new = 0 OR max_year < 2024 OR page + 1 >= CASE platform WHEN 'investorroom' THEN 50 WHEN 'investis' THEN 50 ELSE 100 END THEN 1 ELSE 0 END) OVER (PARTITION BY slug ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS was FROM judged) WHERE was = 0)"""


@query("SELECT p.slug, p.page, p.n_new, p.max_year, f.ordinal, f.url, f.publish_date FROM read_pages p LEFT JOIN fresh f ON p.slug = f.slug AND p.page = f.page", SHORT)
def walk_stream(spark, sf):
    """Pages arrive in three files, each third page in one, and are walked in three micro-batches."""
    root = store.scratch_path(spark)
    pages = short_pages(spark, sf).groupBy("slug", "platform", "page").agg(F.collect_list(F.struct("ordinal", "url", "publish_date")).alias("items"))
    for third in (2, 0, 1):
        pages.filter(F.col("page") % 3 == third).coalesce(1).write.mode("append").parquet(f"{root}/pages")
    walk.run_walk(spark, f"{root}/pages", f"{root}/walked", f"{root}/state", files_a_batch=1, target_min=2024)
    return spark.read.parquet(f"{root}/walked")


@query("SELECT slug, page, n_new, max_year FROM read_pages", SHORT)
def walk_caps(spark, sf):
    """The same pages as a table, each platform with its own cap."""
    items = short_pages(spark, sf)
    pages = flow.page_years(items, "slug", "platform", "page")
    return flow.walked(pages, items, target_min=2024, cap=flow.cap_of(F.col("platform"))).select("slug", "page", "n_new", "max_year")


def _by_spot(spark: SparkSession, pages: DataFrame, name: str, root: str, groups: int) -> DataFrame:
    probe.write_pages(pages, f"{root}/{name}", groups)
    return spark.read.parquet(f"{root}/{name}")


def _listings(facts: DataFrame) -> DataFrame:
    return facts.groupBy("slug").agg((F.max("page") + 1).alias("n_pages"))


@query(ORACLES["start_page"])
def start_page_probing(spark, sf):
    facts = flow.page_years(v.listing(spark, sf), "slug", "page")
    told = _by_spot(spark, facts, "facts", store.scratch_path(spark), 4)
    return probe.probed_start(told, _listings(facts), 2025, 2025, store.keeper(spark), 4).select("slug", "start_page")


@query(ORACLES["walk"])
def walk_probing(spark, sf):
    root, items = store.scratch_path(spark), v.listing(spark, sf)
    facts = flow.page_years(items, "slug", "page")
    told, table = _by_spot(spark, facts, "facts", root, 4), _by_spot(spark, items, "items", root, 4)
    made, _ = probe.probing_walk(told, table, _listings(facts), {2024, 2025}, store.keeper(spark), groups=4)
    return made.select("slug", "ordinal", "url", "page")


def gated_pages(spark: SparkSession, sf: str) -> DataFrame:
    """releases as gated listings, ten cards a page of a source's year; some second pages hold an address that no parser takes."""
    before, card, after = CARDS["notified_gated"]
    year = F.year("publish_date").cast("long")
    place = F.row_number().over(Window.partitionBy("slug", year).orderBy("release_id")) - 1
    text = F.lit(card)
    for name, value in (("{date}", F.col("date_text")), ("{id}", F.col("release_id").cast("string")), ("{title}", F.col("title"))):
        text = F.replace(text, F.lit(name), value)
    r = v.releases(spark, sf).withColumns({"year": year, "page": F.floor(place / 10).cast("long"), "card": text})
    pages = r.groupBy("slug", "year", "page").agg(F.array_sort(F.collect_list(F.struct("release_id", "card"))).alias("cards"), F.first("ticker", ignorenulls=True).alias("ticker"))
    broken = F.when((F.col("page") == 1) & ((F.substring("slug", 2, 9).cast("int") + F.col("year")) % 5 == 0), "<a href='/news-releases/news-release-details/[x'>fine</a><a href='http://[x/news-releases/news-release-details/y'>broken</a>").otherwise("")
    html = F.concat(F.lit(before), F.array_join("cards.card", ""), F.lit(after), broken)
    none = F.lit(None).cast("string").alias("segment")
    return pages.select("slug", "ticker", "year", "page", F.lit("https://ir.example.com/news").alias("base_url"), html.alias("html"), F.lit("notified_gated").alias("platform"), none)


@query("""SELECT slug, y AS year, page, title, publish_date, false AS failed FROM cards WHERE y BETWEEN 1996 AND 1999 AND NOT EXISTS (SELECT 1 FROM bad b WHERE b.slug = cards.slug AND b.y = cards.y)
  UNION ALL SELECT slug, y, 1, NULL, NULL, true FROM bad WHERE y BETWEEN 1996 AND 1999""", v.RELEASES, """
cards AS (SELECT slug, CAST(year(publish_date) AS BIGINT) AS y, title, publish_date, (row_number() OVER (PARTITION BY slug, year(publish_date) ORDER BY release_id) - 1) // 10 AS page FROM releases),
bad AS (SELECT DISTINCT slug, y FROM cards WHERE page = 1 AND (CAST(substr(slug, 2) AS INT) + y) % 5 = 0)""")
def gated_years(spark, sf):
    """A page that cannot be read fails its year alone."""
    made = extract.gated_years(gated_pages(spark, sf), {1996, 1997, 1998, 1999})
    return made.select("slug", "year", "page", "title", "publish_date", F.col("error").isNotNull().alias("failed"))


#: Cards of a rich listing: nested, with a second link, with a date in the headline, and with the date in the label alone.
RICH = (
    "<li><div><span>{date}</span><div><a href='/news/news-details/2026/{id}/default.aspx'>{title}</a></div></div><a href='/news/news-details/2026/{id}/default.aspx'>Continue</a></li>",
    "<article><section><p>{date}</p><p>Sales Releases</p><div><ul><li><a href='/news/news-details/2026/{id}/'><b> {title} </b></a></li></ul></div></section></article>",
    "<div><div><time>{date}</time></div><div><div><a href='/news/news-details/2026/{id}'>{title} on April 9, 2031</a></div></div></div>",
    "<div><div><a href='/news/news-details/2026/{id}' aria-label='Results of January 27, 2026, {plain}'>{title}</a></div></div>",
)


@query("""SELECT release_id // 20 AS page_id, title || CASE release_id % 4 WHEN 2 THEN ' on April 9, 2031' ELSE '' END AS title,
  'https://ir.example.com/news/news-details/2026/' || release_id || CASE release_id % 4 WHEN 0 THEN '/default.aspx' WHEN 1 THEN '/' ELSE '' END AS url, publish_date, CASE release_id % 4 WHEN 1 THEN 'Sales Releases' ELSE '' END AS category FROM releases""", v.RELEASES)
def containment_items(spark, sf):
    """releases in rich listings of twenty cards, read by the stretches of their nodes."""
    k = F.col("release_id")
    text = F.element_at(F.array(*map(F.lit, RICH)), (k % len(RICH) + 1).cast("int"))
    for name, value in (("{date}", F.col("date_text")), ("{plain}", F.date_format("publish_date", "MMMM d, yyyy")), ("{id}", k.cast("string")), ("{title}", F.col("title"))):
        text = F.replace(text, F.lit(name), value)
    cards = v.releases(spark, sf).select(F.floor(k / 20).cast("long").alias("page_id"), F.struct("release_id", text.alias("card")).alias("c")).groupBy("page_id").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    page = F.concat(F.lit("<html><nav><a href='/news'>News</a></nav><main><section>"), F.array_join("cs.card", ""), F.lit("</section></main></html>"))
    made = containment.q4_items(cards.select("page_id", F.lit("https://ir.example.com/news").alias("base_url"), page.alias("html")))
    return made.select("page_id", "title", "url", "publish_date", "category")


@query("""SELECT page_id, CASE WHEN k % 4 <> 0 THEN 'https://ir.example.com/list?page=2' END AS next_url, CASE k % 4 WHEN 0 THEN NULL WHEN 2 THEN greatest(2, k % 7 + 1) ELSE k % 7 + 1 END AS last_page,
  CASE WHEN form THEN '10,50,100' ELSE '' END AS sizes, CASE WHEN form THEN '2024,2025' ELSE '' END AS years, CASE WHEN form THEN CASE k % 2 WHEN 0 THEN '2024' ELSE '_none' END END AS shown,
  CASE WHEN form AND k % 4 > 0 THEN w || '_items_per_page=' || [50, 50, 100][k % 4] || '&' || w || '_year[value]=_none&op=Filter&' || w || '_widget_id=' || w || '&form_id=f&form_build_id=b' || k ELSE '' END AS size_query,
  CASE WHEN form AND (k % 5 > 0 OR k % 2 = 0) THEN w || '_year[value]=' || CASE WHEN k % 5 > 0 THEN '2025' ELSE '_none' END || '&op=Filter&' || w || '_widget_id=' || w || '&form_id=f&form_build_id=b' || k ELSE '' END AS year_query,
  CASE WHEN k % 6 = 0 THEN 'event-details' ELSE 'news-details' END AS segment, 1 + CAST(k % 2 AS BIGINT) AS leads
  FROM (SELECT page_id, page_id AS k, page_id % 3 <> 0 AS form, 'w' || (page_id % 5) AS w FROM pages)""")
def listing_widgets(spark, sf):
    """Each page's id as a listing with a pager, a page-size and a year widget, detail links of two kinds and leads."""
    k = F.col("page_id")
    w = F.concat(F.lit("w"), (k % 5).cast("string"))
    sel = lambda on: F.when(on, " selected").otherwise("")
    form = F.concat(
        F.lit("<form><select name='"), w, F.lit("_year[value]'><option value='_none'"), sel(k % 2 == 1), F.lit(">All</option><option value='2025'>2025</option><option value='2024'"), sel(k % 2 == 0), F.lit(">2024</option></select><select name='"), w,
        F.lit("_items_per_page'><option>100</option><option value='10'>ten</option><option value='50'>50</option><option value='all'>All</option></select><input name='form_id' value='f'><input name='form_build_id' value='b"), k.cast("string"), F.lit("'></form>"),
    )
    last = F.concat(F.lit("<a href='?page="), (k % 7 + 1).cast("string"), F.when(k % 4 == 2, "'>").otherwise("' title='Go to last page'>"), F.lit("x</a>"))
    pager = F.concat(F.lit("<a href='?page=1'>1</a><a href='#'>next</a>"), last, F.lit("<a rel='next' href='/list?page=2'>more</a>"))
    links = F.when(k % 6 == 0, "<a href='/x/event-details/2026/a'>e</a>").otherwise("<a href='/x/news-details/2026/a'>n</a><a href='/x/event-details/2026/b'>e</a><a href='/x/news-details/2026/c'>n</a>")
    leads = F.concat(F.lit("<a href='/about'>About</a><a href='/Press-Releases/all'>All</a>"), F.when(k % 2 == 1, "<a href='/investors'>Investors</a><a href='/investors'>again</a>").otherwise(""))
    html = F.concat(F.when(k % 3 != 0, form).otherwise(""), F.when(k % 4 != 0, pager).otherwise(""), links, leads)
    pages = v.table(spark, sf, "pages").select("page_id", F.lit("https://ir.example.com/news").alias("base_url"), html.alias("html"), F.element_at(F.array(*map(F.lit, (5, 50, 70, 1000))), (k % 4 + 1).cast("int")).alias("size"), F.array(F.when(k % 5 == 0, 2030).otherwise(2025)).alias("years"))
    made = extract.listing_facts(pages, "page_id")
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return made.select("page_id", "next_url", "last_page", joined("sizes"), joined("years"), "shown", "size_query", "year_query", "segment", F.size("leads").cast("long").alias("leads"))


#: Cards whose link says no more than to read on: the headline is a heading, has a class that tells, or is the card's first text that is no date.
READ_ON = (
    "<li><div><h3>{title}</h3><p>{date}</p></div><p><a href='/news-releases/news-release-details/{id}'>Read more</a></p></li>",
    "<li><p>{date}</p><span class='card-Title'>{title}</span><a href='/news-releases/news-release-details/{id}'>Learn More</a></li>",
    "<li><span>{date}</span><p>{title}</p><b><a href='/news-releases/news-release-details/{id}'>Find out more</a></b></li>",
    "<li><a href='/news-releases/news-release-details/{id}'><time datetime='{iso}T09:00'>x</time><h5>{title}</h5>{date}</a></li>",
)


@query("SELECT release_id // 25 AS page, title, 'https://ir.example.com/news-releases/news-release-details/' || release_id AS url, publish_date FROM releases", v.RELEASES)
def extract_items_read_on(spark, sf):
    k = F.col("release_id")
    text = F.element_at(F.array(*map(F.lit, READ_ON)), (k % len(READ_ON) + 1).cast("int"))
    for name, value in (("{date}", F.col("date_text")), ("{iso}", F.col("publish_date").cast("string")), ("{id}", k.cast("string")), ("{title}", F.col("title"))):
        text = F.replace(text, F.lit(name), value)
    cards = v.releases(spark, sf).select(F.floor(k / 25).cast("long").alias("page"), F.struct("release_id", text.alias("card")).alias("c")).groupBy("page").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    page = F.concat(F.lit("<main><ul>"), F.array_join("cs.card", ""), F.lit("</ul></main>"))
    none = F.lit(None).cast("string")
    pages = cards.select(F.lit("s").alias("slug"), F.lit("S").alias("ticker"), "page", F.lit("https://ir.example.com/news").alias("base_url"), page.alias("html"), F.lit("notified").alias("platform"), none.alias("segment"))
    return extract.extract_items(pages).select("page", "title", "url", "publish_date")


@query("SELECT release_id, publish_date AS detail_date, CASE WHEN release_id % 2 = 0 THEN '9:05 AM EST' ELSE '' END AS detail_time FROM releases", v.RELEASES)
def detail_dates_by_platform(spark, sf):
    """Notified pages tell the date in a labelled element, behind another date in the text; Q4 pages at the beginning of the text."""
    k = F.col("release_id")
    labelled = F.concat(F.lit("<body><p>Since May 1, 1990.</p><p class='release-date'>"), F.col("date_text"), F.lit("</p><article>9:05 AM EST</article></body>"))
    plain = F.concat(F.lit("<body><h1>Title</h1><div>"), F.col("date_text"), F.lit("</div><p class='date'>1990-05-01</p></body>"))
    pages = v.releases(spark, sf).select(k.cast("string").alias("url"), F.when(k % 2 == 0, labelled).otherwise(plain).alias("html"), F.when(k % 2 == 0, "notified").otherwise("q4").alias("platform"))
    made = extract.detail_dates(pages)
    return made.select(F.col("url").cast("bigint").alias("release_id"), "detail_date", "detail_time")
