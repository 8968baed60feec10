from datetime import date

import pytest
from noticeloom.functions import dates, html, urls
from pyspark.sql import functions as F

CASES = [
    ("MENLO PARK, Calif. , Jan. 02, 2026 (WIRE)", date(2026, 1, 2), "Jan. 02, 2026"),
    ("CITY, Calif., Feb. 19, 2026 news", date(2026, 2, 19), "Feb. 19, 2026"),
    ("Results on February 10, 2026 and Feb. 11, 2026", date(2026, 2, 10), "February 10, 2026"),
    ("06/18/2026 x", date(2026, 6, 18), "06/18/2026"),
    ("2026-06-18 x", date(2026, 6, 18), "2026-06-18"),
    ("6 August, 2026", date(2026, 8, 6), "6 August, 2026"),
    ("06 Aug 2026", date(2026, 8, 6), "06 Aug 2026"),
    ("Jun 18, 2026", date(2026, 6, 18), "Jun 18, 2026"),
    ("2026-01-01 then Jan 5, 2026", date(2026, 1, 5), "Jan 5, 2026"),
    ("Feb 30, 2026 then Mar 1, 2026", date(2026, 3, 1), "Mar 1, 2026"),
    ("May 6,2026", None, ""),
    ("nothing date-like here", None, ""),
    ("", None, ""),
]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text,day,raw", CASES)
def test_parse_date(spark, text, day, raw):
    got = one(spark, dates.parse_date(F.lit(text)))
    assert (got["date"], got["raw"]) == (day, raw)
    assert html.find_date(text) == (day, raw)


def test_trailing_date(spark):
    text = "Results on January 27, 2026, January 13, 2026"
    assert one(spark, dates.parse_trailing_date(F.lit(text)))["date"] == date(2026, 1, 13)
    assert html.find_date(text, last=True)[0] == date(2026, 1, 13)


def test_short_date_and_time(spark):
    text = "12/09/25 - 3:35 PM EST"
    assert one(spark, dates.parse_short_date(F.lit(text)))["date"] == date(2025, 12, 9)
    assert one(spark, dates.parse_time(F.lit(text))) == "3:35 PM EST"
    assert one(spark, dates.parse_short_date(F.lit("13/41/25 1/2/25")))["date"] is None
    assert one(spark, dates.parse_time(F.lit("05:30 AM"))) == ""


@pytest.mark.parametrize("time,key", [("12:15 am ET", (0, 0, 15)), ("12:15 pm ET", (0, 12, 15)), ("4:30 am EDT", (0, 4, 30)), ("05:30 AM", (1, 0, 0)), ("", (1, 0, 0))])
def test_time_order(spark, time, key):
    assert tuple(one(spark, dates.time_sort_key(F.lit(time)))) == key


def test_null_text(spark):
    null = F.lit(None).cast("string")
    assert one(spark, dates.parse_date(null))["date"] is None
    assert one(spark, dates.parse_time(null)) == ""


@pytest.mark.parametrize("base,path", [("https://x.example.com", "news"), ("https://x.example.com/", "news"), ("https://x.example.com", "/news"), ("https://x.example.com///", "//news")])
def test_join_path(spark, base, path):
    assert one(spark, urls.join_path(F.lit(base), F.lit(path))) == "https://x.example.com/news"


@pytest.mark.parametrize("href,full", [("a", "https://x.example.com/p/a"), ("../a", "https://x.example.com/a"), ("/a", "https://x.example.com/a"), ("//y.example.com/a", "https://y.example.com/a"), ("?q=1", "https://x.example.com/p/q.html?q=1"), ("#f", "https://x.example.com/p/q.html#f"), ("http://z.example.com", "http://z.example.com"), ("./b", "https://x.example.com/p/b")])
def test_resolve(spark, href, full):
    assert one(spark, urls.resolve(F.lit("https://x.example.com/p/q.html"), F.lit(href))) == full


@pytest.mark.parametrize("url,known", [("/news-releases/press-releases/rss", True), ("/press-releases/rss", False), ("/press-releases/rss-feed-integration-announced", True), ("/news/news/press-releases/x", True)])
def test_feed_is_no_release(spark, url, known):
    assert one(spark, urls.is_detail(F.lit(url), "notified")) == known


@pytest.mark.parametrize("name,slug", [("Acme Holdings, Inc.", "acme"), ("Foo & Bar Co. (Old)", "foo-bar"), ("Plain", "plain")])
def test_slug(spark, name, slug):
    assert one(spark, urls.slugify(F.lit(name))) == slug
