"""Page shapes that the extractors must read, rebuilt with neutral names."""

from datetime import date

import pyarrow as pa
import pytest
from noticeloom.functions import html
from noticeloom.operators import extract

BASE = "https://ir.example.com/news"


def told(text, platform, **options):
    return [(t, u, d) for t, u, d, *_ in html.items_of(text, BASE, platform, **options)]


def test_q4_card_with_second_link():
    page = """<div class="list"><div class="card"><div class="d">May 6, 2026</div>
      <div><a href="/news/news-details/2026/One/default.aspx" aria-label="Report, June 1, 2025">Report One</a></div>
      <a href="/news/news-details/2026/One/default.aspx">Continue</a></div></div>"""
    assert told(page, "q4") == [("Report One", "https://ir.example.com/news/news-details/2026/One/default.aspx", date(2026, 5, 6))]


def test_q4_label_trails():
    page = '<div><div><a href="/news/news-details/2026/X" aria-label="Results on January 27, 2026, January 13, 2026">Results</a></div></div>'
    assert told(page, "q4")[0][2] == date(2026, 1, 13)


def test_q4_stops_at_siblings_and_ignores_headline_date():
    page = """<section><article><span>Mar 2, 2026</span><a href="/news/news-details/2026/A">Meeting on April 9, 2026</a></article>
      <article><a href="/news/news-details/2026/B">Other thing</a></article></section>"""
    assert [x[2] for x in told(page, "q4")] == [date(2026, 3, 2), None]


def test_q4_category():
    page = '<ul><li><span>Jan 5, 2026</span> <span>Sales Releases</span> <a href="/news/news-details/2026/A">Sales</a></li></ul>'
    assert html.items_of(page, BASE, "q4")[0][5] == "Sales Releases"


def test_investorroom_menu_and_card():
    page = """<nav><ul><li><a href="/about-us-and-our-long-history">About us and our long history</a></li><li><a href="/careers-and-people-of-ours">Careers and people of ours</a></li></ul></nav>
      <div class="item"><div>Jan 14, 2026</div><div>9:00 AM ET</div><a href="/a-new-storage-portfolio-is-here">A new storage portfolio is here on February 17, 2026</a>
      <a href="/a-new-storage-portfolio-is-here?asPDF">PDF</a></div>"""
    items = html.items_of(page, BASE, "investorroom")
    assert [(i[1], i[2], i[4]) for i in items] == [("https://ir.example.com/a-new-storage-portfolio-is-here", date(2026, 1, 14), "9:00 AM ET")]


def test_investorroom_date_from_address():
    items = html.items_of('<p><a href="/2026-04-21-Big-news">Big news</a></p>', BASE, "investorroom")
    assert items[0][2:4] == (date(2026, 4, 21), "2026-04-21")


def test_notified_card_in_one_link():
    page = """<div><a href="/news-releases/news-release-details/a"><span>2 min</span><time datetime="2026-02-03T00:00">Feb 3</time><h5>First headline</h5><p>On March 1, 2027</p></a>
      <a href="/news-releases/news-release-details/b"><time datetime="2026-02-01">Feb 1</time><h5>Second headline</h5></a></div>"""
    assert told(page, "notified") == [
        ("First headline", "https://ir.example.com/news-releases/news-release-details/a", date(2026, 2, 3)),
        ("Second headline", "https://ir.example.com/news-releases/news-release-details/b", date(2026, 2, 1)),
    ]


def test_notified_feed_and_call_to_action():
    page = """<div><article><h3>Real headline</h3><p>Jun 18, 2026</p><a href="/press-releases/detail/1">Read more</a></article>
      <article><h3>Next headline</h3><p>Jun 17, 2026</p><a href="/press-releases/detail/2">Read more</a></article></div><a href="/press-releases/rss">RSS</a>"""
    assert [(t, d) for t, _, d in told(page, "notified")] == [("Real headline", date(2026, 6, 18)), ("Next headline", date(2026, 6, 17))]


def test_gated_table_row():
    page = '<table><tr><td>12/09/25 - 3:35 PM EST</td><td><a href="/news-releases/news-release-details/x">Sales on Jan 1, 2027</a></td></tr></table>'
    assert html.items_of(page, BASE, "notified_gated")[0][2:5] == (date(2025, 12, 9), "12/09/25", "3:35 PM EST")


def test_investis_row_and_address():
    page = '<table><tr><td>Date <span>Dec 10, 2025</span></td><td><a href="/news-releases/2025/12-10-2025-1">Opening</a></td></tr></table><a href="/news-releases/2025">2025</a>'
    assert told(page, "investis") == [("Opening", "https://ir.example.com/news-releases/2025/12-10-2025-1", date(2025, 12, 10))]
    assert html.items_of('<a href="/news-releases/2025/12-10-2025-14">Opening</a>', BASE, "investis")[0][2:4] == (date(2025, 12, 10), "(from URL)")


def test_bny_cards_and_fallback():
    page = """<div class="list-item-tile"><time class="list-item-header__date">June 2, 2026</time><div class="title"><a href="/x/a.html"><h3>Title A</h3></a></div></div>
      <a href="?page=2">Next</a>"""
    assert told(page, "aem_bny") == [("Title A", "https://ir.example.com/x/a.html", date(2026, 6, 2))]
    bare = '<div><p>June 2, 2026</p><a href="/x/b.html">A headline that is long enough</a></div><a href="/x/c.html">Short</a>'
    assert told(bare, "aem_bny") == [("A headline that is long enough", "https://ir.example.com/x/b.html", date(2026, 6, 2))]


def test_cme_list():
    page = '<ul><li><a href="/nav">Nav</a></li></ul><ul id="cmeSearchFilterResults"><li><span class="cmeBrowseAllDate">6 August, 2026</span><a href="/media/2026/8/06/x.html">Card</a></li></ul>'
    assert told(page, "aem_cme") == [("Card", "https://ir.example.com/media/2026/8/06/x.html", date(2026, 8, 6))]


YEARS = '<form><input name="form_id" value="f"><input name="form_build_id" value="b"><select name="w_year[value]"><option value="_none">All</option><option value="2025">2025</option><option value="2026" selected>2026</option></select></form>'


def test_widgets():
    assert html.year_widget(YEARS)["default"] == "2026"
    assert html.year_params(YEARS, {2025}) == [("w_year[value]", "2025"), ("op", "Filter"), ("w_widget_id", "w"), ("form_id", "f"), ("form_build_id", "b")]
    assert html.year_params(YEARS, None)[0] == ("w_year[value]", "_none")
    assert html.year_params("<p>", {2025}) == []
    sizes = '<select name="w_items_per_page"><option value="10">10</option><option value="50">50</option></select>'
    assert html.size_params(sizes, 100)[0] == ("w_items_per_page", "50")
    assert html.size_params(sizes, 5) == []


def test_pager():
    page = '<a href="?page=3">4</a><a href="?page=9" title="Go to last page">last</a><a aria-label="Next page" href="/p2">x</a>'
    assert html.last_page(page) == 9
    assert html.next_page(page, BASE) == "https://ir.example.com/p2"


def test_detail_page():
    assert html.detail_date('<div class="news-date">May 6, 2026</div>')[0] == date(2026, 5, 6)
    assert html.detail_date("<article>CITY, May 6, 2026 news</article>")[0] == date(2026, 5, 6)
    assert html.detail_date(None) == (None, "")


def test_segment():
    assert html.details_segment('<a href="/x/press-release-details/2026/a"><a href="/x/press-release-details/2026/b"><a href="/x/event-details/2026/c">') == "press-release-details"
    assert html.details_segment("<a>") is None


def test_frame_and_table_function(spark):
    page = '<ul><li><span>Jan 5, 2026</span><a href="/news/news-details/2026/A">Sales</a></li></ul>'
    rows = [("s", "T", 0, BASE, page, "q4", None), ("s", "T", 1, BASE, None, "q4", None), ("s", "T", 2, BASE, "", "other", None)]
    pages = spark.createDataFrame(rows, "slug string, ticker string, page int, base_url string, html string, platform string, segment string")
    got = extract.extract_items(pages).collect()
    assert [(r["slug"], r["page"], r["ordinal"], r["title"], r["publish_date"]) for r in got] == [("s", 0, 0, "Sales", date(2026, 1, 5))]
    extract.register(spark)
    pages.createOrReplaceTempView("listing_pages")
    assert spark.sql("SELECT i.title FROM listing_pages, LATERAL extract_items(html, base_url, platform, segment) i").first()["title"] == "Sales"


@pytest.mark.parametrize("bad", ["<", "<a href=x", "<table><tr><td><a href='/press-releases/a/b'>x", "&#x0;", "<li><li><p><p>"])
def test_broken_markup(bad):
    for platform in html.EXTRACTORS:
        html.items_of(bad, BASE, platform)


def test_detail_time_is_the_articles():
    menu = "<nav>" + "<a href='/x'>Open 9:00 AM EST</a> " + "menu " * 600 + "</nav>"
    for tag in ("article", "main"):
        assert html.detail_time(f"<html><body>{menu}<{tag}>CITY, May 6, 2026, 4:05 PM EDT news</{tag}></body></html>") == html.detail_time("<p>4:05 PM EDT</p>") != ""
    assert html.detail_time(f"<html><head><title>{'title ' * 400}</title></head><body>At 4:05 PM EDT</body></html>") == html.detail_time("<p>4:05 PM EDT</p>")
    assert html.detail_time(None) == ""


def test_headings_as_written_but_for_ampersands(spark):
    pages = ["<h1 class='x'> A &amp;&amp B &quot;c&quot; </h1><h1>two</h1>", "<h1><b>no</b></h1>\n<h1>yes\n</h1>", "<h1>&amp;amp;</h1>", "<p>none</p>", "", None]
    made = {r["page_id"]: r["title"] for r in extract.headings(spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")).collect()}
    assert made == {0: "A &&amp B &quot;c&quot;", 1: "yes\n", 2: "&amp;", 3: "", 4: "", 5: None}


def listing(spark, rows):
    return spark.createDataFrame([(slug, "T", year, page, BASE, text, platform, None) for slug, year, page, text, platform in rows], "slug string, ticker string, year long, page long, base_url string, html string, platform string, segment string")


def card(n, day="3/4/25"):
    return f"<tr><td>{day}</td><td><a href='/news-releases/news-release-details/r{n}'>Release {n}</a></td></tr>"


BROKEN = "<a href='http://[x/news-releases/news-release-details/y'>broken</a>"


def test_a_broken_page_fails_its_year_alone(spark):
    pages = listing(spark, [
        ("a", 2024, 0, f"<table>{card(1)}{card(2)}</table>", "notified_gated"),
        ("a", 2024, 1, f"<table>{card(2)}{card(3)}</table>", "notified_gated"),
        ("a", 2024, 2, f"<table>{card(3)}</table>", "notified_gated"),  # nothing new: the walk ends
        ("a", 2024, 3, BROKEN, "notified_gated"),  # and does not come here
        ("a", 2025, 0, f"<table>{card(4)}</table>", "notified_gated"),
        ("a", 2025, 1, f"<table>{card(5)}</table>{BROKEN}", "notified_gated"),
        ("b", 2025, 0, f"<table>{card(6)}</table>", "notified_gated"),
        ("b", 2025, 1, "", "notified_gated"),
        ("b", 2025, 2, f"<table>{card(7)}</table>", "notified_gated"),  # behind an empty page
        ("b", 2023, 0, None, "notified_gated"),
    ])
    made = extract.gated_years(pages, {2023, 2024, 2025}).collect()
    assert sorted((r["slug"], r["year"], r["page"], r["title"]) for r in made if r["error"] is None) == [("a", 2024, 0, "Release 1"), ("a", 2024, 0, "Release 2"), ("a", 2024, 1, "Release 3"), ("b", 2025, 0, "Release 6")]
    assert [(r["slug"], r["year"], r["page"], r["error"].split(":")[0]) for r in made if r["error"]] == [("a", 2025, 1, "ValueError")]
    only = extract.gated_years(pages, today=date(2024, 6, 1)).collect()
    assert {r["year"] for r in only} == {2024} and len(only) == 3
    assert extract.gated_years(pages.limit(0), {2024}).count() == 0
    with pytest.raises(Exception, match="Invalid IPv6"):
        extract.extract_items(pages).collect()


def test_a_year_of_many_pages_is_read_to_its_end(spark):
    pages = listing(spark, [("a", 2024, i, f"<table>{card(i)}</table>", "notified_gated") for i in range(130)])
    assert sorted(r["page"] for r in extract.gated_years(pages, {2024}).collect()) == list(range(130))
    assert sorted(r["page"] for r in extract.gated_years(pages, {2024}, cap=7).collect()) == list(range(7))


def test_pages_leave_python_in_small_batches(spark):
    """What a task holds does not grow with the pages that it gets: rows go out after every few pages."""
    rows = [("a", 2024, i, f"<table>{card(2 * i)}{card(2 * i + 1)}</table>", "notified_gated") for i in range(500)]
    made = extract.try_items(listing(spark, rows).coalesce(1), "page")
    assert [b.num_rows for b in extract.small([pa.RecordBatch.from_arrays([pa.array(range(500))], ["x"])])] == [64] * 7 + [52]
    assert sorted((r["page"], r["ordinal"]) for r in made.collect()) == [(i, k) for i in range(500) for k in range(2)]


def test_a_platform_of_ones_own(spark):
    """Added from outside, with a link predicate and a date of its own, beside another platform in one plan."""

    def when(page, a):
        stamp = page.attrs[a].get("data-day", "")
        return (date.fromisoformat(stamp), stamp, "") if stamp else (None, "", "")

    own = "<ul><li>May 1, 2020 <a href='/blog/one' data-day='2026-02-03'>Post one</a></li><li><a href='/blog/two'>Post two</a></li><li><a href='/about'>About</a></li></ul>"
    pages = listing(spark, [("a", 2026, 0, own, "blog"), ("b", 2026, 0, f"<table>{card(1)}</table>", "notified_gated"), ("c", 2026, 0, own, "plain_blog")])
    assert {r["slug"] for r in extract.extract_items(pages).collect()} == {"b"}
    extract.register_extractor("blog", html.link_extractor(lambda href: href.startswith("/blog/"), when))
    extract.register_extractor("plain_blog", html.link_extractor(lambda href: href.startswith("/blog/")))
    try:
        made = {(r["slug"], r["title"]): r["publish_date"] for r in extract.extract_items(pages).collect()}
        extract.register(spark, "items_of_all")
        pages.createOrReplaceTempView("own_pages")
        lateral = spark.sql("SELECT slug, i.title FROM own_pages, LATERAL items_of_all(html, base_url, platform, segment) i").collect()
    finally:
        extract.unregister_extractor("blog")
        extract.unregister_extractor("plain_blog")
    assert made == {("a", "Post one"): date(2026, 2, 3), ("a", "Post two"): None, ("b", "Release 1"): date(2025, 3, 4), ("c", "Post one"): date(2020, 5, 1), ("c", "Post two"): None}
    assert sorted(map(tuple, lateral)) == sorted(made)
    with pytest.raises(ValueError, match="q4"):
        extract.register_extractor("q4", html.q4)
