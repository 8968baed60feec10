"""The end of a run, day files, reports as files, and addresses and tables of pages."""

import json
from urllib.parse import urljoin

import pytest
from noticeloom.functions import html, urls
from noticeloom.plans import output, reports
from noticeloom.sources import catalog, store
from pyspark.sql import functions as F

ITEM = "slug string, ticker string, title string, url string, publish_date date, publish_time string"


def items(spark, *rows):
    made = spark.createDataFrame([("s", t, n, u, d, c) for t, n, u, d, c in rows], ITEM.replace("date date", "date string"))
    return made.withColumn("publish_date", F.col("publish_date").cast("date"))


def files(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*.csv"))


def test_day_files_are_written_read_and_replaced(spark, tmp_path):
    root = f"{tmp_path}/data"
    rows = items(spark, ("T", 'b "quoted"', "u2", "2026-01-05", "9:00 AM ET"), ("T", "a\nline", "u1", "2026-01-05", ""), (None, "c", "u3", "2025-12-31", ""))
    assert store.write_day_files(rows, root) == 2
    assert files(tmp_path / "data") == ["2025/2025-12-31.csv", "2026/2026-01-05.csv"]
    assert [r["url"] for r in store.read_day(spark, root, "2026-01-05").collect()] == ["u2", "u1"]  # a time with a zone comes first
    assert store.read_day(spark, root, "2026-01-06").count() == 0
    assert store.write_day_files(items(spark, ("T", "new", "u9", "2026-01-05", "")), root) == 1
    told = {(r["url"], r["title"]) for r in store.read_days(spark, root).collect()}
    assert told == {("u9", "new"), ("u3", "c")}
    assert store.write_day_files(rows.limit(0), root) == 0


def test_finalize(spark, tmp_path):
    root, path = f"{tmp_path}/data", f"{tmp_path}/out/items.json"
    got = items(spark, ("T", "old", "u0", "2024-01-01", ""), ("T", "é new", "u1", "2026-01-05", ""), (None, "newer", "u2", "2026-01-06", ""), ("T", "no date", "u3", None, ""))
    dry = output.finalize(got, root, years={2026}, form="both", json_path=path, dry_run=True)
    assert dry.summary.first()["rows_added"] == 2 and dry.files == 0 and not (tmp_path / "out").exists() and not (tmp_path / "data").exists()
    kept = output.finalize(got, root, years={2026}, form="both", json_path=path, write=False)
    assert kept.summary is None and [r["url"] for r in kept.items.collect()] == ["u1", "u2"] and not (tmp_path / "data").exists()
    assert [r["title"] for r in json.loads((tmp_path / "out/items.json").read_text())] == ["é new", "newer"]
    made = output.finalize(got, root, years={2026})
    assert made.files == 2 and files(tmp_path / "data") == ["2026/2026-01-05.csv", "2026/2026-01-06.csv"]
    assert made.preview.count() == 2 and made.summary.first()["files_written"] == 2
    again = output.finalize(got, root, years={2026})
    assert again.files == 0 and tuple(again.summary.first())[:3] == (0, 0, 0)
    with pytest.raises(ValueError):
        output.finalize(got, root, form="json")


def test_one_row_upsert(spark):
    old = items(spark, ("T", "a", "u1", "2026-01-05", ""), ("T", "b", "u2", "2026-01-05", ""))
    for row, action, n in ((("T", "c", "u1", "2026-01-05", ""), "Updated", 2), (("T", "c", "u3", "2026-01-05", ""), "Added", 3)):
        made, told = store.upsert_row(old, items(spark, row))
        assert told == action and made.count() == n
    assert store.upsert_row(old.limit(0), items(spark, ("T", "c", "u3", "2026-01-05", "")))[1] == "Created"


def test_reports_as_files(spark, tmp_path):
    table = spark.createDataFrame([("q4", 4, 1, 3, 25.0), ("x", 1, 1, None, 100.0)], "platform string, total long, configured long, missing long, percentage_done double")
    missing = spark.createDataFrame([("b", "q4"), ("a", "q4")], "slug string, platform string")
    output.write_coverage(table, missing, f"{tmp_path}/summary.txt", f"{tmp_path}/missing.csv")
    lines = (tmp_path / "summary.txt").read_text().splitlines()
    assert len(lines) == 3 and lines[-1].split() == ["TOTAL", "5", "2", "3", "40.0%"]
    assert (tmp_path / "missing.csv").read_text() == "slug,platform\na,q4\nb,q4\n"
    assert reports.text_table(missing.orderBy("slug"), "slug", "platform") == ["slug  platform", "----  --------", "a     q4", "b     q4"]


def test_preview_with_category(spark):
    rows = items(spark, ("T", "a", "u1", "2026-01-05", ""), ("T", "b", "u2", "2026-01-05", "")).withColumn("category", F.when(F.col("url") == "u1", "Sales"))
    assert {r["line"] for r in reports.preview(rows, "category").collect()} == {"2026-01-05  a [Sales]", "2026-01-05  b"}


BASES = ["https://h.example.com", "https://h.example.com/", "https://h.example.com/a/b/c?x=1#f", "https://h.example.com/a/b/"]
HREFS = ["x", "./x", "../x", "../../x/../y", "../../../x", "x/..", "x/.", ".", "..", "/x/./y/../z", "/..", "?q=../a", "#g", "", "//o.example.com/x", "http://o.example.com/a/../b", "x/y/", "/x//y", "x?u=a/../b#c", "mailto:a@b.c"]


def test_addresses_resolve_as_the_library_does(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    got = spark.createDataFrame(rows, "b string, h string").select("b", "h", urls.resolve(F.col("b"), F.col("h")).alias("u")).collect()
    assert [(r["b"], r["h"], r["u"]) for r in got] == [(b, h, urljoin(b, h)) for b, h in rows]


def test_first_table_and_leads():
    page = "<p>x</p><table><tr><th>Symbol</th><th>Name</th></tr><tr><td> BRK.B </td><td>B<table><tr><td>inner</td></tr></table></td></tr><tr><td>A</td></tr></table><table><tr><td>no</td></tr></table>"
    assert html.first_table(page) == [{"Symbol": "BRK.B", "Name": "B inner"}, {"Symbol": "A"}]
    assert html.first_table(None) == html.first_table("<p>no table</p>") == []
    links = "".join(f"<a href='/press-releases/{i % 50}'>t{i}</a>" for i in range(99)) + "<a href='/about'>about</a>"
    assert len(html.empty_page_leads(links)) == 40 and html.empty_page_leads("<a href='/about'>x</a>") == []


def test_arguments_and_selector():
    assert catalog.arguments("s", 2026, ("--a", "b"), True, "d") == ["--slug", "s", "--year", "2026", "--a", "b", "--dry-run", "--data-dir", "d"]
    assert catalog.arguments("s") == ["--slug", "s"]
    assert urls.details_selector() == "a[href*='/news-details/']" and urls.details_selector("x-details") == "a[href*='/x-details/']"


def test_dumps_are_named_by_year_and_page(spark, tmp_path):
    rows = [("a", 2026, 1, "<p>one</p>\n<p>two</p>"), ("a", 2026, 2, "<p>three</p>"), ("b", None, 1, "x"), ("b", None, 3, None)]
    output.write_dumps(spark.createDataFrame(rows, "slug string, year int, page int, html string"), f"{tmp_path}/dumps")
    made = {r["dump"]: r["value"].strip() for r in spark.read.text(f"{tmp_path}/dumps", wholetext=True).collect()}
    assert made == {"a-page_2026.html": rows[0][3], "a-page_2026_page2.html": rows[1][3], "b-page.html": "x"}
