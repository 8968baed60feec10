import pytest
from noticeloom.operators import flow
from noticeloom.plans import classify, queries, reports, views
from noticeloom.sources import store
from noticeloom.streaming import ingest
from pyspark.sql import functions as F

SCHEMA = "slug string, ticker string, title string, url string, publish_date date, publish_time string"


def frame(spark, rows):
    made = [("s", "T", t, u, d, "") for t, u, d in rows]
    return spark.createDataFrame(made, "slug string, ticker string, title string, url string, publish_date string, publish_time string").withColumn("publish_date", F.col("publish_date").cast("date")).withColumn("ordinal", F.monotonically_increasing_id())


D = "2026-01-05"


@pytest.mark.parametrize(
    "old,new,changes,left",
    [
        ([], [("a", "u1", D)], ["added"], ["u1"]),
        ([("a", "u1", D)], [("a", "u1", D)], ["same"], []),
        ([("a", "u1", D)], [("b", "u1", D)], ["updated"], ["u1"]),
        ([("a", "u1", D), ("a", "u2", D)], [("b", "u1", D)], ["updated"], ["u1", "u2"]),
        ([("a", "u1", D)], [("a", "u2", D), ("a", "u2", D)], ["added", "added"], ["u1", "u2", "u2"]),
        ([("a", "u1", D)], [("a", "u1/", D)], ["added"], ["u1", "u1/"]),
        ([("a", "u1", D)], [("a", "u1", "2026-01-06")], ["added"], ["u1"]),
        ([("x", "u1", D), ("a", "u1", D)], [("a", "u1", D)], ["same"], []),
    ],
)
def test_upsert(spark, old, new, changes, left):
    old, new = frame(spark, old), frame(spark, new)
    assert sorted(r["change"] for r in store.classify(old, new).collect()) == changes
    assert sorted(r["url"] for r in store.merge(old, new).collect()) == left


def test_undated_rows_are_not_stored(spark):
    new = frame(spark, [("a", "u1", None), ("a", "u2", D)])
    assert [r["url"] for r in store.merge(frame(spark, []), new).collect()] == ["u2"]


def counts(spark, rows):
    return spark.createDataFrame(rows, "year long, slug string, ticker string, release_count long")


@pytest.mark.parametrize(
    "baseline,actual,want",
    [
        ([(2026, "a", "A", 2)], [(2026, "a", "A", 2)], []),
        ([(2026, "a", "A", 2)], [(2026, "a", "A", 3)], [("A", 2, 3, 1)]),
        ([(2026, "a", "A", 1), (2026, "n", "N", 5)], [(2026, "a", "A", 1)], [("N", 5, None, None)]),
        ([(2026, "a", "A", 1)], [(2026, "a", "A", 1), (2026, "n", "N", 1)], [("N", None, 1, None)]),
        ([(2026, "a", "A", 2)], [(2026, "a", "A2", 2)], [("A", 2, None, None), ("A2", None, 2, None)]),
        ([(2026, "a", None, 2)], [(2026, "a", None, 2)], []),
    ],
)
def test_mismatches(spark, baseline, actual, want):
    got = reports.count_mismatches(counts(spark, baseline), counts(spark, actual)).collect()
    assert [(r["ticker"], r["baseline_count"], r["actual_count"], r["diff"]) for r in got] == want


def test_csv_round_trip(spark, tmp_path):
    rows = frame(spark, [('quote " and, comma', "u1", D), ("line\nbreak", "u2", D), ("later", "u3", "2026-02-01")])
    store.write_days(rows.select(*store.COLUMNS), str(tmp_path / "days"))
    assert sorted(r["title"] for r in store.read_day_folders(spark, str(tmp_path / "days")).collect()) == ["later", "line\nbreak", 'quote " and, comma']


def test_no_day_files(spark, tmp_path):
    assert store.read_days(spark, str(tmp_path)).count() == 0


def test_baseline_columns(spark, tmp_path):
    (tmp_path / "b.csv").write_text("year,slug\n2026,a\n")
    with pytest.raises(ValueError, match="release_count, ticker"):
        store.read_baseline(spark, str(tmp_path / "b.csv"))


def test_stream_is_idempotent(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    incoming, root, state = (str(tmp_path / x) for x in ("in", "store", "state"))

    def arrive(rows):
        frame(spark, rows).select("slug", "ticker", "title", "url", F.col("publish_date").cast("string").alias("publish_date"), "publish_time").write.mode("append").parquet(incoming)

    arrive([("a", "u1", D), ("a", "u2", "2026-01-06")])
    ingest.ingest(spark, incoming, root, state)
    arrive([("b", "u1", D), ("c", "u3", D)])
    ingest.ingest(spark, incoming, root, state)
    ingest.ingest(spark, incoming, root, state)
    assert sorted((r["url"], r["title"]) for r in store.read_day_folders(spark, root).collect()) == [("u1", "b"), ("u2", "a"), ("u3", "c")]


def test_all_releases_are_streamed(spark, sf):
    """By brute force over every order: what comes in replaces its day's row of the same address, all other rows stay."""
    rows = [r.asDict() for r in views.releases(spark, sf).collect()]
    come = [r | {"title": r["title"] + (" (updated)" if r["release_id"] % 5 == 0 else "")} for r in rows if r["release_id"] % 3 != 1]
    come += [r | {"url": r["url"] + "-new"} for r in rows if r["release_id"] % 10 == 0]
    gone = {(r["publish_date"], r["url"]) for r in come}
    want = [r for r in rows if (r["publish_date"], r["url"]) not in gone] + come
    made = queries.QUERIES["stream_upsert_all"](spark, sf).collect()
    assert len(rows) > 300
    assert sorted((str(r["publish_date"]), r["url"], r["title"]) for r in made) == sorted((str(r["publish_date"]), r["url"], r["title"]) for r in want)


def test_years():
    assert flow.year_set() is None
    assert flow.year_set(start=2026, end=2024) == {2024, 2025, 2026}
    assert flow.year_set([2020], start=2022) == {2020, 2022}


def test_years_reach_the_scan(spark, tmp_path):
    frame(spark, [("a", "u1", D)]).write.parquet(str(tmp_path / "r"))
    plan = flow.filter_items(spark.read.parquet(str(tmp_path / "r")), {2026})._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(publish_date,2026-01-01)" in plan


def test_undated_stay_without_bounds(spark):
    items = frame(spark, [("b", "u1", D), ("a", "u2", None), ("c", "u3", "2026-01-06")])
    assert [r["url"] for r in flow.filter_items(items, limit=2).collect()] == ["u2", "u1"]
    assert [r["url"] for r in flow.filter_items(items, since="2026-01-06").collect()] == ["u3"]


PAGES = [
    ("<!-- Investis Sitecore common GTM -->", "investis"),
    ("<footer>Delivered by Investis</footer><a href='/news-releases/2026/07-15-2026-1'>x</a>", "investis"),
    ('<meta name="Generator" content="Drupal 10">investorroom', "notified"),
    ('<a href="/news/news-details/2026/x">', "q4"),
    ('<a href="/financial-releases/a/b">', "notified"),
    ('<img src="/content/dam/x.png">', "aem"),
    ("<p>nothing</p>", "unknown"),
    (None, "unknown"),
]


@pytest.mark.parametrize("page,platform", PAGES)
def test_platform(spark, page, platform):
    row = spark.createDataFrame([(page,)], "html string").select(classify.detect_platform(F.col("html")).alias("p")).first()
    assert row["p"] == platform


@pytest.mark.parametrize("platform,slug,strategy", [("notified", "tjx", "notified_gated"), ("q4", "x", "q4_ir"), ("aem", "bny", "aem_bny"), ("aem", "cme", "aem_cme"), ("aem", "x", "aem"), ("unknown", "x", "unknown")])
def test_strategy(spark, platform, slug, strategy):
    row = spark.range(1).select(classify.strategy_of(F.lit(platform), F.lit(slug)).alias("s"), classify.platform_of(F.lit(strategy)).alias("p")).first()
    assert tuple(row) == (strategy, platform)
