"""Walks as a stream and by probing give the rows of the walk over a whole table."""

import math
import random
from pathlib import Path

import pytest
from noticeloom.operators import flow, probe
from noticeloom.sources import store
from noticeloom.streaming import walk
from pyspark.sql import functions as F

ITEMS = "slug string, platform string, page long, ordinal long, url string, publish_date date"


def listings(spark, seed=1):
    """Listings from newest to oldest, with addresses that come again, undated items, and one that ends in repeats."""
    rng, rows = random.Random(seed), []
    for k, platform in enumerate(["q4", "investis", "investorroom", "notified", "q4"]):
        for page in range(60 if k < 3 else rng.randint(1, 30)):
            for i in range(3):
                n = page * 3 + i - (rng.randrange(5) if rng.random() < 0.3 else 0)
                n = 7 if k == 4 and page > 6 else n
                day = None if rng.random() < 0.1 else f"{2026 - page // 8}-0{rng.randint(1, 9)}-11"
                rows.append((f"s{k}", platform, page, page * 10 + i, f"https://x.example.com/{k}/{n}" + "/" * rng.randrange(2), day))
    return spark.createDataFrame(rows, ITEMS.replace("publish_date date", "day string")).withColumn("publish_date", F.col("day").cast("date")).drop("day")


def as_pages(items):
    return items.groupBy("slug", "platform", "page").agg(F.collect_list(F.struct("ordinal", "url", "publish_date")).alias("items"))


def expected(items, target_min):
    pages = flow.page_years(items, "slug", "platform", "page")
    made = flow.walked(pages, items, target_min, cap=flow.cap_of(F.col("platform"))).select("slug", "page", "n_new", "max_year")
    return sorted(map(repr, map(tuple, made.collect())))


def got(spark, out):
    return sorted(map(repr, map(tuple, walk.page_table(spark, out).collect())))


@pytest.mark.parametrize("target_min", [None, 2021])
def test_stream_in_three_batches_with_a_restart(spark, tmp_path, target_min):
    items = listings(spark)
    parts = [as_pages(items.filter(F.col("page") % 3 == third)).coalesce(1) for third in (1, 2, 0)]
    where = [f"{tmp_path}/{x}" for x in ("in", "out", "state")]
    parts[0].write.mode("append").parquet(where[0])
    assert walk.run_walk(spark, *where, target_min=target_min) == 1
    for part in (*parts[1:], parts[1]):  # the last file brings pages again
        part.write.mode("append").parquet(where[0])
    assert walk.run_walk(spark, *where, files_a_batch=1, target_min=target_min) == 3  # a new query over the same checkpoint
    want = expected(items, target_min)
    assert got(spark, where[1]) == want and len(want) > 50
    if target_min is None:  # the platforms' caps end two listings of 60 pages
        assert max(int(r.split(", ")[1]) for r in want if r.startswith("('s1'")) == 49
        assert max(int(r.split(", ")[1]) for r in want if r.startswith("('s0'")) == 59
    fresh = spark.read.parquet(where[1]).filter("ordinal is not null")
    assert fresh.count() == fresh.select("slug", F.regexp_replace("url", "/+$", "")).distinct().count()
    assert walk.run_walk(spark, *where, target_min=target_min) == 0 and got(spark, where[1]) == want


def test_stream_waits_for_missing_pages(spark, tmp_path):
    items = listings(spark).filter("slug = 's0' and page < 6")
    where = [f"{tmp_path}/{x}" for x in ("in", "out", "state")]
    as_pages(items.filter("page <> 2")).coalesce(1).write.parquet(where[0])
    walk.run_walk(spark, *where)
    assert walk.page_table(spark, where[1]).agg(F.max("page")).first()[0] == 1
    as_pages(items.filter("page = 2")).coalesce(1).write.mode("append").parquet(where[0])
    walk.run_walk(spark, *where)
    assert got(spark, where[1]) == expected(items, None)


def test_settings_come_back(spark):
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    with walk.stream_settings(spark):
        assert spark.conf.get(name) == "false"
    assert spark.conf.get(name) == before


def by_spot(spark, items, root, groups=64):
    facts = flow.page_years(items, "slug", "page")
    probe.write_pages(facts, f"{root}/facts", groups)
    probe.write_pages(items, f"{root}/items", groups)
    tables = [spark.read.parquet(f"{root}/{x}") for x in ("facts", "items")]
    return facts, *tables, items.groupBy("slug").agg((F.max("page") + 1).alias("n_pages"))


def dated(spark, lengths, years_back=4):
    rows = []
    for k, n in enumerate(lengths):
        for page in range(n):
            rows += [(f"s{k}", "q4", page, page * 10 + i, f"https://x.example.com/{k}/{page * 2 + i}", f"{2026 - page // years_back}-06-01") for i in range(2)]
    return spark.createDataFrame(rows, ITEMS.replace("publish_date date", "day string")).withColumn("publish_date", F.col("day").cast("date")).drop("day")


@pytest.mark.parametrize("years", [{2024, 2025}, {2026}, {2030}, {1990}, {2012}])
def test_probing_equals_reading_all(spark, tmp_path, years):
    items = dated(spark, [64, 1, 2, 37])
    facts, told, table, pages = by_spot(spark, items, tmp_path)
    made, cost = probe.probing_walk(told, table, pages, years, store.keeper(spark), groups=64)
    names = ["slug", "page", "ordinal", "url"]
    want = flow.walk(items, years).select(names)
    assert sorted(map(tuple, made.select(names).collect())) == sorted(map(tuple, want.collect()))
    start = {r["slug"]: r["start_page"] for r in flow.start_page(facts, max(years), min(years)).collect()}
    walked = {r["slug"]: r["n"] for r in flow.walk(items, years).groupBy("slug").agg(F.countDistinct("page").alias("n")).collect()}
    n_pages = {r["slug"]: r["n_pages"] for r in pages.collect()}
    for r in cost.collect():
        assert r["start_page"] == start[r["slug"]]
        assert r["probes"] <= math.log2(n_pages[r["slug"]]) + 2
        assert r["n_read"] <= 2 * walked.get(r["slug"], 0) + 4


def test_pages_that_no_probe_asks_for_are_not_opened(spark, tmp_path):
    """All page files but those of the search and the walk are made unreadable."""
    items = dated(spark, [64])
    _, told, table, pages = by_spot(spark, items, tmp_path, groups=1)
    low, high, asked = 1, 63, {0}
    while low < high:  # years {2020}: pages 24 to 27
        middle = (low + high) // 2
        asked.add(middle)
        low, high = (low, middle) if 2026 - middle // 4 <= 2020 else (middle + 1, high)
    for kind, keep in (("facts", asked), ("items", set(range(24, 30)))):
        for file in Path(f"{tmp_path}/{kind}").glob("spot=*/*.parquet"):
            if int(file.parent.name.split("-")[1]) not in keep:
                file.write_bytes(b"no parquet")
                (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    made, cost = probe.probing_walk(told, table, pages, {2020}, store.keeper(spark), groups=1)
    assert sorted(r["page"] for r in made.collect()) == sorted(list(range(24, 29)) * 2)  # 28 is older and ends the walk
    assert cost.first()["probes"] == len(asked) <= 8
    plan = probe.fetch(told, pages.filter("n_pages > 1").select("slug", F.lit(3).alias("page")), 1)._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan


def test_folders_of_a_long_listing_grow_with_its_logarithm(spark, tmp_path):
    """Pages far back share folders; the search finds what reading all pages finds."""
    page = F.col("id")
    facts = spark.range(2_500).select(F.lit("s0").alias("slug"), page.alias("page"), (F.lit(2026) - F.floor(page / 100)).cast("long").alias("min_year"), (F.lit(2026) - F.floor(page / 100)).cast("long").alias("max_year"))
    probe.write_pages(facts, f"{tmp_path}/facts", 1)
    assert len(list(Path(f"{tmp_path}/facts").glob("spot=*"))) < 128 + 64 * 5
    table = spark.read.parquet(f"{tmp_path}/facts")
    listings = spark.createDataFrame([("s0", 2_500)], "slug string, n_pages long")
    got = probe.probed_start(table, listings, 2004, 2004, store.keeper(spark), 1).first()
    assert got["start_page"] == flow.start_page(facts, 2004, 2004).first()["start_page"] == 2_200
    asked = listings.select("slug", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_pages") - 1)).alias("page"))
    assert probe.fetch(table, asked, 1).count() == 2_500
