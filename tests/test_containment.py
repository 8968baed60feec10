"""Interval joins over nodes read listings as the extractor does that walks one page after another."""

import random

import pytest
from noticeloom.functions import html
from noticeloom.operators import containment
from pyspark.sql import functions as F

BASE = "https://ir.example.com/news/list"
WORDS = ["May 6, 2026", "12 March 2025", "Report", "Sales Releases", "Results of July 1, 2024", "2026-02-30", "Earnings Releases", " ", "see 3/4/2025", "Continue"]


def tree(rng, depth=0):
    """Nested cards, lists and links, some links twice, some without words, some that are no releases."""
    out = []
    for _ in range(rng.randint(1, 4 if depth < 4 else 2)):
        kind = rng.random()
        if kind < 0.25 or depth > 6:
            out.append(rng.choice(WORDS))
        elif kind < 0.5:
            href = rng.choice([f"/news/news-details/2026/{rng.randrange(6)}/", f"/news/news-details/2026/{rng.randrange(6)}/", "/about", "#"])
            label = rng.choice(["", "", ' aria-label="Title, January 27, 2026, January 13, 2026"', ' aria-label="no date"'])
            said = rng.choice(["", "<b>Headline</b> two", "Headline of May 9, 2031", "Report", "<span> </span>"])
            out.append(f'<a href="{href}"{label}>{said}</a>')
        elif kind < 0.55:
            out.append("<script>May 1, 2020</script>")
        else:
            tag = rng.choice(["div", "li", "article", "section", "span", "ul", "p"])
            out.append(f"<{tag}>{tree(rng, depth + 1)}</{tag}>")
    return "".join(out)


def test_random_pages_as_the_extractor_reads_them(spark):
    rng = random.Random(11)
    pages = [(i, BASE, tree(rng)) for i in range(150)] + [(1_000, BASE, None), (1_001, BASE, ""), (1_002, BASE, "no element")]
    made = containment.q4_items(spark.createDataFrame(pages, "page_id long, base_url string, html string")).collect()
    got = {}
    for r in sorted(made, key=lambda r: (r["page_id"], r["place"])):
        got.setdefault(r["page_id"], []).append((r["title"], r["url"], r["publish_date"], r["raw_date_text"], "", r["category"]))
    want = {i: told for i, base, text in pages if (told := html.items_of(text, base, "q4"))}
    assert got == want
    assert sum(len(x) for x in want.values()) > 100 and any(x[2] for told in want.values() for x in told) and any(x[5] for told in want.values() for x in told)


def test_blocks_make_up_the_interval(spark):
    n = 33
    rows = [(a, b) for a in range(n) for b in range(a, n + 1)]
    made = spark.createDataFrame(rows, "low long, high long").select("low", "high", containment._blocks(F.col("low"), F.col("high")).alias("blocks")).collect()
    for r in made:
        covered = [x for b in r["blocks"] for x in range(b["block"] << b["level"], (b["block"] + 1) << b["level"])]
        assert sorted(covered) == list(range(r["low"], r["high"]))
        assert len(r["blocks"]) <= 2 * max(1, (r["high"] - r["low"]).bit_length())


@pytest.mark.parametrize("n", [200])
def test_join_equals_comparing_all(spark, n):
    rng = random.Random(2)
    outer = [(rng.randrange(3), a, a + rng.randrange(60), f"o{i}") for i, a in enumerate(rng.randrange(5_000) for _ in range(n))]
    inner = [(rng.randrange(3), rng.randrange(5_000), f"i{i}") for i in range(n)] + [(1, 2**31 - 2, "far")]
    made = containment.contained(spark.createDataFrame(outer, "page_id long, a long, b long, o string"), spark.createDataFrame(inner, "page_id long, p long, i string"), "a", "b", "p")
    assert sorted((r["o"], r["i"]) for r in made.collect()) == sorted((o, i) for g, a, b, o in outer for h, p, i in inner if g == h and a <= p < b)
    plan = made._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_side_of_a_join_is_collected_at_the_driver(spark):
    """Estimates of small pages would have Spark broadcast what parsing and the grid multiply."""
    pages = spark.createDataFrame([(1, BASE, "<div><a href='/news/news-details/2026/1/'>x</a></div>")], "page_id long, base_url string, html string")
    made = containment.q4_items(pages)
    assert made.count() == 1
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()


def test_levels_by_the_number_of_nodes(spark):
    outer = [(1, a, b) for a in range(9) for b in range(a, 10)]
    made = containment.contained(spark.createDataFrame(outer, "page_id long, a long, b long"), spark.createDataFrame([(1, p, 9) for p in range(9)], "page_id long, p long, n long"), "a", "b", "p", "n")
    assert sorted((r["a"], r["b"], r["p"]) for r in made.collect()) == sorted((a, b, p) for _, a, b in outer for p in range(9) if a <= p < b)


def test_a_page_is_read_without_joins_or_shuffles(spark):
    """Every shuffle of nodes, links or texts grows with what the pages hold: on large tables these took most of the time."""
    pages = spark.createDataFrame([(1, BASE, "<div><a href='/news/news-details/2026/1/'>x</a></div>")], "page_id long, base_url string, html string")
    made = containment.q4_items(pages)
    assert made.count() == 1
    plan = made._jdf.queryExecution().toString()
    assert plan.count("MapInArrow") and not any(x in plan.split("== Physical Plan ==")[1] for x in ("Exchange", "Join", "Window", "Sort"))


def test_boxes_hold_no_more_than_the_page(spark):
    """Of many links to one release in one card only that which gives the item takes the card's texts."""
    n = 1_000
    many = "".join(f"<p>told {i}</p><a href='/news/news-details/2026/1/'>{'' if i < 5 else f'Title {i}'}</a>" for i in range(n))
    wordless = "".join(f"<a href='/news/news-details/2026/{i}/'> </a>" for i in (2, 3, 2))
    deep = "<div>" * 200 + "<span>" * 50 + "May 6, 2026<a href='/news/news-details/2026/4/'>Deep</a>" + "</span>" * 50 + "</div>" * 200
    texts = {1: f"<section>{many}</section>", 2: f"<section>{wordless}</section>", 3: f"<li>{wordless}</li>", 4: deep, 5: f"<div><section>June 3, 2025{wordless}</section>words</div>"}
    texts[6] = "".join(f"<li>June {i}, 2025<a href='{'https://ir.example.com' * (i % 2)}/news/news-details/2026/{i // 2}/'>One</a></li>" for i in range(1, 8))
    pages = spark.createDataFrame([(i, BASE, text) for i, text in texts.items()], "page_id long, base_url string, html string")
    for i, text in texts.items():
        want = [(t, u, d, raw, c) for t, u, d, raw, _, c in html.items_of(text, BASE, "q4")]
        got = containment.q4_items(pages.filter(F.col("page_id") == i)).orderBy("place").drop("page_id", "place").collect()
        assert [tuple(r) for r in got] == want
    sizes = containment.q4_links(pages.filter("page_id = 1"), "news-details", 5).select(F.sum(F.size(F.flatten("boxes")))).first()[0]
    assert n < sizes <= 5 * 2 * n
