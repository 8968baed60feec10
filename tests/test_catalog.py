import pytest
from noticeloom.plans import classify
from noticeloom.sources import catalog

SOURCES = """
- {slug: acme, name: Acme, ticker: ACME, ir_url: "https://ir.acme.example.com/"}
- {slug: beta, name: Beta Co, ticker: BETA, ir_url: "https://www.beta.example.com/ir", news_url: "https://news.beta.example.com", news_path: "news/{year}/default.aspx"}
- {slug: bls, name: Bureau, ir_url: "https://bls.example.com"}
"""
CONFIG = """
q4_ir: {scraper: q4, sources: [{slug: beta, args: [--b, --a]}]}
notified: {scraper: notified, sources: [{slug: acme}, {slug: lost}, {args: [x]}]}
notified_gated: {scraper: gated, sources: [{slug: acme}]}
"""


@pytest.fixture
def files(tmp_path):
    (tmp_path / "s.yaml").write_text(SOURCES)
    (tmp_path / "c.yaml").write_text(CONFIG)
    return tmp_path


@pytest.fixture
def sources(spark, files):
    return catalog.load_sources(spark, str(files / "s.yaml"))


def test_lookups(spark, sources):
    assert catalog.find_source(sources, " acme ").first()["slug"] == "acme"
    assert catalog.find_source(sources, "beta", "ticker").first()["slug"] == "beta"
    assert catalog.find_source(sources, "beta", "slug").count() == 1
    with pytest.raises(LookupError):
        catalog.required(sources, "none")
    assert catalog.slug_taken(sources, "ACME", "OTHER") and not catalog.slug_taken(sources, "acme", "ACME")
    urls = spark.createDataFrame([("https://news.beta.example.com/x",), ("https://beta.example.com",), ("https://other.example.com",)], "url string")
    assert {r["url"]: r["slug"] for r in catalog.find_by_url(sources, urls).collect()} == {"https://news.beta.example.com/x": "beta", "https://beta.example.com": "beta", "https://other.example.com": None}


def test_bad_records(spark, tmp_path):
    (tmp_path / "s.yaml").write_text("- {slug: a, name: A}")
    with pytest.raises(ValueError, match="ir_url"):
        catalog.load_sources(spark, str(tmp_path / "s.yaml"))
    (tmp_path / "s.yaml").write_text("- {slug: a, name: A, ir_url: x, ticker: ON}")
    with pytest.raises(ValueError, match="ticker"):
        catalog.load_sources(spark, str(tmp_path / "s.yaml"))


def test_config(spark, files):
    config = catalog.load_config(spark, str(files / "c.yaml"))
    rows = catalog.configured_platforms(config).collect()
    assert sorted((r["slug"], r["strategy"], r["platform"]) for r in rows) == [("acme", "notified", "notified"), ("acme", "notified_gated", "notified"), ("beta", "q4_ir", "q4"), ("lost", "notified", "notified")]
    assert catalog.selected(config, "NOTIFIED", "Acme").count() == 1
    signature = catalog.signatures(config).filter("slug = 'beta'").first()["signature"]
    assert signature == '{"module":"q4","args":["--a","--b"]}'


def test_identity(spark, sources):
    rows = [("https://ir.acme.example.com/news?category=788", "", ""), ("https://x.example.com", "", "beta"), ("https://x.example.com", "new", "N"), ("https://x.example.com", "", "")]
    made = catalog.with_identity(spark.createDataFrame(rows, "url string, slug string, ticker string"), sources, "d", "D").collect()
    assert sorted((r["slug"], r["ticker"], r["known"]) for r in made) == [("acme", "ACME", True), ("beta", "BETA", True), ("d", "D", False), ("new", "N", False)]
    acme = next(r for r in made if r["slug"] == "acme")
    assert acme["base"] == "https://ir.acme.example.com" and [tuple(p) for p in acme["extra"]] == [("category", "788")]


def test_resolved(spark, sources):
    detected = spark.createDataFrame([("acme", "notified"), ("beta", "q4")], "slug string, platform string")
    made = {r["slug"]: r for r in catalog.resolved_sources(sources, detected).collect()}
    assert made["acme"]["listing"] == "https://ir.acme.example.com/news-releases"
    assert made["beta"]["listing"] == "https://news.beta.example.com/news/default.aspx"
    assert (made["bls"]["platform"], made["bls"]["listing"]) == ("unknown", "https://bls.example.com")
    assert made["beta"]["strategy"] == "q4_ir" and made["acme"]["first_page_index"] == 0


def test_upsert(spark, sources):
    record = spark.createDataFrame([("acme2", "Acme", "ACME", "https://a.example.com")], "slug string, name string, ticker string, ir_url string")
    assert [r["slug"] for r in catalog.upsert_source(sources, record).collect()] == ["acme2", "beta", "bls"]
    with pytest.raises(ValueError):
        catalog.upsert_source(sources, record.replace("acme2", "beta", "slug"))


def test_files(spark, tmp_path):
    assert catalog.platform_map(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "p.csv").write_text("slug,ticker,platform\nna,NA,q4\nb,,\n")
    assert [tuple(r) for r in catalog.platform_map(spark, str(tmp_path / "p.csv")).collect()] == [("na", "q4"), ("b", "")]
    with pytest.raises(ValueError, match="title"):
        catalog.read_checked(spark, [str(tmp_path / "p.csv")], ("slug", "title"))
    (tmp_path / "r.csv").write_text("a,b\n1\n1,2,3\n")
    assert [tuple(r) for r in catalog.read_text_table(spark, str(tmp_path / "r.csv")).collect()] == [("1", None), ("1", "2")]


def test_queries(spark):
    rows = spark.createDataFrame([(" Acme", 0), ("beta", 1), ("acme ", 2), ("", 3)], "query string, ordinal int")
    assert [r["query"] for r in catalog.distinct_queries(rows).collect()] == [" Acme", "beta"]


def test_registry():
    assert classify.registry_faults() == []
    assert len(classify.describe_platforms()) == 6


def test_nested_signatures(spark):
    from pyspark.sql import functions as F

    same = [['{"b":[1,{"y":2,"x":null}],"a":"t"}', "7"], ["7", ' {"a":"t", "b":[1, {"x":null, "y":2}]}']]
    other = [["7"], ['{"b":[{"y":2,"x":null},1],"a":"t"}', "7"], ['{"b":[1,{"y":2,"x":null}],"a":"T"}', "7"], ["no json"], ['"no json"'], ['{"text":"no json"}'], [None], ["null"], None, [], ["7", "7"], ["true"], ['"true"']]
    rows = [("m", a, i) for i, a in enumerate(same + other)] + [("n", same[0], 99)]
    made = {r["i"]: r["signature"] for r in catalog.nested_signatures(spark.createDataFrame(rows, "module string, args array<string>, i int")).collect()}
    assert made[0] == made[1] and made[0] != made[99]
    equal = {frozenset(i for i, x in made.items() if x == s) for s in made.values()}
    assert {e for e in equal if len(e) > 1} == {frozenset({0, 1}), frozenset({8, 9}), frozenset({10, 11})}  # null is JSON's null, no arguments are none
    numbers = spark.createDataFrame([("100",), ("1e2",), ("100.0",)], "v string").select(catalog.canonical_json(F.col("v")).alias("c")).distinct()
    assert numbers.count() <= 2


CATALOG = """# All sources
- slug: acme
  name: "Acme, Inc."   # as they write it
  ticker: ACME
  ir_url: https://ir.acme.example.com

# The second one
# moves often
- slug: beta
  name: Beta
  ticker: BET
  notes: |
    two
    lines
  ir_url: 'https://ir.beta.example.com'
- {slug: delta, name: Delta, ticker: DEL, ir_url: https://d.example.com}
# the end
"""


def test_saving_a_source_leaves_all_other_lines_alone(spark, tmp_path):
    beta = {"slug": "beta", "name": "Beta \u00dc", "ticker": "BET", "ir_url": "https://new.example.com", "news_url": None}
    text = catalog.saved_text(CATALOG, beta)
    begin, end = CATALOG.index("- slug: beta"), CATALOG.index("- {slug: delta")
    assert text == CATALOG[:begin] + "- slug: beta\n  name: Beta \u00dc\n  ticker: BET\n  ir_url: https://new.example.com\n" + CATALOG[end:]
    new = {"slug": "aero", "name": "Aero", "ticker": "AER", "ir_url": "https://a.example.com"}
    added = catalog.saved_text(CATALOG, new)
    at = CATALOG.index("# The second one")
    assert added == CATALOG[:at] + "- slug: aero\n  name: Aero\n  ticker: AER\n  ir_url: https://a.example.com\n" + CATALOG[at:]
    assert catalog.saved_text(added, new) == added
    moved = catalog.saved_text(CATALOG, {**beta, "slug": "zeta"})
    assert moved.endswith("# the end\n- slug: zeta\n  name: Beta \u00dc\n  ticker: BET\n  ir_url: https://new.example.com\n") and "- slug: beta" not in moved and "# moves often" in moved
    with pytest.raises(ValueError, match="acme"):
        catalog.saved_text(CATALOG, {**beta, "slug": "acme"})
    path = f"{tmp_path}/sources.yaml"
    for record in (beta, new, {**beta, "slug": "zeta"}):
        catalog.save_source(path, record)
    assert [(r["slug"], r["ticker"]) for r in catalog.load_sources(spark, path).orderBy("ordinal").collect()] == [("aero", "AER"), ("zeta", "BET")]


def test_required_records_and_conflicts(spark, sources):
    asked = spark.createDataFrame([(" Acme ", 1), ("beta", 2), ("beta", 3)], "slug string, n int")
    assert [(r["n"], r["ticker"]) for r in catalog.with_required(asked, sources, "ticker").orderBy("n").collect()] == [(1, "ACME"), (2, "BETA"), (3, "BETA")]
    lost = spark.createDataFrame([("acme",), ("none",)], "slug string")
    with pytest.raises(Exception, match="no source has the slug none"):
        catalog.with_required(lost, sources, "ticker").collect()
    wanted = spark.createDataFrame([("ACME ", "OTHER"), ("acme", "ACME"), ("new", "N"), ("bls", None), (None, None)], "slug string, ticker string")
    assert {(r["slug"], r["taken"]) for r in catalog.conflicts(wanted, sources).collect()} == {("ACME ", True), ("acme", False), ("new", False), ("bls", False), (None, False)}


def test_catalog_under_a_key_with_empty_defaults(spark, tmp_path):
    (tmp_path / "k.yaml").write_text("sources:\n  - {slug: a, name: é, ir_url: x}\n")
    made = catalog.described(catalog.load_sources(spark, str(tmp_path / "k.yaml"))).first().asDict()
    assert made == {"ordinal": 0, "slug": "a", "name": "é", "ticker": "", "ir_url": "x", "news_url": "", "news_path": "", "news_details_segment": "", "news_releases_path": ""}
    (tmp_path / "empty.yaml").write_text("")
    assert catalog.load_sources(spark, str(tmp_path / "empty.yaml")).count() == 0
