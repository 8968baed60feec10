"""URL filters: fixed rules by hand, mined ones against counting every combination."""

from itertools import combinations
from random import Random

import pytest
from noticeloom.llm import url_rules
from noticeloom.llm.common import Scratch

PAGES = "page_id long, url string"


def tokens(spark, urls):
    made = spark.createDataFrame(list(enumerate(urls)), PAGES).select("page_id", url_rules.tokens_of().alias("t"))
    return {urls[r["page_id"]]: set(r["t"]) for r in made.collect()}


def brute(of, labels, addresses=url_rules.ADDRESSES, support=url_rules.SUPPORT):
    """Rules (tokens -> verdict, confidence, n) that no rule with fewer tokens makes needless. of: tokens by url; labels: (url, verdict)."""
    labels = sorted({(u, v) for u, v in labels if u is not None and of[u]})
    least = max(addresses, -int(-support * len({*labels}) // 1))
    n = {v: sum(v == x for _, x in labels) for v in url_rules.VERDICTS}
    count = {}
    for u, v in labels:
        for t in of[u]:
            count.setdefault(t, dict.fromkeys(url_rules.VERDICTS, 0))[v] += 1
    weight = {t: abs(c["block"] * n["allow"] - c["allow"] * n["block"]) for t, c in count.items() if sum(c.values()) >= least}
    baskets = [(sorted((t for t in of[u] if t in weight), key=lambda t: (-weight[t], t))[: url_rules.TOKENS], v) for u, v in labels]
    baskets = [(sorted(b), v) for b, v in baskets if b]
    seen = {}
    for b, v in baskets:
        for size in range(1, len(b) + 1):
            for c in combinations(b, size):
                seen.setdefault(c, dict.fromkeys(url_rules.VERDICTS, 0))[v] += 1
    total = {v: sum(v == x for _, x in baskets) for v in url_rules.VERDICTS}
    rules = {}
    for c, k in seen.items():
        for v in url_rules.VERDICTS:
            confidence = k[v] / sum(k.values())
            if k[v] >= least and confidence >= url_rules.CONFIDENCE and confidence / (total[v] / len(baskets)) >= url_rules.LIFT:
                rules[c, v] = (confidence, k[v])
    return {(c, v): x for (c, v), x in rules.items() if not any(w == v and set(d) < set(c) and rules[d, w][0] >= x[0] for d, w in rules)}


def test_mined_rules_equal_counting(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    rule = url_rules.fixed_rule(url_rules.host_of(), url_rules.path_of())
    labelled = pages.select("url", rule["verdict"].alias("verdict")).filter("verdict is not null")
    made = url_rules.mine(labelled, Scratch(spark), addresses=3)
    labels = [tuple(r) for r in labelled.collect()]
    want = brute(tokens(spark, [u for u, _ in labels]), labels, addresses=3)
    got = {(tuple(r["tokens"]), r["verdict"]): (r["confidence"], r["n"]) for r in made.collect()}
    assert got == want and len(got) >= 3
    assert all(r["key"] in r["tokens"] for r in made.collect())


def test_held_out_labels(spark):
    """Folders decide: of addresses whose labels were not seen, nearly all are told rightly."""
    rng = Random(1)
    rows = []
    for i in range(900):
        lang, site = rng.choice(["de", "en", "fr", "casino"]), rng.choice(["aa", "bb", "cc"])
        verdict = "block" if lang == "casino" or (lang == "de" and site == "aa") else "allow"
        rows.append((i, f"https://www.{site}.example.org/{lang}/{rng.randrange(10**6)}", verdict if rng.random() > 0.03 else "allow"))
    frame = spark.createDataFrame(rows, PAGES + ", verdict string")
    rules = url_rules.mine(frame.filter("page_id % 3 > 0"), Scratch(spark))
    made = url_rules.judge(frame.filter("page_id % 3 = 0"), rules, fixed=()).collect()
    truth = {r[0]: r[2] for r in rows}
    assert sum(r["verdict"] == truth[r["page_id"]] for r in made) / len(made) > 0.93
    assert {"dir=casino"} in [set(r["mined"] or ()) for r in made]
    assert {"dir=de", "host=aa"} in [set(r["mined"] or ()) for r in made]


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://NET/x", "net", "/x", "net/", "block"),
        ("https://A.Example.NET/en/5?q#f", "a.example.net", "/en/5", "example.net/en/", "allow"),
        ("https://example.net/en", "example.net", "/en", "net/", "block"),
        ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
        ("http://x.net", "x.net", "", None, "allow"),
        ("http://x.net?a=/b", "x.net", "", None, "allow"),
        ("ftp://u@x.example.com/de/a://b", "u@x.example.com", "/de/a://b", "example.com/de/", "block"),
        ("http://planet/", "planet", "/", None, "allow"),
        ("http://a.org/fr/", "a.org", "/fr/", "org/fr/", "allow"),
        ("http://\u00c4.org/\nfr", "\u00c4.org", "/\nfr", None, "allow"),
        ("mailto:x", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("://", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ],
)
def test_fixed_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url), (1, url), (None, url)], PAGES)
    made = url_rules.verdicts(pages, Scratch(spark)).drop("mined").collect()
    assert sorted(map(repr, map(tuple, made))) == sorted(repr((i, url, host, path, rule, verdict)) for i in (1, 1, None))


def test_edges(spark):
    assert url_rules.verdicts(spark.createDataFrame([], PAGES), Scratch(spark)).count() == 0
    one_sided = spark.createDataFrame([(f"http://a.org/x/{'y' * i}", "block") for i in range(40)], "url string, verdict string")
    assert url_rules.mine(one_sided, Scratch(spark)).count() == 0
    long = "http://h.org/" + "/".join(f"d{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)) + "/"  # shared by all: combinations stay bounded
    rows = [(long + f"{'a' if i % 2 else 'b'}/{i}", "block" if i % 2 else "allow") for i in range(60)] * 2
    rules = url_rules.mine(spark.createDataFrame(rows, "url string, verdict string"), Scratch(spark))
    assert {(tuple(r["tokens"]), r["verdict"]) for r in rules.collect()} == {(("dir=a",), "block"), (("dir=b",), "allow")}


def mined(rules):
    return {(tuple(r["tokens"]), r["verdict"]): (r["confidence"], r["n"]) for r in rules.collect()}


@pytest.mark.parametrize("most", [0, 1, 3])
def test_tokens_beyond_fp_growth(spark, sf, monkeypatch, most):
    """However few tokens FP-growth gets, the rules are those of counting all combinations."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    rule = url_rules.fixed_rule(url_rules.host_of(), url_rules.path_of())
    labels = [tuple(r) for r in pages.select("url", rule["verdict"].alias("verdict")).filter("verdict is not null").collect()]
    rng = Random(most)
    for i in range(300):  # folders at random, some inside others, some always together
        dirs = [d for d in "abcdefg" if rng.random() < 0.5] + (["h", "i"] if rng.random() < 0.3 else []) + ["x", "xx", "xxx"][: rng.randrange(4)]
        labels.append((f"http://s.org/{'/'.join(dirs)}/{i}", "block" if {"a", "b"} <= set(dirs) or ("xx" in dirs and rng.random() < 0.9) else "allow"))
    of = tokens(spark, [u for u, _ in labels])
    monkeypatch.setattr(url_rules, "TOKENS", 99)
    want = brute(of, labels)
    monkeypatch.setattr(url_rules, "TOKENS", most)
    got = mined(url_rules.mine(spark.createDataFrame(labels, "url string, verdict string"), Scratch(spark)))
    assert got == want and len(got) >= 20


def test_rule_of_an_eleventh_token(spark):
    """Two folders decide only together; ten others tell the verdicts apart better than either, and less than both."""
    rng = Random(3)
    rows = []
    for i in range(600):
        p, q = i % 2, i // 2 % 2
        verdict = "block" if p == q else "allow"
        dirs = [f"t{c}" for c in "abcdefghijkl" if rng.random() < (0.95 if verdict == "block" else 0.85)] + [f"p{'yn'[p]}", f"q{'yn'[q]}"]
        rows.append((f"http://s.org/{'/'.join(dirs)}/{i}", verdict))
    rules = url_rules.mine(spark.createDataFrame(rows, "url string, verdict string"), Scratch(spark))
    assert {((f"dir=p{a}", f"dir=q{b}"), "block" if a == b else "allow") for a in "yn" for b in "yn"} <= mined(rules).keys()
    pages = spark.createDataFrame([(i, u.replace("s.org", "other.org")) for i, (u, _) in enumerate(rows)], PAGES)
    made = url_rules.judge(pages, rules, fixed=()).collect()
    assert all(r["verdict"] == rows[r["page_id"]][1] for r in made)


def test_tokens_that_nearly_all_hold(spark):
    """30 folders in 95 of 100 addresses each: their combinations, 2^30, are not tried one by one."""
    rng = Random(4)
    rows = []
    for i in range(400):
        dirs = [f"u{chr(97 + c % 26)}{chr(97 + c // 26)}" for c in range(30) if rng.random() < 0.95] + [f"p{'yn'[i % 2]}", f"q{'yn'[i // 2 % 2]}"]
        rows.append((f"http://s.org/{'/'.join(dirs)}/{i}", "block" if i % 2 == i // 2 % 2 else "allow"))
    rules = url_rules.mine(spark.createDataFrame(rows, "url string, verdict string"), Scratch(spark))
    assert {((f"dir=p{a}", f"dir=q{b}"), "block" if a == b else "allow") for a in "yn" for b in "yn"} <= mined(rules).keys()


def test_no_python_in_plan(spark, sf):
    made = url_rules.verdicts(spark.read.parquet(f"{sf}/pages.parquet").withColumn("rule", url_rules.F.lit(1)), Scratch(spark))
    plan = made._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
