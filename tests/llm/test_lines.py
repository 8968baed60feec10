"""Line dedup against a brute-force scan of all runs."""

import hashlib
import random

import pytest
from noticeloom.llm import lines

DOCS = "doc_id long, text string"


def brute(docs, least):
    """Cut lines by id: every run of lines with words that holds enough of them and occurred before."""
    seen, cut = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        told = [(j, t, len(t.encode().split())) for j, t in enumerate(text.split("\n"))]
        told = [x for x in told if x[2]]
        gone = set()
        for a in range(len(told)):
            words = 0
            for b in range(a, len(told)):
                words += told[b][2]
                if words >= least:
                    key = tuple(t for _, t, _ in told[a : b + 1])
                    if key in seen:
                        gone |= set(range(a, b + 1))
                    seen.add(key)
        out = {told[i][0] for i in gone}
        for i in gone:  # lines without words between two that go
            if i + 1 in gone:
                out |= set(range(told[i][0], told[i + 1][0]))
        cut[doc_id] = out
    return cut


def left(text, cut):
    return "\n".join(t for j, t in enumerate(text.split("\n")) if j not in cut)


@pytest.mark.parametrize("least", [1, 4, 9])
def test_random(spark, least):
    rng = random.Random(least)
    docs = [(i, "\n".join(rng.choice(["a b c", "d e", "f", "", "g h i j k l", "  "]) for _ in range(rng.randint(0, 12)))) for i in range(50)]
    got = {r["doc_id"]: r["kept_sha256"] for r in lines.line_report(spark.createDataFrame(docs, DOCS), least).collect()}
    cut = brute(docs, least)
    assert got == {i: hashlib.sha256(left(t, cut[i]).encode()).hexdigest() for i, t in docs}


def test_documents(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["doc_id"]: r["kept_sha256"] for r in lines.line_report(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    cut = brute(docs, lines.MIN_WORDS)
    assert got == {i: hashlib.sha256(left(t, cut[i]).encode()).hexdigest() for i, t in docs}


def test_passage_inside_other_lines(spark):
    passage = "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) for i in range(4))
    docs = [(1, "first\n" + passage + "\nend"), (2, "own\n" + passage + "\nother"), (3, "clean text here")]
    made = {r["doc_id"]: r["text"] for r in lines.dedup_lines(spark.createDataFrame(docs, DOCS)).collect()}
    assert made == {1: docs[0][1], 2: "own\nother", 3: "clean text here"}


def test_edges_and_columns(spark):
    rows = [(1, None, None, 7), (2, "", 0, 8), (None, "x", 1, 9), (4, "y " * 60, 120, 1), (4, "y " * 60, 120, 1)]
    docs = spark.createDataFrame(rows, DOCS + ", n_chars long, rank int")
    made = lines.dedup_lines(docs)
    assert made.columns == docs.columns
    assert sorted(map(repr, map(tuple, made.collect()))) == sorted(map(repr, rows))
    assert lines.dedup_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("times", [2, 3, 60])
def test_rows_listed_again_keep_their_text(spark, times):
    """A document listed again is no copy; one with another id is, in each of its listings."""
    passage = "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) for i in range(4))
    rows = [(1, "own start\n" + passage)] * times + [(2, passage + "\nown end")] * times + [(None, passage)] + [(3, "z " * 70)]
    made = lines.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()
    want = [(1, "own start")] * times + [(2, "own end")] * times + [(None, passage), (3, "z " * 70)]  # a null id comes first
    assert sorted(map(repr, map(tuple, made))) == sorted(map(repr, want))
    told = lines.line_report(spark.createDataFrame(rows, DOCS)).collect()
    assert len(told) == len(rows) and all(r["n_cut"] <= r["n_lines"] for r in told)
    assert {(r["doc_id"], r["n_lines"], r["n_cut"]) for r in told} == {(1, 5, 4), (2, 5, 4), (None, 4, 0), (3, 1, 0)}


def test_table_listed_twice(spark, sf):
    """Every row twice gives every result twice."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    once = sorted(map(tuple, lines.line_report(docs).collect()))
    assert sorted(map(tuple, lines.line_report(docs.union(docs)).collect())) == sorted(once * 2)


def test_many_listings_of_one_row(spark):
    """Rows grow with the listings, not with their square: no more lines are compared for a thousand than for one."""
    row = (5, "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) for i in range(6)))
    scratch = lines.Scratch(spark)
    docs = spark.createDataFrame([row] * 1_000, DOCS)
    kept = lines.distinct_places(scratch.keep(lines.numbered_lines(docs, 50), "all"), scratch)
    assert kept.count() == 6
    assert {tuple(r) for r in lines.dedup_lines(docs).collect()} == {row}


def test_sql_agrees_on_rows_listed_again(spark, sf):
    import duckdb
    from noticeloom.llm.queries import LINES_SQL

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.filter("doc_id % 3 = 0"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT doc_id, text FROM '{sf}/documents.parquet' UNION ALL SELECT doc_id, text FROM '{sf}/documents.parquet' WHERE doc_id % 3 = 0")
    assert sorted(map(tuple, lines.line_report(docs).collect())) == sorted(con.execute(LINES_SQL).fetchall())
