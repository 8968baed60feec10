import hashlib

import numpy as np
import pytest
from noticeloom.llm import multiset as m

DOCS = "doc_id long, text string"


def test_sum_over_paragraphs():
    f = m.Fingerprinter()
    a, b = f.text(b"one two three four\nfive six\n\nseven"), f.text(b"seven\n\nfive six\none two three four")
    assert np.array_equal(a, b)
    assert np.array_equal(f.vector([b"x y z"]) + f.vector([b"p", b"x y z"]), f.vector([b"x y z", b"p", b"x y z"]))
    assert not np.array_equal(f.text(b"a\na"), f.text(b"a"))
    assert not np.array_equal(f.text(b""), f.vector([]))


def test_edits_are_incremental():
    f = m.Fingerprinter()
    for old, new in ((b"a b c\nd e f\ng", b"a b c\nd e\nx y z w"), (b"", b"a"), (b"a\nb", b"a\nb"), (b"a\nb\nc", b"a\nb")):
        assert np.array_equal(f.edit(f.text(old), old, new), f.text(new))


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.9])
def test_likeness_estimates_shared_shingles(share):
    """The standard error over many pairs of texts is one over the square root of the lanes, and there is no bias."""
    f, off, cut = m.Fingerprinter(), [], int(1_000 * share)
    for turn in range(60):
        words = [f"w{turn}x{i}" for i in range(1_000)]
        other = words[:cut] + [f"v{turn}x{i}" for i in range(1_000 - cut)]
        a, b = (f.text(" ".join(w).encode())[m.EQUAL :].astype(np.int32).astype(float) for w in (words, other))
        off.append(2 * (a @ b) / (a @ a + b @ b) - share)
    assert abs(np.mean(off)) < 0.025
    assert np.sqrt(np.mean(np.square(off))) < 1.2 / np.sqrt(m.LIKE)


def test_returned_fingerprints_are_added_to_and_taken_from(spark):
    """What the query returns is the vector itself: paragraphs go in and out, parts add up, likeness is told from it."""
    docs = spark.createDataFrame([(3, "a b c d\ne f g"), (2, "e f g"), (1, "a b c d")], DOCS)
    got = {r["doc_id"]: r for r in m.edited_fingerprints(docs).collect()}
    f, told = m.Fingerprinter(), {i: m.lanes(r["fingerprint"]) for i, r in got.items()}
    assert np.array_equal(told[3], told[2] + told[1])
    assert m.written(told[3] - f.vector([b"a b c d"])) == got[2]["fingerprint"]
    assert m.written(told[2] + f.vector([b"a b c d"])) == got[3]["fingerprint"]
    assert got[3]["near_next"] == m.likeness(told[3], told[2])


def test_ids_keep_their_type(spark):
    assert m.edited_fingerprints(spark.createDataFrame([(1, "a")], "doc_id int, text string")).schema["doc_id"].dataType.simpleString() == "int"
    with pytest.raises(TypeError):
        m.edited_fingerprints(spark.createDataFrame([("x", "a")], "doc_id string, text string"))


def test_equal_texts():
    f = m.Fingerprinter()
    whole = f.text(b"a b c d e")
    assert m.likeness(whole, whole) == 1.0
    assert m.likeness(f.text(b""), f.text(b"\n")) == 0.0


def check(spark, docs):
    rows = m.edited_fingerprints(spark.createDataFrame(docs, DOCS).repartition(5)).collect()
    f, order = m.Fingerprinter(), sorted(docs, key=lambda d: -d[0])
    assert len(rows) == len(docs)
    got = {r["doc_id"]: r for r in rows}
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        edited = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (f.text(t.encode()) for t in (text, edited, following))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (m.written(a), m.written(b))
        assert np.array_equal(m.lanes(r["fingerprint"]), a)
        assert (r["near_edited"], r["near_next"]) == (m.likeness(a, b), m.likeness(a, c))


def test_next_document_over_partitions(spark):
    check(spark, [(i * 7 % 101, f"text é🙂 number {i}\n" * (i % 5) + "end" * i) for i in range(101)])
    check(spark, [(1, "only one document here")])
    check(spark, [(2, None), (1, "abc"), (5, "")])


def test_nulls_and_repeats(spark):
    rows = [(None, "a b c"), (None, "a b c"), (None, "z"), (3, "q"), (3, "q"), (2, None)]
    got = m.edited_fingerprints(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 6
    assert len({r["fingerprint"] for r in got if r["n_chars"] == 5}) == 1
    assert m.edited_fingerprints(spark.createDataFrame([], DOCS)).count() == 0


def test_fingerprints_frame(spark):
    got = m.fingerprints(spark.createDataFrame([(1, "a\nb"), (2, "b\na"), (3, None)], DOCS)).collect()
    prints = {r["doc_id"]: bytes(r["fingerprint"]) for r in got}
    assert prints[1] == prints[2] != prints[3]
