import re
import textwrap

import numpy as np
import pytest
from noticeloom.llm import licenses

DOCS = "doc_id long, text string"
NOTICES = [
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("Distributed under the terms of the GNU General Public License, version 2.", "GPL-2.0"),
    ("Released under the MIT License.", "MIT"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA"),
    ("Licensed under CC BY 4.0.", "CC-BY"),
    ("SPDX-License-Identifier: MPL-2.0", "MPL-2.0"),
    ("Copyright 2020 Somebody. All rights reserved.", "Proprietary"),
    ("She renewed her driver license and the license plate.", ""),
    ("Copyright law is taught in the third year.", ""),
    ("No notice here.", ""),
]


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
BSD3 = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
GPL = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
WRAPPED = [(MIT, "MIT"), (BSD3, "BSD-3-Clause"), (GPL.format(2), "GPL-2.0"), (GPL.format(3), "GPL-3.0"), ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.", "Apache-2.0")]


@pytest.mark.parametrize("before", ["", "# "])
def test_wrapped_notices(spark, before):
    """At any width; a comment's sign before each line changes nothing."""
    docs, want = [], {}
    for text, family in WRAPPED:
        for width in (44, 60, 72, 80, 1_000):
            docs.append((len(docs), "A first paragraph.\n\n" + textwrap.fill(text, width, initial_indent=before, subsequent_indent=before, break_on_hyphens=False) + "\n\nSome prose that ends here.\n"))
            want[len(docs) - 1] = family
    got = {r["doc_id"]: r["families"] for r in licenses.license_report(spark.createDataFrame(docs, DOCS)).collect()}
    assert got == want


def test_choices_and_denials(spark):
    told = {
        "Licensed under the MIT License or the Apache License, Version 2.0.": "Apache-2.0 MIT",
        "Licensed under either of the Apache License, Version 2.0 or the MIT License at your option.": "Apache-2.0 MIT",
        "Distributed under the terms of the GNU General Public License, version 2 or the GNU General Public License, version 3.": "GPL-2.0 GPL-3.0",
        "This is not released under MIT.": "",
        "The code is no longer licensed under the Apache License, Version 2.0.": "",
        "Licensed under the GNU Lesser General Public License, version 2.1.": "LGPL",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    }
    made = licenses.license_report(spark.createDataFrame(list(enumerate(told)), DOCS))
    assert {list(told)[r["doc_id"]]: r["families"] for r in made.collect()} == told
    assert all(r["n_paragraphs"] == 1 and r["n_confirmed"] <= 1 for r in made.collect())


def test_families(spark):
    docs = [(i, "Some text.\n" + text + "\nmore text") for i, (text, _) in enumerate(NOTICES)]
    got = {r["doc_id"]: r["families"] for r in licenses.license_report(spark.createDataFrame(docs, DOCS)).collect()}
    assert [got[i] for i in range(len(NOTICES))] == [f for _, f in NOTICES]


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = {"Apache License": "Apache-2.0", "General Public License, version 3": "GPL-3.0", "MIT License": "MIT", "CC BY-NC 4.0": "CC-BY-NC", "rights reserved": "Proprietary"}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in licenses.license_report(docs).collect():
        want = sorted(f for part, f in told.items() if part in texts[r["doc_id"]])
        assert r["families"].split() == want


def test_words_agree_with_the_scan(spark):
    text = "Version 2.0 of CC-BY, and GPLv3; v. 2.0! ünï"
    row = spark.createDataFrame([(1, "copyright " + text)], DOCS)
    assert set(licenses.paragraphs(row).first()["features"]) == set(licenses.features("copyright " + text))


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, "Released under the MIT License."), (3, "x"), (3, "x")]])
def test_edges(spark, rows):
    assert licenses.license_report(spark.createDataFrame(rows, DOCS)).count() == len(rows)


def test_plan_is_native(spark):
    plan = licenses.license_report(spark.createDataFrame([(1, "Released under the MIT License.")], DOCS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapIn", plan)


def test_every_notice_is_scanned(spark):
    """Also without the words license or copyright; none is lost to the filter or to the weights."""
    notices = [(f, t) for f, t in dict.fromkeys(licenses.notices()) if f != licenses.UNKNOWN]
    docs = [(i, "Some text.\n" + text) for i, (_, text) in enumerate(notices)] + [(-1, "MIT"), (-2, "Released under MIT."), (-3, "copyrighted")]
    got = {r["doc_id"]: r for r in licenses.license_report(spark.createDataFrame(docs, DOCS)).collect()}
    assert all(r["n_paragraphs"] == 1 for r in got.values())
    assert [got[i]["families"] for i, (_, t) in enumerate(notices) if t in ("Released under MIT.", "Published under BSD-3-Clause.", "Available under MPL-2.0.")] == ["MIT", "BSD-3-Clause", "MPL-2.0"]
    assert all(re.search(licenses.ANCHOR, t) for _, t in notices)


@pytest.mark.parametrize("text", ["Prof. Lee of MIT holds the copyright of the book.", "Distributed under the terms of our contract.", "The LGPL is the topic of the talk.", "Copyright law and the MIT Press."])
def test_names_alone_are_no_notices(text):
    """A name of one word counts only with what carries it; the brute force of the comparison, without Spark."""
    words, by = set(licenses.features(text)), {}
    for family, number, feature, must in licenses.templates():
        by.setdefault((family, number), []).append((feature, must))
    alike = {k: sum(f in words for f, _ in v) / len(v) for k, v in by.items() if all(f in words for f, must in v if must)}
    assert all(share < licenses.ALIKE for share in alike.values())


def test_probabilities_are_calibrated():
    """Of notices with carriers that training did not see, and sentences without a licence, the mean probability of what is said is near the share that is right."""
    model, kept = licenses.train([licenses.features(t) for t in licenses.OTHERS]), licenses.held_back()
    rows = [(f, t) for f, t in dict.fromkeys(licenses.notices()) if t in kept or f == licenses.UNKNOWN]
    told = []
    for family, text in rows:
        z = model.intercept + sum(model.weight[w] for w in licenses.features(text) if w in model.weight)
        e = np.exp((z - z.max()) / model.temperature)
        told.append((e.max() / e.sum(), model.families[int(z.argmax())] == family))
    p, right = map(np.array, zip(*told))
    assert right.mean() > 0.95 and abs(p.mean() - right.mean()) < 0.1


def test_scores_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    notes = [(10**6 + i, "A line before.\n" + text) for i, (text, _) in enumerate(NOTICES)]
    docs = docs.union(spark.createDataFrame(notes, DOCS))
    model = licenses.train([licenses.features(t) for t in licenses.OTHERS])
    got = licenses.scan(docs, model).collect()
    keys = {(r["doc_id"], r["line"]) for r in got}
    by, seen = {}, 0
    for family, number, feature, must in licenses.templates():
        by.setdefault((family, number), []).append((feature, must))
    needed, anchor = re.compile(licenses.needed().replace(r"\p{L}\p{N}", r"^\W_").replace("[^\\W_]", "[^\\W_]")), re.compile(licenses.ANCHOR)
    for r in docs.collect():
        for line, text in enumerate(re.sub(licenses.WRAP, " ", r["text"] or "").split("\n")):
            if not (needed.search(text.lower()) or anchor.search(text)):
                assert (r["doc_id"], line) not in keys
                continue
            seen += 1
            words = licenses.features(text)
            z = model.intercept + sum((model.weight[w] for w in words if w in model.weight), np.zeros(len(model.families)))
            e = np.exp((z - z.max()) / model.temperature)
            said = model.families[int(z.argmax())]
            alike = max((sum(f in words for f, _ in v) / len(v) for (family, _), v in by.items() if family == said and all(f in words for f, must in v if must)), default=0.0)
            row = next(x for x in got if (x["doc_id"], x["line"]) == (r["doc_id"], line) and (not x["confirmed"] or x["family"] == said))
            assert row["probability"] == pytest.approx(e.max() / e.sum(), abs=1e-4) and row["alike"] == pytest.approx(alike)
            sure = said != licenses.UNKNOWN and e.max() / e.sum() >= licenses.PROBABLE and alike >= licenses.ALIKE
            assert (row["family"], row["confirmed"]) == (said if sure else licenses.UNKNOWN, sure)
    assert seen == len(keys) > 10


def test_long_and_hostile_texts(spark):
    texts = ["copyright " + "1." * 100_000 + "1", "copyright " + "a" * 100_000, "license " * 20_000, "mit " + "-" * 100_000, "copyright\n" * 20_000]
    assert licenses.license_report(spark.createDataFrame(list(enumerate(texts)), DOCS), ).count() == len(texts)
