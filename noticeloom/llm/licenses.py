"""Licence scan by a trained paragraph classifier, in DataFrame and SQL functions alone.

Multinomial logistic regression over words and word pairs tells licence families and an unknown class apart. It is
trained here, on notices composed from carriers and names, on excerpts, and on whole paragraphs of the corpus as unknown
ones: any paragraphs, and such that share words with a notice without being one. A temperature fitted on carriers and
paragraphs that were held back calibrates its probabilities. What it says is confirmed by comparison with the family's
templates: enough of one template's words and pairs must stand in the paragraph. A name of a single word is no template
by itself, only with what carries it, and the numbers of a template, which tell versions apart, must all stand there. A
paragraph that holds whole templates of other families too, as a choice of licences does, is told under each of them.

A paragraph is a line and the lines that it is wrapped into: a line without a full stop, colon or the like at its end goes
on in the next one, up to a blank line.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm.common import Scratch

#: The names that notices use for each family; the first ones serve as templates too.
NAMES = {
    "MIT": ("the MIT License", "MIT License", "the MIT licence", "MIT", "the Expat license"),
    "Apache-2.0": ("the Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "the Apache 2.0 license", "the Apache Software License, version 2"),
    "GPL-2.0": ("the GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0", "the GPLv2", "version 2 of the GNU General Public License"),
    "GPL-3.0": ("the GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0", "the GPLv3", "version 3 of the GNU General Public License"),
    "LGPL": ("the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License, version 3", "LGPL-2.1", "LGPL-3.0", "the LGPL"),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3", "AGPL-3.0", "the AGPLv3", "GNU AGPL v3"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "BSD-2-Clause", "the Simplified BSD License", "the two-clause BSD license"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "BSD-3-Clause", "the New BSD License", "the three-clause BSD license", "a BSD-style license"),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "MPL-2.0", "the Mozilla Public License 2.0", "MPL 2.0"),
    "ISC": ("the ISC License", "ISC license", "the ISC licence"),
    "EPL-2.0": ("the Eclipse Public License, version 2.0", "EPL-2.0", "the Eclipse Public License 2.0"),
    "CC-BY": ("CC BY 4.0", "CC-BY-4.0", "the Creative Commons Attribution 4.0 International License", "CC BY 3.0", "a Creative Commons Attribution license"),
    "CC-BY-SA": ("CC BY-SA 4.0", "CC-BY-SA-4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 3.0"),
    "CC-BY-NC": ("CC BY-NC 4.0", "CC-BY-NC-4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 3.0"),
    "CC-BY-ND": ("CC BY-ND 4.0", "CC-BY-ND-4.0", "the Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC0": ("CC0 1.0", "CC0-1.0", "the CC0 1.0 Universal public domain dedication", "Creative Commons Zero"),
    "Unlicense": ("the Unlicense", "The Unlicense"),
}
#: What stands around a name.
CARRIERS = (
    "Licensed under {}.", "Released under {}.", "This work is licensed under {}.", "Distributed under the terms of {}.",
    "This project is released under {}.", "SPDX-License-Identifier: {}", "License: {}", "Available under {}.",
    "The code is licensed under {}; see the LICENSE file.", "Published under {}.", "This file is made available under {}.",
)
#: Sentences that licence texts themselves hold.
EXCERPTS = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "Apache-2.0": ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",),
    "GPL-3.0": ("either version 3 of the License, or (at your option) any later version of the GNU General Public License",),
    "GPL-2.0": ("either version 2 of the License, or (at your option) any later version of the GNU General Public License",),
    "BSD-2-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following two conditions are met",),
    "BSD-3-Clause": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "Unlicense": ("This is free and unencumbered software released into the public domain",),
    "Proprietary": ("All rights reserved.", "Copyright. All rights reserved.", "Unauthorized copying of this file is strictly prohibited. Proprietary and confidential.", "No part of this work may be reproduced without written permission. All rights reserved."),
}
#: Sentences with the same words that grant nothing.
OTHERS = (
    "He lost his driver license on the way to the station.", "The city issued a new business license to the shop.",
    "A fishing licence costs ten pounds a year.", "The license plate was stolen.", "Copyright law differs between countries.",
    "They studied at MIT before the war.", "The Apache helicopter landed at noon.", "The general public was invited to the event.",
    "The warranty covers two years.", "She asked for permission to use the room.", "Version 2.0 of the game was released in May.",
    "The software is distributed by a new company.", "The foundation published a report under its own name.", "The terms of the contract were met.",
    "The commons debated the license fee.", "The project is available in four languages.", "The file is in the public library.", "All rights come with duties.",
)
UNKNOWN = "unknown"
#: Corpus paragraphs that the unknown class learns from, by hash, half of them near to notices: the only bound on what is learned from.
SAMPLE = 400
#: The carriers, and one of so many unknown paragraphs, that are held back for the temperature.
HELD_CARRIERS, HELD_SHARE = (3, 8), 5
#: A family's probability, and the share of a template that must stand in the paragraph.
PROBABLE, ALIKE = 0.5, 0.6
#: A word; of a number, eight groups behind points at most, as a matcher recurses once for each.
TOKEN = r"[\p{L}\p{N}]+(?:[.][\p{N}]+){0,8}"
#: Words of any text, which are chosen for the filter only where a template has too few others.
EVERYDAY = frozenset("a all an and any are as at be by for form from in into is it may no nor not of on only or other that the this to under use used was which with your you".split())
#: What every notice above holds.
ANCHOR = r"(?i)licen[sc]e|copyright|public domain|rights reserved|spdx|creative commons|\bcc0\b|\bcc[ -]by|\b[al]?gpl|permission is hereby|permission to use|source and binary forms|unencumbered|unauthorized copying|\b(?:released|available|published|distributed) under\b"


#: The end of a wrapped line: no mark that ends a sentence or clause stands before it, and no blank line behind it.
WRAP = r"(?<=[^.!?:;\s])[ \t\r]{0,99}\n(?=[ \t]{0,99}[^\s])"
#: A notice that says what is not the case.
NEGATED = r"(?i)\b(?:not|never|no longer)\s+(?:\w+\s+){0,2}(?:licensed|released|distributed|published|available)\b"


def tokens(text: str) -> list[str]:
    """The same as the scan's own words: letters and digits, numbers with their points, lower case."""
    return [t.lower() for t in re.findall(r"[^\W_]+(?:[.]\d+){0,8}", text)]


def features(text: str) -> list[str]:
    words = tokens(text)
    return list(dict.fromkeys(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))


@dataclass
class Model:
    families: list[str]
    weight: dict[str, np.ndarray]
    intercept: np.ndarray
    temperature: float


def notices() -> list[tuple[str, str]]:
    made = [(family, carrier.format(name)) for family, names in NAMES.items() for name in names for carrier in CARRIERS]
    made += [(family, text) for family, texts in EXCERPTS.items() for text in texts for _ in range(4)]
    return made + [(UNKNOWN, text) for text in OTHERS for _ in range(4)]


def held_back() -> set[str]:
    """The notices that the temperature is fitted on: all names, with carriers that training does not see."""
    return {CARRIERS[i].format(name) for names in NAMES.values() for name in names for i in HELD_CARRIERS}


def train(unknown: list[list[str]], rounds: int = 400, penalty: float = 1e-3) -> Model:
    """unknown: the features of corpus paragraphs without a notice."""
    told = notices()
    rows = [(f, features(text)) for f, text in told] + [(UNKNOWN, words) for words in unknown]
    families = sorted({f for f, _ in rows} - {UNKNOWN}) + [UNKNOWN]
    vocabulary = {w: i for i, w in enumerate(sorted({w for f, text in notices() for w in features(text)}))}
    x = np.zeros((len(rows), len(vocabulary)))
    for i, (_, words) in enumerate(rows):
        x[i, [vocabulary[w] for w in words if w in vocabulary]] = 1.0
    y = np.array([families.index(f) for f, _ in rows])
    kept = held_back()
    back = np.array([text in kept for _, text in told] + [i % HELD_SHARE == HELD_SHARE - 1 for i in range(len(unknown))])
    target = np.eye(len(families))[y]
    each = 1 / np.bincount(y, minlength=len(families))[y]
    each[back] = 0
    each /= each.sum()
    w, b = np.zeros((len(vocabulary), len(families))), np.zeros(len(families))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        p = _softmax(x @ w + b)
        err = (p - target) * each[:, None]
        g = x.T @ err + penalty * w / len(families)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        b -= 0.5 * err.sum(axis=0)
    z = x[back] @ w + b
    loss = {t: -np.log(_softmax(z / t)[np.arange(back.sum()), y[back]] + 1e-12).mean() for t in np.geomspace(0.3, 5, 40)}
    return Model(families, {f: w[i] for f, i in vocabulary.items()}, b, float(min(loss, key=loss.get)))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def templates() -> list[tuple[str, int, str, bool]]:
    """Family, template, feature, and whether a paragraph must have it: names without articles, names of one word with their carriers, and excerpts.

    A name of one word must be there itself, and of its carrier the longest word; so must every word with a digit.
    """
    made, number = [], 0

    def add(family: str, text: str, *must: str) -> None:
        nonlocal number
        number += 1
        must = {*must, *(w for w in tokens(text) if any(c.isdigit() for c in w))}
        made.extend((family, number, f, f in must) for f in features(text))

    for family in {**NAMES, **EXCERPTS}:
        for name in NAMES.get(family, ()):
            words = tokens(_plain(name))
            if len(words) > 1:
                add(family, _plain(name))
                continue
            for carrier in CARRIERS:
                carried = max((w for w in tokens(carrier.format("")) if w not in EVERYDAY), key=len)
                add(family, carrier.format(name), words[0], carried)
        for text in EXCERPTS.get(family, ()):
            add(family, text)
    return made


def _plain(name: str) -> str:
    return re.sub(r"^(the|a) ", "", name, flags=re.I)


def needed() -> str:
    """A pattern in lower case that finds a word in every paragraph which holds the share ALIKE of a template; others cannot be confirmed.

    Such a paragraph lacks fewer of a template's features than the words chosen for it occur in, so it holds one of them.
    """
    by: dict[int, list[str]] = {}
    for _, number, feature, _ in templates():
        by.setdefault(number, []).append(feature)
    chosen = {words[0] for names in NAMES.values() for name in names if len(words := tokens(_plain(name))) == 1}
    for number in {number for _, number, feature, must in templates() if must and feature in chosen}:
        del by[number]
    for held in sorted(by.values(), key=len):
        lacking = len(held) - math.ceil(ALIKE * len(held) - 1e-9)  # at most, in a paragraph that is alike
        met = lambda w: {f for f in held if w in f.split()}
        words = sorted({w for f in held for w in f.split()}, key=lambda w: (w in EVERYDAY, w not in chosen, -len(met(w)), -len(w), w))
        covered: set[str] = set()
        while len(covered) <= lacking:
            covered |= met(words[0])
            chosen.add(words.pop(0))
    return r"(?<![\p{L}\p{N}])(?:" + "|".join(re.escape(w) for w in sorted(chosen)) + r")(?![\p{L}\p{N}])"


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, digest, line (the paragraph's number), paragraph of the paragraphs with a needed word or an anchor, and their features."""
    docs = docs.filter(_held("text")).select("doc_id", F.xxhash64("text").alias("digest"), F.posexplode(_split("text")).alias("line", "paragraph"))
    return _with_features(docs.filter(_held("paragraph")))


def _split(text: str) -> Column:
    """The paragraphs of a text, wrapped lines joined."""
    return F.split(F.regexp_replace(text, WRAP, " "), "\n")


def _with_features(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("words", F.regexp_extract_all(F.lower("paragraph"), F.lit(f"({TOKEN})"), F.lit(1)))
    pairs = F.transform(F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.col("words")[i], w))
    return rows.withColumn("features", F.array_distinct(F.concat("words", pairs))).drop("words")


def _held(text: str) -> Column:
    return F.lower(text).rlike(needed()) | F.col(text).rlike(ANCHOR)


KEY = ("doc_id", "digest", "line")


def _any_paragraphs(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Paragraphs of some documents, chosen by a threshold on their hashes: a few times SAMPLE, however many documents there are."""
    part = max(1, docs.count() // (2 * SAMPLE))
    some = docs.filter(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(part)) == 0).select(F.explode(_split("text")).alias("paragraph"))
    some = some.filter(F.col("paragraph").rlike(r"[\p{L}\p{N}]") & ~_held("paragraph"))  # those that are held may be notices
    return scratch.keep(_with_features(some.distinct()).select(F.xxhash64("paragraph").alias("h"), "features"), "some")


def _sampled(rows: DataFrame, n: int) -> list[list[str]]:
    return [r["features"] for r in rows.orderBy("h", F.array_join("features", " ")).limit(n).select("features").collect()]


def _held_with_alike(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The paragraphs that can be notices (KEY, features, negated), and for each family with a shared template KEY, t_family and alike."""
    spark, told = docs.sparkSession, templates()
    known = sorted({f for _, _, f, _ in told} | {f for _, text in notices() for f in features(text)})  # no other feature counts
    held = paragraphs(docs).withColumn("features", F.array_intersect("features", F.lit(known)))
    held = scratch.keep(held.withColumn("negated", F.col("paragraph").rlike(NEGATED)).drop("paragraph").distinct(), "paragraphs")
    table = literal(spark, [{"t_family": f, "template": n, "feature": w, "must": m} for f, n, w, m in told], "t_family string, template int, feature string, must boolean")
    size = table.groupBy(F.col("t_family").alias("f0"), F.col("template").alias("n0")).agg(F.count("*").alias("of"), F.count_if("must").alias("needed"))
    each = held.select(*KEY, F.explode("features").alias("w")).join(F.broadcast(table), F.col("w") == F.col("feature"))
    shared = each.groupBy(*KEY, "t_family", "template").agg(F.count("*").alias("n"), F.count_if("must").alias("met"))
    shared = shared.join(F.broadcast(size), (F.col("t_family") == F.col("f0")) & (F.col("template") == F.col("n0"))).filter(F.col("met") == F.col("needed"))
    alike = shared.groupBy(*KEY, "t_family").agg(F.max(F.col("n") / F.col("of")).alias("alike"))
    return held, scratch.keep(alike, "alike")


def _same(prefix: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(f"{prefix}doc_id")) & (F.col("digest") == F.col(f"{prefix}digest")) & (F.col("line") == F.col(f"{prefix}line"))


def learned(docs: DataFrame, scratch: Scratch, held: DataFrame, alike: DataFrame) -> Model:
    """The model that this corpus trains: SAMPLE paragraphs at most reach the driver, as their words."""
    notices_here = alike.filter(F.col("alike") >= ALIKE).select(*(F.col(k).alias(f"n_{k}") for k in KEY)).distinct()
    near = held.join(notices_here, _same("n_"), "left_anti").select("features").distinct().withColumn("h", F.xxhash64(F.array_join("features", " ")))
    part = max(1, near.count() // (2 * SAMPLE))
    near = scratch.keep(near.filter(F.pmod("h", F.lit(part)) == 0), "near")
    return train(_sampled(near, SAMPLE // 2) + _sampled(_any_paragraphs(docs, scratch), SAMPLE // 2))


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, digest, line, family, probability, alike, confirmed of every paragraph with a needed word or an anchor.

    A confirmed paragraph that holds a whole template of other families, Proprietary not among them, has a row for each of
    these, with the paragraph's probability. One that says what is not the case is not confirmed. Null and empty texts hold
    none. Rows alike in doc_id and text are scanned once. Without a model, docs trains one.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    held, alike = _held_with_alike(docs, scratch)
    model = model or learned(docs, scratch, held, alike)
    scored = _scores(spark, held, KEY, model)
    best = F.array_max(F.transform("scores", lambda s, i: F.struct(s.alias("score"), (-i).alias("i"))))
    total = F.aggregate(F.transform("scores", lambda s: F.exp((s - F.array_max("scores")) / model.temperature)), F.lit(0.0), lambda a, e: a + e)
    said = scored.withColumn("best", best).withColumn("probability", 1 / total)
    names = F.array(*map(F.lit, model.families))
    said = said.select(*KEY, "negated", names[-F.col("best.i")].alias("said"), "probability")
    said = scratch.keep(said, "said")
    alike = alike.select(*(F.col(k).alias(f"a_{k}") for k in KEY), "t_family", "alike")
    made = said.join(alike, _same("a_") & (F.col("said") == F.col("t_family")), "left").withColumn("alike", F.coalesce("alike", F.lit(0.0)))
    sure = (F.col("said") != UNKNOWN) & (F.col("probability") >= PROBABLE) & (F.col("alike") >= ALIKE) & ~F.col("negated")
    made = made.select(*KEY, F.when(sure, F.col("said")).otherwise(UNKNOWN).alias("family"), "probability", "alike", sure.alias("confirmed"))
    whole = alike.filter((F.col("alike") == 1) & (F.col("t_family") != "Proprietary"))
    more = made.filter("confirmed").select(*KEY, "family", "probability").join(whole, _same("a_") & (F.col("t_family") != F.col("family")))
    return made.unionByName(more.select(*KEY, F.col("t_family").alias("family"), "probability", "alike", F.lit(True).alias("confirmed")))


def literal(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table from values in the plan: a thousand rows or so, fixed by the notices above."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def _scores(spark: SparkSession, held: DataFrame, key: tuple[str, ...], model: Model) -> DataFrame:
    """key and scores: a number for each family, the weights of the paragraph's features added up; none for the empty one, which holds paragraphs without a known feature."""
    weights = literal(spark, [{"feature": f, "weight": w.round(6).tolist()} for f, w in model.weight.items()] + [{"feature": "", "weight": [0.0] * len(model.families)}], "feature string, weight array<double>")
    each = held.select(*key, "negated", F.explode(F.array_append("features", F.lit(""))).alias("w")).join(F.broadcast(weights), F.col("w") == F.col("feature"))
    sums = [(F.sum(F.col("weight")[i]) + float(model.intercept[i])).alias(f"s{i}") for i in range(len(model.families))]
    return each.groupBy(*key, "negated").agg(*sums).select(*key, "negated", F.array(*(F.col(f"s{i}") for i in range(len(model.families)))).alias("scores"))


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs (with a needed word or an anchor), n_confirmed, families (sorted, joined by blanks, empty if none) and probability (the surest confirmed one's, else 0) of every row of docs (doc_id, text)."""
    found = scan(docs)
    by_doc = found.groupBy(F.col("doc_id").alias("d0"), F.col("digest").alias("g0")).agg(
        F.count_distinct("line").alias("n_paragraphs"),
        F.count_distinct(F.when(F.col("confirmed"), F.col("line"))).alias("n_confirmed"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), " ").alias("families"),
        F.coalesce(F.max(F.when(F.col("confirmed"), F.col("probability"))), F.lit(0.0)).alias("probability"),
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"))
    made = rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("d0")) & (F.col("digest") == F.col("g0")), "left")
    none = F.lit(0).cast("long")
    return made.select("doc_id", F.coalesce("n_paragraphs", none).alias("n_paragraphs"), F.coalesce("n_confirmed", none).alias("n_confirmed"), F.coalesce("families", F.lit("")).alias("families"), F.coalesce("probability", F.lit(0.0)).alias("probability"))
