import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from noticeloom.llm import ngram_lm as lm
from noticeloom.llm.common import Scratch

DOCS = "doc_id long, text string"


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text) + ["\n"]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def check_base(rows, docs):
    counts = Counter(t for i, text in docs if not held(i) for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for i, text in docs:
        made = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in made)
        want[i, held(i), len(made), sum(counts[t] > 0 for t in made), total, round(base, 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == want


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = lm.lm_scores(docs).collect()
    check_base(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_model_beats_the_base_on_held_out_texts(spark):
    import random

    rng = random.Random(1)
    follow = {w: rng.sample("abcdefghijklmnop", 3) for w in "abcdefghijklmnop"}

    def text():
        out = ["a"]
        for _ in range(60):
            out.append(rng.choice(follow[out[-1]]))
        return " ".join(out)

    rows = lm.lm_scores(spark.createDataFrame([(i, text()) for i in range(300)], DOCS)).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > 0.6 * sum(r["base_score"] for r in rows)


def test_every_state_is_a_distribution(spark, monkeypatch):
    """Known words and one for all unknown ones share each state's mass."""
    docs = spark.createDataFrame([(i, "a b c a b d " * (i % 4) + "e f") for i in range(30)], DOCS)
    counts, made = lm.train(docs, Scratch(spark), 3)
    automaton = lm.Automaton(made["model"])
    words = [w.encode() for w, _ in counts.collect()]
    for state in range(len(automaton.fail)):
        mass = 0.0
        for t in [*words, None]:
            at, logp = state, 0.0
            while at and (t is None or t not in automaton.arcs[at]):
                at, lost = automaton.fail[at]
                logp += lost
            logp += automaton.arcs[at][t][0] if at else automaton.unknown if t is None else automaton.root[t]
            mass += 10**logp
        assert mass == pytest.approx(1.0)


def test_traversal_matches_a_recursive_model(spark):
    texts = ["a b a c", "a b a b a", "b a c c", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    _, made = lm.train(docs, Scratch(spark), 3)
    model, grams = made["model"], {}
    seqs = [["\n", *tokens(t)] for t in texts]
    for n in (1, 2, 3):
        grams[n] = Counter(tuple(s[i : i + n]) for s in seqs for i in range(len(s) - n + 1))
    unigrams, total = Counter(t for s in seqs for t in s[1:]), model["tokens"]
    before = {1: Counter(t for s in seqs for t in s[:-1]), 2: grams[2]}

    def p(history, w):
        if not history:
            return (unigrams[w] + 1) / total
        follow = {g[-1]: c for g, c in grams[len(history) + 1].items() if g[:-1] == history}
        if not follow:
            return p(history[1:], w)
        n = max(before[len(history)][history], sum(follow.values()))
        left = 1 - sum(c - lm.DISCOUNT for c in follow.values()) / n
        return max(follow.get(w, 0) - lm.DISCOUNT, 0) / n + left * p(history[1:], w) if w in follow else left * p(history[1:], w)

    automaton = lm.Automaton(model)
    for t, s in zip(texts, seqs):
        want = sum(math.log10(p(tuple(s[max(0, i - 2) : i]), s[i])) for i in range(1, len(s)))
        assert automaton.read(t.encode())[2] == pytest.approx(want)


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, ""), (1, ""), (2, "a  A")], [(i, "x") for i in range(40) if held(i)]])
def test_edges(spark, rows):
    check_base(lm.lm_scores(spark.createDataFrame(rows, DOCS)).collect(), rows)


def test_rare_words_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 0.05)
    docs = [(i, f"common word{i % 7} rare{i}") for i in range(60)]
    check_base(lm.lm_scores(spark.createDataFrame(docs, DOCS)).collect(), docs)
    assert np.isfinite([r["score"] for r in lm.lm_scores(spark.createDataFrame(docs, DOCS)).collect()]).all()


def test_every_ngram_counts_however_large_the_corpus(spark, monkeypatch):
    """Blocks and buckets give what one automaton of all n-grams gives; almost every pair occurs twice at most in 33,000 tokens."""
    monkeypatch.setattr(lm, "BLOCK", 1000, raising=False)
    monkeypatch.setattr(lm, "BUCKET", 5000, raising=False)
    docs = [(i, " ".join(f"w{(i % 500) * 40 + j}" for j in range(30)) + (" w1 w2" if i % 3 else " new")) for i in range(1000)] + [(1000, None), (1001, "w1 never w2")]
    table = spark.createDataFrame(docs, DOCS)
    rows = lm.lm_scores(table).collect()
    check_base(rows, docs)
    _, made = lm.train(spark.createDataFrame([d for d in docs if not held(d[0])], DOCS), Scratch(spark), 3)
    assert len(made["model"]["number"]) > 12000
    automaton, texts = lm.Automaton(made["model"]), dict(docs)
    for r in rows:
        _, _, score, unseen = automaton.read((texts[r["doc_id"]] or "").encode())
        assert r["score"] == pytest.approx(score + sum(unseen.values()) * automaton.unknown)
    assert max(r["score"] / r["n_tokens"] for r in rows if r["n_tokens"] > 10) > -1.5


@pytest.mark.parametrize("bucket", [40, 400])
def test_hot_histories_are_spread(spark, monkeypatch, bucket):
    """Words and pairs that occur more often than a bucket holds give the same scores, for every document."""
    import random

    monkeypatch.setattr(lm, "BLOCK", 150)
    monkeypatch.setattr(lm, "BUCKET", bucket)
    rng = random.Random(bucket)
    docs = [(i, " ".join(rng.choice(["the", "the", "of the", "a", f"w{rng.randint(0, 30)}"]) for _ in range(rng.randint(0, 20)))) for i in range(250)]
    rows = lm.lm_scores(spark.createDataFrame(docs, DOCS)).collect()
    check_base(rows, docs)
    _, made = lm.train(spark.createDataFrame([d for d in docs if not held(d[0])], DOCS), Scratch(spark), 3)
    automaton, texts = lm.Automaton(made["model"]), dict(docs)
    for r in rows:
        _, _, score, unseen = automaton.read(texts[r["doc_id"]].encode())
        assert r["score"] == pytest.approx(score + sum(unseen.values()) * automaton.unknown)


def test_everything_held_out(spark, monkeypatch):
    """Without a training row all words are unseen; n-grams are still dealt over buckets, by all tokens."""
    monkeypatch.setattr(lm, "BUCKET", 64)
    docs = spark.createDataFrame([(i, f"a b c w{i} x{i} y{i}") for i in range(100)], "doc_id long, text string")
    made = lm.lm_scores(docs, folds=1, held=0).collect()
    assert len(made) == 100 and all(r["held_out"] and r["train_tokens"] == 0 and r["n_known"] == 0 for r in made)
    assert all(r["n_tokens"] == 7 and r["score"] == r["base_score"] == 0.0 for r in made)  # log10 of 1 / (0 + 0 + 1)
