"""The pipeline's stages against each operator's own brute force, on a small corpus."""

from types import SimpleNamespace

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from noticeloom.llm import bpe, quality
from noticeloom.llm.common import AT_ONCE
from noticeloom.llm.lines import MIN_WORDS
from noticeloom.llm.queries import vocabulary_path
from test_lines import brute, left
from test_mixing import targets
from test_quality import base
from test_simhash import least, print_of


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "pareto_mix", "bpe"]
    seen, frame = {}, docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, frame, sf)
        if i < 4:
            assert frame.columns == docs.columns
        frame = spark.createDataFrame(frame.collect(), frame.schema)
        seen[name] = frame.collect()
    stages = SimpleNamespace(**{n: {r["doc_id"]: r["text"] for r in rows} for n, rows in seen.items() if n != "bpe"})
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    # Rules: what the base fails goes, and the labels' good documents that pass it stay.
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for i, text in texts.items():
        n, *_, repeated = base(text)
        if n < quality.MIN_WORDS or 100 * repeated > 50 * n:
            assert i not in stages.quality_rules
        elif labels.get(i) == 1:
            assert stages.quality_rules[i] == text
    # Lines: the brute-force cut of what the rules kept.
    cut = brute(list(stages.quality_rules.items()), MIN_WORDS)
    assert stages.line_dedup == {i: left(t, cut[i]) for i, t in stages.quality_rules.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"])
    # Near copies: the least id of every group over all pairs.
    ids = sorted(stages.line_dedup)
    group = least(np.array([print_of(stages.line_dedup[i]) for i in ids], np.uint64), ids)
    assert sorted(r["doc_id"] for r in seen["simhash_near_dedup"]) == sorted(set(group.values()))
    # Mix: sources near their targets, no document more than three times.
    size = {r["doc_id"]: len(r["text"].encode().split()) for r in seen["simhash_near_dedup"]}
    sources, taken, copies = {}, {}, {}
    for r in seen["simhash_near_dedup"]:
        sources[r["source"]] = sources.get(r["source"], 0) + size[r["doc_id"]]
    for r in seen["pareto_mix"]:
        taken[r["source"]] = taken.get(r["source"], 0) + size[r["doc_id"]]
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert max(copies.values()) <= 3
    assert all(abs(taken.get(s, 0) - t) <= max(size.values()) for s, t in targets(sources).items())
    # Tokens: the library's, for every copy.
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary_path())
    want = sorted((r["doc_id"], len(library.encode(r["text"], add_special_tokens=False).ids)) for r in seen["pareto_mix"])
    assert sorted((r["doc_id"], r["n_tokens"]) for r in seen["bpe"]) == want
    for r in seen["bpe"]:
        assert r["tokens"] == library.encode(r["text"], add_special_tokens=False).ids
    assert list(seen["bpe"][0].asDict()) == [*docs.columns, "tokens", "n_tokens"]
    assert corpus_pipeline.run(spark, sf).count() == len(want)


ROWS = "doc_id long, text string, lang string, source string, n_chars long, row int, tokens string, size int, `rank` int, quality double, cuts int"


@pytest.mark.parametrize("rows", [0, 1, 40])
def test_edges_through_all_stages(spark, sf, rows):
    """Empty tables, nulls in every column, repeated rows and extra columns whose names the operators use themselves."""
    text = "\n".join([
        "The first report of the week was read by many people in the small town near the river.",
        "Nobody had expected that prices would fall again, since harvests were poor and winter came early.",
        "A teacher from the northern school said her pupils could explain the numbers better than most experts.",
        "Later on, two farmers brought old ledgers that showed how often such years had come before.",
        "When evening fell, everyone agreed to meet once more and to write down whatever they remembered.",
    ])
    data = [(None,) * 11, (5, "", "en", "a", 0, 1, "t", 2, 3, 0.5, 4)] + [(7, text, None, "b", len(text), 1, "t", 2, 3, 0.5, 4)] * 3
    # The rows behind begin with the same passage: each loses its copy of it.
    data += [(10 + i, f"{text}\nNumber {i} has a line of its own about the topic {i * i}.", "en", None if i % 3 else "a", None, i, None, i, i, None, i) for i in range(rows)]
    frame = spark.createDataFrame(data[: rows and len(data)], ROWS)
    columns = frame.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, frame, sf)
        if name == "line_dedup" and rows:  # a row listed three times keeps its text three times
            assert [r["text"] for r in frame.collect() if r["doc_id"] == 7] == [text] * 3
            assert all(r["text"] for r in frame.collect())
        frame = spark.createDataFrame(frame.collect(), frame.schema)
        assert frame.columns == (columns if i < 4 else [c for c in columns if c != "tokens"] + ["tokens", "n_tokens"])
    assert all(r["text"] for r in frame.collect())


def test_whole_texts_are_worked_on_in_parts(spark, monkeypatch):
    """Of an Arrow batch with many texts a part at a time is given back, every row once and in order; a text goes to Python once."""
    rows = [{"doc_id": i, "text": f"word {i} of a text\n" * (i % 40) if i % 7 else None} for i in range(3 * AT_ONCE + 5)]
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows[:9]], "doc_id long, text string")
    taken, real = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda frame, run, schema: taken.append((frame.columns, run)) or real(frame, run, schema))
    quality.keep_good(docs)
    bpe.bpe_tokens(docs, vocabulary_path())
    assert [columns for columns, _ in taken] == [["text"], ["k0"], ["row"]]
    whole = pa.array(rows, pa.struct([("doc_id", pa.int64()), ("text", pa.string())]))
    inputs, made = [whole.field(1), whole, whole], []
    for (columns, run), column in zip(taken, inputs):
        parts = list(run(iter([pa.RecordBatch.from_arrays([column], columns)])))
        assert [p.num_rows for p in parts] == [AT_ONCE] * 3 + [5]
        made.append(pa.Table.from_batches(parts).to_pylist())
    want = [dict(zip(quality.MEASURES, quality.measure((r["text"] or "").encode()))) for r in rows]
    assert made[0] == want
    assert made[1] == [{"k0": r} | m for r, m in zip(rows, want)]
    encoder = bpe.Encoder(bpe.Vocabulary(**bpe.vocabulary_parts(vocabulary_path())))
    ids = [np.frombuffer(bpe.encode_ids(encoder, (r["text"] or "").encode()), "<i4").tolist() for r in rows]
    assert made[2] == [{"row": r, "tokens": t} for r, t in zip(rows, ids)]
