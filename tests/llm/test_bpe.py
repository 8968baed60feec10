"""The transducer against the library, whole texts and in pieces."""

import random
import struct

import pytest
from noticeloom.llm import bpe
from noticeloom.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(**bpe.vocabulary_parts(vocabulary_path()))


def ids(encoder, text):
    raw = bpe.encode_ids(encoder, text.encode())
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


PARTS = ["a", "b", "th", "e", " ", "  ", "\n", "\t", "'s", "'re", "'", "1", "23", "é", "日本", "🙂", " ", "\x1c", "<|endoftext|>", "<|end", "!!", "$", "²", "́", "　", "'ll", "ſ"]


@pytest.mark.parametrize("chunk", [1 << 20, 3, 40, 64, 101])
def test_fuzz(monkeypatch, library, vocabulary, chunk):
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    encoder, rng = bpe.Encoder(vocabulary), random.Random(chunk)
    for _ in range(300):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 160)))
        got = ids(encoder, text)
        assert got == library.encode(text, add_special_tokens=False).ids
        decoder = bpe.Decoder(vocabulary)
        assert decoder.feed(got) + decoder.finish() == library.decode(got, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9_000 + " x", "!" * 9_000, "1" * 7_000, " " * 5_000 + "x", " " * 5_000 + "\n" * 3_000, " " * 4_000 + "<|endoftext|>", "the" * 6_000])
def test_long_pieces(monkeypatch, library, vocabulary, text):
    monkeypatch.setattr(bpe, "CHUNK", 2_000)
    assert ids(bpe.Encoder(vocabulary), text) == library.encode(text, add_special_tokens=False).ids


def test_stable_tokens_come_early(monkeypatch, vocabulary):
    monkeypatch.setattr(bpe.PieceTransducer, "BLOCK", 64)
    rng = random.Random(4)
    piece = "".join(rng.choice("aeinrsth") for _ in range(20_000)).encode()
    machine, out, most = bpe.PieceTransducer(vocabulary), [], 0
    for at in range(0, len(piece), 50):
        out += machine.feed(piece[at : at + 50])
        most = max(most, len(machine.held))
    out += machine.finish()
    assert out == vocabulary.merge(piece)
    assert most <= vocabulary.lookahead + 64 + vocabulary.longest


def test_every_character(library, vocabulary):
    """Every scalar value alone, between letters and between blanks."""
    encoder = bpe.Encoder(vocabulary)
    codes = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(codes), 40):
        text = " ".join(codes[at : at + 20]) + "a".join(codes[at + 20 : at + 40])
        assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids, hex(ord(codes[at]))


def test_lookahead_suffices_for_random_merge_lists(monkeypatch):
    """Tokens that the machine emits early are those of the whole piece, whatever the merges."""
    import json

    monkeypatch.setattr(bpe.PieceTransducer, "BLOCK", 1)
    rng = random.Random(11)
    for _ in range(150):
        merges, known = [], list("abc")
        for _ in range(rng.randint(1, 12)):
            a, b = rng.choice(known), rng.choice(known)
            if f"{a} {b}" not in merges and len(a + b) <= 12:
                merges.append(f"{a} {b}")
                known.append(a + b)
        vocab = {t: i for i, t in enumerate(dict.fromkeys([*bpe.byte_characters(), *known]))}
        made = bpe.Vocabulary(json.dumps({"model": {"type": "BPE", "vocab": vocab, "merges": merges}}), "a-z", "0-9")
        for _ in range(30):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 120)))
            assert list(bpe.PieceTransducer(made).whole(piece)) == made.merge(piece)


def test_long_pieces_are_emitted_before_they_end(library, vocabulary):
    """A piece over the lookahead is emitted in parts in any text; the splitter keeps a chunk, the merger a block."""
    encoder, text, got = bpe.Encoder(vocabulary), "x " + "ab" * 150_000, []
    for at in range(0, len(text), 1_000):
        got.append(encoder.feed(text[at : at + 1_000]))
        assert len(encoder.held) < 1_100
    assert sum(map(len, got)) > 4 * 100_000
    assert b"".join(got) + encoder.finish() == bpe.encode_ids(bpe.Encoder(vocabulary), text.encode())


@pytest.mark.parametrize("change", [{"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"model": {"ignore_merges": True}}, {"added_tokens": [{"content": "x", "id": 1, "lstrip": True}]}])
def test_other_tokenizers_are_refused(change):
    import json

    with pytest.raises(ValueError, match="unsupported"):
        bpe.Vocabulary(json.dumps({"model": {"type": "BPE", "vocab": {"a": 0}, "merges": []}} | change), "a-z", "0-9")


def test_unknown_ids_stand_for_nothing(spark):
    tokens = spark.createDataFrame([(1, [64, 99_999_999, None, -5, 65]), (2, None), (3, [])], "doc_id long, tokens array<int>")
    assert {r["doc_id"]: r["text"] for r in bpe.bpe_text(tokens, vocabulary_path()).collect()} == {1: "ab", 2: "", 3: ""}


def test_tokens_keep_all_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 5, 6), (None, None, None, None, None)], "doc_id long, text string, tokens string, row int, `a.b` int")
    made = bpe.bpe_tokens(docs, vocabulary_path())
    assert made.columns == ["doc_id", "text", "row", "a.b", "tokens"]
    assert sorted(map(tuple, made.collect()), key=str) == [(1, "a b", 5, 6, [64, 275]), (None, None, None, None, [])]


def test_frame(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tokens = bpe.bpe_tokens(docs, vocabulary_path())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in tokens.collect():
        assert r["tokens"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
    assert {r["doc_id"]: r["text"] for r in bpe.bpe_text(tokens, vocabulary_path()).collect()} == texts


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "x")], "doc_id long, text string")
    rows = bpe.bpe_round_trip(docs, vocabulary_path()).collect()
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert sorted(r["n_tokens"] for r in rows) == [0, 0, 0, 1]
    assert sum(r["ids_sha256"] == r["decoded_sha256"] == empty for r in rows) == 3
    assert bpe.bpe_round_trip(docs.limit(0), vocabulary_path()).count() == 0


def test_frequent_words_outlive_a_full_memory(vocabulary, monkeypatch):
    """A word that comes again and again is merged once, though rare ones fill the memory between."""
    monkeypatch.setattr(bpe, "REMEMBERED", 8)
    met, real = [], vocabulary.merge
    monkeypatch.setattr(vocabulary, "merge", lambda piece: met.append(piece) or real(piece))
    text = " ".join(f"often rare{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    got = bpe.encode_ids(bpe.Encoder(vocabulary), text.encode())
    assert met.count(b" often") == 1
    monkeypatch.setattr(bpe, "REMEMBERED", 400_000)
    assert got == bpe.encode_ids(bpe.Encoder(vocabulary), text.encode())
