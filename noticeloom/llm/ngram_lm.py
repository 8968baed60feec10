"""Language-model scores from a weighted backoff automaton.

The model is an interpolated n-gram model. Its lowest order is the add-one unigram; a higher order discounts every count
that it keeps and leaves the rest of its mass to the next lower order. As an automaton, a kept history is a state, a kept
n-gram an arc with its log-probability, and every state has a failure arc to its shorter history that weighs what the
discounts left. A text is read once from left to right: a token is tried in the state, failure arcs are followed and their
weights added until an arc carries the token, and the arc's target is the next state.

Every word and every n-gram of the training rows is kept, so the model grows with the corpus and no process holds it
whole. Texts are cut into blocks; a block's distinct n-grams are counted there and sent, by their histories, to buckets
whose number follows the corpus. A bucket adds the counts up and answers each block with those that it asked for. A state
needs its own count, which it has as an n-gram of one size less, and how many kinds of arcs it has. A history that occurs
more often than a bucket holds is hot: its arcs are dealt out by their own hashes, and the buckets' numbers of kinds are
added up; there is at most one such history for each bucket's share of the training tokens, and these are broadcast. Failure
arcs are followed from the longest history, so a token's probability is built from the unigram upwards. Words are known
by 64 bits of BLAKE2b, histories by 64 bits mixed from these, the word after one by 32.

Automaton is the same model in one process, for a corpus that fits there.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import Scratch, binary, crc_fold

ORDER = 3
#: The share of all tokens that a word needs in Automaton; 0 keeps all.
HEAD = 0.0
DISCOUNT = 0.75
#: The token at a text's end; no word holds a line end.
END = b"\n"
#: Tokens of a block of texts, and of the training texts for each bucket of n-grams.
BLOCK, BUCKET = 1 << 20, 1 << 20


def tokens(raw: bytes) -> list[bytes]:
    """Lower-cased words (A-Z alone) between ASCII white space, then the end."""
    made = raw.lower().split()
    made.append(END)
    return made


def _sum_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("n").alias("n"))


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n over all of texts (text); words are counted in each batch before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return made

        for batch in batches:
            for raw in binary(batch.column("text")):
                held.update(tokens(raw or b""))
                if len(held) > 500_000:
                    yield out()
        yield out()

    return _sum_by(texts.select("text").mapInArrow(count, "word string, n bigint"), "word")


def _history_counts(texts: DataFrame, shared, order: int) -> DataFrame:
    """size, code, n of all n-grams of sizes 2 to order whose words are all history words; code: their numbers to the base of the words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value["number"]
        base, end = len(number), number.get(END, -1)
        held: list[list[np.ndarray]] = [[] for _ in range(order + 1)]

        def out() -> Iterator[pa.RecordBatch]:
            for size in range(2, order + 1):
                if held[size]:
                    code, n = np.unique(np.concatenate(held[size]), return_counts=True)
                    held[size].clear()
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), size, np.int32)), pa.array(code), pa.array(n.astype(np.int64))], ["size", "code", "n"])

        rows = 0
        for batch in batches:
            for raw in binary(batch.column("text")):
                ids = np.fromiter(_numbers(number, end, raw or b""), np.int64)
                code, whole = ids, ids >= 0
                for size in range(2, order + 1):
                    code = code[:-1] * base + ids[size - 1 :]
                    whole = whole[:-1] & (ids[size - 1 :] >= 0)
                    kept = code[whole]
                    held[size].append(kept)
                    rows += len(kept)
            if rows > 4_000_000:
                yield from out()
                rows = 0
        yield from out()

    made = texts.select("text").mapInArrow(count, "size int, code bigint, n bigint")
    return _sum_by(made, "size", "code")


def _numbers(number: dict[bytes, int], end: int, raw: bytes) -> Iterator[int]:
    """The numbers of a text's tokens after that of the end before it, which is where every text starts; -1: no history word."""
    yield end
    for t in tokens(raw):
        yield number.get(t, -1)


class Automaton:
    """States are histories; 0 is the empty one. Arcs and failure arcs carry log10 weights."""

    def __init__(self, model: dict):
        self.number, self.head, self.unknown = model["number"], model["head"], model["unknown"]
        base, total = len(self.number), model["tokens"]
        grams = {size: dict(zip(codes.tolist(), ns.tolist())) for size, (codes, ns) in model["grams"].items()}
        #: The count of each history: its own, or for one word how often it occurs before another token.
        history = {1: dict(enumerate(model["history"].tolist()))} | grams
        self.start = self.number.get(END, -1)
        root = {w: math.log10((c + 1) / total) for w, c in self.head.items()}
        self.root = root
        words = list(self.number)
        state_of: dict[tuple[int, int], int] = {(0, 0): 0}
        kept: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for size, found in sorted(grams.items()):
            for code, n in found.items():
                kept.setdefault((size - 1, code // base), []).append((code % base, n))
        for key in sorted(kept):
            state_of[key] = len(state_of)
        self.fail = [(-1, 0.0)] * len(state_of)
        self.arcs: list[dict[bytes, tuple[float, int]]] = [{} for _ in state_of]

        def state(size: int, code: int) -> int:
            while (size, code) not in state_of:
                size, code = size - 1, code % base ** (size - 1)
            return state_of[size, code]

        linear: list[dict[int, float]] = [{} for _ in state_of]
        self.state, self.base = state, base
        for key in sorted(kept):  # shorter histories first
            size, code = key
            at, n = state_of[key], max(history[size][code], sum(c for _, c in kept[key]))
            lower = state(size - 1, code % base ** (size - 1))
            left = 1 - sum(c - DISCOUNT for _, c in kept[key]) / n
            self.fail[at] = (lower, math.log10(left))
            for w, c in kept[key]:
                p = (c - DISCOUNT) / n + left * self._chance(linear, lower, w, words)
                linear[at][w] = p
                code_here = code * base + w
                to = (size + 1, code_here) if size + 1 < model["order"] else (size, code_here % base**size)
                self.arcs[at][words[w]] = (math.log10(p), state(*to))
        self.first = [state(1, i) for i in range(base)]  # from the empty history, a word's own state

    def _chance(self, linear: list[dict[int, float]], at: int, w: int, words: list[bytes]) -> float:
        """The probability of a history word in a state, by its arcs and failure arcs."""
        weight = 1.0
        while at:
            if w in linear[at]:
                return weight * linear[at][w]
            at, lost = self.fail[at]
            weight *= 10**lost
        return weight * 10 ** self.root[words[w]]

    def read(self, raw: bytes) -> tuple[int, float, float, Counter[bytes]]:
        """Tokens, base score and model score as far as they are known here, and the words whose unigrams are not."""
        arcs, fail, root, number, first = self.arcs, self.fail, self.root, self.number, self.first
        at = first[self.start] if self.start >= 0 else 0
        base = score = 0.0
        rare: Counter[bytes] = Counter()
        made = tokens(raw)
        for t in made:
            p = root.get(t)
            if p is None:
                rare[t] += 1  # added to both scores when its count is joined
                while at:
                    at, lost = fail[at]
                    score += lost
                continue
            base += p
            while at:
                arc = arcs[at].get(t)
                if arc is not None:
                    score += arc[0]
                    at = arc[1]
                    break
                at, lost = fail[at]
                score += lost
            else:
                score += p
                i = number.get(t)
                at = 0 if i is None else first[i]
        return len(made), base, score, rare


def train(texts: DataFrame, scratch: Scratch, order: int = ORDER) -> tuple[DataFrame, dict]:
    """The counts of all words as a table (word, n), and all that an automaton in one process needs."""
    spark = texts.sparkSession
    counts = scratch.keep(word_counts(texts), "words")
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = counts.filter(F.col("n") >= max(1.0, HEAD * total)).orderBy(F.desc("n"), "word").toPandas()
    words = [w.encode() for w in head["word"]]
    if len(words) ** order >= 2**63:
        raise ValueError("too many words for an automaton in one process")
    of_head = dict(zip(words, head["n"].tolist()))
    model = {"number": {w: i for i, w in enumerate(words)}, "head": of_head, "tokens": total + kinds + 1, "order": order}
    model["unknown"] = -math.log10(model["tokens"])
    # Every token but the last of a text stands before another; before a text's first stands the end of none.
    model["history"] = np.array([of_head[w] for w in words], np.int64)
    grams = _history_counts(texts, spark.sparkContext.broadcast(model), order)
    grams = grams.orderBy("size", "code").toPandas()
    model["grams"] = {size: (g["code"].to_numpy(), g["n"].to_numpy()) for size, g in grams.groupby("size")}
    return counts, {"model": model, "train_tokens": total}


def _blocks(docs: DataFrame) -> DataFrame:
    """Blocks of docs (doc_id, text, held_out): their rows, how many tokens each has, all tokens as places in the block's words, and the words' hashes."""
    kind, limit = docs.schema["doc_id"].dataType.simpleString(), BLOCK

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        place: dict[bytes, int] = {END: 0}
        ids, held, sizes, places = [], [], [], []

        def out() -> pa.RecordBatch:
            words = b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in place)
            train = sum(n for n, h in zip(sizes, held) if not h)
            row = [first + made], [list(ids)], [list(held)], [list(sizes)], [train], [_pack(np.array(places, np.int32))], [words]
            for x in (ids, held, sizes, places):
                x.clear()
            place.clear()
            place[END] = 0
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names)

        for batch in batches:
            doc_ids = batch.column("doc_id")
            types = [pa.int64(), pa.list_(doc_ids.type), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary()]
            for doc_id, raw, h in zip(doc_ids.to_pylist(), binary(batch.column("text")), batch.column("held_out").to_pylist()):
                text = tokens(raw or b"")
                places.extend([place.setdefault(t, len(place)) for t in text])
                ids.append(doc_id)
                held.append(h)
                sizes.append(len(text))
                if len(places) >= limit:
                    yield out()
                    made += 1
        if ids:
            yield out()

    names = ["block", "doc_id", "held", "sizes", "train", "places", "words"]
    return docs.select("doc_id", "text", "held_out").mapInArrow(cut, f"block bigint, doc_id array<{kind}>, held array<boolean>, sizes array<int>, train bigint, places binary, words binary")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _after(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of each n-gram: of its history's, and 32 bits of its last word."""
    return _mix(history + (word.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


class Block:
    """A block's n-grams: the distinct ones in order of (history, word), and where each token's stands among them."""

    def __init__(self, row: dict):
        words = np.frombuffer(row["words"], np.uint64)
        self.sizes, self.held = np.array(row["sizes"], np.int64), np.array(row["held"], bool)
        self.word = words[_unpack(row["places"], np.int32)]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.depth = np.arange(len(self.word)) - self.starts[self.doc] + 1  # words before a token, the end of none among them
        self.learned, self.end = ~self.held[self.doc], _mix(words[:1])[0]

    def before(self, each: np.ndarray, start: np.generic) -> np.ndarray:
        """What each token's predecessor has; start: what the end of none has, which stands before a text's first token."""
        out = np.empty_like(each)
        out[1:] = each[:-1]
        out[self.starts] = start
        return out

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Histories, words and training counts of the distinct n-grams; the tokens that have one, and which."""
        at, history, word = np.arange(len(self.word)), _mix(self.word), np.zeros(len(self.word), np.uint32)
        last = (self.word >> np.uint64(32)).astype(np.uint32)
        for back in range(2, size + 1):
            history, word = self.before(history if back == 2 else _after(history, word), self.end), last
        if size > 2:  # before a text's first tokens there are too few
            at = np.flatnonzero(self.depth >= size - 1)
            history, word = history[at], word[at]
        history, word, gram, where = _distinct(history, word)
        n = np.bincount(gram, self.learned[at][where], len(history)).astype(np.int32)
        which = np.empty(len(at), np.int64)
        which[where] = gram
        return history, word, n, at, which


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _is_hot(history: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Whether each history is one of hot (in order)."""
    if not len(hot):
        return np.zeros(len(history), bool)
    return hot[np.minimum(np.searchsorted(hot, history), len(hot) - 1)] == history


def _place(history: np.ndarray, word: np.ndarray, buckets: int, hot: np.ndarray) -> np.ndarray:
    """The bucket of each n-gram: its history's, or its own where the history is hot."""
    return _bucket(np.where(_is_hot(history, hot), _after(history, word), history), buckets)


def _distinct(history: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in order, the pair of each entry in that order, and the order."""
    by = np.argsort(history)  # two sorts of plain numbers take a third of lexsort's time
    h = history[by]
    state = np.cumsum(np.append(False, h[1:] != h[:-1])[: len(h)]).astype(np.uint64)
    where = by[np.argsort(state << np.uint64(32) | word[by])]
    h, w = history[where], word[where]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    return h[new], w[new], np.cumsum(new) - 1, where


def _pack(x: np.ndarray) -> bytes:
    """Compressed: the first bytes of all numbers, the second ones and so on; before them, how many bytes there are."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _unpack(raw: bytes, kind: type) -> np.ndarray:
    plain = pa.Codec("zstd").decompress(memoryview(raw)[8:], int.from_bytes(raw[:8], "little"))
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _asked(blocks: DataFrame, size: int, buckets: int, hot: Broadcast) -> DataFrame:
    """bucket, block, histories, words, n: the n-grams of a size in each block for each bucket, a range of histories' hashes."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                history, word, n, _, _ = Block(row).grams(size)
                bucket = _place(history, word, buckets, hot.value)
                order = np.argsort(bucket, kind="stable")
                history, word, n = history[order], word[order], n[order]
                held, starts = np.unique(bucket[order], return_index=True)
                ends = np.append(starts, len(history))[1:]
                parts = [(_pack(np.diff(history[a:b], prepend=np.uint64(0))), _pack(word[a:b]), _pack(n[a:b])) for a, b in zip(starts, ends)]
                columns = [pa.array(held.astype(np.int64)), pa.array([row["block"]] * len(held), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(list(x), pa.binary()) for x in (zip(*parts) if parts else ([], [], []))], names)

    names = ["bucket", "block", "histories", "words", "n"]
    return blocks.mapInArrow(ask, "bucket bigint, block bigint, histories binary, words binary, n binary")


#: Answers of a bucket to a block, and rows of the bucket itself: at KINDS, hot histories (in n) and how many kinds of tokens
#: follow them in this bucket; at MANY, the n-grams that occur more than BUCKET times, which are hot as histories.
ANSWER, KINDS, MANY = "size int, bucket bigint, block bigint, kinds bigint, n binary, after binary", -1, -2


def _answer(asked: pa.Table, size: int, hot: np.ndarray, limit: int) -> pa.Table:
    """For each block's n-grams in one bucket, how often they occur, and how many kinds of tokens follow their histories (0 for hot ones)."""
    parts = [(np.cumsum(_unpack(h, np.uint64), dtype=np.uint64), _unpack(w, np.uint32), _unpack(n, np.int32)) for h, w, n in zip(*(asked.column(c).to_pylist() for c in ("histories", "words", "n")))]
    history, word, n = (np.concatenate(x) for x in zip(*parts))
    h, w, gram, where = _distinct(history, word)
    count = np.add.reduceat(n[where], np.flatnonzero(np.diff(gram, prepend=-1)), dtype=np.int64)
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    kinds = np.add.reduceat((count > 0).astype(np.int64), first).astype(np.int32)
    spread = _is_hot(h[first], hot)
    after = np.repeat(np.where(spread, 0, kinds), np.diff(np.append(first, len(h)))).astype(np.int32)
    place = np.empty(len(n), np.int64)
    place[where] = gram
    ends = np.cumsum([len(p[2]) for p in parts])
    bucket, rows, whole = asked.column("bucket")[0].as_py(), [], int((count > 0).sum())
    for block, e, p in zip(asked.column("block").to_pylist(), ends, parts):
        x = place[e - len(p[2]) : e]
        rows.append((size, bucket, block, whole, _pack(count[x]), _pack(after[x])))
        whole = 0
    if spread.any():
        rows.append((size, bucket, KINDS, 0, _pack(h[first][spread]), _pack(kinds[spread])))
    if (many := count > limit).any():
        rows.append((size, bucket, MANY, 0, _pack(h[many] if size == 1 else _after(h[many], w[many])), _pack(count[many])))
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(list(c), k) for c, k in zip(zip(*rows), types)], ["size", "bucket", "block", "kinds", "n", "after"])


def _answering(size: int, hot: Broadcast, limit: int) -> Callable[[pa.Table], pa.Table]:
    """_answer as a function of the table alone, as Spark counts its parameters."""
    return lambda asked: _answer(asked, size, hot.value, limit)


def _collected(answers: DataFrame, row: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order and numbers of the buckets' own rows; equal hashes are added up. At most one hash for each BUCKET training tokens."""
    told = answers.filter(F.col("block") == row).select("n", "after").collect()
    keys = np.concatenate([np.empty(0, np.uint64)] + [_unpack(r["n"], np.uint64) for r in told])
    numbers = np.concatenate([np.empty(0, np.int64)] + [_unpack(r["after"], kind).astype(np.int64) for r in told])
    keys, of = np.unique(keys, return_inverse=True)
    return keys, np.bincount(of, numbers, len(keys)).astype(np.int64)


def lm_scores(docs: DataFrame, folds: int = 7, held: int = 2, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs (doc_id, text).

    The model learns from rows whose crc32(doc_id as text) mod folds is not held. A null text is empty: its end alone. A
    word that was never seen has the unigram's share for one more word; without any training row all words are unseen.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    blocks = scratch.keep(_blocks(docs.select("doc_id", "text", (crc_fold(folds) == held).alias("held_out"))), "blocks")
    whole = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)
    total, every = blocks.agg(F.coalesce(F.sum("train"), F.lit(0)), F.coalesce(F.sum(whole), F.lit(0))).first()
    texts = blocks.select("block", "held", "sizes", "places", "words")
    answers, hot, spread = {}, {}, {}
    buckets, limit = every // BUCKET + 1, BUCKET  # held-out texts ask for their n-grams too
    many = np.empty(0, np.uint64)
    for size in range(1, order + 1):  # the shortest first: their counts tell which histories of the next size are hot
        hot[size] = many
        shared = spark.sparkContext.broadcast(many)
        made = _asked(texts, size, buckets, shared).groupBy("bucket").applyInArrow(_answering(size, shared, limit), ANSWER)
        made = scratch.keep(made, f"answers{size}")
        answers[size] = made.filter("block >= 0")
        spread[size] = _collected(made, KINDS, np.int32)
        many, _ = _collected(made, MANY, np.int64)
    told = spark.sparkContext.broadcast((hot, spread))
    kinds = answers[1].agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0]
    shares = total + kinds + 1

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block = Block(row)
        size_of, place_of = (np.array(right.column(c).to_pylist(), np.int64) for c in ("size", "bucket"))
        hot, spread = told.value
        p = base = known = lower = None
        for size in range(1, order + 1):
            mine = [int(i) for i in np.argsort(place_of) if size_of[i] == size]
            history, word, _, at, which = block.grams(size)
            if not len(at):
                continue
            by = np.argsort(_place(history, word, buckets, hot[size]), kind="stable")
            n, kinds_after = np.empty(len(by), np.int64), np.empty(len(by), np.int64)
            n[by] = np.concatenate([_unpack(right.column("n")[i].as_py(), np.int64) for i in mine])
            here = n[which]
            if size == 1:
                p, known = (here + 1) / shares, here > 0
                base = np.log10(p)
                lower = block.before(here, n[np.searchsorted(history, block.end)])
                continue
            kinds_after[by] = np.concatenate([_unpack(right.column("after")[i].as_py(), np.int32) for i in mine])
            keys, numbers = spread[size]
            if len(keys):
                there = _is_hot(history, keys)
                kinds_after[there] = numbers[np.searchsorted(keys, history[there])]
            state = lower[at] > 0  # a history is followed as often as it occurs
            t = at[state]
            p[t] = (np.maximum(here[state] - DISCOUNT, 0) + DISCOUNT * kinds_after[which][state] * p[t]) / lower[t]
            full = np.zeros(len(p), np.int64)
            full[at] = here
            lower = block.before(full, 0)
        add = lambda x: np.bincount(block.doc, x, len(block.sizes))
        columns = [left.column("doc_id").combine_chunks().flatten(), pa.array(block.held), pa.array(block.sizes), pa.array(add(known).astype(np.int64)), pa.array(add(base)), pa.array(add(np.log10(p)))]
        return pa.table(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = reduce(DataFrame.unionByName, answers.values()).drop("kinds")
    made = blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(read, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return made.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
