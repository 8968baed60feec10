"""Quality rules as weak supervision.

Every rule votes good or bad on a document or abstains. Expectation-maximisation over the vote patterns of all documents
estimates how accurate each rule is and how common good documents are, without any labels; a document's quality is the
posterior probability that it is good. Vote patterns are few (two to the power of the rules at most), so they are
counted in the cluster and only their counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import binary, in_parts

SPACES = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
#: The floor below which no posterior can keep a document.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


GOOD, BAD = 1, 0


def rules() -> list[tuple[str, int, Column]]:
    """Name, vote and condition of the production rules; where its condition fails, a rule abstains.

    Each fault is watched by rules that read it in different ways, since rules that agree are what EM learns from.
    """
    n, letters = F.col("n_words"), F.greatest(F.col("n_letters"), F.lit(1))
    symbols, symbol_chars = F.col("n_symbols") / n, F.col("n_symbols") / F.col("word_chars")
    repeats, dup_lines = F.col("n_repeat_words") / n, F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    distinct = F.col("n_distinct") / F.sqrt(n * F.least(n, F.lit(400)))  # of a text of n words, whose distinct ones grow slower
    length, wordlike, odd_ends = F.col("word_chars") / n, F.col("n_wordlike") / n, F.col("n_odd_ends") / n
    upper = F.when(letters >= 20, F.col("n_upper") / letters).otherwise(0.0)
    shouted = F.col("n_exclaimed") / n
    plain = (symbols <= 0.01) & (repeats < 0.5) & (odd_ends <= 0.05) & (wordlike >= 0.8) & length.between(3.0, 9.0)
    calm = (repeats <= 0.2) & (dup_lines <= 0.05) & (distinct >= 0.4) & (upper <= 0.15) & (shouted <= 0.05)
    return [
        ("symbols", BAD, symbols >= 0.1),
        ("symbol_chars", BAD, symbol_chars >= 0.03),
        ("odd_ends", BAD, odd_ends >= 0.2),
        ("not_words", BAD, wordlike <= 0.65),
        ("repeats", BAD, repeats >= 0.5),
        ("dup_lines", BAD, dup_lines >= 0.3),
        ("few_distinct", BAD, distinct <= 0.3),
        ("upper", BAD, upper >= 0.5),
        ("shouted", BAD, shouted >= 0.3),
        ("length", BAD, (length >= 12.0) | (length <= 2.5)),
        ("plain", GOOD, plain),
        ("calm", GOOD, calm),
    ]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper", "n_letters", "n_wordlike", "n_odd_ends", "n_exclaimed", "n_lines")


def measure(raw: bytes) -> tuple[int, ...]:
    """MEASURES of one text. Words lie between ASCII white space; one is word-like if it begins with a letter, and ends oddly if with a symbol."""
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * len(MEASURES)
    text = raw.decode("utf-8", "replace")
    chars = len(text) - (len(raw) - len(raw.translate(None, SPACES)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    first = np.fromiter(map(seen.setdefault, words, range(n)), np.int64, n)
    letters = np.frombuffer(raw, np.uint8)
    upper = int(((letters >= 65) & (letters <= 90)).sum())
    lower = int(((letters >= 97) & (letters <= 122)).sum())
    starts = np.frombuffer(b"".join([w[:1] for w in words]), np.uint8)
    wordlike = int(((starts >= 128) | ((starts | 32) >= 97) & ((starts | 32) <= 122)).sum())
    ends = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    odd = int(np.isin(ends, np.frombuffer(SYMBOLS, np.uint8)).sum()) if symbols else 0
    exclaimed = sum(1 for w in words if w.endswith(b"!")) if b"!" in raw else 0
    return (n, chars, symbols, len(lines) - len(set(lines)), repeated(first), len(seen), upper, upper + lower, wordlike, odd, exclaimed, len(lines))


def repeated(ids: np.ndarray) -> int:
    """Words that lie in a window of three words which occurs twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    _, pair = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
    window = pair[:-1] * n + ids[2:]
    order = np.argsort(window, kind="stable")
    equal = window[order][1:] == window[order][:-1]
    if not equal.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return int(covered.sum())


def measured(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns in keep and MEASURES (long) of every row. Whole texts are read; a null one has no words.

    Without a column text, texts are those in the struct column row, which keep must name; so they go to Python once.
    """
    inside = None if "text" in docs.columns else (f"k{keep.index('row')}", docs.schema["row"].dataType.names.index("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            text = batch.column(inside[0]).flatten()[inside[1]] if inside else batch.column("text")
            rows = np.array([measure(raw or b"") for raw in binary(text)], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([*(batch.column(f"k{i}") for i in range(len(keep))), *(pa.array(c) for c in rows.T)], names)

    names = [*(f"k{i}" for i in range(len(keep))), *MEASURES]
    kinds = [f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)] + [f"{m} bigint" for m in MEASURES]
    made = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), *([] if inside else [F.col("text").alias("text")])).mapInArrow(run, ", ".join(kinds))
    return made.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), *MEASURES)


def votes() -> Column:
    """The rules that vote, as the bits of one number; none do on a text without words."""
    pattern = sum((F.when(fires, 1 << i).otherwise(0) for i, (_, _, fires) in enumerate(rules())), F.lit(0))
    return F.when(F.col("n_words") > 0, pattern).otherwise(0).cast("int")


@dataclass
class LabelModel:
    """share: how many documents are good. accuracy: per rule, how often it is right where it votes; silence tells nothing."""

    share: float
    accuracy: np.ndarray
    polarity: np.ndarray

    @classmethod
    def fit(cls, fired: np.ndarray, weight: np.ndarray, polarity: np.ndarray, share: float = 0.85, accuracy: float = 0.9, trust: float = 0.5, rounds: int = 500) -> LabelModel:
        """EM over vote patterns (fired: pattern by rule) that occur weight times.

        Each accuracy is drawn to the starting one by trust times the rule's own votes: a rule that no other confirms
        or contradicts says nothing about itself, and plain EM would let it drift.
        """
        model, total = cls(share, np.full(fired.shape[1], accuracy), polarity), weight.sum()
        cast = (weight[:, None] * fired).sum(axis=0)
        for _ in range(rounds):
            good = model.posterior(fired)
            right = (weight[:, None] * fired * np.where(polarity == GOOD, good[:, None], 1 - good[:, None])).sum(axis=0)
            learned = (right + (trust * cast + 1) * accuracy) / (cast + trust * cast + 1)
            before = model
            model = cls(float(np.clip((weight * good).sum() / max(total, 1), 0.5, 0.98)), np.clip(learned, 0.5, 0.995), polarity)
            if np.abs(model.accuracy - before.accuracy).max() < 1e-9 and abs(model.share - before.share) < 1e-9:
                break
        return model

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        weigh = np.log(self.accuracy / (1 - self.accuracy)) * np.where(self.polarity == GOOD, 1, -1)
        return 1 / (1 + np.exp(-(np.log(self.share / (1 - self.share)) + fired @ weigh)))


def label_model(features: DataFrame) -> tuple[LabelModel, dict[int, float]]:
    """The model of a table of MEASURES, and the posterior of every pattern that occurs in it."""
    counts = {r["pattern"]: r["count"] for r in features.select(votes().alias("pattern")).groupBy("pattern").count().collect()}
    made = rules()
    fired = np.array([[p >> i & 1 for i in range(len(made))] for p in counts], float).reshape(-1, len(made))
    model = LabelModel.fit(fired, np.array(list(counts.values()), float), np.array([vote for _, vote, _ in made]))
    return model, dict(zip(counts, map(float, model.posterior(fired))))


def verdict(features: DataFrame, posterior: dict[int, float], least: float = 0.5) -> DataFrame:
    """features with base_failed, quality (the posterior) and kept."""
    spark = features.sparkSession
    table = spark.createDataFrame(list(posterior.items()) or [(-1, 0.0)], "pattern int, quality double")  # 2 ** rules rows at most
    made = features.withColumn("pattern", votes()).join(F.broadcast(table), "pattern", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    quality = F.coalesce("quality", F.lit(0.0))
    return made.withColumn("base_failed", failed).withColumn("quality", quality).withColumn("kept", ~failed & (quality >= least))


def quality_rules(docs: DataFrame, scratch) -> DataFrame:
    """doc_id, MEASURES, base_failed, quality, kept of every row of docs (doc_id, text); texts are read once."""
    features = scratch.keep(measured(docs), "features")
    _, posterior = label_model(features)
    return verdict(features, posterior)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns.

    Texts are read twice, once for the model and once for the filter, so that no text is shuffled or written.
    """
    _, posterior = label_model(measured(docs, ()))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return verdict(measured(rows, ("row",)), posterior).filter("kept").select("row.*")
