"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse as a byte-to-text state machine.

A text passes through two machines that each hold a bounded buffer: the splitter into pieces (words, numbers, marks,
white space) and the merger of a piece's bytes into tokens. The merge list bounds how far to the left a byte can still
change tokens: a merge that a later byte wins by an earlier rank frees what lies left of it, which can undo a neighbour
only by a merge of a later rank, and so on; the longest such chain is the sufficient lookahead. Tokens that end further
back than that are stable and are emitted. The end of a piece is a forced boundary, where the merger empties its buffer.

Every piece of every text goes through the merger. What it said of short runs of characters is remembered, so a word that
comes again is looked up; a piece that has not ended at the end of a chunk stays open in the merger until it does.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticeloom.llm.common import binary, in_parts

#: Characters that the splitter is fed at a time.
CHUNK = 1 << 17
#: Pieces whose tokens a worker remembers; a full memory becomes the older one, whose pieces come over when they are met again.
REMEMBERED = 400_000


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others from 256 up."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def category_class(letter: str) -> str:
    """The characters of a Unicode category as ranges of a regular expression's class."""
    out, start, last = [], None, -2
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] == letter:
            if c != last + 1:
                if start is not None:
                    out.append((start, last))
                start = c
            last = c
    out.append((start, last))
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


#: White space as Unicode defines it; Python's own class also has the separators 1C to 1F.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: What the machines take for granted of a tokenizer's file, by section; a file that says otherwise is refused.
ASSUMED = {
    "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True},
    "model": {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False},
    "decoder": {"type": "ByteLevel"},
}


def _checked(made: dict) -> dict:
    """The file's content, if it is a byte-level BPE that these machines read as the library does."""
    for section, wanted in ASSUMED.items():
        told = made.get(section) or {}
        for name, value in wanted.items():
            if (told.get(name, value) or None) != (value or None):
                raise ValueError(f"unsupported tokenizer: {section}.{name} is {told[name]!r}, not {value!r}")
    if made.get("normalizer") is not None:
        raise ValueError("unsupported tokenizer: it has a normalizer")
    for token in made.get("added_tokens", []):
        if token.get("single_word") or token.get("lstrip") or token.get("rstrip"):
            raise ValueError(f"unsupported added token: {token['content']!r}")
    return made


class Vocabulary:
    """The merge list and the tables that follow from it."""

    def __init__(self, content: str, letters: str, numbers: str):
        made = _checked(json.loads(content))
        model, chars = made["model"], byte_characters()
        raw = {t: bytes(chars[c] for c in t) for t in model["vocab"]}
        self.ids = {raw[t]: i for t, i in model["vocab"].items() if raw.get(t) is not None}
        self.special = {t["content"]: t["id"] for t in made.get("added_tokens", [])}
        for t, i in self.special.items():
            self.ids.pop(raw.get(t, b""), None)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = [(raw.get(a) or bytes(chars[c] for c in a), raw.get(b) or bytes(chars[c] for c in b)) for a, b in merges]
        self.ranks = {p: i for i, p in reversed(list(enumerate(self.pairs)))}
        self.of_id = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.longest = max(map(len, self.ids))
        self.lookahead = self.sufficient_lookahead()
        self.letters, self.numbers = letters, numbers
        self.splitter = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACE}{letters}{numbers}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def sufficient_lookahead(self) -> int:
        """Bytes after a token from which on no byte can change it.

        undone[k]: how far left of merge k's right part a change reaches if that merge does not happen. Its left part is
        then free; it can join a left neighbour a by a later merge j, which takes a from every still later merge that has
        a as its right part. Later merges come first, so one pass from the last merge to the first suffices.
        """
        undone_right: dict[bytes, int] = {}  # by right part a: the furthest reach of the merges seen that need a
        joins: dict[bytes, int] = {}  # by right part y: the furthest reach that a free y has by the merges seen
        furthest = 0
        for a, y in reversed(self.pairs):
            made = a + y
            reach = len(a) + joins.get(a, 0)
            furthest = max(furthest, len(y) + reach)
            through = max(undone_right.get(a, 0), len(a) + joins.get(made, 0))
            joins[y] = max(joins.get(y, 0), through)
            undone_right[y] = max(undone_right.get(y, 0), reach)
        return furthest + self.longest

    def merge(self, piece: bytes) -> list[bytes]:
        """The tokens of a run of bytes: the pair of least rank is joined first, of equal ones the leftmost."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        if len(parts) > 64:
            return self._merge_long(parts)
        rank, none = self.ranks.get, len(self.ranks)
        found = [rank(p, none) for p in zip(parts, parts[1:])]
        while found and (least := min(found)) < none:
            i = found.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i:
                found[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(found):
                found[i] = rank((parts[i], parts[i + 1]), none)
        return parts

    def _merge_long(self, parts: list[bytes]) -> list[bytes]:
        """The same with a heap over linked parts, for runs where a rescan per merge would be slow."""
        import heapq

        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        here: list[bytes | None] = list(parts)
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if here[i] != a or j >= n or here[j] != b:
                continue
            here[i], here[j] = a + b, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.ranks.get((here[x], here[y]))) is not None:
                    heapq.heappush(heap, (r, x, here[x], here[y]))
        return [p for p in here if p is not None]


class PieceTransducer:
    """Bytes of one piece in, tokens out as soon as they are stable. It holds the sufficient lookahead and one block."""

    BLOCK = 256

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.held, self.room = vocabulary, b"", self.BLOCK + vocabulary.lookahead

    def feed(self, more: bytes) -> Iterator[bytes]:
        for at in range(0, len(more), self.BLOCK):
            self.held += more[at : at + self.BLOCK]
            if len(self.held) >= self.room:
                stable, tokens, done = len(self.held) - self.v.lookahead, self.v.merge(self.held), 0
                for t in tokens:
                    if done + len(t) > stable:
                        break
                    done += len(t)
                    yield t
                self.held = self.held[done:]  # what follows a token boundary is merged as if it stood alone

    def finish(self) -> Iterator[bytes]:
        tokens, self.held = self.v.merge(self.held) if self.held else [], b""
        yield from tokens

    def whole(self, piece: bytes) -> list[bytes]:
        """The tokens of a piece whose end is known; one that fits the buffer is all merged when it ends."""
        if len(piece) < self.room:
            return self.v.merge(piece)
        return [*self.feed(piece), *self.finish()]


class Encoder:
    """A text in parts in, the ids as little-endian unsigned 32-bit numbers out."""

    #: Characters after a piece that can still change where it ends.
    MARGIN = 4

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.held, self.open = vocabulary, "", None
        code = vocabulary.ids
        machine, packed = PieceTransducer(vocabulary), {t: i.to_bytes(4, "little") for t, i in code.items()}

        find = vocabulary.splitter.findall

        class Memory(dict):
            """The packed ids of a run of characters; lead goes before it."""

            lead = ""

            def __init__(self):
                self.older: dict[str, bytes] = {}

            def __missing__(self, run: str) -> bytes:
                made = self.older.get(run)
                if made is None:
                    made = b"".join([packed[t] for piece in find(self.lead + run) for t in machine.whole(piece.encode())])
                if len(self) >= REMEMBERED:
                    self.older = dict(self)
                    self.clear()
                if len(run) < 64:
                    self[run] = made
                return made

        class Spaced(Memory):
            lead = " "

        self.packed, self.memory, self.spaced = packed, Memory(), Spaced()
        self.newline = self.memory["\n"]
        letters, numbers = vocabulary.letters, vocabulary.numbers
        self.spaces = re.compile(f"[{SPACE}]*")
        self.kinds = [re.compile(x) for x in (f"[{letters}]*", f"[{numbers}]*", f"[^{SPACE}{letters}{numbers}]*")]
        #: White space but single blanks and line ends between words.
        self.odd = re.compile(f"[{SPACE.replace(r'\t-\r ', r'\t\v-\r')}]|[ \n][ \n]|^[ \n]|[ \n]$")
        self.ends = re.compile(f"[^{SPACE}] ")
        self.guard = max(map(len, vocabulary.special), default=1) - 1

    def feed(self, more: str) -> bytes:
        """Ids that no further text can change."""
        self.held += more
        return self._take(last=False)

    def finish(self, more: str = "") -> bytes:
        """The ids that are left, of more text too, at the end of which the next text can begin."""
        self.held += more
        return self._take(last=True)

    def text(self, text: str) -> Iterator[bytes]:
        """The ids of a whole text, a chunk of it at a time."""
        at = 0
        while len(text) - at > CHUNK:
            yield self.feed(text[at : at + CHUNK])
            at += CHUNK
        yield self.finish(text[at:])

    def _take(self, last: bool) -> bytes:
        out, marks = [], self.v.marks
        text, at = self.held, 0
        if marks is not None:
            for m in marks.finditer(text):
                out += [self._pieces(text[at : m.start()], True), self.v.special[m[0]].to_bytes(4, "little")]
                at = m.end()
        end = len(text) if last else max(at, len(text) - self.guard)  # a special token may have begun there
        out.append(self._pieces(text[at:end], last))
        self.held += text[end:]
        return b"".join(out)

    def _pieces(self, text: str, last: bool) -> bytes:
        """The ids of text's pieces; what is not final stays in held."""
        find, get = self.v.splitter, self.memory.__getitem__
        self.held, out = "", []
        if self.open is not None:  # a piece longer than a buffer goes on
            kind, machine = self.open
            end = kind.match(text).end()
            if end == len(text):
                sure = end if last else max(0, end - self.MARGIN)
            else:  # of white space before a word, the last character goes with what follows
                sure = end - (kind is self.spaces)
            out += [self.packed[t] for t in machine.feed(text[:sure].encode())]
            if end == len(text) and not last:
                self.held = text[sure:]
                return b"".join(out)
            out += [self.packed[t] for t in machine.finish()]
            self.open, text = None, text[sure:]
        if last:
            out.append(self._whole(text))
            return b"".join(out)
        sure = self._boundary(text)
        out.append(self._whole(text[:sure]))
        text = text[sure:]
        pieces = [m.span() for m in find.finditer(text)]
        final = len(text) - self.MARGIN
        while pieces and pieces[-1][1] > final:
            pieces.pop()
        out += [get(text[a:b]) for a, b in pieces]
        rest = text[pieces[-1][1] :] if pieces else text
        if len(rest) > self.v.lookahead + self.MARGIN and (kind := self._endless(rest)) is not None:
            machine = PieceTransducer(self.v)
            sure = len(rest) - self.MARGIN
            out += [self.packed[t] for t in machine.feed(rest[:sure].encode())]
            self.open, rest = (kind, machine), rest[sure:]
        self.held = rest
        return b"".join(out)

    def _whole(self, text: str) -> bytes:
        """The ids of text that ends where a piece does."""
        if self.odd.search(text) is None:
            return self._plain(text)
        return b"".join(map(self.memory.__getitem__, self.v.splitter.findall(text)))

    def _boundary(self, text: str) -> int:
        """The last place of a blank after anything but white space, where a piece ends whatever follows; 0 without one."""
        found = 0
        for at in range(len(text), 0, -STEP):  # from the end, so that a long text is not read whole
            begin = max(0, at - STEP)
            for m in self.ends.finditer(text[begin : at + 1]):
                found = begin + m.end() - 1
            if found:
                break
        return found

    def _plain(self, text: str) -> bytes:
        """The same for words between single blanks and line ends: no piece crosses a blank, so each word's ids are looked up."""
        out, first, rest = [], self.memory.__getitem__, self.spaced.__getitem__
        for line in text.split("\n"):
            words = line.split(" ")
            out.append(first(words[0]))
            out += map(rest, words[1:])
            out.append(self.newline)
        return b"".join(out[:-1])

    def _endless(self, rest: str) -> re.Pattern | None:
        """The class of the one piece that rest consists of so far, if it does."""
        if self.spaces.fullmatch(rest):
            return self.spaces
        lead = rest[0] == " "
        return next((kind for kind in self.kinds if kind.fullmatch(rest, lead)), None)


class Decoder:
    """Ids in, text out: bytes go to an incremental UTF-8 machine that keeps at most one unfinished character."""

    def __init__(self, vocabulary: Vocabulary):
        self.table, self.machine = vocabulary.of_id, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        """What ids complete. Ids that the vocabulary does not have, and nulls, stand for nothing, as in the library."""
        return self.machine.decode(b"".join(map(self.table.get, ids, repeat(b""))))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


#: Ids that are decoded at a time.
STEP = 1 << 16


def encode_digest(encoder: Encoder, raw: bytes) -> tuple[int, str, str]:
    """Tokens, SHA-256 of the ids and SHA-256 of the text decoded from them."""
    ids, back, n = hashlib.sha256(), hashlib.sha256(), 0
    decoder, text = Decoder(encoder.v), raw.decode()

    def take(got: bytes) -> int:
        ids.update(got)
        for at in range(0, len(got), 4 * STEP):
            back.update(decoder.feed(memoryview(got[at : at + 4 * STEP]).cast("I")).encode())
        return len(got) // 4

    for got in encoder.text(text):
        n += take(got)
    back.update(decoder.finish().encode())
    return n, ids.hexdigest(), back.hexdigest()


def encode_ids(encoder: Encoder, raw: bytes) -> bytes:
    return b"".join(encoder.text(raw.decode()))


def vocabulary_parts(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return {"content": f.read(), "letters": category_class("L"), "numbers": category_class("N")}


def _vocabulary(docs: DataFrame, path: str):
    """The vocabulary file's content as a broadcast: its size is fixed and known, about a megabyte."""
    return docs.sparkSession.sparkContext.broadcast({"parts": vocabulary_parts(path)})


def _encoder(shared: dict) -> Encoder:
    """One per worker process: tasks that follow find its tables and remembered pieces."""
    if "encoder" not in shared:
        shared["encoder"] = Encoder(Vocabulary(**shared["parts"]))
    return shared["encoder"]


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of docs (doc_id, text); path: a byte-level BPE in JSON.

    A null text counts as empty: no tokens, and the digest of no bytes. Rows that repeat give repeated rows.
    """
    content = _vocabulary(docs, path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        for batch in batches:
            made = [encode_digest(encoder, raw or b"") for raw in binary(batch.column("text"))]
            n, ids, back = map(list, zip(*made)) if made else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(digest, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def bpe_tokens(docs: DataFrame, path: str) -> DataFrame:
    """Every row of docs with all its columns and tokens (array of int) added; a null text has no tokens.

    A column tokens that docs has already is replaced.
    """
    content = _vocabulary(docs, path)
    names = [c for c in docs.columns if c != "tokens"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))  # the text goes to Python and back once
    at = names.index("text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoder = _encoder(content.value)
        for batch in in_parts(batches):
            made = [encode_ids(encoder, raw or b"") for raw in binary(batch.column("row").flatten()[at])]
            ends = np.cumsum([0, *(len(x) // 4 for x in made)]).astype("int32")
            tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(made), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("row"), tokens], ["row", "tokens"])

    schema = T.StructType([rows.schema["row"], T.StructField("tokens", T.ArrayType(T.IntegerType()))])
    made = rows.mapInArrow(encode, schema)
    return made.select("row.*", F.col("tokens").alias("__tokens")).select(*(F.col(f"`{c}`") for c in names), F.col("__tokens").alias("tokens"))


def bpe_text(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of tokens (doc_id, tokens): the inverse of bpe_tokens.

    Null tokens are none. Ids that the vocabulary does not have, and nulls among the ids, stand for nothing.
    """
    content = _vocabulary(tokens, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _encoder(content.value).v
        for batch in batches:
            out = []
            for ids in batch.column("tokens").to_pylist():
                decoder = Decoder(vocabulary)
                out.append(decoder.feed(ids or []) + decoder.finish())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", F.col("tokens").cast("array<int>").alias("tokens")).mapInArrow(decode, f"doc_id {kind}, text string")
