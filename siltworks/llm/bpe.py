"""Byte-pair encoding and decoding with a public vocabulary file, inside Arrow tasks.

A word is a contiguous array of parts and one of the ranks of adjacent pairs. The smallest rank is looked for, its
boundary deleted, and the ranks beside it refreshed, until no pair can merge. That is quadratic in the word's length,
so words of more than ``SHORT`` bytes keep their ranks in a heap; both give the same parts. White space always ends a
word, so the runs between white space are encoded on their own and remembered for the length of a task, up to
``REMEMBERED`` of them; then the memory starts anew.

The vocabulary, some 2 MB of a fixed file, is read by the driver and broadcast. Rows are independent: no shuffle.

Defined results: null is encoded like the empty text, to no ids; texts are never cut; repeated rows are
encoded each; other columns pass unchanged, except that ``ids`` and ``decoded`` replace columns of the same name.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.words import added_schema, by_value

SHORT = 64
REMEMBERED = 200_000
#: Rows of a batch that is sent back, so that neither side holds many long texts at once.
ROWS_BACK = 512
#: White space as the vocabulary's normaliser has it, and the end mark of a word.
WHITE = "\\t\\n\\v\\f\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD_END = "</w>"
NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it is printable, else the next one from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Ids of the two forms of each byte, merges by pair of ids, and the texts of ids."""

    def __init__(self, text: str):
        spec = json.loads(text)
        ids = spec["model"]["vocab"]
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + WORD_END] for c in letters]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(spec["model"]["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in (ids | self.special).items():
            self.tokens[i] = token
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace("\\s", WHITE))
        self.runs = regex.compile(f"[^{WHITE}]+")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def parts(self, word: bytes) -> list[int]:
        found = [*(self.inner[b] for b in word[:-1]), self.last[word[-1]]]
        return self._short(found) if len(found) <= SHORT else self._long(found)

    def _short(self, parts: list[int]) -> list[int]:
        merge = self.merges.get
        none = (NEVER, 0)
        pairs = [merge(p, none) for p in zip(parts, parts[1:], strict=False)]
        while pairs:
            best = min(pairs)
            if best is none or best[0] == NEVER:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = merge((parts[i - 1], parts[i]), none)
            if i < len(pairs):
                pairs[i] = merge((parts[i], parts[i + 1]), none)
        return parts

    def _long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(*m, i) for i in range(n - 1) if (m := self.merges.get((parts[i], parts[i + 1])))]
        heap = [(rank, i, token) for rank, token, i in heap]
        heapq.heapify(heap)
        while heap:
            rank, i, token = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j < 0 or self.merges.get((parts[i], parts[j])) != (rank, token):
                continue
            parts[i], parts[j] = token, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (m := self.merges.get((parts[a], parts[b]))):
                    heapq.heappush(heap, (m[0], a, m[1]))
        return [p for p in parts if p >= 0]

    def run(self, text: str) -> bytes:
        """Ids of a text without white space, as little-endian 32-bit integers."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        found: list[int] = []
        for piece in self.pieces.findall(text.lower()):
            found += self.parts(piece.encode())
        return np.array(found, "<u4").tobytes()


class Memory(dict):
    """Ids of the runs that a task has met."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.run = vocabulary.run

    def __missing__(self, text: str) -> bytes:
        found = self.run(text)
        if len(text) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[text] = found
        return found


_CONTROL = regex.compile("[\x1c-\x1f]")


def encode_text(vocabulary: Vocabulary, memory: Memory, text: str) -> bytes:
    pieces = [text]
    if vocabulary.specials is not None and "<|" in text:
        pieces = vocabulary.specials.split(text)
    found = []
    for piece in pieces:
        if len(pieces) > 1 and piece in vocabulary.special:
            found.append(np.array([vocabulary.special[piece]], "<u4").tobytes())
        else:  # str.split() also splits at four controls that are no white space to the vocabulary
            runs = vocabulary.runs.findall(piece) if _CONTROL.search(piece) else piece.split()
            found += map(memory.__getitem__, runs)
    return b"".join(found)


def _added(df: DataFrame, column: str, kind: str, keep: Sequence[str], read: str, start: Callable) -> DataFrame:
    """``keep`` of the columns and a new one, made from the values of ``read`` by the function that ``start()`` returns."""
    rows = df.select(F.col(read).alias("_read"), *(F.col(f"`{c}`") for c in keep if c != column))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_BACK):
                part = batch.slice(at, ROWS_BACK)
                made = pa.array([make(x.as_py()) for x in part.column(0)], pa.binary() if kind == "binary" else pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], made], [*part.schema.names[1:], column])

    return rows.mapInArrow(task, added_schema(rows.schema[1:], f"`{column}` {kind}"))


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(df: DataFrame, vocabulary_path: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Adds ``ids``: the token ids as binary, little-endian unsigned 32-bit integers; see ``ids_array``.

    ``keep`` names the columns to pass on; all, if it is not given. The driver reads ``vocabulary_path``.
    """
    spec = df.sparkSession.sparkContext.broadcast(_read(vocabulary_path))

    def start() -> Callable[[str | None], bytes]:
        vocabulary = Vocabulary(spec.value)
        memory = Memory(vocabulary)
        return lambda x: encode_text(vocabulary, memory, x or "")

    return _added(df, "ids", "binary", df.columns if keep is None else keep, text, start)


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", keep: Sequence[str] | None = None) -> DataFrame:
    """Adds ``decoded``: the texts of the ids, joined as the vocabulary's library joins them, by a space."""
    spec = df.sparkSession.sparkContext.broadcast(_read(vocabulary_path))

    def start() -> Callable[[bytes | None], str]:
        token = Vocabulary(spec.value).tokens.__getitem__
        return lambda x: " ".join(map(token, np.frombuffer(x or b"", "<u4").tolist()))

    return _added(df, "decoded", "string", df.columns if keep is None else keep, ids, start)


def ids_array(ids: str = "ids") -> Column:
    """The ids as an array of integers, in column expressions."""
    text = F.hex(F.col(ids))
    at = F.sequence(F.lit(0), F.floor(F.length(text) / 8).cast("int") - 1)

    def one(i: Column) -> Column:
        part = [F.substring(text, i * 8 + 1 + 2 * k, F.lit(2)) for k in (3, 2, 1, 0)]
        return F.conv(F.concat(*part), 16, 10).cast("long")

    return F.when(F.length(text) > 0, F.transform(at, one)).otherwise(F.array().cast("array<bigint>"))


by_value(sys.modules[__name__])
