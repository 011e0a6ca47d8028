"""Fill-in-the-middle: texts cut at two token positions found by content-defined chunk memoization.

A rolling hash over the last ``WINDOW`` bytes cuts a text into chunks where its highest bits are zero, so a passage that many
texts share falls into the same chunks wherever it stands. What a cut needs to know of a chunk is a boundary summary: its
tokens, its code points, and whether it begins and ends within a word. Summaries are remembered by a hash of the chunk and used
again only if the remembered content is the same, byte for byte. Two neighbouring chunks that end and begin with a letter have one
token in common, so the running sums of the summaries give the number of tokens of the text and the chunk in which a token
begins; only the two chunks that hold a cut are read again. A task remembers at most ``REMEMBERED`` bytes of chunks.

Tokens are ``[A-Za-z]+|[^A-Za-z]``, matched from left to right over code points.

Forms: ``plain`` is the text itself; ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, and ``spm`` ``<S>`` suffix ``<P>``
prefix ``<M>`` middle. A text that is empty or holds a mark stays plain, so the marks of an output are the only ones and
``restored`` rebuilds the text from output and form alone.

Defined results: a null text is empty; rows without a key have no draws and stay plain; rows that repeat a key have its draws,
and equal texts equal outputs; an empty table gives an empty result; other columns pass through if ``keep`` names them. A long text is
hashed in blocks, so a task holds its bytes and one block of hashes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.words import added_schema, by_value

#: The marks of a cut text.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)

#: Bytes that the rolling hash sees: 2 ** DOUBLINGS.
DOUBLINGS = 5
WINDOW = 1 << DOUBLINGS
#: A chunk ends where so many bits of the hash are zero, on average every 512 bytes, but is no shorter or longer than this.
CUT_BITS, LEAST_CHUNK, MOST_CHUNK = 9, 128, 4096
#: Bytes hashed at once, and bytes of chunks that a task remembers.
BLOCK, REMEMBERED = 1 << 20, 64 << 20
#: Bytes of output that are handed back at once.
BATCH = 8 << 20

_GEAR = np.random.default_rng(29).integers(0, 1 << 32, 256, dtype=np.uint32)
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
#: Bytes within a code point, and a table that turns letters into ``a`` and all else into ``-``.
_INNER = bytes(range(0x80, 0xC0))
_KINDS = bytes(ord("a") if b in _LETTERS else ord("-") for b in range(256))
_IS_LETTER = np.isin(np.arange(256), np.frombuffer(_LETTERS, np.uint8))
_IS_INNER = (np.arange(256) & 0xC0) == 0x80


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte the hash of the last ``WINDOW`` bytes, by doubling the length that it covers."""
    h = _GEAR[data]
    for k in range(DOUBLINGS):
        step = 1 << k
        longer = h.copy()
        longer[step:] += h[:-step] << np.uint32(step)
        h = longer
    return h


def chunk_ends(text: bytes) -> list[int]:
    """Where the chunks end, the last at the end of the text. They depend on content, not on place."""
    found = []
    highest = np.uint32(((1 << CUT_BITS) - 1) << (32 - CUT_BITS))
    for at in range(0, len(text), BLOCK):
        begin = max(at - WINDOW + 1, 0)
        h = rolling(np.frombuffer(text, np.uint8, min(at + BLOCK, len(text)) - begin, begin))[at - begin :]
        found.append(np.flatnonzero(h & highest == 0) + at + 1)
    ends, last = [], 0
    for end in np.concatenate(found).tolist() if found else []:
        while end - last > MOST_CHUNK:
            last += MOST_CHUNK
            ends.append(last)
        if end - last >= LEAST_CHUNK:
            ends.append(end)
            last = end
    while len(text) - last > MOST_CHUNK:
        last += MOST_CHUNK
        ends.append(last)
    if last < len(text):
        ends.append(len(text))
    return ends


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """Tokens of a chunk by itself, its code points, and whether its first and last are letters."""
    kinds = chunk.translate(_KINDS, _INNER)
    first, last = kinds.startswith(b"a"), kinds.endswith(b"a")
    return kinds.count(b"-") + kinds.count(b"-a") + first, len(kinds), first, last


class Summaries:
    """Boundary summaries of the chunks that a task has met, each verified by its content."""

    def __init__(self, most: int = REMEMBERED):
        self.known: dict[int, tuple[bytes, tuple[int, int, bool, bool]]] = {}
        self.held, self.most, self.hits = 0, most, 0

    def of(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        name = xxhash.xxh3_64_intdigest(chunk)
        found = self.known.get(name)
        if found is not None and found[0] == chunk:
            self.hits += 1
            return found[1]
        made = summary(chunk)
        if found is None:
            if self.held + len(chunk) > self.most:
                self.known.clear()
                self.held = 0
            self.known[name] = (chunk, made)
            self.held += len(chunk)
        return made


class Counted:
    """A text with the running sums over its chunks."""

    def __init__(self, text: bytes, summaries: Summaries):
        self.text = text
        ends = chunk_ends(text)
        tokens, points, at, within = [0], [0], 0, False
        for end in ends:
            n, p, first, last = summaries.of(text[at:end])
            tokens.append(tokens[-1] + n - (within and first))
            points.append(points[-1] + p)
            at, within = end, last
        self.starts = [0, *ends]
        self.tokens, self.points = np.array(tokens), points

    @property
    def n(self) -> int:
        return int(self.tokens[-1])

    def cut(self, units: int) -> tuple[int, int]:
        """Byte and code point at which the token of this number begins; the end of the text if there is none."""
        if units >= self.n:
            return len(self.text), self.points[-1]
        k = int(np.searchsorted(self.tokens, units, "right")) - 1
        begin, end = self.starts[k], self.starts[k + 1]
        data = np.frombuffer(self.text, np.uint8, end - begin, begin)
        letter = _IS_LETTER[data]
        before = np.empty_like(letter)
        before[1:] = letter[:-1]
        before[0] = begin > 0 and bool(_IS_LETTER[self.text[begin - 1]])
        own = ~_IS_INNER[data]
        offset = int(np.flatnonzero(own & ~(letter & before))[units - int(self.tokens[k])])
        return begin + offset, self.points[k] + int(np.count_nonzero(own[:offset]))


def draws(key: str, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit draws of a row: the first groups of the SHA-256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    seed: int = 1,
    plain: int = 10,
    spm: int = 20,
) -> DataFrame:
    """``keep`` of the columns, then ``n`` (tokens), ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``.

    ``plain`` and ``spm`` are percentages: of the texts that stay plain, and of the others that begin with the suffix.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | F.contains(whole, F.lit(mark))
    h = draws(key, seed)
    stays = (whole == "") | marked | F.col(key).isNull() | (h[2] % 100 >= 100 - plain)
    form = F.when(stays, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    # The draws are made once per row and not again for each use.
    read = df.select(whole.cast("binary").alias("_text"), form.alias("_form"), h[0].alias("_h1"), h[1].alias("_h2"), *(F.col(f"`{c}`") for c in keep))
    added = ["n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    p, s, m = (x.encode() for x in MARKS)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries = Summaries()
        for batch in batches:
            names = [*batch.schema.names[4:], *added]
            made, size, begin = [], 0, 0
            forms, h1, h2 = (batch.column(i).to_pylist() for i in (1, 2, 3))
            for i, form in enumerate(forms):
                body = batch.column(0)[i].as_py()
                counted = Counted(body, summaries)
                n = counted.n
                if form == "plain":
                    made.append((n, form, None, None, body))
                else:
                    low, high = sorted((h1[i] % (n + 1), h2[i] % (n + 1)))
                    (a, x), (b, y) = counted.cut(low), counted.cut(high)
                    pre, mid, suf = body[:a], body[a:b], body[b:]
                    out = p + pre + s + suf + m + mid if form == "psm" else s + suf + p + pre + m + mid
                    made.append((n, form, x, y - x, out))
                size += len(made[-1][-1])
                if size > BATCH or i + 1 == len(forms):
                    columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*batch.slice(begin, len(made)).columns[4:], *columns], names)
                    made, size, begin = [], 0, i + 1

    schema = added_schema(read.schema[4:], "n long, form string, prefix_chars long, middle_chars long, output binary")
    out = read.mapInArrow(task, schema)
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of, as a column expression."""
    out, three = F.col(output), F.lit(len(PREFIX))

    def after(mark: str) -> Column:
        return F.substring(out, F.instr(out, mark) + three, F.length(out))

    def between(mark: str, end: str) -> Column:
        begin = F.instr(out, mark) + three
        return F.substring(out, begin, F.instr(out, end) - begin)

    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(out)


by_value(sys.modules[__name__])
