"""Periodic runs of words: maximal stretches that repeat with a period, found through a difference-cover index.

The longest common extension (LCE) of two places of a text is answered from a sorted sample of its suffixes, those that
begin at a position whose remainder lies in a difference cover: for any two places there is a shift below ``V`` that brings both
onto sampled positions. So a query compares at most ``V - 1`` words, until both places are synchronised, and then reads the
smallest common prefix between two sampled suffixes from a sparse table. Sampled suffixes are sorted by their first ``V`` words
and then by doubling, which stays within the sample.

Runs are enumerated on harmonic grids: for each period q the multiples of q are compared with their successors, about
``n ln n`` pairs for n words. A run of three periods holds two neighbouring grid steps, so both must agree before more words are
compared, and texts without repetition build no index. Extensions to the right and, on the reversed words, to the left give the maximal
stretch; a stretch found with several periods has the smallest.

A run has at least ``cycles`` (three or more) periods and ``least`` words.

Defined results: null and blank texts have no words and no runs, and collapse to the empty text; repeated rows have the same runs
each; rows without a key are read like others; an empty table gives an empty result; other columns pass through if ``keep`` names
them. A text is held whole by one task, with up to ``V`` numbers per sampled suffix if it has repetitions, and its grid is compared in
blocks of ``PAIRS``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.words import added_schema, by_value

#: A perfect difference cover, in which each remainder of 31 but 0 is the difference of one pair.
V = 31
COVER = (0, 1, 3, 8, 12, 18)

LEAST, CYCLES = 24, 3
#: Grid pairs compared at once; texts of up to so many words share one table of pairs.
PAIRS, TABLE = 1 << 20, 1 << 15
#: Words and bytes of words that a task remembers.
REMEMBERED, REMEMBERED_BYTES = 300_000, 16 << 20
#: Bytes of output that are handed back at once.
BATCH = 8 << 20

_IN_COVER = np.isin(np.arange(2 * V) % V, COVER)
#: For remainders of the first place and of the distance, the smallest shift that brings both into the cover.
_SHIFT = np.array([[next(s for s in range(V) if _IN_COVER[(i + s) % V] and _IN_COVER[(i + d + s) % V]) for d in range(V)] for i in range(V)])


class Extensions:
    """Longest common extensions to the right of places of a text, given as an array of numbers from 0."""

    def __init__(self, words: np.ndarray):
        self.n = n = len(words)
        self.words = np.zeros(n + V, np.uint32)  # 0 is the end
        self.words[:n] = words + 1
        at = np.flatnonzero(_IN_COVER[np.arange(n) % V])
        first = np.lib.stride_tricks.sliding_window_view(self.words.astype(">u4"), V)[at]
        first = np.ascontiguousarray(first).view(f"V{4 * V}").ravel()  # big-endian, so that bytes sort like numbers
        levels, length = [self._spread(at, np.unique(first, return_inverse=True)[1])], V
        while length < n and levels[-1].max() + 1 < len(at):
            rank = levels[-1]
            later = np.where(at + length < n, rank[np.minimum(at + length, n - 1)] + 1, 0)
            levels.append(self._spread(at, np.unique(rank[at] * (len(at) + 1) + later, return_inverse=True)[1]))
            length *= 2
        self.rank = levels[-1]
        order = at[np.argsort(self.rank[at])]
        self.least = [self._common(order[:-1], order[1:], levels)]
        while 2 << len(self.least) - 1 <= len(order) - 1:
            row, half = self.least[-1], 1 << len(self.least) - 1
            self.least.append(np.minimum(row[:-half], row[half:]))

    def _spread(self, at: np.ndarray, rank: np.ndarray) -> np.ndarray:
        out = np.full(self.n, -1, np.int64)
        out[at] = rank
        return out

    def _common(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of sampled suffixes, by the levels that ranked them."""
        found, last = np.zeros(len(a), np.int64), self.n - 1
        for k in range(len(levels) - 1, -1, -1):
            x, y = a + found, b + found
            inside = np.maximum(x, y) <= last
            same = inside & (levels[k][np.minimum(x, last)] == levels[k][np.minimum(y, last)])
            found += np.where(same, V << k, 0)
        return found + self._few(a + found, b + found, np.full(len(a), V))[0]

    def _few(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many of the first ``most`` words agree, and where all do."""
        found = np.zeros(len(i), np.int64)
        left = np.flatnonzero(most > 0)
        last = len(self.words) - 1
        while len(left):
            x, y = i[left] + found[left], j[left] + found[left]
            same = (np.maximum(x, y) < self.n) & (self.words[np.minimum(x, last)] == self.words[np.minimum(y, last)])
            left = left[same]
            found[left] += 1
            left = left[found[left] < most[left]]
        return found, found == most

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places ``i < j <= n`` the number of words from there on that agree."""
        found, whole = self._few(i, j, _SHIFT[i % V, (j - i) % V])
        on = np.flatnonzero(whole & (j + found < self.n))
        if len(on):
            x, y = self.rank[i[on] + found[on]], self.rank[j[on] + found[on]]
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in np.unique(level).tolist():
                own = level == k
                row = self.least[k]
                found[on[own]] += np.minimum(row[low[own]], row[high[own] - (1 << k)])
        return found


class Grid:
    """Pairs of a period q and a multiple i of it, with ``i + 2 q`` inside of the text."""

    def __init__(self):
        self.size = 0

    @staticmethod
    def _pairs(n: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        q = np.arange(low, high, dtype=np.int32)
        each = np.maximum((n - 1) // q - 1, 0)
        period = np.repeat(q, each)
        step = np.arange(len(period), dtype=np.int64) - np.repeat(np.cumsum(each) - each, each)
        return period, (step * period).astype(np.int32)

    def blocks(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if n <= TABLE:
            if n > self.size:
                # Sorted by the last place that a pair reads, so that a shorter text takes the first ones.
                self.size = 1 << max(n - 1, 1).bit_length()
                period, place = self._pairs(self.size, 1, self.size)
                order = np.argsort(place + 2 * period, kind="stable")
                self.period, self.place = period[order], place[order]
                self.upto = np.searchsorted(self.place + 2 * self.period, np.arange(self.size + 1))
            yield self.period[: self.upto[n]], self.place[: self.upto[n]]
            return
        low = 1
        while low <= (n - 1) // 2:
            high = low + max(1, PAIRS * low // n)
            yield self._pairs(n, low, high)
            low = high


def find_runs(words: np.ndarray, grid: Grid, least: int = LEAST, cycles: int = CYCLES) -> list[tuple[int, int, int]]:
    """``start, length, period`` of the runs, by start and period."""
    n = len(words)
    if n < least:
        return []
    kept = []
    for q, i in grid.blocks(n):
        on = np.flatnonzero(words[i] == words[i + q])
        q, i = q[on].astype(np.int64), i[on].astype(np.int64)
        # From the first multiple of q in a run on, more than all but two periods agree.
        needed = np.maximum(least, cycles * q) - 2 * q + 1
        for t in range(min(int(needed.min()), V) if len(q) else 0):
            # Past the end no run is left; a place on the second grid step is asked for first.
            for ahead in (q, 0) if t == 0 else (0,):
                x = i + t + ahead
                on = np.flatnonzero((x + q < n) & (words[np.minimum(x, n - 1)] == words[np.minimum(x + q, n - 1)]))
                q, i = q[on], i[on]
            if not len(q):
                break
        if len(q):
            kept.append((q, i))
    if not kept:
        return []
    q, i = (np.concatenate(x) for x in zip(*kept, strict=True))
    right = Extensions(words).of(i, i + q)
    on = np.flatnonzero(right > np.maximum(least, cycles * q) - 2 * q)
    if not len(on):
        return []
    q, i, right = q[on], i[on], right[on]
    left = Extensions(words[::-1]).of(n - i - q, n - i)
    # A stretch that reaches a whole period back is met at the multiple before.
    on = np.flatnonzero((left < q) & (q + left + right >= np.maximum(least, cycles * q)))
    start, length, q = (i - left)[on], (q + left + right)[on], q[on]
    found: dict[tuple[int, int], int] = {}
    for k in np.argsort(q, kind="stable").tolist():
        found.setdefault((int(start[k]), int(length[k])), int(q[k]))
    return sorted((s, m, p) for (s, m), p in found.items())


class Numbers(dict):
    """A number for each word that a task has met; forgotten between texts if there are too many."""

    size = 0

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        self.size += len(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED or self.size > REMEMBERED_BYTES:
            self.clear()
            self.size = 0
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def collapsed(words: list[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words but those that a run repeats after its first period."""
    if runs:
        stays = np.ones(len(words), bool)
        for start, length, period in runs:
            stays[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(stays).tolist()]
    return b" ".join(words)


def detect(
    df: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    least: int = LEAST,
    cycles: int = CYCLES,
) -> DataFrame:
    """``keep`` of the columns, then ``n_words``, ``runs`` (by start, then period) and the ``collapsed`` text."""
    if cycles < 3 or least < 3:
        raise ValueError("runs have three periods and three words at least")
    read = df.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"), *(F.col(f"`{c}`") for c in keep))
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    added = {"n_words": pa.int64(), "runs": pa.list_(run), "collapsed": pa.binary()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, grid = Numbers(), Grid()
        for batch in batches:
            names = [*batch.schema.names[1:], *added]
            made, size, begin = [], 0, 0
            for i in range(batch.num_rows):
                words = batch.column(0)[i].as_py().split()
                runs = find_runs(numbers.of(words), grid, least, cycles)
                named = [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]
                made.append((len(words), named, collapsed(words, runs)))
                size += len(made[-1][-1])
                if size > BATCH or i + 1 == batch.num_rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), added.values(), strict=True)]
                    yield pa.RecordBatch.from_arrays([*batch.slice(begin, len(made)).columns[1:], *columns], names)
                    made, size, begin = [], 0, i + 1

    schema = added_schema(read.schema[1:], "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")
    return read.mapInArrow(task, schema).withColumn("collapsed", F.col("collapsed").cast("string"))


by_value(sys.modules[__name__])
