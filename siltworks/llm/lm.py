"""Language-model scores from n-gram tries with Elias-Fano levels.

The model is a trigram model over all words met in training, an end mark, and one class for words never met. Probabilities
are interpolated with absolute discounting: trigrams on bigrams with continuation counts on add-one unigrams. All
trigrams that are counted have an entry; ``LEAST_TRIGRAM`` names the count from which they do.

The trie is dealt into shards by the word before the predicted one; a word with more than a shard's share of all tokens is
dealt further by the word before it. Each of its shards then has a part of its trigrams and the same whole bigram
level, from counts over all shards; discounts are those of all counts. So the size of shards changes no probability.
In a shard, roots are words; below them lie successors, and contexts (the word before the root)
with their children. Each level is a monotone sequence of parent and child in Elias-Fano form, low bits packed and high
bits in unary. A child is the rank of the word among the root's successors, which the successor level's pointers give.
Probabilities and back-off weights are 8-bit codes into codebooks. Tasks write a shard's bytes to a temporary file,
map it into memory, and remove it at once. A model is kept as what its tries are made of, which is smaller than they are: the
trigrams of shards, the counts of their rare words, and whole bigram levels. Scoring sends these with the questions and makes tries there.

Words are told apart by 64-bit hashes. The ``CLASSES`` most frequent ones, which are nearly all tokens, have a number by falling count,
which every task knows (20 MB broadcast at most), so the keys of trigrams are small numbers; pieces and shards number the others
by the order of their hashes and carry these, so nothing holds all words and no word lacks a number. Scores don't depend on ``CLASSES``. Training counts distinct trigrams per run before
the shuffle and joins the rare words of each shard with their counts; scoring sends the distinct trigrams of a run,
with the numbers of the texts that have them, as packed columns to the shards; a shard has about a million of them, as it has tokens,
however many texts there are. Where neither trigram nor bigram is known, and for base scores, which go along with a run's
questions, the unigram of a word is wanted: the counts of numbered words are at hand, those of the others come by one join, with the same result.

Defined results: null and empty texts consist of one end; texts are never cut; repeated rows get equal scores; with
nothing to learn from, no word is known; empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import json
import sys
import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.words import by_value
from siltworks.session import stored

#: Words that have a number in all tasks, and whose counts these have at hand. Scores do not depend on it.
CLASSES = (1 << 20) - 2
LEAST_TRIGRAM = 1
SHARD_TOKENS = 1_000_000
#: Tokens, and texts, of which trigrams are packed together. Keys hold three numbers below 2 ** 21, so a run has fewer words.
RUN_TOKENS, RUN_TEXTS = 1_500_000, 60_000
#: Bytes of texts whose words are told apart together.
SLICE_BYTES = 4 << 20
#: Values that are worked on together where a shard's arrays would need several times its memory.
CHUNK = 1 << 16
END_HASH = xxhash.xxh3_64_intdigest(b"\n")  # no word has a line break

Arrays = dict[str, np.ndarray]


def signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def pack(a: np.ndarray) -> bytes:
    """The bytes of an array, highest bytes together, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(b: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


# --- Elias-Fano sequences


def elias_fano(values: np.ndarray, name: str) -> Arrays:
    """A non-decreasing sequence as packed low bits and unary high bits."""
    values = values.astype(np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    low = max(0, (top // max(n, 1)).bit_length() - 1)
    packed = [np.zeros(0, np.uint8)]
    step = 1 << 15  # a multiple of 8, so chunks end at whole bytes
    for at in range(0, n if low else 0, step):
        bits = (values[at : at + step, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
        packed.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"))
    high = (values >> np.uint64(low)).astype(np.int64)
    unary = np.zeros(n + (int(high[-1]) if n else 0) + 2, bool)
    high += np.arange(n)
    unary[high] = 1
    return {
        f"{name}.low": np.concatenate([*packed, np.zeros(8, np.uint8)]),
        f"{name}.high": np.packbits(unary, bitorder="little"),
        f"{name}.shape": np.array([n, low, len(unary)], np.int64),
    }


class EliasFano:
    """Successor search and access on mapped arrays, for many values at once."""

    def __init__(self, arrays: Arrays, name: str):
        self.n, self.width, length = (int(x) for x in arrays[f"{name}.shape"])
        low = arrays[f"{name}.low"]
        self.low = np.ndarray(len(low) - 7, "<u8", low.data, 0, (1,))
        bits = np.unpackbits(arrays[f"{name}.high"], count=length, bitorder="little")
        zeros = np.flatnonzero(bits == 0)
        #: How many values have a smaller high part, by high part.
        self.before = np.concatenate([[0], zeros - np.arange(len(zeros))])
        self.ones = np.flatnonzero(bits).astype(np.int64)

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i * self.width
        return (self.low[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = (self.ones[i] - i).astype(np.uint64)
        return ((high << np.uint64(self.width)) | self._low(i)).astype(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of each value, or -1: the first not smaller one in the bucket of its high part is compared."""
        values = values.astype(np.uint64)
        if not self.n:
            return np.full(len(values), -1)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        inside = high < len(self.before) - 1
        high = np.where(inside, high, 0)
        low, end = self.before[high], self.before[high + 1]
        target = values & np.uint64((1 << self.width) - 1)
        top = end.copy()
        while (open_ := low < top).any():
            mid = (low + top) >> 1
            less = self._low(np.minimum(mid, self.n - 1)) < target
            low, top = np.where(open_ & less, mid + 1, low), np.where(open_ & ~less, mid, top)
        at = np.minimum(low, self.n - 1)
        return np.where(inside & (low < end) & (self._low(at) == target), at, -1)


# --- Shards


def codebook(values: np.ndarray, name: str) -> Arrays:
    """8-bit codes of the logarithms of values, into the means of 256 quantile bins."""
    logs = np.maximum(values, 1e-30)
    np.log10(logs, out=logs)
    edges = np.unique(np.quantile(logs, np.linspace(0, 1, 257)[1:-1])) if len(logs) else np.zeros(0)
    codes, counts, sums = np.zeros(len(logs), np.uint8), np.zeros(256, np.int64), np.zeros(256)
    for at in range(0, len(logs), CHUNK):
        part = logs[at : at + CHUNK]
        codes[at : at + CHUNK] = found = np.searchsorted(edges, part, side="left")
        counts += np.bincount(found, minlength=256)
        np.add.at(sums, found, part)
    return {f"{name}.code": codes, f"{name}.book": (sums / np.maximum(counts, 1)).astype(np.float32)}


def edges_of(*columns: np.ndarray) -> np.ndarray:
    """Whether a row of sorted columns differs from the one before it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with their counts. Sorts ``values`` in place."""
    values.sort()
    first = np.flatnonzero(edges_of(values))
    return values[first], np.diff(np.append(first, len(values)))


def discount(counts: np.ndarray) -> float:
    return discount_of((counts == 1).sum(), (counts == 2).sum())


def discount_of(once: float, twice: float) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5


def build_shard(keys: np.ndarray, n: np.ndarray, unigram: np.ndarray) -> bytes:
    """The trie of sorted trigram keys (root, word before it, predicted word; 16 bits each) with counts."""
    numbers = ((keys >> np.uint64(shift)) & np.uint64(0xFFFF) for shift in (32, 16, 0))
    return build_trie(*numbers, n, unigram)


def joined_pairs(root: np.ndarray, other: np.ndarray, base: np.uint64) -> np.ndarray:
    pairs = root.astype(np.uint64)
    pairs *= base
    pairs += other.astype(np.uint64)
    return pairs


def build_trie(
    root: np.ndarray, before: np.ndarray, word: np.ndarray, n: np.ndarray, unigram: np.ndarray,
    words: np.ndarray | None = None, discounts: tuple[float, float] | None = None, lower: Sequence[np.ndarray] | None = None,
) -> bytes:
    """The trie of trigrams, sorted by root, word before it and predicted word, which are positions in ``unigram``.

    ``words`` has the hashes of the words at these positions, ``discounts`` those of bigrams and trigrams, and ``lower`` the
    bigrams (root, word, number of contexts) of the roots whose contexts are not all here.
    """
    base = np.uint64(len(unigram) + 1)  # one number is left for words that the shard does not have
    bigram = joined_pairs(root, word, base)
    pairs, continued = counted(bigram.copy())
    if lower is not None:
        own = ~np.isin(pairs // base, np.unique(lower[0]))
        pairs = np.concatenate([pairs[own], joined_pairs(lower[0], lower[1], base)])
        order = np.argsort(pairs)
        pairs, continued = pairs[order], np.concatenate([continued[own], lower[2]])[order]
    at_root = pairs // base
    first = np.flatnonzero(edges_of(at_root))
    roots, kinds = at_root[first], np.diff(np.append(first, len(pairs)))
    total = np.add.reduceat(continued, first) if len(first) else np.zeros(0)
    at_root = np.repeat(np.arange(len(roots)), kinds)
    d2, d3 = discounts or (discount(continued), discount(n))
    back2 = d2 * kinds / np.maximum(total, 1)
    p2 = (continued - d2) / total[at_root] + back2[at_root] * unigram[(pairs % base).astype(np.int64)]
    begin = np.flatnonzero(edges_of(root, before))
    contexts = joined_pairs(root[begin], before[begin], base)
    own = np.repeat(np.arange(len(contexts), dtype=np.int32), np.diff(np.append(begin, len(root))))
    seen = np.add.reduceat(n, begin, dtype=np.int64) if len(begin) else np.zeros(0)
    share = np.where(n >= LEAST_TRIGRAM, (n - d3) / seen[own], 0.0) if len(n) else np.zeros(0)
    back3 = 1 - (np.add.reduceat(share, begin) if len(begin) else np.zeros(0))
    kept = share > 0
    if not kept.all():
        own, share, bigram = own[kept], share[kept], bigram[kept]
    parents = own[edges_of(own)]
    place = np.searchsorted(pairs, bigram)
    del bigram
    rank = (place - first[at_root[place]]).astype(np.uint64)
    width = int(kinds.max()) if len(kinds) else 1
    p3 = back3[own] * p2[place]
    p3 += share
    del place, share
    children = (np.cumsum(edges_of(own), dtype=np.uint64) - np.uint64(1)) * np.uint64(width)
    children += rank
    del rank, own
    root_of = np.searchsorted(roots, contexts[parents] // base).astype(np.uint64)
    arrays = (
        elias_fano(roots, "roots")
        | elias_fano(at_root.astype(np.uint64) * base + pairs % base, "successors")
        | elias_fano(np.append(first, len(pairs)), "pointers")
        | elias_fano(root_of * base + contexts[parents] % base, "contexts")
        | elias_fano(children, "children")
        | codebook(back2, "back2")
        | codebook(p2, "p2")
        | codebook(back3[parents], "back3")
        | codebook(p3, "p3")
        | {"width": np.array([width], np.int64), "base": np.array([base], np.uint64)}
        | {"words": np.zeros(0, np.uint64) if words is None else words}
    )
    head, body, at = {}, [], 0
    for name, a in arrays.items():
        raw = a.tobytes() + bytes(-a.nbytes % 8)
        head[name] = (a.dtype.str, at, len(a))
        body.append(raw)
        at += len(raw)
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return np.array([len(text)], "<i8").tobytes() + text + b"".join(body)


class Shard:
    """A trie on mapped memory."""

    def __init__(self, content: bytes):
        with tempfile.NamedTemporaryFile() as f:
            f.write(content)
            f.flush()
            mapped = np.memmap(f.name, np.uint8, "r")
        size = int(mapped[:8].view("<i8")[0])
        head = json.loads(mapped[8 : 8 + size].tobytes())
        body = mapped[8 + size :]
        self.a = {k: body[at : at + n * np.dtype(kind).itemsize].view(kind) for k, (kind, at, n) in head.items()}
        self.level = {k: EliasFano(self.a, k) for k in ("roots", "successors", "pointers", "contexts", "children")}
        self.width = int(self.a["width"][0])
        self.base = self.a["base"][0]
        self.words = self.a["words"]

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The shard's numbers of rare words by hash, after those of the classes; those that it does not have share the last number."""
        last = int(self.base) - 1
        if not len(self.words):
            return np.full(len(words), last)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, last - len(self.words) + at, last)

    def _value(self, name: str, at: np.ndarray, missing: np.ndarray | float) -> np.ndarray:
        """Logarithms at the positions, and ``missing`` where there is none."""
        if not len(self.a[f"{name}.code"]):
            return np.broadcast_to(missing, len(at))
        found = self.a[f"{name}.book"][self.a[f"{name}.code"][np.maximum(at, 0)]]
        return np.where(at >= 0, found, missing)

    def log_p(self, keys: np.ndarray, log_unigram: np.ndarray) -> np.ndarray:
        """log10 of the probability of each key's word, keys as those of ``build_shard``."""
        root, before, word = ((keys >> np.uint64(shift)) & np.uint64(0xFFFF) for shift in (32, 16, 0))
        found, missing = self.look_up(root, before, word)
        return found + np.where(missing, log_unigram[word.astype(np.int64)], 0.0)

    def look_up(self, root: np.ndarray, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the probability, but for a factor that is the unigram of the word where the second result says so."""
        # Keys come in order, so a root or context is looked up once for all that follow it.
        new = edges_of(root)
        anew = edges_of(root, before)
        root = self.level["roots"].find(root[new])[np.cumsum(new) - 1]
        base = np.maximum(root, 0).astype(np.uint64) * self.base
        successor = np.where(root >= 0, self.level["successors"].find(base + word), -1)
        context = np.where(root >= 0, self.level["contexts"].find((base + before)[anew])[np.cumsum(anew) - 1], -1)
        rank = successor - self.level["pointers"].get(np.maximum(root, 0)) if self.level["pointers"].n > 1 else successor
        ask = (successor >= 0) & (context >= 0)
        child = np.full(len(word), -1)
        child[ask] = self.level["children"].find(context[ask] * self.width + rank[ask])
        lower = self._value("p2", successor, self._value("back2", root, 0.0))
        return self._value("p3", child, self._value("back3", context, 0.0) + lower), successor < 0


# --- Tokens


@dataclass
class Classes:
    """The frequent words, with what is known of all words. At most ``CLASSES`` rows, and the words that are dealt further."""

    #: Sorted hashes, and the number of each: its place by falling count. ``counts`` is in the order of numbers.
    hashes: np.ndarray
    number: np.ndarray
    counts: np.ndarray
    n_tokens: int
    n_distinct: int
    shards: int

    def __post_init__(self):
        self.log_unigram = self.log_of(self.counts)
        #: The first numbers are words with more than a shard's share of all tokens.
        often = int((self.counts > SHARD_TOKENS).sum())
        self.slots = np.ceil(self.counts[:often] / SHARD_TOKENS).astype(np.uint64)
        self.hash_of = np.zeros(often, np.uint64)
        near = self.number < often
        self.hash_of[self.number[near]] = self.hashes[near]

    @property
    def size(self) -> int:
        return len(self.counts)

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The numbers of words by hash, or -1."""
        if not self.size:
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.hashes, words), self.size - 1)
        return np.where(self.hashes[at] == words, self.number[at].astype(np.int64), -1)

    def log_of(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the add-one unigram of words with these counts."""
        return np.log10((counts + 1) / (self.n_tokens + self.n_distinct + 1))

    def shard_of(self, number: np.ndarray, root: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The shards of trigrams, by the number of the root, its hash, and that of the word before it."""
        slot = np.zeros(len(root), np.uint64)
        hit = np.flatnonzero((number >= 0) & (number < len(self.slots)))
        slot[hit] = ((before[hit] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)) % self.slots[number[hit]]
        return self._mixed(root, slot)

    def shards_of_frequent(self) -> list[tuple[int, int]]:
        """The numbers of the frequent roots, with each shard that they are dealt to."""
        own = np.repeat(np.arange(len(self.slots)), self.slots.astype(np.int64))
        slots = [np.arange(int(k), dtype=np.uint64) for k in self.slots]
        shards = self._mixed(self.hash_of[own], np.concatenate([np.zeros(0, np.uint64), *slots]))
        return sorted(set(zip(own.tolist(), shards.tolist(), strict=True)))

    def _mixed(self, root: np.ndarray, slot: np.ndarray) -> np.ndarray:
        mixed = (root * np.uint64(0xBF58476D1CE4E5B9)) ^ (slot * np.uint64(0x94D049BB133111EB))
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(self.shards)


def sent(spark: SparkSession, classes: Classes) -> Broadcast:
    """What ``received`` makes classes of: arrays and numbers, which workers can read without this package."""
    c = classes
    return spark.sparkContext.broadcast((c.hashes, c.number, c.counts, c.n_tokens, c.n_distinct, c.shards))


def received(shared: Broadcast) -> Classes:
    return Classes(*shared.value)


def release() -> None:
    """Give back memory that Arrow and the C library, which has the arrays, keep unused, as workers live on after a task."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """The texts in parts of at most ``SLICE_BYTES``, or one text, with the place of the first."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield at, texts.slice(at, end - at)
        at = end


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words of texts, the place of each word in order among them, and the number of words of each text."""
    # The bytes are taken as they are; Arrow's functions for ASCII know no other letters or white space than the contract.
    whole = texts.view(pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(whole, ""))))
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not full.all():  # a blank text is one empty word
        flat = flat.filter(pa.array(full))
        lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[full], minlength=len(lengths))
    coded = flat.dictionary_encode()
    words = coded.dictionary.view(texts.type).to_numpy(zero_copy_only=False)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return hashes, coded.indices.to_numpy(), lengths


@dataclass
class Run:
    """Trigrams of texts. A key has the root, the word before it and the predicted word as positions in ``words``."""

    #: Hashes: those of numbered words by number, then the others in order.
    words: np.ndarray
    #: The numbers of the words, or -1, and how many have one.
    numbered: np.ndarray
    near: int
    keys: np.ndarray
    #: The text of each key, as a position in ``rids``.
    number: np.ndarray
    rids: np.ndarray


def parted(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = np.uint64(max(size, 1))
    word = (keys % base).astype(np.int32)
    context = keys // base
    before = (context % base).astype(np.int32)
    context //= base
    return context.astype(np.int32), before, word


def _run(classes: Classes, pieces: list[tuple[np.ndarray, list[np.ndarray]]], rows: list[int]) -> Run:
    pieces = [(hashes, np.concatenate(parts), [len(a) for a in parts]) for hashes, parts in pieces if parts]
    used = []
    for hashes, tokens, _ in pieces:
        met = np.zeros(len(hashes), bool)
        met[tokens] = True
        used.append(np.flatnonzero(met))
    words, place = np.unique(np.concatenate([h[u] for (h, _, _), u in zip(pieces, used, strict=True)]), return_inverse=True)
    numbered = classes.numbers(words)
    order = np.argsort(np.where(numbered >= 0, numbered, classes.size), kind="stable")
    words, numbered = words[order], numbered[order]
    rank = np.empty(len(order), np.uint64)
    rank[order] = np.arange(len(order), dtype=np.uint64)
    base, keys, lengths, at = np.uint64(len(words)), [], [], 0
    for (hashes, tokens, sizes), u in zip(pieces, used, strict=True):
        table = np.zeros(len(hashes), np.uint64)
        table[u] = rank[place[at : at + len(u)]]
        at += len(u)
        tokens = table[tokens]
        key = tokens[1:-1] * base
        key += tokens[:-2]
        key *= base
        key += tokens[2:]
        inside = np.ones(len(tokens), bool)
        ends = np.cumsum(sizes)
        inside[ends - 1] = inside[ends - 2] = False
        keys.append(key[inside[:-2]])
        lengths += sizes
    number = np.repeat(np.arange(len(rows), dtype=np.uint16), np.array(lengths) - 2)
    return Run(words, numbered, int((numbered >= 0).sum()), np.concatenate(keys), number, np.array(rows, np.int64))


def _runs(batches: Iterator[pa.RecordBatch], classes: Classes) -> Iterator[Run]:
    """Runs of texts. A long text is several parts, which may lie in several runs; a text begins after two ends."""
    pieces, rows, held = [], [], 0
    longest = max(1, RUN_TOKENS // 4)
    for batch in batches:
        rids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, texts in slices(batch.column(1)):
            hashes, place, lengths = distinct_words(texts)
            tokens = np.full(len(place) + 3 * len(lengths), len(hashes), np.int32)
            tokens[np.arange(len(place)) + 3 * np.repeat(np.arange(len(lengths)), lengths) + 2] = place
            hashes = np.append(hashes, np.uint64(END_HASH))
            pieces.append((hashes, parts := []))
            ends = np.cumsum(lengths + 3)
            for rid, begin, end in zip(rids[first : first + len(texts)].tolist(), (ends - lengths - 3).tolist(), ends.tolist(), strict=True):
                for at in range(begin, end - 2, longest):
                    part = tokens[at : min(at + longest + 2, end)]
                    parts.append(part)
                    rows.append(rid)
                    held += len(part) - 2
                    if held >= RUN_TOKENS or len(rows) >= RUN_TEXTS:
                        yield _run(classes, pieces, rows)
                        pieces, rows, held = [(hashes, parts := [])], [], 0
    if rows:
        yield _run(classes, pieces, rows)


@dataclass
class LanguageModel:
    classes: Classes
    #: ``h, n`` of all words; a table in the shared folder.
    word_counts: DataFrame
    #: ``shard, cell, fact``: what tries are made of. A shard has at most one cell, of its trigrams, and facts on words and bigrams.
    parts: DataFrame
    #: Of bigrams and trigrams.
    discounts: tuple[float, float]

    @property
    def tries(self) -> DataFrame:
        """``shard, trie``, made when they are read. Scoring makes each where its questions are, so none is stored or sent."""
        shared, discounts = sent(self.word_counts.sparkSession, self.classes), self.discounts

        def build(key: tuple, parts: pa.Table) -> pa.Table:
            trie = trie_of(received(shared), parts, discounts)
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "trie": pa.array([trie], pa.binary())})

        return self.parts.groupBy("shard").applyInArrow(build, "shard int, trie binary")


def named_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """``_rid`` and the text as bytes. Rows of equal key and text share their id, whoever computes it."""
    body = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.xxhash64(F.col(key).cast("string"), body).alias("_rid"), body.cast("binary").alias("_text"))


def count_words(texts: DataFrame) -> DataFrame:
    """``h, n``: the hash and count of every token, ends included."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts_ in slices(batch.column(0)):
                hashes, place, _ = distinct_words(texts_)
                h = np.append(hashes, np.uint64(END_HASH)).view(np.int64)
                n = np.append(np.bincount(place, minlength=len(hashes)), len(texts_))
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])
        release()

    return texts.select("_text").mapInArrow(task, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, tokens: int, distinct: int) -> Classes:
    """Words down to the least count that at most ``CLASSES`` words have, and in any case those that are dealt further.

    There are about as many different counts as the root of twice the tokens.
    """
    held, least = 0, SHARD_TOKENS + 1
    for r in sorted(counts.groupBy("n").agg(F.count("*").alias("words")).collect(), key=lambda r: -r["n"]):
        held += r["words"]
        if held > CLASSES:
            break
        least = min(least, r["n"])
    top = counts.filter(F.col("n") >= least).toArrow()
    h, n = (top[c].to_numpy().astype(np.int64) for c in ("h", "n"))
    falling = np.lexsort((h, -n))
    h, n = h[falling].view(np.uint64), n[falling]
    order = np.argsort(h)
    return Classes(h[order], order.astype(np.uint32), n, tokens, distinct, max(1, -(-tokens // SHARD_TOKENS)))


def train(df: DataFrame, key: str = "doc_id", text: str = "text") -> LanguageModel:
    """Learn from every row. Starts jobs; the word counts and trigrams are stored in the shared folder."""
    spark = df.sparkSession
    texts = named_rows(df, key, text)
    counts = stored(count_words(texts), "word-counts")
    whole = counts.agg(F.sum("n"), F.count("*")).first()
    tokens = whole[0] or 0
    classes = frequent_words(counts, tokens, whole[1])
    shared = sent(spark, classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(shared)
        for run in _runs(batches, own):
            distinct, n = counted(run.keys)
            made = _dealt(own, run, distinct, lambda at, m=n: (pack(m[at].astype(np.uint32)),), ("counts",))
            del run, distinct, n
            release()
            yield made
        release()

    def merge(table: pa.Table) -> pa.Table:
        """The distinct trigrams of a shard, by number of its words, and how many trigrams and bigrams of its own were met once and twice."""
        size = shared.value[2].size
        own = [_sums(unpack(b, np.uint64)) for b in table["words"].to_pylist()]
        words = np.unique(np.concatenate(own))
        keys = [
            renumbered(unpacked_keys(*blobs), size, size + np.searchsorted(words, w))
            for w, *blobs in zip(own, *(table[c].to_pylist() for c in KEYS), strict=True)
        ]
        del own
        columns = [np.concatenate([k[i] for k in keys]) for i in range(3)]
        del keys
        order = np.lexsort(columns[::-1])
        for i in range(3):
            columns[i] = columns[i][order]
        n = np.concatenate([unpack(b, np.uint32) for b in table["counts"].to_pylist()])[order]
        del order
        first = np.flatnonzero(edges_of(*columns))
        for i in range(3):
            columns[i] = columns[i][first]
        n = np.add.reduceat(n, first, dtype=np.int64)
        root, before, word = columns
        whole_ = root >= len(received(shared).slots)
        continued = counted(joined_pairs(root[whole_], word[whole_], np.uint64(size + len(words))))[1]
        made = (_deltas(words), *packed_keys(root, before, word), pack(n))
        met = ((continued == 1).sum(), (continued == 2).sum(), (n == 1).sum(), (n == 2).sum())
        del columns, root, before, word, whole_, continued, n, first
        release()
        return pa.table(
            [table["shard"][:1], *(pa.array([m], pa.binary()) for m in made), *(pa.array([int(m)]) for m in met)],
            names=["shard", "words", *KEYS, "counts", "once2", "twice2", "once3", "twice3"],
        )

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bigrams of the roots that are dealt to several shards, with the number of their contexts in each; a word is a class or a hash."""
        own = received(shared)
        for batch in batches:
            for words, *blobs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = _sums(unpack(words, np.uint64))
                root, _, word = unpacked_keys(*blobs)
                at = np.flatnonzero(root < len(own.slots))
                width = own.size + len(words)
                pairs, n = counted(joined_pairs(root[at], word[at], np.uint64(width)))
                root, word = (x.astype(np.int64) for x in np.divmod(pairs, np.uint64(max(width, 1))))
                rare = word >= own.size
                h = words[np.where(rare, word - own.size, 0)] if len(words) else np.zeros(len(word), np.uint64)
                columns = [pa.array(root), pa.array(word, mask=rare), pa.array(h.view(np.int64), mask=~rare), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["root", "w", "h", "n"])

    def words_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = _sums(unpack(words, np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), shard, np.int32)), pa.array(h)], ["shard", "h"])

    cell = "shard int, words binary, " + ", ".join(f"{c} binary" for c in KEYS) + ", counts binary"
    dealt = texts.mapInArrow(count, cell).groupBy("shard")
    met = ("once2", "twice2", "once3", "twice3")
    columns = f"{cell}, " + ", ".join(f"{m} long" for m in met)
    trigrams = stored(dealt.applyInArrow(merge, columns), "trigrams")
    found = trigrams.agg(*(F.coalesce(F.sum(m), F.lit(0)) for m in met)).first()
    known = trigrams.select("shard", "words").mapInArrow(words_in, "shard int, h long")
    spread = classes.shards_of_frequent()
    below, more = [], (0, 0)
    if spread:
        shards = F.broadcast(spark.createDataFrame(spread, "root long, shard int"))
        lower = trigrams.select("words", *KEYS).mapInArrow(bigrams, "root long, w long, h long, n long")
        lower = stored(lower.groupBy("root", "w", "h").agg(F.sum("n").alias("n")), "frequent-bigrams")
        more = lower.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
        below = [lower.join(shards, "root").select("shard", "root", "w", "h", "n")]
        # Dealt by word alone, as the join with the counts is, so words are shuffled once.
        known = known.union(below[0].filter("h is not null").select("shard", "h")).repartition("h").distinct()
    discounts = discount_of(found[0] + more[0], found[1] + more[1]), discount_of(found[2], found[3])
    none = F.lit(None).cast("long")
    facts = known.join(counts, "h").select("shard", none.alias("root"), none.alias("w"), "h", "n")
    for b in below:
        facts = facts.union(b)
    cells = trigrams.select("shard", F.struct("words", *KEYS, "counts").alias("cell"))
    facts = facts.select("shard", F.struct("root", "w", "h", "n").alias("fact"))
    return LanguageModel(classes, counts, cells.unionByName(facts, allowMissingColumns=True), discounts)


def trie_of(own: Classes, parts: pa.Table, discounts: tuple[float, float]) -> bytes:
    """The trie of a shard, from its cell, the counts of its rare words, and whole bigram levels of frequent roots."""
    cells, facts = (pa.Table.from_struct_array(parts[c].drop_null()) for c in ("cell", "fact"))
    known, below = facts.filter(pc.field("root").is_null()), facts.filter(~pc.field("root").is_null())
    words, learned = known["h"].to_numpy().view(np.uint64), known["n"].to_numpy()
    order = np.argsort(words)
    words, learned = words[order], learned[order]
    root = before = word = n = np.zeros(0, np.int64)
    if cells.num_rows:
        rare = own.size + np.searchsorted(words, _sums(unpack(cells["words"][0].as_py(), np.uint64)))
        # Rare words keep their order, so the trigrams stay sorted.
        root, before, word = renumbered(unpacked_keys(*(cells[c][0].as_py() for c in KEYS)), own.size, rare)
        n = unpack(cells["counts"][0].as_py(), np.int64).astype(np.int32)
    rare = below["w"].is_null().to_numpy()
    w = below["w"].fill_null(0).to_numpy()
    at = own.size + np.searchsorted(words, below["h"].fill_null(0).to_numpy().view(np.uint64))
    lower = (below["root"].to_numpy(), np.where(rare, at, w), below["n"].to_numpy())
    unigram = np.concatenate([own.log_unigram, own.log_of(learned)])
    np.power(10, unigram, out=unigram)
    return build_trie(root, before, word, n, unigram, words, discounts, lower)


#: A cell's trigrams as columns: root, word before it, predicted word.
KEYS = ("roots", "befores", "nexts")


def packed_keys(root: np.ndarray, before: np.ndarray, word: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Sorted trigrams as differences: roots to the last, the word before within its root, the word within both."""
    none = np.zeros(len(root), bool)
    columns = (root, none), (before, edges_of(root)), (word, edges_of(root, before))
    return tuple(pack(np.where(anew, c, np.diff(c, prepend=c.dtype.type(0))).astype(np.uint32)) for c, anew in columns)


def unpacked_keys(roots: bytes, befores: bytes, nexts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = unpack(roots, np.uint32)
    first = steps != 0
    first[:1] = True
    root = np.cumsum(steps, dtype=np.uint32)
    steps = unpack(befores, np.uint32)
    before = _sums_within(steps, first)
    first |= steps != 0
    word = _sums_within(unpack(nexts, np.uint32), first)
    return root.view(np.int32), before.view(np.int32), word.view(np.int32)


def _sums_within(steps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Running sums that begin anew where ``first`` says so. Sums over all may pass 32 bits, which their differences do not feel."""
    total = np.cumsum(steps, dtype=np.uint32)
    at = np.flatnonzero(first)
    return total - np.repeat(total[at] - steps[at], np.diff(np.append(at, len(steps))))


def renumbered(keys: tuple[np.ndarray, ...], size: int, rare: np.ndarray) -> tuple[np.ndarray, ...]:
    """Numbers from ``size`` on, those of rare words, replaced by others."""
    if not len(rare):
        return keys
    rare = rare.astype(np.int32)
    return tuple(np.where(k < size, k, rare[np.maximum(k - size, 0)]) for k in keys)


def _deltas(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def _sums(deltas: np.ndarray) -> np.ndarray:
    return np.cumsum(deltas, dtype=np.uint64)


def _dealt(classes: Classes, run: Run, keys: np.ndarray, columns, names: tuple[str, ...]) -> pa.RecordBatch:  # noqa: ANN001
    """One row per shard that has some of a run's sorted keys: its rare words, its trigrams, and what ``columns`` makes of their places."""
    root, before, word = parted(keys, len(run.words))
    shard = np.zeros(len(root), np.uint16 if classes.shards <= 1 << 16 else np.int32)
    for at in range(0, len(root), CHUNK):
        r, b = root[at : at + CHUNK], before[at : at + CHUNK]
        shard[at : at + CHUNK] = classes.shard_of(run.numbered[r], run.words[r], run.words[b])
    order = np.argsort(shard, kind="stable")
    root, before, word = root[order], before[order], word[order]
    own, first = np.unique(shard[order], return_index=True)
    # Numbers rise with positions, so the keys of a shard stay sorted.
    placed = run.numbered.astype(np.int32)
    used = np.zeros(len(run.words), bool)
    made = []
    for begin, end in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        sides = [side[begin:end] for side in (root, before, word)]
        for side in sides:
            used[side] = True
        rare = run.near + np.flatnonzero(used[run.near :])
        used[rare] = False
        placed[rare] = classes.size + np.arange(len(rare))
        made.append((_deltas(run.words[rare]), *packed_keys(*(placed[side] for side in sides)), *columns(order[begin:end])))
    arrays = [pa.array([m[i] for m in made], pa.binary()) for i in range(len(names) + 4)]
    return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32), pa.int32()), *arrays], ["shard", "words", *KEYS, *names])


def _log_unigram(model: LanguageModel, rows: DataFrame) -> tuple[DataFrame, Column, Column]:
    """Rows with ``h`` joined with the counts of words, whether the word is known, and log10 of its unigram."""
    c = model.classes
    count = model.word_counts.select(F.col("h").alias("_h"), F.col("n").alias("_c"))
    seen = F.coalesce(F.col("_c"), F.lit(0))
    return rows.join(count, F.col("h") == F.col("_h"), "left"), seen > 0, F.log10((seen + 1) / F.lit(float(c.n_tokens + c.n_distinct + 1)))


def _scores(texts: DataFrame, model: LanguageModel) -> DataFrame:
    """``_rid, n_tokens, n_known, base, lm``: sums over tokens, in parts; frequent words at once and the others by a join."""
    shared, discounts = sent(texts.sparkSession, model.classes), model.discounts

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(shared)
        for r in _runs(batches, own):
            facts = facts_of(own, r)
            order = np.argsort(r.keys, kind="stable").astype(np.int32)
            number = r.number[order]
            keys = r.keys[order]
            del order
            first = np.flatnonzero(edges_of(keys))
            distinct, n = keys[first], np.diff(np.append(first, len(keys))).astype(np.int32)
            first = first.astype(np.int32)
            del keys, r.keys

            def columns(at: np.ndarray) -> tuple[bytes, ...]:
                ends = np.cumsum(n[at])
                where = np.arange(ends[-1]) + np.repeat(first[at] - ends + n[at], n[at])  # noqa: B023
                return pack(n[at].astype(np.uint32)), pack(number[where])  # noqa: B023

            run = signed(xxhash.xxh3_64_intdigest(r.rids.tobytes()))
            dealt = _dealt(own, r, distinct, columns, ("counts", "numbers"))
            del distinct, n, first, number, r.number
            release()
            yield dealt.append_column("run", pa.array([run] * dealt.num_rows, pa.int64()))
            # Who the texts of the run are, and what is known without tries, goes along under a negative number, past the shards.
            names_ = pa.RecordBatch.from_arrays([pa.array([-1 - run % (4 * own.shards)], pa.int32()), *[pa.array([f], pa.binary()) for f in facts]], dealt.schema.names)
            yield names_.append_column("run", pa.array([run], pa.int64()))
        release()

    def answer(key: tuple, parts: pa.Table, asked: pa.Table) -> pa.Table:
        """The sums of one shard's trigrams; a negative one has the names and facts of runs, which are passed on."""
        shard = key[0].as_py()
        made = []
        own = received(shared) if shard >= 0 and asked.num_rows else None
        trie = Shard(trie_of(own, parts, discounts)) if own and parts.num_rows else None
        release()
        for batch in asked.to_batches(max_chunksize=1):
            words, *blobs, counts, numbers, run = (c[0].as_py() for c in batch.columns[1:])
            if shard < 0:
                tokens, base, open_ = blobs
                made.append((run, words, None, numbers, open_, tokens, base, counts))
                continue
            words = _sums(unpack(words, np.uint64))
            root, before, word = keys = unpacked_keys(*blobs)
            if trie:
                found, missing = trie.look_up(*(k.astype(np.uint64) for k in renumbered(keys, own.size, trie.numbers(words))))
            else:  # a shard that nothing was learned for
                found, missing = np.zeros(len(word)), np.ones(len(word), bool)
            cached = missing & (word < own.size)
            found[cached] += own.log_unigram[word[cached]]
            missing = missing & ~cached
            counts, numbers = unpack(counts, np.uint32), unpack(numbers, np.uint16)
            number = np.flatnonzero(np.bincount(numbers)).astype(np.uint16)
            sums = np.bincount(numbers, np.repeat(found, counts))[number]
            still = np.repeat(missing, counts)
            open_ = words[word[missing] - own.size]
            made.append((run, pack(number), pack(sums), pack(numbers[still]), pack(np.repeat(open_, counts[missing])), None, None, None))
        del trie
        release()
        columns = [pa.array([m[i] for m in made], pa.binary() if i else pa.int64()) for i in range(8)]
        return pa.table(columns, names=["run", "texts", "sums", "open_texts", "open_words", "tokens", "base", "counts"])

    def total(table: pa.Table) -> pa.Table:
        """The sums of a run's texts over all shards, and tokens whose unigrams are to be added. A run that repeats has its rows twice, and so its sums."""
        rows = table.to_pylist()
        own, tried = [r for r in rows if r["base"] is not None], [r for r in rows if r["base"] is None]
        rids = unpack(own[0]["texts"], np.int64)
        tokens = sum(unpack(r["tokens"], np.uint32).astype(np.int64) for r in own).reshape(2, -1)
        base = sum(unpack(r["base"], np.float64) for r in own)
        lm = np.zeros(len(rids))
        for r in tried:
            lm[unpack(r["texts"], np.uint16)] += unpack(r["sums"], np.float64)

        def column(rows: list[dict], name: str, kind: type) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *(unpack(r[name], kind) for r in rows)])

        words, place = np.unique(column(own, "open_words", np.uint64), return_inverse=True)
        pairs, place = np.unique(place * len(rids) + column(own, "open_texts", np.uint16), return_inverse=True)
        n = np.bincount(place, column(own, "counts", np.uint32), len(pairs)).astype(np.int64)
        open_, m = counted(np.searchsorted(words, column(tried, "open_words", np.uint64)) * len(rids) + column(tried, "open_texts", np.uint16))
        still = np.zeros(len(pairs), np.int64)
        still[np.searchsorted(pairs, open_)] = m
        word, text = np.divmod(pairs, max(len(rids), 1))
        h = pa.array(np.append(np.zeros(len(rids), np.uint64), words[word]).view(np.int64), mask=np.arange(len(rids) + len(pairs)) < len(rids))
        below = lambda a, b: np.append(a, b.astype(a.dtype))
        none = np.zeros(len(pairs), np.int64)
        return pa.table(
            {"_rid": np.append(rids, rids[text]), "h": h, "n": below(tokens[0], n), "open": below(np.zeros(len(rids), np.int64), still),
             "known": below(tokens[1], none), "base": below(base, none), "lm": below(lm, none)}
        )

    names = ("words", *KEYS, "counts", "numbers")
    asked = texts.mapInArrow(ask, "shard int, " + ", ".join(f"{c} binary" for c in names) + ", run long")
    grouped = model.parts.groupBy("shard").cogroup(asked.select("shard", *names, "run").groupBy("shard"))
    answered = ("texts", "sums", "open_texts", "open_words", "tokens", "base", "counts")
    parts = grouped.applyInArrow(answer, "run long, " + ", ".join(f"{c} binary" for c in answered))
    summed = parts.groupBy("run").applyInArrow(total, "_rid long, h long, n long, open long, known long, base double, lm double")
    summed = stored(summed, "trie-scores")
    others, known, log_u = _log_unigram(model, summed.filter("h is not null"))
    others = others.select(
        "_rid", F.lit(0).cast("long").alias("n_tokens"), F.when(known, F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * log_u).alias("base"), (F.col("open") * log_u).alias("lm"),
    )
    return summed.filter("h is null").select("_rid", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), "base", "lm").unionByName(others)


def facts_of(classes: Classes, run: Run) -> tuple[bytes, ...]:
    """The texts of a run, packed: ids, numbers of tokens and of frequent ones, base scores of these; then hash, count and text of rare words."""
    word = (run.keys % np.uint64(max(len(run.words), 1))).astype(np.int64)
    near = word < run.near
    size = len(run.rids)
    tokens = np.bincount(run.number, minlength=size), np.bincount(run.number[near], minlength=size)
    base = np.bincount(run.number[near], classes.log_unigram[run.numbered[word[near]]], size)
    pairs, n = counted(word[~near] * size + run.number[~near])
    word, text = np.divmod(pairs, max(size, 1))
    facts = np.concatenate(tokens).astype(np.uint32), base, run.words[word], n.astype(np.uint32), text.astype(np.uint16)
    return pack(run.rids), *map(pack, facts)


def score(df: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key, n_tokens, n_known, train_tokens, base_score, score``, scores as log10."""
    texts = named_rows(df, key, text)
    sums = _scores(texts, model).groupBy("_rid").agg(*(F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", "lm")))
    names = df.select(F.col(key), F.xxhash64(F.col(key).cast("string"), F.coalesce(F.col(text), F.lit(""))).alias("_of"))
    names = stored(names, "row-names")
    copies = names.groupBy("_of").agg(F.count("*").alias("copies"))
    totals = stored(sums.join(copies, F.col("_rid") == F.col("_of")).drop("_of"), "scores")
    each = lambda c, kind: (F.col(c) / F.col("copies")).cast(kind)
    return names.join(totals, F.col("_of") == F.col("_rid")).select(
        key, each("n_tokens", "long").alias("n_tokens"), each("n_known", "long").alias("n_known"),
        F.lit(model.classes.n_tokens).cast("long").alias("train_tokens"), each("base", "double").alias("base_score"),
        each("lm", "double").alias("score"),
    )


by_value(sys.modules[__name__])
