"""Near duplicates by MinHash with tensored banding, confirmed on whole shingle sets.

A table key is made of one band from each of two small collections: with ``BANDS`` bands of ``ROWS`` minhashes a
collection, ``2 * BANDS * ROWS`` minhashes give ``BANDS ** 2`` tables of ``2 * ROWS`` minhashes each, where plain banding
would compute ``BANDS ** 2 * 2 * ROWS``. A pair of similarity s shares a table unless it shares no band in one of the
collections: with 10 bands of 3, a pair of 0.8 is missed with probability 0.0015, one of 0.85 with 0.0002. Bands that no
other document has are dropped before bands are combined, so documents without near duplicates make no table keys.

Documents with equal sets are one node from the start, named by a 64-bit hash of the set. In each table bucket the node
with most bucket mates stands for it, so that a group of thousands gives a star and not all pairs, and pairs are
confirmed in three rounds. First each node points to the representative with which it shares most buckets; pointers lead to ever
heavier nodes, so following them gives components without a search. Then nodes are compared with
all other representatives of theirs in other components; then pairs of nodes that share a bucket but still lie in different components.
Of these, most can't be similar, and which ones is known exactly from a representative r that both have. Of each of ``PARTS`` parts
of r, x and y lack at least as many shingles as the one that lacks more, which bounds what they have in common within r, so they need the rest among the shingles that r
lacks. These are rare, and a join on them finds the pairs that share enough; pairs that need none, since one is smaller than
r, are found by their sizes. A pair with several such representatives is looked at for the first one only. No bucket is capped. A pair is confirmed by streaming: partitions are sorted so that the representative's
set comes first and its partners follow; partners of a frequent one are dealt to several tasks. Links of the later rounds join
components by alternating large-star and small-star steps on tables in the shared folder.

Defined results: a text with fewer words than a shingle is one shingle of all its words; null and blank texts have no
shingle, are linked with nothing and form their own component; repeated rows have equal sets and so one component; the
component's id is its smallest key, nulls aside; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.words import by_value, pieces, text_bytes
from siltworks.session import stored

BANDS, ROWS = 10, 3
REMEMBERED = 200_000
#: Partners that one copy of a representative's set is compared with.
PARTNERS = 400
#: Pairs that are broadcast to the scan of texts: at some 60 bytes, 30 MB.
MOST_BROADCAST = 500_000
#: Parts of a representative's sorted set in which the shingles that a partner lacks are counted.
PARTS = 64
#: Shingles hashed at once.
CHUNK = 1 << 13

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of the words that a task has met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = found
        return found


def shingle_set(text: bytes, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``width`` words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k]
    return np.unique(_mixed(out))


class Bands:
    """The bands of both collections as 64-bit hashes."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 7):
        draw = np.random.default_rng(seed)
        n = 2 * bands * rows
        self.shape = (2 * bands, rows)
        self.a = draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 1 << 63, n, dtype=np.uint64)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), ~np.uint64(0))
        for at in range(0, len(shingles), CHUNK):
            low = np.minimum(low, (shingles[at : at + CHUNK, None] * self.a + self.b).min(axis=0))
        out = np.zeros(self.shape[0], np.uint64)
        for column in low.reshape(self.shape).T:
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + column)
        return out.view(np.int64)


def set_name(shingles: np.ndarray) -> int:
    """The node of a set, as a signed 64-bit integer."""
    found = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return found - (1 << 64) if found >= 1 << 63 else found


def sketch(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: ``_key``, ``_same`` (a hash of the text), ``n_shingles``, ``node`` and ``halves``, the bands of both collections."""
    whole = F.coalesce(F.col(text), F.lit(""))
    read = df.select(F.col(key).alias("_key"), F.xxhash64(whole).alias("_same"), whole.cast("binary").alias("_text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, half = WordHashes(), Bands(bands, rows)
        for batch in pieces(batches):
            sets = (shingle_set(x.as_py(), width, hashes) for x in batch.column(2))
            made = [(len(s), set_name(s), half.of(s)) if len(s) else (0, None, None) for s in sets]
            columns = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["_key", "_same", "n_shingles", "node", "halves"])

    kind = df.schema[key].dataType.simpleString()
    return read.mapInArrow(task, f"_key {kind}, _same long, n_shingles long, node long, halves array<long>")


def bucket_entries(nodes: DataFrame, bands: int = BANDS) -> DataFrame:
    """``node, key, n, bucket`` for buckets of two or more nodes, with the node's weight: its number of bucket mates."""
    own = nodes.select("node", "key", "n", F.posexplode("halves").alias("i", "half"))
    common = own.groupBy("i", "half").agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    sides = own.join(common, ["i", "half"]).groupBy("node", "key", "n").agg(
        F.collect_list(F.when(F.col("i") < bands, F.struct("i", "half"))).alias("left"),
        F.collect_list(F.when(F.col("i") >= bands, F.struct("i", "half"))).alias("right"),
    )
    crossed = sides.withColumn("l", F.explode("left")).withColumn("r", F.explode("right"))
    entries = crossed.select("node", "key", "n", F.xxhash64("l.i", "r.i", "l.half", "r.half").alias("bucket"))
    mates = entries.groupBy("bucket").agg(F.count("*").alias("mates")).filter("mates > 1")
    # A node has at most one entry in each of the tables.
    weight = F.sum("mates").over(Window.partitionBy("node"))
    return stored(entries.join(mates, "bucket").withColumn("weight", weight).drop("mates"), "buckets")


def compare_sets(pairs: DataFrame, df: DataFrame, key: str, text: str, width: int, extras: bool = False) -> DataFrame:
    """For pairs ``a, b``: sizes ``n_a, n_b``, the number ``both`` of common shingles, ``extra``, those of b that a lacks, and ``lost``, how
    many of each part of a b lacks, at most 127.

    ``pairs`` also has the keys ``a_key``, ``b_key`` of documents with the sets. The whole sets are made again from these
    documents' texts; the join that finds them broadcasts the pairs only if they are counted to be few. ``extra`` and ``lost`` are
    null unless asked for.
    """
    # Only representatives with many partners are looked up: at most one in PARTNERS of the pairs.
    many = pairs.groupBy("a").agg(F.count("*").alias("_n")).filter(F.col("_n") > PARTNERS).withColumnRenamed("a", "_many")
    many = F.broadcast(many) if many.count() <= MOST_BROADCAST else many
    slots = F.ceil(F.coalesce("_n", F.lit(1)) / PARTNERS)
    dealt = pairs.join(many, F.col("a") == F.col("_many"), "left").withColumn("slot", F.pmod(F.xxhash64("b"), slots).cast("int"))
    dealt = stored(dealt.drop("_many", "_n"), "pairs")
    heads = dealt.select("a", "slot", F.col("a").alias("node"), F.col("a_key").alias("_k"), F.lit(0).alias("turn")).distinct()
    tails = dealt.select("a", "slot", F.col("b").alias("node"), F.col("b_key").alias("_k"), F.lit(1).alias("turn"))
    wanted = stored(heads.unionByName(tails), "wanted")
    texts = text_bytes(df, key, text)
    few = wanted.count() <= MOST_BROADCAST
    joined = texts.join(F.broadcast(wanted) if few else wanted, F.col(key) == F.col("_k")).select("a", "slot", "node", "turn", "_text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches):
            made = [shingle_set(x.as_py(), width, hashes) for x in batch.column(4)]
            right = [len(s) > 0 and set_name(s) == n for s, n in zip(made, batch.column(2).to_pylist(), strict=True)]
            blob = pa.array([s.tobytes() for s in made], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], blob], ["a", "slot", "node", "turn", "blob"]).filter(pa.array(right))

    names = ["a", "b", "n_a", "n_b", "both", "extra", "lost"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, np.zeros(0, np.uint64)
        for batch in pieces(batches):
            found = []
            for i, (a, slot, node, turn) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
                if turn == 0:
                    if head != (a, slot):
                        head, own = (a, slot), np.frombuffer(batch.column(4)[i].as_py(), np.uint64)
                    continue
                other = np.frombuffer(batch.column(4)[i].as_py(), np.uint64)
                if head == (a, slot):
                    common = np.intersect1d(own, other, assume_unique=True)
                    extra = lost = None
                    if extras:
                        extra = np.setdiff1d(other, common, assume_unique=True).view(np.int64)
                        at = np.flatnonzero(np.isin(own, common, assume_unique=True, invert=True))
                        lost = np.minimum(np.bincount(at * PARTS // len(own), minlength=PARTS), 127).astype(np.int8)
                    found.append((a, node, len(own), len(other), len(common), extra, lost))
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.list_(pa.int8())]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)], names)

    blobs = joined.mapInArrow(sets, "a long, slot int, node long, turn int, blob binary")
    sorted_ = blobs.repartition("a", "slot").sortWithinPartitions("a", "slot", "turn")
    return sorted_.mapInArrow(compare, "a long, b long, n_a long, n_b long, both long, extra array<long>, lost array<tinyint>")


def unlinked_pairs(diffs: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, a_key, b, b_key`` of nodes of different roots that may be similar, from their differences to one representative.

    ``diffs`` is what ``compare_sets`` gives for representatives and partners, with each partner's ``b_key``, ``root`` and ``heads``, all
    representatives that it is compared with in this way, by which a pair with several of them is looked at once.
    """

    def side(rows: DataFrame, name: str, *more: str) -> DataFrame:
        columns = {"b": name, "b_key": f"key_{name}", "root": f"root_{name}", "heads": f"heads_{name}", "n_b": f"n_{name}", "both": f"both_{name}", "n_a": f"of_{name}", "lost": f"lost_{name}"}
        return rows.select("a", *(F.col(c).alias(n) for c, n in columns.items()), *(F.col(c).alias(f"{c}_{name}") for c in more))

    needed = percent * (F.col("n_x") + F.col("n_y"))  # common shingles, times 100 + percent
    lacking = F.zip_with("lost_x", "lost_y", lambda x, y: F.greatest(x, y).cast("int"))
    inside = F.col("of_x") - F.aggregate(lacking, F.lit(0), lambda total, n: total + n)
    first = F.col("a") == F.array_min(F.array_intersect("heads_x", "heads_y"))
    rare = diffs.withColumn("e", F.explode("extra")).drop("extra")
    counts = rare.groupBy("a", "e").agg(F.count("*").alias("_n"), F.min("root").alias("_low"), F.max("root").alias("_high"))
    rare = rare.join(counts.filter("_low <> _high").select("a", "e", "_n"), ["a", "e"])
    # A partner has at least percent of x, so at least so many of these; among all but that many less one there is one.
    least = F.greatest(F.ceil(percent * F.col("n_b") / 100 - F.col("both")), F.lit(1))
    own = Window.partitionBy("a", "b")
    rare = rare.withColumns({"all": F.count("*").over(own), "_place": F.row_number().over(own.orderBy("_n", "e")), "_least": least})
    rare = stored(rare.filter(F.col("_place") <= F.col("all") - F.col("_least") + 1), "rare")
    enough = needed <= (100 + percent) * (inside + F.least("all_x", "all_y"))
    met = (F.col("a_x") == F.col("a")) & (F.col("e_x") == F.col("e_y"))
    one, two = side(rare, "x", "e", "all").withColumnRenamed("a", "a_x"), side(rare, "y", "e", "all")
    shared = one.join(two, met & (F.col("root_x") < F.col("root_y")) & enough & first)
    # Without a shared shingle outside of r: x is not similar to r, and y is smaller than r, so small that x can do with what it has in r.
    x = side(diffs, "x").filter(100 * F.col("both_x") < percent * (F.col("of_x") + F.col("n_x") - F.col("both_x")))
    smallest, largest = F.ceil(percent * F.col("n_x") / 100), F.floor((100 + percent) * F.col("both_x") / percent) - F.col("n_x")
    x = x.filter(smallest <= largest).withColumn("size", F.explode(F.sequence(smallest, largest))).withColumnRenamed("a", "a_x")
    y = side(diffs.filter("n_b < n_a"), "y")
    fits = (F.col("a_x") == F.col("a")) & (F.col("size") == F.col("n_y")) & (needed <= (100 + percent) * inside)
    none = x.join(y, fits & (F.col("root_x") != F.col("root_y")) & first)
    pairs = [p.select("x", "key_x", "y", "key_y") for p in (shared, none)]
    swap = F.col("x") > F.col("y")
    sides = F.struct(F.col("x").alias("n"), F.col("key_x").alias("k")), F.struct(F.col("y").alias("n"), F.col("key_y").alias("k"))
    ordered = pairs[0].unionByName(pairs[1]).select(F.when(swap, sides[1]).otherwise(sides[0]).alias("a"), F.when(swap, sides[0]).otherwise(sides[1]).alias("b"))
    return ordered.select(F.col("a.n").alias("a"), F.col("a.k").alias("a_key"), F.col("b.n").alias("b"), F.col("b.k").alias("b_key")).dropDuplicates(["a", "b"])


def followed(pointers: DataFrame) -> DataFrame:
    """``node, root`` of pointers ``b`` to ``a`` that form no circle, by following twice as far in each step."""
    found = pointers.select(F.col("b").alias("node"), F.col("a").alias("root"))
    while True:
        ahead = found.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        found = stored(found.join(ahead, "root", "left").select("node", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "followed")
        if found.filter("_moved").isEmpty():
            return found.select("node", "root")
        found = found.drop("_moved")


def rooted(pairs: DataFrame, roots: DataFrame, *sides: str) -> DataFrame:
    """The pairs with the ``root_`` of their sides; a node without one is its own."""
    for side in sides:
        known = roots.select(F.col("node").alias(side), F.col("root").alias("_root"))
        pairs = pairs.join(known, side, "left").withColumn(f"root_{side}", F.coalesce("_root", side)).drop("_root")
    return pairs


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for all nodes of ``a, b``; the root is the component's smallest node."""
    swap = F.col("a") > F.col("b")
    low, high = F.when(swap, F.col("b")).otherwise(F.col("a")), F.when(swap, F.col("a")).otherwise(F.col("b"))
    edges = stored(edges.filter("a <> b").select(high.alias("u"), low.alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # Sums of hashes of all edges are equal only if the step changed none.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def judged(df: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """Per row ``_key``, ``_same`` (a hash of the text), ``n_shingles``, ``root`` (null without shingles) and ``component_id``."""
    rows = stored(sketch(df, key, text, width), "sketches")
    nodes = rows.filter("n_shingles > 0").groupBy("node")
    nodes = stored(nodes.agg(F.min("_key").alias("key"), F.first("halves").alias("halves"), F.max("n_shingles").alias("n")), "nodes")
    entries = bucket_entries(nodes.filter("key is not null"))
    head = entries.groupBy("bucket").agg(F.max(F.struct("weight", "node", "n", "key")).alias("_h"))
    starred = entries.join(head.select("bucket", F.col("_h.node").alias("a"), F.col("_h.key").alias("a_key"), F.col("_h.n").alias("_n")), "bucket")
    starred = stored(starred.select("bucket", "a", "a_key", "_n", F.col("node").alias("b"), F.col("key").alias("b_key"), "n"), "stars")
    fits = 100 * F.least("n", "_n") >= percent * F.greatest("n", "_n")  # else the sets are too unequal in size
    stars = starred.filter((F.col("a") != F.col("b")) & fits).groupBy("a", "a_key", "b", "b_key").agg(F.count("*").alias("_shared"))
    order = Window.partitionBy("b").orderBy(F.desc("_shared"), F.desc("a"))  # a node has at most one star in each table
    stars = stored(stars.withColumn("_turn", F.row_number().over(order)).drop("_shared"), "stars")

    def confirmed(pairs: DataFrame) -> DataFrame:
        compared = compare_sets(pairs.select("a", "a_key", "b", "b_key"), df, key, text, width)
        similar = 100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))
        return stored(compared.filter(similar).select("a", "b").distinct(), "confirmed")

    roots = followed(confirmed(stars.filter("_turn = 1")))
    rest = stored(rooted(stars.filter("_turn > 1"), roots, "a", "b").filter("root_a <> root_b"), "rest")
    links = confirmed(rest)
    # Components that these links join take the smallest root that one link leads to, which is enough to leave out most pairs.
    led = rooted(links, roots, "a", "b").select(F.greatest("root_a", "root_b").alias("root"), F.least("root_a", "root_b").alias("_led"))
    led = stored(led.groupBy("root").agg(F.min("_led").alias("_led")), "led")
    near = roots.join(led, "root", "left").select("node", F.coalesce("_led", "root").alias("root"))
    near = near.unionByName(led.select(F.col("root").alias("node"), F.col("_led").alias("root")))
    # What is left: nodes of one bucket in different components.
    labelled = stored(rooted(starred, near, "b").withColumnRenamed("root_b", "root"), "labelled")
    mixed = labelled.groupBy("bucket").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).filter("_low <> _high")
    around = labelled.join(mixed.select("bucket"), "bucket", "left_semi").filter("a <> b")
    around = around.groupBy("a", "a_key", "b", "b_key", "root").agg(F.lit(1)).drop("1")
    around = stored(around.withColumn("heads", F.array_sort(F.collect_set("a").over(Window.partitionBy("b")))), "around")
    diffs = stored(compare_sets(around.select("a", "a_key", "b", "b_key"), df, key, text, width, extras=True), "differences")
    diffs = diffs.dropDuplicates(["a", "b"]).join(around.select("a", "b", "b_key", "root", "heads"), ["a", "b"])
    tried = stars.select("a", "b").unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    last = stored(unlinked_pairs(stored(diffs, "differences"), percent).join(tried, ["a", "b"], "left_anti"), "last")
    links = rooted(links.unionByName(confirmed(last)), roots, "a", "b")
    joined = components(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    placed = rooted(nodes.select(F.col("node").alias("b"), "key"), roots, "b").withColumnRenamed("root_b", "node")
    placed = placed.join(joined, "node", "left").select(F.col("b").alias("node"), "key", F.coalesce("root", "node").alias("root"))
    placed = stored(placed, "components")
    smallest = placed.groupBy("root").agg(F.min("key").alias("component_id"))
    ids = placed.select("node", "root").join(smallest, "root")
    out = rows.join(ids, "node", "left").withColumn("component_id", F.coalesce("component_id", "_key"))
    return out.select("_key", "_same", "n_shingles", "root", "component_id")


def cluster(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``key``, ``n_shingles``, ``component_id`` and ``kept`` (the key is the component's).

    Starts jobs; tables of sketches, buckets and links are written to the shared folder.
    """
    out = judged(df, key, text, width, percent)
    kept = F.col("_key").eqNullSafe(F.col("component_id"))
    return out.select(F.col("_key").alias(key), "n_shingles", "component_id", kept.alias("kept"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The input rows of which each component keeps one: that with the smallest key, and of these with the smallest hash of the text.

    A row is known by key and text, so different texts that share a key don't replace each other. Rows that repeat both become
    one of them if they have words; rows without words all stay.
    """
    rows = stored(judged(df, key, text, width, percent).filter("root is not null"), "clusters")
    alike = rows.groupBy("root", F.col("_key").alias("_k"), F.col("_same").alias("_s")).agg(F.count("*").alias("_n"))
    alike = stored(alike, "clusters")
    place = F.struct(F.col("_k").isNull().alias("none"), F.col("_k").alias("k"), F.col("_s").alias("s"))
    first = alike.groupBy("root").agg(F.min(place).alias("_first"))
    marked = alike.join(first, "root").withColumn("_stays", F.col("_k").eqNullSafe(F.col("_first.k")) & (F.col("_s") == F.col("_first.s")))
    marked = stored(marked.select("_k", "_s", "_n", "_stays"), "marked")
    same = F.col(key).eqNullSafe(F.col("_k")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("_s"))

    def listed(rows: DataFrame) -> DataFrame:
        rows = rows.select("_k", "_s")
        return F.broadcast(rows) if rows.count() <= MOST_BROADCAST else rows

    rest = df.join(listed(marked.filter("not _stays")), same, "left_anti")
    repeated = marked.filter("_stays and _n > 1")
    if repeated.isEmpty():
        return rest
    ids = listed(repeated)
    once = rest.join(ids, same, "left_semi").withColumn("_s", F.xxhash64(F.coalesce(F.col(text), F.lit("")))).dropDuplicates([key, "_s"])
    return rest.join(ids, same, "left_anti").unionByName(once.drop("_s"))


by_value(sys.modules[__name__])
