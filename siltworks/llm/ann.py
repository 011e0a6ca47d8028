"""Approximate nearest neighbours by a forest of hash prefixes.

Each of ``TREES`` trees gives a vector a string of ``BITS`` bits, the sides of random hyperplanes through the mean, and
is the sorted array of these strings. A query descends each tree to its longest common prefix and ascends all trees at
once, one bit at a time, until the rows that share a prefix of that length reach ``enough`` over all trees. All of them,
without a cap, are candidates, and their exact distances decide.

In Spark a tree is dealt by its first bits, as many as leave ``BLOCK`` rows to a part; a part with more (vectors that
crowd together) is dealt into blocks, to each of which its queries go. Queries that need a shorter prefix than that are dealt
again by half as many bits, down to none, so the parts bound the work and no query's candidates. Counts per prefix length add up over
blocks and trees to the length at which a query stops, and the nearest of each block are merged, so no task holds
more than a block. Equal vectors are one entry that lists their smallest ids, since only ``k + 1`` of these can be among
a query's nearest, so one vector that makes up a third of all rows costs no more than any other.

``enough`` and the number of bits a tree is dealt by are chosen from the data: ``SAMPLE`` queries are compared with all
rows, and the smallest value that finds ``RECALL`` of their true neighbours is taken. Vectors without structure need
nearly all rows, others few.

Defined results: vectors that are null, empty, zero or have a null or non-finite component take no part, nor do rows
without id; vectors of other lengths are never compared; repeated rows count once; rows that share an id but not the
vector are candidates each, but never of their own id; ties go to the smaller id; empty tables give an empty result.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.words import by_value
from siltworks.session import stored

TREES, BITS = 16, 24
BLOCK = 16_384
QUERIES = 4_096
SAMPLE = 96
RECALL = 0.96
SEED = 11


def usable(vector: str) -> Column:
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def planes(dim: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).normal(size=(dim, trees * bits))


def prefix_codes(x: np.ndarray, mean: np.ndarray, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """One integer per row and tree; its highest bit is the first of the string."""
    sides = (x - mean) @ planes(len(mean), trees, bits) > 0
    return sides.reshape(len(x), trees, bits) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


def common_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix."""
    return BITS - np.frexp((a ^ b).astype(np.float64))[1]


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.float64) for x in column]


def entries(df: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """The distinct vectors: ``vid``, ``ids`` (the k + 1 smallest keys), ``dim``, and the vector itself."""
    rows = df.filter(usable(vector) & F.col(key).isNotNull())
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    ranked = rows.withColumn("_r", F.dense_rank().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("_r") <= k + 1)
    distinct = ranked.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    return stored(distinct.select(F.monotonically_increasing_id().alias("vid"), "ids", F.size("v").alias("dim"), "v"), "vectors")


def hashed(distinct: DataFrame, means: dict[int, np.ndarray]) -> DataFrame:
    """``vid, first`` (its smallest id), ``dim, codes, x`` (the vector as bytes)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                x = own.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                codes = prefix_codes(x, means[int(dim)])
                blobs = pa.array([r.tobytes() for r in np.ascontiguousarray(x, "<f8")], pa.binary())
                columns = [*own.columns[:3], pa.array(list(codes), pa.list_(pa.int64())), blobs]
                yield pa.RecordBatch.from_arrays(columns, ["vid", "first", "dim", "codes", "x"])

    rows = distinct.select("vid", F.col("ids")[0].alias("first"), "dim", "v")
    return stored(rows.mapInArrow(task, "vid long, first long, dim int, codes array<long>, x binary"), "codes")


def mean_vectors(distinct: DataFrame) -> dict[int, np.ndarray]:
    """The mean of the vectors of each length, rounded so that it does not depend on the order of sums."""
    at = distinct.select("dim", F.posexplode("v").alias("i", "c")).groupBy("dim", "i").agg(F.round(F.avg("c"), 7).alias("m"))
    out: dict[int, list] = {}
    for r in at.orderBy("dim", "i").collect():
        out.setdefault(r["dim"], []).append(r["m"])
    return {d: np.array(m) for d, m in out.items()}


def calibrate(index: DataFrame, asked: DataFrame, k: int, recall: float) -> dict[int, tuple[int, int]]:
    """Per length of vector: how many rows are enough, and the shortest prefix at which a sampled query then stops.

    The sampled queries are compared with all rows in tasks that send back their nearest and counts per prefix length.
    """
    size = Window.partitionBy("dim").orderBy(F.xxhash64("vid"), "vid")
    chosen = asked.join(index, "vid").withColumn("_r", F.row_number().over(size)).filter(F.col("_r") <= SAMPLE)
    sample = {}
    for r in chosen.select("vid", "dim", "codes", "x").collect():
        sample.setdefault(r["dim"], []).append((r["vid"], np.array(r["codes"]), np.frombuffer(r["x"], np.float64)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vids = batch.column(2).to_numpy(), batch.column(0).to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x, codes = np.stack(_vectors(batch.column(4).take(pa.array(at)))), np.array(batch.column(3).take(pa.array(at)).to_pylist())
                out = []
                for vid, code, q in sample.get(int(dim), []):
                    bits = common_bits(codes, code)
                    other = vids[at] != vid
                    d = np.where(other, ((x - q) ** 2).sum(axis=1), np.inf)
                    for j in np.argsort(d, kind="stable")[:k]:
                        if d[j] < np.inf:
                            out.append((vid, d[j], int(bits[j].max()), 0))
                    out += [(vid, -1.0, b, int(n)) for b, n in enumerate(np.bincount(bits[other].ravel(), minlength=BITS + 1))]
                kinds = (pa.int64(), pa.float64(), pa.int32(), pa.int64())
                arrays = [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["vid", "d", "bits", "n"])

    made = stored(index.mapInArrow(task, "vid long, d double, bits int, n long"), "calibration")
    nearest = made.filter("d >= 0").withColumn("_r", F.row_number().over(Window.partitionBy("vid").orderBy("d"))).filter(F.col("_r") <= k)
    found: dict[int, list] = {}
    for r in nearest.collect():
        found.setdefault(r["vid"], []).append(r["bits"])
    counts: dict[int, np.ndarray] = {}
    for r in made.filter("d < 0").groupBy("vid", "bits").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(r["vid"], np.zeros(BITS + 1, np.int64))[r["bits"]] = r["n"]
    out = {}
    for dim, rows in sample.items():
        most = max(int(counts[vid].sum()) for vid, _, _ in rows)
        enough = 16 * k
        while True:
            stops = {vid: stop_length(counts[vid], enough) for vid, _, _ in rows}
            hits = [b >= stops[vid] for vid, _, _ in rows for b in found.get(vid, [])]
            if not hits or np.mean(hits) >= recall or enough >= most:
                break
            enough = math.ceil(enough * 1.25)
        out[dim] = (enough, min(stops.values()))
    return out


def stop_length(counts: np.ndarray, enough: int) -> int:
    """The longest prefix that ``enough`` rows share over all trees; ``counts`` has the rows by exact length."""
    shared = np.cumsum(counts[::-1])[::-1]
    reached = np.flatnonzero(shared >= enough)
    return int(reached[-1]) if len(reached) else 0


def search(
    df: DataFrame, asked: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", recall: float = RECALL
) -> DataFrame:
    """The k nearest rows found for each row of ``asked``: ``query_id, rank, vec_id, score`` with Euclidean distance.

    ``asked`` has the same columns and holds rows of ``df``. Starts jobs; tables go to the shared folder.
    """
    distinct = entries(df, key, vector, k)
    index = hashed(distinct, mean_vectors(distinct))
    named = asked.filter(usable(vector) & F.col(key).isNotNull())
    named = named.select(F.col(key).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v")).distinct()
    named = stored(named.join(distinct, "v").select("query_id", "vid"), "queries")
    queries = stored(named.select("vid").distinct(), "query-vectors")
    tuned = calibrate(index, queries, k, recall)
    sizes = {r["dim"]: r["count"] for r in index.groupBy("dim").count().collect()}
    cut = {d: max(0, min(tuned.get(d, (0, 0))[1], int(math.log2(max(1, n / BLOCK))))) for d, n in sizes.items()}
    if not sizes:
        sizes = cut = {0: 0}
    enough = {d: tuned.get(d, (k, 0))[0] for d in sizes}
    by_dim = lambda of: F.element_at(F.create_map(*[F.lit(x) for pair in of.items() for x in pair]), F.col("dim"))
    tree = ["tree", "dim", "part"]
    where = [*tree, "block", "turn"]

    def counted(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        codes = np.sort(left["code"].to_numpy())
        mine = right["code"].to_numpy()
        shared = np.empty((len(mine), BITS + 1), np.int64)
        for b in range(BITS + 1):
            low = (mine >> (BITS - b)) << (BITS - b)
            shared[:, b] = np.searchsorted(codes, low + (1 << (BITS - b))) - np.searchsorted(codes, low)
        return pa.table({"vid": right["vid"], "shared": pa.array(list(shared), pa.list_(pa.int64()))})

    def nearest(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("code")
        codes, vids, firsts = (left[c].to_numpy() for c in ("code", "vid", "first"))
        out = []
        x = np.stack([np.frombuffer(b, np.float64) for b in left["x"].to_pylist()]) if len(codes) else None
        for vid, code, stop, q in zip(*(right[c].to_pylist() for c in ("vid", "code", "stop", "x")), strict=True):
            low = (code >> (BITS - stop)) << (BITS - stop)
            a, b = np.searchsorted(codes, [low, low + (1 << (BITS - stop))])
            if a == b:
                continue
            d = np.sqrt(((x[a:b] - np.frombuffer(q, np.float64)) ** 2).sum(axis=1))
            near = np.flatnonzero(d <= np.partition(d, k)[k]) if b - a > k + 1 else np.arange(b - a)
            near = near[np.lexsort((firsts[a:b][near], d[near]))][: k + 1]
            out += [(vid, v, s) for v, s in zip(vids[a:b][near], d[near], strict=True)]
        kinds = (("qid", pa.int64()), ("vid", pa.int64()), ("score", pa.float64()))
        return pa.table({n: pa.array([o[i] for o in out], t) for i, (n, t) in enumerate(kinds)})

    def in_trees(rows: DataFrame, cut: dict[int, int]) -> DataFrame:
        out = rows.select("vid", "first", "dim", "x", F.posexplode("codes").alias("tree", "code"))
        return out.withColumn("part", F.floor(F.col("code") / F.pow(F.lit(2.0), F.lit(BITS) - by_dim(cut))).cast("long"))

    def found_in_parts(asking: DataFrame, cut: dict[int, int]) -> tuple[DataFrame, DataFrame]:
        """What the queries find in trees dealt by ``cut`` bits, and those of them that need a shorter prefix."""
        rows, ask = in_trees(index, cut), stored(in_trees(index.join(asking, "vid"), cut), "asked")
        parts = rows.groupBy(*tree).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        asks = ask.groupBy(*tree).agg(F.ceil(F.count("*") / QUERIES).alias("rounds"))
        parts = stored(parts.join(asks, tree), "parts")
        block = F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int")
        turn = F.pmod(F.xxhash64("vid", F.lit(1)), F.col("rounds")).cast("int")
        upto = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
        rows = rows.join(parts, tree).withColumn("block", block).withColumn("turn", upto("rounds"))
        ask = ask.join(parts, tree).withColumn("turn", turn).withColumn("block", upto("blocks"))
        slim = [*where, "vid", "code"]
        pieces = rows.select(*slim).groupBy(*where).cogroup(ask.select(*slim).groupBy(*where)).applyInArrow(counted, "vid long, shared array<long>")
        total = pieces.select("vid", F.posexplode("shared").alias("bits", "n")).groupBy("vid", "bits").agg(F.sum("n").alias("n"))
        at = total.join(index.select("vid", "dim"), "vid").groupBy("vid", "dim")
        reached = F.col("n") - TREES >= by_dim(enough)  # without the query itself
        stops = stored(at.agg(F.max(F.when(reached, F.col("bits"))).alias("stop")), "stops")
        short = F.col("stop").isNull() & (by_dim(cut) > 0)
        ask = ask.join(stops.filter(~short).select("vid", F.coalesce("stop", F.lit(0)).alias("stop")), "vid")
        left = rows.select(*where, "vid", "first", "code", "x").groupBy(*where)
        right = ask.select(*where, "vid", "code", "stop", "x").groupBy(*where)
        near = left.cogroup(right).applyInArrow(nearest, "qid long, vid long, score double").distinct()
        return near, stops.filter(short).select("vid")

    near, again = found_in_parts(queries, cut)
    while any(cut.values()) and not again.isEmpty():
        cut = {d: bits // 2 for d, bits in cut.items()}
        more, again = found_in_parts(again, cut)
        near = near.unionByName(more)
    listed = near.join(distinct.select("vid", "ids"), "vid").select("qid", "score", F.explode("ids").alias("vec_id"))
    # Of a vector's rows one at most is the query itself.
    first = listed.withColumn("_r", F.row_number().over(Window.partitionBy("qid").orderBy("score", "vec_id"))).filter(F.col("_r") <= k + 1)
    first = stored(first.select("qid", "score", "vec_id"), "nearest")
    paired = named.join(first, F.col("vid") == F.col("qid")).filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    out = paired.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score")
    return out.filter(F.col("rank") <= k)


by_value(sys.modules[__name__])
