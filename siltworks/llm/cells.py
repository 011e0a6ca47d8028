"""Near duplicates of vectors: cells by spherical k-means, blocked cosine products within cells, one row of each group kept.

Equal vectors are one node that counts its rows, so a vector that makes up a third of all rows costs no more than any other. Centres
are fitted by ``ROUNDS`` of spherical k-means, as Spark jobs over a sample of about ``SAMPLE`` distinct vectors by hash, one per
``ROWS`` nodes and ``MOST_CELLS`` at most. Every vector then has its home in the cell of the nearest centre. A pair that a boundary parts
is met because a vector is also a guest of each cell of a smaller number that lies behind a boundary within ``margin``. The distance
of two vectors of cosine 0.9 is 0.447; of that, the part that runs across a given boundary has in d dimensions a standard deviation
of 0.447 / sqrt(d - 1), and the margin is ``SIGMAS`` of these: about one pair in a thousand at the very threshold may be missed if a
boundary parts it, and none with ``margin=exact_margin()``, since no vector farther from a boundary is similar to one behind it, for any data.

Members within half the angle of the threshold of their centre are all linked with each other by the triangle inequality. They are
counted and tied to one of them without products, so a large group of near copies stays linear. All other pairs of a cell
are multiplied in blocks of ``BLOCK`` by ``BLOCK`` rows, in double precision, as many tasks as a cell needs; a block gives back one
count per row and a spanning forest of its links, never the pairs. Components of the forests are found on tables in the shared folder.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component link with nothing; vectors of
different lengths never link; repeated rows link with each other; rows without a key count as links and pass on components but name none;
a component's id is its smallest key; an empty table gives an empty result; other columns are ignored. Starts jobs; tables
are written to the shared folder.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.ann import usable
from siltworks.llm.near_dup import components
from siltworks.llm.words import by_value
from siltworks.session import stored

COSINE = 0.9
SAMPLE, ROUNDS = 65_536, 6
ROWS, MOST_CELLS = 2_048, 4_096
BLOCK = 2_048
SIGMAS = 3.0
#: Rows multiplied with all centres at once.
CHUNK = 1_024
#: Vectors of other lengths than the commonest share so many cells of their own.
OTHER_CELLS = 256
#: A vector with more than one in so many of all rows is joined with its rows in ``SALTS`` parts.
HOT, SALTS = 1_000, 64
_EPS = 1e-9

#: Parts that a member plays in a cell: at home, at home near the centre, guest that may reach those near it, other guest.
LOOSE, TIGHT, NEAR, FAR = range(4)


def exact_margin(cosine: float = COSINE) -> float:
    """The distance from a boundary at which no pair of this cosine has it between them: the sine of the angle."""
    return math.sqrt(1 - cosine * cosine) + _EPS


def unit(blobs: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length as rows of length 1 in double precision."""
    x = np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distinct_vectors(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """The rows as ``_key, _v``, and the distinct vectors as ``node, first, n, dim, x`` (the bytes) and ``_v``."""
    element = df.schema[vector].dataType.elementType.simpleString()
    element = element if element in ("float", "double") else "double"
    plain = F.transform(F.col(vector), lambda x: x.cast(element) + F.lit(0).cast(element))  # there is one zero
    rows = df.select(F.col(key).alias("_key"), F.when(usable(vector), plain).alias("_v"))
    counted = rows.filter("_v is not null").groupBy("_v").agg(F.min("_key").alias("first"), F.count("*").alias("n"))
    numbered = counted.select(F.monotonically_increasing_id().alias("node"), "first", "n", F.size("_v").alias("dim"), "_v")
    return rows, stored(numbered, "vectors")


def kind_of(nodes: DataFrame) -> str:
    return "<f4" if nodes.schema["_v"].dataType.elementType.simpleString() == "float" else "<f8"


def _blobs(nodes: DataFrame, *columns: str) -> DataFrame:
    """The columns and ``x``, the vectors as bytes."""
    kind = kind_of(nodes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(columns))
            flat, ends = np.asarray(lists.flatten()), np.cumsum(np.asarray(lists.value_lengths()))
            parts = np.split(flat.astype(kind, copy=False), ends[:-1]) if len(ends) else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([p.tobytes() for p in parts], pa.binary())], [*columns, "x"])

    read = nodes.select(*columns, "_v")
    schema = ", ".join(f"{c} {read.schema[c].dataType.simpleString()}" for c in columns)
    return read.mapInArrow(task, f"{schema}, x binary")


def fit_centres(nodes: DataFrame, dim: int, n: int, sample: int = SAMPLE, rounds: int = ROUNDS, rows: int = ROWS) -> np.ndarray:
    """Unit centres of spherical k-means over about ``sample`` of the ``n`` vectors of this length, chosen by hash."""
    k = max(1, min(MOST_CELLS, math.ceil(n / rows)))
    place = F.pmod(F.xxhash64("_v"), F.lit(1 << 40))
    chosen = nodes.filter((F.col("dim") == dim) & (place <= int((1 << 40) * min(1.0, sample / n)))).withColumn("place", place)
    kind = kind_of(nodes)
    chosen = stored(_blobs(chosen, "place", "node"), "sample")
    first = chosen.orderBy("place", "node").limit(k).collect()
    if not first:  # so few that the hash chose none
        first = _blobs(nodes.filter(F.col("dim") == dim).limit(1).withColumn("place", F.lit(0)), "place", "node").collect()
    centres = unit([bytes(r["x"]) for r in first], kind)
    context = nodes.sparkSession.sparkContext
    for _ in range(rounds if len(centres) > 1 else 0):
        held = context.broadcast(centres)

        def sums(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(held.value)
            for batch in batches:
                blobs = batch.column(0).to_pylist()
                for at in range(0, len(blobs), CHUNK):
                    x = unit(blobs[at : at + CHUNK], kind)
                    np.add.at(total, (x @ held.value.T).argmax(axis=1), x)
            used = np.flatnonzero(np.abs(total).sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([total[c].tobytes() for c in used], pa.binary())], ["cell", "total"])

        def added(group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_py(), np.float64) for x in group.column(1))
            return pa.table({"cell": group.column(0).slice(0, 1), "total": pa.array([total.tobytes()], pa.binary())})

        parts = chosen.select("x").mapInArrow(sums, "cell long, total binary")
        moved = centres.copy()
        for r in parts.groupBy("cell").applyInArrow(added, "cell long, total binary").collect():
            total = np.frombuffer(r["total"], np.float64)
            length = np.sqrt(total @ total)
            if length > _EPS:
                moved[r["cell"]] = np.round(total / length, 7)  # sums differ in their last bits by order
        centres = moved / np.sqrt((moved * moved).sum(axis=1, keepdims=True))
        held.unpersist()
    return centres


def assign(nodes: DataFrame, centres: np.ndarray, cosine: float, margin: float) -> DataFrame:
    """``cell, node, n, part, x``: each vector in its home and as a guest of the cells within the margin."""
    held = nodes.sparkSession.sparkContext.broadcast(centres)
    angle = math.acos(cosine)
    tight = math.cos(angle / 2) + _EPS
    near = math.cos(min(1.5 * angle, math.pi)) - _EPS
    blobs, kind = _blobs(nodes, "node", "n", "dim"), kind_of(nodes)

    def places(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, cell and part of each membership."""
        s = x @ held.value.T
        home = s.argmax(axis=1)
        own = s[np.arange(len(x)), home]
        apart = np.sqrt(np.maximum(2 - 2 * (held.value[home] @ held.value.T), 0))
        behind = (own[:, None] - s <= margin * apart + _EPS) & (np.arange(s.shape[1]) < home[:, None])
        row, cell = np.nonzero(behind)
        part = np.where(s[row, cell] >= near, NEAR, FAR)
        at_home = np.where(own >= tight, TIGHT, LOOSE)
        return np.concatenate([np.arange(len(x)), row]), np.concatenate([home, cell]), np.concatenate([at_home, part])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                dims = batch.column(2).to_numpy()
                other = np.flatnonzero(dims != held.value.shape[1])
                own = np.flatnonzero(dims == held.value.shape[1])
                row, cell, part = other, -1 - dims[other] % OTHER_CELLS, np.full(len(other), LOOSE)
                if len(own):
                    r, c, p = places(unit(batch.column(3).take(pa.array(own)).to_pylist(), kind))
                    row, cell, part = np.concatenate([row, own[r]]), np.concatenate([cell, c]), np.concatenate([part, p])
                taken = batch.take(pa.array(row))
                columns = [pa.array(cell, pa.int32()), taken.column(0), taken.column(1), pa.array(part, pa.int8()), taken.column(3)]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "node", "n", "part", "x"])

    return stored(blobs.mapInArrow(task, "cell int, node long, n long, part tinyint, x binary"), "cells")


def forest(linked: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Pairs that span the components of a matrix of links: (row, column), and (row, row)."""
    across, along = [], []
    rows_left, columns_left = linked.any(axis=1), linked.any(axis=0)
    for top in np.flatnonzero(rows_left).tolist():
        if not rows_left[top]:
            continue
        rows_left[top], front = False, np.array([top])
        while len(front):
            columns = np.flatnonzero(linked[front].any(axis=0) & columns_left)
            columns_left[columns] = False
            across += [(top, c) for c in columns.tolist()]
            front = np.flatnonzero(linked[:, columns].any(axis=1) & rows_left)
            rows_left[front] = False
            along += [(top, r) for r in front.tolist()]
    return across, along


def block_links(left: tuple, right: tuple, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From ``node, n, part, unit vectors`` of a block's rows and columns: nodes, links each gains, and pairs that span them."""
    (a, n_a, part_a, x), (b, n_b, part_b, y) = left, right
    linked = x @ y.T >= cosine
    # Two members that both are loose meet twice. A guest only meets what is near the centre; guests meet elsewhere.
    loose, tight = part_b == LOOSE, part_b == TIGHT
    linked &= np.where((part_a == LOOSE)[:, None], ~loose | (a[:, None] < b), tight)
    nodes, gained = np.concatenate([a, b]), np.concatenate([linked @ n_b, n_a @ linked])
    across, along = forest(linked)
    pairs = [(a[i], b[j]) for i, j in across] + [(a[i], a[j]) for i, j in along]
    some = gained > 0
    return nodes[some], gained[some], np.array(pairs, np.int64).reshape(-1, 2)


def links(members: DataFrame, kind: str, cosine: float = COSINE) -> DataFrame:
    """Links as ``a, b, gained``: what a node gains in one block (b is null), and pairs that span the blocks' links."""
    mark = lambda *parts: F.col("part").isin(*parts)
    sizes = members.groupBy("cell").agg(
        F.count_if(mark(LOOSE)).alias("_loose"),
        F.count_if(mark(NEAR)).alias("_near"),
        F.count("*").alias("_all"),
        F.sum(F.when(mark(TIGHT), F.col("n"))).alias("_tight"),
        F.min(F.when(mark(TIGHT), F.col("node"))).alias("_top"),
    )
    # At most MOST_CELLS and OTHER_CELLS rows.
    placed = members.join(F.broadcast(sizes), "cell")
    lefts = F.col("_loose") + F.when(F.col("_top").isNotNull(), F.col("_near")).otherwise(0)
    blocks, slots = F.ceil(lefts / BLOCK).cast("int"), F.ceil(F.col("_all") / BLOCK).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    is_left = mark(LOOSE) | (mark(NEAR) & F.col("_top").isNotNull())
    left = placed.filter(is_left).select("cell", F.pmod(F.hash("node"), blocks).alias("block"), numbers(slots).alias("slot"), F.lit(0).alias("turn"), "node", "n", "part", "x")
    right = placed.filter(lefts > 0).select("cell", numbers(blocks).alias("block"), F.pmod(F.hash(F.lit(1), "node"), slots).alias("slot"), F.lit(1).alias("turn"), "node", "n", "part", "x")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit_of, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held)
            turn, node, n, part = (whole.column(c).to_numpy() for c in ("turn", "node", "n", "part"))
            blobs = whole.column("x").to_pylist()
            lengths = np.array([len(x) for x in blobs])
            for length in np.unique(lengths):
                sides = [np.flatnonzero((lengths == length) & (turn == t)) for t in (0, 1)]
                if not min(map(len, sides)):
                    continue
                both = [(node[s], n[s], part[s], unit([blobs[i] for i in s], kind)) for s in sides]
                nodes, gained, pairs = block_links(*both, cosine)
                a = np.concatenate([nodes, pairs[:, 0]])
                b = pa.concat_arrays([pa.nulls(len(nodes), pa.int64()), pa.array(pairs[:, 1])])
                yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(np.concatenate([gained, np.zeros(len(pairs), np.int64)]))], ["a", "b", "gained"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if begin == end:
                    continue
                now = tuple(keys[:, begin])
                if held and now != unit_of:
                    yield from done()
                    held = []
                unit_of = now
                held.append(batch.slice(begin, end - begin))
        if held:
            yield from done()

    dealt = left.unionByName(right).repartition("cell", "block", "slot").sortWithinPartitions("cell", "block", "slot", "turn")
    met = dealt.mapInArrow(task, "a long, b long, gained long")
    # Those near their centre are linked with each other.
    close = placed.filter(mark(TIGHT)).select("node", "_top", (F.col("_tight") - F.col("n")).alias("gained")).filter("gained > 0")
    close = close.select(F.col("node").alias("a"), F.when(F.col("node") != F.col("_top"), F.col("_top")).alias("b"), "gained")
    return stored(met.unionByName(close), "links")


def group(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    margin: float | None = None,
) -> DataFrame:
    """One row per input row: ``key``, ``n_links``, ``component_id`` and ``kept`` (the key is the component's)."""
    rows, nodes = distinct_vectors(df, key, vector)
    common = nodes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        alone = F.lit(0).cast("long").alias("n_links")
        return rows.select(F.col("_key").alias(key), alone, F.col("_key").alias("component_id"), F.lit(True).alias("kept"))
    dim, n = common
    if margin is None:
        margin = min(SIGMAS * math.sqrt(2 - 2 * cosine) / math.sqrt(max(dim - 1, 1)), exact_margin(cosine))
    members = assign(nodes, fit_centres(nodes, dim, n), cosine, margin)
    found = links(members, kind_of(nodes), cosine)
    gained = found.groupBy(F.col("a").alias("node")).agg(F.sum("gained").alias("gained"))
    roots = stored(components(found.filter("b is not null").select("a", "b")), "roots")
    named = nodes.select("node", "first").join(roots, "node")
    smallest = named.groupBy("root").agg(F.min("first").alias("_least"))
    judged = nodes.select("node", "first", "n", "_v").join(gained, "node", "left").join(roots, "node", "left").join(smallest, "root", "left")
    links_of = F.col("n") - 1 + F.coalesce("gained", F.lit(0))
    judged = judged.select("_v", "n", links_of.alias("n_links"), F.coalesce("_least", "first").alias("component_id"))
    judged = stored(judged, "judged")
    out = _rejoined(rows, judged)
    component = F.coalesce("component_id", "_key")
    return out.select(
        F.col("_key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("_key").eqNullSafe(component).alias("kept"),
    )


def _rejoined(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """Rows with what was found of their vector; rows of a very common one are spread."""
    judged = judged.withColumn("_h", F.xxhash64("_v"))
    total = judged.agg(F.sum("n")).first()[0]
    hot = judged.filter(F.col("n") * HOT > total).select(F.col("_h").alias("_hot")).distinct()  # at most HOT rows
    rows = rows.withColumn("_h", F.xxhash64("_v")).join(F.broadcast(hot), F.col("_h") == F.col("_hot"), "left")
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64("_key"), F.lit(SALTS))).otherwise(0)
    rows = rows.withColumn("_salt", salt.cast("int")).drop("_hot")
    salts = F.when(F.col("n") * HOT > total, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return rows.join(judged.withColumn("_salt", F.explode(salts)).drop("n"), ["_h", "_salt", "_v"], "left")


by_value(sys.modules[__name__])
