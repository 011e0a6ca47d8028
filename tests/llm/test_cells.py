from __future__ import annotations

import math

import numpy as np
import pytest

from siltworks.llm import cells

SCHEMA = "vec_id long, embedding array<float>, n_links string, kept string, node string"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "l", "k", "n") for i, x in rows], SCHEMA)


def usable(x):
    return x is not None and len(x) > 0 and all(c is not None and math.isfinite(c) for c in x) and any(x)


def brute(rows, cosine=0.9):
    """Per row: id, links, component."""
    x = [np.array(v, np.float32).astype(np.float64) if usable(v) else None for _, v in rows]
    x = [v / np.linalg.norm(v) if v is not None else None for v in x]
    near = [[j for j in range(len(x)) if j != i and x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]) and x[i] @ x[j] >= cosine] for i in range(len(x))]
    out = []
    for i, (key, _) in enumerate(rows):
        seen, front = {i}, [i]
        while front:
            front = [j for f in front for j in near[f] if j not in seen and not seen.add(j)]
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((key, len(near[i]), min(ids, default=key)))
    return sorted(out, key=repr)


def found(df):
    got = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr)


@pytest.mark.parametrize("dim", [3, 24])
def test_all_links(spark, dim, monkeypatch):
    """Groups near the threshold, a crowd of near copies and one of equal vectors, in cells and blocks smaller than these."""
    monkeypatch.setattr(cells, "ROWS", 60)
    monkeypatch.setattr(cells, "BLOCK", 40)
    rng = np.random.default_rng(dim)
    top = rng.normal(size=(12, dim))
    x = [*rng.normal(size=(200, dim))]
    x += [t * math.sqrt(dim) / np.linalg.norm(t) + rng.normal(size=dim) * s for t in top for s in np.linspace(0.05, 0.5, 14)]
    x += [top[0] + 0.02 * rng.normal(size=dim) for _ in range(120)] + [top[1]] * 90 + [3 * top[1]] * 5
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rng.shuffle(rows)
    exact = brute(rows)
    assert found(cells.group(frame(spark, rows), margin=cells.exact_margin())) == exact
    near = found(cells.group(frame(spark, rows)))
    assert sum(n for _, n, _ in near) >= 0.99 * sum(n for _, n, _ in exact)
    assert all(a[1] <= b[1] for a, b in zip(near, exact, strict=True))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (None, [1.0, 0.1, 0.0]), (3, [1.0, 0.6, 0.0]), (3, [0.0, 0.0, 1.0])]
    rows += [(4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]), (8, [nan, 1.0, 0.0]), (9, [inf, 0.0, 0.0]), (None, None)]
    rows += [(20, [1.0, 0.0]), (21, [5.0, 0.5]), (22, [-0.0, 1.0]), (23, [0.0, 1.0]), (24, [1e-30, 1e-30]), (25, [1e30, 1e30])]
    rows += [(40 + i, [1.0] * 300) for i in range(2)]
    assert found(cells.group(frame(spark, rows), margin=cells.exact_margin())) == brute(rows)
    assert found(cells.group(frame(spark, []))) == []
    assert found(cells.group(frame(spark, [(1, None), (1, None)]))) == [(1, 0, 1)] * 2


def test_close_members_need_no_products(spark):
    """A crowd around its centre makes as many rows of links as it has members."""
    rng = np.random.default_rng(4)
    top = rng.normal(size=32)
    rows = [(i, [float(c) for c in top + 0.05 * rng.normal(size=32)]) for i in range(400)]
    _, nodes = cells.distinct_vectors(frame(spark, rows), "vec_id", "embedding")
    centres = cells.fit_centres(nodes, 32, 400)
    members = cells.assign(nodes, centres, 0.9, 0.2)
    assert {r["part"] for r in members.select("part").distinct().collect()} == {cells.TIGHT}
    assert cells.links(members, "<f4").count() == 400


def test_forest_spans():
    rng = np.random.default_rng(8)
    for _ in range(50):
        linked = rng.random((12, 15)) < 0.12
        across, along = cells.forest(linked)
        label = {("r", i): ("r", i) for i in range(12)} | {("c", j): ("c", j) for j in range(15)}

        def top(v, label=label):
            while label[v] != v:
                v = label[v]
            return v

        for a, b in [(("r", i), ("c", j)) for i, j in across] + [(("r", i), ("r", j)) for i, j in along]:
            label[top(a)] = top(b)
        assert all(top(("r", i)) == top(("c", j)) for i, j in np.argwhere(linked).tolist())
        assert all(linked[i].any() or top(("r", i)) == ("r", i) for i in range(12))
        assert len(across) + len(along) <= 27
