from __future__ import annotations

import numpy as np
import pytest
from helpers import find_groups

from rowtide.llm import metric_join
from rowtide.llm.metric_join import near_vectors


def expected(rows):
    def ok(v, label):
        return v is not None and label is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    valid = [(i, np.array(v, float), l) for i, v, l in rows if i is not None and ok(v, l)]
    n = {}
    links = []
    for k, (a, x, l) in enumerate(valid):
        for b, y, m in valid[:k]:
            if l == m and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links.append((a, b))
                n[a], n[b] = n.get(a, 0) + 1, n.get(b, 0) + 1
    top = find_groups({i for i, _, _ in rows if i is not None}, links)
    return {i: (n.get(i, 0), top[i], top[i] == i) for i, _, _ in rows if i is not None}


def table():
    draw = np.random.default_rng(5)
    rows = []
    for i in range(400):
        centre = np.random.default_rng(i % 30).normal(size=8)
        rows.append((1000 - i, (centre + draw.normal(size=8) * draw.choice([0.05, 0.2, 0.5])).astype("f4").tolist(), int(draw.integers(3)) if i % 17 else None))
    rows += [(2000 + i, rows[5][1], rows[5][2]) for i in range(40)]  # copies
    rows += [(2100, [2 * x for x in rows[5][1]], rows[5][2]), (2101, [0.0] * 8, 1), (2102, None, 1), (2103, [], 1)]
    rows += [(2104, [1.0, None] + [0.0] * 6, 1), (2105, [float("nan")] * 8, 1), (2106, [float("inf")] * 8, 1), (2107, [1.0], 1), (None, rows[5][1], rows[5][2])]
    return rows


@pytest.mark.parametrize("cell, block", [(1024, 2048), (20, 2048), (10, 16)])
def test_against_all_pairs(spark, monkeypatch, cell, block):
    monkeypatch.setattr(metric_join, "BLOCK_VECTORS", block)
    rows = table()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS rep", "2 AS n").repartition(4)
    got = near_vectors(df, cell_vectors=cell).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == expected(rows)
    none = next(r for r in got if r.vec_id is None)
    assert none.n_links == 0 and none.component_id is None


@pytest.mark.parametrize("cell, block", [(1024, 2048), (10, 16)])
def test_every_length_is_joined_with_its_own(spark, monkeypatch, cell, block):
    monkeypatch.setattr(metric_join, "BLOCK_VECTORS", block)
    rows = table()
    draw = np.random.default_rng(7)
    other = [(5000 + i, (np.eye(5)[i % 5] + draw.normal(size=5) * 0.15).tolist(), int(i % 2)) for i in range(120)]
    other += [(6000, [1.0, 2.0], 0), (6001, [1.0, 2.0], 0), (6002, [1.0, 2.1], 0), (6003, [1.0, 2.0], None), (6004, [2.0], 0), (6005, [3.0], 0)]
    want = expected(rows)
    n, links = {}, []
    for k, (a, x, l) in enumerate(other):
        for b, y, m in other[:k]:
            if l is not None and l == m and len(x) == len(y) and np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                links.append((a, b))
                n[a], n[b] = n.get(a, 0) + 1, n.get(b, 0) + 1
    top = find_groups([i for i, _, _ in other], links)
    want |= {i: (n.get(i, 0), top[i], top[i] == i) for i, _, _ in other}
    assert len(links) > 200 and want[6000] == (2, 6000, True)
    df = spark.createDataFrame(rows + other, "vec_id long, embedding array<float>, label int").repartition(4)
    got = near_vectors(df, cell_vectors=cell).collect()
    assert len(got) == len(rows) + len(other)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == want


def test_huge_and_tiny_numbers(spark):
    rows = [(1, [1e300, 1e300], 0), (2, [1e-300, 1e-300], 0), (3, [1.0, -1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in near_vectors(df).collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert near_vectors(df).collect() == []


def test_matrices_of_many_pivots_are_bounded(monkeypatch):
    """4,000 pivots and 3,000 vectors: 96 MB for one whole matrix, far less in pieces, and the same cells."""
    import tracemalloc

    draw = np.random.default_rng(1)
    unit = lambda n: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(draw.normal(size=(n, 16)))
    vectors, held = unit(3000), unit(4000)
    monkeypatch.setattr(metric_join, "DEALT_CELLS", 1 << 18)
    tracemalloc.start()
    sizes = [len(c) for c in metric_join._cells_of(vectors, held, 0.1)]
    assert tracemalloc.get_traced_memory()[1] < 30e6
    tracemalloc.stop()
    monkeypatch.setattr(metric_join, "DEALT_CELLS", 1 << 24)
    assert sizes == [len(c) for c in metric_join._cells_of(vectors, held, 0.1)]
