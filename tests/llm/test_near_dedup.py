from __future__ import annotations

import random

import pytest
from helpers import documents, find_groups

import rowtide.llm.near_dedup as module
from rowtide.llm.components import components
from rowtide.llm.near_dedup import drop_near, near_groups, shingle_hashes


def shingles(text, words):
    parts = (text or "").encode().lower().split()
    return {tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def expected(rows, words):
    sets = [(i, shingles(t, words)) for i, t, _ in rows]
    known = [(i, s) for i, s in sets if i is not None and s]
    links = [
        (a, b) for k, (a, x) in enumerate(known) for b, y in known[:k]
        if 80 * max(len(x), len(y)) <= 100 * min(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y)
    ]
    return sets, find_groups({i for i, _ in sets if i is not None}, links)


def mutated(draw, words, share):
    return " ".join(f"m{draw.randrange(10**6)}" if draw.random() < share else w for w in words)


def table(seed=4, n=150):
    draw = random.Random(seed)
    rows, i = [], 0
    for g in range(12):
        base = [f"w{draw.randrange(3000)}" for _ in range(draw.randrange(4, 200))]
        for _ in range(n // 12):
            rows.append((i, mutated(draw, base, draw.choice([0, 0.01, 0.04, 0.06, 0.1])), "s"))
            i += 1
    passage = " ".join(f"p{k}" for k in range(40))
    rows += [(i + k, passage + " " + " ".join(f"q{draw.randrange(10**6)}" for _ in range(draw.randrange(4, 14))), "s") for k in range(60)]
    i += 60
    chain = [f"c{k}" for k in range(60)]
    for k in range(20):  # each is near the one before it, the ends aren't alike
        rows.append((i + k, " ".join(chain[2 * k : 2 * k + 40] + [f"d{x}" for x in range(k * 2)][:0]), "s"))
    return rows


@pytest.mark.parametrize("words", [2, 5])
def test_against_all_pairs(spark, words):
    rows = table()
    sets, top = expected(rows, words)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_groups(documents(spark, rows, "1 AS n", "2 AS bands"), words).collect()}
    assert got == {i: (len(s), top[i], top[i] == i) for i, s in sets}


def test_large_buckets_go_by_rounds(spark, monkeypatch):
    monkeypatch.setattr(module, "GROUP_MEMBERS", 4)
    rows = table(5)
    sets, top = expected(rows, 2)
    got = {r.doc_id: r.component_id for r in near_groups(documents(spark, rows), 2).collect()}
    assert got == {i: top[i] for i, _ in sets}


def test_hot_id_and_hot_text(spark):
    """A third of the rows bear one id, with one text or one of two; a third are copies with ids of their own."""
    base = [f"w{k}" for k in range(40)]
    rows = [(5, " ".join(base), "s")] * 150 + [(5, "another text", "s")] * 50 + [(100 + k, " ".join(base + ["x"]), "s") for k in range(200)]
    rows += [(1000 + k, f"single {k} " + "y " * k, "s") for k in range(200)] + [(4, "another  text", "s")]
    got = near_groups(documents(spark, rows), 2).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id < 400} == {(4, 4), (5, 4)} | {(100 + k, 4) for k in range(200)}


def test_edges(spark):
    base = " ".join(f"w{i}" for i in range(50))
    rows = [
        (7, base, "s"), (3, base.upper(), "s"), (9, base + " x", "s"), (None, base, "s"), (20, None, "s"), (21, "", "s"), (22, " \t", "s"),
        (23, "one", "s"), (24, "ONE", "s"), (25, "one two three", "s"), (None, "alone here", "s"), (30, "b " * 100_000, "s"),
        (31, "b", "s"), (40, "other text of its own", "s"), (40, base, "s"), (41, "other text  of its own", "s"),
    ]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_groups(documents(spark, rows), 2).collect()), key=str)
    # 40 has two texts, so it ties both groups together
    want = [
        (7, 3, False), (3, 3, True), (9, 3, False), (None, 3, False), (20, 20, True), (21, 21, True), (22, 22, True), (23, 23, True),
        (24, 23, False), (25, 25, True), (None, None, True), (30, 30, True), (31, 31, True), (40, 3, False), (40, 3, False), (41, 3, False),
    ]
    assert got == sorted(want, key=str)
    assert near_groups(documents(spark, []), 2).collect() == []
    assert drop_near(documents(spark, [])).collect() == []


def test_no_bucket_with_several(spark):
    rows = [(i, " ".join(f"u{i}_{k}" for k in range(20)), "s") for i in range(20)]
    assert all(r.kept for r in near_groups(documents(spark, rows)).collect())


def test_drop_near_keeps_one_of_each_group(spark):
    rows = table(8, 60)
    _, top = expected(rows, 5)
    got = drop_near(documents(spark, rows, "1 AS id", "2 AS component_id"))
    assert {r.doc_id for r in got.collect()} == {i for i, t in top.items() if i == t}
    assert got.columns[-2:] == ["id", "component_id"]


def test_words():
    assert len(shingle_hashes("A b\x0bC d", 2)) == 2
    assert (shingle_hashes("A B c", 2) == shingle_hashes("a  b\tC", 2)).all()
    assert (shingle_hashes("a", 2) == shingle_hashes("A", 2)).all() and len(shingle_hashes("É é", 2)) == 1
    with pytest.raises(ValueError):
        near_groups(None, 2, 79)


def test_components(spark):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(300)] + [(1000 + draw.randrange(400), 1000 + draw.randrange(400)) for _ in range(250)]
    links += [(5000, 6000 + i) for i in range(500)] + [(9, 9), (7000, 7000)]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    df = spark.createDataFrame([*links, (None, 3), (links[0][1], links[0][0])], "a long, b long")
    got = [tuple(r) for r in components(df).collect()]
    assert len(got) == len(nodes) and dict(got) == find_groups(nodes, [x for x in links if x[0] != x[1]])
    assert components(df.limit(0)).collect() == []
