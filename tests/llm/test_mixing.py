from __future__ import annotations

import re

import duckdb
import pytest
from helpers import documents
from pyspark.sql import functions as F

from rowtide.llm import mixing
from rowtide.llm.mixing import mix, mixed_documents
from rowtide.llm.oracle import ORACLE


def shares(sizes, weights=(5, 2, 1), total_share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target = set(names), {}
    total = total_share * sum(sizes.values())
    while left:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] >= most * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = most * sizes[s]
            left.discard(s)
    return target


def table(spark, *extra):
    rows = [(i, " ".join(["w"] * (i % 40)), ["b", "a", "é", None, "z"][i % 5]) for i in range(2000)]
    rows += [(i, "hot " * 3, "hot") for i in range(2000, 3500)]
    rows += [(9000, None, "empty"), (9001, " \t", "empty"), (9002, "word " * 4000, "z"), (None, "no id", "a")]
    rows += [(9100, "again again", "b"), (9100, "again again", "b")]
    return documents(spark, rows, *extra), rows


def test_targets_and_taken(spark):
    docs, rows = table(spark, "1 AS size", "2.0D AS key")
    got = mix(docs).collect()
    assert len(got) == len(rows)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = shares(sizes)
    by_size = {}
    for s, n in sizes.items():
        by_size.setdefault(n, []).append(s)
    taken = {}
    for r in got:
        assert r.source_size in by_size
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken.setdefault((r.source_size, r.target), []).append((r.size, r.taken, r.key))
    assert sorted(t for _, t in taken) == pytest.approx(sorted(want[s] for s in want))
    for (source_size, target), docs_of in taken.items():
        off = abs(sum(t for _, t, _ in docs_of) - target)
        assert off <= max(n for n, _, _ in docs_of) / 2 + 1e-6
        if source_size:  # epochs differ by one at most, and the smaller keys have more
            epochs = [(key, t // n) for n, t, key in sorted(docs_of, key=lambda x: x[2]) if n]
            assert [e for _, e in epochs] == sorted((e for _, e in epochs), reverse=True)
            assert epochs[0][1] - epochs[-1][1] <= 1


def test_reruns_agree(spark):
    docs, _ = table(spark)
    a, b = (sorted(map(str, mix(docs.repartition(n)).collect())) for n in (2, 7))
    assert a == b
    other = sorted(map(str, mix(docs, seed=1).collect()))
    assert other != a


def test_budget_that_ends_on_a_slice(spark):
    cursor = duckdb.connect()
    for n, words, share in ((2, 10, 1.5), (8, 3, 1.25), (40, 5, 1.5)):  # the budget is that of so many equal documents
        docs = documents(spark, [(i, "w " * words, "s") for i in range(n)])
        got = mix(docs, weights=(1,), total_share=share).collect()
        assert sum(r.taken for r in got) == share * n * words
        if share == 1.5:
            frame = docs.toArrow()
            cursor.register("documents", frame)
            want = cursor.execute(ORACLE["op4_source_mix"]).fetchall()
            assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got) == sorted(want)


def test_quality_weighs(spark):
    docs = documents(spark, [(i, "w w w w", "s") for i in range(4000)] + [(5000, "x " * 16000, "t")])
    got = mix(docs, weights=(1,), total_share=0.6, quality="IF(doc_id < 2000, 9.0D, 1.0D)").where("size = 4").collect()
    good = sum(r.taken for r in got if r.doc_id < 2000)
    assert good > 1.5 * sum(r.taken for r in got if r.doc_id >= 2000)


def test_documents_as_often_as_taken(spark):
    docs, _ = table(spark)
    want = {}
    for r in mix(docs).collect():
        if r.size:
            want[r.doc_id] = want.get(r.doc_id, 0) + r.epochs
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = {r.doc_id: r.n for r in mixed.where("text rlike '[^ \t]'").groupBy("doc_id").count().withColumnRenamed("count", "n").collect()}
    want.pop(9100), got.pop(9100, None)
    assert got == {i: n for i, n in want.items() if n}


def test_rows_without_or_with_repeated_ids_are_taken_by_themselves(spark):
    # nulls and repeats of equal size on all sides; the third source takes least
    rows = [(None if i % 2 else i % 5, f"{s} {i} " + "w " * 8, s) for s in ("a", "b", "c") for i in range(300)]
    sizes = {s: 300 * 10 for s in "abc"}
    want = shares(sizes)
    got = mixed_documents(documents(spark, rows)).collect()
    copies = {}
    for r in got:
        copies.setdefault(r.source, {}).setdefault(r.text, 0)
        copies[r.source][r.text] += 1
    for s in "abc":
        assert abs(sum(copies[s].values()) * 10 - want[s]) <= 5
        assert set(copies[s].values()) <= {1, 2} and (want[s] < sizes[s] or len(copies[s]) == 300)


def test_empty_table(spark):
    assert mix(documents(spark, [])).collect() == []
    assert mixed_documents(documents(spark, [])).collect() == []


@pytest.mark.parametrize("quality", [None, "0.001D", "1000D", "IF(coalesce(doc_id, 0) % 2 = 0, 0.001D, 1000D)"])
def test_slices_are_even(spark, quality):
    """Also for rows without an id, and for weights of any size."""
    rows = spark.range(40_000).selectExpr("IF(id % 2 = 0, NULL, id) AS doc_id", "concat('word ', id) AS text", "'s' AS source")
    names = ["_source", "size", "key"]
    thin = rows.selectExpr("source", *(f"{m} AS {n}" for m, n in zip(mixing._marks(quality, 0), names)))
    sliced = thin.join(mixing._cuts(thin), "_source").selectExpr(f"{mixing._SLICE} AS s", "key", "_slices")
    counts = sliced.groupBy("s").agg(F.expr("count(*) AS n"), F.expr("min(key) AS low"), F.expr("max(key) AS high"), F.expr("any_value(_slices) AS k")).orderBy("s").collect()
    assert sum(r.n for r in counts) == 40_000 and max(r.n for r in counts) < 1_500
    assert len(counts) >= 0.9 * counts[0].k
    assert all(a.high < b.low for a, b in zip(counts, counts[1:]))
