from __future__ import annotations

import hashlib
import random

import pytest
from helpers import documents

from rowtide.llm.common import keep
from rowtide.llm.manifest import FANOUT, build_manifest, folded, leaf_digest, prove, siblings_digest, verify_rows

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + FANOUT]) for i in range(0, len(out[-1]), FANOUT)])
    return out


def climb(tree, at):
    """Siblings and sides of each level from a leaf up."""
    for level in tree[:-1]:
        begin = at // FANOUT * FANOUT
        yield level[begin:at], level[at + 1 : begin + FANOUT]
        at //= FANOUT


def expected(rows, claim):
    """rows: dicts with COLUMNS. Multiset of results, from plain lists."""
    groups = {}
    for r in rows:
        leaf, claimed = leaf_of([r[c] for c in COLUMNS]), leaf_of([claim(r)[c] for c in COLUMNS])
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, claimed, r["doc_id"]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for t, g in enumerate(names):
        for at, (_, _, leaf, claimed, doc_id) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            value, proof = claimed, ""
            for before, after in [*climb(trees[g], at), *climb(top, t)]:
                value, proof = h(*before, value, *after), proof + "".join(before + after)
            out.append((doc_id, leaf, trees[g][-1][0], top[-1][0], h(proof), value, value == top[-1][0]))
    return sorted(out, key=str)


def result(docs, claimed):
    rows = verify_rows(docs, COLUMNS, claimed)
    return sorted(map(tuple, rows.select("doc_id", "leaf", "subroot", "root", siblings_of(), "folded_root", "verified").collect()), key=str)


def siblings_of():
    from pyspark.sql import functions as F

    return F.expr(f"{siblings_digest()} AS proof_sha256")


def table_of(spark, rows, langs):
    df = documents(spark, [(i, t, s) for i, t, s in rows]).drop("lang")
    cases = " ".join(f"WHEN {i} THEN {'NULL' if g is None else repr(g)}" for (i, _, _), g in zip(rows, langs) if i is not None)
    return df.selectExpr("*", f"CASE doc_id {cases} ELSE 'xx' END AS lang", "'mine' AS leaf", "7 AS tree", "8 AS at", "9 AS path")


@pytest.mark.parametrize("n", [1, 8, 65, 600])
def test_against_lists(spark, n):
    draw = random.Random(n)
    rows = [(i, draw.choice(["Ab", "é Ü", "", None, "long " * 50]), draw.choice(["s", None, ""])) for i in draw.sample(range(10 * n), n)]
    langs = [draw.choice(["en", "en", "en", "de", None, "", "fr"]) for _ in rows]
    docs = table_of(spark, rows, langs)
    plain = [r.asDict() for r in docs.select(*COLUMNS).collect()]
    assert result(docs, {"text": "IF(doc_id % 3 = 0, translate(text, 'ABU', 'abu'), text)"}) == expected(
        plain, lambda r: {**r, "text": r["text"].translate(str.maketrans("ABU", "abu")) if r["text"] and r["doc_id"] % 3 == 0 else r["text"]}
    )
    assert result(docs, None) == expected(plain, lambda r: r)


def test_many_trees(spark):
    """More trees than a node has children, some of one leaf."""
    rows = [(i, f"t{i}", "s") for i in range(150)]
    docs = table_of(spark, rows, [f"g{i % 70}" for i in range(150)])
    plain = [r.asDict() for r in docs.select(*COLUMNS).collect()]
    assert result(docs, None) == expected(plain, lambda r: r)


def test_repeated_rows_and_missing_ids(spark):
    rows = [(None, "same", "s")] * 40 + [(4, "same", "s")] * 20 + [(4, "other", None), (5, None, None)]
    docs = documents(spark, rows)
    plain = [r.asDict() for r in docs.select(*COLUMNS).collect()]
    got = result(docs, None)
    assert got == expected(plain, lambda r: r) and all(r[-1] for r in got)


def test_empty_table(spark):
    assert verify_rows(documents(spark, []), COLUMNS).collect() == []


def test_descent_of_few_requests(spark):
    docs = documents(spark, [(i, f"text {i}", "s") for i in range(300)])
    rows = keep(docs.selectExpr("doc_id", "lang", f"{leaf_digest(COLUMNS)} AS leaf"))
    manifest = build_manifest(rows)
    asked = spark.createDataFrame([(0, 5, "a"), (0, 299, "b"), (0, 300, "none"), (1, 0, "none")], "tree long, at long, who string")
    got = prove(manifest, asked).selectExpr("who", "at", "leaf", f"{folded('leaf')} AS root", "size(path) AS n").collect()
    tree = levels([r.leaf.hex() for r in rows.orderBy("doc_id").collect()])
    assert sorted((r.who, r.at, r.leaf.hex(), r.n) for r in got) == [("a", 5, tree[0][5], 3), ("b", 299, tree[0][299], 3)]
    assert {r.root for r in got} == {manifest.root.hex()} == {tree[-1][0]}
    stored = {r.digest.hex(): [c.hex() for c in r.children] for r in manifest.store().collect()}
    assert all(h(*children) == digest for digest, children in stored.items()) and len(stored) == 38 + 5 + 1
