from __future__ import annotations

import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from helpers import documents

import __spark_entry__ as entry
from compare import connect
from rowtide.llm.oracle import ORACLE
from rowtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_against_sql(spark, name):
    cursor = connect(SF).execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == Counter(cursor.fetchall())


@pytest.mark.parametrize("name", ["op3_deobfuscated_toxicity", "op8_compression_quality"])
def test_folds_and_rows(spark, name):
    mod, fold, bar = (5, 0, 0.5) if "toxicity" in name else (4, 2, 0.7)
    got = QUERIES[name](spark, SF).collect()
    ids = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{SF}/documents.parquet'").fetchall()}
    assert {r.doc_id for r in got} == ids and len(got) == len(ids)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= bar)


def test_pipeline_stages(spark, tmp_path):
    """Toxic documents and copies go, clean ones stay, and what is packed is what the mix takes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = [{r.doc_id: r.text for r in docs.collect()}]
    frame = docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frame, SF)
        out.write.parquet(path := f"{tmp_path}/{i}")
        frame = spark.read.parquet(path)
        if i < 4:
            assert frame.columns == docs.columns
            kept.append({r.doc_id: r.text for r in frame.collect()})
    gone = set(kept[0]) - set(kept[1])
    clean = {i for i, y in labels.items() if y == 0}
    assert len(gone & clean) <= 0.02 * len(clean)
    assert len({" ".join(t.split()) for t in kept[2].values()}) == len(kept[2])
    packed = frame.groupBy("sequence_id").sum("length").collect()
    assert all(r[1] <= 1024 for r in packed)
    assert {r.doc_id for r in frame.select("doc_id").distinct().collect()} == set(kept[4])


def test_pipeline_runs_over_no_rows(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_pipeline_keeps_odd_rows_whole(spark, tmp_path):
    """Null and repeated ids, equal and near texts, null, empty and long texts, columns named like the operators' own and with dots."""
    plain = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    rows = [(r.doc_id, r.text, r.source) for r in plain]
    long = " ".join(f"w{k}" for k in range(30_000))
    rows += [(None, "no id but a text of its own", "a"), (None, "no id but a text of its own", "a"), (None, None, None), (90_001, None, None)]
    rows += [(90_002, "", "a"), (90_003, "", None), (90_004, "the same id with one text", "b"), (90_004, "the same id with another", "b")]
    rows += [(90_005, "repeated row", "b"), (90_005, "repeated row", "b"), (90_006, long, "b"), (90_007, long + " x", "c"), (90_008, long, "c")]
    extra = ["'mine' AS score", "1 AS _score", "2 AS `a.b`", "3 AS _source", "4 AS key", "5 AS size", "6 AS _row", "7 AS digest", "8 AS component_id", "9 AS n"]
    docs = documents(spark, rows, *extra)
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(path := f"{tmp_path}/{i}")
        docs = spark.read.parquet(path)
        kept.append(docs.collect())
    for stage in kept[:4]:
        assert {r.score for r in stage} == {"mine"} and {r["a.b"] for r in stage} == {2} and {r.n for r in stage} == {9}
    ids = [Counter(r.doc_id for r in stage) for stage in kept]
    assert ids[0][None] == 3 and ids[0][90_005] == 2 and ids[0][90_004] == 2
    # Of equal texts one row stays; a group with an id never keeps one without.
    assert ids[1][90_005] == 1 and ids[1][90_004] == 2 and 90_008 not in ids[1] and 90_001 in ids[1] and 90_002 not in ids[1]
    assert sum(r.text == "no id but a text of its own" for r in kept[1]) >= 1
    assert 90_006 in ids[2] and 90_007 not in ids[2]
    assert {r.doc_id for r in kept[4]} == set(ids[3])


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
