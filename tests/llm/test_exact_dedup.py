from __future__ import annotations

import hashlib
import random
import re

import pytest
from helpers import documents

from rowtide.llm.exact_dedup import build_hash, drop_copies, exact_dedup, find_slots


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(normal(t), []).append(i)
    out = []
    for i, t, _ in rows:
        ids = groups[normal(t)]
        known = [x for x in ids if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    return out


ROWS = [
    (5, "a  b", "x"), (3, "a\tb", None), (9, "a b", "x"), (7, None, "y"), (8, "", "y"), (2, " ", "y"), (None, "a\r\n b", "y"),
    (None, "only", "y"), (None, "only", "y"), (11, "w" * 300_000, "x"), (12, "w" * 300_000 + " ", "x"), (4, "a b ", "x"),
    (13, "twice", "x"), (13, "twice", "x"), (14, "a\u00a0b", "x"), (1, "Ünïcode\x0bx", "x"),
]


@pytest.mark.parametrize("history", [None, "doc_id <= 8", "FALSE", "TRUE", "doc_id % 2 = 0"])
def test_against_dictionary(spark, history):
    got = exact_dedup(documents(spark, ROWS, "'z' AS digest"), history).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected(ROWS), key=key)


def test_hot_text_and_many(spark):
    draw = random.Random(1)
    rows = [(i, "hot text" if i % 3 == 0 else f"text {draw.randrange(2500)}", "s") for i in range(6000)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(documents(spark, rows)).collect()}
    assert got == {i: (k, n, kept) for i, k, n, kept, _ in expected(rows)}


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).collect() == []
    assert drop_copies(documents(spark, [])).collect() == []


def test_drop_copies_keeps_whole_rows(spark):
    docs = documents(spark, ROWS, "doc_id AS _id")
    got = drop_copies(docs)
    assert got.columns[:5] == docs.columns[:5]
    ids = [r.doc_id for r in got.collect()]
    assert ids.count(13) == 1
    assert {i for i in ids if i is not None} == {2, 3, 4, 7, 11, 12, 13, 14, 1}


def test_hash_is_perfect_and_refuses_others():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    sizes, bits, slots = build_hash(digests)
    assert sorted(slots) == list(range(5000))
    assert list(find_slots(sizes, bits, digests)) == list(slots)
    others = find_slots(sizes, bits, [hashlib.sha256(b"x%d" % i).digest() for i in range(1000)])
    assert others.max() < 5000 and (others >= 0).any()  # they do point at slots, which hold other digests
    assert build_hash([])[0] == []
