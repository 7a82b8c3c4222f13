from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import documents
from tokenizers import Tokenizer

from rowtide.llm import packing
from rowtide.llm.packing import Plan, configurations, linear_groups, pack, plan_runs, public_codec

TEXTS = [
    None, "", " ", "a", "It's 12,345  words\n\n\tand ÄÖÜ — 漢字 🙂   x", "the <|endoftext|> token", "word " * 3000, "x" * 5000, "\r\n" * 3000, "é" * 2000,
    " " * 4000, "'s 'S 're don't", "the " * 1023, "the " * 1022, "the " * 2047,
]


def expected(tokenizer, text, capacity=1024):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    first = len(ids) % capacity or capacity
    starts = [0, *range(first, len(ids), capacity)]
    return [(i, a, len(part := ids[a : (starts + [len(ids)])[i + 1]]), zlib.crc32(np.array(part, "<u4").tobytes())) for i, a in enumerate(starts)]


def check_layout(rows, capacity):
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_and_layout(spark):
    tokenizer = Tokenizer.from_file(public_codec().tokenizer)
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, "no id", "s"), (3, "a", "s"), (3, "a", "s")]
    got = pack(documents(spark, rows, "1 AS piece", "2 AS sequence_id"), public_codec()).collect()
    want = Counter((i, *p) for i, t, _ in rows for p in expected(tokenizer, t))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    check_layout(got, 1024)
    assert pack(documents(spark, []), public_codec()).collect() == []


def test_without_ids_none_leave_the_tasks(spark):
    """The checksums are those of the ids, and only numbers come back from Python."""
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(TEXTS)])
    with_ids = {(r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in packing.tokenise(docs, public_codec()).collect()}
    numbers = packing.tokenise(docs, public_codec(), with_ids=False)
    assert {kind for _, kind in numbers.select("piece", "start", "length", "ids_crc32").dtypes} == {"int", "bigint"} and "ids" not in numbers.columns
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in numbers.collect()} == with_ids


def test_few_sequences(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 50)  # several slices of each length
    draw = random.Random(3)
    rows = [(i, "the " * draw.randrange(0, 400 if i % 3 else 1500), "s") for i in range(3000)]
    got = pack(documents(spark, rows), public_codec(), with_ids=False).collect()
    assert "ids" not in got[0]
    n = check_layout(got, 1024)
    assert n <= 1.01 * sum(r.length for r in got) / 1024 + 1


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_piece(seed):
    draw = random.Random(seed)
    capacity = [64, 100, 1024][seed % 3]
    lengths = [min(capacity, 1 + int(draw.expovariate(1) * capacity / 3)) for _ in range(1500)] if seed % 2 else [capacity // 2 + 1] * 77 + [1] * 5000 + [capacity] * 9
    counts = Counter(lengths)
    runs = plan_runs(counts, capacity)
    held = Counter()
    for many, items in runs:
        assert sum(items) <= capacity
        for length in items:
            held[length] += many
    assert held == counts
    plan = Plan(counts, capacity)
    for length, n in counts.items():
        sequence, offset = plan.places(np.full(n, length), np.arange(n))
        assert len(set(zip(sequence, offset))) == n
    big = sum(n for k, n in counts.items() if 2 * k > capacity)
    assert plan.sequences <= 1.05 * max(big, sum(k * n for k, n in counts.items()) / capacity) + 2


def test_groups_and_configurations():
    groups = linear_groups({9: 5, 8: 5, 7: 5, 3: 5}, 4)
    assert [(s, sum(n for _, n in h)) for s, h in groups] == [(9, 5), (8, 5), (7, 5), (3, 5)]
    assert linear_groups({10: 3, 9: 3}, 1) == [(10, [[10, 3], [9, 3]])]
    found = configurations([6, 4], [10, 10], 10)
    assert sum(use for _, use in found) == pytest.approx(10)


def test_the_plan_does_not_grow_with_the_counts():
    counts = {k: 1 + k % 7 for k in range(1, 1025)}
    small, large = plan_runs(counts, 1024), plan_runs({k: n * 1_000_000 for k, n in counts.items()}, 1024)
    assert len(large) < 4 * len(small) + 1000
