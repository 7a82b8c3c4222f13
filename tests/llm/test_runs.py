from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import documents

import rowtide.llm.runs as module
from rowtide.llm.runs import COVER, Extensions, periodic_runs


def slow_runs(words):
    """Every period, every stretch of words that equal the word a period further on."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(12, 2 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def slow_collapse(words, runs):
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def texts(draw, n):
    out = []
    for _ in range(n):
        words = draw.choices("a b c d e f é 長い".split(), k=draw.randrange(60))
        for _ in range(draw.randrange(3)):
            piece = draw.choices("a b c".split(), k=draw.randrange(1, 9))
            at = draw.randrange(len(words) + 1)
            words[at:at] = piece * draw.randrange(2, 9) + piece[: draw.randrange(len(piece) + 1)]
        out.append(draw.choice([" ", "\t", " \n", "\x0b\x0c"]).join(words))
    return out


def check(spark, rows):
    got = periodic_runs(documents(spark, rows, "'x' AS runs", "1 AS n_words", "2 AS _r")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text, _ in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = slow_runs(words)
        assert by_id[i].n_words == len(words)
        assert [tuple(r) for r in by_id[i].runs] == runs
        assert by_id[i].collapsed == slow_collapse(words, runs)


@pytest.mark.parametrize("group, points", [(1 << 18, 1 << 20), (40, 25)])
def test_against_all_periods(spark, group, points, monkeypatch):
    monkeypatch.setattr(module, "GROUP_WORDS", group)  # in this process only; workers keep theirs
    monkeypatch.setattr(module, "GRID_POINTS", points)
    odd = [None, "", "  ", "a", "a " * 11, "a " * 12, "a " * 400, "a b " * 6, "a a " * 12, "a b c d e f g " * 2, "é " * 30 + "x"]
    draw = random.Random(group)
    rows = [(i, t, "s") for i, t in enumerate(odd + texts(draw, 150))]
    check(spark, rows)
    for start in range(0, len(rows), 9):
        some = [(t or "").encode().split() for _, t, _ in rows[start : start + 9]]
        for found, words in zip(module._runs_of(some).to_pylist(), some):
            assert [(r["start"], r["length"], r["period"]) for r in found["runs"]] == slow_runs(words)


def test_long_text(spark):
    draw = random.Random(2)
    words = draw.choices([f"w{k}" for k in range(300)], k=4000)
    words[700:2100] = (words[700:1230] * 3)[:1400]
    words[3000:3500] = ["z"] * 500
    check(spark, [(1, " ".join(words), "s"), (2, "q " * 3000, "s")])


@pytest.mark.parametrize("letters", [1, 2, 30])
def test_extensions(letters):
    draw = np.random.Generator(np.random.PCG64(letters))
    words = np.r_[draw.integers(0, letters, 300), letters + np.arange(COVER)]
    i, j = np.triu_indices(300, 1)
    plain = [next(k for k in range(400) if words[a + k] != words[b + k]) for a, b in zip(i, j)]
    assert Extensions(words).between(i, j).tolist() == plain
    assert Extensions(words).between(j, i).tolist() == plain


def test_empty_table(spark):
    assert periodic_runs(documents(spark, [])).collect() == []


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a " * 20, "s"), (1, "a " * 20, "s"), (None, "b " * 12, None), (None, None, None)]
    got = periodic_runs(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), [tuple(x) for x in r.runs], r.collapsed) for r in got) == [
        ("1", [(0, 20, 1)], "a"), ("1", [(0, 20, 1)], "a"), ("None", [], ""), ("None", [(0, 12, 1)], "b"),
    ]
