from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import documents

from rowtide.llm.repeats import remove_repeats, spans


def expected(rows, length):
    """Every string looked up in a set, in the order of the ids."""
    seen, out = set(), {}
    for i, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1):
            string = data[s : s + length]
            if string in seen:
                covered[s : s + length] = b"\1" * length
            seen.add(string)
        starts = [k for k in range(len(data)) if covered[k] and (k == 0 or not covered[k - 1])]
        out[i] = (len(data), sum(covered), len(starts), bytes(x for x, c in zip(data, covered) if not c))
    return out


def result(docs, length):
    rows = remove_repeats(docs, length).collect()
    return [(r.doc_id, (r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed), bytes(r.kept))) for r in rows]


def passages(draw):
    words = ["alpha", "bet", "gam", "dé", "zz", "長い"]
    rows = [(i, " ".join(draw.choices(words, k=draw.randrange(150))), "s") for i in range(25)]
    shared = " ".join(draw.choices(words, k=90))
    noise = lambda: "".join(draw.choices("abc ", k=draw.randrange(120)))
    for i in range(25, 60):
        edited = list(shared)
        for _ in range(draw.randrange(3)):
            edited[draw.randrange(len(edited))] = "#"
        rows.append((i, noise() + "".join(edited) + noise(), "s"))
    odd = [None, "", "a" * 900, "ab" * 600 + "c" * 250, "a" * 450, rows[3][1], "x" * 99, "x" * 100, "x" * 100, "x" * 101]
    return rows + [(60 + k, text, None) for k, text in enumerate(odd)]


@pytest.mark.parametrize("length", [64, 100, 130])
def test_against_a_set_of_all_strings(spark, length):
    rows = passages(random.Random(length))
    assert dict(result(documents(spark, rows, "'z' AS data", "1 AS doc", "2 AS pair"), length)) == expected(rows, length)


def test_parts_that_cut_groups(spark):
    """Many parts: equal pairs and equal spans lie on both sides of the ends of parts."""
    rows = [(i, "the hot line " * 12 + str(i % 3) * 70 + "and its end " * 9, "s") for i in range(80)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert dict(result(documents(spark, rows), 100)) == expected(rows, 100)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repeated_and_missing_ids(spark):
    text = "".join(random.Random(5).choices("abcdefgh ", k=300))
    rows = [(7, text, "s"), (7, text, "s"), (None, text, "s"), (None, "y" + text, "s"), (3, text[:150], "s"), (None, None, "s")]
    got = result(documents(spark, rows), 100)
    assert sorted((x[1], x[0] is None) for i, x in [(i, (i, r[1])) for i, r in got]) == [
        (0, False), (0, True), (150, False), (300, False), (300, True), (300, True)
    ]


def test_empty_table(spark):
    assert result(documents(spark, []), 100) == []


def test_long_text_in_pieces(spark, monkeypatch):
    import rowtide.llm.repeats as module

    monkeypatch.setattr(module, "PIECE", 256)
    draw = random.Random(9)
    text = "".join(draw.choices("abcd", k=3000))
    data = np.frombuffer((text + text[500:1700]).encode(), dtype=np.uint8)
    texts = __import__("pyarrow").array([data.tobytes()])
    found = [x for _, begin, piece in module._pieces(texts, None, 100) for x in zip(*spans(piece, np.array([len(piece)]), 100, 100))]
    assert len(found) == len(data) - 99
    assert len({(int(p), int(s)) for _, _, p, s in found}) == 3000 - 99 + 99


def test_short_strings_are_refused(spark):
    with pytest.raises(ValueError):
        remove_repeats(documents(spark, []), 32)
