from __future__ import annotations

import random

from helpers import documents

from rowtide.llm.quality import fit_quality, score_quality


def corpus(n=400):
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randrange(2, 8))) for _ in range(800)]
    rows, labels = [], []
    for i in range(n):
        text = " ".join(draw.choice(words) for _ in range(draw.randrange(20, 120)))
        bad = i % 4 == 0
        rows.append((i, " ".join(f"{w.upper()}!!" for w in text.split()) if bad else text, "s"))
        labels.append((i, int(not bad)))
    return rows, labels


def test_held_out_and_edges(spark):
    rows, labels = corpus()
    more = [(1000, None, "s"), (1001, "", "s"), (1002, "the quick " * 40_000, "s"), (None, rows[1][1], "s"), (5, rows[5][1], "s")]
    docs = documents(spark, rows + more, "1 AS score", "'x' AS quality")
    table = spark.createDataFrame(labels + [(1, None), (None, 1), (7777, 0)], "doc_id long, quality int")
    got = score_quality(docs, fit_quality(docs, table, "doc_id % 5 <> 0")).collect()
    assert len(got) == len(rows) + len(more) and all(0 <= r.score <= 1 for r in got)
    of = {r.doc_id: r.score for r in got}
    held = [(of[i], y) for i, y in labels if i % 5 == 0]
    assert sum((s >= 0.7) == (y == 1) for s, y in held) >= 0.97 * len(held)
    assert of[1000] == of[1001]
    assert of[None] == of[1]


def test_labels_of_the_other_fold_do_not_matter(spark):
    rows, labels = corpus(120)
    docs = documents(spark, rows)
    flipped = [(i, 1 - y if i % 5 == 0 else y) for i, y in labels]
    a, b = (fit_quality(docs, spark.createDataFrame(x, "doc_id long, quality int"), "doc_id % 5 <> 0") for x in (labels, flipped))
    assert (a.good, a.bad, a.weights, a.prior) == (b.good, b.bad, b.weights, b.prior)


def test_one_label_or_none(spark):
    docs = documents(spark, [(1, "text", "s"), (2, None, "s")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in score_quality(docs, fit_quality(docs, none)).collect()] == [0.5, 0.5]
    assert score_quality(docs.limit(0), fit_quality(docs.limit(0), none)).collect() == []


def test_long_labelled_texts_teach(spark):
    """Where all labelled texts are long, passages of them fit the model."""
    rows, _ = corpus(80)
    rows = [(i, (t + " ") * (1 + 70_000 // len(t)), s) for i, t, s in rows[:40]]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i, _, _ in rows], "doc_id long, quality int")
    got = score_quality(docs, fit_quality(docs, labels)).collect()
    assert len({r.score for r in got}) > 2 and all((r.score >= 0.5) == (r.doc_id % 4 != 0) for r in got)


def test_differences_by_plain_compression(spark):
    """The raw score from whole frames made and measured one by one."""
    import zstandard

    rows, labels = corpus(60)
    docs = documents(spark, [*rows, (900, None, "s"), (901, "é" * 5000, "s")])
    model = fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"))

    def size(block, dictionary):
        own = zstandard.ZstdCompressionDict(dictionary)
        return len(zstandard.ZstdCompressor(level=3, dict_data=own, write_content_size=False, write_dict_id=False).compress(block))

    for r in score_quality(docs, model).collect():
        data = (r.text or "").encode()
        blocks = [data[i : i + 2048] for i in range(0, len(data), 2048)]
        plain = sum(size(b, model.bad) - size(b, model.good) for b in blocks) / max(len(data), 1)
        assert abs(r.raw_score - plain) < 1e-12
