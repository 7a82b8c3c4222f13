from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from helpers import documents

from rowtide.llm import toxicity
from rowtide.llm.toxicity import Restorer, corpus_trigrams, drop_toxic, fit_toxicity, language_model, score_toxicity

BAD = ["moron", "idiot", "scum", "stupid", "trash"]


def corpus(n=600):
    draw = random.Random(2)
    parts = ["the", "re", "an", "ing", "ti", "on", "er", "st", "mo", "ro", "di", "up", "tra", "sh", "cu"]
    words = ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 4))) for _ in range(500)]
    rows, labels = [], []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randrange(20, 150))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3 + len(text) // 30):
                text.insert(draw.randrange(len(text)), draw.choice(BAD))
        rows.append((i, " ".join(text), "s"))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    return docs, labels, fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id % 5 <> 0")


def test_restores(fitted):
    restorer = Restorer(fitted[2][0])
    read = lambda text: set(restorer.read(text))
    assert "moron" in read("you m0r0n there")
    assert "idiot" in read("an 1d1ot, an")
    assert "idiot" in read("iiiidiooot!!")
    assert "stupid" in read("$tup1d")
    assert "idiot" in read("the i d i o t the")
    assert "trash" in read("t.r.a.s.h") and "trash" in read("t-r-a-s-h.")
    assert "thering" in read("Thering%%%") and "thering" in read("(thering),")
    assert read("12345 -- !!! ...") == set()
    assert read("") == set()


def test_restores_what_looks_plain(fitted):
    restorer = Restorer(fitted[2][0])
    read = lambda text: set(restorer.read(text))
    assert read("iiddiioott moorroonn stuPiIid") == {"idiot", "moron", "stupid"}
    assert read("!diot") == {"idiot"} and read("(uing") == {"cuing"} and read("(scum)!") == {"scum"}
    assert read("7!$+") == {"tist"} and read("100% $5 3.14 555-3334 1000000 (377) & ***") == set()
    assert read("i d i o t!") == read("i\nd  i\to t.") == {"idiot"} and "st" in read("the s t the")


def test_symbols_at_the_end_may_be_letters(spark):
    words = documents(spark, [(i, "a jackass passes class as lass; mass and grass pass", "s") for i in range(50)])
    restorer = Restorer(language_model(corpus_trigrams(words)))
    assert set(restorer.read("jacka$$ cla$$! gra$$.")) == {"jackass", "class", "grass"}
    assert set(restorer.read("pass### grass%%% mass***")) == {"pass", "grass", "mass"}


def test_held_out_in_plain_looking_forms(spark, fitted):
    docs, labels, (model, scorer) = fitted
    forms = [lambda w: "".join(c + c for c in w), lambda w: " ".join(w) + "!", lambda w: "\n".join(w), lambda w: w[0] + w[0].upper() + w[1:]]
    toxic = [r for r in docs.collect() if r.doc_id % 20 == 0]
    for k, form in enumerate(forms):
        texts = [(r.doc_id, " ".join(form(w) if w in BAD else w for w in r.text.split()), "s") for r in toxic]
        scores = [r.score for r in score_toxicity(documents(spark, texts), model, scorer).collect()]
        assert sum(s >= 0.5 for s in scores) >= 0.9 * len(scores), k


def test_held_out(spark, fitted):
    docs, labels, (model, scorer) = fitted
    of = {r.doc_id: r.score for r in score_toxicity(docs, model, scorer).collect()}
    held = [(of[i], y) for i, y in labels if i % 5 == 0]
    assert sum((s >= 0.5) == (y == 1) for s, y in held) >= 0.97 * len(held)


def test_obfuscation_does_not_hide(spark, fitted):
    docs, labels, (model, scorer) = fitted
    hidden = str.maketrans({"o": "0", "i": "1", "s": "$"})
    toxic = [r for r in docs.collect() if r.doc_id % 20 == 0]
    texts = [(r.doc_id, " ".join(w.translate(hidden) if w in BAD else w for w in r.text.split()), "s") for r in toxic]
    assert all(a != r.text for (_, a, _), r in zip(texts, toxic))
    scores = [r.score for r in score_toxicity(documents(spark, texts), model, scorer).collect()]
    assert sum(s >= 0.5 for s in scores) >= 0.9 * len(scores)


def test_edges(spark, fitted):
    _, _, (model, scorer) = fitted
    rows = [(1, None, "s"), (2, "", "s"), (None, "moron " * 30, "s"), (4, "a " * 20_000, "s"), (5, "$" * 50_000, "s"), (6, "the " * 200_000, "s")]
    got = score_toxicity(documents(spark, rows, "'x' AS score"), model, scorer).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    of = {r.doc_id: r.score for r in got}
    assert of[1] == of[2] == scorer.prior and of[None] > 0.5


def test_counts_are_of_the_whole_corpus(spark):
    once = corpus_trigrams(documents(spark, [(1, "ab  Ab", "s"), (2, None, "s")]))
    assert once.sum() > 0 and (corpus_trigrams(documents(spark, [(i, "ab  Ab", "s") for i in range(7)])) == 7 * once).all()
    assert np.isfinite(language_model(np.zeros_like(once))).all()


def test_without_labels_and_without_rows(spark):
    docs = documents(spark, [(1, "text", "s")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in score_toxicity(docs, *fit_toxicity(docs, none)).collect()] == [0.5]
    assert drop_toxic(docs.limit(0), none).collect() == []


def test_drop_toxic_leaves_rows_whole(spark):
    """Columns named like the operator's own, or with dots; null and repeated ids, null, empty and long texts."""
    rows, labels = corpus(200)
    odd = [(None, "a plain text", "s"), (None, None, None), (5000, "", "s"), (3, rows[3][1], "s"), (5001, "word " * 30_000, "s")]
    docs = documents(spark, rows + odd, "'mine' AS score", "1 AS _score", "2 AS `a.b`")
    kept = drop_toxic(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert kept.columns == docs.columns
    got = kept.collect()
    assert {r.score for r in got} == {"mine"} and {r["a.b"] for r in got} == {2}
    assert sum(r.doc_id is None for r in got) == 2 and {5000, 5001} <= {r.doc_id for r in got}
    assert drop_toxic(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).collect() == []


def test_long_labelled_texts_teach(spark):
    """Where all labelled texts are long, passages of them fit the model."""
    draw = random.Random(6)
    words = ["wa", "ter", "sto", "ne", "lea", "ves", "ri", "ver"]
    rows = [(i, " ".join(draw.choice(words) + (draw.choice(BAD) if i % 2 and k % 9 == 0 else "") for k in range(17_000)), "s") for i in range(24)]
    assert min(len(t) for _, t, _ in rows) > 60_000
    docs = documents(spark, rows)
    got = score_toxicity(docs, *fit_toxicity(docs, spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, toxic int"))).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in got)


def test_decoding_is_the_likeliest_of_all_readings(fitted):
    """Viterbi against every reading of short tokens, one after the other."""
    from itertools import product

    from rowtide.llm import toxicity as t

    restorer = Restorer(fitted[2][0])
    model, number = restorer.model, restorer.number

    def likeliest(token):
        runs = [m[0] for m in t._RUNS.finditer(token)]
        word = [i for i, run in enumerate(runs) if run[0].isalnum()] or [0, -1]
        options = [
            restorer._at_ends(run, i < word[0], restorer._options(run)) if i < word[0] or i > word[-1] else restorer._options(run)
            for i, run in enumerate(runs)
        ]
        best = (-1e18, "")
        for reading in product(*options):
            text, total, a, b = "".join(x for x, _ in reading), sum(w for _, w in reading), 0, 0
            for c in [*text, " "]:
                s = 0 if c == " " else number.get(c, t.OTHER)
                total, a, b = total + model[(a * t.SYMBOLS + b) * t.SYMBOLS + s], b, s
            best = max(best, (total, text))
        return best

    def weight(token, text):
        return max((x for x in [likeliest(token)] if x[1] == text), default=None)

    for token in ["m0r0n", "1d10t", "5tup1d", "tr@sh", "sccum", "mooron!", "st*p", "(um", "$cum$$$", "tra5h3r", "a11"]:
        assert weight(token, restorer.decode(token)) is not None, token


def test_weights_hold_little_beside_the_sample(monkeypatch):
    """Against the same steps over all n-grams at once, to the last bit; memory is that of a block."""
    draw = np.random.default_rng(3)
    monkeypatch.setattr(toxicity, "STEPS", 3)
    sizes = draw.integers(0, 4000, 500)
    docs = [(np.sort(draw.choice(toxicity.WEIGHTS, n, replace=False)).astype(np.int32), draw.random(n, np.float32)) for n in sizes]
    y = (draw.random(len(docs)) < 0.4).astype(float)
    blocks = toxicity._Blocks()
    for d in docs:
        blocks.add(*d)
    tracemalloc.start()
    try:
        got = toxicity._word_weights(blocks.close(), y)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    at, v, row = np.concatenate([a for a, _ in docs]), np.concatenate([x for _, x in docs]), np.repeat(np.arange(len(docs)), sizes)
    w, b, squares, square = np.zeros(toxicity.WEIGHTS), 0.0, np.full(toxicity.WEIGHTS, 1e-8), 1e-8
    for _ in range(3):
        e = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=v * w[at], minlength=len(docs)) + b, -30, 30))) - y
        g = np.bincount(at, weights=v * e[row], minlength=toxicity.WEIGHTS) + 1e-3 * w
        squares += g * g
        w -= 0.3 * g / np.sqrt(squares)
        square += e.sum() ** 2
        b -= 0.3 * e.sum() / np.sqrt(square)
    assert (got == w).all() and len(blocks.done) > 5
    assert most < 8 * toxicity.WEIGHTS * 8 + 64 * toxicity.BLOCK_GRAMS < 40 * len(at)
