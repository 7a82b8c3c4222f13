"""Quality by compression: which of two dictionaries, of good or of bad text, shortens a document more.

Two Zstandard dictionaries are built from labelled documents. A text is cut into
blocks, each is compressed on its own with either dictionary (so the dictionary counts
for long texts as for short ones), and the difference of the sizes over the length of the text is
the raw score. Logistic regression on the labelled sample turns it into a
probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import keep, labelled_texts, without

# The sample that the model is fitted on: of each label, so many rows, of at most so many characters each and together,
# half of them for the dictionaries and half for the calibration. Longer texts give a passage; scores are those of whole texts.
SAMPLE_ROWS = 1500
TEXT_CHARS = 60_000
SAMPLE_CHARS = 12_000_000

DICTIONARY_BYTES = 64 << 10
BLOCK = 2048
LEVEL = 3


class Model:
    """Two dictionaries and a calibration; small, so it travels with the task."""

    def __init__(self, good: bytes, bad: bytes, weights: list[float], prior: float):
        self.good, self.bad, self.weights, self.prior = good, bad, weights, prior

    def compressors(self) -> list:
        return [
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False
            )
            for d in (self.good, self.bad)
        ]


def _blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def difference(data: bytes, good, bad) -> float:
    """Compressed size with the bad dictionary less that with the good one, over the size of the text."""
    if not data:
        return 0.0
    return sum(len(bad.compress(b)) - len(good.compress(b)) for b in _blocks(data)) / len(data)


def _features(differences: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The difference, its amount, and how short the text is: short ones tell less."""
    return np.stack([np.ones_like(differences), 10 * differences, np.abs(10 * differences), 64 / (64 + sizes)], axis=1)


def _fit(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def _dictionary(texts: list[bytes]) -> bytes:
    """Trained on the blocks; where they are too few to train on, the text itself is the dictionary."""
    blocks = [b for t in texts for b in _blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(blocks) or b" " * 16)[-DICTIONARY_BYTES:].ljust(16)


def fit_quality(docs: DataFrame, labels: DataFrame, learn: str = "TRUE", label: str = "quality") -> Model:
    """A model from a bounded sample of the labelled documents for which `learn` (SQL on `doc_id`) holds.

    Of each label, the `SAMPLE_ROWS` rows with the smallest hash of the id are
    taken, as long as they have at most `SAMPLE_CHARS` characters together; a text of over `TEXT_CHARS` gives a passage of that length, and
    rows that repeat an id count once. Even and odd places go to the
    dictionaries and to the calibration. The prior is the share of label 1 among all
    labelled rows. Without rows of both labels every score is the prior.
    """
    known = labels.where(f"({learn}) AND {label} IN (0, 1)").selectExpr("doc_id", f"CAST({label} AS INT) AS _y")
    counts = {r._y: r.n for r in known.groupBy("_y").agg(F.expr("count(*) AS n")).collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    chosen = [
        known.where(f"_y = {y}").select("doc_id", "_y", F.expr("xxhash64(doc_id) AS _h")).orderBy("_h", "doc_id").limit(SAMPLE_ROWS)
        for y in (0, 1)
    ]
    sample = keep(chosen[0].unionByName(chosen[1]))
    rows = labelled_texts(docs, sample, TEXT_CHARS, SAMPLE_CHARS, "_y")
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    for r in rows:
        if r.text:
            texts[r._y].append(r.text.encode())
    if min(map(len, texts.values())) < 2:
        return Model(b" " * 16, b" " * 16, [0.0] * 4, prior)
    model = Model(_dictionary(texts[1][::2]), _dictionary(texts[0][::2]), [0.0] * 4, prior)
    good, bad = model.compressors()
    held = [(difference(t, good, bad), float(len(t)), float(y)) for y in (0, 1) for t in texts[y][1::2]]
    d, sizes, y = np.array(held).T
    x = _features(d, sizes)
    weights = _fit(x, y)
    # The sample has the labels in other shares than the corpus: shift the intercept to the prior's odds.
    share = y.mean()
    weights[0] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    model.weights = weights
    return model


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `score` (0 to 1, higher is better) and `raw_score`, over whole texts.

    Null and empty texts have the raw score 0. Columns of these names are replaced. Equal texts have equal scores; no rows give no rows.
    """
    data = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        good, bad = data.value.compressors()
        for batch in texts:
            yield pa.array([difference((t.as_py() or "").encode(), good, bad) for t in batch], pa.float64())

    weigh = F.arrow_udf(score, "double")
    w = [float(x) for x in model.weights]
    short = "64D / (64D + octet_length(coalesce(text, '')))"
    z = f"{w[0]!r}D + {w[1]!r}D * 10 * raw_score + {w[2]!r}D * abs(10 * raw_score) + {w[3]!r}D * {short}"
    scored = without(docs, "score", "raw_score").withColumn("raw_score", weigh("text"))
    if not any(w):
        return scored.selectExpr("*", f"{model.prior!r}D AS score")
    return scored.selectExpr("*", f"1 / (1 + exp(-({z}))) AS score")
