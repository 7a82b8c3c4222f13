"""Toxicity of obfuscated text: a noisy channel restores it, then restored words are scored.

A character trigram model is counted over the whole corpus. A token that isn't plain
letters is a lattice: digits and symbols may stand for letters or for nothing, runs of
a letter for one or two, and a row of spaced single letters for a word; Viterbi decoding finds the
most likely reading under the model and the channel. Only tokens of a single reading are not
decoded. A token without letters may also be a number or an ornament, which stands for no word. A linear model over the character
n-grams of restored words, fitted on labelled documents, gives each word a score, and a second
small one turns the words' scores into the document's.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import fresh, keep, labelled_texts, without
from rowtide.model import quoted

# The model's alphabet: 0 stands for everything between words, the last one for any other letter.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
SYMBOLS = 64
OTHER = SYMBOLS - 1

# What stands for which letters.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y", "&": "a", "%": "x",
}
WILD = "*#"

# Log probabilities of the channel.
SUBSTITUTED, DROPPED_SYMBOL, DROPPED_DIGIT, DROPPED_MARK, WILDCARD = -1.5, -4.5, -7.0, -1.0, -4.5
DOUBLED_ONCE, LONG_ONCE, LONG_TWICE, SPACE_DROPPED, SPACE_KEPT = -3.0, -0.5, -1.5, -0.5, -2.0
# Of what stands for no word: each run of a digit in a number, each run of a symbol, and one of three or more at the end of a word.
DIGIT_ALONE, SYMBOLS_ALONE, ORNAMENT = -2.3, -6.0, -1.5

# The linear model: n-grams of words with their ends marked, hashed into so many weights.
GRAMS = (4, 5)
WEIGHTS = 1 << 18
STEPS = 80

# The sample that the model is fitted on: so many rows of each label, by hash of the id, of at most so many characters
# each (a passage of longer texts) and in all. Scores are those of whole texts.
TOXIC_ROWS, OTHER_ROWS, TEXT_CHARS, SAMPLE_CHARS = 1600, 3200, 60_000, 24_000_000

# The driver fits on about so many n-grams at a time.
BLOCK_GRAMS = 1 << 16

_DOUBLED = re.compile(r"(.)\1", re.S)
_RUNS = re.compile(r"(.)\1*", re.S)
# Marks that stand for no letter, and those that may.
_MARKS_ONLY = "\"'“”«»)[]{}.,;:?…¿¡"
_MARKS = _MARKS_ONLY + "(!"
_SPACED = re.compile(rf"(?<!\S)[{re.escape(_MARKS_ONLY)}]*\S(?:\s+\S)+[{re.escape(_MARKS)}]*(?!\S)")
_BLANKS = re.compile(r"\s+")

_CACHE, _KNOWN = 200_000, 50_000


def _table() -> np.ndarray:
    """The symbol of every code point of the basic plane, in either case; the last entry is for all others."""
    table = np.array([OTHER if chr(code).isalpha() else 0 for code in range(0x10000)] + [OTHER], dtype=np.uint8)
    for i, c in enumerate(LETTERS, 1):
        for form in (c, c.upper()):
            if len(form) == 1:
                table[ord(form)] = i
    return table


# Texts are counted together, about so many characters at a time.
COUNTED_CHARS = 1 << 20
_BETWEEN = "\0\0"


def corpus_trigrams(docs: DataFrame) -> np.ndarray:
    """Counts of symbol trigrams over all texts; what reaches the driver is as large as the model, not the corpus."""
    table = _table()

    def count_in(text: str, counts: np.ndarray) -> None:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        s = table[np.minimum(codes, len(table) - 1)]
        kept = s > 0
        kept[1:] |= s[:-1] > 0  # one symbol between words
        kept |= codes == 0  # and two between texts, so that the counts don't depend on who is next to whom
        s = s[kept].astype(np.int32)
        counts += np.bincount((s[:-2] << 12) | (s[1:-1] << 6) | s[2:], minlength=SYMBOLS**3)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SYMBOLS**3, dtype=np.int64)
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    held.append(text.as_py())
                    size += len(held[-1])
                    if size >= COUNTED_CHARS:
                        count_in(_BETWEEN + _BETWEEN.join(held) + _BETWEEN, counts)
                        held, size = [], 0
        if held:
            count_in(_BETWEEN + _BETWEEN.join(held) + _BETWEEN, counts)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(counts[found], pa.int64())], ["trigram", "n"])

    each = docs.select("text").mapInArrow(count, "trigram int, n long")
    counts = np.zeros(SYMBOLS**3)
    for r in each.groupBy("trigram").agg(F.expr("sum(n) AS n")).collect():
        counts[r.trigram] = r.n
    return counts


def language_model(trigrams: np.ndarray) -> list[float]:
    """Log probabilities of a symbol after two others, smoothed by shorter contexts."""
    n3 = trigrams.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
    p1 = (n1 + 0.5) / (n1.sum() + 0.5 * SYMBOLS)
    p2 = (n2 + 20 * p1) / (n2.sum(axis=1, keepdims=True) + 20)
    p3 = (n3 + 20 * p2) / (n3.sum(axis=2, keepdims=True) + 20)
    return np.log(p3).reshape(-1).tolist()


class Restorer:
    """Plain words from tokens, by the language model."""

    def __init__(self, model: list[float]):
        self.model = model
        self.number = {c: i for i, c in enumerate(LETTERS, 1)}
        self.known: dict[str, tuple[str, ...]] = {}

    def _options(self, run: str) -> list[tuple[str, float]]:
        """What a run of one character may stand for, with the channel's log probability. A blank ends a word."""
        c, many = run[0], len(run)
        if c.isspace():
            return [("", SPACE_DROPPED), (" ", SPACE_KEPT)]
        if c.isalpha():
            if many == 1:
                return [(c, 0.0)]
            if many == 2:
                return [(c + c, 0.0), (c, DOUBLED_ONCE)]
            return [(c, LONG_ONCE), (c + c, LONG_TWICE)]
        if c in WILD:
            return [("", DROPPED_SYMBOL), *((x, WILDCARD) for x in LETTERS[:26])]
        if c in LEET:
            drop = DROPPED_DIGIT if c.isdigit() else DROPPED_SYMBOL
            options = [("", drop), *((x, SUBSTITUTED) for x in LEET[c])]
            return options + [(x + x, SUBSTITUTED - 1) for x in LEET[c]] if many > 1 else options
        return [("", DROPPED_MARK if not c.isdigit() else DROPPED_DIGIT)]

    def _at_ends(self, run: str, first: bool, options: list[tuple[str, float]]) -> list[tuple[str, float]]:
        """The options of a run before or after all letters, where it's more likely to be a mark or an ornament."""
        if run[0] == "(" or run[0] == "!" and not first:
            return [("", DROPPED_MARK), *options[1:]]
        if run == "!":  # no mark stands so before a word
            return [("", DROPPED_DIGIT), *options[1:]]
        if len(run) > 2 and not first and not run[0].isalnum() and options[0][1] < ORNAMENT:
            return [("", ORNAMENT), *options[1:]]
        return options

    def decode(self, token: str) -> str:
        """The most likely reading of a token: Viterbi over states of the last two symbols.

        Without a letter it is read as words only when that is likelier than a number or symbols.
        """
        model, number = self.model, self.number
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        runs = [m[0] for m in _RUNS.finditer(token)]
        # Ends are what stands before and after all letters and digits; a token without any has an end only.
        word = [i for i, run in enumerate(runs) if run[0].isalnum()] or [0, -1]
        spaced = any(run[0].isspace() for run in runs)
        for i, run in enumerate(runs):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            options = self._options(run)
            if i < word[0] or i > word[-1]:
                options = self._at_ends(run, i < word[0], options)
            if spaced and not run[0].isalpha() and not run[0].isspace():  # what stands on its own may be no letter
                options = [("", max(DIGIT_ALONE, options[0][1])), *options[1:]]
            for (a, b), (score, path) in states.items():
                for text, weight in options:
                    x, y, total = a, b, score + weight
                    for c in text:
                        s = 0 if c == " " else number.get(c, OTHER)
                        total += model[(x * SYMBOLS + y) * SYMBOLS + s]
                        x, y = y, s
                    old = after.get((x, y))
                    if old is None or total > old[0]:
                        after[(x, y)] = (total, (path, text) if text else path)
            states = after
        end = max(((score + model[(a * SYMBOLS + b) * SYMBOLS], path) for (a, b), (score, path) in states.items()), key=lambda t: t[0])
        if not any(run[0].isalpha() for run in runs) and end[0] <= sum(map(self._alone, runs)):
            return ""
        parts, path = [], end[1]
        while path is not None:
            path, text = path
            parts.append(text)
        return "".join(reversed(parts))

    @staticmethod
    def _alone(run: str) -> float:
        """The log probability of a run in a token that stands for no word."""
        if run[0].isspace():
            return SPACE_KEPT
        if run[0].isdigit():
            return DIGIT_ALONE
        return SYMBOLS_ALONE if (run[0] in LEET or run[0] in WILD) and run[0] not in _MARKS else DROPPED_MARK

    def words(self, token: str) -> tuple[str, ...]:
        """The words that a token stands for."""
        # Marks at the ends go, but not those that may be letters.
        text = token.lower().strip(_MARKS_ONLY)
        if text.isalpha() and not _DOUBLED.search(text):
            return (text,)  # nothing in it may be read in another way
        return tuple(self.decode(text).split()) if text else ()

    def tokens(self, text: str) -> Counter:
        """Tokens of a whole text with their counts; rows of spaced letters are decoded to words already."""
        spaced = _SPACED.findall(text)
        if not spaced:
            return Counter(text.split())
        counts = Counter(_SPACED.sub(" ", text).split())
        for run in spaced:
            counts.update(self.decode(_BLANKS.sub(" ", run.lower())).split())
        return counts

    def read(self, text: str) -> Counter:
        """Restored words of a whole text with their counts."""
        counts: Counter = Counter()
        if len(self.known) > _KNOWN:
            self.known.clear()
        for token, n in self.tokens(text).items():
            words = self.known.get(token)
            if words is None:
                words = self.known[token] = self.words(token)
            for word in words:
                counts[word] += n
        return counts


def gram_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all words, as places in the weights, and the word that each is of."""
    marked = [f"^{w}$".encode("utf-8", "surrogatepass").ljust(4, b"$") for w in words]
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    text = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), sizes)
    found, owners = [], []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            if len(text) >= n:
                packed = text[: len(text) - n + 1].copy()
                for k in range(1, n):
                    packed |= text[k : len(text) - n + 1 + k] << np.uint64(8 * k)
                inside = owner[: len(packed)] == owner[n - 1 :]
                found.append((((packed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(WEIGHTS))[inside])
                owners.append(owner[: len(packed)][inside])
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found).astype(np.int64), np.concatenate(owners)


class Scorer:
    """A word's score is the sum of its n-grams' weights; the document's, a small model over its words' scores."""

    def __init__(self, weights: np.ndarray, levels: list[float], final: list[float], prior: float):
        self.weights, self.levels, self.final, self.prior = weights, levels, final, prior
        self.cache: dict[str, float] = {}
        self.several: dict[str, np.ndarray] = {}

    def words(self, words: list[str]) -> np.ndarray:
        at, owner = gram_ids(words)
        return np.bincount(owner, weights=self.weights[at], minlength=len(words))

    def read(self, tokens: Counter, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the restored words and their counts. Scores of tokens are kept for the texts that follow."""
        if len(self.cache) > _CACHE:
            self.cache.clear()
            self.several.clear()
        cache = self.cache
        new = [t for t in tokens if t not in cache]
        if new:
            stand_for = [restorer.words(t) for t in new]
            scores = self.words([w for words in stand_for for w in words])
            at = 0
            for token, words in zip(new, stand_for):
                if len(words) == 1:
                    cache[token] = scores[at]
                else:  # none or several words
                    cache[token] = np.nan
                    self.several[token] = scores[at : at + len(words)]
                at += len(words)
        s = np.fromiter(map(cache.__getitem__, tokens), dtype=float, count=len(tokens))
        n = np.fromiter(tokens.values(), dtype=float, count=len(tokens))
        odd = np.isnan(s)
        if odd.any():
            parts = [(self.several[t], m) for t, m in tokens.items() if t in self.several]
            s = np.concatenate([s[~odd], *(p for p, _ in parts)])
            n = np.concatenate([n[~odd], *(np.full(len(p), float(m)) for p, m in parts)])
        return s, n

    def features(self, s: np.ndarray, n: np.ndarray) -> np.ndarray:
        if not len(s):
            return np.zeros(5 + 2 * len(self.levels))
        total = n.sum()
        above = [(n * (s > level)).sum() for level in self.levels]
        shares = [np.sqrt(a / total) * 4 for a in above]
        return np.array([(n * s).sum() / total, (n * np.maximum(s, 0)).sum() / total, s.max() / 10, 5 / (5 + total), np.log1p(total) / 5]
                        + shares + [np.log1p(a) for a in above])

    def score(self, text: str, restorer: Restorer) -> float:
        if not self.final:
            return self.prior
        s, n = self.read(restorer.tokens(text), restorer)
        if not len(s):
            return self.prior
        z = self.final[0] + float(np.dot(self.final[1:], self.features(s, n)))
        return 1 / (1 + float(np.exp(-np.clip(z, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _densities(words: list[str], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a document and how dense each is among its words."""
    ids, owner = gram_ids(words)
    u, inverse = np.unique(ids.astype(np.int32), return_inverse=True)
    total = np.bincount(inverse, weights=n[owner], minlength=len(u))
    return u, np.minimum(total / max(n.sum(), 1) * 20, 1).astype(np.float32)


class _Blocks:
    """N-grams of documents and their densities, in blocks of whole documents: `at`, `value`, and how many each document has."""

    def __init__(self):
        self.done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.open: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, at: np.ndarray, value: np.ndarray) -> None:
        self.open.append((at, value))
        self.size += len(at)
        if self.size >= BLOCK_GRAMS:
            self.close()

    def close(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if self.open:
            at, value = zip(*self.open)
            self.done.append((np.concatenate(at), np.concatenate(value), np.array([len(x) for x in at])))
            self.open, self.size = [], 0
        return self.done


def _word_weights(blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]], y: np.ndarray) -> np.ndarray:
    """Logistic regression on the density of n-grams, by adaptive gradient steps; besides the blocks it holds what one of them needs."""
    w, b, squares, square = np.zeros(WEIGHTS), 0.0, np.full(WEIGHTS, 1e-8), 1e-8
    e = np.empty(len(y))
    for _ in range(STEPS):
        g, done = np.zeros(WEIGHTS), 0
        for at, v, sizes in blocks:
            own = slice(done, done := done + len(sizes))
            row = np.repeat(np.arange(len(sizes)), sizes)
            z = np.bincount(row, weights=v * w[at], minlength=len(sizes)) + b
            e[own] = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[own]
            np.add.at(g, at, v * e[own][row])
        g += 1e-3 * w
        squares += g * g
        w -= 0.3 * g / np.sqrt(squares)
        square += e.sum() ** 2
        b -= 0.3 * e.sum() / np.sqrt(square)
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: str = "TRUE", label: str = "toxic") -> tuple[list[float], Scorer]:
    """The language model of all documents, and a scorer from a bounded sample of the labelled ones.

    `learn` is SQL on `doc_id` for the labels that may be used. Of each label, the rows with the smallest
    hash of the id are taken, `TOXIC_ROWS` and `OTHER_ROWS` at most; a text of over `TEXT_CHARS` gives a passage of that length. Two thirds
    fit the words' weights, a third the final model. Of a text, only its words or n-grams stay. Of rows that repeat an id, one is taken. Without rows of both labels every score is the
    share of label 1; empty tables give such a model, too.
    """
    model = language_model(corpus_trigrams(docs))
    known = labels.where(f"({learn}) AND {label} IN (0, 1)").selectExpr("doc_id", f"CAST({label} AS INT) AS _y")
    counts = {r._y: r.n for r in known.groupBy("_y").agg(F.expr("count(*) AS n")).collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    chosen = [
        known.where(f"_y = {y}").select("doc_id", "_y", F.expr("xxhash64(doc_id) AS _h")).orderBy("_h", "doc_id").limit(most)
        for y, most in ((0, OTHER_ROWS), (1, TOXIC_ROWS))
    ]
    sample = keep(chosen[0].unionByName(chosen[1]))
    rows = labelled_texts(docs, sample, TEXT_CHARS, SAMPLE_CHARS)[::-1]
    restorer, taken = Restorer(model), 0
    first, third = _Blocks(), []
    first_y, held_y = [], []
    while rows:
        r = rows.pop()  # of what is collected, nothing stays beside what is made of it
        if r.text:
            counts = restorer.read(r.text)
            words, n = list(counts), np.fromiter(counts.values(), dtype=np.float32, count=len(counts))
            if taken % 3 != 2:
                first.add(*_densities(words, n))
                first_y.append(float(r._y))
            else:
                third.append(("\n".join(words), n))
                held_y.append(float(r._y))
            taken += 1
    del restorer
    if len(set(first_y)) < 2 or len(set(held_y)) < 2:
        return model, Scorer(np.zeros(WEIGHTS), [], [], prior)
    held_y = np.array(held_y)
    weights = _word_weights(first.close(), np.array(first_y))
    scorer = Scorer(weights, [], [], prior)
    held = [(scorer.words(words.split("\n") if words else []), n) for words, n in third]
    seen = np.concatenate([s for s, _ in held])
    scorer.levels = [float(np.quantile(seen, q)) for q in (0.9, 0.97, 0.99, 0.997)]
    final = _logistic(np.array([scorer.features(s, n) for s, n in held]), held_y)
    share = held_y.mean()
    final[0] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))  # the sample has more of label 1
    scorer.final = final.tolist()
    return model, scorer


def score_toxicity(docs: DataFrame, model: list[float], scorer: Scorer) -> DataFrame:
    """`docs` with `score`, 0 to 1 and higher for label 1, over whole texts; null and empty texts have the prior.

    A column of this name is replaced. Equal texts have equal scores; no rows give no rows.
    """
    return _scored(without(docs, "score"), model, scorer, "score")


def _scored(docs: DataFrame, model: list[float], scorer: Scorer, name: str) -> DataFrame:
    weights = scorer.weights.astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((model, weights, scorer.levels, scorer.final, scorer.prior))

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lm, *rest = shared.value
        restorer, of = Restorer(lm), Scorer(*rest)
        for batch in texts:
            yield pa.array([of.score(t.as_py(), restorer) if t.is_valid else of.prior for t in batch], pa.float64())

    return docs.withColumn(name, F.arrow_udf(score, "double")("text"))


def drop_toxic(docs: DataFrame, labels: DataFrame, from_score: float = 0.5) -> DataFrame:
    """The rows of `docs` that score less than that, whole, with columns of any name; the model is fitted on the labels of `docs`."""
    model, scorer = fit_toxicity(docs, labels)
    (name,) = fresh(docs, "_score")
    return _scored(docs, model, scorer, name).where(f"{name} < {from_score}D").select(*quoted(docs.columns))
