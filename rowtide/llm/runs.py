"""Runs of periodic words, from longest common extensions over a difference cover.

Texts are taken in groups of a bounded number of words, one after another with a separator of its own behind each.
Of the positions of a group only those are sorted whose remainder mod `COVER` lies in a difference cover.
For any two positions there is a short distance after which both are such samples, so
a longest common extension compares those few words, and beyond them asks for the least
common prefix between two ranks of the sorted samples: a sparse table answers that at once.

A run of period p holds at least p consecutive words that equal the word p further on, so one of them
lies on the grid 0, p, 2p, ... For all periods together the grids have n log n points. At each
that passes a look at its words, the extensions to both sides give the run.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Every difference of remainders is one of two members of the cover.
COVER, MEMBERS = 7, (0, 1, 3)

# Words that are sorted together; a longer text is a group of its own.
GROUP_WORDS = 1 << 18

# Grid points that are looked at together.
GRID_POINTS = 1 << 20

SHORTEST = 12

RUNS = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"

_PLACE = np.full(COVER, -1)
_PLACE[list(MEMBERS)] = range(len(MEMBERS))
# After how many words two positions with these remainders are both samples.
_SYNC = np.array(
    [[next(d for d in range(COVER) if _PLACE[(i + d) % COVER] >= 0 and _PLACE[(j + d) % COVER] >= 0) for j in range(COVER)] for i in range(COVER)]
)


def _starts(changes: np.ndarray) -> np.ndarray:
    """For each place, that of the last change at or before it."""
    return np.maximum.accumulate(np.where(changes, np.arange(len(changes)), 0))


class Extensions:
    """Longest common extensions of two positions of `words` (numbers, none negative).

    The last `COVER` words must occur only once, so that no extension reaches the end.
    """

    def __init__(self, words: np.ndarray):
        self.words = words
        n = len(words)
        blocks = -(-n // COVER)
        samples = (np.arange(blocks)[:, None] * COVER + np.array(MEMBERS)).ravel()
        samples = samples[samples <= n - COVER]
        levels = [self._first_classes(samples)]
        rank = levels[0]
        step = len(MEMBERS)
        while True:
            shared = np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)
            if not len(shared):
                break
            rank = rank.copy()
            then = np.where(shared + step < len(rank), rank[np.minimum(shared + step, len(rank) - 1)], -1)
            order = np.lexsort((then, rank[shared]))
            at, before, after = shared[order], rank[shared][order], then[order]
            new_class = np.r_[True, before[1:] != before[:-1]]
            new = new_class | np.r_[True, after[1:] != after[:-1]]
            rank[at] = before + (_starts(new) - _starts(new_class))
            levels.append(rank)
            step *= 2
        self.rank = rank
        order = np.empty(len(rank), dtype=np.int64)
        order[rank] = np.arange(len(rank))
        self._table(self._neighbours(levels, samples, order))

    def _first_classes(self, samples: np.ndarray) -> np.ndarray:
        """Each sample's place of the first one equal in `COVER` words, in their order."""
        bits = max(1, int(self.words.max()).bit_length())
        keys, k = [], 0
        while k < COVER:
            key = np.zeros(len(samples), dtype=np.int64)
            for _ in range(min(63 // bits, COVER - k)):
                key = (key << bits) | self.words[samples + k]
                k += 1
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(samples), dtype=bool)
        new[:1] = True
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        out = np.empty(len(samples), dtype=np.int64)
        out[order] = _starts(new)
        return out

    def _neighbours(self, levels: list[np.ndarray], samples: np.ndarray, order: np.ndarray) -> np.ndarray:
        """The common prefix of each sorted sample and the one before it, from the classes of each doubling."""
        a, b = order[:-1].copy(), order[1:].copy()
        total = np.zeros(len(a), dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            classes, step = levels[k], len(MEMBERS) << k
            inside = (a < len(classes)) & (b < len(classes))
            same = np.flatnonzero(inside)
            same = same[classes[a[same]] == classes[b[same]]]
            total[same] += COVER << k
            a[same] += step
            b[same] += step
        first, second = (samples[order[:-1]] + total, samples[order[1:]] + total) if len(a) else (total, total)
        alive = np.arange(len(a))
        for _ in range(COVER):
            alive = alive[np.maximum(first[alive], second[alive]) < len(self.words)]
            alive = alive[self.words[first[alive]] == self.words[second[alive]]]
            for x in (total, first, second):
                x[alive] += 1
        return total

    def _table(self, least: np.ndarray) -> None:
        self.table = [least.astype(np.int32)]
        width = 1
        while 2 * width <= len(least):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The number of equal words from `i` and from `j` on; `i` and `j` differ."""
        out = np.zeros(len(i), dtype=np.int64)
        sync = _SYNC[i % COVER, j % COVER]
        alive = np.arange(len(i))
        for k in range(COVER):
            asking = alive[sync[alive] > k]
            same = self.words[i[asking] + k] == self.words[j[asking] + k]
            out[asking] += same
            alive = np.concatenate([alive[sync[alive] <= k], asking[same]])
        if not len(alive) or not len(self.table[0]):
            return out
        at = [x[alive] + sync[alive] for x in (i, j)]
        known = np.maximum(*at) <= len(self.words) - COVER  # else the next word is one that occurs once
        alive, (a, b) = alive[known], (self.rank[x[known] // COVER * len(MEMBERS) + _PLACE[x[known] % COVER]] for x in at)
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            mine = level == k
            row = self.table[k]
            out[alive[mine]] += np.minimum(row[low[mine]], row[high[mine] - (1 << int(k))])
        return out


def _grid(words: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid points (position, period) of all texts whose word equals that a period further on, and so a neighbour's."""
    half = np.maximum(sizes // 2, 0)
    text = np.repeat(np.arange(len(sizes)), half)
    period = np.arange(len(text)) - np.repeat(np.cumsum(half) - half, half) + 1
    points = (sizes[text] - 1) // period
    upto = np.cumsum(points)
    first = 0
    while first < len(text):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + GRID_POINTS, side="right")))
        some = points[first:last]
        p = np.repeat(period[first:last], some)
        k = np.arange(len(p)) - np.repeat(np.cumsum(some) - some, some)
        i = np.repeat(begins[text[first:last]], some) + k * p
        hit = np.flatnonzero(words[i] == words[i + p])
        i, p = i[hit], p[hit]
        near = (words[i + 1] == words[i + 1 + p]) | (words[i - 1] == words[i - 1 + p])
        yield i[near], p[near]
        first = last


def find_runs(words: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows of (start in `words`, length, period) by start, then period, of all runs of length 12 and two periods at least.

    `words` holds the texts at `begins` with words that occur once between, before and (`COVER` at least) after them.
    """
    found = [x for x in _grid(words, begins, sizes) if len(x[0])]
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    i, p = (np.concatenate(x) for x in zip(*found))
    after = Extensions(words).between(i, i + p)
    turned = np.r_[words[::-1], words.max() + 1 + np.arange(COVER)]
    before = Extensions(turned).between(len(words) - i, len(words) - i - p)
    long = after + before >= np.maximum(p, SHORTEST - p)
    runs = np.stack([(i - before)[long], (after + before + p)[long], p[long]], axis=1)
    runs = np.unique(runs, axis=0)
    # Of one stretch, the least period is the run's; the others are its multiples.
    own = np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]
    runs = runs[own[: len(runs)]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _runs_of(texts: list[list[bytes]]) -> pa.StructArray:
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    flat = [w for t in texts for w in t]
    ids = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy()
    begins = np.cumsum(sizes + 1) - sizes  # a separator before each text
    words = np.empty(len(flat) + len(texts) + COVER, dtype=np.int64)
    single = np.ones(len(words), dtype=bool)
    place = np.arange(len(flat)) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
    words[place], single[place] = ids, False
    words[single] = (ids.max() + 1 if len(ids) else 0) + np.arange(len(words) - len(flat))
    runs = find_runs(words, begins, sizes)

    text = np.searchsorted(begins, runs[:, 0], side="right") - 1
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(change) > 0
    touched = set(text.tolist())
    collapsed = []
    for k, own in enumerate(texts):
        if k in touched:
            own = compress(own, ~dropped[begins[k] : begins[k] + sizes[k]])
        collapsed.append(b" ".join(own))
    fields = [pa.field(c, pa.int64()) for c in ("start", "length", "period")]
    each = pa.StructArray.from_arrays([pa.array(runs[:, 0] - begins[text]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=fields)
    offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
    columns = [pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), each), pa.array(collapsed, pa.binary()).cast(pa.string())]
    return pa.StructArray.from_arrays(columns, names=["n_words", "runs", "collapsed"])


def _groups(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    group, size = [], 0
    for text in texts:
        words = (text.as_py() or "").encode().split()
        group.append(words)
        size += len(words)
        if size >= GROUP_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.concat_arrays([_runs_of(group) for group in _groups(texts)])


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id`, `n_words`, `runs` and `collapsed` of every row of `docs`; `text` is SQL of the text.

    Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0. A run is a stretch of words with smallest period `period`, of `length` 12 and
    two periods at least, that can't be made longer to either side with that period; `runs` lists all by
    start, then period. `collapsed` is the text, joined by single spaces, without the words of any run that
    follow its first period. Null and empty texts have no words, no runs and an empty `collapsed`. Rows
    that repeat an id or have none each get a row of their own; other columns are ignored. No rows give no rows.

    Texts are worked on one by one, so nothing is shuffled; memory grows with the longest text, by some 300 bytes a word.
    """
    find = F.arrow_udf(_find, RUNS)
    return docs.selectExpr("doc_id", f"{text} AS _text").withColumn("_r", find("_text")).select("doc_id", "_r.*")
