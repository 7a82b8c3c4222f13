"""Repeated passages by distributed prefix doubling over sampled positions.

A position is settled once the string that starts there is known to be unique, or has been
followed past the threshold. Each round names longer strings (32 bytes, four fifths of the threshold, the
threshold) by the pair of ranks of their halves, taken at growing offsets, and Spark sorts the
positions by these pairs; equal neighbours share a rank, the first of them is the earliest
position. Ranks of halves are fingerprints, so that those at an offset need no join.

Not every position has to be sorted. In each string of the threshold's length, one
position is sampled: that where the rank pair of the round's length is least. What is chosen
depends on the string alone, so equal strings sample alike. A sampled position stands for the run of
consecutive strings that chose it, its span. When its pair is unique, so are all of them; when
the whole span occurred before, all of them did. Only spans that share their pair with another, different
span go on to the next round. In the last one, every position is its own sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import join_small, keep
from rowtide.llm.ranks import part_count, ranked
from rowtide.operators.rows import splittable_join

# Bytes that are hashed at a time.
PIECE = 1 << 18

# Runs or removed stretches of all documents that are broadcast at most, eight bytes each.
BROADCAST_RANGES = 2_000_000

# `place` is the first start of a span in its high half and the last one in its low half.
ROWS = "doc long, place long, pair long, span long"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


class _Sums:
    """Fingerprints of substrings of one buffer from prefix sums; tables are the same for every worker."""

    _tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int):
        if seed not in self._tables or len(self._tables[seed][1]) <= len(data):
            draw = np.random.Generator(np.random.PCG64(seed))
            letters = draw.integers(0, 2**64, 256, dtype=np.uint64)
            base = int(draw.integers(0, 2**64, dtype=np.uint64)) | 1
            n = max(len(data), 2 * PIECE) + 1
            self._tables[seed] = letters, _powers(base, n), _powers(pow(base, -1, 2**64), n)
        letters, up, self.down = self._tables[seed]
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(letters[data] * up[: len(data)], out=self.sums[1:])

    def fixed(self, length: int) -> np.ndarray:
        """Of all substrings of one length."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.down[:n]

    def between(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.down[begin]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def spans(data: np.ndarray, lengths: np.ndarray, seed: int, length: int) -> tuple[np.ndarray, ...]:
    """Spans of the pieces that lie one after another in `data`: first and last start (in `data`) of the
    strings that sampled the same position, its rank pair at `seed` bytes, the fingerprint of the span."""
    if len(data) < length:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    high = np.uint64(0xFFFFFFFF00000000)
    sums = _Sums(data, 11)
    half = _mixed(sums.fixed(seed - seed // 2))
    n = len(data) - seed + 1
    pair = (half[:n] & high) | (half[seed // 2 :][:n] >> np.uint64(32))
    starts = len(data) - length + 1
    at = np.arange(starts)
    if seed < length:
        index = np.uint64((1 << 22) - 1)
        low = (_mixed(pair) & ~index) | np.arange(n, dtype=np.uint64)  # of equal ranks, the first
        step, width = 1, length - seed + 1
        while 2 * step <= width:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < width:
            low = np.minimum(low[: len(low) - (width - step)], low[width - step :])
        at = (low & index).astype(np.int64)
    for end in np.cumsum(lengths)[:-1]:
        at[max(0, end - length + 1) : end] = -1  # strings don't cross pieces
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:], starts] - 1
    inside = at[first] >= 0
    first, last = first[inside], last[inside]
    place = at[first]
    shape = (last - first).astype(np.uint64) * np.uint64(0x94D049BB133111EB) ^ (place - first).astype(np.uint64)
    whole = _mixed(_Sums(data, 13).between(first, last + length) + _mixed(shape))
    return first, last, pair[place], whole


def _pieces(texts: pa.Array, ranges: list[list[int]] | None, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Row number, offset and bytes of what is to be sampled, at most `PIECE` strings at a time."""
    for i, text in enumerate(texts):
        data = np.frombuffer(text.as_buffer() or b"", dtype=np.uint8) if text.is_valid else np.zeros(0, np.uint8)
        for place in [len(data) - length] if ranges is None else ranges[i]:
            hi = place & 0xFFFFFFFF if place >= 0 else -1
            for begin in range(place >> 32, hi + 1, PIECE):
                yield i, begin, data[begin : min(hi + 1, begin + PIECE) + length - 1]


def _sample(seed: int, length: int):
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans_of(group: list, docs: np.ndarray) -> pa.RecordBatch:
            sizes = np.array([len(d) for _, _, d in group])
            first, last, pair, whole = spans(np.concatenate([d for _, _, d in group]), sizes, seed, length)
            piece = np.searchsorted(np.cumsum(sizes), first, side="right")
            moved = np.array([b for _, b, _ in group]) - (np.cumsum(sizes) - sizes)
            doc = docs[np.array([i for i, _, _ in group])[piece]]
            lo, hi = first + moved[piece], last + moved[piece]
            columns = [doc, lo << 32 | hi, pair.view(np.int64), whole.view(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "place", "pair", "span"])

        for batch in batches:
            docs = batch.column("doc").to_numpy(zero_copy_only=False)
            ranges = batch.column("ranges").to_pylist() if "ranges" in batch.schema.names else None
            group, size = [], 0
            for piece in _pieces(batch.column("data"), ranges, length):
                group.append(piece)
                size += len(piece[2])
                if size >= PIECE:
                    yield spans_of(group, docs)
                    group, size = [], 0
            if group:
                yield spans_of(group, docs)

    return sample


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted part: spans that occurred before (`again`), first ones of several with their pair, and those whose
    pair reaches an end of the part, where neighbours may lie in another one: only these keep their ranks."""
    found = list(batches)
    if not sum(b.num_rows for b in found):
        return
    rows = pa.Table.from_batches(found).combine_chunks()
    pair, span = (rows.column(c).to_numpy() for c in ("pair", "span"))
    new_pair = np.r_[True, pair[1:] != pair[:-1]]
    new_span = new_pair | np.r_[True, span[1:] != span[:-1]]
    group = np.cumsum(new_pair) - 1
    different = np.bincount(group, weights=new_span)[group] > 1
    edge = (group == 0) | (group == group[-1])
    kept = np.flatnonzero(~new_span | different | edge)
    doc, place = (rows.column(c).to_numpy()[kept] for c in ("doc", "place"))
    inside = ~edge[kept]  # these are settled, without their ranks
    columns = [pa.array(doc), pa.array(place), *(pa.array(x[kept], mask=inside) for x in (pair, span)), pa.array(~new_span[kept])]
    yield from pa.Table.from_arrays(columns, names=["doc", "place", "pair", "span", "again"]).to_batches(max_chunksize=100_000)


def _round(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans that occurred before, and the first ones of spans that share their pair with a different one."""
    order = ["pair", "span", "doc", "place"]
    parts = part_count(rows, rows.count())
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    judged = keep(dealt.mapInArrow(_neighbours, f"{ROWS}, again boolean"))
    # Of the pairs that reach the ends of parts, there are two for each part at most.
    edges = judged.where("pair IS NOT NULL AND NOT again")
    first = edges.groupBy("pair", "span").agg(F.expr("min(struct(doc, place)) AS first"), F.expr("count(*) AS n"))
    several = keep(first.where("n > 1").drop("n"))  # spans cut by an end: one for each part at most
    pairs = keep(edges.groupBy("pair").agg(F.expr("min(span) <> max(span) AS contested")))
    known = join_small(join_small(judged, pairs, ["pair"], "left"), several, ["pair", "span"], "left")
    known = known.selectExpr(
        "doc", "place", "again OR coalesce(struct(doc, place) <> first, FALSE) AS again", "pair IS NULL OR contested AS contested"
    )
    return known.where("again").select("doc", "place"), known.where("NOT again AND contested").select("doc", "place")


def _joined(gap: int):
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("places")
            flat = lists.flatten().to_numpy()
            doc = np.repeat(batch.column("doc").to_numpy(), lists.value_lengths().to_numpy())
            lo, hi = flat >> 32, flat & 0xFFFFFFFF
            new = np.r_[True, (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1] + gap)]
            begin = np.flatnonzero(new)
            end = np.r_[begin[1:], len(flat)] - 1
            docs = np.flatnonzero(np.r_[True, doc[begin][1:] != doc[begin][:-1]])
            offsets = np.r_[docs, len(begin)].astype(np.int32)
            ranges = pa.ListArray.from_arrays(pa.array(offsets), pa.array(lo[begin] << 32 | hi[end]))
            yield pa.RecordBatch.from_arrays([pa.array(doc[begin][docs]), ranges], names=["doc", "ranges"])

    return joined


def _lists(places: DataFrame, gap: int) -> DataFrame:
    """The places of each text (bounded by its length) in order, those at most `gap` apart as one. Spans don't overlap."""
    lists = places.groupBy("doc").agg(F.expr("sort_array(collect_list(place)) AS places"))
    return keep(lists.mapInArrow(_joined(gap), "doc long, ranges array<long>"))


def _with_lists(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Documents with their ranges: lists of a counted size are broadcast, others meet the texts by shuffle."""
    n = lists.selectExpr("coalesce(sum(size(ranges) + 4), 0)").first()[0]
    if n <= BROADCAST_RANGES:
        return docs.join(F.broadcast(lists), "doc", how)
    return splittable_join(docs, lists, ["doc"], how)


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(`doc`, `data`) for the work and (`doc`, `doc_id`, `data`) for the result. Ids that tell rows apart
    are numbers already; else rows are written and ranked by id and text, those without an id last."""
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(coalesce(text, '') AS BINARY) AS data")
    twice = rows.groupBy("doc_id").agg(F.expr("count(*) AS n")).where("n > 1 OR doc_id IS NULL")
    if twice.isEmpty():
        return rows.selectExpr("doc_id AS doc", "data"), rows.selectExpr("doc_id AS doc", "doc_id", "data")
    held = keep(rows.selectExpr("*", "monotonically_increasing_id() AS row"))
    keys = held.selectExpr("doc_id IS NULL AS last", "doc_id", "sha2(data, 256) AS digest", "row")
    numbers = ranked(keys, ["last", "doc_id", "digest", "row"], "doc").select("row", "doc")
    whole = keep(splittable_join(held, numbers, ["row"], "inner").select("doc", "doc_id", "data"))
    return whole.select("doc", "data"), whole


def _cut(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans_out, kept = [], []
            for data, ranges in zip(batch.column("data"), batch.column("ranges").to_pylist()):
                data = data.as_py()
                removed = [{"start": x >> 32, "end": (x & 0xFFFFFFFF) + length} for x in ranges or ()]
                spans_out.append(removed)
                ends = [0, *(x["end"] for x in removed)]
                kept.append(b"".join(data[b:e] for b, e in zip(ends, [*(x["start"] for x in removed), len(data)])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(d.as_buffer()) for d in batch.column("data")], pa.int64()),
                 pa.array(spans_out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "removed", "kept"],
            )

    return cut


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """Per row of `docs` (`doc_id`, `text`): `doc_id`, `n_bytes`, `removed` and `kept`.

    Every byte that lies in a string of `length` bytes (64 at least) which also starts earlier (in a smaller id, or before
    in the same text) is removed; overlaps count, and strings are those of the input. `removed` lists
    the maximal stretches (`start`, `end` exclusive) in order, `kept` is what remains, as bytes.

    Texts are taken as UTF-8. Null and empty texts give no stretch and empty bytes, and so do texts shorter than `length`
    (their bytes are kept). Rows that repeat an id count as different documents, ordered by the digest of their texts;
    rows without an id come after all others in the same way. Other columns are ignored. No rows give no rows.
    Equal means equal fingerprints of 128 bits.
    """
    if length < 64:
        raise ValueError("strings of at least 64 bytes are compared")
    texts, whole = _numbered(docs)
    repeated, live = [], None
    for seed in (32, length * 4 // 5, length):
        asked = texts
        if live is not None:
            lists = _lists(live, 1)
            if lists.isEmpty():
                break
            asked = _with_lists(texts, lists, "inner").select("doc", "data", "ranges")
        again, live = _round(keep(asked.mapInArrow(_sample(seed, length), ROWS)))
        repeated.append(again)
    ranges = repeated[0]
    for more in repeated[1:]:
        ranges = ranges.unionAll(more)
    marked = _with_lists(whole, _lists(ranges, length), "left").select("doc_id", "data", "ranges")
    return marked.mapInArrow(_cut(length), "doc_id long, n_bytes long, removed array<struct<start: int, end: int>>, kept binary")
