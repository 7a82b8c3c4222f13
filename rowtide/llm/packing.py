"""Best-fit packing of tokenised documents into sequences, by linear grouping.

A plan is made for the counts of the piece lengths alone, which are as many as a
sequence has tokens, however many documents there are: large lengths are rounded up to the
largest of their group (groups of equal cardinality), the few sizes left are packed by
the configuration program (column generation), the actual lengths take the places of the
rounded ones, and what is left, the small pieces last, goes where it fits best. The
plan says which places the pieces of a length take, by rank; the pieces are then
ranked within their length, in slices, and look up their places.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from rowtide.llm.common import join_small, keep, without

# Sizes that large lengths are rounded to, and the share of a sequence up to which a piece is small.
GROUPS = 96
SMALL_SHARE = 1 / 4

# Pieces of one length are ranked in slices of about so many rows.
SLICE_ROWS = 4096
MOST_SLICES = 1 << 16

PIECES = "array<struct<piece: int, start: long, length: int, ids: binary>>"
CHECKED_PIECES = "array<struct<piece: int, start: long, length: int, ids_crc32: long>>"


# -- tokens -----------------------------------------------------------------------------------------------


class Codec:
    """Where the two files of a byte-level BPE vocabulary lie: its ranks, and the tokenizer with its special tokens."""

    def __init__(self, ranks: str, pattern: str, tokenizer: str, special: str = "<|endoftext|>"):
        self.ranks, self.pattern, self.tokenizer, self.special = ranks, pattern, tokenizer, special

    @property
    def key(self) -> tuple[str, str, str, str]:
        return self.ranks, self.pattern, self.tokenizer, self.special


def public_codec() -> Codec:
    """The 50,257-token byte-level vocabulary among the public files."""
    import public_tokenizers

    at = public_tokenizers.path
    return Codec(at("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, at("byte_bpe_50k.json"))


@lru_cache(maxsize=4)
def _encoder(ranks: str, pattern: str, tokenizer: str, special: str):
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
    whole: list[Tokenizer] = []

    def encode(text: str) -> list[int]:
        # The ranks are those of the tokenizer's own model; only it knows the special token.
        if special not in text:
            return fast.encode_ordinary(text)
        if not whole:
            whole.append(Tokenizer.from_file(tokenizer))
        return whole[0].encode(text, add_special_tokens=False).ids

    return encode


def tokenise(docs: DataFrame, codec: Codec, capacity: int = 1024, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """One row per piece: the columns of `docs` but `text`, and `piece`, `start`, `length`, `ids`.

    A document's ids are those of its text (null: none) and `end_id`. Only those with more than `capacity` are
    cut: all pieces have `capacity` ids but the first, which may be shorter. `ids` are
    little-endian unsigned 32-bit numbers; without `with_ids`, `ids_crc32` takes their place and no ids are held
    beyond a text's own. Columns with these names are replaced.
    """
    key = codec.key
    content = "ids" if with_ids else "ids_crc32"

    def cut(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _encoder(*key)
        for batch in texts:
            ids, checks, piece, start, length, ends = [], [], [], [], [], [0]
            for text in batch:
                one = np.array(encode(text.as_py() or "") + [end_id], dtype="<u4")
                first = len(one) % capacity or capacity
                starts = [0, *range(first, len(one), capacity)]
                if with_ids:
                    ids.append(one)
                else:
                    checks += [zlib.crc32(one[a:b]) for a, b in zip(starts, [*starts[1:], len(one)])]
                piece += range(len(starts))
                start += starts
                length += [first] + [capacity] * (len(starts) - 1)
                ends.append(len(piece))
            if with_ids:
                flat = np.concatenate(ids) if ids else np.zeros(0, dtype="<u4")
                places = np.concatenate([[0], np.cumsum(length)]).astype(np.int64) * 4
                if places[-1] >= 1 << 31:
                    raise ValueError("the ids of one Arrow batch exceed 2 GB: lower spark.sql.execution.arrow.maxRecordsPerBatch")
                own = pa.Array.from_buffers(pa.binary(), len(piece), [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(flat)])
            else:
                own = pa.array(checks, pa.int64())
            columns = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()), own]
            pieces = pa.StructArray.from_arrays(columns, ["piece", "start", "length", content])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces)

    pieces = F.arrow_udf(cut, PIECES if with_ids else CHECKED_PIECES)
    own = without(docs, "piece", "start", "length", content, "_piece")
    return own.withColumn("_piece", F.explode(pieces("text"))).select(
        *[F.col(f"`{c}`") for c in own.columns if c != "text"], "_piece.*"
    )


# -- the plan ---------------------------------------------------------------------------------------------


def linear_groups(counts: Mapping[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """Rounded size and the actual [length, count] of each group, all of (nearly) equal cardinality, largest first."""
    each = -(-sum(counts.values()) // groups)
    found: list[tuple[int, list[list[int]]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                found.append((length, []))
                room = each
            taken = min(left, room)
            found[-1][1].append([length, taken])
            left, room = left - taken, room - taken
    merged: dict[int, list[list[int]]] = defaultdict(list)
    for size, held in found:  # groups of one and the same length are one
        merged[size] += held
    return list(merged.items())


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    sizes_up, values_up = sizes[order], values[order]
    fit = np.searchsorted(sizes_up, np.arange(capacity + 1), side="right")
    for c in range(int(sizes_up[0]), capacity + 1):
        n = fit[c]
        gains = best[c - sizes_up[:n]] + values_up[:n]
        i = int(gains.argmax())
        if gains[i] > best[c - 1] + 1e-12:
            best[c], choice[c] = gains[i], order[i]
        else:
            best[c] = best[c - 1]
    taken, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            taken[choice[c]] += 1
            c -= int(sizes[choice[c]])
    return float(best[capacity]), taken


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often each is used, by the linear program and column generation."""
    width, need = np.array(sizes), np.array(demand, dtype=float)
    basis = np.diag(capacity // width).astype(float)
    inverse = np.linalg.inv(basis)
    use = inverse @ need
    for _ in range(60 * len(sizes)):
        prices = inverse.sum(axis=0)
        worth, column = _knapsack(width, np.maximum(prices, 0), capacity)
        if worth <= 1 + 1e-7:
            break
        move = inverse @ column
        ratio = np.where(move > 1e-9, use / np.where(move > 1e-9, move, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
        inverse = np.linalg.inv(basis)
        use = np.maximum(inverse @ need, 0)
    return [(basis[:, i], float(use[i])) for i in range(len(sizes))]


class _Runs:
    """Equal sequences under construction: how many, and the lengths in each; by free room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[int] = []
        self.by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)

    def add(self, count: int, lengths: tuple[int, ...]) -> None:
        if count:
            room = self.capacity - sum(lengths)
            if not self.by_room[room]:
                insort(self.rooms, room)
            self.by_room[room].append((count, lengths))

    def place(self, length: int, count: int) -> None:
        """Best fit: the sequences with the least room that is enough, each filled before the next; then new ones."""
        while count:
            i = bisect_left(self.rooms, length)
            if i == len(self.rooms):
                each = self.capacity // length
                self.add(count // each, (length,) * each)
                if count % each:
                    self.add(1, (length,) * (count % each))
                return
            room = self.rooms[i]
            many, lengths = self.by_room[room].pop()
            if not self.by_room[room]:
                self.rooms.pop(i)
            each = room // length
            full = min(many, count // each)
            self.add(full, lengths + (length,) * each)
            count -= full * each
            rest = many - full
            if rest and count:  # fewer than `each` are left: they go into one more sequence
                self.add(1, lengths + (length,) * count)
                rest, count = rest - 1, 0
            self.add(rest, lengths)

    def all(self) -> Iterator[tuple[int, tuple[int, ...]]]:
        for room in self.rooms:
            yield from self.by_room[room]


def _take(held: list[list[int]], count: int) -> list[tuple[int, int]]:
    """The first `count` pieces of a group as (length, count); the group is used up."""
    taken = []
    while count and held:
        n = min(count, held[0][1])
        taken.append((held[0][0], n))
        held[0][1] -= n
        count -= n
        if not held[0][1]:
            held.pop(0)
    return taken


def plan_runs(counts: Mapping[int, int], capacity: int, groups: int = GROUPS) -> list[tuple[int, tuple[int, ...]]]:
    """Sequences for so many pieces of each length, as (how many, lengths in each)."""
    counts = {int(k): int(n) for k, n in counts.items() if n}
    runs = _Runs(capacity)
    runs.add(counts.pop(capacity, 0), (capacity,))
    large = {k: n for k, n in counts.items() if k > SMALL_SHARE * capacity}
    if large:
        grouped = linear_groups(large, groups)
        held = [h for _, h in grouped]
        demand = [sum(n for _, n in h) for h in held]
        for column, use in sorted(configurations([s for s, _ in grouped], demand, capacity), key=lambda c: -c[0].sum()):
            copies = int(use + 1e-6)
            slots = [_take(held[g], copies) for g in np.flatnonzero(column) for _ in range(int(column[g]))]
            _substitute(runs, copies, slots)
        for h in held:  # what rounding down left over, longest first
            for length, n in h:
                runs.place(length, n)
    for length in sorted((k for k in counts if k not in large), reverse=True):
        runs.place(length, counts[length])
    return list(runs.all())


def _substitute(runs: _Runs, copies: int, slots: list[list[tuple[int, int]]]) -> None:
    """Cut `copies` equal configurations where the actual length in any slot changes."""
    ends = {copies} if slots else set()
    spans = []
    for slot in slots:
        at, span = 0, []
        for length, n in slot:
            at += n
            span.append((at, length))
            ends.add(min(at, copies))
        spans.append(span)
    at = 0
    for end in sorted(ends):
        lengths = tuple(next((length for stop, length in span if stop > at), 0) for span in spans)
        runs.add(end - at, tuple(x for x in lengths if x))
        at = end


class Plan:
    """For each length: from which rank on its pieces go to which sequence and offset."""

    def __init__(self, counts: Mapping[int, int], capacity: int):
        self.capacity, self.sequences = capacity, 0
        ranks: dict[int, int] = defaultdict(int)
        rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for many, lengths in plan_runs(counts, capacity):
            offset = 0
            for length in lengths:
                rows[length].append((ranks[length], self.sequences, offset))
                ranks[length] += many
                offset += length
            self.sequences += many
        if any(ranks[k] != n for k, n in counts.items()):
            raise AssertionError("the plan has other pieces than the table")
        self.rows = {k: np.array(v, dtype=np.int64) for k, v in rows.items()}

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), dtype=np.int64), np.empty(len(length), dtype=np.int64)
        for k in np.unique(length):
            mine = np.flatnonzero(length == k)
            row = self.rows[int(k)][np.searchsorted(self.rows[int(k)][:, 0], rank[mine], side="right") - 1]
            sequence[mine] = row[:, 1] + rank[mine] - row[:, 0]
            offset[mine] = row[:, 2]
        return sequence, offset


# -- placing ----------------------------------------------------------------------------------------------


def place(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`: no sequence holds more than `capacity`, none has a gap.

    `pieces` should be a written table; it has `length` (1 to `capacity`) and any other columns, which are kept.
    The driver gets the count of each length and makes the plan; rows are ranked within slices of a
    length. Equal rows may change places with each other. No rows give no rows.
    """
    columns = [F.col(f"`{c}`") for c in pieces.columns if c.lower() not in ("sequence_id", "offset", "_slice", "_rank")]
    pieces = pieces.select(*columns)
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.expr("count(*) AS n")).collect()}
    total = sum(counts.values())
    slices = max(1, min(MOST_SLICES, total // SLICE_ROWS))
    plan = pieces.sparkSession.sparkContext.broadcast(Plan(counts, capacity))
    names = [f"`{c}`" for c in pieces.columns]
    sliced = pieces.selectExpr("*", f"CAST(pmod(xxhash64({', '.join(names)}), {slices}) AS INT) AS _slice")
    before = keep(
        sliced.groupBy("length", "_slice")
        .agg(F.expr("count(*) AS _n"))
        .selectExpr("length", "_slice", "sum(_n) OVER (PARTITION BY length ORDER BY _slice) - _n AS _before")
    )
    in_slice = Window.partitionBy("length", "_slice").orderBy(*[F.col(c) for c in names])
    ranked = join_small(
        sliced.withColumn("_rank", F.row_number().over(in_slice)), before, ["length", "_slice"], "inner"
    ).withColumn("_rank", F.expr("_before + _rank - 1"))

    def look_up(length: pa.Array, rank: pa.Array) -> pa.Array:
        sequence, offset = plan.value.places(length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    found = F.arrow_udf(look_up, "sequence_id long, offset long")
    return ranked.withColumn("_place", found("length", "_rank")).select(*[F.col(c) for c in names], "_place.*")


def pack(docs: DataFrame, codec: Codec, capacity: int = 1024, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """One row per piece of `docs` (`doc_id`, `text`): `doc_id`, `piece`, `start`, `length`, `ids_crc32`, `ids`,
    `sequence_id`, `offset`. Null texts count as empty and are a piece of one id; null and repeated doc_ids are
    packed like any other. Without `with_ids` the ids are left out, and nothing but numbers is moved.
    """
    pieces = tokenise(docs.select("doc_id", "text"), codec, capacity, end_id, with_ids)
    content = ["crc32(ids) AS ids_crc32", "ids"] if with_ids else ["ids_crc32"]
    kept = ["doc_id", "piece", "start", "CAST(length AS BIGINT) AS length", *content]
    return place(keep(pieces.selectExpr(*kept)), capacity)
