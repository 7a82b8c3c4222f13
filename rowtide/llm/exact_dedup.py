"""Exact duplicates by a minimal perfect hash over the digests of earlier documents.

The distinct digests of the history are dealt into parts by their leading bits.
Each part is a minimal perfect hash of its own: level by level, every digest that
falls alone on a position of a bit array is placed, the others go on to the next
level, and the slot of a digest is the number of set bits before its own. A slot
holds the full digest, the winner's id and the number of copies. A digest that is
not a member may still point at a slot, so the slot's digest is compared byte by
byte; hits are repeats of the history, the rest are groups of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import fresh, join_small, keep, parts_for
from rowtide.model import quoted
from rowtide.operators.rows import splittable_join

# Digests in a part of the index: a part is a row of about 1.5 MB.
PART_DIGESTS = 1 << 15

# Positions of a level for each digest that is left.
GAMMA = 2.0

WHITE = r"[\x20\x09-\x0D]+"

INDEX = "part int, n int, sizes array<int>, bits binary, digests binary, winners binary, copies binary"
GROUPS = "digest binary, keep_id long, group_size long"


def text_digest(text: str = "text") -> str:
    """SQL of the SHA-256 of a text with white space runs as single spaces; null counts as empty."""
    return rf"unhex(sha2(regexp_replace(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+', ' '), 256))"


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys[:, level % 4] ^ (keys[:, (level + 1) % 4] + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def build_hash(digests: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, the bits of all levels, and the slot of each (distinct) digest."""
    keys = _words(digests)
    left = np.arange(len(keys))
    sizes: list[int] = []
    levels: list[np.ndarray] = []
    where = np.zeros(len(keys), dtype=np.int64)
    begin = 0
    with np.errstate(over="ignore"):
        while len(left):
            size = max(64, int(GAMMA * len(left)))
            at = (_hash(keys[left], len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            placed = alone[at]
            where[left[placed]] = begin + at[placed]
            levels.append(alone)
            sizes.append(size)
            begin += size
            left = left[~placed]
    bits = np.concatenate(levels) if levels else np.zeros(0, dtype=bool)
    return sizes, bits, (np.cumsum(bits) - 1)[where] if len(keys) else where


def find_slots(sizes: list[int], bits: np.ndarray, digests: list[bytes]) -> np.ndarray:
    """The slot each digest points at, -1 for none. Members get their own; others may get any."""
    keys = _words(digests)
    slots = np.full(len(keys), -1, dtype=np.int64)
    ranks = np.cumsum(bits) - 1
    left = np.arange(len(keys))
    begin = 0
    with np.errstate(over="ignore"):
        for level, size in enumerate(sizes):
            at = begin + (_hash(keys[left], level) % np.uint64(size)).astype(np.int64)
            hit = bits[at]
            slots[left[hit]] = ranks[at[hit]]
            left = left[~hit]
            begin += size
    return slots


def _build(part: pd.DataFrame) -> pd.DataFrame:
    digests = list(part["digest"])
    sizes, bits, slots = build_hash(digests)
    n = len(digests)
    held = np.empty((n, 4), dtype="<u8")
    held[slots] = _words(digests)
    winners, copies = np.empty(n, dtype="<i8"), np.empty(n, dtype="<i8")
    winners[slots] = part["winner"]
    copies[slots] = part["copies"]
    row = (part["part"].iloc[0], n, sizes, np.packbits(bits).tobytes(), held.tobytes(), winners.tobytes(), copies.tobytes())
    return pd.DataFrame([row], columns=["part", "n", "sizes", "bits", "digests", "winners", "copies"])


def _part(parts: int) -> str:
    return f"CAST(pmod(conv(substr(hex(digest), 1, 8), 16, 10), {parts}) AS INT) AS part"


def build_index(history: DataFrame, parts: int) -> DataFrame:
    """One row per part from the distinct digests (`digest`, `winner`, `copies`) of the history."""
    return history.selectExpr("digest", "winner", "copies", _part(parts)).groupBy("part").applyInPandas(_build, INDEX)


def _look_up(index: pd.DataFrame, arrivals: pd.DataFrame) -> pd.DataFrame:
    held, winners, copies = np.zeros((0, 4), dtype="<u8"), np.zeros(0, dtype="<i8"), np.zeros(0, dtype="<i8")
    asked = list(arrivals["digest"])
    slots = np.full(len(asked), -1, dtype=np.int64)
    words = _words(asked)
    if len(index):
        row = index.iloc[0]
        held = np.frombuffer(row["digests"], dtype="<u8").reshape(-1, 4)
        winners = np.frombuffer(row["winners"], dtype="<i8").copy()
        copies = np.frombuffer(row["copies"], dtype="<i8").copy()
        sizes = [int(x) for x in row["sizes"]]
        bits = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8))[: sum(sizes)].astype(bool)
        slots = find_slots(sizes, bits, asked)
        seen = slots >= 0
        slots[seen] = np.where((held[slots[seen]] == words[seen]).all(axis=1), slots[seen], -1)
    hit = slots >= 0
    least, more = arrivals["winner"].astype("Int64"), arrivals["copies"].to_numpy(dtype="<i8")
    ids = least[hit].fillna(np.iinfo(np.int64).max).to_numpy(dtype="<i8")
    winners[slots[hit]] = np.minimum(winners[slots[hit]], ids)
    copies[slots[hit]] += more[hit]
    members = pd.DataFrame({"digest": [x.tobytes() for x in held], "keep_id": pd.array(winners, "Int64"), "group_size": copies})
    new = pd.DataFrame(
        {"digest": [d for d, h in zip(asked, hit) if not h], "keep_id": least[~hit].array, "group_size": more[~hit]}
    )
    return pd.concat([members, new], ignore_index=True)


def look_up(index: DataFrame, arrivals: DataFrame, parts: int) -> DataFrame:
    """All groups (`digest`, `keep_id`, `group_size`) after the arrivals' distinct digests met the index."""
    dealt = arrivals.selectExpr("digest", "winner", "copies", _part(parts))
    return index.groupBy("part").cogroup(dealt.groupBy("part")).applyInPandas(_look_up, GROUPS)


def _distinct(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.expr("min(doc_id) AS winner"), F.expr("count(*) AS copies"))


def exact_groups(rows: DataFrame, history: str) -> DataFrame:
    """Groups of equal digests of `rows` (`doc_id`, `digest`); `history` (SQL) says which rows came earlier.

    Equal digests are added up per task before any shuffle, so a digest that makes
    up a third of all rows is one record per task. Rows without an id are arrivals.
    """
    earlier = keep(_distinct(rows.where(f"doc_id IS NOT NULL AND ({history})")))
    arrivals = keep(_distinct(rows.where(f"doc_id IS NULL OR NOT coalesce({history}, FALSE)")))
    parts = parts_for(max(earlier.count(), arrivals.count()), PART_DIGESTS)
    index = keep(build_index(earlier, parts))
    return look_up(index, arrivals, parts)


def _older_half(rows: DataFrame) -> str:
    low, high = rows.selectExpr("min(doc_id)", "max(doc_id)").first()
    return "FALSE" if low is None else f"doc_id <= {low + (high - low) // 2}"


def exact_dedup(docs: DataFrame, history: str | None = None) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256`.

    `history` is an SQL predicate on `doc_id` for the documents that were there
    before; without it, the lower half of the range of ids. The result does not
    depend on it. A null text counts as empty. A null id never stays while its
    group has another; a group of null ids only has a null `keep_id`, and its rows
    stay. Rows that repeat an id with an equal text are one document and bear the
    same mark. Other columns are ignored. No rows give no rows.
    """
    rows = keep(docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", f"{text_digest()} AS digest"))
    groups = keep(exact_groups(rows, history or _older_half(rows)))
    return splittable_join(rows, groups, ["digest"], "left").selectExpr(
        "doc_id", "keep_id", "group_size", "doc_id <=> keep_id AS kept", "lower(hex(digest)) AS text_sha256"
    )


def drop_copies(docs: DataFrame, history: str | None = None) -> DataFrame:
    """The rows of `docs` that stay, whole; of rows that repeat an id with an equal text, any one."""
    marks = keep(exact_dedup(docs, history))
    key = fresh(docs, "_id", "_digest")
    named = "coalesce(CAST(doc_id AS STRING), '') AS {}".format(key[0])
    keyed = docs.selectExpr("*", named, f"{text_digest()} AS {key[1]}")
    marked = marks.selectExpr(named, f"unhex(text_sha256) AS {key[1]}", "kept")
    left = join_small(keyed, marked.where("NOT kept").drop("kept").distinct(), key, "left_anti")
    twins = keep(marked.where("kept").groupBy(*key).agg(F.expr("count(*) AS n")).where("n > 1").drop("n"))
    if twins.isEmpty():
        return left.select(*quoted(docs.columns))
    once = join_small(left, twins, key, "left_semi").dropDuplicates(key)
    return join_small(left, twins, key, "left_anti").unionByName(once).select(*quoted(docs.columns))
