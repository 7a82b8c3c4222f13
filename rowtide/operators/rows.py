"""Signed row multisets: the arithmetic under diffs, versions and net changes.

A row is identified by all of its columns, nulls included, so grouping does the
comparing and no join ever matches rows by value. Equal rows collapse in the
map-side half of the aggregation, so a row that makes up a third of the data
reaches the shuffle as one record per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from rowtide.model import (
    CHANGE_ORDINAL,
    CHANGE_TYPE,
    SNAPSHOT_ID,
    change_type_of,
    quoted,
    row_columns,
    signed,
)

# One task writes at most this many copies of one row; the rest are spread over other tasks.
COPIES_PER_TASK = 1 << 20

# At most this many 8-byte hashes of rows or keys are broadcast.
BROADCAST_HASHES = 1_000_000

# Up to this many commits, a row's changes are one sum per commit inside a single aggregation.
INLINE_COMMITS = 16

Commits = Sequence[tuple[int, int]]


def row_balance(log: DataFrame, name: str = "_balance") -> DataFrame:
    """One record per distinct row with the sum of its signed changes, zero sums dropped."""
    rows = quoted(row_columns(log))
    return log.groupBy(*rows).agg(F.expr(f"sum({signed(log)}) AS {name}")).where(f"{name} != 0")


def repeat_rows(df: DataFrame, copies: str, at_most: int | None = None) -> DataFrame:
    """Each record `copies` times (records with fewer than one copy vanish), without that column.

    Ordinary records are unfolded where they are. A record with more than
    `COPIES_PER_TASK` copies is first cut into chunks which are then shuffled, so
    that no task has to write out a hot row alone. Adaptive execution drops that
    branch when it is empty, and a known bound `at_most` can rule it out.
    """
    rest = quoted(c for c in df.columns if c != copies)
    few = df.where(f"{copies} >= 1")
    if at_most is None or at_most > COPIES_PER_TASK:
        few = few.where(f"{copies} <= {COPIES_PER_TASK}")
    few = few.selectExpr(*rest, f"explode(array_repeat(TRUE, CAST({copies} AS INT))) AS _copy").drop("_copy")
    if at_most is not None and at_most <= COPIES_PER_TASK:
        return few
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk = f"least({COPIES_PER_TASK}, {copies} - _chunk * {COPIES_PER_TASK})"
    many = (
        df.where(f"{copies} > {COPIES_PER_TASK}")
        .selectExpr(*rest, copies, f"explode(sequence(0L, ({copies} - 1) DIV {COPIES_PER_TASK})) AS _chunk")
        .repartition(tasks, *rest, "_chunk")
        .selectExpr(*rest, f"explode(array_repeat(TRUE, CAST({chunk} AS INT))) AS _copy")
        .drop("_copy")
    )
    return few.unionAll(many)


def split_untouched(log: DataFrame, rare: str) -> tuple[DataFrame, DataFrame]:
    """Split a log by a change type that few rows have: changes nothing can cancel, and the others.

    8-byte hashes of the rare changes' rows are broadcast, so the caller must
    know their number. A hash met by chance only sends a row the longer way.
    """
    row_hash = f"xxhash64({', '.join(quoted(row_columns(log)))})"
    few = log.where(f"{CHANGE_TYPE} = '{rare}'")
    many = log.where(f"{CHANGE_TYPE} <> '{rare}'")
    hashes = F.broadcast(few.selectExpr(f"{row_hash} AS _hash"))
    met = F.expr(f"{row_hash} = _hash")
    return many.join(hashes, met, "left_anti"), many.join(hashes, met, "left_semi").unionAll(few)


def splittable_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join whose shuffled sides adaptive execution may split where a key is hot.

    It only splits a join that shuffles both sides itself. A side that was just
    grouped by the keys would be taken as it is, so a hash of the keys joins
    the condition; the grouped side, which is thin, is then shuffled once more.
    """
    key_hash = f"xxhash64({', '.join(quoted(on))}) AS _key_hash"
    joined = left.selectExpr("*", key_hash).join(right.selectExpr("*", key_hash), [*on, "_key_hash"], how)
    return joined.drop("_key_hash")


def diff_states(before: DataFrame, after: DataFrame) -> DataFrame:
    """Change rows that turn `before` into `after`: one shuffle for both directions."""
    rows = quoted(before.columns)
    signed = before.selectExpr(*rows, "-1 AS _n").unionByName(after.selectExpr(*rows, "1 AS _n"))
    net = signed.groupBy(*rows).agg(F.expr("sum(_n) AS _n")).where("_n != 0")
    return repeat_rows(net.selectExpr(f"{change_type_of('_n')} AS {CHANGE_TYPE}", *rows, "abs(_n) AS _n"), "_n")


def cancelled(changes: DataFrame) -> DataFrame:
    """Change rows of one commit without those that undo each other."""
    rows = quoted(row_columns(changes))
    net = row_balance(changes, "_n").selectExpr(f"{change_type_of('_n')} AS {CHANGE_TYPE}", *rows, "abs(_n) AS _n")
    return repeat_rows(net, "_n")


def inlined(commits: Commits | None) -> bool:
    return commits is not None and 0 < len(commits) <= INLINE_COMMITS


def sum_names(commits: Commits) -> list[str]:
    return [f"_n{i}" for i in range(len(commits))]


def commit_sums(log: DataFrame, commits: Commits) -> DataFrame:
    """One record per distinct row, its signed count in each commit as `_n0`, `_n1`, ...: one shuffle."""
    sums = [
        F.expr(f"coalesce(sum(IF({SNAPSHOT_ID} = {snapshot_id}, {signed(log)}, 0)), 0) AS _n{i}")
        for i, (_, snapshot_id) in enumerate(commits)
    ]
    return log.groupBy(*quoted(row_columns(log))).agg(*sums)


def commit_counts(log: DataFrame) -> DataFrame:
    """One record per distinct row and commit with its signed count `_n`: for windows of many commits."""
    keys = [*quoted(row_columns(log)), CHANGE_ORDINAL, SNAPSHOT_ID]
    return log.groupBy(*keys).agg(F.expr(f"sum({signed(log)}) AS _n")).where("_n != 0")


def last_changes_of_sums(
    sums: DataFrame, commits: Commits, first: str | None = None, last: str | None = None
) -> DataFrame:
    """The last |balance| changes of the balance's sign, from `commit_sums`: plain arithmetic, no shuffle.

    With `first` and `last` (SQL text), only commits with an ordinal between
    them count, and ordinals are given from `first` on. Adds `_sign`,
    `_ordinal`, `_snapshot_id` and `_copies`, one record per commit with
    something left.
    """
    names = sum_names(commits)
    kept = quoted(c for c in sums.columns if c not in names)
    start = "0" if first is None else first
    if first is not None:
        inside = [f"IF({o} BETWEEN {first} AND {last}, {n}, 0) AS {n}" for n, (o, _) in zip(names, commits)]
        sums = sums.selectExpr(*kept, *inside)
    same = (
        sums.selectExpr("*", f"{' + '.join(names)} AS _balance")
        .where("_balance != 0")
        .selectExpr(
            *kept,
            "IF(_balance > 0, 1, -1) AS _sign",
            "abs(_balance) AS _balance",
            *[f"greatest(IF(_balance > 0, {n}, -{n}), 0) AS {n}" for n in names],
        )
    )
    changes = []
    for i, (ordinal, snapshot_id) in enumerate(commits):
        left = " - ".join(["_balance", *names[i + 1 :]])
        changes.append(
            f"struct({ordinal} - {start} AS ordinal, {snapshot_id}L AS snapshot_id, "
            f"greatest(least({names[i]}, {left}), 0) AS copies)"
        )
    return (
        same.selectExpr(*kept, "_sign", f"explode(array({', '.join(changes)})) AS _change")
        .where("_change.copies > 0")
        .selectExpr(
            *kept,
            "_sign",
            "_change.ordinal AS _ordinal",
            "_change.snapshot_id AS _snapshot_id",
            "_change.copies AS _copies",
        )
    )


def last_changes_of_counts(counts: DataFrame, *within: str) -> DataFrame:
    """The same from `commit_counts`. A group is one row, at most one record per commit."""
    rows = quoted(c for c in row_columns(counts) if c != "_n")
    group = ", ".join(quoted(dict.fromkeys([*within, *(c for c in row_columns(counts) if c != "_n")])))
    return (
        counts.selectExpr("*", f"sum(_n) OVER (PARTITION BY {group}) AS _balance")
        .where("_balance != 0")
        .selectExpr("*", "IF(signum(_n) = signum(_balance), abs(_n), 0) AS _same")
        .selectExpr(
            "*", f"sum(_same) OVER (PARTITION BY {group} ORDER BY {CHANGE_ORDINAL} DESC) - _same AS _later"
        )
        .selectExpr(
            *rows,
            "IF(_balance > 0, 1, -1) AS _sign",
            f"{CHANGE_ORDINAL} AS _ordinal",
            f"{SNAPSHOT_ID} AS _snapshot_id",
            "least(_same, abs(_balance) - _later) AS _copies",
        )
        .where("_copies > 0")
    )


def as_change_rows(left: DataFrame, columns: Sequence[str], at_most: int | None = None) -> DataFrame:
    """Counted changes (`_sign`, `_ordinal`, `_snapshot_id`, `_copies`) as change rows with these columns."""
    texts = {
        CHANGE_TYPE: f"{change_type_of('_sign')} AS {CHANGE_TYPE}",
        CHANGE_ORDINAL: f"CAST(_ordinal AS INT) AS {CHANGE_ORDINAL}",
        SNAPSHOT_ID: f"_snapshot_id AS {SNAPSHOT_ID}",
    }
    counted = left.selectExpr(*[texts.get(c) or quoted([c])[0] for c in columns], "_copies")
    return repeat_rows(counted, "_copies", at_most)


def as_change_rows_of(
    counted: DataFrame,
    most: Callable[[int], str],
    left_of: Callable[[DataFrame], DataFrame],
    columns: Sequence[str],
    at_most: int | None = None,
) -> DataFrame:
    """The change rows that `left_of` makes of counted rows, where it gives a row no more copies than it has changes in one commit.

    `most` gives SQL text that tells whether a row has more changes in a commit than a number. Only those rows
    can have copies to be shuffled, so the others are worked out once and not looked through for them again.
    """
    if at_most is not None and at_most <= COPIES_PER_TASK:
        return as_change_rows(left_of(counted), columns, at_most)
    hot = most(COPIES_PER_TASK)
    usual = as_change_rows(left_of(counted.where(f"NOT ({hot})")), columns, COPIES_PER_TASK)
    return usual.unionAll(as_change_rows(left_of(counted.where(hot)), columns))
