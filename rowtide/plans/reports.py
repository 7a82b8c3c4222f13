"""Reports over commits and change logs. Commit tables are small; logs are only ever aggregated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rowtide.model import CHANGE_TYPE, SNAPSHOT_ID, q, quoted
from rowtide.sources.history import History

# The status of a partition in a snapshot.
ADDED = "ADDED"
DELETED = "DELETED"
EXISTING = "EXISTING"


def snapshot_listing(history: History) -> DataFrame:
    """Commits in order with their parent, kind and time."""
    return (
        history.snapshots()
        .select("snapshot_id", "parent_id", "operation", "committed_at")
        .orderBy("committed_at", "snapshot_id")
    )


def snapshot_labels(history: History) -> DataFrame:
    """S0, S1, ... in commit order. The window runs over the commits only, one record each."""
    position = "row_number() OVER (ORDER BY committed_at, snapshot_id) - 1 AS ordinal"
    return (
        history.snapshots()
        .selectExpr("snapshot_id", position)
        .selectExpr("concat('S', ordinal) AS label", "snapshot_id", "ordinal")
    )


def snapshot_summary(history: History) -> DataFrame:
    """The counters of each commit, read from its summary map."""
    counters = ["added-records", "deleted-records", "changed-partition-count", "total-records"]
    return (
        history.snapshots()
        .selectExpr(
            "snapshot_id",
            "parent_id",
            "operation",
            *[f"CAST(summary['{c}'] AS BIGINT) AS {c.replace('-', '_')}" for c in counters],
        )
        .orderBy("snapshot_id")
    )


def snapshot_ids(history: History) -> DataFrame:
    """Snapshot ids in commit order."""
    return history.snapshots().orderBy("committed_at", "snapshot_id").select("snapshot_id")


def first_and_latest(history: History) -> DataFrame:
    """First and latest snapshot id by commit time."""
    at = "struct(committed_at, snapshot_id)"
    return history.snapshots().agg(
        F.expr(f"min_by(snapshot_id, {at}) AS first_snapshot_id"),
        F.expr(f"max_by(snapshot_id, {at}) AS latest_snapshot_id"),
    )


def first_value(df: DataFrame, column: str, *order: str):
    """The column's value in the first record by `order` (default: by itself), None without records."""
    row = df.orderBy(*(order or (column,))).select(q(column)).first()
    return None if row is None else row[0]


def last_value(df: DataFrame, column: str):
    """The column's largest value."""
    return df.agg(F.max(q(column))).first()[0]


def assert_commit_count(history: History, expected: int) -> None:
    """Stop unless the history has exactly this many commits."""
    found = history.snapshots().count()
    if found != expected:
        raise ValueError(f"expected {expected} snapshots, got {found}")


def counts_by_commit(log: DataFrame) -> DataFrame:
    """Number of changes by commit and type; on a stored log this reads directory names and footers only."""
    return log.groupBy(SNAPSHOT_ID, CHANGE_TYPE).agg(F.expr("count(*) AS n"))


def counts_by_key(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of changes by key and type."""
    return changes.groupBy(*quoted(keys), CHANGE_TYPE).agg(F.expr("count(*) AS n"))


def _touched(history: History) -> tuple[DataFrame, list[str]]:
    """Partitions touched by each commit, with their rows after it and the next commit that touches them."""
    values = quoted(history.partition_by)
    last = history.commits[-1].snapshot_id if history.commits else 0
    in_order = f"OVER ({'PARTITION BY ' + ', '.join(values) if values else ''} ORDER BY snapshot_id)"
    touched = (
        history.partition_counts()
        .withColumnRenamed(SNAPSHOT_ID, "snapshot_id")
        .selectExpr(
            "*",
            f"sum(added - deleted) {in_order} AS _after",
            f"coalesce(lead(snapshot_id) {in_order}, {last + 1}) AS _until",
        )
    )
    return touched, values


_HAD, _HAS = "_after - added + deleted > 0", "_after > 0"


def partition_entries(history: History) -> DataFrame:
    """One record per snapshot, partition value and status.

    A partition touched by a commit is DELETED if it had rows before and ADDED
    if it has rows after; an untouched one with rows is EXISTING. Computed from
    the stored per-commit counts, so the log itself is not read.
    """
    touched, values = _touched(history)
    status = f"array_compact(array(IF({_HAD}, '{DELETED}', NULL), IF({_HAS}, '{ADDED}', NULL)))"
    changed = touched.selectExpr("snapshot_id", *values, f"explode({status}) AS status")
    kept = touched.where(f"{_HAS} AND _until > snapshot_id + 1").selectExpr(
        "explode(sequence(snapshot_id + 1, _until - 1)) AS snapshot_id", *values, f"'{EXISTING}' AS status"
    )
    return changed.unionAll(kept)


def entry_counts(history: History) -> DataFrame:
    """Number of partition entries by snapshot and status.

    Untouched partitions are counted, not listed: those with rows before a commit less those it touched.
    The window runs over one record per commit.
    """
    touched, _ = _touched(history)
    per_commit = touched.groupBy("snapshot_id").agg(F.expr(f"count_if({_HAD}) AS had"), F.expr(f"count_if({_HAS}) AS has"))
    before = "coalesce(sum(has - had) OVER (ORDER BY snapshot_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    pairs = [(DELETED, "had"), (ADDED, "has"), (EXISTING, "_live - had")]
    counts = f"array({', '.join(f"struct('{s}' AS status, {n} AS cnt)" for s, n in pairs)})"
    return (
        per_commit.selectExpr("*", f"{before} AS _live")
        .selectExpr("snapshot_id", f"inline({counts})")
        .where("cnt > 0")
        .orderBy("snapshot_id", "status")
    )
