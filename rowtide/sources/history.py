"""A stored history: append-only change rows in Parquet, and small tables about the commits.

    <path>/table/                                         schema, keys, partition columns
    <path>/changes/_commit_snapshot_id=K/_attempt=A/_change_type=T/<partition>=v/   change rows
    <path>/partitions/_commit_snapshot_id=K/_attempt=A/   rows added and deleted per partition value
    <path>/snapshots/                                     one row per commit
    <path>/states/_commit_snapshot_id=K/                  full rows of a version, optional
    <path>/states_written/                                which versions are stored

A history without `directories` has no `<partition>=v/` below the change type: partition values share files, which are sorted by them,
so that the number of files follows the amount of data where values are many. Row groups of other values needn't be read.

A history with `buckets` keeps its changes and stored versions in one bucketed Parquet table: a record per distinct row and change
type of a commit, with the number of its copies, in buckets of a hash of the row. Versions and net changes then add up without a
shuffle, and versions are stored by themselves when changes pile up. The table is known to the session's catalog by a name of its own.

Snapshot ids are consecutive, so a commit's ordinal is its id minus one. Every try to
commit writes into directories of its own. The row in `snapshots` is written last, names
the try, and is what makes a commit visible: readers open only the directories
that it names, and nothing is ever written there again. There is one writer at a time; a
handle that does not know of the latest commit is refused before it writes, and when two
writers list the same snapshot id all the same, every later read says so.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from rowtide.model import (
    CHANGE_ORDINAL,
    CHANGE_TYPE,
    COPIES,
    DELETE,
    INSERT,
    METADATA_FIELDS,
    SNAPSHOT_ID,
    SNAPSHOT_SCHEMA,
    conform,
    q,
    quoted,
    resolve,
)
from rowtide.operators import dml
from rowtide.operators.changelog import label_updates, net_changes, net_changes_by_key
from rowtide.operators.rows import BROADCAST_HASHES, cancelled, diff_states, repeat_rows, row_balance, split_untouched
from rowtide.operators.windows import changelog_windows, window_matrix

# Partition values are kept as directory names; these types survive that unchanged.
PARTITION_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, T.BooleanType)


# The directory level of one try to commit; in a bucketed history, the names of those that store a version begin like this.
ATTEMPT = "_attempt"
STORED = "stored"

ROW_HASH = "_row_hash"

# Fixed value: the directory name that stands for null. Longer names than that fail in most file systems, escaped or not.
NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"
MOST_VALUE_BYTES = 70

# A task sorts and writes about so many rows at most, where their number is known. Bytes say little: equal rows shrink to next to nothing in a shuffle.
ROWS_PER_TASK = 1 << 22

# Ranges of a key that equal rows of one key are dealt to.
DEALS = 64

STATES_SCHEMA = T.StructType([T.StructField("snapshot_id", T.LongType()), T.StructField("attempt", T.StringType())])


@dataclass(frozen=True)
class Commit:
    snapshot_id: int
    ordinal: int
    added: int
    deleted: int
    attempt: str


@dataclass
class History:
    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    partition_by: list[str]
    commits: list[Commit] = field(default_factory=list)
    buckets: int = 0
    directories: bool = True

    # -- lifecycle ---------------------------------------------------------

    @staticmethod
    def create(
        spark: SparkSession,
        path: str,
        schema: T.StructType | str,
        keys: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        buckets: int = 0,
        directories: bool = True,
    ) -> History:
        """Declare a table: column types, key columns, partition columns, and buckets, if it is to have any.

        `directories` is false where partition values are many and have few rows each in a commit: they then share files.
        """
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
        names = schema.fieldNames()
        reserved = [n for n in names if n.startswith("_")]
        if reserved:
            raise ValueError(f"column names starting with an underscore are reserved: {reserved}")
        unknown = [c for c in [*keys, *partition_by] if c not in names]
        if unknown:
            raise ValueError(f"no such columns: {unknown}")
        maps = [f.name for f in schema if _has_map(f.dataType)]
        if maps:
            raise ValueError(f"map columns cannot be compared, store sorted entry arrays instead: {maps}")
        bad = [c for c in partition_by if not isinstance(schema[c].dataType, PARTITION_TYPES)]
        if bad:
            raise ValueError(f"columns of these types cannot partition a table: {bad}")
        table = spark.range(1).select(
            F.lit(schema.json()).alias("schema"),
            F.lit(json.dumps(list(keys))).alias("keys"),
            F.lit(json.dumps(list(partition_by))).alias("partition_by"),
            F.lit(int(buckets)).alias("buckets"),
            F.lit(bool(directories)).alias("directories"),
        )
        table.coalesce(1).write.mode("errorifexists").parquet(f"{path}/table")
        _no_rows(spark, SNAPSHOT_SCHEMA).write.mode("append").parquet(f"{path}/snapshots")
        _no_rows(spark, STATES_SCHEMA).write.mode("append").parquet(f"{path}/states_written")
        return History(spark, path, schema, list(keys), list(partition_by), buckets=buckets, directories=directories)._registered()

    @staticmethod
    def open(spark: SparkSession, path: str) -> History:
        table = spark.read.parquet(f"{path}/table").first()
        history = History(
            spark,
            path,
            T.StructType.fromJson(json.loads(table["schema"])),
            json.loads(table["keys"]),
            json.loads(table["partition_by"]),
            buckets=table.asDict().get("buckets", 0),
            directories=table.asDict().get("directories", True),
        )
        return history._registered().refresh()

    @property
    def _folders(self) -> list[str]:
        """Partition columns whose values are directories."""
        return self.partition_by if self.directories else []

    def _registered(self) -> History:
        """Make the bucketed table known to the session's catalog."""
        if self.buckets:
            layout = [SNAPSHOT_ID, ATTEMPT, CHANGE_TYPE, *self._folders]
            types = {f.name: f.dataType.simpleString() for f in self.schema} | {SNAPSHOT_ID: "bigint", ATTEMPT: "string", CHANGE_TYPE: "string"}
            rest = [f"{q(c)} {types[c]}" for c in self.schema.fieldNames() if c not in self._folders]
            columns = [*rest, f"{ROW_HASH} BIGINT", f"{COPIES} BIGINT", *[f"{q(c)} {types[c]}" for c in layout]]
            where = f"{self.path}/changes".replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._table()} ({', '.join(columns)}) USING parquet PARTITIONED BY ({', '.join(quoted(layout))}) "
                f"CLUSTERED BY ({ROW_HASH}) INTO {self.buckets} BUCKETS LOCATION '{where}'"
            )
        return self

    def _table(self) -> str:
        return f"rowtide_{hashlib.md5(self.path.encode()).hexdigest()[:20]}"

    def _store_counted(self, counted: DataFrame, snapshot_id: int, attempt: str) -> None:
        """Append records (`_change_type`, the columns, `_copies`) to the bucketed table, a file for each bucket and directory."""
        names = [c for c in self.schema.fieldNames() if c not in self._folders]
        row_hash = f"xxhash64({', '.join(quoted(self.schema.fieldNames()))}) AS {ROW_HASH}"
        placed = [f"{snapshot_id}L AS {SNAPSHOT_ID}", f"'{attempt}' AS {ATTEMPT}", CHANGE_TYPE, *[self._written(c) for c in self._folders]]
        rows = counted.selectExpr(*quoted(names), row_hash, f"CAST({COPIES} AS BIGINT) AS {COPIES}", *placed)
        rows.repartition(self.buckets, ROW_HASH).write.insertInto(self._table())

    def _counted(self, attempts: Mapping[int, str]) -> DataFrame:
        """Records of the bucketed table from some tries to commit; other directories are not opened."""
        ids, tries = ", ".join(map(str, attempts)) or "NULL", ", ".join(f"'{a}'" for a in dict.fromkeys(attempts.values())) or "NULL"
        return self.spark.table(self._table()).where(f"{SNAPSHOT_ID} IN ({ids}) AND {ATTEMPT} IN ({tries})")

    def refresh(self) -> History:
        """Read the commit list again."""
        self.commits = self._stored_commits()
        if self.buckets and self.commits:
            self.spark.sql(f"ALTER TABLE {self._table()} RECOVER PARTITIONS")
        return self

    def _stored_commits(self) -> list[Commit]:
        found = self.snapshots().select(
            "snapshot_id",
            F.col("summary")["added-records"].cast("long"),
            F.col("summary")["deleted-records"].cast("long"),
            F.col("summary")["attempt"],
        )
        commits = [Commit(i, i - 1, a, d, t) for i, a, d, t in sorted(found.collect())]
        if len({c.snapshot_id for c in commits}) < len(commits):
            raise RuntimeError("two writers have committed the same snapshot id to this history")
        return commits

    # -- commits -----------------------------------------------------------

    def append_commit(self, changes: DataFrame, committed_at: datetime | None = None) -> int | None:
        """Store the change rows (`_change_type` and the table's columns) of one commit; its snapshot id, or None.

        A row that is deleted and inserted with equal values is no change, so it is left out.
        """
        changes = changes.selectExpr(CHANGE_TYPE, *quoted(self.schema.fieldNames()))
        return self._commit(cancelled(changes), committed_at)

    def _refuse_stale(self) -> None:
        if self._stored_commits() != self.commits:
            raise RuntimeError("another writer has committed to this history")

    def _commit(self, changes: DataFrame, committed_at: datetime | None = None, at_most: int | None = None) -> int | None:
        """Store one commit's change rows; its snapshot id, or None when nothing changed.

        Rows are rebalanced by partition column, so that the number of files
        follows the amount of data (or of partitions, where each has a directory) and a hot partition is split over tasks; if `at_most`, a bound on the
        rows, is more than one task should sort, by ranges of partition and key. The
        per-partition counts are read from file footers, or from the partition columns alone.
        """
        self._refuse_stale()
        snapshot_id, attempt = self.latest() + 1 if self.commits else 1, uuid.uuid4().hex
        layout = [CHANGE_TYPE, *self.partition_by]
        names = [*layout, *(c for c in self.schema.fieldNames() if c not in layout)]
        rows = changes.selectExpr(*[self._written(c) for c in names])
        own = f"{SNAPSHOT_ID}={snapshot_id}/{ATTEMPT}={attempt}"
        if self.buckets:
            self._store_counted(changes.groupBy(CHANGE_TYPE, *quoted(self.schema.fieldNames())).agg(F.expr(f"count(*) AS {COPIES}")), snapshot_id, attempt)
            stored, n = self._counted({snapshot_id: attempt}), COPIES
        else:
            writer = self._by_key(rows, layout, at_most).write.mode("errorifexists").options(**self._filters())
            writer.partitionBy(CHANGE_TYPE, *self._folders).parquet(f"{self.path}/changes/{own}")
            stored, n = self._read_changes([own]), "1"

        counts = [F.expr(f"sum(IF({CHANGE_TYPE} = '{t}', {n}, 0L)) AS {name}") for t, name in ((INSERT, "added"), (DELETE, "deleted"))]
        per_partition = stored.groupBy(*quoted(self.partition_by)).agg(*counts)
        per_partition = per_partition.where("added + deleted > 0")
        per_partition.write.mode("errorifexists").parquet(f"{self.path}/partitions/{own}")
        sums = self._read_partitions([own]).agg(
            F.expr("coalesce(sum(added), 0)"), F.expr("coalesce(sum(deleted), 0)"), F.expr("count(*)")
        )
        n_added, n_deleted, n_partitions = sums.first()
        if n_added + n_deleted == 0:
            return None

        self._refuse_stale()
        commit = Commit(snapshot_id, snapshot_id - 1, n_added, n_deleted, attempt)
        total = sum(c.added - c.deleted for c in [*self.commits, commit])
        operation = "append" if n_deleted == 0 else "delete" if n_added == 0 else "overwrite"
        summary = {
            "added-records": n_added,
            "deleted-records": n_deleted,
            "changed-partition-count": n_partitions,
            "total-records": total,
            "attempt": attempt,
        }
        entries = ", ".join(f"'{k}', '{v}'" for k, v in summary.items())
        row = self.spark.range(1).selectExpr(
            f"CAST({snapshot_id} AS BIGINT) AS snapshot_id",
            f"CAST({self.commits[-1].snapshot_id if self.commits else 'NULL'} AS BIGINT) AS parent_id",
            f"{_timestamp(committed_at)} AS committed_at",
            f"'{operation}' AS operation",
            f"map({entries}) AS summary",
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/snapshots")
        self.commits.append(commit)
        if self.buckets:
            self.materialize_if_due()
        return snapshot_id

    def _by_key(self, rows: DataFrame, layout: Sequence[str], at_most: int | None = None) -> DataFrame:
        """Dealt to tasks, and sorted by key within each, so that a row group holds a narrow range of keys and others needn't be read."""
        keys = [c for c in self.keys if c not in layout]
        tasks = -(-(at_most or 0) // ROWS_PER_TASK)
        if self.partition_by and tasks > 1:
            # By the row, and for equal rows by where they lie; a task that is run again deals them alike.
            deal = F.expr(f"pmod(xxhash64({', '.join(quoted(rows.columns))}) + spark_partition_id(), {DEALS}) AS _deal")
            names = quoted([*layout, *keys])
            return rows.select("*", deal).repartitionByRange(tasks, *names, "_deal").sortWithinPartitions(*names).drop("_deal")
        if self.partition_by:
            rows = rows.hint("rebalance", *quoted(layout))
        return rows.sortWithinPartitions(*quoted([*layout, *keys])) if keys else rows

    def _filters(self) -> dict[str, str]:
        """Writer options: bloom filters on the key columns, as small as the distinct keys of a row group allow."""
        kinds = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
        keys = [c for c in self.keys if c not in self.partition_by and "." not in c and isinstance(self.schema[c].dataType, kinds)]
        own = {f"parquet.bloom.filter.enabled#{c}": "true" for c in keys}
        return {"parquet.bloom.filter.adaptive.enabled": "true", **own} if own else {}

    def _written(self, name: str) -> str:
        """A column as it is stored; as a directory, some strings would come back as null or not at all, so they fail."""
        if name not in self._folders or not isinstance(self.schema[name].dataType, T.StringType):
            return q(name)
        checks = f"WHEN {q(name)} = '' THEN raise_error('an empty string cannot be a partition value')"
        checks += f" WHEN {q(name)} = '{NULL_DIRECTORY}' THEN raise_error('this string stands for null as a partition value')"
        checks += f" WHEN octet_length({q(name)}) > {MOST_VALUE_BYTES} THEN raise_error('a partition value is too long for a directory')"
        return f"CASE {checks} ELSE {q(name)} END AS {q(name)}"

    def insert(self, rows: DataFrame, committed_at: datetime | None = None) -> int | None:
        changes = dml.insert_rows(self._empty(), rows)
        return self._commit(changes, committed_at, self._counted_rows(changes))

    def _counted_rows(self, rows: DataFrame) -> int | None:
        """Number of given rows, where the layout asks for it."""
        return rows.count() if self.partition_by and not self.buckets else None

    def delete(self, where: str | Column, committed_at: datetime | None = None) -> int | None:
        return self._commit(dml.delete_rows(self.current(), where), committed_at)

    def update(
        self,
        assignments: Mapping[str, str | Column],
        where: str | Column | None = None,
        committed_at: datetime | None = None,
    ) -> int | None:
        return self._commit(dml.update_rows(self.current(), assignments, where), committed_at)

    def merge(
        self, source: DataFrame, keys: Sequence[str] | None = None, committed_at: datetime | None = None
    ) -> int | None:
        source, keys = conform(source, self.schema), self._columns(keys or self.keys)
        state = self.state_at(keep=dml.rows_with_keys_of(source, keys)) if keys else self.current()
        return self._commit(dml.merge_rows(state, source, keys, narrow=False), committed_at)

    def overwrite(self, rows: DataFrame, mode: str = "static", committed_at: datetime | None = None) -> int | None:
        rows = conform(rows, self.schema)
        given = self._counted_rows(rows)
        at_most = None if given is None else given + self._live(self.commits)
        if mode == "dynamic" and self.partition_by:
            state = self.state_at(keep=dml.rows_in_partitions_of(rows, self.partition_by))
            return self._commit(diff_states(state, rows), committed_at, at_most)
        return self._commit(dml.overwrite_rows(self.current(), rows, mode, self.partition_by), committed_at, at_most)

    @staticmethod
    def _live(commits: Sequence[Commit]) -> int:
        """Rows of the table after these commits."""
        return sum(c.added - c.deleted for c in commits)

    # -- reading -----------------------------------------------------------

    def snapshots(self) -> DataFrame:
        """snapshot_id, parent_id, committed_at, operation, summary: one row per commit."""
        return self.spark.read.schema(SNAPSHOT_SCHEMA).parquet(f"{self.path}/snapshots")

    def latest(self) -> int:
        if not self.commits:
            raise ValueError("the history has no commit")
        return self.commits[-1].snapshot_id

    def commit_pairs(self, start: int | None = None, end: int | None = None) -> list[tuple[int, int]]:
        """(ordinal, snapshot id) of the commits in a window, ordinals counted within it."""
        inside = self._window(start, end)
        return [(i, c.snapshot_id) for i, c in enumerate(inside)]

    def rows_changed(self, start: int | None = None, end: int | None = None) -> int:
        """Number of change rows in a window, known from the commits."""
        return sum(c.added + c.deleted for c in self._window(start, end))

    def one_sided(self, start: int | None = None, end: int | None = None) -> bool:
        """Whether a window has only INSERTs or only DELETEs, so that nothing can cancel."""
        inside = self._window(start, end)
        return not any(c.added for c in inside) or not any(c.deleted for c in inside)

    def rare_change(self, start: int | None = None, end: int | None = None) -> str | None:
        """The change type so rare in a window that its rows' hashes can be broadcast, if there is one."""
        inside = self._window(start, end)
        added, deleted = sum(c.added for c in inside), sum(c.deleted for c in inside)
        if _is_rare(deleted, added):
            return DELETE
        return INSERT if _is_rare(added, deleted) else None

    def matrix(self, windows: DataFrame) -> DataFrame:
        """RAW and NET counts of many windows by change type."""
        return window_matrix(self.log(), windows, self.commit_pairs(), self.rare_change())

    def window_changes(self, windows: DataFrame) -> DataFrame:
        """RAW and NET change rows of many windows."""
        return changelog_windows(self.log(), windows, self.commit_pairs(), self.rows_changed(), self.rare_change())

    def _window(self, start: int | None, end: int | None) -> list[Commit]:
        known = {c.snapshot_id for c in self.commits}
        unknown = [i for i in (start, end) if i is not None and i not in known]
        if unknown:
            raise ValueError(f"unknown snapshot ids: {unknown}")
        if start is not None and end is not None and start > end:
            raise ValueError(f"window starts after its end: {start} > {end}")
        return [
            c
            for c in self.commits
            if (start is None or c.snapshot_id > start) and (end is None or c.snapshot_id <= end)
        ]

    def log(self, start: int | None = None, end: int | None = None) -> DataFrame:
        """Change rows of the commits after snapshot `start` up to and with `end`; other commits are not opened."""
        names = [*quoted(self.schema.fieldNames()), CHANGE_TYPE, CHANGE_ORDINAL, SNAPSHOT_ID]
        if self.buckets:
            return repeat_rows(self._counted_log(start, end), COPIES, self.rows_changed(start, end)).selectExpr(*names)
        inside = self._window(start, end)
        return _with_ordinals(self._read_changes(_directories(inside)), inside).selectExpr(*names)

    def _counted_log(self, start: int | None, end: int | None) -> DataFrame:
        """The log of a bucketed history as it is stored, with the row's hash and `_copies`."""
        inside = self._window(start, end)
        return _with_ordinals(self._counted({c.snapshot_id: c.attempt for c in inside}), inside).drop(ATTEMPT)

    def changelog(
        self,
        start: int | None = None,
        end: int | None = None,
        net: bool = False,
        updates: bool = False,
        keys: Sequence[str] | None = None,
    ) -> DataFrame:
        """Changes in (start, end], with ordinals from 0 within the window.

        `net` cancels opposite changes of equal rows, or per key when `keys` are
        given. `updates` labels the update pairs of the key (default: the table's). Keys without
        either, labels of net changes and labels without keys are refused.
        """
        if net and updates:
            raise ValueError("net changes have no update labels: ask for one of both")
        if keys and not (net or updates):
            raise ValueError("keys only serve net changes or update labels")
        keys = self._columns(keys or [])
        if updates and not (keys or self.keys):
            raise ValueError("update labels need key columns")
        log = self.log(start, end)
        if net:
            pairs, at_most = self.commit_pairs(start, end), self.rows_changed(start, end)
            if keys:
                return net_changes_by_key(log, keys, pairs, at_most)
            if self.one_sided(start, end):
                return log
            if self.buckets:
                return net_changes(self._counted_log(start, end), pairs, at_most).drop(ROW_HASH).select(*quoted(log.columns))
            return net_changes(log, pairs, at_most, self.rare_change(start, end))
        return self._labelled(log, start, end, keys or self.keys) if updates else log

    def _labelled(self, log: DataFrame, start: int | None, end: int | None, keys: Sequence[str]) -> DataFrame:
        """Only commits with both changes can hold pairs; the others are not shuffled."""
        mixed = [c.snapshot_id for c in self._window(start, end) if c.added and c.deleted]
        if not mixed:
            return log
        among = f"{SNAPSHOT_ID} IN ({', '.join(map(str, mixed))})"
        return log.where(f"NOT {among}").unionAll(label_updates(log.where(among), keys))

    def state_at(self, snapshot_id: int | None = None, keep: dml.Narrowing | None = None) -> DataFrame:
        """The table's rows at a version (default: the latest).

        Starts from the last stored version before it, if any. Without deletes
        the inserted rows are the answer. With few deletes, only rows whose hash
        is among the deleted ones are shuffled; otherwise all changes are, once.
        Predicates on the result reach the scan by themselves; `keep` is for
        joins, which do not: it is applied to the changes before they are summed.
        """
        if not self.commits:
            return self._empty()
        snapshot_id = self.latest() if snapshot_id is None else snapshot_id
        through = self._window(None, snapshot_id)
        base = max((i for i in self._stored_states() if i <= snapshot_id), default=None)
        todo = [c for c in through if base is None or c.snapshot_id > base]
        names = quoted(self.schema.fieldNames())
        if self.buckets:
            n_live = sum(c.added - c.deleted for c in through)
            return repeat_rows(self._balance(todo, base, keep), "_balance", n_live).select(*names)
        changes = self._read_changes(_directories(todo)).select(CHANGE_TYPE, *names)
        inserts = changes.where(f"{CHANGE_TYPE} = '{INSERT}'")
        deletes = changes.where(f"{CHANGE_TYPE} = '{DELETE}'")
        if base is not None:
            stored = self.spark.read.schema(self.schema).parquet(self._state_path(base))
            inserts = stored.selectExpr(f"'{INSERT}' AS {CHANGE_TYPE}", *names).unionAll(inserts)
        if keep is not None:
            inserts, deletes = keep(inserts), keep(deletes)

        n_deleted = sum(c.deleted for c in todo)
        n_inserted = sum(c.added - c.deleted for c in through) + n_deleted
        if n_deleted == 0:
            return inserts.select(*names)
        if _is_rare(n_deleted, n_inserted):
            untouched, touched = split_untouched(inserts.unionAll(deletes), DELETE)
            return untouched.select(*names).unionAll(repeat_rows(row_balance(touched), "_balance", n_inserted))
        return repeat_rows(row_balance(inserts.unionAll(deletes)), "_balance", n_inserted)

    def _balance(self, todo: Sequence[Commit], base: int | None, keep: dml.Narrowing | None = None) -> DataFrame:
        """The rows of a version of a bucketed history, each with its `_balance`: added up bucket by bucket."""
        attempts = {c.snapshot_id: c.attempt for c in todo}
        if base is not None:
            attempts[base] = self._stored_tries()[base]
        rows = self._counted(attempts).drop(SNAPSHOT_ID, ATTEMPT)
        return row_balance(keep(rows) if keep else rows)

    def current(self) -> DataFrame:
        return self.state_at()

    def materialize(self, snapshot_id: int | None = None) -> str:
        """Write a version's rows out, so that later versions start from there. Cuts the lineage of long histories."""
        snapshot_id = self.latest() if snapshot_id is None else snapshot_id
        target = self._state_path(snapshot_id)
        if snapshot_id in self._stored_states():
            return target
        if self.buckets:
            before = max((i for i in self._stored_states() if i < snapshot_id), default=None)
            todo = [c for c in self._window(None, snapshot_id) if before is None or c.snapshot_id > before]
            live, attempt = self._balance(todo, before).withColumnRenamed("_balance", COPIES), f"{STORED}-{uuid.uuid4().hex}"
            self._store_counted(live.withColumn(CHANGE_TYPE, F.lit(INSERT)), snapshot_id, attempt)
            return self._mark_stored(snapshot_id, target, attempt)
        rows = self._by_key(self.state_at(snapshot_id), self.partition_by, self._live(self._window(None, snapshot_id)))
        _replace(rows).options(**self._filters()).partitionBy(*self._folders).parquet(target)
        return self._mark_stored(snapshot_id, target, None)

    def _mark_stored(self, snapshot_id: int, target: str, attempt: str | None) -> str:
        mark = self.spark.range(1).select(F.lit(snapshot_id).cast("long").alias("snapshot_id"), F.lit(attempt).cast("string").alias("attempt"))
        mark.coalesce(1).write.mode("append").parquet(f"{self.path}/states_written")
        return target

    def materialize_if_due(self, factor: float = 1.0) -> str | None:
        """Write the latest version out once the changes since the last stored one outnumber its rows by `factor`.

        Called after each commit, a write then reads no more than a few times the table's rows, however long the
        history is, and the versions written take no more than the changes that led to them.
        """
        if not self.commits:
            return None
        base = max(self._stored_states(), default=0)
        changed = sum(c.added + c.deleted for c in self.commits if c.snapshot_id > base)
        live = sum(c.added - c.deleted for c in self.commits)
        return self.materialize() if changed > factor * live else None

    def _state_path(self, snapshot_id: int) -> str:
        return f"{self.path}/states/{SNAPSHOT_ID}={snapshot_id}"

    def _stored_states(self) -> list[int]:
        return list(self._stored_tries())

    def _stored_tries(self) -> dict[int, str | None]:
        """Stored versions, and for each the try that wrote it into the bucketed table, if there is one."""
        found = self.spark.read.schema(STATES_SCHEMA).parquet(f"{self.path}/states_written").collect()
        return {r.snapshot_id: r.attempt for r in found}

    def _columns(self, names: Sequence[str]) -> list[str]:
        """The table's columns of these names, by the session's rule on upper and lower case."""
        found = resolve(self._empty(), names, self.schema.fieldNames())
        unknown = [n for n in names if n not in found]
        if unknown:
            raise ValueError(f"no such columns: {unknown}")
        return [found[n] for n in names]

    def _empty(self) -> DataFrame:
        return _no_rows(self.spark, self.schema)

    def _read_changes(self, directories: Sequence[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *[f for f in METADATA_FIELDS if f.name != CHANGE_ORDINAL]])
        return self._read("changes", directories, schema)

    def partition_counts(self) -> DataFrame:
        """Rows added and deleted by commit and partition value."""
        return self._read_partitions(_directories(self.commits))

    def _read_partitions(self, directories: Sequence[str]) -> DataFrame:
        values = [self.schema[c] for c in self.partition_by]
        counts = [T.StructField(c, T.LongType()) for c in ("added", "deleted", SNAPSHOT_ID)]
        return self._read("partitions", directories, T.StructType([*values, *counts]))

    def _read(self, table: str, directories: Sequence[str], schema: T.StructType) -> DataFrame:
        if not directories:
            return _no_rows(self.spark, schema)
        root = f"{self.path}/{table}"
        schema = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())])
        return self.spark.read.option("basePath", root).schema(schema).parquet(*[f"{root}/{d}" for d in directories]).drop(ATTEMPT)


def _with_ordinals(rows: DataFrame, inside: Sequence[Commit]) -> DataFrame:
    first = inside[0].snapshot_id if inside else 1
    return rows.selectExpr("*", f"CAST({SNAPSHOT_ID} - {first} AS INT) AS {CHANGE_ORDINAL}")


def _directories(commits: Sequence[Commit]) -> list[str]:
    return [f"{SNAPSHOT_ID}={c.snapshot_id}/{ATTEMPT}={c.attempt}" for c in commits]


def _is_rare(few: int, many: int) -> bool:
    return few <= BROADCAST_HASHES and few * 10 <= many


def _no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    nulls = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {q(f.name)}" for f in schema]
    return spark.range(0).selectExpr(*nulls)


def _replace(rows: DataFrame) -> DataFrameWriter:
    """Replace the whole target directory, whatever overwrite mode the session has."""
    return rows.write.mode("overwrite").option("partitionOverwriteMode", "static")


def create_changelog_view(
    history: History,
    view: str,
    start: int | None = None,
    end: int | None = None,
    net_changes: bool = False,
    compute_updates: bool = False,
    identifier_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Register a changelog as a temporary view for SQL text; it replaces a view of the same name.

    Options that do nothing together are refused, as `History.changelog` does.
    """
    changes = history.changelog(start, end, net_changes, compute_updates, identifier_columns)
    changes.createOrReplaceTempView(view)
    return changes


def _timestamp(at: datetime | None) -> str:
    """Without an offset, a time is meant in the session's time zone."""
    return "current_timestamp()" if at is None else f"TIMESTAMP '{at.isoformat(sep=' ')}'"


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return False
