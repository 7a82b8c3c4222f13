"""A change matrix that is kept up to date, commit by commit.

    <path>/row_events/_try=T/     rows that some commits touched: two hashes, all events so far, how many of them are older
    <path>/signatures/_try=T/     lists of events (signatures) with the number of rows that came to have them or no longer have
    <path>/signatures_written/    one row per try that counts: the commit it goes through, and its name

A further commit only concerns the rows that it touched: they leave the signature that they had
and take one with an event more. So bringing the store up to date reads the changes of the new commits and
the events stored of the rows they touched; older changes are not opened. NET counts of any windows come from the sums of the
signatures, and RAW counts from the commits' own totals, without a look at any row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F, types as T

from rowtide.model import CHANGE_ORDINAL, CHANGE_TYPE, DELETE, INSERT, SNAPSHOT_ID, quoted
from rowtide.operators.rows import commit_counts, splittable_join
from rowtide.operators.windows import change_matrix, raw_window_counts_of, swept_counts
from rowtide.sources.history import History

EVENT = T.StructType([T.StructField("ordinal", T.IntegerType()), T.StructField("n", T.LongType())])
ROW_EVENTS = T.StructType(
    [T.StructField("h0", T.LongType()), T.StructField("h1", T.LongType()), T.StructField("events", T.ArrayType(EVENT)), T.StructField("older", T.IntegerType())]
)
SIGNATURES = T.StructType([T.StructField("events", T.ArrayType(EVENT)), T.StructField("change", T.LongType())])
WRITTEN = T.StructType([T.StructField("through", T.LongType()), T.StructField("try", T.StringType())])


def _written(history: History) -> list[tuple[int, str]]:
    """Commits that the store goes through, in order, with the tries that wrote it."""
    if not _exists(history):
        return []
    return sorted(map(tuple, history.spark.read.schema(WRITTEN).parquet(f"{history.path}/signatures_written").collect()))


def _exists(history: History) -> bool:
    jvm = history.spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{history.path}/signatures_written")
    return folder.getFileSystem(history.spark._jsc.hadoopConfiguration()).exists(folder)


def _read(history: History, table: str, schema: T.StructType, tries: list[str]) -> DataFrame:
    """Rows of some tries."""
    if not tries:
        return history.spark.createDataFrame([], schema)
    root = f"{history.path}/{table}"
    marked = T.StructType([*schema.fields, T.StructField("_try", T.StringType())])
    return history.spark.read.option("basePath", root).schema(marked).parquet(*[f"{root}/_try={t}" for t in tries]).drop("_try")


def touched_rows(history: History, after: int | None, through: int) -> DataFrame:
    """Rows that the commits after `after` up to `through` changed, with their events: `h0`, `h1`, `events`. Rows are told apart by
    128 bits of hashes; changes of a row that cancel within a commit are none."""
    names = ", ".join(quoted(history.schema.fieldNames()))
    first = 0 if after is None else after  # ordinals of the whole history, one less than the commit
    log = history.log(after, through).selectExpr(
        f"xxhash64({names}) AS h0", f"xxhash64({names}, 1) AS h1", CHANGE_TYPE, f"CAST({CHANGE_ORDINAL} + {first} AS INT) AS {CHANGE_ORDINAL}", SNAPSHOT_ID
    )
    event = f"struct({CHANGE_ORDINAL} AS ordinal, _n AS n)"
    return commit_counts(log).groupBy("h0", "h1").agg(F.expr(f"array_sort(collect_list({event})) AS events"))


def store_signatures(history: History, through: int | None = None) -> int | None:
    """Bring the store up to date through a commit (default: the latest); the commit it now goes through, or None without any.

    One writer at a time, as for commits. A try that is broken off leaves files that are never read.
    """
    if not history.commits:
        return None
    through = history.latest() if through is None else through
    written = _written(history)
    after = written[-1][0] if written else None
    if after is not None and after >= through:
        return after
    new = touched_rows(history, after, through)
    known = _read(history, "row_events", ROW_EVENTS, [t for _, t in written])
    if written:
        # Of the records of a row, the longest list is the last.
        known = splittable_join(known, new.select("h0", "h1"), ["h0", "h1"], "left_semi")
        known = known.groupBy("h0", "h1").agg(F.expr("max_by(events, size(events)) AS _known"))
        new = splittable_join(new, known, ["h0", "h1"], "left")
        new = new.selectExpr("h0", "h1", "concat(coalesce(_known, array()), events) AS events", "coalesce(size(_known), 0) AS older")
    else:
        new = new.selectExpr("h0", "h1", "events", "0 AS older")
    name = uuid.uuid4().hex
    new.write.mode("errorifexists").parquet(f"{history.path}/row_events/_try={name}")
    rows = _read(history, "row_events", ROW_EVENTS, [name])
    moves = "array(struct(events AS events, 1L AS change), IF(older > 0, struct(slice(events, 1, older) AS events, -1L AS change), NULL))"
    changes = rows.selectExpr(f"inline(array_compact({moves}))").groupBy("events").agg(F.expr("sum(change) AS change"))
    changes.where("change <> 0").write.mode("errorifexists").parquet(f"{history.path}/signatures/_try={name}")
    mark = history.spark.range(1).selectExpr(f"{through}L AS through", f"'{name}' AS try")
    mark.coalesce(1).write.mode("append").parquet(f"{history.path}/signatures_written")
    return through


def signature_counts(history: History) -> DataFrame:
    """Signatures with the number of rows that have them: `_events`, `_rows`."""
    changes = _read(history, "signatures", SIGNATURES, [t for _, t in _written(history)])
    return changes.groupBy(F.expr("events AS _events")).agg(F.expr("sum(change) AS _rows")).where("_rows <> 0")


def kept_matrix(history: History, windows: DataFrame) -> DataFrame:
    """RAW and NET counts of many windows by change type, as `History.matrix` gives them, from the store and the list of commits.

    Windows that end after the commits that the store goes through are refused.
    """
    written = _written(history)
    last = windows.selectExpr("max(end_ordinal)").first()[0]
    if last is not None and (not written or last + 1 > written[-1][0]):
        raise ValueError(f"the store goes through commit {written[-1][0] if written else 0}, windows through {last + 1}")
    totals = [(c.ordinal, kind, n) for c in history.commits for kind, n in ((INSERT, c.added), (DELETE, c.deleted)) if n]
    each = ", ".join(f"struct({o} AS {CHANGE_ORDINAL}, '{kind}' AS {CHANGE_TYPE}, {n}L AS n)" for o, kind, n in totals)
    per_commit = history.spark.range(1).selectExpr(f"inline(array({each}))")
    return change_matrix(raw_window_counts_of(per_commit, windows).unionByName(swept_counts(signature_counts(history), windows)))
