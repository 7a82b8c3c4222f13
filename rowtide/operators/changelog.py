"""Which rows changed: raw, net by row, net by key, and update pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rowtide.model import (
    CHANGE_ORDINAL,
    CHANGE_TYPE,
    COPIES,
    DELETE,
    INSERT,
    SNAPSHOT_ID,
    UPDATE_AFTER,
    UPDATE_BEFORE,
    q,
    quoted,
    row_columns,
)
from rowtide.operators.rows import (
    Commits,
    as_change_rows,
    commit_counts,
    commit_sums,
    inlined,
    last_changes_of_counts,
    last_changes_of_sums,
    split_untouched,
    splittable_join,
    sum_names,
)


def changelog(log: DataFrame, start: int | None, end: int) -> DataFrame:
    """Changes of the commits after ordinal `start` (None: from the first) up to and with `end`.

    Ordinals count from 0 within the result's window.
    """
    if start is not None and start > end:
        raise ValueError(f"window starts after its end: {start} > {end}")
    first = 0 if start is None else start + 1
    return log.where(f"{CHANGE_ORDINAL} >= {first} AND {CHANGE_ORDINAL} <= {end}").withColumn(
        CHANGE_ORDINAL, F.expr(f"CAST({CHANGE_ORDINAL} - {first} AS INT)")
    )


def net_changes(
    log: DataFrame, commits: Commits | None = None, at_most: int | None = None, rare: str | None = None
) -> DataFrame:
    """Opposite changes of the same row cancelled across commits.

    What is left of a row are its last |balance| changes of the balance's sign,
    with their own commit metadata. When `commits`, the (ordinal, snapshot id)
    pairs of the log, are given and few, one shuffle on the row does it, of
    records already summed per task. `at_most` bounds the copies of a row.
    `rare` names a change type with few rows: only rows it met are shuffled.
    """
    if rare is not None:
        untouched, touched = split_untouched(log, rare)
        return untouched.unionAll(net_changes(touched, commits, at_most))
    if inlined(commits):
        left = last_changes_of_sums(commit_sums(log, commits), commits)
    else:
        left = last_changes_of_counts(commit_counts(log))
    return as_change_rows(left, [c for c in log.columns if c != COPIES], at_most)


def net_changes_by_key(
    log: DataFrame, keys: Sequence[str], commits: Commits | None = None, at_most: int | None = None
) -> DataFrame:
    """Per key, the image before the window (DELETE) and the image after it (INSERT).

    A key whose first change is an INSERT had no image before; one whose last
    change is a DELETE has none after; equal images cancel. Within a commit a
    DELETE comes before an INSERT, and opposite changes of one row are no change.

    That holds for keys that stand for one row at a time. Rows with a null in the key, and
    those of a key that holds several rows at once in the window, are netted by whole rows
    (see `net_changes`, also for `commits` and `at_most`), so nothing is lost: signs add up to those of the log.

    The log is read and shuffled by row once. A key's state is one aggregation over the counted
    rows, which merges in any order; rows are only looked up again, from the same shuffle, for the keys whose state
    says that they hold several.
    """
    if not keys:
        raise ValueError("net changes by key need key columns")
    rows, few = row_columns(log), inlined(commits)
    if few:
        names = sum_names(commits)
        counted = commit_sums(log, commits).where(" OR ".join(f"{n} <> 0" for n in names))
    else:
        counted = commit_counts(log)
    states = _states_of_sums(counted, keys, commits) if few else _states_of_counts(counted, keys)
    # Null keys are told by an aggregate: a predicate on the key itself would go down to one of the scans and keep them apart.
    states = states.selectExpr("*", f"_null_key OR {_holds_several('_steps')} AS _several")
    several = states.where("_several").selectExpr(*[f"{q(k)} AS {q('_key_' + k)}" for k in keys], "TRUE AS _by_row")
    same_key = " AND ".join(f"{q(k)} <=> {q('_key_' + k)}" for k in keys)
    met = counted.join(several, F.expr(same_key), "left").where("_by_row").select(*quoted(counted.columns))
    left = last_changes_of_sums(met, commits) if few else last_changes_of_counts(met)
    by_row = as_change_rows(left, log.columns, at_most)
    return _images(states.where("NOT _several"), log.columns, rows).unionAll(by_row.select(*quoted(log.columns)))


def _entry(rows: Sequence[str], ordinal: str, sign: str, snapshot_id: str) -> str:
    """SQL of a change as a record that sorts by commit, then DELETE before INSERT."""
    return f"struct({ordinal} AS _ordinal, {sign} AS _sign, {', '.join(quoted(rows))}, {snapshot_id} AS _snapshot_id)"


def _null_key(keys: Sequence[str]) -> str:
    return f"max({' OR '.join(f'{q(k)} IS NULL' for k in keys)}) AS _null_key"


def _states_of_sums(sums: DataFrame, keys: Sequence[str], commits: Commits) -> DataFrame:
    """One state per key: `_steps` (deleted, inserted in each commit), `_first` and `_last` change, `_null_key`."""
    names, rows = sum_names(commits), [c for c in sums.columns if c not in sum_names(commits)]
    events = [f"IF({n} <> 0, {_entry(rows, str(o), f'IF({n} > 0, 1, -1)', f'{i}L')}, NULL)" for n, (o, i) in zip(names, commits)]
    steps = [f"struct(sum(greatest(-{n}, 0)) AS deleted, sum(greatest({n}, 0)) AS inserted)" for n in names]
    return sums.groupBy(*quoted(keys)).agg(
        F.expr(f"array({', '.join(steps)}) AS _steps"),
        F.expr(f"min(coalesce({', '.join(events)})) AS _first"),
        F.expr(f"max(coalesce({', '.join(reversed(events))})) AS _last"),
        F.expr(_null_key(keys)),
    )


def _states_of_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same from `commit_counts`, summed by commit first: a key has at most one step per commit."""
    rows = [c for c in row_columns(counts) if c != "_n"]
    entry = _entry(rows, CHANGE_ORDINAL, "IF(_n > 0, 1, -1)", SNAPSHOT_ID)
    per_commit = counts.groupBy(*quoted(keys), CHANGE_ORDINAL).agg(
        F.expr("sum(greatest(-_n, 0)) AS _deleted"), F.expr("sum(greatest(_n, 0)) AS _inserted"),
        F.expr(f"min({entry}) AS _low"), F.expr(f"max({entry}) AS _high"),
    )
    step = f"struct({CHANGE_ORDINAL} AS ordinal, _deleted AS deleted, _inserted AS inserted)"
    return per_commit.groupBy(*quoted(keys)).agg(
        F.expr(f"array_sort(collect_list({step})) AS _steps"), F.expr("min(_low) AS _first"), F.expr("max(_high) AS _last"),
        F.expr(_null_key(keys)),
    )


def _holds_several(steps: str) -> str:
    """SQL: whether the steps of a key don't alternate between INSERT and DELETE.

    The running balance of a single row takes two neighbouring values only, also between the
    DELETE and the INSERT of one commit.
    """
    balance = "a.balance - s.deleted + s.inserted"
    walk = (
        f"(a, s) -> struct({balance} AS balance, least(a.low, a.balance - s.deleted, {balance}) AS low, "
        f"greatest(a.high, {balance}) AS high, greatest(a.most, s.deleted, s.inserted) AS most)"
    )
    start = "struct(0L AS balance, 0L AS low, 0L AS high, 0L AS most)"
    return f"aggregate({steps}, {start}, {walk}, a -> a.most > 1 OR a.high - a.low > 1)"


def _images(states: DataFrame, columns: Sequence[str], rows: Sequence[str]) -> DataFrame:
    def image(side: str, change_type: str) -> str:
        texts = {CHANGE_TYPE: f"'{change_type}'", CHANGE_ORDINAL: f"CAST({side}._ordinal AS INT)", SNAPSHOT_ID: f"{side}._snapshot_id"}
        return ", ".join(f"{texts.get(c) or f'{side}.{q(c)}'} AS {q(c)}" for c in columns)

    same = " AND ".join(f"_first.{q(c)} <=> _last.{q(c)}" for c in rows)
    sides = [
        f"IF(_first._sign < 0, struct({image('_first', DELETE)}), NULL)",
        f"IF(_last._sign > 0, struct({image('_last', INSERT)}), NULL)",
    ]
    return states.where(f"NOT (_first._sign < 0 AND _last._sign > 0 AND {same})").selectExpr(
        f"inline(array_compact(array({', '.join(sides)})))"
    )


def label_updates(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A key with exactly one DELETE and one INSERT in a commit becomes an update pair.

    The pairs are found by counting (summed per task before the shuffle) and
    joined back; keys with many changes are no pairs, so they find no partner
    and their rows may be spread over tasks. Null keys never pair.
    """
    if not keys:
        raise ValueError("update labels need key columns")
    at = [SNAPSHOT_ID, *keys]
    pairs = (
        log.groupBy(*quoted(at))
        .agg(
            F.expr(f"count_if({CHANGE_TYPE} = '{DELETE}') AS _deleted"),
            F.expr(f"count_if({CHANGE_TYPE} = '{INSERT}') AS _inserted"),
        )
        .where("_deleted = 1 AND _inserted = 1")
        .selectExpr(*quoted(at), "TRUE AS _pair")
    )
    pair = f"IF({CHANGE_TYPE} = '{DELETE}', '{UPDATE_BEFORE}', '{UPDATE_AFTER}')"
    label = f"IF(_pair, {pair}, {CHANGE_TYPE}) AS {CHANGE_TYPE}"
    return splittable_join(log, pairs, at, "left").selectExpr(*[label if c == CHANGE_TYPE else q(c) for c in log.columns])


def key_violations(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that identify no single row: those with a null part and those held by several rows."""
    names = quoted(keys)
    has_null = " OR ".join(f"{k} IS NULL" for k in names)
    counted = rows.groupBy(*names).agg(F.expr("count(*) AS n"))
    return counted.selectExpr(*names, "n", f"({has_null}) AS null_key").where("null_key OR n > 1")
