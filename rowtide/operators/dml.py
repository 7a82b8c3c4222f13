"""Row-level writes. Each takes the current rows and returns change rows.

A change row is `_change_type` plus the table's columns. Nothing is rewritten in
place: a history appends the change rows, and a version is the sum of them.
A row that is rewritten with equal values is not a change.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowtide.model import CHANGE_TYPE, DELETE, INSERT, conform, differs, q, quoted, resolve
from rowtide.operators.rows import BROADCAST_HASHES, cancelled, diff_states, repeat_rows


def insert_rows(state: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT INTO: every given row, cast to the table's types; keys are not checked."""
    return conform(rows, state.schema).selectExpr(f"'{INSERT}' AS {CHANGE_TYPE}", "*")


def delete_rows(state: DataFrame, where: str | Column) -> DataFrame:
    """DELETE FROM ... WHERE: rows for which the predicate is true (null keeps the row)."""
    return state.where(where).selectExpr(f"'{DELETE}' AS {CHANGE_TYPE}", "*")


def update_rows(
    state: DataFrame, assignments: Mapping[str, str | Column], where: str | Column | None = None
) -> DataFrame:
    """UPDATE ... SET ... WHERE: one scan, both images of a row from one record.

    Where rows take each other's values, their images cancel, so no row is deleted and inserted by one update.
    """
    found = resolve(state, assignments, state.columns)
    unknown = [c for c in assignments if c not in found]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    if len(set(found.values())) < len(found):
        raise ValueError(f"a column is set twice: {list(assignments)}")
    assignments = {found[c]: v for c, v in assignments.items()}
    hit = state if where is None else state.where(where)
    after = [
        (F.expr(v) if isinstance(v, str) else v).cast(state.schema[c].dataType).alias(f"_after_{c}")
        for c, v in assignments.items()
    ]
    changed = hit.select("*", *after).where(differs((c, f"_after_{c}") for c in assignments))
    return cancelled(_both_images(changed, state.columns, list(assignments)))


# At most this many partitions of a dynamic overwrite become literals of the plan.
LITERAL_PARTITIONS = 500

# At most this many keys of a merge's source become literals of the plan.
LITERAL_KEYS = 200
LITERAL_TYPES = (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.BooleanType)

# Marks a record of a merge's source that met a row.
_MET = "MET"

Narrowing = Callable[[DataFrame], DataFrame]


def merge_rows(state: DataFrame, source: DataFrame, keys: Sequence[str], narrow: bool = True) -> DataFrame:
    """MERGE ... ON keys WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *.

    One join on the key, which adaptive execution may split on either side, gives the images of changed rows and a mark for
    each key of the source that met a row, so the table is read once; keys without a mark are new. A source whose keys
    repeat (a count of its keys tells) is first reduced to one record per key, so the join never multiplies rows.
    When the source is counted to be small, the table is first cut down to rows with one of its key hashes, before any
    shuffle of the table.

    Null keys match nothing, so their source rows are inserted. A key with
    several source rows fails the write when the table has that key; else all of them are inserted. Rows of one key that are
    deleted differ from the one that is inserted, so nothing in a merge cancels. `narrow`
    is false when the caller has cut the table down itself.
    """
    if not keys:
        raise ValueError("a merge needs key columns")
    source = conform(source, state.schema)
    columns, names = state.columns, quoted(keys)
    null_key = " OR ".join(f"{k} IS NULL" for k in names)
    keyed = source.where(f"NOT ({null_key})")
    if narrow:
        state = rows_with_keys_of(source, keys)(state)
    row = f"struct({', '.join(quoted(columns))})"
    key_names = [f"{k} AS {q('_key_' + c)}" for k, c in zip(names, keys)]
    unique = keyed.groupBy(*names).agg(F.expr("count(*) AS _rows")).where("_rows > 1").isEmpty()
    if unique:
        dealt = keyed.selectExpr("1L AS _rows", f"{row} AS _source", *key_names)
    else:
        per_key = keyed.groupBy(*names).agg(F.expr("count(*) AS _rows"), F.expr(f"min({row}) AS _source"))
        dealt = per_key.selectExpr("_rows", "_source", *key_names)
    table = state.selectExpr(f"{row} AS _row", *[f"{k} AS {q('_own_' + c)}" for k, c in zip(names, keys)])
    on = [f"{q('_key_' + c)} = {q('_own_' + c)}" for c in keys]
    if not unique:  # a side that was just grouped by the key would be taken as it is, and so not be split
        on += [f"xxhash64({', '.join(q('_key_' + c) for c in keys)}) = xxhash64({', '.join(q('_own_' + c) for c in keys)})"]
    met = dealt.join(table, F.expr(" AND ".join(on)), "inner")

    values = [c for c in columns if c not in keys]
    fields = lambda side: ", ".join(f"{side}.{q(c)} AS {q(c)}" for c in columns)
    # The table's row keeps its own form of the key, which may differ from an equal one of the source.
    after = ", ".join(f"{'_source' if c in values else '_row'}.{q(c)} AS {q(c)}" for c in columns)
    changed = " OR ".join(f"NOT (_row.{q(c)} <=> _source.{q(c)})" for c in values) or "FALSE"
    mark = f"struct('{_MET}' AS {CHANGE_TYPE}, {fields('_source')})"
    images = f"array(struct('{DELETE}' AS {CHANGE_TYPE}, {fields('_row')}), struct('{INSERT}' AS {CHANGE_TYPE}, {after}), {mark})"
    # The check is part of the generator: as a filter it could be moved below the join, to rows without partner.
    several = "raise_error('MERGE source has several rows for one row of the table')"
    out = met.selectExpr(f"inline(CASE WHEN _rows > 1 THEN {several} WHEN {changed} THEN {images} ELSE array({mark}) END)")
    matched = out.where(f"{CHANGE_TYPE} <> '{_MET}'")
    marks = out.where(f"{CHANGE_TYPE} = '{_MET}'").select(*quoted(keys)).distinct()
    same_key = " AND ".join(f"{q('_key_' + c)} = {q(c)}" for c in keys)
    inserted = dealt.join(marks, F.expr(same_key), "left_anti").selectExpr("_source.*").unionAll(source.where(null_key))
    if not unique:  # what a key has besides its first row; if the table has the key, the merge fails anyway
        others = keyed.selectExpr(*quoted(columns), "1L AS _n").unionAll(per_key.selectExpr("_source.*", "-1L AS _n"))
        inserted = inserted.unionAll(repeat_rows(others.groupBy(*quoted(columns)).agg(F.expr("sum(_n) AS _n")).where("_n > 0"), "_n"))
    return matched.unionAll(inserted.selectExpr(f"'{INSERT}' AS {CHANGE_TYPE}", *quoted(columns)))


def rows_with_keys_of(source: DataFrame, keys: Sequence[str]) -> Narrowing:
    """Cut rows down to those with a key of the source, or its hash; leaves them whole when the source is large.

    Up to `LITERAL_KEYS` values of a key column are written into the plan, so that they reach the scan: row groups that by
    their least and greatest key or their bloom filter have none of them aren't read. The hashes of more keys, and of
    several columns, are joined. It only looks at key columns, so it may be applied to a version's rows or
    to the changes that they are summed from.
    """
    key_hash = f"xxhash64({', '.join(quoted(keys))})"
    null_key = " OR ".join(f"{k} IS NULL" for k in quoted(keys))
    inside, plain = F.lit(True), all(isinstance(source.schema[k].dataType, LITERAL_TYPES) for k in keys)
    known = source.where(f"NOT ({null_key})").select(*quoted(keys)).distinct().limit(LITERAL_KEYS + 1).collect() if plain else []
    if plain and len(known) <= LITERAL_KEYS:
        for i, k in enumerate(quoted(keys)):
            inside = inside & (F.col(k).isin(sorted({row[i] for row in known})) if known else F.lit(False))
        if len(keys) == 1:
            return lambda rows: rows.where(inside)
    hashes = source.selectExpr(f"{key_hash} AS _hash")
    if hashes.limit(BROADCAST_HASHES + 1).count() > BROADCAST_HASHES:
        return lambda rows: rows
    return lambda rows: rows.where(inside).join(F.broadcast(hashes), F.expr(f"{key_hash} = _hash"), "left_semi")


def rows_in_partitions_of(source: DataFrame, partition_by: Sequence[str]) -> Narrowing:
    """Cut rows down to those whose partition occurs in the source.

    Up to `LITERAL_PARTITIONS` partitions are written into the plan as literals, so that the other
    directories are not opened; more are joined.
    """
    touched = source.selectExpr(*[f"{q(c)} AS {q('_new_' + c)}" for c in partition_by]).distinct()
    known = touched.limit(LITERAL_PARTITIONS + 1).collect()
    if len(known) <= LITERAL_PARTITIONS:
        one = len(partition_by) == 1
        values = [v for (v,) in known if v is not None] if one else []
        inside = F.lit(False)
        if one:
            column = F.col(q(partition_by[0]))
            inside = column.isin(values) if values else inside
            if len(values) < len(known):
                inside = column.isNull() | inside
        else:
            for row in known:
                here = F.lit(True)
                for c, v in zip(partition_by, row):
                    here = here & (F.col(q(c)).isNull() if v is None else F.col(q(c)) == F.lit(v))
                inside = inside | here
        return lambda rows: rows.where(inside)
    same = F.expr(" AND ".join(f"{q(c)} <=> {q('_new_' + c)}" for c in partition_by))
    return lambda rows: rows.join(touched, same, "left_semi")


def overwrite_rows(
    state: DataFrame, rows: DataFrame, mode: str = "static", partition_by: Sequence[str] = ()
) -> DataFrame:
    """INSERT OVERWRITE with a query that may read the table itself.

    `static` replaces the whole table, `dynamic` only the partitions that occur
    in `rows`. Rows present on both sides are carried over, hence no change.
    """
    rows = conform(rows, state.schema)
    if mode == "static":
        return diff_states(state, rows)
    if mode != "dynamic":
        raise ValueError(f"unknown overwrite mode: {mode!r}")
    if not partition_by:
        raise ValueError("dynamic overwrite needs partition columns")
    return diff_states(rows_in_partitions_of(rows, partition_by)(state), rows)


def _both_images(changed: DataFrame, columns: Sequence[str], rewritten: Sequence[str]) -> DataFrame:
    """Two change rows from each record."""
    after = [q(f"_after_{c}") if c in rewritten else q(c) for c in columns]
    return changed.selectExpr(
        f"inline(array(struct('{DELETE}' AS {CHANGE_TYPE}, {', '.join(f'{q(c)} AS {q(c)}' for c in columns)}), "
        f"struct('{INSERT}' AS {CHANGE_TYPE}, {', '.join(f'{a} AS {q(c)}' for a, c in zip(after, columns))})))"
    )
