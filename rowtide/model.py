"""Names shared by every operator: change types and change metadata columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, types as T

# The change types and the metadata columns of a change row.
INSERT = "INSERT"
DELETE = "DELETE"
UPDATE_BEFORE = "UPDATE_BEFORE"
UPDATE_AFTER = "UPDATE_AFTER"
CHANGE_TYPES = [INSERT, DELETE, UPDATE_BEFORE, UPDATE_AFTER]

CHANGE_TYPE = "_change_type"
CHANGE_ORDINAL = "_change_ordinal"
SNAPSHOT_ID = "_commit_snapshot_id"
METADATA = [CHANGE_TYPE, CHANGE_ORDINAL, SNAPSHOT_ID]

# How many equal rows a change row of a log stands for; a log without this column has one record per row.
COPIES = "_copies"

METADATA_FIELDS = [
    T.StructField(CHANGE_TYPE, T.StringType()),
    T.StructField(CHANGE_ORDINAL, T.IntegerType()),
    T.StructField(SNAPSHOT_ID, T.LongType()),
]

SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("snapshot_id", T.LongType()),
        T.StructField("parent_id", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("summary", T.MapType(T.StringType(), T.StringType())),
    ]
)


def q(name: str) -> str:
    """A column name as SQL text, dots included."""
    return "`" + name.replace("`", "``") + "`"


def quoted(names: Iterable[str]) -> list[str]:
    return [q(n) for n in names]


def row_columns(df: DataFrame) -> list[str]:
    """The table's own columns of a change log (everything but the metadata and the number of copies)."""
    return [c for c in df.columns if c not in METADATA and c != COPIES]


# +1 for a row that appears, -1 for a row that disappears.
SIGN = f"IF({CHANGE_TYPE} IN ('{INSERT}', '{UPDATE_AFTER}'), 1, -1)"


def signed(df: DataFrame) -> str:
    """SQL of what a change row adds to the number of its rows."""
    return f"{SIGN} * {COPIES}" if COPIES in df.columns else SIGN


def change_type_of(signed: str) -> str:
    return f"IF({signed} > 0, '{INSERT}', '{DELETE}')"


def differs(pairs: Iterable[tuple[str, str]]) -> str:
    """SQL text that is true when any pair of columns differs, nulls compared as values."""
    return " OR ".join(f"NOT ({q(a)} <=> {q(b)})" for a, b in pairs) or "FALSE"


def resolve(df: DataFrame, names: Iterable[str], among: Iterable[str]) -> dict[str, str]:
    """The column of `among` that each name means, by the session's rule on upper and lower case."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    key = (lambda n: n) if exact else str.lower
    known: dict[str, list[str]] = {}
    for name in among:
        known.setdefault(key(name), []).append(name)
    found = {}
    for name in names:
        columns = known.get(key(name), [])
        if len(columns) > 1:
            raise ValueError(f"column {name!r} is ambiguous: {columns}")
        if columns:
            found[name] = columns[0]
    return found


def assignable(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether a value may be stored in a column of another type: what INSERT INTO accepts under ANSI rules."""
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if given == wanted or isinstance(given, T.NullType):
        return True
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return assignable(given.elementType, wanted.elementType)
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        return len(given) == len(wanted) and all(assignable(a.dataType, b.dataType) for a, b in zip(given, wanted))
    if isinstance(given, (T.ArrayType, T.StructType, T.MapType)) or isinstance(wanted, (T.ArrayType, T.StructType, T.MapType)):
        return False
    if isinstance(wanted, T.StringType):
        return not isinstance(given, T.BinaryType)
    if isinstance(given, T.NumericType) and isinstance(wanted, T.NumericType):
        return True
    return isinstance(given, times) and isinstance(wanted, times)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select `schema`'s columns by name, as its types; types that can't be stored so are refused."""
    found = resolve(df, schema.fieldNames(), df.columns)
    missing = [f.name for f in schema if f.name not in found]
    if missing:
        raise ValueError(f"columns missing from the written rows: {missing}")
    wrong = [
        f"{f.name}: {df.schema[found[f.name]].dataType.simpleString()} into {f.dataType.simpleString()}"
        for f in schema
        if not assignable(df.schema[found[f.name]].dataType, f.dataType)
    ]
    if wrong:
        raise ValueError(f"types that cannot be stored, cast them first: {wrong}")
    return df.selectExpr(*[f"CAST({q(found[f.name])} AS {f.dataType.simpleString()}) AS {q(f.name)}" for f in schema])
