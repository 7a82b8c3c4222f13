"""Run the registered queries next to their SQL and compare whole results."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rowtide.plans.oracle import ORACLE
from rowtide.plans.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


# DuckDB's name of each Spark type that a registered query returns.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when columns and multisets of rows agree, otherwise what differs."""
    got = QUERIES[name](spark, sf_dir)
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in want.description}
    wrong = {c: (t, kinds[c]) for c, t in got.dtypes if TYPES.get(t) != kinds[c]}
    if wrong:
        return f"types {wrong}"
    expected = Counter(want.fetchall())
    actual = Counter(tuple(r) for r in got.select(*[f"`{c}`" for c in names]).collect())
    if actual != expected:
        extra, missing = actual - expected, expected - actual
        return f"{sum(extra.values())} extra e.g. {next(iter(extra), None)}; {sum(missing.values())} missing e.g. {next(iter(missing), None)}"
    return None


if __name__ == "__main__":
    from conftest import session

    spark = session()
    sf_dir = sys.argv[1]
    con = connect(sf_dir)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            found = difference(spark, con, name, sf_dir)
        except Exception as e:
            found = "ERROR " + str(e)[:600]
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
