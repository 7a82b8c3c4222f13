"""The commit scripts that the golden results belong to, and a plain model of a history."""

from __future__ import annotations

from collections import Counter
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from rowtide import History

SCHEMA = "id BIGINT, company_id INT, created_at TIMESTAMP, write_operation INT, payload STRING"
KEYS = ["id", "company_id"]


def rows(spark: SparkSession, *values: tuple) -> DataFrame:
    return spark.createDataFrame(
        [(i, c, datetime.fromisoformat(at), w, p) for i, c, at, w, p in values], SCHEMA
    )


def new_history(spark: SparkSession, path, schema: str = SCHEMA, keys=KEYS, partition_by=("company_id",)) -> History:
    return History.create(spark, str(path), schema, keys, partition_by)


def seven_commits(spark: SparkSession, path, seed: bool = True) -> History:
    """S0..S6, or S1..S6 without the seed commit."""
    h = new_history(spark, path)
    one = "id = 1 AND company_id = 10"
    if seed:
        h.insert(rows(spark, (98, 10, "2025-07-31", 2, '{"k":"Z98"}'), (99, 10, "2025-07-31T00:00:01", 2, '{"k":"Z99"}')))
    h.insert(rows(spark, (1, 10, "2025-08-01", 2, '{"k":"A"}'), (2, 10, "2025-08-01", 2, '{"k":"B"}')))
    h.update({"payload": """'{"k":"A2"}'""", "write_operation": "1"}, one)
    h.update({"payload": """'{"k":"A3"}'"""}, one)
    h.delete(one)
    h.insert(rows(spark, (1, 10, "2025-08-10", 1, '{"k":"A4"}')))
    h.merge(
        spark.sql(
            """SELECT 2 AS id, 10 AS company_id, TIMESTAMP '2025-08-11' AS created_at, 1 AS write_operation, '{"k":"B2"}' AS payload
               UNION ALL SELECT 3, 10, TIMESTAMP '2025-08-12', 1, '{"k":"C1"}'"""
        )
    )
    return h


def three_rows(spark: SparkSession) -> DataFrame:
    return rows(
        spark,
        (1, 10, "2025-08-01", 2, '{"k":"a"}'),
        (2, 10, "2025-08-02", 2, '{"k":"b"}'),
        (3, 20, "2025-08-03", 2, '{"k":"c"}'),
    )


def upsert(spark: SparkSession) -> DataFrame:
    return rows(spark, (2, 10, "2025-08-05", 1, '{"k":"merge-upd"}'), (5, 20, "2025-08-06", 1, '{"k":"merge-ins"}'))


def five_writes(spark: SparkSession, path, mode: str) -> History:
    h = new_history(spark, path)
    h.insert(three_rows(spark))
    kept = h.current().where("company_id = 10")
    h.overwrite(kept.unionByName(rows(spark, (4, 10, "2025-08-04", 2, '{"k":"new"}'))), mode)
    h.delete("id = 3 AND company_id = 20")
    h.update({"write_operation": "1"}, "company_id = 10 AND id = 4")
    h.merge(upsert(spark))
    return h


def bag(df: DataFrame, *columns: str) -> Counter:
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


# A plain model: commits are lists of (type, row), and everything is derived by counting.


def model_state(commits: list[list[tuple[str, tuple]]], end: int) -> Counter:
    state: Counter = Counter()
    for commit in commits[: end + 1]:
        for kind, row in commit:
            state[row] += 1 if kind == "INSERT" else -1
    assert min(state.values(), default=0) >= 0
    return +state


def model_net(commits: list[list[tuple[str, tuple]]], start: int, end: int) -> Counter:
    """(row, type, ordinal in the window) of what is left, found by cancelling one change at a time."""
    left: dict[tuple, list[tuple[str, int]]] = {}
    for ordinal, commit in enumerate(commits[start + 1 : end + 1]):
        for kind, row in commit:
            left.setdefault(row, []).append((kind, ordinal))
    out: Counter = Counter()
    for row, changes in left.items():
        balance = sum(1 if kind == "INSERT" else -1 for kind, _ in changes)
        wanted = "INSERT" if balance > 0 else "DELETE"
        same = sorted((o for kind, o in changes if kind == wanted), reverse=True)
        for ordinal in same[: abs(balance)]:
            out[(row, wanted, ordinal)] += 1
    return out
