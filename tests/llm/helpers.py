"""Small tables for the tests of the llm package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, rows: list[tuple], *extra: str) -> DataFrame:
    """Rows of (doc_id, text, source); with `extra`, further columns (SQL) are added."""
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    df = spark.createDataFrame(full, DOCS).repartition(3)
    return df.selectExpr("*", *extra)


def find_groups(nodes, links):
    """Smallest node reachable from each node."""
    top = {n: n for n in nodes}

    def root(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
