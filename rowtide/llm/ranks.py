"""Places of rows in a total order over the whole table, without gathering any part of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import fresh, keep

# Rows of a sorted part, about.
PART_ROWS = 500_000


def part_count(df: DataFrame, rows: int, each: int = PART_ROWS) -> int:
    """Parts for a sort: the session's, or more where parts would have over `each` rows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def ranked(df: DataFrame, order: list[str], name: str, rows: int | None = None) -> DataFrame:
    """The rows, written, with their place (from 0) in the order of `order`; nulls come first, ties in any order.

    Parts are ranges of the order, so equal leading keys spread over many of them; the
    driver and the joins see one count per part. `order` should tell rows apart: rows that are
    equal in all of it lie in one part.
    """
    part, at, before = fresh(df, "_part", "_at", "_before")
    parts = part_count(df, df.count() if rows is None else rows)
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = keep(
        dealt.selectExpr("*", f"spark_partition_id() AS {part}", f"monotonically_increasing_id() & {(1 << 33) - 1} AS {at}")
    )
    counts = placed.groupBy(part).agg(F.expr(f"count(*) AS {before}"))  # one record per part
    sums = counts.selectExpr(part, f"sum({before}) OVER (ORDER BY {part}) - {before} AS {before}")
    return placed.join(F.broadcast(sums), part).selectExpr(
        *[f"`{c}`" for c in df.columns], f"{before} + {at} AS {name}"
    )
