"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from rowtide.plans.oracle import ORACLE
from rowtide.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert list(QUERIES) == list(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, name, SF_DIR) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 56
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


def test_orders_of_any_priority_are_in_the_history(spark, tmp_path):
    """A null priority and an unknown one take part; the history agrees with its SQL."""
    odd = "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN 'other' ELSE o_orderpriority END"
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").withColumn("o_orderpriority", F.expr(odd))
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    own = duckdb.connect()
    own.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    for name in ("history_complete", "current_rows"):
        assert difference(spark, own, name, str(tmp_path)) is None
