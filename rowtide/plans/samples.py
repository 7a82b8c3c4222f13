"""Histories over the driver's tables: every row of the source table takes part in the commits."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.sources.history import History

BASE_TIME = datetime(2025, 8, 1)

_built: dict[tuple[str, str, str], History] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """A fresh folder under the session's checkpoint folder or its warehouse, which all executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/history-{uuid.uuid4().hex}"


def _cached(spark: SparkSession, sf_dir: str, name: str, build) -> History:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build(spark, sf_dir, work_dir(spark))
    history = _built[key]
    return History(spark, history.path, history.schema, history.keys, history.partition_by, list(history.commits), history.buckets, history.directories)


def orders_history(spark: SparkSession, sf_dir: str) -> History:
    """The seven commits S0..S6 over `orders`, built once per application."""
    return _cached(spark, sf_dir, "orders", build_orders_history)


def lineitem_history(spark: SparkSession, sf_dir: str) -> History:
    """Three commits over `lineitem` reduced to columns with many equal rows, built once per application."""
    return _cached(spark, sf_dir, "lineitem", build_lineitem_history)


def merge_source(orders: DataFrame) -> DataFrame:
    """S6's source: raised prices for one class, unchanged rows of another, and a new class."""
    medium = orders.where("o_orderpriority = '3-MEDIUM'").withColumn("o_totalprice", F.expr("o_totalprice + 2"))
    return medium.unionByName(orders.where("o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED')"))


def build_orders_history(spark: SparkSession, sf_dir: str, path: str) -> History:
    """Insert two batches, update a class twice, delete it, insert it again, then merge."""
    orders = table(spark, sf_dir, "orders")
    at = lambda k: BASE_TIME + timedelta(minutes=k)
    h = History.create(spark, path, orders.schema, keys=["o_orderkey"], partition_by=["o_orderstatus"])
    high = "o_orderpriority = '2-HIGH'"
    # The first batch also takes rows of no known priority, so that no row is left out.
    known = "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"
    h.insert(orders.where(f"coalesce(NOT {known}, TRUE)"), at(0))
    h.insert(orders.where("o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"), at(1))
    h.update({"o_totalprice": "o_totalprice + 1", "o_orderstatus": "'P'"}, high, at(2))
    h.update({"o_totalprice": "o_totalprice + 1"}, high, at(3))
    h.delete(high, at(4))
    h.insert(orders.where(high).withColumn("o_orderdate", F.expr("o_orderdate + INTERVAL 9 DAYS")), at(5))
    h.merge(merge_source(orders), committed_at=at(6))
    return h


# Commits of the long history, classes of keys, and how many commits a class lives.
LONG_COMMITS, LONG_LIFE = 24, 7


def long_history(spark: SparkSession, sf_dir: str) -> History:
    """24 commits over `customer`, built once per application."""
    return _cached(spark, sf_dir, "long", build_long_history)


def build_long_history(spark: SparkSession, sf_dir: str, path: str) -> History:
    """Each commit inserts a class of customers twice and deletes one copy of an earlier class.

    Customers without a key are in class 0. A nation has few rows in a commit, and nations grow with the table, so they share files.
    """
    columns = ["c_custkey", "c_nationkey", "c_mktsegment"]
    customer = table(spark, sf_dir, "customer").select(*columns)
    of_class = lambda k: customer.where(f"coalesce(pmod(c_custkey, {LONG_COMMITS}), 0) = {k}")
    h = History.create(spark, path, customer.schema, keys=["c_custkey"], partition_by=["c_nationkey"], directories=False)
    for k in range(LONG_COMMITS):
        new = of_class(k).withColumn("_copy", F.expr("explode(array(1, 2))")).drop("_copy")
        changes = new.selectExpr("'INSERT' AS _change_type", "*")
        if k >= LONG_LIFE:
            changes = changes.unionAll(of_class(k - LONG_LIFE).selectExpr("'DELETE' AS _change_type", "*"))
        h.append_commit(changes, BASE_TIME + timedelta(minutes=k))
    return h


LINEITEM_COLUMNS = ["l_suppkey", "l_returnflag", "l_linestatus"]


def lineitem_replacement(lineitem: DataFrame) -> DataFrame:
    """The overwrite's rows: more copies of some rows than before, fewer of others."""
    parts = ["l_linestatus = 'O'", "l_discount > 0.07", "l_returnflag = 'A'"]
    first, *rest = [lineitem.where(p).select(*LINEITEM_COLUMNS) for p in parts]
    for part in rest:
        first = first.unionAll(part)
    return first


def build_lineitem_history(spark: SparkSession, sf_dir: str, path: str) -> History:
    """Insert all rows, insert more copies of some, then overwrite the table."""
    lineitem = table(spark, sf_dir, "lineitem")
    at = lambda k: BASE_TIME + timedelta(minutes=k)
    rows = lineitem.select(*LINEITEM_COLUMNS)
    h = History.create(spark, path, rows.schema, keys=LINEITEM_COLUMNS, partition_by=["l_returnflag"])
    h.insert(rows, at(0))
    h.insert(lineitem.where("l_quantity > 25").select(*LINEITEM_COLUMNS), at(1))
    h.overwrite(lineitem_replacement(lineitem), committed_at=at(2))
    return h
