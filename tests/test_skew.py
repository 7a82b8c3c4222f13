"""Hot keys and hot rows: the work is spread, and the results stay whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowtide import History, label_updates, merge_rows, net_changes, net_changes_by_key
from rowtide.operators import dml, rows as row_operators
from rowtide.operators.windows import fixed_windows, net_windows
from rowtide.sources import history
from scripts import bag

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_limits(spark):
    """The limits of adaptive execution scaled down to test data; every join shuffles."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scans_of(plan: str, path) -> int:
    """How often a final plan reads a table; exchanges that are used again are one reading."""
    return sum("FileScan" in line and str(path)[:60] in line for line in plan.splitlines())


def most_in_a_task(df) -> float:
    """The largest task's share of the rows."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def hot(spark, n=60_000):
    """A third of the rows have key 0."""
    return spark.range(n).selectExpr("IF(id % 3 = 0, 0, id) AS k", "uuid() AS v").repartition(8)


def test_update_pairs_with_a_hot_key(spark, small_limits, tmp_path):
    hot(spark).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    commit = "1 AS _change_ordinal, 2L AS _commit_snapshot_id"
    log = rows.selectExpr("*", "'DELETE' AS _change_type", *commit.split(", ")).unionAll(
        rows.selectExpr("k", "concat(v, 'x')", "'INSERT'", *commit.split(", "))
    )
    labelled = label_updates(log, ["k"])
    assert "skew=true" in final_plan(labelled)
    counts = bag(labelled.groupBy("_change_type").count())
    assert counts == {
        ("DELETE", 20_000): 1,
        ("INSERT", 20_000): 1,
        ("UPDATE_BEFORE", 40_000): 1,
        ("UPDATE_AFTER", 40_000): 1,
    }


def test_merge_into_a_table_with_a_hot_key(spark, small_limits, tmp_path, monkeypatch):
    monkeypatch.setattr(dml, "BROADCAST_HASHES", 1)
    hot(spark).write.parquet(str(tmp_path / "t"))
    state = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(0, 61_000).selectExpr("id AS k", "'new' AS v")
    changes = merge_rows(state, source, ["k"])
    assert most_in_a_task(changes.where("k = 0")) < 0.5
    assert scans_of(final_plan(changes), tmp_path / "t") == 1
    # Key 0 has 20,000 rows; multiples of three and the last thousand are new.
    assert bag(changes.groupBy("_change_type").count()) == {("DELETE", 60_000): 1, ("INSERT", 60_000 + 61_000 - 40_001): 1}


def test_merge_moves_each_row_of_its_source_once(spark, small_limits, monkeypatch):
    monkeypatch.setattr(dml, "BROADCAST_HASHES", 1)
    state = spark.range(0, 20_000).selectExpr("id AS k", "'old' AS v")
    source = spark.range(10_000, 30_000).selectExpr("id AS k", "IF(id % 2 = 0, 'old', 'new') AS v")
    changes = merge_rows(state, source, ["k"])
    assert "explode" not in final_plan(changes)
    assert bag(changes.groupBy("_change_type").count()) == {("DELETE", 5_000): 1, ("INSERT", 15_000): 1}


def test_merge_of_a_source_with_a_hot_new_key(spark, small_limits, tmp_path, monkeypatch):
    monkeypatch.setattr(dml, "BROADCAST_HASHES", 1)
    hot(spark).write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    state = spark.range(1, 30_000).selectExpr("id AS k", "'old' AS v")
    changes = merge_rows(state, source, ["k"])
    assert most_in_a_task(changes.where("k = 0")) < 0.5
    # Of the keys 1..29999, 9999 are multiples of three and not in the source; every source row is written.
    assert bag(changes.groupBy("_change_type").count()) == {("DELETE", 29_999 - 9_999): 1, ("INSERT", 60_000): 1}


def test_copies_are_added_up_before_the_shuffle(spark):
    """A row that makes up a third of the log leaves each task as one record."""
    rows = spark.range(0, 300_000, 1, 8).selectExpr("IF(id % 3 = 0, -1, id) AS k", "'INSERT' AS _change_type")
    log = rows.selectExpr("*", "0 AS _change_ordinal", "1L AS _commit_snapshot_id").where("k = -1")
    df = net_changes(log, [(0, 1)])
    assert bag(df.groupBy("k").agg(F.count("*").alias("n"))) == {(-1, 100_000): 1}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_sum")


def test_net_by_key_reads_the_log_once(spark, small_limits, tmp_path):
    """A hot key of one row at a time, a hot null key and a hot key of several rows, from one scan."""
    rows = spark.range(90_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 3 = 1 THEN NULL ELSE id END AS k", "CAST(id DIV 2 AS STRING) AS v",
        "IF(id % 2 = 0, 'INSERT', 'DELETE') AS _change_type", "CAST(id % 2 AS INT) AS _change_ordinal", "id % 2 + 1 AS _commit_snapshot_id",
    )
    rows.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    for commits in ([(0, 1), (1, 2)], None):
        net = net_changes_by_key(log, ["k"], commits)
        assert scans_of(final_plan(net), tmp_path) == 1
        by_row = net_changes(log.where("k IS NULL OR k = 0")).unionAll(log.where("k <> 0"))
        assert bag(net) == bag(by_row.select(*net.columns))


def test_a_hot_partition_of_equal_rows_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """They are a few bytes in a shuffle, but a task sorts no more than its share of them."""
    monkeypatch.setattr(history, "ROWS_PER_TASK", 10_000, raising=False)
    monkeypatch.setattr(row_operators, "COPIES_PER_TASK", 10_000)
    h = History.create(spark, str(tmp_path / "h"), "p STRING, k BIGINT", keys=["p", "k"], partition_by=["p"])
    rows = spark.range(0, 80_000, 1, 8).selectExpr("IF(id % 8 = 0, 'b', 'a') AS p", "CAST(NULL AS BIGINT) AS k")
    h.insert(rows)
    h.overwrite(rows.where("p = 'a'").unionAll(rows))
    h.materialize()
    for stored in (h.log(end=1), h.log(start=1), h.spark.read.parquet(h._state_path(2))):
        held = [r["count"] for r in stored.where("p = 'a'").groupBy("_metadata.file_path").count().collect()]
        assert sum(held) in (70_000, 140_000) and max(held) < 0.5 * sum(held)
    assert bag(h.current().groupBy("p", "k").count()) == {("a", None, 140_000): 1, ("b", None, 10_000): 1}


def test_windows_are_worked_out_again_for_rows_with_many_copies_only(spark, monkeypatch):
    text = "id % 6 AS k", "CAST(id % 4 AS INT) AS _change_ordinal", "id % 4 + 1 AS _commit_snapshot_id", "IF(id % 12 = 3, 'DELETE', 'INSERT') AS _change_type"
    log = spark.range(60).selectExpr(*text).unionAll(spark.range(9).selectExpr("0L", "2", "3L", "'INSERT'"))
    windows = fixed_windows(spark, [(f"{a}..{b}", a, b) for b in range(4) for a in range(b + 1)])
    for commits, hot in ((None, "exists(_events"), ([(i, i + 1) for i in range(4)], "greatest(abs(")):
        expected = bag(net_windows(log, windows, commits, at_most=69))
        monkeypatch.setattr(row_operators, "COPIES_PER_TASK", 5)
        found = net_windows(log, windows, commits)
        assert bag(found) == expected and max(expected.values()) > 5
        assert hot in found._jdf.queryExecution().optimizedPlan().toString()
        monkeypatch.undo()
