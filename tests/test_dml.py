"""Row-level writes: edge inputs."""

from __future__ import annotations

import pytest

from rowtide import delete_rows, diff_states, insert_rows, key_violations, merge_rows, overwrite_rows, update_rows
from rowtide.operators import dml
from scripts import bag

SCHEMA = "k BIGINT, p INT, v STRING"


def df(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_insert_casts_and_keeps_duplicates(spark):
    state = df(spark)
    source = spark.sql("SELECT 1 AS k, 2 AS p, 'x' AS v, 'unused' AS extra UNION ALL SELECT 1, 2, 'x', ''")
    changes = insert_rows(state, source)
    assert changes.schema["k"].dataType == state.schema["k"].dataType
    assert bag(changes) == {("INSERT", 1, 2, "x"): 2}
    with pytest.raises(ValueError, match="missing"):
        insert_rows(state, source.drop("v"))


def test_delete_keeps_rows_with_a_null_predicate(spark):
    state = df(spark, (1, 1, "a"), (2, None, "b"))
    assert bag(delete_rows(state, "p = 1")) == {("DELETE", 1, 1, "a"): 1}
    assert bag(delete_rows(state, "p <> 1")) == {}


def test_update_sees_the_old_values_and_skips_no_ops(spark):
    state = df(spark, (1, 1, "a"), (2, 2, None), (3, 3, "c"), (3, 3, "c"))
    changes = update_rows(state, {"p": "p + k", "v": "coalesce(v, CAST(p AS STRING))"}, "k <= 2")
    assert bag(changes) == {
        ("DELETE", 1, 1, "a"): 1,
        ("INSERT", 1, 2, "a"): 1,
        ("DELETE", 2, 2, None): 1,
        ("INSERT", 2, 4, "2"): 1,
    }
    assert bag(update_rows(state, {"v": "v"})) == {}
    assert bag(update_rows(state, {"v": "'d'"}, "k = 3")) == {("DELETE", 3, 3, "c"): 2, ("INSERT", 3, 3, "d"): 2}
    with pytest.raises(ValueError, match="no such columns"):
        update_rows(state, {"w": "1"})


def test_merge_with_null_keys_duplicates_and_no_ops(spark):
    state = df(spark, (1, 1, "a"), (1, 1, "b"), (None, 1, "n"), (4, 1, "same"))
    source = df(spark, (1, 1, "z"), (None, 1, "n"), (4, 1, "same"), (5, 1, "new"), (5, 1, "new"))
    assert bag(merge_rows(state, source, ["k", "p"])) == {
        ("DELETE", 1, 1, "a"): 1,
        ("DELETE", 1, 1, "b"): 1,
        ("INSERT", 1, 1, "z"): 2,
        ("INSERT", None, 1, "n"): 1,
        ("INSERT", 5, 1, "new"): 2,
    }


def test_merge_resolves_columns_by_name(spark):
    state = df(spark, (1, 1, "a"))
    source = spark.sql("SELECT 'b' AS v, 1 AS p, 1 AS k")
    assert bag(merge_rows(state, source, ["k"])) == {("DELETE", 1, 1, "a"): 1, ("INSERT", 1, 1, "b"): 1}


def test_merge_of_a_large_source_gives_the_same(spark, monkeypatch):
    state = df(spark, (1, 1, "a"), (2, 1, "b"), (None, 1, "n"))
    source = df(spark, (1, 1, "z"), (3, 1, "c"), (None, 1, "n"))
    small = bag(merge_rows(state, source, ["k"]))
    monkeypatch.setattr(dml, "BROADCAST_HASHES", 1)
    assert bag(merge_rows(state, source, ["k"])) == small


def test_merge_with_two_source_rows_for_one_row_fails(spark):
    state = df(spark, (1, 1, "a"))
    source = df(spark, (1, 1, "b"), (1, 1, "c"))
    with pytest.raises(Exception, match="several rows"):
        merge_rows(state, source, ["k"]).collect()


def test_merge_only_checks_source_rows_that_match(spark):
    """Several new rows of one key are fine, also where nothing but keys is compared."""
    new = df(spark, (7, 1, "a"), (7, 1, "a"))
    state = spark.range(3).selectExpr("id AS k", "1 AS p", "'old' AS v")
    assert bag(merge_rows(state, new, ["k"])) == {("INSERT", 7, 1, "a"): 2}
    assert bag(merge_rows(state, new, ["k", "p", "v"])) == {("INSERT", 7, 1, "a"): 2}
    with pytest.raises(Exception, match="several rows"):
        merge_rows(state, df(spark, (1, 1, "old"), (1, 1, "old")), ["k", "p", "v"]).collect()


def test_overwrite_modes(spark):
    state = df(spark, (1, 1, "a"), (1, 1, "a"), (2, 2, "b"), (3, None, "n"))
    rows = df(spark, (1, 1, "a"), (9, None, "n"))
    assert bag(overwrite_rows(state, rows)) == {
        ("DELETE", 1, 1, "a"): 1,
        ("DELETE", 2, 2, "b"): 1,
        ("DELETE", 3, None, "n"): 1,
        ("INSERT", 9, None, "n"): 1,
    }
    assert bag(overwrite_rows(state, rows, "dynamic", ["p"])) == {
        ("DELETE", 1, 1, "a"): 1,
        ("DELETE", 3, None, "n"): 1,
        ("INSERT", 9, None, "n"): 1,
    }
    with pytest.raises(ValueError, match="partition columns"):
        overwrite_rows(state, rows, "dynamic")
    with pytest.raises(ValueError, match="unknown overwrite mode"):
        overwrite_rows(state, rows, "merge")


def test_diff_agrees_with_except_all(spark):
    a = df(spark, (1, 1, "a"), (1, 1, "a"), (None, None, None), (2, 1, "b"))
    b = df(spark, (1, 1, "a"), (None, None, None), (None, None, None), (3, 1, "c"))
    gone = a.exceptAll(b).selectExpr("'DELETE' AS _change_type", "*")
    new = b.exceptAll(a).selectExpr("'INSERT' AS _change_type", "*")
    assert bag(diff_states(a, b)) == bag(gone.unionAll(new))


def test_floating_point_rows_are_compared_like_groups(spark):
    a = spark.sql("SELECT double('NaN') AS x UNION ALL SELECT -0.0D")
    b = spark.sql("SELECT double('NaN') AS x UNION ALL SELECT 0.0D")
    assert bag(diff_states(a, b)) == {}


def test_key_violations(spark):
    rows = df(spark, (1, 1, "a"), (1, 1, "b"), (2, 1, "c"), (None, 1, "d"))
    assert bag(key_violations(rows, ["k", "p"])) == {(1, 1, 2, False): 1, (None, 1, 1, True): 1}
