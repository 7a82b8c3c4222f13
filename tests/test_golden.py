"""Results of the known commit scripts."""

from __future__ import annotations

import pytest

from rowtide import (
    all_windows,
    case_windows,
    change_matrix,
    changelog_windows,
    create_changelog_view,
    label_updates,
    window_matrix,
)
from rowtide.operators.windows import change_counts
from rowtide.plans import reports
from scripts import bag, five_writes, new_history, seven_commits, three_rows, upsert

# window -> RAW inserts, RAW deletes, NET inserts, NET deletes
ALL_WINDOWS = {
    "(beginning, S0]": (2, 0, 2, 0),
    "(beginning, S1]": (4, 0, 4, 0),
    "(beginning, S2]": (5, 1, 4, 0),
    "(beginning, S3]": (6, 2, 4, 0),
    "(beginning, S4]": (6, 3, 3, 0),
    "(beginning, S5]": (7, 3, 4, 0),
    "(beginning, S6]": (9, 4, 5, 0),
    "(S0, S1]": (2, 0, 2, 0),
    "(S0, S2]": (3, 1, 2, 0),
    "(S0, S3]": (4, 2, 2, 0),
    "(S0, S4]": (4, 3, 1, 0),
    "(S0, S5]": (5, 3, 2, 0),
    "(S0, S6]": (7, 4, 3, 0),
    "(S1, S2]": (1, 1, 1, 1),
    "(S1, S3]": (2, 2, 1, 1),
    "(S1, S4]": (2, 3, 0, 1),
    "(S1, S5]": (3, 3, 1, 1),
    "(S1, S6]": (5, 4, 3, 2),
    "(S2, S3]": (1, 1, 1, 1),
    "(S2, S4]": (1, 2, 0, 1),
    "(S2, S5]": (2, 2, 1, 1),
    "(S2, S6]": (4, 3, 3, 2),
    "(S3, S4]": (0, 1, 0, 1),
    "(S3, S5]": (1, 1, 1, 1),
    "(S3, S6]": (3, 2, 3, 2),
    "(S4, S5]": (1, 0, 1, 0),
    "(S4, S6]": (3, 1, 3, 1),
    "(S5, S6]": (2, 1, 2, 1),
}

CASE_WINDOWS = {
    "W1 S1..S1": (2, 0, 2, 0),
    "W1.1 0..S1": (2, 0, 2, 0),
    "W2 S1..S2": (1, 1, 1, 1),
    "W2.1 0..S2": (3, 1, 2, 0),
    "W3 S1..S3": (2, 2, 1, 1),
    "W3.1 0..S3": (4, 2, 2, 0),
    "W4 S1..S4": (2, 3, 0, 1),
    "W4.1 0..S4": (4, 3, 1, 0),
    "W4 S1..S5": (3, 3, 1, 1),
    "W4.1 0..S5": (5, 3, 2, 0),
    "W4 S1..S6": (5, 4, 3, 2),
    "W4.1 0..S6": (7, 4, 3, 0),
    "W5 S2..S3": (1, 1, 1, 1),
    "W5.1 S2..S4": (1, 2, 0, 1),
    "W6 S3..S4": (0, 1, 0, 1),
    "W7 S4..S5": (1, 0, 1, 0),
    "W8 S5..S6": (2, 1, 2, 1),
    "W9 S1..S6": (5, 4, 3, 2),
}


@pytest.fixture(scope="module")
def script_a(spark, tmp_path_factory):
    return seven_commits(spark, tmp_path_factory.mktemp("a") / "h")


@pytest.fixture(scope="module")
def script_b(spark, tmp_path_factory):
    return seven_commits(spark, tmp_path_factory.mktemp("b") / "h", seed=False)


def lines(matrix):
    out = {}
    for r in matrix.collect():
        line = out.setdefault(r["window"], {})
        line[r["mode"]] = (r["INSERT"], r["DELETE"])
        assert r["UPDATE_BEFORE"] == r["UPDATE_AFTER"] == 0
    return {w: line["RAW"] + line["NET"] for w, line in out.items()}


def test_all_windows(script_a):
    windows = all_windows(reports.snapshot_labels(script_a))
    matrix = window_matrix(script_a.log(), windows, script_a.commit_pairs())
    assert lines(matrix) == ALL_WINDOWS
    titles = [r["window"] for r in matrix.collect()]
    assert titles == sorted(titles)


def test_all_windows_by_change_rows(script_a):
    windows = all_windows(reports.snapshot_labels(script_a))
    for commits in (script_a.commit_pairs(), None):
        changes = changelog_windows(script_a.log(), windows, commits)
        assert lines(change_matrix(change_counts(changes, "window", "mode"))) == ALL_WINDOWS


def test_all_windows_without_commit_list(script_a):
    windows = all_windows(reports.snapshot_labels(script_a))
    assert lines(window_matrix(script_a.log(), windows)) == ALL_WINDOWS


def test_each_window_alone(script_a):
    """Every window asked for on its own agrees with the matrix and is numbered from 0."""
    ids = [c.snapshot_id for c in script_a.commits]
    for start, end in [(None, 3), (2, 5), (2, 7), (4, 6), (5, 7)]:
        title = f"({'beginning' if start is None else f'S{ids.index(start)}'}, S{ids.index(end)}]"
        for net, at in ((False, 0), (True, 2)):
            found = script_a.changelog(start, end, net=net).collect()
            by_type = [sum(r["_change_type"] == t for r in found) for t in ("INSERT", "DELETE")]
            assert tuple(by_type) == ALL_WINDOWS[title][at : at + 2]
            for r in found:
                assert r["_change_ordinal"] == r["_commit_snapshot_id"] - (start or 0) - 1


def test_case_windows(script_b, spark):
    labels = {f"S{c.ordinal + 1}": c.ordinal for c in script_b.commits}
    matrix = window_matrix(script_b.log(), case_windows(spark, labels), script_b.commit_pairs())
    assert lines(matrix) == CASE_WINDOWS


def test_labels(script_a):
    labelled = bag(label_updates(script_a.log(), ["id", "company_id"]), "_change_type")
    assert labelled == {("INSERT",): 6, ("DELETE",): 1, ("UPDATE_BEFORE",): 3, ("UPDATE_AFTER",): 3}


def test_final_rows(script_a):
    assert bag(script_a.current(), "id", "payload") == {
        (1, '{"k":"A4"}'): 1,
        (2, '{"k":"B2"}'): 1,
        (3, '{"k":"C1"}'): 1,
        (98, '{"k":"Z98"}'): 1,
        (99, '{"k":"Z99"}'): 1,
    }


def test_reinsert_inside_a_window(script_a):
    """Deleted and inserted again: one INSERT from the beginning, a DELETE too when the old image came before."""
    one = script_a.changelog(None, 6, net=True).where("id = 1")
    assert bag(one, "_change_type", "payload") == {("INSERT", '{"k":"A4"}'): 1}
    one = script_a.changelog(4, 6, net=True).where("id = 1")
    assert bag(one, "_change_type", "payload") == {("DELETE", '{"k":"A3"}'): 1, ("INSERT", '{"k":"A4"}'): 1}


def test_net_counts_by_key(script_b):
    counts = reports.counts_by_key(script_b.changelog(1, 6, net=True), ["id", "company_id"])
    assert bag(counts, "id", "company_id", "_change_type", "n") == {
        (1, 10, "DELETE", 1): 1,
        (1, 10, "INSERT", 1): 1,
        (2, 10, "DELETE", 1): 1,
        (2, 10, "INSERT", 1): 1,
        (3, 10, "INSERT", 1): 1,
    }


def test_insert_then_merge(spark, tmp_path):
    h = new_history(spark, tmp_path / "h")
    first = h.insert(three_rows(spark))
    second = h.merge(upsert(spark))
    create_changelog_view(h, "clv", end=first)
    assert bag(spark.sql("SELECT _change_type, count(*) FROM clv GROUP BY _change_type")) == {("INSERT", 3): 1}
    create_changelog_view(h, "clv", start=first, end=second)
    assert bag(spark.table("clv"), "_change_type", "id", "payload", "_change_ordinal") == {
        ("DELETE", 2, '{"k":"b"}', 0): 1,
        ("INSERT", 2, '{"k":"merge-upd"}', 0): 1,
        ("INSERT", 5, '{"k":"merge-ins"}', 0): 1,
    }
    assert reports.first_value(h.snapshots(), "snapshot_id", "committed_at") == first
    assert reports.last_value(h.snapshots(), "snapshot_id") == second


def test_one_key_updated_twice(spark, tmp_path):
    h = new_history(spark, tmp_path / "h")
    h.insert(three_rows(spark))
    h.update({"payload": "'1st update'"}, "id = 1")
    h.update({"payload": "'2nd update'"}, "id = 1")
    assert bag(h.changelog(net=True), "_change_type", "id", "payload", "_change_ordinal") == {
        ("INSERT", 1, "2nd update", 2): 1,
        ("INSERT", 2, '{"k":"b"}', 0): 1,
        ("INSERT", 3, '{"k":"c"}', 0): 1,
    }


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("static", [("append", 3, 0), ("overwrite", 1, 1), ("overwrite", 1, 1), ("overwrite", 2, 1)]),
        ("dynamic", [("append", 3, 0), ("append", 1, 0), ("delete", 0, 1), ("overwrite", 1, 1), ("overwrite", 2, 1)]),
    ],
)
def test_five_write_kinds(spark, tmp_path, mode, expected):
    h = five_writes(spark, tmp_path / "h", mode)
    summary = reports.snapshot_summary(h).collect()
    assert [(r["operation"], r["added_records"], r["deleted_records"]) for r in summary] == expected
    assert summary[-1]["total_records"] == 4
    assert [r["parent_id"] for r in summary] == [None, *[r["snapshot_id"] for r in summary[:-1]]]
    assert bag(h.current(), "id", "company_id", "write_operation", "payload") == {
        (1, 10, 2, '{"k":"a"}'): 1,
        (2, 10, 1, '{"k":"merge-upd"}'): 1,
        (4, 10, 1, '{"k":"new"}'): 1,
        (5, 20, 1, '{"k":"merge-ins"}'): 1,
    }


def test_entries(spark, tmp_path):
    h = five_writes(spark, tmp_path / "h", "dynamic")
    assert bag(reports.partition_entries(h), "snapshot_id", "company_id", "status") == {
        (1, 10, "ADDED"): 1,
        (1, 20, "ADDED"): 1,
        (2, 10, "DELETED"): 1,
        (2, 10, "ADDED"): 1,
        (2, 20, "EXISTING"): 1,
        (3, 20, "DELETED"): 1,
        (3, 10, "EXISTING"): 1,
        (4, 10, "DELETED"): 1,
        (4, 10, "ADDED"): 1,
        (5, 10, "DELETED"): 1,
        (5, 10, "ADDED"): 1,
        (5, 20, "ADDED"): 1,
    }
    assert bag(reports.entry_counts(h).where("snapshot_id = 2")) == {(2, "ADDED", 1): 1, (2, "DELETED", 1): 1, (2, "EXISTING", 1): 1}


def test_commit_count_check(script_a, script_b):
    reports.assert_commit_count(script_a, 7)
    with pytest.raises(ValueError, match="expected 7 snapshots, got 6"):
        reports.assert_commit_count(script_b, 7)
