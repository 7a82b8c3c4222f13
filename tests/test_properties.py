"""Random histories against a plain model: duplicate rows, null keys and no-op changes included.

Each example holds many scripts; a `script` column keeps their rows apart, so
one Spark job checks them all.
"""

from __future__ import annotations

import random
from collections import Counter
from itertools import accumulate

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rowtide import (
    all_windows,
    changelog_windows,
    diff_states,
    label_updates,
    merge_rows,
    net_changes,
    net_changes_by_key,
    update_rows,
    window_matrix,
)
from rowtide.operators import windows as window_ops
from rowtide.operators.changelog import changelog
from rowtide.operators.rows import repeat_rows, row_balance
from scripts import bag, model_net, model_state

ROW = st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "a", "b"]))
N_COMMITS = 5
LOG_SCHEMA = "script INT, k INT, v STRING, _change_type STRING, _change_ordinal INT, _commit_snapshot_id BIGINT"
SETTINGS = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)


@st.composite
def script(draw, unique_keys: bool = False):
    """A list of commits; a commit is a list of (type, row) whose deletes hit existing rows."""
    state: Counter = Counter()
    commits = []
    for _ in range(N_COMMITS):
        commit = []
        for _ in range(draw(st.integers(0, 3))):
            live = sorted(state.elements(), key=str)
            if live and draw(st.booleans()):
                row = draw(st.sampled_from(live))
                state[row] -= 1
                commit.append(("DELETE", row))
            else:
                row = draw(ROW)
                if unique_keys and (row[0] is None or any(r[0] == row[0] and n for r, n in state.items())):
                    continue
                state[row] += 1
                commit.append(("INSERT", row))
        # Opposite changes of one row in one commit are no change.
        net = Counter()
        for kind, row in commit:
            net[row] += 1 if kind == "INSERT" else -1
        commits.append([("INSERT" if n > 0 else "DELETE", r) for r, n in net.items() for _ in range(abs(n))])
    return commits


def log_of(spark, scripts):
    rows = [
        (s, *row, kind, o, o + 1) for s, commits in enumerate(scripts) for o, c in enumerate(commits) for kind, row in c
    ]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def labels(spark):
    return spark.range(N_COMMITS).selectExpr("concat('S', id) AS label", "CAST(id AS INT) AS ordinal")


def bounds():
    for end in range(N_COMMITS):
        for start in range(-1, end):
            yield f"({'beginning' if start < 0 else f'S{start}'}, S{end}]", start, end


COMMITS = [(o, o + 1) for o in range(N_COMMITS)]


@SETTINGS
@given(st.lists(script(), min_size=20, max_size=40))
def test_all_windows_agree_with_the_model(spark, scripts):
    log = log_of(spark, scripts).cache()
    windows = all_windows(labels(spark))
    net, raw = Counter(), Counter()
    for s, commits in enumerate(scripts):
        for title, start, end in bounds():
            for (row, kind, ordinal), n in model_net(commits, start, end).items():
                net[(title, s, *row, kind, ordinal, ordinal + start + 2)] += n
            for o in range(start + 1, end + 1):
                for kind, row in commits[o]:
                    raw[(title, s, *row, kind, o - start - 1, o + 1)] += 1
    columns = ["window", "script", "k", "v", "_change_type", "_change_ordinal", "_commit_snapshot_id"]
    for commits, rare in ((COMMITS, None), (None, None), (COMMITS, "DELETE"), (COMMITS, "INSERT")):
        changes = changelog_windows(log, windows, commits, rare=rare)
        assert bag(changes.where("mode = 'NET'"), *columns) == net
        assert bag(changes.where("mode = 'RAW'"), *columns) == raw
        counts = Counter()
        for mode, found in (("NET", net), ("RAW", raw)):
            for key, n in found.items():
                counts[(key[0], mode, key[4])] += n
        matrix = window_matrix(log, windows, commits, rare).collect()
        assert {(r["window"], r["mode"], t): r[t] for r in matrix for t in ("INSERT", "DELETE") if r[t]} == counts
    log.unpersist()


@SETTINGS
@given(st.lists(script(), min_size=20, max_size=40))
def test_versions_and_net_agree(spark, scripts):
    log = log_of(spark, scripts).cache()
    meta = ["_change_ordinal", "_commit_snapshot_id"]
    for start, end in [(-1, 4), (0, 3), (2, 4)]:
        inside = changelog(log, None if start < 0 else start, end)
        pairs = [(o - start - 1, i) for o, i in COMMITS if start < o <= end]
        by_sums, by_counts = net_changes(inside, pairs), net_changes(inside)
        assert bag(by_sums) == bag(by_counts)
        for rare in ("DELETE", "INSERT"):
            assert bag(net_changes(inside, pairs, rare=rare)) == bag(by_sums)
        assert bag(net_changes(by_sums, pairs)) == bag(by_sums)
        states = [
            repeat_rows(row_balance(log.where(f"_change_ordinal <= {o}").drop(*meta)), "_balance") for o in (start, end)
        ]
        expected = Counter()
        for s, commits in enumerate(scripts):
            for row, n in model_state(commits, end).items():
                expected[(s, *row)] += n
        assert bag(states[1], "script", "k", "v") == expected
        assert bag(diff_states(*states), "script", "k", "v", "_change_type") == bag(
            by_sums, "script", "k", "v", "_change_type"
        )
    log.unpersist()


@SETTINGS
@given(st.lists(script(unique_keys=True), min_size=20, max_size=40))
def test_net_by_key_is_net_by_row_when_keys_are_unique(spark, scripts):
    log = log_of(spark, scripts)
    columns = ["script", "k", "v", "_change_type"]
    for commits in (None, COMMITS):
        assert bag(net_changes_by_key(log, ["script", "k"], commits), *columns) == bag(net_changes(log), *columns)


@SETTINGS
@given(scripts=st.lists(script(), min_size=15, max_size=25))
def test_net_by_key_loses_nothing(spark, scripts):
    """With null keys and keys of several rows, signs add up as in the log, and whole rows do so for those keys."""
    log = log_of(spark, scripts).cache()
    net = net_changes_by_key(log, ["script", "k"], COMMITS)
    assert bag(net) == bag(net_changes_by_key(log, ["script", "k"]))
    signs = lambda df: bag(
        df.groupBy("script", "k").agg(F.expr("sum(IF(_change_type = 'INSERT', 1, -1)) AS n")).where("n <> 0"), "script", "k", "n"
    )
    assert signs(net) == signs(log)
    null = "k IS NULL"
    assert bag(net.where(null)) == bag(net_changes(log.where(null)).select(*net.columns))
    log.unpersist()


@SETTINGS
@given(st.lists(script(), min_size=20, max_size=40))
def test_labels_mark_single_pairs(spark, scripts):
    expected = Counter()
    for s, commits in enumerate(scripts):
        for o, commit in enumerate(commits):
            per_key = Counter((kind, row[0]) for kind, row in commit if row[0] is not None)
            for kind, (k, v) in commit:
                pair = per_key["DELETE", k] == per_key["INSERT", k] == 1
                label = kind if not pair else "UPDATE_BEFORE" if kind == "DELETE" else "UPDATE_AFTER"
                expected[(s, k, v, label, o, o + 1)] += 1
    assert bag(label_updates(log_of(spark, scripts), ["script", "k"])) == expected


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 9), ROW), max_size=60), st.dictionaries(st.tuples(st.integers(0, 9), st.sampled_from([1, 2])), st.sampled_from([None, "a", "z"]), max_size=20))
def test_merge_and_update(spark, rows, upserts):
    schema = "script INT, k INT, v STRING"
    state = spark.createDataFrame([(s, *r) for s, r in rows], schema)
    source = spark.createDataFrame([(s, k, v) for (s, k), v in upserts.items()], schema)
    expected, matched, after = Counter(), set(), Counter()
    for s, (k, v) in rows:
        matched.add((s, k))
        new = upserts.get((s, k), v)
        after[(s, k, new)] += 1
        if new != v:
            expected[("DELETE", s, k, v)] += 1
            expected[("INSERT", s, k, new)] += 1
    for (s, k), v in upserts.items():
        if (s, k) not in matched:
            expected[("INSERT", s, k, v)] += 1
            after[(s, k, v)] += 1
    assert bag(merge_rows(state, source, ["script", "k"])) == expected
    merged = spark.createDataFrame(list(after.elements()), schema)
    assert bag(merge_rows(merged, source, ["script", "k"])) == {}
    updated = Counter()
    for s, (k, v) in rows:
        if v == "a":
            updated[("DELETE", s, k, v)] += 1
            updated[("INSERT", s, k, "aa")] += 1
    assert bag(update_rows(state, {"v": "concat(v, v)"}, "v = 'a'")) == updated


def test_long_window_lists_take_the_join(spark, monkeypatch):
    """Past the literal and broadcast limits the same counts come from shuffle joins."""
    scripts = [[[("INSERT", (1, "a"))], [("DELETE", (1, "a")), ("INSERT", (1, "b"))], [], [("INSERT", (2, "a"))], []]]
    log, windows = log_of(spark, scripts), all_windows(labels(spark))
    expected = bag(window_matrix(log, windows, COMMITS))
    rows = bag(changelog_windows(log, windows, COMMITS))
    monkeypatch.setattr(window_ops, "LITERAL_WINDOWS", 3)
    monkeypatch.setattr(window_ops, "BROADCAST_RECORDS", 3)
    assert bag(window_matrix(log, windows, COMMITS)) == expected
    assert bag(changelog_windows(log, windows, COMMITS)) == rows


def test_many_commits_against_sums(spark):
    """200 commits: RAW and NET counts of all 20,100 windows, from plain sums per row."""
    draw, commits = random.Random(4), 200
    events = [{o: draw.choice([-2, -1, 1, 1, 2]) for o in draw.sample(range(commits), draw.randrange(1, 12))} for _ in range(40)]
    rows = [
        (1, k % 30, "x", "INSERT" if n > 0 else "DELETE", o, o + 1)
        for k, by_commit in enumerate(events) for o, n in by_commit.items() for _ in range(abs(n))
    ]
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    windows = all_windows(spark.range(commits).selectExpr("concat('S', id) AS label", "CAST(id AS INT) AS ordinal"))
    kinds = ("INSERT", "DELETE")
    per_row, raw = {}, {k: [0] * (commits + 1) for k in kinds}
    for _, k, _, kind, o, _ in rows:
        per_row.setdefault(k, [0] * (commits + 1))[o + 1] += 1 if kind == "INSERT" else -1
        raw[kind][o + 1] += 1
    totals = [list(accumulate(x)) for x in per_row.values()]
    raw = {k: list(accumulate(x)) for k, x in raw.items()}
    expected = {}
    for end in range(commits):
        for start in range(-1, end):
            left = [t[end + 1] - t[start + 1] for t in totals]
            title = f"({'beginning' if start < 0 else f'S{start}'}, S{end}]"
            expected[title, "NET"] = (sum(n for n in left if n > 0), -sum(n for n in left if n < 0))
            expected[title, "RAW"] = tuple(raw[k][end + 1] - raw[k][start + 1] for k in kinds)
    found = {(r.window, r["mode"]): (r["INSERT"], r["DELETE"]) for r in window_matrix(log, windows).collect()}
    assert found == {k: v for k, v in expected.items() if v != (0, 0)}
    net = changelog_windows(log, windows).where("mode = 'NET'").groupBy("window", "_change_type").count().collect()
    counted = Counter({(r["window"], r["_change_type"]): r["count"] for r in net})
    assert counted == Counter({(t, k): n for (t, m), both in expected.items() if m == "NET" for k, n in zip(kinds, both) if n})
