"""Many change windows at once.

A window is `(title, start_ordinal, end_ordinal)`: start exclusive, null for
"from the beginning", end inclusive. Window lists and per-commit counts are
metadata: their size depends on the number of commits, never on the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowtide.model import (
    CHANGE_ORDINAL,
    CHANGE_TYPE,
    CHANGE_TYPES,
    SNAPSHOT_ID,
    change_type_of,
    quoted,
    row_columns,
)
from rowtide.operators.rows import (
    Commits,
    as_change_rows_of,
    commit_counts,
    commit_sums,
    inlined,
    last_changes_of_sums,
    split_untouched,
    splittable_join,
    sum_names,
)

# A metadata table is broadcast when it was counted to have at most this many records.
BROADCAST_RECORDS = 200_000

# A window list of at most this length becomes a literal of the plan.
LITERAL_WINDOWS = 500

# Name, start and end label of the standard case windows ("0" = the beginning).
CASE_WINDOWS = [
    ("W1", "S1", "S1"),
    ("W1.1", "0", "S1"),
    ("W2", "S1", "S2"),
    ("W2.1", "0", "S2"),
    ("W3", "S1", "S3"),
    ("W3.1", "0", "S3"),
    ("W4", "S1", "S4"),
    ("W4.1", "0", "S4"),
    ("W4", "S1", "S5"),
    ("W4.1", "0", "S5"),
    ("W4", "S1", "S6"),
    ("W4.1", "0", "S6"),
    ("W5", "S2", "S3"),
    ("W5.1", "S2", "S4"),
    ("W6", "S3", "S4"),
    ("W7", "S4", "S5"),
    ("W8", "S5", "S6"),
    ("W9", "S1", "S6"),
]


def all_windows(labels: DataFrame) -> DataFrame:
    """Every window over the labelled commits: from the beginning and between any two.

    `labels` has `label` and `ordinal`; each commit unfolds its own list of starts.
    """
    ends = labels.selectExpr(
        "label AS _end", "CAST(ordinal AS INT) AS end_ordinal", "explode(sequence(-1, CAST(ordinal AS INT) - 1)) AS _start"
    )
    starts = labels.selectExpr("label AS _from", "CAST(ordinal AS INT) AS _start")
    return ends.join(starts, "_start", "left").selectExpr(
        "concat('(', coalesce(_from, 'beginning'), ', ', _end, ']') AS title",
        "IF(_start >= 0, _start, NULL) AS start_ordinal",
        "end_ordinal",
    )


def case_windows(
    spark: SparkSession,
    ordinals: Mapping[str, int],
    cases: Sequence[tuple[str, str, str]] = tuple(CASE_WINDOWS),
) -> DataFrame:
    """Named windows between labels. A window that starts at its own end means "from the beginning"."""
    rows = []
    for name, start, end in cases:
        unknown = [x for x in (start, end) if x != "0" and x not in ordinals]
        if unknown:
            raise ValueError(f"unknown labels {unknown} in window {name}")
        whole = start in ("0", end)
        if not whole and ordinals[start] > ordinals[end]:
            raise ValueError(f"window {name} starts after its end")
        rows.append((f"{name} {start}..{end}", 0 if whole else ordinals[start] + 1, ordinals[end]))
    return fixed_windows(spark, rows)


def _commits_of(windows: DataFrame) -> DataFrame:
    """One record per window and commit ordinal inside it."""
    first = "coalesce(start_ordinal + 1, 0)"
    return windows.where(f"{first} <= end_ordinal").selectExpr(
        "title AS window", f"{first} AS _first", f"explode(sequence({first}, end_ordinal)) AS _ordinal"
    )


def _listed(windows: DataFrame) -> list[tuple[str, int, int]] | None:
    """A short window list as (title, first, last) ordinals; None when it is long."""
    known = windows.limit(LITERAL_WINDOWS + 1).collect()
    if len(known) > LITERAL_WINDOWS:
        return None
    return [(w.title, 0 if w.start_ordinal is None else w.start_ordinal + 1, w.end_ordinal) for w in known]


def _literal(listed: list[tuple[str, int, int]]) -> str:
    """SQL text of an array of (title, first, last)."""
    texts = [f"struct({_text(title)} AS title, {first} AS first, {last} AS last)" for title, first, last in listed]
    return f"array({', '.join(texts)})"


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _small(pairs: DataFrame, listed: list[tuple[str, int, int]] | None) -> DataFrame:
    """Broadcast the commits of windows where their number is known; otherwise an ordinary shuffle join follows."""
    if listed is not None:
        n = sum(max(0, last - first + 1) for _, first, last in listed)
    else:
        n = pairs.limit(BROADCAST_RECORDS + 1).count()
    return F.broadcast(pairs) if n <= BROADCAST_RECORDS else pairs


def raw_windows(log: DataFrame, windows: DataFrame) -> DataFrame:
    """RAW change rows of every window: an equi-join on the commit ordinal."""
    inside = _small(_commits_of(windows), _listed(windows))
    return log.join(inside, log[CHANGE_ORDINAL] == inside["_ordinal"]).selectExpr(
        "window",
        "'RAW' AS mode",
        *quoted(row_columns(log)),
        CHANGE_TYPE,
        f"CAST({CHANGE_ORDINAL} - _first AS INT) AS {CHANGE_ORDINAL}",
        SNAPSHOT_ID,
    )


def net_windows(
    log: DataFrame,
    windows: DataFrame,
    commits: Commits | None = None,
    at_most: int | None = None,
    rare: str | None = None,
) -> DataFrame:
    """NET change rows of every window; see `net_changes` for the arguments.

    With few commits and a short list, the log is shuffled once and each row
    works out its windows on the spot. Otherwise it works out its distinct outcomes, from its list of
    events, at most one per commit, and windows are joined to these; those in which nothing is left of a row
    never meet it.
    """
    if rare is not None:
        untouched, touched = split_untouched(log, rare)
        unchanged = raw_windows(untouched, windows).withColumn("mode", F.lit("NET"))
        return unchanged.unionByName(net_windows(touched, windows, commits, at_most))
    rows = row_columns(log)
    listed = _listed(windows)
    columns = ["window", "mode", *rows, CHANGE_TYPE, CHANGE_ORDINAL, SNAPSHOT_ID]
    if listed and inlined(commits):

        def left_of(sums: DataFrame) -> DataFrame:
            each = sums.selectExpr("*", f"explode({_literal(listed)}) AS _window")
            left = last_changes_of_sums(each, commits, "_window.first", "_window.last")
            return left.selectExpr("*", "_window.title AS window", "'NET' AS mode")

        most = lambda n: f"greatest({', '.join(f'abs({x})' for x in sum_names(commits))}, 0) > {n}"
        return as_change_rows_of(commit_sums(log, commits), most, left_of, columns, at_most)
    most = lambda n: f"exists(_events, e -> abs(e.n) > {n})"
    left_of = lambda events: _left_of_events(events, rows, windows).selectExpr("*", "'NET' AS mode")
    return as_change_rows_of(_events_of(log), most, left_of, columns, at_most)


_EVENT = "struct<ordinal: int, snapshot_id: bigint, copies: bigint>"

# Windows with the same start that are one record of a join at most.
CHUNK_WINDOWS = 256


def _outcomes(last: int) -> str:
    """SQL of the outcomes of a row's sorted `_events` (`ordinal`, `n`), for windows up to commit `last`.

    What a window leaves of a row depends on the first and the last event inside it alone. With e events there are
    e (e + 1) / 2 such pairs (`a`, `b`: their places); each holds for a range of starts and a range of ends.
    """
    sums = "aggregate(_events, array(0L), (x, e) -> array_append(x, element_at(x, -1) + e.n))"
    pair = (
        "struct(a AS a, b AS b, coalesce(get(_events, a - 1).ordinal + 1, 0) AS s_lo, _events[a].ordinal AS s_hi, "
        f"_events[b].ordinal AS e_lo, coalesce(get(_events, b + 1).ordinal - 1, {last}) AS e_hi, x[b + 1] - x[a] AS balance)"
    )
    places = "size(_events) - 1"
    pairs = f"flatten(transform(sequence(0, {places}), a -> transform(sequence(a, {places}), b -> {pair})))"
    return f"transform(array({sums}), x -> filter({pairs}, o -> o.balance <> 0))[0]"


def _last_end(windows: DataFrame) -> int | None:
    return windows.selectExpr("max(end_ordinal)").first()[0]


def _events_of(log: DataFrame) -> DataFrame:
    """Distinct rows with their sorted `_events` (`ordinal`, `snapshot_id`, `n`)."""
    event = f"struct({CHANGE_ORDINAL} AS ordinal, {SNAPSHOT_ID} AS snapshot_id, _n AS n)"
    return commit_counts(log).groupBy(*quoted(row_columns(log))).agg(F.expr(f"array_sort(collect_list({event})) AS _events"))


def _left_of_events(events: DataFrame, columns: Sequence[str], windows: DataFrame) -> DataFrame:
    """The last |balance| changes of the balance's sign of every row (`columns`) and window: `window`, the row,
    `_sign`, `_ordinal`, `_snapshot_id`, `_copies`.

    Each distinct outcome of a row is worked out once, and then joined to the windows that it holds for: by
    start, with lists of ends of bounded length.
    """
    rows, last = quoted(columns), _last_end(windows)
    step = (
        "struct(greatest(a.left - abs(e.n), 0L) AS left, IF(a.left > 0, array_append(a.out, "
        "struct(CAST(e.ordinal AS INT) AS ordinal, e.snapshot_id AS snapshot_id, least(abs(e.n), a.left) AS copies)), a.out) AS out)"
    )
    same = "filter(slice(_events, _o.a + 1, _o.b - _o.a + 1), e -> signum(e.n) = signum(_o.balance))"
    left = f"aggregate(reverse({same}), struct(abs(_o.balance) AS left, CAST(array() AS array<{_EVENT}>) AS out), (a, e) -> {step}).out"
    outcomes = (
        events.selectExpr(*rows, "_events", f"explode({_outcomes(-1 if last is None else last)}) AS _o")
        .where(f"_o.e_lo <= {-1 if last is None else last}")
        .selectExpr(*rows, "_o", f"{left} AS _left")
        .selectExpr(*rows, "_o.e_lo AS _e_lo", "_o.e_hi AS _e_hi", "IF(_o.balance > 0, 1, -1) AS _sign", "_left", "explode(sequence(_o.s_lo, _o.s_hi)) AS _first")
    )
    bounds = windows.selectExpr("title", "coalesce(start_ordinal + 1, 0) AS _first", "end_ordinal AS _end")
    placed = bounds.selectExpr("*", f"(row_number() OVER (PARTITION BY _first ORDER BY _end, title) - 1) DIV {CHUNK_WINDOWS} AS _chunk")
    chunks = placed.groupBy("_first", "_chunk").agg(F.expr("collect_list(struct(title, _end)) AS _ends")).drop("_chunk")
    if windows.limit(BROADCAST_RECORDS + 1).count() <= BROADCAST_RECORDS:
        met = outcomes.join(F.broadcast(chunks), "_first")
    else:
        met = splittable_join(outcomes, chunks, ["_first"], "inner")
    return (
        met.selectExpr("*", "explode(filter(_ends, w -> w._end BETWEEN _e_lo AND _e_hi)) AS _window")
        .selectExpr(*rows, "_first", "_window.title AS window", "_sign", "explode(_left) AS _change")
        .selectExpr(
            "window", *rows, "_sign", "_change.ordinal - _first AS _ordinal", "_change.snapshot_id AS _snapshot_id", "_change.copies AS _copies"
        )
    )


def _signatures(log: DataFrame) -> DataFrame:
    """Distinct lists of events, with the number of rows (`_rows`) that have them."""
    events = f"array_sort(collect_list(struct({CHANGE_ORDINAL} AS ordinal, _n AS n))) AS _events"
    per_row = commit_counts(log).groupBy(*quoted(row_columns(log))).agg(F.expr(events))
    return per_row.groupBy("_events").agg(F.expr("count(*) AS _rows"))


def swept_counts(alike: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, mode, type, n) of many windows from signatures: a sweep over a summed-area table.

    An outcome holds for a rectangle of starts and ends. Its count is added at the rectangle's four corners,
    and prefix sums over starts, then over ends, give the counts of all windows: commits squared,
    but neither rows nor signatures times windows.
    """
    last = _last_end(windows)
    last = -1 if last is None else last
    each = alike.selectExpr("_rows", f"explode({_outcomes(last)}) AS o").where(f"o.e_lo <= {last}")
    n = "abs(o.balance) * _rows"
    corners = [
        f"struct(o.s_lo AS s, o.e_lo AS e, {n} AS n)", f"struct(o.s_hi + 1 AS s, o.e_lo AS e, -{n} AS n)",
        f"struct(o.s_lo AS s, o.e_hi + 1 AS e, -{n} AS n)", f"struct(o.s_hi + 1 AS s, o.e_hi + 1 AS e, {n} AS n)",
    ]
    added = each.selectExpr(f"{change_type_of('o.balance')} AS {CHANGE_TYPE}", f"inline(array({', '.join(corners)}))")
    added = added.groupBy(CHANGE_TYPE, "s", "e").agg(F.expr("sum(n) AS n"))
    types = f"explode(array({', '.join(repr(t) for t in CHANGE_TYPES[:2])})) AS {CHANGE_TYPE}"
    grid = alike.sparkSession.range(last + 1).selectExpr("CAST(id AS INT) AS s", f"explode(sequence(0, {last})) AS e")
    cells = added.unionByName(grid.selectExpr(types, "s", "e", "0L AS n")).groupBy(CHANGE_TYPE, "s", "e").agg(F.expr("sum(n) AS n"))
    swept = cells.selectExpr("*", f"sum(n) OVER (PARTITION BY {CHANGE_TYPE}, e ORDER BY s) AS _by_start").selectExpr(
        CHANGE_TYPE, "s", "e", f"sum(_by_start) OVER (PARTITION BY {CHANGE_TYPE}, s ORDER BY e) AS n"
    )
    asked = windows.selectExpr("title AS window", "coalesce(start_ordinal + 1, 0) AS s", "end_ordinal AS e")
    found = asked.join(swept.where("n > 0"), ["s", "e"])
    return found.groupBy("window", F.expr("'NET' AS mode"), CHANGE_TYPE).agg(F.expr("sum(n) AS n"))


def changelog_windows(
    log: DataFrame,
    windows: DataFrame,
    commits: Commits | None = None,
    at_most: int | None = None,
    rare: str | None = None,
) -> DataFrame:
    """RAW and NET change rows of every window, marked by `window` and `mode`."""
    return raw_windows(log, windows).unionByName(net_windows(log, windows, commits, at_most, rare))


def raw_window_counts(log: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, mode, type, n) without touching a row twice: count per commit, then add up."""
    per_commit = log.groupBy(CHANGE_ORDINAL, CHANGE_TYPE).agg(F.expr("count(*) AS n"))
    listed = _listed(windows)
    if listed:
        hit = (
            per_commit.selectExpr("*", f"explode({_literal(listed)}) AS _window")
            .where(f"{CHANGE_ORDINAL} BETWEEN _window.first AND _window.last")
            .selectExpr("*", "_window.title AS window")
        )
    else:
        return raw_window_counts_of(per_commit, windows)
    return hit.groupBy("window", F.expr("'RAW' AS mode"), CHANGE_TYPE).agg(F.expr("sum(n) AS n"))


def raw_window_counts_of(per_commit: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, mode, type, n) from counts per commit (`_change_ordinal`, `_change_type`, `n`)."""
    hit = _prefix_counts(per_commit, windows)
    return hit.groupBy("window", F.expr("'RAW' AS mode"), CHANGE_TYPE).agg(F.expr("sum(n) AS n"))


def _prefix_counts(per_commit: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, type, n) as differences of running sums over the commits: two equi-joins of the window list."""
    last = _last_end(windows)
    types = f"explode(array({', '.join(repr(t) for t in CHANGE_TYPES)})) AS {CHANGE_TYPE}"
    grid = per_commit.sparkSession.range(0 if last is None else last + 1).selectExpr(f"CAST(id AS INT) AS {CHANGE_ORDINAL}", types, "0L AS n")
    whole = grid.unionByName(per_commit).groupBy(CHANGE_TYPE, CHANGE_ORDINAL).agg(F.expr("sum(n) AS n"))
    running = whole.selectExpr(CHANGE_TYPE, CHANGE_ORDINAL, f"sum(n) OVER (PARTITION BY {CHANGE_TYPE} ORDER BY {CHANGE_ORDINAL}) AS n")
    asked = windows.selectExpr("title AS window", "coalesce(start_ordinal, -1) AS _before", "end_ordinal AS _end")
    upto = asked.join(running.selectExpr(f"{CHANGE_ORDINAL} AS _end", CHANGE_TYPE, "n AS _upto"), "_end")
    both = upto.join(running.selectExpr(f"{CHANGE_ORDINAL} AS _before", CHANGE_TYPE, "n AS _less"), ["_before", CHANGE_TYPE], "left")
    return both.selectExpr("window", CHANGE_TYPE, "_upto - coalesce(_less, 0) AS n").where("n > 0")


def net_window_counts(
    log: DataFrame, windows: DataFrame, commits: Commits | None = None, rare: str | None = None
) -> DataFrame:
    """(window, mode, type, n) of the NET changes from one shuffle of the log.

    Rows changed by the same commits in the same way are counted together
    before any window is looked at, so the windows cost next to nothing; many windows, or windows of many commits, come
    from a summed-area table. With a
    `rare` change type, rows it never met are counted like RAW changes.
    """
    if rare is not None:
        untouched, touched = split_untouched(log, rare)
        unchanged = raw_window_counts(untouched, windows).withColumn("mode", F.lit("NET"))
        parts = unchanged.unionByName(net_window_counts(touched, windows, commits))
        return parts.groupBy("window", "mode", CHANGE_TYPE).agg(F.expr("sum(n) AS n"))
    listed = _listed(windows)
    if not (listed and inlined(commits)):
        return swept_counts(_signatures(log), windows)
    names = sum_names(commits)
    alike = commit_sums(log, commits).groupBy(*names).agg(F.expr("count(*) AS _rows"))
    inside = [f"IF({o} BETWEEN _window.first AND _window.last, {n}, 0)" for n, (o, _) in zip(names, commits)]
    balances = alike.selectExpr("*", f"explode({_literal(listed)}) AS _window").selectExpr(
        "_window.title AS window", f"({' + '.join(inside)}) * _rows AS _balance"
    )
    change_type = F.expr(f"{change_type_of('_balance')} AS {CHANGE_TYPE}")
    return (
        balances.where("_balance != 0")
        .groupBy("window", F.expr("'NET' AS mode"), change_type)
        .agg(F.expr("sum(abs(_balance)) AS n"))
    )


def change_counts(changes: DataFrame, *labels: Column) -> DataFrame:
    """Number of change rows by label columns and type."""
    return changes.groupBy(*labels, CHANGE_TYPE).agg(F.expr("count(*) AS n"))


def change_matrix(counts: DataFrame) -> DataFrame:
    """Windows as lines, change types as columns, in the string order of the titles."""
    return (
        counts.groupBy("window", "mode")
        .pivot(CHANGE_TYPE, CHANGE_TYPES)
        .agg(F.sum("n"))
        .na.fill(0, CHANGE_TYPES)
        .orderBy("window", "mode")
    )


def window_matrix(
    log: DataFrame, windows: DataFrame, commits: Commits | None = None, rare: str | None = None
) -> DataFrame:
    """The change matrix of many windows from two passes over the log, RAW and NET."""
    listed = _listed(windows)
    if listed is not None:
        windows = fixed_windows(log.sparkSession, listed)
    net = net_window_counts(log, windows, commits, rare)
    return change_matrix(raw_window_counts(log, windows).unionByName(net))


def fixed_windows(spark: SparkSession, listed: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Windows given as (title, first, last) commit ordinals, without a file behind them."""
    if not listed:
        return spark.range(0).selectExpr("'' AS title", "1 AS start_ordinal", "1 AS end_ordinal")
    return spark.range(1).selectExpr(f"inline({_literal(list(listed))})").selectExpr(
        "title", "IF(first > 0, first - 1, NULL) AS start_ordinal", "last AS end_ordinal"
    )
