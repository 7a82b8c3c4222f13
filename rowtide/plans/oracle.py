"""The registered queries once more as plain SQL over the driver's tables.

The two histories are spelled out as lists of change rows; each query adds its
own tail. Nothing here uses the library.
"""

from __future__ import annotations

ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
HIGH = "o_orderpriority = '2-HIGH'"
ONCE = ORDER.replace("o_orderstatus", "'P' AS o_orderstatus").replace("o_totalprice", "o_totalprice + 1 AS o_totalprice")
TWICE = ONCE.replace("o_totalprice + 1 AS", "o_totalprice + 1 + 1 AS")
LATER = ORDER.replace("o_orderdate", "o_orderdate + INTERVAL 9 DAY AS o_orderdate")
RAISED = ORDER.replace("o_totalprice", "o_totalprice + 2 AS o_totalprice")

ORDER_LOG = f"""
WITH log AS (
  SELECT 1 AS k, 'INSERT' AS t, {ORDER} FROM orders
    WHERE coalesce(o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'), TRUE)
  UNION ALL SELECT 2, 'INSERT', {ORDER} FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  UNION ALL SELECT 3, 'DELETE', {ORDER} FROM orders WHERE {HIGH}
  UNION ALL SELECT 3, 'INSERT', {ONCE} FROM orders WHERE {HIGH}
  UNION ALL SELECT 4, 'DELETE', {ONCE} FROM orders WHERE {HIGH}
  UNION ALL SELECT 4, 'INSERT', {TWICE} FROM orders WHERE {HIGH}
  UNION ALL SELECT 5, 'DELETE', {TWICE} FROM orders WHERE {HIGH}
  UNION ALL SELECT 6, 'INSERT', {LATER} FROM orders WHERE {HIGH}
  UNION ALL SELECT 7, 'DELETE', {ORDER} FROM orders WHERE o_orderpriority = '3-MEDIUM'
  UNION ALL SELECT 7, 'INSERT', {RAISED} FROM orders WHERE o_orderpriority = '3-MEDIUM'
  UNION ALL SELECT 7, 'INSERT', {ORDER} FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
)"""

LINE = "l_suppkey, l_returnflag, l_linestatus"

LINE_LOG = f"""
WITH first AS (SELECT {LINE} FROM lineitem),
second AS (SELECT {LINE} FROM lineitem WHERE l_quantity > 25),
third AS (
  SELECT {LINE} FROM lineitem WHERE l_linestatus = 'O'
  UNION ALL SELECT {LINE} FROM lineitem WHERE l_discount > 0.07
  UNION ALL SELECT {LINE} FROM lineitem WHERE l_returnflag = 'A'
),
before AS (SELECT * FROM first UNION ALL SELECT * FROM second),
log AS (
  SELECT 1 AS k, 'INSERT' AS t, * FROM first
  UNION ALL SELECT 2, 'INSERT', * FROM second
  UNION ALL SELECT 3, 'DELETE', * FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM third)
  UNION ALL SELECT 3, 'INSERT', * FROM (SELECT * FROM third EXCEPT ALL SELECT * FROM before)
)"""

LONG = "c_custkey, c_nationkey, c_mktsegment"

# Commit k inserts class k - 1 of the customers twice and deletes one copy of class k - 8.
LONG_LOG = f"""
WITH classed AS (SELECT {LONG}, coalesce(((c_custkey % 24) + 24) % 24, 0) AS class FROM customer),
log AS (
  SELECT class + 1 AS k, 'INSERT' AS t, {LONG} FROM classed, (SELECT unnest([1, 2])) copies
  UNION ALL SELECT class + 8, 'DELETE', {LONG} FROM classed WHERE class + 8 <= 24
)"""

LONG_WINDOWS = """,
windows AS (
  SELECT '(' || CASE WHEN s = 0 THEN 'beginning' ELSE 'S' || (s - 1) END || ', S' || (e.k - 1) || ']' AS "window", s, e.k AS e
  FROM (SELECT unnest(range(1, 25)) AS k) e, LATERAL (SELECT unnest(range(0, e.k)) AS s)
),
counted AS (SELECT k, t, c_custkey, c_nationkey, c_mktsegment, count(*) AS n FROM log GROUP BY ALL),
inside AS (SELECT "window", t, c_custkey, c_nationkey, c_mktsegment, n FROM counted JOIN windows ON k > s AND k <= e),
balances AS (
  SELECT "window", sum(CASE WHEN t = 'INSERT' THEN n ELSE -n END) AS b FROM inside
  GROUP BY "window", c_custkey, c_nationkey, c_mktsegment
),
sums AS (
  SELECT "window", 'RAW' AS mode, coalesce(sum(n) FILTER (t = 'INSERT'), 0) AS i, coalesce(sum(n) FILTER (t = 'DELETE'), 0) AS d
  FROM inside GROUP BY "window"
  UNION ALL
  SELECT "window", 'NET', coalesce(sum(b) FILTER (b > 0), 0), coalesce(-sum(b) FILTER (b < 0), 0) FROM balances WHERE b <> 0 GROUP BY "window"
)"""

LONG_MATRIX = (
    LONG_LOG
    + LONG_WINDOWS
    + """
        SELECT "window", mode, CAST(i AS BIGINT) AS "INSERT", CAST(d AS BIGINT) AS "DELETE",
               CAST(0 AS BIGINT) AS "UPDATE_BEFORE", CAST(0 AS BIGINT) AS "UPDATE_AFTER" FROM sums"""
)

# Many rows for each key of `lineitem`, so these go by whole rows; a key of `orders` is inserted, deleted, inserted.
KEYED_LOG = """
WITH given AS (
  SELECT nullif(l_orderkey % 50, 0) AS key, l_linenumber AS line, l_returnflag AS flag, l_orderkey % 3 AS part FROM lineitem
),
log AS (
  SELECT CAST(part + 1 AS BIGINT) AS k,
         CASE WHEN flag = 'N' OR part = 0 THEN 'INSERT' ELSE 'DELETE' END AS t, key, line, flag
  FROM given
)"""

SIGN = "CASE WHEN t = 'INSERT' THEN 1 ELSE -1 END"


def _raw(start: int, end: int, where: str = "TRUE") -> str:
    return f"""{ORDER_LOG}
SELECT {ORDER}, t AS _change_type, CAST(k - {start} - 1 AS INTEGER) AS _change_ordinal, CAST(k AS BIGINT) AS _commit_snapshot_id
FROM log WHERE k > {start} AND k <= {end} AND {where}"""


def _net_tail(columns: str, start: int, end: int, select: str) -> str:
    return f""",
balanced AS (
  SELECT *, SUM({SIGN}) OVER (PARTITION BY {columns}) AS balance,
         ROW_NUMBER() OVER (PARTITION BY {columns}, t ORDER BY k DESC) AS rn
  FROM log WHERE k > {start} AND k <= {end}
),
net AS (
  SELECT {columns}, t AS _change_type, CAST(k - {start} - 1 AS INTEGER) AS _change_ordinal,
         CAST(k AS BIGINT) AS _commit_snapshot_id
  FROM balanced WHERE ((balance > 0 AND t = 'INSERT') OR (balance < 0 AND t = 'DELETE')) AND rn <= abs(balance)
)
{select}"""


def _net(start: int, end: int, select: str = "SELECT * FROM net") -> str:
    return ORDER_LOG + _net_tail(ORDER, start, end, select)


def _line_net(start: int, end: int) -> str:
    return LINE_LOG + _net_tail(LINE, start, end, "SELECT * FROM net")


def _state(log: str, columns: str, end: int) -> str:
    return f"""{log},
live AS (SELECT {columns}, SUM({SIGN}) AS n FROM log WHERE k <= {end} GROUP BY {columns})
SELECT {columns} FROM live, LATERAL (SELECT unnest(range(CAST(n AS BIGINT))) AS copy) WHERE n > 0"""


ALL_WINDOWS = """,
labels AS (SELECT unnest(range(1, 8)) AS k),
windows AS (
  SELECT '(' || CASE WHEN s = 0 THEN 'beginning' ELSE 'S' || (s - 1) END || ', S' || (e.k - 1) || ']' AS "window", s, e.k AS e
  FROM labels e, LATERAL (SELECT unnest(range(0, e.k)) AS s)
)"""

# (name, start, end) as snapshot ids; 0 is the beginning.
CASE_LIST = [
    ("W1 S1..S1", 0, 2),
    ("W1.1 0..S1", 0, 2),
    ("W2 S1..S2", 2, 3),
    ("W2.1 0..S2", 0, 3),
    ("W3 S1..S3", 2, 4),
    ("W3.1 0..S3", 0, 4),
    ("W4 S1..S4", 2, 5),
    ("W4.1 0..S4", 0, 5),
    ("W4 S1..S5", 2, 6),
    ("W4.1 0..S5", 0, 6),
    ("W4 S1..S6", 2, 7),
    ("W4.1 0..S6", 0, 7),
    ("W5 S2..S3", 3, 4),
    ("W5.1 S2..S4", 3, 5),
    ("W6 S3..S4", 4, 5),
    ("W7 S4..S5", 5, 6),
    ("W8 S5..S6", 6, 7),
    ("W9 S1..S6", 2, 7),
]
CASE_WINDOWS = (
    ', windows AS (SELECT * FROM (VALUES '
    + ", ".join(f"('{n}', {s}, {e})" for n, s, e in CASE_LIST)
    + ') v("window", s, e))'
)

WINDOWED = f""",
raw AS (SELECT "window", s, 'RAW' AS mode, log.* FROM log JOIN windows ON k > s AND k <= e),
balanced AS (
  SELECT *, SUM({SIGN}) OVER (PARTITION BY "window", {ORDER}) AS balance,
         ROW_NUMBER() OVER (PARTITION BY "window", {ORDER}, t ORDER BY k DESC) AS rn
  FROM raw
),
net AS (
  SELECT "window", s, 'NET' AS mode, k, t, {ORDER} FROM balanced
  WHERE ((balance > 0 AND t = 'INSERT') OR (balance < 0 AND t = 'DELETE')) AND rn <= abs(balance)
),
changes AS (SELECT "window", s, mode, k, t, {ORDER} FROM raw UNION ALL SELECT * FROM net)"""

MATRIX = """
SELECT "window", mode, count(*) FILTER (t = 'INSERT') AS "INSERT", count(*) FILTER (t = 'DELETE') AS "DELETE",
       count(*) FILTER (t = 'UPDATE_BEFORE') AS "UPDATE_BEFORE", count(*) FILTER (t = 'UPDATE_AFTER') AS "UPDATE_AFTER"
FROM changes GROUP BY "window", mode ORDER BY "window", mode"""

LABELLED = """,
counted AS (
  SELECT *, count(*) FILTER (t = 'DELETE') OVER (PARTITION BY k, o_orderkey) AS d,
         count(*) FILTER (t = 'INSERT') OVER (PARTITION BY k, o_orderkey) AS i
  FROM log
),
labelled AS (
  SELECT * EXCLUDE (t, d, i),
         CASE WHEN d = 1 AND i = 1 AND t = 'DELETE' THEN 'UPDATE_BEFORE'
              WHEN d = 1 AND i = 1 THEN 'UPDATE_AFTER' ELSE t END AS t
  FROM counted
)"""

PER_COMMIT = """,
commits AS (
  SELECT CAST(k AS BIGINT) AS snapshot_id, count(*) FILTER (t = 'INSERT') AS added, count(*) FILTER (t = 'DELETE') AS deleted,
         count(DISTINCT o_orderstatus) AS parts
  FROM log GROUP BY k
),
listed AS (
  SELECT *, LAG(snapshot_id) OVER (ORDER BY snapshot_id) AS parent_id,
         CASE WHEN deleted = 0 THEN 'append' WHEN added = 0 THEN 'delete' ELSE 'overwrite' END AS operation
  FROM commits
)"""

ENTRIES = """,
touched AS (
  SELECT k, o_orderstatus, count(*) FILTER (t = 'INSERT') AS added, count(*) FILTER (t = 'DELETE') AS deleted
  FROM log GROUP BY k, o_orderstatus
),
grid AS (
  SELECT s.k, p.o_orderstatus, t.k IS NOT NULL AS hit,
         SUM(coalesce(added, 0) - coalesce(deleted, 0)) OVER (PARTITION BY p.o_orderstatus ORDER BY s.k) AS after,
         coalesce(added, 0) - coalesce(deleted, 0) AS change
  FROM (SELECT DISTINCT k FROM log) s CROSS JOIN (SELECT DISTINCT o_orderstatus FROM log) p
  LEFT JOIN touched t ON t.k = s.k AND t.o_orderstatus = p.o_orderstatus
),
entries AS (
  SELECT CAST(k AS BIGINT) AS snapshot_id, o_orderstatus, 'ADDED' AS status FROM grid WHERE hit AND after > 0
  UNION ALL SELECT CAST(k AS BIGINT), o_orderstatus, 'DELETED' FROM grid WHERE hit AND after - change > 0
  UNION ALL SELECT CAST(k AS BIGINT), o_orderstatus, 'EXISTING' FROM grid WHERE NOT hit AND after > 0
)"""

# 32-bit Murmur3, seed 0, in HUGEINT arithmetic; each step is a column so that nothing is computed twice.
U32 = "4294967295"


def _mul(a: str, b: int) -> str:
    return f"((CAST({a} AS HUGEINT) * {b}) & {U32})"


def _rotl(a: str, r: int) -> str:
    return f"((({a} << {r}) & {U32}) | ({a} >> {32 - r}))"


def _murmur_string(table: str, key: str, text: str) -> str:
    """Common table expressions that end in `hashed(key, h)` for a string column."""
    byte = lambda i: f"(strpos('0123456789ABCDEF', substr(w, {i}, 1)) - 1)"
    little = " + ".join(
        f"CAST({byte(2 * i + 1)} * 16 + {byte(2 * i + 2)} AS HUGEINT) * {256**i}" for i in range(4)
    )
    return f"""
WITH bytes AS (SELECT {key} AS key, hex(encode({text})) AS x, CAST(octet_length(encode({text})) AS HUGEINT) AS len FROM {table}),
words AS (
  SELECT key, len, len // 4 AS n, list_transform(regexp_extract_all(x || repeat('00', CAST((4 - len % 4) % 4 AS INTEGER)), '.{{8}}'),
         lambda w: {little}) AS w0
  FROM bytes
),
mixed1 AS (SELECT key, len, n, list_transform(w0, lambda w: {_mul("w", 0xCC9E2D51)}) AS w1 FROM words),
mixed2 AS (SELECT key, len, n, list_transform(w1, lambda w: {_rotl("w", 15)}) AS w2 FROM mixed1),
mixed3 AS (SELECT key, len, n, list_transform(w2, lambda w: {_mul("w", 0x1B873593)}) AS w3 FROM mixed2),
folded AS (
  SELECT key, len, CASE WHEN len % 4 = 0 THEN CAST(0 AS HUGEINT) ELSE w3[-1] END AS tail,
         list_reduce(w3[1:CAST(n AS BIGINT)],
           lambda h, w: ((((xor(h, w) << 13) & {U32}) | (xor(h, w) >> 19)) * 5 + {0xE6546B64}) & {U32}, CAST(0 AS HUGEINT)) AS h0
  FROM mixed3
),
tailed AS (SELECT key, xor(xor(h0, tail), len) AS h1 FROM folded),
{_finish("tailed", "h1")}"""


def _finish(source: str, h: str) -> str:
    return f"""f1 AS (SELECT key, xor({h}, {h} >> 16) AS a FROM {source}),
f2 AS (SELECT key, {_mul("a", 0x85EBCA6B)} AS b FROM f1),
f3 AS (SELECT key, xor(b, b >> 13) AS c FROM f2),
f4 AS (SELECT key, {_mul("c", 0xC2B2AE35)} AS d FROM f3),
hashed AS (SELECT key, xor(d, d >> 16) AS h FROM f4)"""


def _murmur_long(source: str, value: str) -> str:
    """The same for a BIGINT column: two words, eight bytes, one record per distinct value."""
    m1, m2, off = 0xCC9E2D51, 0x1B873593, 0xE6546B64
    return f"""
WITH halves AS (
  SELECT DISTINCT {value} AS key,
         (CAST({value} AS HUGEINT) + CASE WHEN {value} < 0 THEN CAST(18446744073709551616 AS HUGEINT) ELSE 0 END) & {U32} AS lo,
         (CAST({value} AS HUGEINT) + CASE WHEN {value} < 0 THEN CAST(18446744073709551616 AS HUGEINT) ELSE 0 END) >> 32 AS hi
  FROM {source}
),
m1 AS (SELECT key, {_mul("lo", m1)} AS lo, {_mul("hi", m1)} AS hi FROM halves),
m2 AS (SELECT key, {_rotl("lo", 15)} AS lo, {_rotl("hi", 15)} AS hi FROM m1),
m3 AS (SELECT key, {_mul("lo", m2)} AS lo, {_mul("hi", m2)} AS hi FROM m2),
r1 AS (SELECT key, hi, {_rotl("lo", 13)} AS h FROM m3),
r2 AS (SELECT key, xor((h * 5 + {off}) & {U32}, hi) AS h FROM r1),
r3 AS (SELECT key, {_rotl("h", 13)} AS h FROM r2),
r4 AS (SELECT key, xor((h * 5 + {off}) & {U32}, CAST(8 AS HUGEINT)) AS h FROM r3),
{_finish("r4", "h")}"""


BUCKET = f"CAST((h & {0x7FFFFFFF}) % {{n}} AS INTEGER)"
B512 = BUCKET.format(n=512)
KEPT = "o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'"
LOWF = "o_orderstatus = 'F' AND o_orderpriority = '5-LOW'"
PLUS1 = ORDER.replace("o_totalprice", "o_totalprice + 1 AS o_totalprice")


def _overwrite(old: str) -> str:
    return f"""
WITH new AS (SELECT {ORDER} FROM orders WHERE {KEPT} UNION ALL SELECT {PLUS1} FROM orders WHERE {LOWF}),
old AS (SELECT {ORDER} FROM orders WHERE {old})
SELECT 'DELETE' AS _change_type, * FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new)
UNION ALL SELECT 'INSERT', * FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old)"""


CHANGED = "(o_totalprice < 100000 OR o_orderpriority <> '1-URGENT') AND o_orderstatus <> 'P'"
MERGE_COLUMNS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"

ORACLE: dict[str, str] = {
    "insert_changes": """SELECT 'INSERT' AS _change_type, -o_orderkey - 1 AS o_orderkey, o_custkey, o_orderstatus,
        round(o_totalprice) AS o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "delete_changes": f"""SELECT 'DELETE' AS _change_type, {ORDER} FROM orders
        WHERE o_orderstatus = 'F' AND o_totalprice > 100000""",
    "update_changes": f"""SELECT 'DELETE' AS _change_type, {ORDER} FROM orders WHERE {CHANGED}
        UNION ALL SELECT 'INSERT', o_orderkey, o_custkey, o_orderstatus, greatest(o_totalprice, 100000), o_orderdate, '1-URGENT'
        FROM orders WHERE {CHANGED}""",
    "update_swap_changes": f"""
        WITH old AS (SELECT {LINE} FROM lineitem),
        new AS (SELECT l_suppkey, CASE l_returnflag WHEN 'A' THEN 'R' WHEN 'R' THEN 'A' ELSE l_returnflag END AS l_returnflag, l_linestatus FROM lineitem)
        SELECT 'DELETE' AS _change_type, * FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new)
        UNION ALL SELECT 'INSERT', * FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old)""",
    "merge_changes": f"""SELECT 'DELETE' AS _change_type, {ORDER} FROM orders WHERE o_orderpriority = '3-MEDIUM'
        UNION ALL SELECT 'INSERT', {RAISED} FROM orders WHERE o_orderpriority = '3-MEDIUM'
        UNION ALL SELECT 'INSERT', {ORDER} FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'""",
    "merge_null_keys": f"""
        WITH t AS (SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS c_custkey, c_name, c_nationkey, c_acctbal,
                          c_mktsegment FROM customer),
        s AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM t)
        SELECT 'DELETE' AS _change_type, t.* FROM t JOIN s USING (c_custkey)
        UNION ALL SELECT 'INSERT', {MERGE_COLUMNS} FROM s""",
    "overwrite_static_changes": _overwrite("TRUE"),
    "overwrite_dynamic_changes": _overwrite("o_orderstatus IN (SELECT o_orderstatus FROM new)"),
    "current_rows": _state(ORDER_LOG, ORDER, 7),
    "state_at_s3": _state(ORDER_LOG, ORDER, 4),
    "state_with_duplicates": f"{LINE_LOG} SELECT * FROM third",
    "diff_states_s1_s6": f"""{ORDER_LOG},
        a AS (SELECT {ORDER} FROM log WHERE t = 'INSERT' AND k <= 2 EXCEPT ALL SELECT {ORDER} FROM log WHERE t = 'DELETE' AND k <= 2),
        b AS (SELECT {ORDER} FROM log WHERE t = 'INSERT' EXCEPT ALL SELECT {ORDER} FROM log WHERE t = 'DELETE')
        SELECT 'DELETE' AS _change_type, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
        UNION ALL SELECT 'INSERT', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
    "raw_end_only": _raw(0, 4),
    "raw_start_end": _raw(2, 5),
    "raw_partition_filter": _raw(0, 7, "o_orderstatus = 'O'"),
    "net_end_only": _net(0, 6),
    "net_start_end": _net(2, 7),
    "net_with_duplicates": _line_net(0, 3),
    "net_with_duplicates_start": _line_net(1, 3),
    "net_by_key": f"""{ORDER_LOG},
        ranked AS (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY k, t, {ORDER}) AS up,
                 ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY k DESC, t DESC, {ORDER}) AS down
          FROM log WHERE k > 2
        ),
        images AS (
          SELECT {ORDER}, t, k FROM ranked WHERE (up = 1 AND t = 'DELETE') OR (down = 1 AND t = 'INSERT')
        ),
        counted AS (SELECT *, count(*) OVER (PARTITION BY {ORDER}) AS same FROM images)
        SELECT {ORDER}, t AS _change_type, CAST(k - 3 AS INTEGER) AS _change_ordinal, CAST(k AS BIGINT) AS _commit_snapshot_id
        FROM counted WHERE same = 1""",
    "update_pairs": f"""{ORDER_LOG}{LABELLED}
        SELECT {ORDER}, t AS _change_type, CAST(k - 1 AS INTEGER) AS _change_ordinal, CAST(k AS BIGINT) AS _commit_snapshot_id
        FROM labelled""",
    "changelog_view_counts": f"""{ORDER_LOG}
        SELECT o_orderstatus, CAST(k AS BIGINT) AS _commit_snapshot_id, CAST(k - 2 AS INTEGER) AS _change_ordinal,
               t AS _change_type, count(*) AS n
        FROM log WHERE k > 1 GROUP BY ALL""",
    "all_windows_raw_counts": f"""{ORDER_LOG}{ALL_WINDOWS}
        SELECT "window", 'RAW' AS mode, t AS _change_type, count(*) AS n
        FROM log JOIN windows ON k > s AND k <= e GROUP BY ALL""",
    "all_windows_net_counts": f"""{ORDER_LOG}{ALL_WINDOWS}{WINDOWED}
        SELECT "window", mode, t AS _change_type, count(*) AS n FROM net GROUP BY ALL""",
    "change_matrix": ORDER_LOG + ALL_WINDOWS + WINDOWED + MATRIX,
    "change_matrix_labelled": f"""{ORDER_LOG}{LABELLED}{ALL_WINDOWS},
        changes AS (SELECT "window", 'RAW' AS mode, t FROM labelled JOIN windows ON k > s AND k <= e){MATRIX}""",
    "case_window_matrix": ORDER_LOG + CASE_WINDOWS + WINDOWED + MATRIX,
    "case_window_changes": f"""{ORDER_LOG}{CASE_WINDOWS}{WINDOWED}
        SELECT "window", mode, CAST(k AS BIGINT) AS _commit_snapshot_id, CAST(k - s - 1 AS INTEGER) AS _change_ordinal,
               t AS _change_type, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM changes GROUP BY ALL""",
    "net_counts_by_key": _net(
        2, 7, "SELECT o_orderkey, o_orderstatus, _change_type, count(*) AS n FROM net GROUP BY ALL"
    ),
    "counts_by_commit": f"""{ORDER_LOG}
        SELECT CAST(k AS BIGINT) AS _commit_snapshot_id, t AS _change_type, count(*) AS n FROM log GROUP BY ALL""",
    "snapshots_listing": f"""{ORDER_LOG}{PER_COMMIT}
        SELECT snapshot_id, parent_id, operation,
               TIMESTAMP '2025-08-01 00:00:00' + (snapshot_id - 1) * INTERVAL 1 MINUTE AS committed_at
        FROM listed""",
    "snapshot_labels": f"""{ORDER_LOG}
        SELECT 'S' || (k - 1) AS label, CAST(k - 1 AS INTEGER) AS ordinal, t AS _change_type, count(*) AS n FROM log GROUP BY ALL""",
    "snapshot_summary": f"""{ORDER_LOG}{PER_COMMIT}
        SELECT snapshot_id, parent_id, operation, added AS added_records, deleted AS deleted_records,
               parts AS changed_partition_count, CAST(SUM(added - deleted) OVER (ORDER BY snapshot_id) AS BIGINT) AS total_records
        FROM listed""",
    "first_last_snapshot": f"""{ORDER_LOG}
        SELECT CAST(k AS BIGINT) AS _commit_snapshot_id, t AS _change_type, count(*) AS n FROM log
        WHERE k IN (SELECT min(k) FROM log UNION ALL SELECT max(k) FROM log) GROUP BY ALL""",
    "partition_entries": ORDER_LOG + ENTRIES + " SELECT * FROM entries",
    "net_by_key_with_duplicates": KEYED_LOG
    + _net_tail("key, line, flag", 0, 3, "SELECT key AS k, * EXCLUDE (key) FROM net")
    + """
        UNION ALL SELECT o_orderkey + 1000000, 0, 'x', 'INSERT', 2, 3 FROM orders""",
    "long_history_net": LONG_LOG + _net_tail(LONG, 3, 22, "SELECT * FROM net"),
    "long_history_matrix": LONG_MATRIX,
    "long_history_matrix_kept": LONG_MATRIX,
    "long_history_changes": LONG_LOG
    + LONG_WINDOWS[: LONG_WINDOWS.index("),\ncounted") + 1]
    + WINDOWED.replace(ORDER, LONG)
    + """
        SELECT "window", mode, CAST(k AS BIGINT) AS _commit_snapshot_id, CAST(k - s - 1 AS INTEGER) AS _change_ordinal,
               t AS _change_type, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM changes GROUP BY ALL""",
    "long_history_entry_counts": LONG_LOG
    + ENTRIES.replace("o_orderstatus", "c_nationkey")
    + " SELECT snapshot_id, status, count(*) AS cnt FROM entries GROUP BY ALL",
    "months_instants": """SELECT o_orderkey, CAST((year(t) - 1970) * 12 + month(t) - 1 AS INTEGER) AS month
        FROM (SELECT o_orderkey, TIMESTAMP '1970-01-01' + to_seconds(CAST(o_orderkey AS BIGINT) * 86399 - 40000000) AS t FROM orders)""",
    "bucket_lineitem_text": f"""{_murmur_string("(SELECT DISTINCT l_returnflag || '-' || l_partkey AS tag FROM lineitem)", 'tag', 'tag')}
        SELECT {B512} AS bucket, count(*) AS n FROM lineitem JOIN hashed ON l_returnflag || '-' || l_partkey = key GROUP BY ALL""",
    "entry_counts": ORDER_LOG + ENTRIES + " SELECT snapshot_id, status, count(*) AS cnt FROM entries GROUP BY ALL",
    "history_complete": f"{ORDER_LOG} SELECT count(DISTINCT k) AS n_commits, count(*) AS n_changes FROM log",
    "key_violations_lineitem": """SELECT l_orderkey, l_linenumber, count(*) AS n,
        l_orderkey IS NULL OR l_linenumber IS NULL AS null_key
        FROM lineitem GROUP BY ALL HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "bucket_orders": f"{_murmur_long('orders', 'o_orderkey')} SELECT key AS o_orderkey, {B512} AS bucket FROM hashed",
    "bucket_distribution_lineitem": f"""{_murmur_long('lineitem', 'l_partkey')}
        SELECT {B512} AS bucket, count(*) AS n FROM lineitem JOIN hashed ON l_partkey = key GROUP BY ALL""",
    "bucket_customer_name": f"""{_murmur_string('customer', 'c_custkey', 'c_name')}
        SELECT c_custkey, c_name, {B512} AS bucket FROM customer JOIN hashed ON c_custkey = key""",
    "bucket_documents": f"""{_murmur_string('documents', 'doc_id', 'text')}
        SELECT key AS doc_id, {B512} AS bucket FROM hashed""",
    "months_orders": """SELECT o_orderkey, o_orderdate,
        CAST((year(o_orderdate) - 1970) * 12 + month(o_orderdate) - 1 AS INTEGER) AS month FROM orders""",
    "partition_functions_sql": f"""{_murmur_string('(SELECT DISTINCT event_type FROM events)', 'event_type', 'event_type')},
        types AS (SELECT key, {B512} AS type_bucket FROM hashed),
        users AS ({_murmur_long('events', 'user_id')} SELECT key, {BUCKET.format(n=16)} AS user_bucket FROM hashed)
        SELECT type_bucket, user_bucket, CAST((year(ts) - 1970) * 12 + month(ts) - 1 AS INTEGER) AS month, count(*) AS n
        FROM events JOIN types ON event_type = types.key JOIN users ON user_id = users.key GROUP BY ALL""",
}
