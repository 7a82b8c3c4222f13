"""Row-history analytics on Spark: row-level writes, change logs, net changes, versions and reports."""

from rowtide.functions.transforms import bucket_distribution, register_functions, with_bucket, with_months
from rowtide.operators.changelog import (
    changelog,
    key_violations,
    label_updates,
    net_changes,
    net_changes_by_key,
)
from rowtide.operators.dml import delete_rows, insert_rows, merge_rows, overwrite_rows, update_rows
from rowtide.operators.rows import diff_states
from rowtide.operators.windows import all_windows, case_windows, change_matrix, changelog_windows, window_matrix
from rowtide.sources.history import History, create_changelog_view

__all__ = [
    "History",
    "all_windows",
    "bucket_distribution",
    "case_windows",
    "change_matrix",
    "changelog",
    "changelog_windows",
    "create_changelog_view",
    "delete_rows",
    "diff_states",
    "insert_rows",
    "key_violations",
    "label_updates",
    "merge_rows",
    "net_changes",
    "net_changes_by_key",
    "overwrite_rows",
    "register_functions",
    "update_rows",
    "window_matrix",
    "with_bucket",
    "with_months",
]
