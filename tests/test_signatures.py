"""A matrix kept up to date, against the one that is worked out from the log."""

from __future__ import annotations

import pytest

from rowtide import History, all_windows
from rowtide.plans import reports
from rowtide.sources.signatures import kept_matrix, signature_counts, store_signatures, touched_rows
from scripts import bag

SCHEMA = "k BIGINT, p STRING, v INT"


def windows(h):
    return all_windows(reports.snapshot_labels(h))


def test_kept_matrix_follows_the_commits(spark, tmp_path):
    many = spark.range(200).selectExpr("nullif(id % 30, 0) AS k", "CAST(id % 3 AS STRING) AS p", "CAST(id % 2 AS INT) AS v")
    h = History.create(spark, str(tmp_path / "h"), SCHEMA, ["k"], ["p"])
    assert store_signatures(h) is None
    h.insert(many)
    assert store_signatures(h) == 1 and store_signatures(h) == 1
    writes = [
        lambda: h.delete("k % 4 = 0"),
        lambda: h.update({"v": "v + 1"}, "k < 7"),
        lambda: h.insert(many.where("k % 4 = 0")),
        lambda: h.overwrite(many.where("p = '1' AND k < 20"), mode="dynamic"),
    ]
    for k, write in enumerate(writes):
        write()
        with pytest.raises(ValueError, match="goes through commit"):
            kept_matrix(h, windows(h))
        # What a further commit reads: its own changes, and the store.
        assert all(f"_commit_snapshot_id={h.latest()}" in f for f in touched_rows(h, h.latest() - 1, h.latest()).inputFiles())
        if k != 1:  # two commits at once, too
            assert store_signatures(h) == h.latest()
            assert bag(kept_matrix(h, windows(h))) == bag(h.matrix(windows(h)))
        else:
            h.delete("v = 0 AND k > 25")
            assert store_signatures(h) == h.latest()
            assert bag(kept_matrix(h, windows(h))) == bag(h.matrix(windows(h)))
    assert signature_counts(h).where("_rows < 0").isEmpty()
    plan = kept_matrix(h, windows(h))._jdf.queryExecution().executedPlan().toString()
    assert "/changes" not in plan and "row_events" not in plan
