"""Time the registered queries: one JSON line, seconds per query after one warm-up run each.

`baseline` is the change matrix computed naively, with one changelog plan per
window and mode, over the same stored rows in the same session.
"""

from __future__ import annotations

import functools
import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rowtide.model import CHANGE_TYPE, SIGN, row_columns
from rowtide.operators.windows import change_matrix
from rowtide.plans.queries import QUERIES
from rowtide.plans.samples import build_orders_history, lineitem_history, long_history, orders_history, work_dir
from rowtide.sources.history import History


BASELINE_NAIVE_SECONDS = 11.4


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rowtide-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def matrix_plan_per_window(history: History) -> DataFrame:
    """28 windows times RAW and NET, each its own changelog, folded into one pivot."""
    ids = [c.snapshot_id for c in history.commits]
    bounds = [(f"(beginning, S{j}]", None, e) for j, e in enumerate(ids)]
    bounds += [(f"(S{i}, S{j}]", ids[i], ids[j]) for i in range(len(ids)) for j in range(i + 1, len(ids))]
    counts = []
    for title, start, end in bounds:
        log = history.log(start, end)
        rows = row_columns(log)
        latest = Window.partitionBy(*rows, CHANGE_TYPE).orderBy(F.desc("_change_ordinal"))
        net = (
            log.withColumn("_balance", F.sum(F.expr(SIGN)).over(Window.partitionBy(*rows)))
            .withColumn("_rank", F.row_number().over(latest))
            .where(f"{SIGN} * _balance > 0 AND _rank <= abs(_balance)")
        )
        for mode, changes in (("RAW", log), ("NET", net)):
            counts.append(
                changes.groupBy(F.lit(title).alias("window"), F.lit(mode).alias("mode"), CHANGE_TYPE).agg(
                    F.count("*").alias("n")
                )
            )
    folded = functools.reduce(DataFrame.unionByName, counts)
    return change_matrix(folded)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    only = sys.argv[1:]
    spark = session()
    history = orders_history(spark, sf_dir)
    lineitem_history(spark, sf_dir)
    long_history(spark, sf_dir)
    seconds: dict[str, float] = {}
    if not only:
        seconds["build_orders_history"] = timed(lambda: build_orders_history(spark, sf_dir, work_dir(spark)))
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        run(query(spark, sf_dir))
        seconds[name] = timed(lambda: run(query(spark, sf_dir)))
    baseline = {}
    if not only or "baseline" in only:
        run(matrix_plan_per_window(history))
        baseline["change_matrix_plan_per_window"] = timed(lambda: run(matrix_plan_per_window(history)))
    naive = baseline.get("change_matrix_plan_per_window")
    result = {
        "metric": "total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(sf_dir.rsplit("sf", 1)[-1]) if "sf" in sf_dir else sf_dir,
        "baseline": baseline,
        "machine_factor": round(naive / BASELINE_NAIVE_SECONDS, 2) if naive and sf_dir.endswith("sf0.1") else None,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
