"""The registered queries: each operator over whole driver tables, or over histories built from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowtide.functions.transforms import bucket_distribution, register_functions, with_bucket, with_months
from rowtide.model import CHANGE_TYPE, SNAPSHOT_ID
from rowtide.operators import windows as w
from rowtide.operators.changelog import key_violations, net_changes_by_key
from rowtide.operators.dml import delete_rows, insert_rows, merge_rows, overwrite_rows, update_rows
from rowtide.operators.rows import diff_states
from rowtide.plans import reports
from rowtide.plans.samples import LINEITEM_COLUMNS, lineitem_history, long_history, merge_source, orders_history, table
from rowtide.sources.history import create_changelog_view
from rowtide.sources.signatures import kept_matrix, store_signatures

BUCKETS = 512

# Row-level writes ---------------------------------------------------------


def insert_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        (-F.col("o_orderkey") - 1).alias("o_orderkey"),
        F.col("o_custkey").cast("int").alias("o_custkey"),
        "o_orderstatus",
        F.round("o_totalprice").cast("long").alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )
    return insert_rows(orders, rows)


def delete_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delete_rows(table(spark, sf_dir, "orders"), "o_orderstatus = 'F' AND o_totalprice > 100000")


def update_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return update_rows(
        table(spark, sf_dir, "orders"),
        {"o_totalprice": "greatest(o_totalprice, 100000)", "o_orderpriority": "'1-URGENT'"},
        "o_orderstatus <> 'P'",
    )


def update_swap_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two flags take each other's: only what the flags differ by in number is a change."""
    swap = "CASE l_returnflag WHEN 'A' THEN 'R' WHEN 'R' THEN 'A' ELSE l_returnflag END"
    return update_rows(table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS), {"l_returnflag": swap})


def merge_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return merge_rows(orders.where("o_orderpriority <> '4-NOT SPECIFIED'"), merge_source(orders), ["o_orderkey"])


def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    key = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey"))
    target = customer.withColumn("c_custkey", key)
    source = target.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return merge_rows(target, source, ["c_custkey"])


def _overwriting(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    kept = orders.where("o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'")
    raised = orders.where("o_orderstatus = 'F' AND o_orderpriority = '5-LOW'")
    return orders, kept.unionByName(raised.withColumn("o_totalprice", F.expr("o_totalprice + 1")))


def overwrite_static_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overwrite_rows(*_overwriting(spark, sf_dir))


def overwrite_dynamic_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overwrite_rows(*_overwriting(spark, sf_dir), mode="dynamic", partition_by=["o_orderstatus"])


# Versions -----------------------------------------------------------------


def current_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_history(spark, sf_dir).current().orderBy("o_orderstatus", "o_orderkey")


def state_at_s3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_history(spark, sf_dir).state_at(4)


def state_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_history(spark, sf_dir).current()


def diff_states_s1_s6(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = orders_history(spark, sf_dir)
    return diff_states(h.state_at(2), h.state_at(7))


# Change logs --------------------------------------------------------------


def raw_end_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_history(spark, sf_dir).changelog(end=4)


def raw_start_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_history(spark, sf_dir).changelog(start=2, end=5)


def raw_partition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_history(spark, sf_dir).changelog().where("o_orderstatus = 'O'")


def net_end_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_history(spark, sf_dir).changelog(end=6, net=True)


def net_start_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_history(spark, sf_dir).changelog(start=2, end=7, net=True)


def net_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_history(spark, sf_dir).changelog(net=True)


def net_with_duplicates_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_history(spark, sf_dir).changelog(start=1, net=True)


def net_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_history(spark, sf_dir).changelog(start=2, end=7, net=True, keys=["o_orderkey"])


def update_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_history(spark, sf_dir).changelog(updates=True)


def net_by_key_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that hold many rows at once, and null keys, lose nothing."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "nullif(l_orderkey % 50, 0) AS k", "l_linenumber AS line", "l_returnflag AS flag", "l_orderkey % 3 AS part"
    )
    change = "IF(flag = 'N', 'INSERT', IF(part = 0, 'INSERT', 'DELETE'))"
    single = table(spark, sf_dir, "orders").selectExpr("o_orderkey + 1000000 AS k", "0 AS line", "o_orderstatus AS flag", "explode(array(0, 1, 2)) AS part")
    log = rows.unionByName(single).selectExpr(
        "k", "line", "IF(k > 999999 AND part = 2, 'x', flag) AS flag", f"IF(k > 999999, IF(part = 1, 'DELETE', 'INSERT'), {change}) AS _change_type",
        "CAST(part AS INT) AS _change_ordinal", "CAST(part + 1 AS BIGINT) AS _commit_snapshot_id",
    )
    return net_changes_by_key(log, ["k"])


def long_history_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_history(spark, sf_dir).changelog(start=3, end=22, net=True)


def long_history_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = long_history(spark, sf_dir)
    return h.matrix(_all_windows(h))


def long_history_matrix_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix from signatures that were stored before the last commit and brought up to date after it."""
    h = long_history(spark, sf_dir)
    store_signatures(h, through=h.latest() - 1)
    store_signatures(h)
    return kept_matrix(h, _all_windows(h))


def long_history_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = long_history(spark, sf_dir)
    changes = h.window_changes(_all_windows(h))
    return changes.groupBy("window", "mode", SNAPSHOT_ID, "_change_ordinal", CHANGE_TYPE).agg(
        F.count("*").alias("n"), F.sum("c_custkey").alias("keys")
    )


def long_history_entry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.entry_counts(long_history(spark, sf_dir))


def changelog_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = orders_history(spark, sf_dir)
    create_changelog_view(h, "order_changes", start=1, end=7)
    return spark.sql(
        """SELECT o_orderstatus, _commit_snapshot_id, _change_ordinal, _change_type, count(*) AS n
           FROM order_changes GROUP BY ALL"""
    )


# Many windows -------------------------------------------------------------


def _all_windows(h):
    return w.all_windows(reports.snapshot_labels(h))


def _case_windows(h):
    return w.case_windows(h.spark, {f"S{c.ordinal}": c.ordinal for c in h.commits})


def all_windows_raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = orders_history(spark, sf_dir)
    return w.raw_window_counts(h.log(), _all_windows(h))


def all_windows_net_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = orders_history(spark, sf_dir)
    return w.net_window_counts(h.log(), _all_windows(h), h.commit_pairs())


def change_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = orders_history(spark, sf_dir)
    return h.matrix(_all_windows(h))


def change_matrix_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = orders_history(spark, sf_dir)
    return w.change_matrix(w.raw_window_counts(h.changelog(updates=True), _all_windows(h)))


def case_window_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = orders_history(spark, sf_dir)
    return h.matrix(_case_windows(h))


def case_window_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = orders_history(spark, sf_dir)
    changes = h.window_changes(_case_windows(h))
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return changes.groupBy("window", "mode", SNAPSHOT_ID, "_change_ordinal", CHANGE_TYPE).agg(
        F.count("*").alias("n"), F.sum(cents).alias("cents")
    )


# Reports ------------------------------------------------------------------


def net_counts_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = orders_history(spark, sf_dir).changelog(start=2, end=7, net=True)
    return reports.counts_by_key(net, ["o_orderkey", "o_orderstatus"])


def counts_by_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts_by_commit(orders_history(spark, sf_dir).log())


def snapshots_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = reports.snapshot_listing(orders_history(spark, sf_dir))
    return listing.withColumn("committed_at", F.col("committed_at").cast("timestamp_ntz"))


def snapshot_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = orders_history(spark, sf_dir)
    counted = reports.counts_by_commit(h.log()).withColumnRenamed(SNAPSHOT_ID, "snapshot_id")
    return reports.snapshot_labels(h).join(counted, "snapshot_id").select("label", "ordinal", CHANGE_TYPE, "n")


def snapshot_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.snapshot_summary(orders_history(spark, sf_dir))


def first_last_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = orders_history(spark, sf_dir)
    ends = reports.first_and_latest(h)
    picked = ends.select(F.explode(F.array("first_snapshot_id", "latest_snapshot_id")).alias(SNAPSHOT_ID))
    return reports.counts_by_commit(h.log()).join(picked, SNAPSHOT_ID)


def partition_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.partition_entries(orders_history(spark, sf_dir))


def entry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.entry_counts(orders_history(spark, sf_dir))


def history_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = orders_history(spark, sf_dir)
    reports.assert_commit_count(h, 7)
    return h.log().agg(F.countDistinct(SNAPSHOT_ID).alias("n_commits"), F.count("*").alias("n_changes"))


def key_violations_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# Partition functions ------------------------------------------------------


def bucket_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_bucket(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", BUCKETS, "bucket")


def bucket_distribution_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucket_distribution(table(spark, sf_dir, "lineitem"), "l_partkey", BUCKETS)


def bucket_customer_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_bucket(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name", BUCKETS, "bucket")


def bucket_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucketed = with_bucket(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", BUCKETS, "bucket")
    return bucketed.select("doc_id", "bucket")


def months_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_months(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "month")


def months_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants near the ends of months, taken in UTC whatever the session's time zone."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "timestamp_seconds(CAST(o_orderkey AS BIGINT) * 86399 - 40000000) AS at"
    )
    return with_months(orders, "at", "month").select("o_orderkey", "month")


def bucket_lineitem_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "concat(l_returnflag, '-', CAST(l_partkey AS STRING)) AS tag"
    )
    return with_bucket(lines, "tag", BUCKETS, "bucket").groupBy("bucket").agg(F.count("*").alias("n"))


def partition_functions_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    table(spark, sf_dir, "events").createOrReplaceTempView("event_rows")
    return spark.sql(
        f"""SELECT bucket_string({BUCKETS}, event_type) AS type_bucket, bucket_long(16, user_id) AS user_bucket,
                   months(ts) AS month, count(*) AS n
            FROM event_rows GROUP BY ALL"""
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        insert_changes,
        delete_changes,
        update_changes,
        update_swap_changes,
        merge_changes,
        merge_null_keys,
        overwrite_static_changes,
        overwrite_dynamic_changes,
        current_rows,
        state_at_s3,
        state_with_duplicates,
        diff_states_s1_s6,
        raw_end_only,
        raw_start_end,
        raw_partition_filter,
        net_end_only,
        net_start_end,
        net_with_duplicates,
        net_with_duplicates_start,
        net_by_key,
        update_pairs,
        changelog_view_counts,
        all_windows_raw_counts,
        all_windows_net_counts,
        change_matrix,
        change_matrix_labelled,
        case_window_matrix,
        case_window_changes,
        net_counts_by_key,
        counts_by_commit,
        snapshots_listing,
        snapshot_labels,
        snapshot_summary,
        first_last_snapshot,
        partition_entries,
        net_by_key_with_duplicates,
        long_history_net,
        long_history_matrix,
        long_history_matrix_kept,
        long_history_changes,
        long_history_entry_counts,
        months_instants,
        bucket_lineitem_text,
        entry_counts,
        history_complete,
        key_violations_lineitem,
        bucket_orders,
        bucket_distribution_lineitem,
        bucket_customer_name,
        bucket_documents,
        months_orders,
        partition_functions_sql,
    ]
}
