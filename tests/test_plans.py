"""What the plans must and must not contain, whatever the size of the data."""

import re

import pytest
from pyspark.sql import functions as F

from tidemill.operators import changes as ch, joins, stats, visits
from tidemill.plans import tables as t
from tidemill.plans.queries import QUERIES
from tidemill.sinks.tables import merge_changes

FOLDER = "/root/testdata/sf0.001"
BATCH = [n for n in QUERIES if not n.startswith(("stream_", "wm_", "win_", "sink_", "src_topic"))
         and n not in ("late_data", "checkpoint_recovery", "side_output", "job_base_log",
                       "job_unique_visit", "job_user_jump", "job_visitor_stats")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pair_joins_no_python_no_single_task(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas",
                   "SinglePartition", "collect_set", "collect_list"):
        assert banned not in text, banned


def test_firsts_are_limited_before_the_shuffle(spark):
    pages = t.page_logs(t.table(spark, FOLDER, "events"))
    changes = t.changes(t.table(spark, FOLDER, "events"))
    for df in (visits.unique_visit(pages, ["event_id"]), visits.repair_is_new(pages, ["event_id"]),
               ch.current_state(changes, "user_id", ["ts_ms", "event_id"]),
               ch.latest_rules(changes.select(F.col("op").alias("sourceTable"),
                                              F.col("op").alias("operateType"), "ts_ms"), ["ts_ms"])):
        text = plan(df)
        assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", text)


def test_jumps_are_sorted_per_bucket_not_per_device(spark):
    text = plan(visits.user_jump(t.page_logs(t.table(spark, FOLDER, "events")), ["event_id"]))
    keys = re.search(r"Exchange hashpartitioning\(([^)]*)\)", text).group(1)
    assert keys.count("#") == 2


def test_repair_joins_on_the_row_and_leaves_old_rows_alone(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(visits.repair_is_new(t.logs(t.table(spark, FOLDER, "events")), ["event_id"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One exchange for the firsts and one for each side of the join, on device, time and place.
    assert text.count("Exchange hashpartitioning") == 3
    assert "SortMergeJoin" in text and "event_id" in re.search(r"SortMergeJoin.*", text).group(0)


def test_interval_join_compares_within_key_and_bucket(spark):
    text = plan(QUERIES["ijoin_order_detail"](spark, FOLDER))
    assert re.search(r"Join \[ok#\d+L, _bucket#\d+L\], \[dk#\d+L, _right_bucket#\d+L\]", text)


def test_statistics_combine_before_the_shuffle(spark):
    rows = QUERIES["union_product"](spark, FOLDER)
    text = plan(stats.product_stats(rows, "30 days"))
    first = re.findall(r"Exchange hashpartitioning\([^\n]*", text)[-1]
    assert "order_ref" in first
    assert "partial_sum" in text and "Expand" not in text


def test_merge_of_changes_combines_before_the_shuffle(spark):
    rows = t.changes(t.table(spark, FOLDER, "events")).withColumn("pk", F.col("after")["user_id"])
    assert "partial_max_by" in plan(merge_changes(rows, ["k"], ["ts_ms"]))


def test_scans_read_only_needed_columns_and_push_filters(spark):
    pages = t.page_logs(t.table(spark, FOLDER, "events"))
    text = plan(visits.unique_visit(pages, ["event_id"]).select("event_id", "ts"))
    assert "EqualTo(event_type,signup)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(
        t.order_info(t.table(spark, FOLDER, "orders")).select("id", "total_amount"))).group(1)
    assert schema == "o_orderkey:bigint,o_totalprice:double"


def test_salted_lookup_joins_on_key_and_salt(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = spark.range(100).withColumnRenamed("id", "k")
        text = plan(joins.dim_join(rows, spark.range(50), "k", {"v": "id"}, max_broadcast_bytes=9))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"SortMergeJoin \[[^\]]*_salt", text)
