"""What the optimizer makes of the jobs: pruned scans, one pass, no needless shuffles."""

import re

import pytest

from bidloom.plans import enrichment
from bidloom.registry import roles
from bidloom.registry.catalog import QUERIES
from bidloom.sources import files, sinks

SF_DIR = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df, table_prefix):
    """Column sets of the scans that read columns of a table."""
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    columns = [{c.split(":")[0] for c in s.split(",")} for s in schemas]
    return [c for c in columns if any(name.startswith(table_prefix) for name in c)]


def test_revenue_reads_only_what_it_needs(spark):
    df = QUERIES["daily_product_revenue"](spark, SF_DIR)
    assert read_columns(df, "l_") == [{"l_orderkey", "l_partkey", "l_extendedprice", "l_discount"}]
    assert read_columns(df, "o_") == [{"o_orderkey", "o_orderdate", "o_orderstatus"}]


def test_filters_reach_the_scan(spark):
    plan = physical(roles.matched_users(spark, SF_DIR))
    assert "EqualTo(o_orderstatus,F)" in plan


def test_enrichment_prunes_unused_columns(spark):
    df = enrichment.final_output(roles.job_inputs(spark, SF_DIR))
    bids = [c for c in read_columns(df, "l_") if "l_quantity" in c]
    assert bids == [{"l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"}]
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    for unused in ("bid_request_hash", "contextual_join_key", "campaign_grouping_key", "rounded_bid_time"):
        assert unused not in optimized


def test_enrichment_scans_the_bids_once(spark):
    """Both branches come from one aggregation: one scan of the orders for the bids, one for the matched users."""
    df = enrichment.final_output(roles.job_inputs(spark, SF_DIR))
    assert len(read_columns(df, "o_")) == 2
    assert "Union" in physical(df) and physical(df).count("Union") == 1  # the two feedback hours


def test_distinct_bids_reuse_the_partitioning_of_the_last_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(enrichment.final_output(roles.job_inputs(spark, SF_DIR)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    grouped = [line for line in plan.splitlines() if "Exchange hashpartitioning(advertiser_id" in line]
    assert len(grouped) == 1 and "bid_request_id" not in grouped[0]


def test_bids_are_shuffled_once_by_the_user_and_before_they_are_summed(spark):
    """Without any broadcast of its own choice: one shuffle for features and user attributes, one of bids by group."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(enrichment.final_output(roles.job_inputs(spark, SF_DIR))).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_user = [line for line in plan if "Exchange hashpartitioning" in line and "normalized_user_id" in line]
    assert len(by_user) == 1 and not [line for line in plan if "Exchange hashpartitioning(user_id_hash" in line and "REPARTITION" in line]
    grouped = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(advertiser_id" in line)
    assert "partial_sum" in "".join(plan[:grouped]) and "partial_sum" not in "".join(plan[grouped:])


def test_outputs_are_audited_once(spark):
    """The report is written by the audit that the outputs have to pass, so reading it audits nothing again."""
    report = QUERIES["output_audit"](spark, SF_DIR)
    assert "Exchange" not in physical(report)
    assert [r["duplicate_keys"] for r in report.collect()] == [0, 0, 0]


def test_groups_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in physical(QUERIES["skew_indicators"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["scan_partition", "ingest_partitioned"])
def test_counts_combine_before_the_shuffle(spark, name):
    assert "partial_count" in physical(QUERIES[name](spark, SF_DIR))


def test_partition_scan_lists_one_hour_only(spark, tmp_path):
    table = files.table_path(str(tmp_path), "raw", "t")
    for hour in ("10", "11"):
        sinks.write_snapshot(spark.range(5), files.partition_path(table, "2026-05-21", hour))
    read = files.scan_partitions(spark, table, "2026-05-21", ("11",)).inputFiles()
    assert read and all("hour=11" in f for f in read)
