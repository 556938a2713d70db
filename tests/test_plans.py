"""Physical-plan properties the design relies on (checked on the smallest test tables)."""

from __future__ import annotations

import datetime as dt

from larder import contracts
from larder.plans import catalog, marts, roles
from larder.sinks import files as sinks
from larder.sources import files as src
from tests.conftest import SF_SMOKE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_small_lookups_are_broadcast_at_run_time_without_jobs_at_build_time(spark):
    parquet = [roles.bronze(spark, SF_SMOKE, t) for t in ("products", "aisles", "departments")]
    before = jobs(spark)
    df = marts.dim_products(*parquet)
    stores = marts.dim_stores(roles.bronze(spark, SF_SMOKE, "stores"), roles.bronze(spark, SF_SMOKE, "store_types"))
    listing = 4  # the four tables of dim_stores: a schema read of each
    assert jobs(spark) - before <= listing
    for p in (final_plan(df), final_plan(stores)):
        assert "BroadcastHashJoin" in p and "LeftOuter" in p and "SortMergeJoin" not in p


def scans(df) -> int:
    return plan(df).count("FileScan")


def test_fixture_copies_and_contract_report_read_each_table_once(spark):
    assert scans(catalog.QUERIES["fact_orders"](spark, SF_SMOKE)) == 2
    assert scans(catalog.QUERIES["check_gold_contracts"](spark, SF_SMOKE)) <= 24


def test_reasoned_rejects_scan_the_extract_once(spark):
    assert scans(catalog.QUERIES["rejects_reasoned"](spark, SF_SMOKE)) == 1


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(catalog.QUERIES["fact_out_of_stock"](spark, SF_SMOKE))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>" in p


def test_dedup_is_partial_then_final_aggregate(spark):
    p = plan(catalog.QUERIES["dedup_rows"](spark, SF_SMOKE))
    assert p.count("HashAggregate") >= 2 and "Exchange hashpartitioning" in p


def test_key_check_pre_aggregates(spark):
    p = plan(catalog.QUERIES["check_unique_key"](spark, SF_SMOKE))
    assert "partial_count" in p


def test_dim_date_skips_the_redundant_order_dedup(spark):
    p = plan(catalog.QUERIES["dim_date"](spark, SF_SMOKE))
    # Only the order date (and the join key) is read from the order feed.
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p
    assert "ReadSchema: struct<l_orderkey:bigint>" in p


def test_daily_fact_refresh_prunes_partitions(spark, out):
    oos = catalog.silver(spark, SF_SMOKE, "out_of_stock")
    sinks.write_parquet(oos, out, partition_by="date")
    silver = src.read_parquet(spark, out, contracts.BRONZE["out_of_stock"])
    day = silver.agg({"date": "max"}).first()[0]
    p = plan(marts.fact_out_of_stock(silver, run_date=day))
    assert f"PartitionFilters: [isnotnull(date" in p and str(day) in p
    assert isinstance(day, dt.date)


def test_partitioned_write_is_rebalanced(spark):
    df = catalog.QUERIES["fact_orders"](spark, SF_SMOKE)
    assert "REBALANCE_PARTITIONS_BY_COL" in df._jdf.queryExecution().executedPlan().toString() or \
        "rebalance" in df._jdf.queryExecution().logical().toString().lower()


def test_no_python_udfs_in_any_registered_query(spark):
    for name in ("dim_products", "fact_orders", "rejects_diff", "check_gold_contracts", "calendar_range"):
        p = plan(catalog.QUERIES[name](spark, SF_SMOKE))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_registered_daily_fact_reads_one_folder(spark):
    p = plan(catalog.QUERIES["fact_out_of_stock_day"](spark, SF_SMOKE))
    assert "PartitionFilters: [isnotnull(date" in p and "(date#" in p
