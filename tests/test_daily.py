"""End-to-end runs on the smallest test tables: bronze snapshots -> silver -> gold."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from larder import contracts
from larder.functions import calendar as cal
from larder.plans import daily, roles
from larder.quality import checks
from larder.sinks import files as sinks
from larder.sources import files as src
from tests.conftest import SF_SMOKE

RUN = dt.date(2021, 8, 22)


def _layout(out):
    return daily.ShopLayout(bronze=f"{out}/bronze", feed=f"{out}/feed", silver=f"{out}/silver", gold=f"{out}/gold")


def _land_snapshots(spark, layout):
    for table in contracts.SILVER_TRANSFORM:
        if table != "out_of_stock":
            sinks.write_csv_snapshot(roles.bronze(spark, SF_SMOKE, table), layout.bronze, RUN, table)


def test_shop_snapshot_run_builds_conforming_gold(spark, out):
    layout = _layout(out)
    _land_snapshots(spark, layout)
    daily.run_shop_snapshot(spark, layout, RUN)
    for table in ["dim_stores", "dim_products", "dim_clients", "dim_area", "fact_orders"]:
        gold = spark.read.parquet(f"{layout.gold}/{table}")
        assert checks.contract_mismatches(gold, contracts.GOLD[table]) == [], table
    silver_orders = daily.read_silver(spark, layout, "orders")
    assert silver_orders.columns == list(contracts.BRONZE["orders"])
    bronze_orders = roles.bronze(spark, SF_SMOKE, "orders")
    assert silver_orders.count() == bronze_orders.distinct().count()
    assert spark.read.parquet(f"{layout.gold}/dim_products").count() == \
        roles.bronze(spark, SF_SMOKE, "products").distinct().count()
    # Dimension keys are unique after de-duplication.
    for table in ["dim_stores", "dim_products", "dim_clients", "dim_area"]:
        gold = spark.read.parquet(f"{layout.gold}/{table}")
        assert checks.duplicate_keys(gold, contracts.GOLD_KEYS[table]).count() == 0, table


def test_rerun_of_snapshot_is_idempotent(spark, out):
    layout = _layout(out)
    _land_snapshots(spark, layout)
    daily.run_shop_snapshot(spark, layout, RUN)
    first = spark.read.parquet(f"{layout.gold}/fact_orders").count()
    daily.run_shop_snapshot(spark, layout, RUN)
    assert spark.read.parquet(f"{layout.gold}/fact_orders").count() == first


def test_out_of_stock_feed_rerun_and_backfill(spark, out):
    layout = _layout(out)
    feed = roles.bronze(spark, SF_SMOKE, "out_of_stock")
    days = [r[0] for r in feed.select("date").distinct().orderBy("date").limit(3).collect()]
    for d in days:
        sinks.land_json_day(feed.where(F.col("date") == d), layout.feed, d)
    daily.run_out_of_stock(spark, layout, days[:2])
    daily.run_out_of_stock(spark, layout, days[1:])  # day 2 re-run, day 3 new
    silver = daily.read_silver(spark, layout, "out_of_stock")
    expected = feed.where(F.col("date").isin(days)).distinct()
    assert sorted(map(tuple, silver.collect())) == sorted(map(tuple, expected.collect()))
    fact = spark.read.parquet(f"{layout.gold}/fact_out_of_stock")
    assert fact.columns == ["product_id", "oos_date"] and fact.count() == expected.count()


def _events(spark, layout):
    return sorted(map(tuple, daily.read_silver(spark, layout, "out_of_stock").collect()), key=str)


def _fact(spark, layout):
    return sorted(map(tuple, src.read_parquet(spark, f"{layout.gold}/fact_out_of_stock", contracts.GOLD["fact_out_of_stock"]).collect()), key=str)


def _land(spark, layout, day, rows):
    sinks.land_json_day(spark.createDataFrame(rows, "product_id int, date date"), layout.feed, day, layout=layout.feed_layout)


def test_late_undated_and_emptied_days_keep_exactly_the_right_rows(spark, out):
    for kind in ("day", "dated"):
        base = _layout(f"{out}/{kind}")
        layout = daily.ShopLayout(base.bronze, base.feed, base.silver, base.gold, feed_layout=kind)
        d1, d2, d3 = (dt.date(2021, 3, k) for k in (1, 2, 3))
        _land(spark, layout, d1, [(1, d1), (2, d1), (3, d1), (4, None)])
        daily.run_out_of_stock(spark, layout, [d1])
        _land(spark, layout, d2, [(5, d2), (9, d1), (3, d1), (6, None)])  # 9 is late, 3 comes again
        daily.run_out_of_stock(spark, layout, [d2])
        everything = [(1, d1), (2, d1), (3, d1), (9, d1), (4, None), (6, None), (5, d2)]
        assert _events(spark, layout) == _fact(spark, layout) == sorted(everything, key=str)
        daily.run_out_of_stock(spark, layout, [d1])  # a re-run loses nothing of the other day
        assert _events(spark, layout) == _fact(spark, layout) == sorted(everything, key=str)
        _land(spark, layout, d3, [(7, d3)])
        daily.run_out_of_stock(spark, layout, [d2, d3])
        _land(spark, layout, d2, [])  # landed again, empty
        daily.run_out_of_stock(spark, layout, [d2])
        left = [(1, d1), (2, d1), (3, d1), (4, None), (7, d3)]
        assert _events(spark, layout) == _fact(spark, layout) == sorted(left, key=str)
        _land(spark, layout, d1, [(1, d1)])
        daily.run_out_of_stock(spark, layout, [d1])
        assert _events(spark, layout) == _fact(spark, layout) == sorted([(1, d1), (7, d3)], key=str)


def test_full_build_and_daily_refresh_share_one_layout(spark, out):
    layout = _layout(out)
    d1, d2 = dt.date(2021, 3, 1), dt.date(2021, 3, 2)
    _land(spark, layout, d1, [(1, d1), (2, None)])
    daily.out_of_stock_to_silver(spark, layout, [d1])
    daily.build_gold(spark, layout, tables=["fact_out_of_stock"])
    _land(spark, layout, d2, [(3, d2)])
    daily.run_out_of_stock(spark, layout, [d2])
    assert _fact(spark, layout) == sorted([(1, d1), (2, None), (3, d2)], key=str)
    spark.createDataFrame([(1, d1)], "product_id int, oos_date date").write.mode("append").parquet(f"{layout.gold}/fact_out_of_stock")
    with pytest.raises(ValueError, match="laid out"):
        daily.run_out_of_stock(spark, layout, [d2])


def test_warehouse_run_sends_the_calendar_to_the_writer(spark, out):
    layout = _layout(out)
    _land_snapshots(spark, layout)
    _land(spark, layout, RUN, [(1, RUN)])
    written, appended = {}, {}
    write = lambda df, table: written.update({table: df.count()})
    append = lambda df, table: appended.update({table: df.collect()})
    with pytest.raises(ValueError, match="append"):
        daily.run_day(spark, layout, RUN, write)
    empty = spark.createDataFrame([], contracts.gold_schema("dim_date"))
    daily.run_day(spark, layout, RUN, write, append=append, existing_calendar=empty)
    assert set(written) == {"dim_stores", "dim_products", "dim_clients", "dim_area", "fact_orders", "fact_out_of_stock"}
    assert [r["action_date"] for r in appended["dim_date"]] == [RUN]
    daily.run_day(spark, layout, RUN, write, append=append, existing_calendar=cal.calendar_row(spark, RUN))
    assert appended["dim_date"] == []
    assert not os.path.exists(layout.gold)


def test_unreadable_calendar_is_an_error(spark, out):
    layout = _layout(out)
    os.makedirs(f"{layout.gold}/dim_date")
    with open(f"{layout.gold}/dim_date/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        daily.append_calendar(spark, layout, RUN)


def test_line_breaks_in_values_survive(spark, out):
    layout = _layout(out)
    sinks.write_csv_snapshot(spark.createDataFrame([(1, "a\nb", 2), (2, None, None)], contracts.to_struct(contracts.BRONZE["clients"])), layout.bronze, RUN, "clients")
    daily.bronze_to_silver(spark, "clients", src.snapshot_path(layout.bronze, RUN, "clients"), layout.silver_table("clients"))
    assert sorted(map(tuple, daily.read_silver(spark, layout, "clients").collect())) == [(1, "a\nb", 2), (2, None, None)]


def test_snapshot_files_of_the_other_layout(spark, out):
    layout = daily.ShopLayout(f"{out}/b", f"{out}/f", f"{out}/s", f"{out}/g", snapshot_layout="file")
    for table in contracts.SILVER_TRANSFORM:
        if table != "out_of_stock":
            sinks.write_csv(roles.bronze(spark, SF_SMOKE, table), src.snapshot_path(layout.bronze, RUN, table, "file"))
    daily.run_shop_snapshot(spark, layout, RUN, rejects=True)
    assert daily.read_silver(spark, layout, "orders").count() == roles.bronze(spark, SF_SMOKE, "orders").distinct().count()
    assert os.path.isdir(sinks.rejects_path(layout.silver_table("orders"), RUN))


def test_rejects_written_next_to_silver(spark, out):
    layout = _layout(out)
    sinks.write_csv_snapshot(roles.bronze(spark, SF_SMOKE, "departments"), layout.bronze, RUN, "departments")
    bronze_path = src.snapshot_path(layout.bronze, RUN, "departments")
    daily.bronze_to_silver(spark, "departments", bronze_path, layout.silver_table("departments"),
                              rejects_date=RUN)
    raw = src.read_csv_inferred(spark, bronze_path)
    silver = daily.read_silver(spark, layout, "departments")
    schema = {**contracts.BRONZE["departments"], "raw_line": {"type": contracts.STR}, "reason": {"type": contracts.STR}}
    rejects = src.read_csv(spark, sinks.rejects_path(layout.silver_table("departments"), RUN), schema)
    assert raw.count() == silver.count() + rejects.count()
    assert rejects.where("department is null").count() == raw.where("department is null").count()


def test_append_calendar_day(spark):
    existing = cal.calendar_row(spark, RUN)
    assert daily.append_calendar_day(spark, existing, RUN).count() == 0
    nxt = daily.append_calendar_day(spark, existing, RUN + dt.timedelta(days=1))
    assert checks.contract_mismatches(nxt, contracts.GOLD["dim_date"]) == []
    assert nxt.count() == 1


def test_run_day_end_to_end_and_rerun(spark, out):
    layout = _layout(out)
    _land_snapshots(spark, layout)
    feed = roles.bronze(spark, SF_SMOKE, "out_of_stock")
    latest = feed.agg(F.max("date")).first()[0]
    sinks.land_json_day(feed.where(F.col("date") == latest), layout.feed, RUN)
    daily.run_day(spark, layout, RUN)
    daily.run_day(spark, layout, RUN)
    dim_date = spark.read.parquet(f"{layout.gold}/dim_date")
    assert [tuple(r) for r in dim_date.collect()] == [(RUN, 22, 8, 2021, "Sun")]
    for table in ["dim_stores", "dim_products", "dim_clients", "dim_area", "fact_orders", "fact_out_of_stock"]:
        assert checks.contract_mismatches(spark.read.parquet(f"{layout.gold}/{table}"),
                                          contracts.GOLD[table]) == [], table


def test_contract_report(spark):
    df = spark.createDataFrame([(1, "Mon"), (1, "Tues"), (None, "Wed")], "k int, name string")
    report = checks.contract_report(df, "t", "k int not null, name string", ["k"], {"name": 3})
    got = sorted(tuple(r) for r in report.collect())
    assert got == [("t", "max_length_3", "name", 1), ("t", "not_null", "k", 1), ("t", "unique_key", "k", 1)]


def test_incremental_fact_refresh_reads_only_the_touched_dates(spark, out):
    layout = _layout(out)
    feed = roles.bronze(spark, SF_SMOKE, "out_of_stock")
    days = [r[0] for r in feed.select("date").distinct().orderBy("date").limit(3).collect()]
    for d in days:
        _land(spark, layout, d, [(r[0], r[1]) for r in feed.where(F.col("date") == d).collect()] + [(7, None)])
    daily.run_out_of_stock(spark, layout, days)
    before = _fact(spark, layout)
    # The refresh's own plan: the touched dates are the partition filter of its scan.
    plan = daily.touched_facts(spark, layout, days[1:2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and plan.split("PartitionFilters: [")[1].split("]")[0].count(str((days[1] - dt.date(1970, 1, 1)).days)) + \
        plan.split("PartitionFilters: [")[1].split("]")[0].count(str(days[1])) >= 1, plan
    files = daily.touched_facts(spark, layout, days[1:2]).inputFiles()
    assert files
    # A file of another date cannot be read any more: the refresh of a day does not notice.
    other = glob.glob(f"{layout.silver_table('out_of_stock')}/day={days[0]}/date={days[0]}/*.parquet")
    kept = {f: open(f, "rb").read() for f in other}
    for f in other:
        with open(f, "w") as fh:
            fh.write("not parquet")
    daily.refresh_fact_out_of_stock(spark, layout, [days[1]])
    daily.refresh_fact_out_of_stock(spark, layout, [])
    for f, raw in kept.items():
        with open(f, "wb") as fh:
            fh.write(raw)
    for crc in glob.glob(f"{layout.silver_table('out_of_stock')}/day={days[0]}/date={days[0]}/.*.crc"):
        os.remove(crc)
    assert _fact(spark, layout) == before
    daily.refresh_fact_out_of_stock(spark, layout, [None, dt.date(1999, 1, 1)])  # no such date
    assert _fact(spark, layout) == before


def test_an_empty_array_takes_the_days_rows_away(spark, out):
    layout = daily.ShopLayout(f"{out}/b", f"{out}/f", f"{out}/s", f"{out}/g", feed_layout="dated")
    d = dt.date(2021, 3, 1)
    path = f"{layout.feed}/{d}/data.json"
    os.makedirs(os.path.dirname(path))
    for text, want in (('[{"product_id": 1, "date": "2021-03-01"}]', [(1, d)]), ("[]", [])):
        with open(path, "w") as fh:
            fh.write(text)
        daily.run_out_of_stock(spark, layout, [d])
        assert _events(spark, layout) == want if want else not glob.glob(f"{layout.gold}/fact_out_of_stock/oos_date=*")


def test_calendar_upkeep_equals_the_full_rebuild(spark, out):
    layout = _layout(out)
    _land_snapshots(spark, layout)
    daily.run_shop_snapshot(spark, layout, RUN)
    _land(spark, layout, RUN, [(1, RUN), (2, None)])
    daily.run_out_of_stock(spark, layout, [RUN])
    daily.build_gold(spark, layout, tables=["dim_date"])
    rows = lambda: sorted(map(tuple, spark.read.parquet(f"{layout.gold}/dim_date").collect()), key=str)
    full = rows()
    for f in glob.glob(f"{layout.silver_table('orders')}/**/*.parquet", recursive=True):
        with open(f, "w") as fh:  # orders are not read any more
            fh.write("not parquet")
    daily.refresh_calendar(spark, layout)
    assert rows() == full


def test_append_writer_needs_the_calendar(spark, out):
    with pytest.raises(ValueError, match="calendar"):
        daily.append_calendar(spark, _layout(out), RUN, append=lambda df, table: None)
