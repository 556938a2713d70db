"""Published versions, compaction, key buckets, header drift and bucketed facts."""

from __future__ import annotations

import datetime as dt
import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from larder import contracts
from larder.operators import keys
from larder.sinks import compaction, versions
from larder.sinks import files as sinks
from larder.sources import drift
from tests.conftest import write_text

DAYS = "product_id int, date date"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_write_that_fails_midway_leaves_the_old_rows(spark, out):
    path = f"{out}/table"
    versions.publish(spark.range(5), path)
    bad = spark.range(0, 9, 1, 3).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        versions.publish(bad, path)
    assert rows(versions.read_published(spark, path)) == [(k,) for k in range(5)]
    versions.publish(versions.read_published(spark, path).where("id > 2"), path)  # from its own rows
    assert rows(versions.read_published(spark, path)) == [(3,), (4,)]
    assert len(versions.expire(spark, path)) == 2
    assert rows(versions.read_published(spark, path)) == [(3,), (4,)] and versions.expire(spark, path) == []


def test_nothing_published_is_an_error(spark, out):
    assert versions.current(spark, f"{out}/none") is None
    with pytest.raises(FileNotFoundError):
        versions.read_published(spark, f"{out}/none")


def test_compaction_packs_days_and_keeps_pruning(spark, out):
    first = dt.date(2015, 1, 1)
    days = [(k * 7 + j, first + dt.timedelta(days=k)) for k in range(300) for j in range(3)] + [(1, None), (2, None)]
    big = [(k, dt.date(2020, 1, 1)) for k in range(60_000)]
    df = spark.createDataFrame(days + big, DAYS)
    sinks.write_parquet_daily(df, f"{out}/days")
    target = 40_000
    for _ in range(2):  # safe to repeat
        compaction.compact(spark, f"{out}/days", f"{out}/packed", DAYS, "date", target_bytes=target)
        versions.expire(spark, f"{out}/packed")
    packed = compaction.read_compacted(spark, f"{out}/packed", DAYS)
    assert rows(packed.drop("span")) == rows(df)
    files = glob.glob(f"{out}/packed/**/*.parquet", recursive=True)
    assert len(files) < 30  # of 302 folders
    lo, hi = dt.date(2015, 2, 1), dt.date(2015, 2, 3)
    some = packed.where(compaction.between("date", lo, hi))
    assert rows(some.drop("span")) == sorted([r for r in days if r[1] and lo <= r[1] <= hi], key=str)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "substring(span" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(date" in plan.split("PushedFilters: [")[1]


def test_key_buckets_read_only_the_new_keys_buckets(spark, out):
    path, many = f"{out}/keys", spark.range(5000).select(F.col("id").alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("b"))
    keys.add_keys(many, path, ["a", "b"], buckets=32)
    new = spark.createDataFrame([(1, 1, "x"), (9999, 1, "y"), (9999, 1, "z"), (7, None, "u"), (None, None, "v")], "a long, b long, c string")
    got = keys.new_keys_bucketed(new, path, ["a", "b"], buckets=32)
    want = keys.new_keys_only(new, many, ["a", "b"])
    assert rows(got.select("a", "b")) == rows(want.select("a", "b")) == [(9999, 1), (None, None)]
    plan = keys.keys_near(new, path, ["a", "b"], buckets=32)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert keys.new_keys_bucketed(new, f"{out}/fresh", ["a", "b"], buckets=32).count() == 4
    with pytest.raises(ValueError, match="buckets-32"):
        keys.add_keys(new, path, ["a", "b"], buckets=64)


def test_drifting_headers_bind_by_name(spark, out):
    spec = contracts.BRONZE["products"]
    paths = [write_text(f"{out}/1.csv", 'product_id,product_name,aisle_id,department_id\n1,"a ""q"" b",2,3\n'),
             write_text(f"{out}/2.csv", 'aisle_id,"new, one",product_id,product_name,department_id\n5,zz,4,name,6\n'),
             write_text(f"{out}/3.csv", "product_name,product_id\nonly,7\n"), write_text(f"{out}/4.csv", ""),
             write_text(f"{out}/5.csv", "product_id,product_name,aisle_id,department_id\n")]
    assert rows(drift.read_csv_by_name(spark, paths, spec)) == sorted(
        [(1, 'a "q" b', 2, 3), (4, "name", 5, 6), (7, "only", None, None)], key=str)
    report = sorted((os.path.basename(f), c, k) for f, c, k in rows(drift.drift_report(spark, paths, spec)))
    assert report == [("2.csv", "aisle_id", "moved"), ("2.csv", "new, one", "added"), ("2.csv", "product_id", "moved"), ("2.csv", "product_name", "moved"),
                      ("3.csv", "aisle_id", "missing"), ("3.csv", "department_id", "missing"), ("3.csv", "product_id", "moved"), ("3.csv", "product_name", "moved")]
    twice = write_text(f"{out}/6.csv", "product_id,product_id\n1,2\n")
    with pytest.raises(ValueError, match="more than once"):
        drift.read_csv_by_name(spark, [twice], spec)
    assert drift.read_csv_by_name(spark, [], spec).collect() == [] and drift.drift_report(spark, [], spec).collect() == []


def test_bucketed_facts_keep_few_files_and_join_without_exchange(spark, out):
    tag = uuid.uuid4().hex[:8]
    facts = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 2000).cast("int").alias("store_id"), F.col("id").alias("n"), F.lit(0).alias("bucket"))
    stores = spark.range(2000).select(F.col("id").cast("int").alias("store_id"), F.lit("x").alias("type"))
    for name, df in (("f", facts), ("s", stores)):
        sinks.write_bucketed(df, f"t_{name}_{tag}", f"{out}/{name}", "store_id", 8)
    assert len(glob.glob(f"{out}/f/*.parquet")) <= 16  # 2,000 stores
    joined = spark.table(f"t_f_{tag}").join(spark.table(f"t_s_{tag}").hint("merge"), "store_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 40_000 and rows(spark.table(f"t_f_{tag}")) == rows(facts)
