"""Contracts, data-quality checks, Parquet/CSV sinks and JDBC write options."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from larder import contracts
from larder.quality import checks
from larder.sinks import files as sinks
from larder.sinks import jdbc
from larder.sources import files as src
from larder.sources.jdbc import jdbc_options


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_contract_forms(spark):
    mapping = contracts.to_struct(contracts.BRONZE["aisles"])
    assert mapping == T.StructType([T.StructField("aisle_id", T.IntegerType(), False),
                                    T.StructField("aisle", T.StringType(), True)])
    assert contracts.to_struct("a int, b decimal(12,2)").fields[1].dataType == T.DecimalType(12, 2)
    custom = contracts.to_struct({"amount": {"type": "decimal(10,3)", "nullable": True}})
    assert custom.fields[0].dataType == T.DecimalType(10, 3)
    assert contracts.required_columns(contracts.BRONZE["orders"]) == []
    assert contracts.required_columns(contracts.BRONZE["stores"]) == ["store_id"]
    assert set(contracts.GOLD) == set(contracts.GOLD_KEYS)


def test_duplicate_keys_and_null_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, None)], "k int, v string")
    assert bag(checks.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert bag(checks.null_counts(df, ["k", "v"])) == [(4, 1, 2)]


def test_length_violations(spark):
    df = spark.createDataFrame([("Mon",), ("Tues",), (None,)], "action_weekday string")
    out = checks.length_violations(df, {"action_weekday": 3}, "dim_date")
    assert bag(out) == [("dim_date", "action_weekday", 3, 4, 1)]


def test_conform_and_mismatches(spark):
    df = spark.createDataFrame([(1, 2, 3, dt.datetime(2021, 1, 1, 5), 4.0, "x")],
                               "client_id long, product_id long, store_id long, order_date timestamp, "
                               "quantity double, extra string")
    contract = contracts.GOLD["fact_orders"]
    assert checks.contract_mismatches(df, contract)
    out = checks.conform(df, contract)
    assert checks.contract_mismatches(out, contract) == []
    assert bag(out) == [(2, 1, 3, dt.date(2021, 1, 1), 4)]
    with pytest.raises(ValueError):
        checks.conform(df.drop("quantity"), contract)


def test_append_doubles_dynamic_overwrite_does_not(spark, out):
    schema = contracts.to_struct(contracts.BRONZE["out_of_stock"])
    day = spark.createDataFrame([(1, dt.date(2021, 1, 1)), (2, dt.date(2021, 1, 1))], schema)
    other = spark.createDataFrame([(3, dt.date(2021, 1, 2))], schema)
    sinks.write_parquet(day, f"{out}/append", mode="append", partition_by="date")
    sinks.write_parquet(day, f"{out}/append", mode="append", partition_by="date")
    assert spark.read.parquet(f"{out}/append").count() == 4
    sinks.write_parquet_daily(other, f"{out}/daily")
    sinks.write_parquet_daily(day, f"{out}/daily")
    sinks.write_parquet_daily(day, f"{out}/daily")
    got = src.read_parquet(spark, f"{out}/daily", contracts.BRONZE["out_of_stock"])
    assert bag(got) == bag(day.union(other))


def test_static_overwrite_replaces_whole_table(spark, out):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    sinks.write_parquet(a, out)
    sinks.write_parquet(a.where("x = 1"), out)
    assert bag(spark.read.parquet(out)) == [(1,)]


def test_reject_and_snapshot_paths():
    assert sinks.rejects_path("/s/products", dt.date(2021, 8, 22)) == "/s/products_errors/2021-08-22/rejected.csv"
    assert src.snapshot_path("/b/data", "2021-08-22", "orders") == "/b/data/2021-08-22/orders"
    assert src.snapshot_path("/b/data/", "2021-08-22", "orders", "file") == "/b/data/2021-08-22/orders.csv"
    assert src.day_dir("/f", "2021-08-22", "dated") == "/f/2021-08-22/data.json"


def test_jdbc_write_options_keep_keys_and_batch():
    opts = jdbc.warehouse_write_options("jdbc:postgresql://h/db", "dim_area", {"user": "u"},
                                        mode="overwrite", batch_size=100_000, num_partitions=4)
    assert opts["truncate"] == "true" and opts["batchsize"] == "100000"
    assert opts["queryTimeout"] == "690" and opts["numPartitions"] == "4"
    assert opts["dbtable"] == "dim_area" and opts["user"] == "u"
    append = jdbc.warehouse_write_options("jdbc:x", "dim_date", mode="append")
    assert "truncate" not in append and "batchsize" not in append
    assert jdbc_options("jdbc:x", None, fetchsize=10, skipped=None) == {"url": "jdbc:x", "fetchsize": "10"}


def test_jdbc_reads_are_split_or_single_on_request():
    import datetime as dt

    from larder.sources.jdbc import snapshot_options

    with pytest.raises(ValueError, match="single_connection"):
        snapshot_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        snapshot_options("jdbc:x", "t", partition_column="id", single_connection=True)
    assert "numPartitions" not in snapshot_options("jdbc:x", "t", single_connection=True)
    opts = snapshot_options("jdbc:x", "t", partition_column="d", bounds=(dt.date(2021, 1, 1), dt.date(2021, 2, 1)), num_partitions=4)
    assert (opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("2021-01-01", "2021-02-01", "4")
    assert "partitionColumn" not in snapshot_options("jdbc:x", "t", partition_column="id", bounds=(None, None))  # an empty table


def test_jdbc_writes_have_a_connection_limit():
    opts = jdbc.warehouse_write_options("jdbc:x", "t", mode="append")
    assert opts["numPartitions"] == str(jdbc.WRITE_CONNECTIONS)


def test_given_bounds_stay_and_missing_ones_are_asked(spark, monkeypatch):
    from larder.sources import jdbc as source

    asked = []
    monkeypatch.setattr(source, "read_table_bounds", lambda *a: asked.append(a) or (1, 90))
    seen = {}
    monkeypatch.setattr(source, "snapshot_options", lambda *a, **kw: seen.update(kw) or {"url": "jdbc:none"})
    with pytest.raises(Exception):  # no database is opened: the options lack a table
        source.read_jdbc_snapshot(spark, "jdbc:none", "t", partition_column="id", lower_bound=0)
    assert seen["bounds"] == (0, 90) and len(asked) == 1
