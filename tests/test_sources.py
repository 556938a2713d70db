"""CSV dialect, corrupt-record capture, inference, JSON days and partitioned Parquet."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from larder import contracts
from larder.sinks import files as sinks
from larder.sources import files as src
from tests.conftest import write_text

AISLES = contracts.BRONZE["aisles"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_malformed_missing_and_extra_tokens(spark, out):
    p = write_text(f"{out}/a.csv", "aisle_id,aisle\nbad,y\n7\n6,p,extra\n1,ok\n")
    df = src.read_csv(spark, p, AISLES, corrupt_column=src.CORRUPT_COLUMN)
    got = {r.aisle: r for r in df.collect() if r.aisle}
    assert got["y"].aisle_id is None and got["y"][src.CORRUPT_COLUMN] == "bad,y"
    assert got["p"].aisle_id == 6 and got["p"][src.CORRUPT_COLUMN] == "6,p,extra"
    assert got["ok"][src.CORRUPT_COLUMN] is None
    seven = [r for r in df.collect() if r.aisle_id == 7][0]
    assert seven.aisle is None and seven[src.CORRUPT_COLUMN] == "7"


def test_empty_and_quoted_empty_read_as_null(spark, out):
    p = write_text(f"{out}/a.csv", 'aisle_id,aisle\n3,\n4,""\n')
    assert rows(src.read_csv(spark, p, AISLES)) == [(3, None), (4, None)]


def test_doubled_quotes_and_embedded_newline(spark, out):
    p = write_text(f"{out}/a.csv", 'aisle_id,aisle\n5,"a ""q"" b"\n8,"l1\nl2"\n')
    df = src.read_csv(spark, p, AISLES, multiline=True)
    assert rows(df) == [(5, 'a "q" b'), (8, "l1\nl2")]


def test_swapped_header_fails_instead_of_binding_by_position(spark, out):
    p = write_text(f"{out}/a.csv", "aisle,aisle_id\nx,1\n")
    with pytest.raises(Exception):
        src.read_csv(spark, p, AISLES).collect()
    lenient = src.read_csv(spark, p, AISLES, check_header=False)
    assert rows(lenient) == [(None, "1")]


def test_inferred_types(spark, out):
    p = write_text(f"{out}/o.csv", "id,qty,order_date,name\n007,2,2021-01-02,x\n8,,2021-01-03,y\n")
    df = src.read_csv_inferred(spark, p)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types == {"id": "int", "qty": "int", "order_date": "date", "name": "string"}
    assert rows(df)[0] == (7, 2, dt.date(2021, 1, 2), "x")


def test_csv_round_trip_keeps_quotes_and_commas(spark, out):
    df = spark.createDataFrame([(1, 'say "hi", twice'), (2, None)], contracts.to_struct(AISLES))
    sinks.write_csv(df, f"{out}/csv")
    assert rows(src.read_csv(spark, f"{out}/csv", AISLES)) == rows(df)


def test_json_day_and_backfill(spark, out):
    schema = contracts.BRONZE["out_of_stock"]
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    feed = spark.createDataFrame([(1, d1), (2, d2), (2, d2)], contracts.to_struct(schema))
    sinks.land_json_days(feed, out)
    day = src.read_json_day(spark, out, d2, schema)
    assert day.columns == ["product_id", "date"]
    assert rows(day) == [(2, d2), (2, d2)]
    assert len(src.read_json_days(spark, out, [d1, d2], schema).collect()) == 3
    with pytest.raises(PySparkException):
        src.read_json_days(spark, out, [dt.date(2021, 1, 3)], schema).collect()


def test_single_day_landing_replaces_the_day(spark, out):
    schema = contracts.BRONZE["out_of_stock"]
    d = dt.date(2021, 5, 1)
    day = spark.createDataFrame([(1, d), (3, d)], contracts.to_struct(schema))
    sinks.land_json_day(day, out, d)
    sinks.land_json_day(day, out, d)
    assert len(src.read_json_day(spark, out, d, schema).collect()) == 2


def test_partitioned_parquet_null_partition_and_column_order(spark, out):
    schema = contracts.BRONZE["orders"]
    d = dt.date(2021, 1, 1)
    df = spark.createDataFrame([(1, 10, 100, 5, 2, d), (2, 11, 101, None, 1, d)], contracts.to_struct(schema))
    sinks.write_parquet(df, out, partition_by="store_id")
    raw = src.read_parquet(spark, out)
    assert raw.columns[-1] == "store_id"
    typed = src.read_parquet(spark, out, schema)
    assert typed.columns == list(schema)
    assert rows(typed) == rows(df)


def test_partition_filter_is_pruned(spark, out):
    schema = contracts.BRONZE["orders"]
    d = dt.date(2021, 1, 1)
    df = spark.createDataFrame([(i, i, i, i % 3, 1, d) for i in range(30)], contracts.to_struct(schema))
    sinks.write_parquet(df, out, partition_by="store_id")
    q = src.read_parquet(spark, out, schema).where("store_id = 1")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(store_id" in plan
    assert {r.store_id for r in q.collect()} == {1}



def test_declared_not_null_is_not_enforced_on_read_but_checked(spark, out):
    from larder.quality.checks import null_counts

    p = write_text(f"{out}/a.csv", "aisle_id,aisle\n,x\n2,y\n")
    df = src.read_csv(spark, p, AISLES)
    assert sorted(map(tuple, df.collect()), key=repr) == [(2, "y"), (None, "x")]
    required = contracts.required_columns(AISLES)
    assert [tuple(r) for r in null_counts(df, required).collect()] == [(2, 1)]


def test_api_day_document_as_one_line_array(spark, out):
    day = dt.date(2021, 8, 22)
    doc = '[{"product_id": 7, "date": "2021-08-22"}, {"product_id": 7, "date": "2021-08-22"}, ' \
          '{"product_id": 9, "date": "2021-08-22"}]'
    write_text(f"{src.day_dir(out, day)}/data.json", doc + "\n")
    df = src.read_json_day(spark, out, day, contracts.BRONZE["out_of_stock"])
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "date"]
    assert rows(df) == [(7, day), (7, day), (9, day)]
