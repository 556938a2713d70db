"""Calendar functions and the star-schema marts on small literal silver tables."""

from __future__ import annotations

import datetime as dt

from larder import contracts
from larder.functions import calendar as cal
from larder.plans import marts

S = contracts.to_struct


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_calendar_row_parts_and_weekday(spark):
    row = cal.calendar_row(spark, dt.date(2021, 8, 22)).collect()
    assert [tuple(r) for r in row] == [(dt.date(2021, 8, 22), 22, 8, 2021, "Sun")]
    assert not cal.calendar_row(spark, dt.date(2021, 1, 1)).schema["action_date"].nullable


def test_weekday_names_match_python_for_a_range(spark):
    start = dt.date(2020, 1, 1)
    rows = cal.calendar_range(spark, start, dt.date(2020, 12, 31)).collect()
    assert len(rows) == 366
    for r in rows:
        assert r.action_weekday == r.action_date.strftime("%a")
        assert (r.action_day, r.action_month, r.action_year) == (
            r.action_date.day, r.action_date.month, r.action_date.year)


def test_calendar_seed_range_has_233_days(spark):
    rows = cal.calendar_range(spark, dt.date(2021, 1, 1), dt.date(2021, 8, 21)).collect()
    assert len(rows) == 233
    assert tuple(rows[0]) == (dt.date(2021, 1, 1), 1, 1, 2021, "Fri")


def test_calendar_span_of_data(spark):
    dates = spark.createDataFrame([(dt.date(2021, 1, 30),), (dt.date(2021, 2, 2),), (None,)], "d date")
    out = cal.calendar_span(dates, "d")
    assert [r.action_date.isoformat() for r in out.orderBy("action_date").collect()] == [
        "2021-01-30", "2021-01-31", "2021-02-01", "2021-02-02"]
    empty = spark.createDataFrame([], "d date")
    assert cal.calendar_span(empty, "d").count() == 0


def _shop(spark):
    products = spark.createDataFrame(
        [(1, "milk", 10, 100), (2, "bread", 11, 101), (3, "eggs", None, 102), (4, "tea", 10, None)],
        S(contracts.BRONZE["products"]))
    aisles = spark.createDataFrame([(10, "dairy"), (11, "bakery")], S(contracts.BRONZE["aisles"]))
    departments = spark.createDataFrame([(100, "fresh"), (101, "dry")], S(contracts.BRONZE["departments"]))
    return products, aisles, departments


def test_dim_products(spark):
    products, aisles, departments = _shop(spark)
    out = marts.dim_products(products, aisles, departments)
    assert out.columns == ["product_id", "product_name", "department_name", "aisle"]
    assert bag(out) == [(1, "milk", "fresh", "dairy"), (2, "bread", "dry", "bakery"),
                        (3, "eggs", None, None), (4, "tea", None, "dairy")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]  # as it ran
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_dim_stores_clients_area(spark):
    stores = spark.createDataFrame([(1, 5, 0), (2, 6, 9), (3, 7, None)], S(contracts.BRONZE["stores"]))
    types = spark.createDataFrame([(0, "mall")], S(contracts.BRONZE["store_types"]))
    assert bag(marts.dim_stores(stores, types)) == [(1, 5, "mall"), (2, 6, None), (3, 7, None)]
    clients = spark.createDataFrame([(1, "Ann", 5)], S(contracts.BRONZE["clients"]))
    assert marts.dim_clients(clients).columns == ["client_id", "fullname", "area_id"]
    areas = spark.createDataFrame([(5, "north")], S(contracts.BRONZE["location_areas"]))
    assert bag(marts.dim_area(areas)) == [(5, "north")]


def test_facts_and_dim_date(spark):
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    orders = spark.createDataFrame([(1, 10, 100, 5, 2, d1), (2, 11, 100, 6, 1, d2)], S(contracts.BRONZE["orders"]))
    oos = spark.createDataFrame([(10, d2), (12, dt.date(2021, 1, 5))], S(contracts.BRONZE["out_of_stock"]))
    fact = marts.fact_orders(orders)
    assert fact.columns == list(marts.ORDER_FACT_COLS)
    assert bag(fact) == [(10, 100, 5, d1, 2), (11, 100, 6, d2, 1)]
    assert marts.fact_out_of_stock(oos).columns == ["product_id", "oos_date"]
    assert bag(marts.fact_out_of_stock(oos, run_date=d2)) == [(10, d2)]
    dim = marts.dim_date(orders, oos)
    assert [r.action_date for r in dim.orderBy("action_date").collect()] == [d1, d2, dt.date(2021, 1, 5)]


def test_dim_date_null_date(spark):
    orders = spark.createDataFrame([(1, 10, 100, 5, 2, None)], S(contracts.BRONZE["orders"]))
    oos = spark.createDataFrame([], S(contracts.BRONZE["out_of_stock"]))
    assert bag(marts.dim_date(orders, oos)) == [(None, None, None, None, None)]
    assert marts.dim_date(orders, oos, drop_null_dates=True).count() == 0


def test_append_dim_date_is_key_safe(spark):
    existing = cal.calendar_row(spark, dt.date(2021, 8, 21))
    assert marts.append_dim_date(spark, existing, dt.date(2021, 8, 21)).count() == 0
    assert bag(marts.append_dim_date(spark, existing, dt.date(2021, 8, 22))) == [
        (dt.date(2021, 8, 22), 22, 8, 2021, "Sun")]
